"""Write PLANS.md: the physical plans of the headline operators, with what each shuffle is for.

usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "stratified_split": (
        "One earlier aggregate, materialised as parquet in the shared folder, counted rows per (kind, hash cell). "
        "Sizes and rank offsets are small tables derived from it. The keys are scanned once more and shuffled once, "
        "on (kind, cell), for the join with the offsets and the rank window, which share that partitioning."
    ),
    "split_audit": (
        "Labels without ranks: each record is compared with the boundary keys of its kind, a materialised table "
        "with one row per kind. No exchange of the records; the audit is one partial aggregate."
    ),
    "token_nll": (
        "Reads only the checkpointed token x tag count matrix: one aggregate with partial sums, no join. "
        "The matrix itself came from one tokenize/explode pass and one groupBy(token)."
    ),
    "before_after_dup": (
        "The per-id aggregate of positions is a hash aggregate, partial, then final (a hot id folds map-side). "
        "Both lookups join on (id <=> id, pos), and pos is unique; no text is sorted."
    ),
    "loss_curves": (
        "Trainer-log lines are read back as splittable text partitioned by run; routing is a "
        "filter + explode of at most two rows per entry; no shuffle."
    ),
    "pack_sequences": (
        "Per-conversation token counts are partial aggregates over rendered segments. The shard running "
        "sum is two-level, with quantile buckets of conv_id, and each text explodes only the blocks it "
        "touches."
    ),
    "truncate_tokens": (
        "Segments carry only their first tokens up to the limit and their last one. Segment offsets inside a "
        "conversation come from the two-level running sum, per 1,024 turn numbers. The last kept token is "
        "one partial aggregate per conversation; no conversation is collected."
    ),
    "split_metadata": (
        "Raw and kept counts come from one pass over the records, unioned with the small stratum-size table; "
        "the split itself is not scanned."
    ),
}


def main() -> None:
    from sftlake.functions.text import STRIP_CHARS
    from sftlake.plans import queries as Q
    from sftlake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8, app="sftlake-plans")
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans of the headline operators",
        "",
        f"Generated by `scripts/dump_plans.py` on `{sf_dir}` (local mode, AQE on; plans shown before AQE re-planning).",
        "At this scale some small sides are broadcast because of size estimates. At 100 TB they become "
        "sort-merge joins on the same keys; the partitioning notes below hold either way.",
        "",
    ]
    for name, note in NOTES.items():
        df = Q.QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.replace(STRIP_CHARS, "<ws29>")
        plan = re.sub(r"\n(?![ :+|]|$)", r"\\n", plan)  # newlines inside string literals
        plan = re.sub(r"#\d+L?", "", plan)
        plan = re.sub(r"\[plan_id=\d+\]", "", plan)
        plan = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: <tables>", plan)
        plan = re.sub(r"MapPartitionsRDD\[\d+\] at checkpoint at [^,]*", "<checkpoint>", plan)
        out += [f"## {name}", "", note, "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
