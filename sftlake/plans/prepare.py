"""The prepare job: raw records -> normalised SFT records -> stratified split -> JSONL + metadata.

Jobs it runs:
  1. one aggregate over the normalised records: rows per (kind, hash cell), dropped rows in
     cell -1 (checkpointed). Stratum sizes, rank offsets and every metadata count come from it;
  2. the boundary keys of each stratum, from the keys of at most two hash cells of it;
  3. the write: rows are labelled by comparison with the boundaries and range-partitioned on
     (split, order_hash) so each split's files come out in its seeded order, partitioned by
     split. That is the one shuffle of the texts;
     The writing tasks count their rows, and the counts must be the planned ones;
  4. a one-row metadata document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.operators.records import message, normalized
from sftlake.operators.split import SPLITS, assign_splits, check_ratios, head_rows, plan_split, seeded_hash
from sftlake.sources.jsonl import write_splits

METADATA_SCHEMA = (
    "dataset_name string, dataset_split string, total_raw long, total_kept long, total_skipped long, "
    "train_size long, val_size long, test_size long, train_ratio double, val_ratio double, seed long, "
    "max_samples long"
)


def prepare(
    raw: DataFrame,
    output_dir: str,
    *,
    dataset_name: str = "local",
    dataset_split: str = "train",
    train_ratio: float = 0.9,
    val_ratio: float = 0.05,
    max_samples: int | None = None,
    seed: int = 42,
    key: str = "row_id",
) -> dict:
    """``raw``: key, kind, input, target (strings). Writes ``<output_dir>/splits/split=*/``
    and ``<output_dir>/metadata/``; returns the metadata as a dict."""
    check_ratios(train_ratio, val_ratio)
    src = head_rows(raw, max_samples, [key])  # None or 0 = every row
    norm = normalized(src, key)
    plan = plan_split(norm, train_ratio, val_ratio, seed, key=key, kept="kept")
    t = plan.totals()

    kept = norm.where("kept").drop("kept").withColumn(
        "messages", F.array(message("user", "prompt"), message("assistant", "response"))
    )
    split = assign_splits(kept, plan, seed=seed, key=key)
    split = split.withColumn("order_hash", seeded_hash(seed, key, salt="order"))
    if key != "row_id":
        split = split.withColumnRenamed(key, "row_id")
    written = write_splits(split, f"{output_dir}/splits")
    spark = raw.sparkSession
    if any(written[s] != t[s] for s in SPLITS):
        raise RuntimeError(f"planned {t}, but wrote {written}: the input changed between the passes, or its keys are not unique")

    meta = {
        "dataset_name": dataset_name,
        "dataset_split": dataset_split,
        "total_raw": t["raw"],
        "total_kept": t["kept"],
        "total_skipped": t["raw"] - t["kept"],
        "train_size": t["train"],
        "val_size": t["val"],
        "test_size": t["test"],
        "train_ratio": float(train_ratio),
        "val_ratio": float(val_ratio),
        "seed": int(seed),
        "max_samples": int(max_samples) if max_samples else None,
    }
    spark.createDataFrame([meta], METADATA_SCHEMA).coalesce(1).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(f"{output_dir}/metadata")
    return meta
