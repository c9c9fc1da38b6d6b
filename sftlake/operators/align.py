"""Before/after output alignment, the report blocks, prompt counts and the generator plug-in.

Alignment rule: results are the prompts in order, each with its own base output. For the
tuned outputs, every prompt updates the *first* result with an equal id (null equals null),
so the first result of an id ends up with the tuned output of the *last* prompt carrying
that id and every later duplicate keeps ''. With unique ids this is a plain lookup.

Spark form: one hash aggregate per id over positions alone (first and last; partial, so a hot id
is folded map-side). The output at the last position is fetched by (id, position), and joined to
the row at the first by (id, position): both keys are unique, so no task holds a whole id and no
text is sorted or aggregated. ``rows`` is read twice; generated rows must be materialised first,
as ``generate_before_after`` does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.text import normalize_text

# Report document texts.
REPORT_TITLE = "# Before vs After (OFT)\n\n"
PROMPT_HEADING = "**Prompt**"
BASE_HEADING = "**Base Model Output**"
TUNED_HEADING = "**OFT Output**"


def with_group_default(prompts: DataFrame, col: str = "group") -> DataFrame:
    """Prompts without a group column are of the group ``unknown``. Where single lines lack the
    key, ``read_prompts`` fills it in; an explicit null stays null."""
    return prompts if col in prompts.columns else prompts.withColumn(col, F.lit("unknown"))


def prompt_groups(prompts: DataFrame) -> DataFrame:
    """group, n; prompts whose group is null are one group."""
    return with_group_default(prompts).groupBy("group").agg(F.count(F.lit(1)).alias("n"))


def before_after(rows: DataFrame, id_col: str = "id", pos_col: str = "pos") -> DataFrame:
    """rows: pos, id, group, prompt, base_output, tuned_output (each generated per row).
    Returns pos, id, group, prompt, base_output, tuned_output after alignment."""
    r = with_group_default(rows)
    ends = r.groupBy(id_col).agg(F.min(pos_col).alias("__first"), F.max(pos_col).alias("__last"))
    ends = ends.withColumnRenamed(id_col, "__id")
    last = r.select(F.col(id_col).alias("__key"), F.col(pos_col).alias("__pos"), F.col("tuned_output").alias("__last_tuned"))
    found = ends.join(last, F.col("__id").eqNullSafe(F.col("__key")) & (F.col("__last") == F.col("__pos")))
    found = found.select("__id", "__first", "__last_tuned")
    cond = r[id_col].eqNullSafe(found["__id"]) & (r[pos_col] == found["__first"])
    j = r.drop("tuned_output").join(found, cond, "left")
    return j.select(
        pos_col, id_col, "group", "prompt", "base_output",
        F.coalesce(F.col("__last_tuned"), F.lit("")).alias("tuned_output"),
    )


def report_block(id_col: str = "id", group_col: str = "group") -> Column:
    """'## id - group' then the three sections, each followed by a blank line."""
    sep = F.lit("\n\n")
    return F.concat(
        F.lit("## "), F.coalesce(F.col(id_col), F.lit("None")), F.lit(" - "), F.coalesce(F.col(group_col), F.lit("None")), sep,
        F.lit(PROMPT_HEADING), sep, F.col("prompt"), sep,
        F.lit(BASE_HEADING), sep, F.col("base_output"), sep,
        F.lit(TUNED_HEADING), sep, F.col("tuned_output"), sep,
    )


# ---------------------------------------------------------------- bundled rule generator

# The bundled stand-in "models": the base echoes the prompt, the tuned one lower-cases it and
# folds ASCII whitespace runs into one space. Both see the whole prompt.
ASCII_WS_RUN = r"[\x{9}-\x{d}\x{20}]+"


def base_rule_output(prompt) -> Column:
    return normalize_text(prompt)


def tuned_rule_output(prompt) -> Column:
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return normalize_text(F.lower(F.regexp_replace(p, ASCII_WS_RUN, " ")))


class DigestGenerator:
    """A generator for checking the plug-in path: answers with the length and the md5 of the
    model input it was given, so the answer is right only if the rendered prompt is."""

    def __call__(self):
        import hashlib

        def gen(prompts: list[str], **_params) -> list[str]:
            return [f" {len(p)}:{hashlib.md5(p.encode()).hexdigest()}\n" for p in prompts]

        return gen


_GEN_CACHE: dict = {}

GeneratorFactory = Callable[[], Callable[..., list[str]]]


def _model_input(prompts: DataFrame, prompt_col: str, render_template: bool) -> Column:
    from sftlake.functions.chat import render_chat
    from sftlake.operators.records import user_turn

    return render_chat(user_turn(prompt_col), add_generation_prompt=True) if render_template else F.col(prompt_col)


def generate(
    prompts: DataFrame,
    id_col: str,
    prompt_col: str,
    factory: GeneratorFactory,
    cache_key: str,
    render_template: bool = False,
    **gen_params,
) -> DataFrame:
    """One output per prompt from a user generator run over Arrow batches (loaded once per
    Python worker). With ``render_template`` the generator sees the chat-rendered prompt with
    the generation suffix (rendered JVM-side). ``gen_params`` (max_new_tokens, temperature,
    top_p, ...) are passed through. Outputs are stripped like decoded text. Returns id, output."""
    import pandas as pd

    from sftlake.session import ship_package

    ship_package(prompts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from sftlake.operators import align as this  # the worker's module: one cache per process

        gen = this._GEN_CACHE.get(cache_key)
        if gen is None:
            gen = this._GEN_CACHE[cache_key] = factory()
        for pdf in batches:
            outs = gen(pdf["__input"].fillna("").tolist(), **gen_params)
            yield pd.DataFrame({id_col: pdf[id_col].values, "output": [o.strip() for o in outs]})

    id_type = dict(prompts.dtypes)[id_col]
    src = prompts.select(id_col, _model_input(prompts, prompt_col, render_template).alias("__input"))
    # Similar lengths share a batch (less padding for real models); no shuffle.
    src = src.sortWithinPartitions(F.length("__input"))
    return src.mapInPandas(run, f"{id_col} {id_type}, output string")


def generate_before_after(
    prompts: DataFrame,
    base_factory: GeneratorFactory,
    tuned_factory: GeneratorFactory,
    cache_key: str,
    render_template: bool = False,
    **gen_params,
) -> DataFrame:
    """prompts (pos, id, group, prompt) -> aligned before/after rows. Both generators run in
    one pass over the prompts, whose result is materialised, so every later use sees the same
    outputs; alignment as ``before_after``."""
    import pandas as pd

    from sftlake.session import ship_package

    ship_package(prompts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from sftlake.operators import align as this  # the worker's module: one cache per process

        cache = this._GEN_CACHE
        key_b, key_t = f"{cache_key}:base", f"{cache_key}:tuned"
        if key_b not in cache:
            cache[key_b] = base_factory()
        if key_t not in cache:
            cache[key_t] = tuned_factory()
        for pdf in batches:
            inputs = pdf["__input"].fillna("").tolist()
            out = pdf.drop(columns=["__input"])
            out["base_output"] = [o.strip() for o in cache[key_b](inputs, **gen_params)]
            out["tuned_output"] = [o.strip() for o in cache[key_t](inputs, **gen_params)]
            yield out

    src = prompts.select("pos", "id", "group", "prompt", _model_input(prompts, "prompt", render_template).alias("__input"))
    src = src.sortWithinPartitions(F.length("__input"))
    schema = "pos long, id string, group string, prompt string, base_output string, tuned_output string"
    from sftlake.sources.scratch import checkpointed

    return before_after(checkpointed(src.mapInPandas(run, schema)))


def length_change(aligned: DataFrame) -> DataFrame:
    """Per group: prompts, mean characters before and after, and how many got shorter."""
    base, tuned = F.length("base_output"), F.length("tuned_output")
    return aligned.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(base).alias("base_chars"),
        F.avg(tuned).alias("tuned_chars"),
        F.count_if(tuned < base).alias("shorter"),
    )


def outcome_tally(aligned: DataFrame, outcomes: DataFrame) -> DataFrame:
    """outcome, n: aligned rows by the outcome labelled for their id (outcomes: id, outcome)."""
    return aligned.select("id").join(outcomes, "id").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def write_before_after(aligned: DataFrame, output_dir: str) -> int:
    """Writes ``jsonl`` (id, group, prompt, base_output, tuned_output in prompt order) and
    ``report``; the report and the returned row count are taken from the written rows."""
    from sftlake.sources.jsonl import BEFORE_AFTER_SCHEMA, read_jsonl, write_jsonl, write_report

    spark = aligned.sparkSession
    cols = ["pos", "id", "group", "prompt", "base_output", "tuned_output"]
    write_jsonl(aligned.select(*cols).repartitionByRange("pos").sortWithinPartitions("pos"), f"{output_dir}/jsonl")
    rows = read_jsonl(spark, f"{output_dir}/jsonl", BEFORE_AFTER_SCHEMA)
    write_report(rows.select("pos", report_block().alias("block")), f"{output_dir}/report", REPORT_TITLE)
    return rows.count()
