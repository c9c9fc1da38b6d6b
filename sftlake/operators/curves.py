"""Training-log curves, run comparison, run summaries and the multi-run metric table.

Log entries are ``map<string,string>`` (a typed map would null the whole entry as soon as one
value is not a number). An entry without a non-null ``step`` is skipped; it joins the train
series when the *key* ``loss`` is present and the eval series when ``eval_loss`` is present
(one entry can feed both; a present-but-null value still makes a point).
"""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loss_points(entries: DataFrame, run_col: str = "run", entry_col: str = "entry") -> DataFrame:
    """run, series ('train' | 'eval'), step, loss, and pos (the place in the log) if the entries
    have it, which orders entries of one step as resumed runs write them."""
    e = F.col(entry_col)
    routes = F.array(
        F.struct(F.lit("train").alias("series"), F.map_contains_key(e, "loss").alias("has"), e["loss"].alias("v")),
        F.struct(F.lit("eval").alias("series"), F.map_contains_key(e, "eval_loss").alias("has"), e["eval_loss"].alias("v")),
    )
    with_step = entries.where(e["step"].isNotNull())
    pts = with_step.select(
        F.col(run_col).alias("run"),
        *(["pos"] if "pos" in entries.columns else []),
        F.expr(f"try_cast({entry_col}['step'] AS DOUBLE)").alias("step"),
        F.explode(F.filter(routes, lambda r: r["has"])).alias("r"),
    )
    return pts.select(
        "run",
        F.col("r.series").alias("series"),
        F.col("step").cast("long").alias("step"),
        F.expr("try_cast(r.v AS DOUBLE)").alias("loss"),
        *(["pos"] if "pos" in entries.columns else []),
    )


def resolve_labels(run_paths: list[str], labels: list[str] | None = None) -> list[str]:
    """Labels by position; missing ones are the run's parent directory name; surplus labels
    are dropped."""
    given = list(labels or ())[: len(run_paths)]
    return given + [PurePosixPath(p).parent.name for p in run_paths[len(given) :]]


def label_runs(points: DataFrame, mapping: dict[str, str], run_col: str = "run") -> DataFrame:
    """Attach a label to each run from a driver-side mapping (small: one entry per run)."""
    if not mapping:
        return points.withColumn("label", F.col(run_col))
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return points.withColumn("label", F.coalesce(m[F.col(run_col)], F.col(run_col)))


def curve_compare(labelled: DataFrame) -> DataFrame:
    """Per label and series: number of points, loss at the first and at the last point, in log
    order where the points have it, else in step order."""
    order = F.col("pos") if "pos" in labelled.columns else F.col("step")
    return labelled.groupBy("label", "series").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("loss", order).alias("first_loss"),
        F.max_by("loss", order).alias("last_loss"),
    )


def merged_run_summary(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Stored metric documents (run, metrics map) of the two phases -> (run, metric, value) of
    the merged document. A metric that both hold is the evaluation's."""
    both = train.select("run", F.col("metrics").alias("t")).join(evaluation.select("run", F.col("metrics").alias("e")), "run", "full_outer")
    none = F.create_map().cast("map<string,double>")
    t, e = F.coalesce("t", none), F.coalesce("e", none)
    merged = F.map_concat(F.map_filter(t, lambda k, _: ~F.map_contains_key(e, k)), e)
    return both.select("run", F.explode(merged).alias("metric", "value"))


def run_summary(points: DataFrame) -> DataFrame:
    """Per run: train metrics and eval metrics maps, merged, in long form (run, metric, value)."""
    train = F.col("series") == "train"
    ev = F.col("series") == "eval"
    agg = points.groupBy("run").agg(
        F.avg(F.when(train, F.col("loss"))).alias("train_loss"),
        F.count(F.when(train, F.lit(1))).cast("double").alias("train_points"),
        F.max_by(F.when(ev, F.col("loss")), F.when(ev, F.col("step"))).alias("eval_loss"),
        F.count(F.when(ev, F.lit(1))).cast("double").alias("eval_points"),
    )
    train_map = F.create_map(F.lit("train_loss"), F.col("train_loss"), F.lit("train_points"), F.col("train_points"))
    eval_map = F.create_map(F.lit("eval_loss"), F.col("eval_loss"), F.lit("eval_points"), F.col("eval_points"))
    merged = agg.select("run", F.map_concat(train_map, eval_map).alias("metrics"))
    return merged.select("run", F.explode("metrics").alias("metric", "value"))


def metric_table(docs: DataFrame, labels: dict[int, str], base_label: str = "Base") -> DataFrame:
    """Summary documents with a run index ``idx`` -> (label, metric, value): the base model
    taken from the first run only, then the tuned model of every run."""
    lab = F.create_map(*[x for kv in labels.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])

    def rows(label, side: str):
        return F.array(
            F.struct(label.alias("label"), F.lit("mean_nll").alias("metric"), F.col(f"{side}.mean_nll").alias("value")),
            F.struct(label.alias("label"), F.lit("perplexity").alias("metric"), F.col(f"{side}.perplexity").alias("value")),
        )

    first = docs.where(F.col("idx") == 0).select(F.explode(rows(F.lit(base_label), "base")).alias("r"))
    tuned = docs.select(F.explode(rows(lab[F.col("idx")], "oft")).alias("r"))
    return first.unionByName(tuned).select("r.label", "r.metric", "r.value")


def loss_curves(spark, state_paths: list[str], labels: list[str] | None = None, reader=None) -> DataFrame:
    """Trainer-state documents -> label, run_path, pos, series, step, loss, for one or several
    runs. Labels go by position, padded with each run's parent directory name. Every path is
    read with its own label, so any spelling of a path that Spark reads keeps its label. ``reader`` is
    ``jsonl.read_trainer_states`` (whole documents in any layout) unless
    ``trainer_log.read_trainer_documents`` (by lines, of any length) is given."""
    from functools import reduce

    from sftlake.sources.jsonl import read_trainer_states

    parts = []
    for path, label in zip(state_paths, resolve_labels(list(state_paths), labels), strict=True):
        entries = (reader or read_trainer_states)(spark, [path]).withColumn("run", F.lit(path))
        parts.append(loss_points(entries).withColumn("label", F.lit(label)))
    points = reduce(DataFrame.unionByName, parts)
    return points.withColumnRenamed("run", "run_path").select("label", "run_path", "pos", "series", "step", "loss")
