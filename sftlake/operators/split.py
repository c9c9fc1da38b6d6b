"""Deterministic stratified train / val / test split with the audited size rule.

Per stratum of n rows: n_train = floor(n * train), n_val = floor(n * val); when n >= 3 both
are at least 1 and, if n_train + n_val >= n, n_val = max(1, n - n_train - 1); the rest is test.
Rows are ranked inside their stratum by md5(seed ':' key) (tie-break key), so the split is
fixed by the seed and independent of partitioning. One aggregate counts rows per (stratum, hash
cell). Labels need no shuffle of records: the two cells of a stratum that hold its last train and
last val rank give the exact boundary keys, and a row is labelled by comparing its own hash and
key with them. Where the rank itself is wanted, it is a window over (stratum, cell) only, so no
task ever sorts a whole stratum. A null stratum is a stratum like any other; null keys raise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftlake.operators.ranking import ordered_running_total
from sftlake.sources.scratch import checkpointed

SPLITS = ("train", "val", "test")


def check_ratios(train_ratio: float, val_ratio: float) -> None:
    if not 0 < train_ratio < 1:
        raise ValueError(f"train_ratio must be in (0, 1), got {train_ratio}")
    if not 0 < val_ratio < 1:
        raise ValueError(f"val_ratio must be in (0, 1), got {val_ratio}")
    if not train_ratio + val_ratio < 1:
        raise ValueError(f"train_ratio + val_ratio must be < 1, got {train_ratio + val_ratio}")


def split_sizes(counts: DataFrame, train_ratio: float, val_ratio: float, n: str = "n") -> DataFrame:
    """Add n_train, n_val, n_test to a table of stratum sizes."""
    check_ratios(train_ratio, val_ratio)
    cnt = F.col(n)
    nt0 = F.floor(cnt * F.lit(float(train_ratio))).cast("long")
    nv0 = F.floor(cnt * F.lit(float(val_ratio))).cast("long")
    big = cnt >= 3
    nt = F.when(big, F.greatest(nt0, F.lit(1))).otherwise(nt0)
    nv1 = F.when(big, F.greatest(nv0, F.lit(1))).otherwise(nv0)
    out = counts.withColumn("n_train", nt).withColumn("__nv", nv1)
    nv = F.when(big & (F.col("n_train") + F.col("__nv") >= cnt), F.greatest(F.lit(1), cnt - F.col("n_train") - 1)).otherwise(
        F.col("__nv")
    )
    out = out.withColumn("n_val", nv.cast("long")).drop("__nv")
    return out.withColumn("n_test", cnt - F.col("n_train") - F.col("n_val"))


def seeded_hash(seed: int, key, salt: str | None = None) -> Column:
    """md5 hex of 'seed:key' (or 'seed:salt:key')."""
    k = F.col(key) if isinstance(key, str) else key
    prefix = f"{seed}:" if salt is None else f"{seed}:{salt}:"
    return F.md5(F.concat(F.lit(prefix), k.cast("string")))


CELL_DIGITS = 4  # hash cells per stratum: 16^4 = 65,536


def hash_cell(hex_hash, digits: int = CELL_DIGITS) -> Column:
    """Cell of a hex digest: its leading ``digits`` hex digits as a number (monotone in the digest)."""
    h = F.col(hex_hash) if isinstance(hex_hash, str) else hex_hash
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("long")


@dataclass
class SplitPlan:
    """Everything the split needs, from one pass over the records.

    cells:   by, cell, c      rows per (stratum, hash cell); cell -1 counts dropped rows
                              (materialised; everything else is a small table derived from it)
    sizes:   by, n, n_train, n_val, n_test
    offsets: by, __cell, __off, c, n_train, n_val   rows of the stratum in earlier cells
    raw, kept:                counts from one small action over ``cells``
    """

    cells: DataFrame
    sizes: DataFrame
    offsets: DataFrame
    by: str
    cell_digits: int
    raw: int
    kept: int

    def totals(self) -> dict[str, int]:
        """raw, kept, train, val, test."""
        t = self.sizes.agg(F.sum("n_train").alias("train"), F.sum("n_val").alias("val"), F.sum("n_test").alias("test")).first()
        return {"raw": self.raw, "kept": self.kept, **{k: int(v or 0) for k, v in t.asDict().items()}}


def plan_split(
    records: DataFrame,
    train_ratio: float = 0.9,
    val_ratio: float = 0.05,
    seed: int = 42,
    by: str = "kind",
    key: str = "row_id",
    kept: str | None = None,
    cell_digits: int = CELL_DIGITS,
) -> SplitPlan:
    """One aggregate over the records, then only small tables.

    The pass counts rows per (stratum, hash cell) with partial aggregation (a hot stratum folds
    map-side); the result (at most min(rows, strata x 16^cell_digits) narrow rows) is
    materialised. Stratum sizes are its per-stratum sums, and a cell's rank offset is the number
    of the stratum's rows in lower cells. With ``kept``, rows whose flag is false are counted in
    cell -1 (for metadata) and take no part in the split."""
    check_ratios(train_ratio, val_ratio)
    cell = hash_cell(seeded_hash(seed, key), cell_digits)
    if kept:
        cell = F.when(F.col(kept), cell).otherwise(F.lit(-1).cast("long"))
    cells = checkpointed(records.groupBy(by, cell.alias("cell")).agg(F.count(F.lit(1)).alias("c")))
    is_kept = F.col("cell") >= 0
    st = cells.agg(
        F.sum("c").alias("raw"), F.sum(F.when(is_kept, F.col("c"))).alias("kept"), F.count_if(F.col("cell").isNull()).alias("unkeyed")
    ).first()
    if st["unkeyed"]:
        raise ValueError(f"records with a null {key!r} cannot be split")
    kept_cells = cells.where(is_kept)
    sizes = split_sizes(kept_cells.groupBy(by).agg(F.sum("c").alias("n")), train_ratio, val_ratio)
    w = Window.partitionBy(by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = kept_cells.select(by, F.col("cell").alias("__cell"), F.coalesce(F.sum("c").over(w), F.lit(0)).alias("__off"), "c")
    per = sizes.select(F.col(by).alias("__by"), "n_train", "n_val")
    offsets = before.join(per, F.col(by).eqNullSafe(F.col("__by"))).drop("__by")
    return SplitPlan(cells, sizes, offsets, by, cell_digits, int(st["raw"] or 0), int(st["kept"] or 0))


def _ranked(records: DataFrame, cells: DataFrame, by: str, digits: int, seed: int, key: str) -> DataFrame:
    """Adds split_hash and stratum_rank to the records that lie in the given cells (offsets);
    the join and the window share one shuffle on (stratum, cell)."""
    d = records.withColumn("split_hash", seeded_hash(seed, key))
    # Equality of structs holds for a null stratum too.
    d = d.withColumn("__at", F.struct(F.col(by).alias("s"), hash_cell("split_hash", digits).alias("c")))
    cells = cells.select(F.struct(F.col(by).alias("s"), F.col("__cell").alias("c")).alias("__at"), "__off", "n_train", "n_val")
    w = Window.partitionBy("__at").orderBy("split_hash", key)
    return d.join(cells, "__at").withColumn("stratum_rank", F.col("__off") + F.row_number().over(w)).drop("__at", "__off")


def split_boundaries(records: DataFrame, plan: SplitPlan, seed: int = 42, key: str = "row_id") -> DataFrame:
    """by, last_train, last_val: the (hash, key) of each stratum's last train and last val row
    (null when there is none), materialised. Only the keys of the one or two cells per stratum
    that hold those ranks are ranked."""
    by = plan.by
    end_val = F.col("n_train") + F.col("n_val")
    holds = lambda rank: (F.col("__off") < rank) & (rank <= F.col("__off") + F.col("c"))
    cells = checkpointed(plan.offsets.where(holds(F.col("n_train")) | holds(end_val)))
    r = _ranked(records.select(by, key), cells, by, plan.cell_digits, seed, key)
    at = F.struct(F.col("split_hash").alias("h"), F.col(key).alias("k"))
    bounds = r.groupBy(by).agg(
        F.max(F.when(F.col("stratum_rank") == F.col("n_train"), at)).alias("last_train"),
        F.max(F.when(F.col("stratum_rank") == end_val, at)).alias("last_val"),
    )
    return checkpointed(bounds)


def assign_splits(records: DataFrame, plan: SplitPlan, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Adds split_hash and split by comparing each row with its stratum's boundaries. The
    boundary table has a row per stratum and a measured size, so it is broadcast when small;
    beyond that the join is a plain one, whose hot strata Spark splits. ``records`` must hold
    the kept rows only."""
    by = plan.by
    bounds = split_boundaries(records, plan, seed, key).withColumnRenamed(by, "__by")
    d = records.withColumn("split_hash", seeded_hash(seed, key))
    d = d.join(bounds, F.col(by).eqNullSafe(F.col("__by")), "left")
    at = F.struct(F.col("split_hash").alias("h"), F.col(key).alias("k"))
    split = F.when(at <= F.col("last_train"), "train").when(at <= F.col("last_val"), "val").otherwise("test")
    return d.withColumn("split", split).drop("__by", "last_train", "last_val")


def rank_splits(records: DataFrame, plan: SplitPlan, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Adds split_hash, stratum_rank and split; one shuffle of the records, on (stratum, cell)."""
    r = _ranked(records, plan.offsets, plan.by, plan.cell_digits, seed, key)
    rank = F.col("stratum_rank")
    split = (
        F.when(rank <= F.col("n_train"), "train")
        .when(rank <= F.col("n_train") + F.col("n_val"), "val")
        .otherwise("test")
    )
    return r.withColumn("split", split).drop("n_train", "n_val")


def stratified_split(
    records: DataFrame,
    train_ratio: float = 0.9,
    val_ratio: float = 0.05,
    seed: int = 42,
    by: str = "kind",
    key: str = "row_id",
    cell_digits: int = CELL_DIGITS,
) -> DataFrame:
    """records -> records + split_hash, stratum_rank, split."""
    plan = plan_split(records, train_ratio, val_ratio, seed, by, key, cell_digits=cell_digits)
    return rank_splits(records, plan, seed, key)


def split_totals(sizes: DataFrame) -> DataFrame:
    """Three rows (split, size) from the stratum-size table."""
    t = sizes.agg(
        F.sum("n_train").alias("train"), F.sum("n_val").alias("val"), F.sum("n_test").alias("test")
    )
    return t.select(
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("split"), F.coalesce(F.col(s), F.lit(0)).alias("size")) for s in SPLITS])
        ).alias("t")
    ).select("t.split", "t.size")


def order_within_splits(split_df: DataFrame, seed: int = 42, key: str = "row_id", cell_digits: int = CELL_DIGITS) -> DataFrame:
    """Seeded shuffle of each finished split: order_hash = md5(seed ':order:' key) and
    order_pos = 1-based position in that order inside the split. Positions are counted per
    (split, hash cell); the offsets table has at most three times 16^cell_digits rows."""
    d = split_df.withColumn("order_hash", seeded_hash(seed, key, salt="order"))
    d = d.withColumn("__b", hash_cell("order_hash", cell_digits))
    return ordered_running_total(d, by=["split"], bucket="__b", order=["order_hash", key], out="order_pos").drop("__b")


def exact_overlap(split_df: DataFrame, columns: list[str], side: str = "test", other: str = "train") -> DataFrame:
    """Rows of one split whose text columns all equal those of a row of the other; compared by
    a 128-bit digest, so no text is shuffled for the other side."""
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    seen = split_df.where(F.col("split") == other).select(digest.alias("__d"))
    mine = split_df.where(F.col("split") == side).withColumn("__d", digest)
    return mine.join(seen, "__d", "left_semi").drop("__d")


def split_audit(split_df: DataFrame, by: str = "kind") -> DataFrame:
    """Per stratum: rows in train / val / test."""
    p = split_df.groupBy(by).pivot("split", list(SPLITS)).agg(F.count(F.lit(1)))
    return p.select(by, *[F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in SPLITS])


def split_metadata(plan: SplitPlan) -> DataFrame:
    """One row: total_raw, total_kept, total_skipped, train_size, val_size, test_size.

    Everything comes from the plan's small tables (a plan built with ``kept=`` counts dropped
    rows in cell -1), so the records and the split are not scanned again."""
    a = plan.cells.select(
        F.col("c").alias("raw"),
        F.when(F.col("cell") >= 0, F.col("c")).otherwise(F.lit(0)).alias("kept"),
        *[F.lit(0).cast("long").alias(s) for s in SPLITS],
    )
    b = plan.sizes.select(
        F.lit(0).cast("long").alias("raw"),
        F.lit(0).cast("long").alias("kept"),
        F.col("n_train").alias("train"),
        F.col("n_val").alias("val"),
        F.col("n_test").alias("test"),
    )
    t = a.unionByName(b).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("raw", "kept", *SPLITS)])
    return t.select(
        F.col("raw").alias("total_raw"),
        F.col("kept").alias("total_kept"),
        (F.col("raw") - F.col("kept")).alias("total_skipped"),
        F.col("train").alias("train_size"),
        F.col("val").alias("val_size"),
        F.col("test").alias("test_size"),
    )


_FINISH = 4096  # keys brought to the driver once the cutoff is known to lie among them
_SAMPLE = 1024


def head_rows(df: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    """The first n rows by the ``order`` columns, of any type (None or 0 = all rows); the result
    is the same rows in no particular order.

    The cutoff key is found on the order columns alone: a sample of the keys gives splitters, one
    aggregate counts the rows up to each, and the interval that holds the n-th key is searched
    again until it has few keys. Then rows up to the cutoff are a filter, which reaches the scan;
    no task ever holds the head. The order must be total."""
    if not n:
        return df
    key = F.struct(*order)
    kinds = {f.name: f.dataType for f in df.schema}

    def literal(row) -> Column:
        return F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in order])

    keys = df.select(*order)
    inside, need = keys, int(n)
    if (m := keys.count()) <= need:
        return df
    while m > _FINISH:
        part = F.pmod(F.xxhash64(*order, F.lit(m)), F.lit(1 << 30)) < int((1 << 30) * _SAMPLE / m)
        sample = inside.where(part).orderBy(*order).collect()
        step = max(1, len(sample) // 64)
        at = sample[::step] or [inside.orderBy(*order).first()]
        counts = inside.agg(*[F.count_if(key <= literal(r)).alias(str(k)) for k, r in enumerate(at)]).first()
        k = next((k for k in range(len(at)) if counts[k] >= need), len(at))
        below = counts[k - 1] if k else 0
        if k:
            inside = inside.where(key > literal(at[k - 1]))
        if k < len(at):
            inside = inside.where(key <= literal(at[k]))
        left = (counts[k] if k < len(at) else m) - below
        if left == m:
            raise ValueError(f"{order} is not a total order")
        need, m = need - below, left
    cutoff = inside.orderBy(*order).collect()[need - 1]
    first = F.col(order[0])
    if cutoff[0] is None:
        return df.where(key <= literal(cutoff))
    # The plain comparison of the first column is what a scan can use.
    return df.where(first.isNull() | (first <= F.lit(cutoff[0]).cast(kinds[order[0]]))).where(key <= literal(cutoff))
