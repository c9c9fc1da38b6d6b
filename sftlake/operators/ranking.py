"""Running counts and sums within groups, without a single-task window.

A window ``partitionBy(g).orderBy(o)`` sorts a whole group in one task; with a hot group
(a third of all rows) that task is the job. Here every row first gets a *bucket* that is
non-decreasing in the order key inside its group. Bucket totals (a small aggregate: at most
groups x buckets rows) are prefix-summed into offsets, and the fine running total is a
window over ``(group, bucket)`` only. The join with the offsets and the window share one
hash partitioning on ``(group, bucket)``, so the big side is shuffled once.

Buckets come either from a uniform hash (``hash_bucket``), whose fraction is scaled by the
group's bucket count, or from approximate quantiles of the order key (``quantile_bucket``).
Both only need to be monotone in the order key; exactness does not depend on their balance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits: exactly representable as a double


def hash_fraction(hex_hash) -> Column:
    """Leading 13 hex digits of a hex digest as a double in [0, 1), monotone in the digest."""
    h = F.col(hex_hash) if isinstance(hex_hash, str) else hex_hash
    return F.conv(F.substring(h, 1, HEX_DIGITS), 16, 10).cast("double") / float(16**HEX_DIGITS)


def hash_bucket(hex_hash, n_buckets) -> Column:
    """Bucket in [0, n_buckets) that is non-decreasing in the hex digest."""
    if isinstance(n_buckets, Column):
        nb = n_buckets
    else:
        nb = F.col(n_buckets) if isinstance(n_buckets, str) else F.lit(n_buckets)
    return F.least(F.floor(hash_fraction(hex_hash) * nb), nb - 1).cast("long")


ROWS_A_BUCKET = 1 << 20


def quantile_bucket(df: DataFrame, col: str, out: str, buckets: int | None = None, rel_err: float | None = None) -> DataFrame:
    """Add ``out``: a bucket non-decreasing in the numeric ``col`` from approximate quantiles.

    Without ``buckets``, one for every ``ROWS_A_BUCKET`` rows (counted), so a bucket's size does
    not follow the data's. ``buckets - 1`` numbers come back to the driver. Nulls go to bucket 0
    (they sort first). A column that isn't numeric raises: a cast would put all of it into one."""
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql.types import NumericType

    if not isinstance(df.schema[col].dataType, NumericType):
        raise ValueError(f"{col!r} must be numeric to be cut into quantile buckets")
    if buckets is None:
        buckets = max(1, -(-df.count() // ROWS_A_BUCKET))
    rel_err = rel_err or min(0.001, 0.1 / buckets)
    probs = [i / buckets for i in range(1, buckets)]
    qs = df.approxQuantile(col, probs, rel_err) if buckets > 1 else []
    splits = sorted({float(q) for q in qs if q is not None})
    if not splits:
        return df.withColumn(out, F.lit(0).cast("long"))
    tmp = f"__{out}_in"
    filled = df.withColumn(tmp, F.coalesce(F.col(col).cast("double"), F.lit(float("-inf"))))
    bz = Bucketizer(
        splits=[float("-inf")] + splits + [float("inf")], inputCol=tmp, outputCol=out, handleInvalid="keep"
    )
    return bz.transform(filled).withColumn(out, F.col(out).cast("long")).drop(tmp)


def ordered_running_total(
    df: DataFrame,
    by: list[str],
    bucket: str,
    order: list,
    out: str,
    value: str | None = None,
) -> DataFrame:
    """Inclusive running total of ``value`` (or running row count) within ``by`` in ``order``.

    Equals ``sum(value) over (partition by by order by order rows unbounded preceding)``
    provided ``bucket`` is non-decreasing in ``order`` within each group and ``order`` is a
    total order. A null group is a group; a null bucket comes first in its group."""
    v = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    keys = [*by, bucket]
    # Equality of structs holds for null fields too, so the join and the window share one key.
    d = df.withColumn("__v", v).withColumn("__g", F.struct(*keys))
    stats = d.groupBy(*keys).agg(F.sum("__v").alias("__s"))
    w_off = (Window.partitionBy(*by) if by else Window).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(F.struct(*keys).alias("__g"), F.coalesce(F.sum("__s").over(w_off), F.lit(0)).alias("__off"))
    joined = d.join(offsets, "__g", "inner")
    w = Window.partitionBy("__g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(out, F.col("__off") + F.sum("__v").over(w)).drop("__v", "__off", "__g")


def window_running_total(df: DataFrame, by: list[str], order: list, out: str, value: str | None = None) -> DataFrame:
    """Single-window form of the same running total (reference for tests; one task per group)."""
    v = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    w = (Window.partitionBy(*by) if by else Window).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return df.withColumn(out, F.sum(v).over(w))
