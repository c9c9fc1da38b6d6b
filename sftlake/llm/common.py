"""Small Spark helpers for the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.session import ship_package as _ship
from sftlake.sources.scratch import checkpointed, fresh_dir

__all__ = ["bounded_rows", "bounded_sample", "checkpointed", "fold", "fresh_dir", "letters_lower", "read", "ship_package", "spread"]


BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers. Arrow batches are cut by rows, not bytes:
    where the session still has the default of 10,000 rows, which is too many whole documents at
    once for a worker's memory, it is lowered to ``BATCH_ROWS``."""
    _ship(spark)
    if spark.conf.get(_ROWS, "10000") == "10000":
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fold(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; a null value belongs to fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def letters_lower(c: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spread(*columns: str) -> Column:
    """A uniform number in [0, 1) that depends on the row's values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """All rows when there are at most ``rows``, else about ``rows`` of them (binomial) chosen
    by a hash of their keys, so the choice is repeatable and no task sees more than its own."""
    n = df.count()
    return df if n <= rows else df.where(spread(*keys) < rows / n)


def bounded_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """All rows when there are at most ``rows``, else about ``rows`` of them chosen by a hash of
    their keys, rows alike in all keys once. So neither null nor repeated values of a key bring
    more: the number of rows is held, not that of ids."""
    n = df.count()
    return df if n <= rows else df.where(spread(*keys) < rows / n).dropDuplicates(list(keys))
