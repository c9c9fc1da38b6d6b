"""The shared folder for intermediate files and checkpoints.

On a cluster the folder is whatever ``spark.checkpoint.dir`` names (a shared
file system every executor can reach). Only a local-mode session without that
setting gets a fresh temporary folder, so tests run anywhere; a cluster session
without it is an error rather than a silent machine-local path.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def shared_root(spark: SparkSession) -> str:
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder reachable by all executors"
            )
        root = tempfile.mkdtemp(prefix="sftlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def session_root(spark: SparkSession) -> str:
    """This application's own folder under the shared root."""
    sc = _context(spark)
    return f"{shared_root(spark)}/sftlake-{sc.applicationId if sc is not None else 'connect'}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path in the session's folder (not created; writers create it)."""
    return f"{session_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete everything this application has written to its folder. Call it when no DataFrame
    that reads an intermediate table is needed any more. False when there was nothing."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(session_root(spark))
    return bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))


_RECORDS: list[list[str]] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside the block remove their shuffle files when they end. Otherwise these
    stay until the driver's garbage collection finds that nothing refers to them any more."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def collected(df: DataFrame) -> list[Row]:
    """The rows of ``df`` at the driver; the shuffle files behind them go at once."""
    with shuffles_removed(df.sparkSession):
        return df.select("*").collect()  # a query that begins inside the block


@contextlib.contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that ``checkpointed`` writes inside the block."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        # By identity: a block around this one may have recorded the same paths.
        _RECORDS[:] = [p for p in _RECORDS if p is not paths]


def remove_tables(spark: SparkSession, paths: Iterable[str], needed_by: DataFrame) -> list[str]:
    """Delete intermediate tables, and return those that stay: any that ``needed_by`` reads, and
    any outside this application's folder."""
    read = needed_by.inputFiles()
    own = session_root(spark) + "/"
    stay = []
    for path in paths:
        at = path.split(":", 1)[-1].lstrip("/") + "/"
        if not path.startswith(own) or any(at in f for f in read):
            stay.append(path)
            continue
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return stay


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint and survives executor loss, but is columnar and
    compressed, and the re-read carries exact file sizes, so the planner's broadcast decisions
    for these small tables rest on measured sizes. The shuffle files behind it go with the write."""
    spark = df.sparkSession
    path = fresh_dir(spark, "table")
    with shuffles_removed(spark):
        df.write.mode("overwrite").parquet(path)
    for paths in _RECORDS:
        paths.append(path)
    return spark.read.parquet(path)
