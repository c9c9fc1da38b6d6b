"""Local session builder used by tests and the bench (clusters bring their own)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sftlake") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SFTLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make the ``sftlake`` package importable in Python workers, as ``--py-files`` would.

    Plug-in operators (mapInPandas, pandas UDFs) pickle sftlake objects by reference, so
    workers must be able to import the package. Zipped once per session and added with
    ``addPyFile`` (``addArtifacts`` under Spark Connect); Spark distributes the archive."""
    import tempfile
    import zipfile
    from pathlib import Path

    key = spark.conf.get("spark.app.id", None) or str(id(spark))
    if key in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="sftlake-pyfiles-")) / "sftlake.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(pkg.rglob("*.py")):
            z.write(f, f.relative_to(pkg.parent).as_posix())
    try:
        spark.sparkContext.addPyFile(str(path))
    except Exception:  # noqa: BLE001 - Spark Connect session
        spark.addArtifacts(str(path), pyfile=True)
    _SHIPPED.add(key)
