"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE does the runtime work the plans rely on: it coalesces small shuffle partitions, turns a join into a
# broadcast once the measured size allows it, and splits skewed sort-merge partitions (also where that costs
# one more shuffle). Time zone is pinned because order timestamps carry none.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "parcelwise", master: str | None = None, **extra: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``extra`` keys use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``; a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="parcelwise-")
    return f"{base.rstrip('/')}/parcelwise/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by :func:`scratch_dir`, through the file system it lies on."""
    if "/parcelwise/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
