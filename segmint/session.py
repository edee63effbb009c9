"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is built by the platform; the library only *reads*
``spark.checkpoint.dir`` and writes derived tables below it.  A local
scratch folder is created only when the setting is absent (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Files of a shuffle go when the write or the micro-batch that made them has ended.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "segmint") -> SparkSession:
    """A local[N] session with AQE on and the UI off (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # bound Arrow batches by bytes too: whole texts can be long
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # delete checkpoint files of DataFrames that are no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for derived tables and checkpoints.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; otherwise (local
    runs only; elsewhere it raises) creates a fresh temporary folder and registers it as the
    checkpoint dir, so ``DataFrame.checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="segmint-scratch-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A new path below the scratch root (``unique`` adds a random leaf)."""
    base = os.path.join(scratch_root(spark), "segmint", *parts)
    return os.path.join(base, uuid.uuid4().hex) if unique else base


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a derived table that is no longer read, on whichever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session's settings inside; those before come back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
