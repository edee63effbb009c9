"""Object listings made in tasks, and what changed between two of them.

A tree is listed level by level: each folder is a row, and a task lists the folders dealt to it.  The
driver never holds the listing.  Files come through ``pyarrow.fs`` (``file:``, ``hdfs:``, ``s3:`` and
``s3a:``, ``gs:``, ``abfs:``).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

LISTING = "key string, is_folder boolean, size long, modified long"
#: Tasks of one level of a listing, at most.
LIST_TASKS = 512


def _open(root: str):
    """(file system, path of the root in it)."""
    from pyarrow import fs
    uri = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", root))
    return fs.FileSystem.from_uri(uri if re.match(r"^[a-z][a-z0-9+.-]*:/", uri) else "file://" + os.path.abspath(uri))


def _listed(files: list, base: str) -> pa.RecordBatch:
    from pyarrow.fs import FileType
    files = [f for f in files if f.type != FileType.NotFound]
    return pa.RecordBatch.from_arrays([
        pa.array([f.path[len(base):].lstrip("/") for f in files], pa.string()),
        pa.array([f.type == FileType.Directory for f in files], pa.bool_()),
        pa.array([f.size for f in files], pa.int64()),
        pa.array([None if f.mtime_ns is None else f.mtime_ns // 1_000_000 for f in files], pa.int64())],
        names=["key", "is_folder", "size", "modified"])


def list_objects(spark: SparkSession, root: str, tasks: int = LIST_TASKS) -> DataFrame:
    """(key, size, modified) of every file below ``root``; ``modified`` in milliseconds.

    Names that begin with ``_`` or ``.`` are left out, as Spark's readers do.  A root that does not
    exist has no files.
    """
    def one_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSelector
        store, base = _open(root)
        for batch in batches:
            for folder in batch.column("key").to_pylist():
                at = f"{base.rstrip('/')}/{folder}" if folder else base
                found = store.get_file_info(FileSelector(at, allow_not_found=True))
                yield _listed([f for f in found if f.base_name[:1] not in ("_", ".")], base)

    level, files = spark.createDataFrame([("",)], "key string"), None
    while True:
        path = scratch_path(spark, "listing")
        level.select("key").mapInArrow(one_level, LISTING).write.parquet(path)
        found = spark.read.schema(LISTING).parquet(path)
        own = found.where("not is_folder").drop("is_folder")
        files = own if files is None else files.unionAll(own)
        folders = found.where("is_folder")
        n = folders.count()
        if not n:
            return files
        level = folders.repartition(min(n, tasks))


def present_objects(keys: DataFrame, root: str) -> DataFrame:
    """(key, size, modified) of those of ``keys(key)`` that exist below ``root``, looked up in tasks."""
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType
        store, base = _open(root)
        for batch in batches:
            found = store.get_file_info([f"{base.rstrip('/')}/{k}" for k in batch.column("key").to_pylist()])
            yield _listed([f for f in found if f.type == FileType.File], base)

    return (keys.select("key").where("key is not null").distinct()
            .mapInArrow(look_up, LISTING).drop("is_folder"))


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, status, size, modified): keys that are ``new``, ``changed`` or ``gone`` between two listings.

    Both hold each key once; they are merged by key.  ``size`` and ``modified`` are those of ``after``, of
    ``before`` where the key is gone.
    """
    a = before.select("key", F.col("size").alias("size_a"), F.col("modified").alias("modified_a"), F.lit(True).alias("in_a"))
    b = after.select("key", F.col("size").alias("size_b"), F.col("modified").alias("modified_b"), F.lit(True).alias("in_b"))
    same = F.col("size_a").eqNullSafe(F.col("size_b")) & F.col("modified_a").eqNullSafe(F.col("modified_b"))
    status = (F.when(F.col("in_a").isNull(), F.lit("new")).when(F.col("in_b").isNull(), F.lit("gone"))
              .when(~same, F.lit("changed")))
    return (a.join(b.hint("merge"), "key", "full_outer")
            .select("key", status.alias("status"),
                    F.when(F.col("in_b").isNull(), F.col("size_a")).otherwise(F.col("size_b")).alias("size"),
                    F.when(F.col("in_b").isNull(), F.col("modified_a")).otherwise(F.col("modified_b")).alias("modified"))
            .where(F.col("status").isNotNull()))


def snapshot(spark: SparkSession, root: str, path: str) -> DataFrame:
    """The listing of ``root``, written to ``path`` (a new folder), for later differences."""
    list_objects(spark, root).write.parquet(path)
    return read_snapshot(spark, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, size long, modified long").parquet(path)
