"""Column discovery, file manifests and run history.

Discovery looks at every record, not only the first one: a JSON-lines file
is read as text and each record's top-level keys are counted in one
aggregate (partial aggregation per task, one row per column name shuffled),
so the answer is exact and costs one scan without schema inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .audience import key_below, scan_csv


def discover_columns_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(column_name, n_records, n_non_null) over all records of a JSON-lines file."""
    recs = spark.read.text(path).select(
        F.from_json("value", T.MapType(T.StringType(), T.StringType())).alias("m"))
    # explode_outer + null filter: plain explode makes Catalyst infer a
    # size(m) > 0 filter below the projection, which would parse every
    # record twice.
    kv = (recs.select(F.explode_outer("m").alias("column_name", "v"))
          .where(F.col("column_name").isNotNull()))
    return kv.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_records"), F.count("v").alias("n_non_null"))


def discover_columns_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(column_name, n_non_null) for every header column of a CSV upload.

    CSV has no separate null: an empty cell reads as missing (as in most CSV
    readers), so the count is of non-empty cells.

    The header gives the names; one aggregate counts non-null values of all
    columns at once, and ``stack`` turns the single result row into rows.
    """
    df = scan_csv(spark, path)
    cols = df.columns
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', c{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, n_non_null)")


def file_manifest(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(key, last_modified, size) of every file below ``root``; contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root)
    return files.select(
        key_below(F.col("path"), root, decode=False).alias("key"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("last_modified"),
        F.col("length").alias("size"))


def sorted_manifest(manifest: DataFrame, by: str = "key") -> DataFrame:
    """O1: the listing ordered by key, newest first, or largest first."""
    keys = {"key": [F.col("key")],
            "date": [F.desc("last_modified"), F.col("key")],
            "size": [F.desc("size"), F.col("key")]}
    return manifest.orderBy(*keys[by])


def object_metadata(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Metadata of one object (key, ISO last-modified, size); contents not read."""
    return file_manifest(spark, root).where(F.col("key") == key)


def file_signatures(spark: SparkSession, root: str, glob: str | None = None,
                    recursive: bool = False) -> DataFrame:
    """(path, size, md5) of every file below ``root`` (reads the contents).

    Non-recursive reads keep Hive-style partition columns from the folders.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root)
    parts = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select("path", *parts, F.col("length").alias("size"),
                        F.md5("content").alias("file_signature"))


def file_signatures_of(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """(path, size, md5) of the named objects below ``root`` only.

    ``keys`` is the bounded list one stream micro-batch refers to; for a
    whole folder use ``file_signatures``.
    """
    paths = [f"{root.rstrip('/')}/{k}" for k in keys]
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.col("length").alias("size"),
                        F.md5("content").alias("file_signature"))


JOB_RUN_SCHEMA = T.StructType([
    T.StructField("Id", T.StringType()),
    T.StructField("StartedOn", T.StringType()),
    T.StructField("JobRunState", T.StringType()),
    T.StructField("ExecutionTime", T.LongType()),
    T.StructField("Arguments", T.MapType(T.StringType(), T.StringType())),
])


def job_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Run history with ``SegmentName`` promoted from the argument map."""
    runs = spark.read.schema(JOB_RUN_SCHEMA).json(path)
    return runs.withColumn("SegmentName",
                           F.try_element_at("Arguments", F.lit("--segment_name")))
