"""Audience file scans (JSON lines, CSV, gzipped hash CSV) with explicit schemas.

Mapped identifier columns are always read as strings: type inference would
turn digit-only phone numbers into numbers and lose leading zeros.  Lines
that do not parse land in ``_corrupt_record`` (PERMISSIVE) instead of
failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import AudienceSpec

HASH_FILE_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("schema", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("segment_name", T.StringType()),
])


#: Where a permissive JSON scan keeps a line that does not parse.
MALFORMED = "_corrupt_record"


def scan_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType,
               mode: str = "PERMISSIVE") -> DataFrame:
    """Newline-delimited JSON objects with an explicit schema (splittable)."""
    return (spark.read.schema(schema).option("mode", mode)
            .option("multiLine", "false").json(path))


def scan_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with header; without a schema every column is read as a string."""
    r = spark.read.option("header", str(header).lower()).option("mode", mode)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", "false")
    return r.csv(path)


def scan_audience(spark: SparkSession, path: str | list[str], spec: AudienceSpec) -> DataFrame:
    """Scan an upload with the spec's columns.

    Malformed lines fail the job unless the spec opts into PERMISSIVE.
    JSON lines: the explicit schema picks fields by name.  CSV is
    positional, so the header supplies the names (every column a string, no
    inference pass) and the spec's columns are selected by name, cast to
    their declared types; a missing mapped column fails at analysis time.
    """
    schema = spec.read_schema()
    if spec.source_format == "csv":
        df = scan_csv(spark, path, mode=spec.read_mode)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    if spec.read_mode == "PERMISSIVE":
        schema = T.StructType(schema.fields + [T.StructField(MALFORMED, T.StringType())])
    return scan_jsonl(spark, path, schema, mode=spec.read_mode)


def scan_hash_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch-profile output files: gzipped CSV, header, ``row_id`` index."""
    return scan_csv(spark, path, HASH_FILE_SCHEMA)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack several scans by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def string_columns(df: DataFrame) -> list[str]:
    """Names of the string-typed columns (the only ones the job processes)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_string_columns(df: DataFrame) -> DataFrame:
    return df.select(*[df[c] for c in string_columns(df)])


def key_below(path: Column, root: str, decode: bool = True) -> Column:
    """Object key of a file: its path minus ``root`` (scheme-insensitive).

    ``decode`` percent-decodes first (``input_file_name`` gives URIs); '+'
    is literal in a URI, so it is protected before decoding.
    """
    if decode:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    no_scheme = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "")
    root_norm = root.split(":", 1)[1] if ":" in root.split("/", 1)[0] else root
    prefix = root_norm.strip("/") + "/"
    return F.right(no_scheme, F.char_length(no_scheme) - F.lit(len(prefix)))


def relative_key(path: Column, root: str) -> Column:
    """Object key of a scanned file from its (percent-encoded) URI."""
    return key_below(path, root, decode=True)


def scan_hash_files(spark: SparkSession, root: str, keys: list[str] | None = None,
                    under: str = "output/batch") -> DataFrame:
    """Rows of batch-profile files, each tagged with its object key.

    With ``keys`` (the bounded list one stream micro-batch names) only those
    files are read.  Without, every ``.gz`` file below ``root/under`` is
    scanned (recursive listing, no key list on the driver); callers join the
    rows to the records they want.
    """
    if keys is not None:
        paths = [f"{root.rstrip('/')}/{k}" for k in keys]
        df = scan_hash_csv(spark, paths)
    else:
        df = (spark.read.option("header", "true").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.gz").schema(HASH_FILE_SCHEMA)
              .csv(f"{root.rstrip('/')}/{under}"))
    return df.withColumn("key", relative_key(F.input_file_name(), root))
