"""The transform job: scan → normalise → hash → long → index → split → keys.

Two passes (the same as any exact size-capped split needs): one small
aggregate that counts rows per input split and identifier kind, and the
output pass.  Neither shuffles data rows; the only shuffle is the one in
the writers that gathers each output part into one task, and a part is
bounded by the destination cap.  The lazy functions (``transform_frame``,
``transform_with_parts``) read the source in both passes; the job path
(``run_transform``) parses the upload once and serves both passes from
persisted hashes, released after the write.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import sha256_hex
from ..functions.normalize import (apply_null_policy_after, apply_null_policy_before,
                                   clean_text, normalize_kind)
from ..functions.paths import chunk_suffix, strip_extension
from ..operators.reshape import (ORDINAL, SPLIT_FILE, SPLIT_START, balanced_split,
                                 tag_source_order, with_file_order_index)
from ..sources.audience import MALFORMED, scan_audience, string_columns
from ..spec import AudienceSpec


def _normalized(df: DataFrame, spec: AudienceSpec, keep: list[str]) -> DataFrame:
    """Normalise every mapped column into ``__norm{i}``, in two projections.

    The first holds exactly one NFKD UDF call per column (``__clean{i}``);
    the second applies the per-kind rules and the null policy to that
    column by name.  Keeping them apart means the UDF runs once per value
    even though the null policy reads the value twice; the kind rules are
    cheap built-ins and may be re-evaluated where a filter is pushed down.
    """
    clean = df.select(*keep, *[
        clean_text(apply_null_policy_before(df[f.column_name], spec.null_policy))
        .alias(f"__clean{i}") for i, f in enumerate(spec.fields)])
    cols = []
    for i, f in enumerate(spec.fields):
        v = normalize_kind(F.col(f"__clean{i}"), f.pii_type, spec.lowercase_email)
        cols.append(apply_null_policy_after(v, spec.null_policy).alias(f"__norm{i}"))
    return clean.select(*keep, *cols)


def normalize_all(df: DataFrame, spec: AudienceSpec, keep: list[str] | None = None) -> DataFrame:
    """Mapped columns, normalised per kind, in mapping order (names kept)."""
    keep = keep or []
    n = _normalized(df, spec, keep)
    return n.select(*keep, *[F.col(f"__norm{i}").alias(f.column_name)
                             for i, f in enumerate(spec.fields)])


def hash_wide(df: DataFrame, spec: AudienceSpec, keep: list[str] | None = None) -> DataFrame:
    """One ``<KIND>_SHA256`` column per mapped column (null where skipped)."""
    keep = keep or []
    n = _normalized(df, spec, keep)
    return n.select(*keep, *[sha256_hex(F.col(f"__norm{i}")).alias(f.output_name)
                             for i, f in enumerate(spec.fields)])


ACCEPTED, NO_VALUE, EMPTY, BAD_LINE = range(4)


def _fates(df: DataFrame, spec: AudienceSpec) -> DataFrame:
    """``df`` with what only the source tells of a value: whether it is null, whether its line is malformed."""
    bad = F.col(MALFORMED).isNotNull() if MALFORMED in df.columns else F.lit(False)
    return df.withColumns({"__bad": bad} | {
        f"__none{i}": df[f.column_name].isNull() for i, f in enumerate(spec.fields)})


def _fate(i: int, hashed: F.Column, spec: AudienceSpec) -> F.Column:
    """One byte a value: accepted, no value, empty after normalising, or on a malformed line."""
    return (F.when(F.col("__bad"), BAD_LINE)
            .when(hashed.isNotNull() & F.lit(spec.null_policy != "skip"), ACCEPTED)
            .when(F.col(f"__none{i}"), NO_VALUE).when(hashed.isNull(), EMPTY).otherwise(ACCEPTED).cast("byte"))


def _write_counts(source: DataFrame, spec: AudienceSpec, path: str) -> None:
    """Per source file and identifier kind: records, and the values of each fate."""
    names = ("accepted", "no_value", "empty", "malformed")
    sums = [F.count(F.when(F.col(f"__fate{i}") == k, 1)).alias(f"{n}{i}")
            for i in range(len(spec.fields)) for k, n in enumerate(names)]
    per_file = source.groupBy(F.col(SPLIT_FILE).alias("source_file")).agg(F.count(F.lit(1)).alias("records"), *sums)
    per_file.select("source_file", "records", F.inline(F.array(*[
        F.struct(F.lit(f.output_name).alias("schema"), *[F.col(f"{n}{i}").alias(n) for n in names])
        for i, f in enumerate(spec.fields)]))).write.parquet(path)


def hashed_long(df: DataFrame, spec: AudienceSpec,
                _cache: list | None = None, _counts_path: str | None = None) -> DataFrame:
    """Long ``(schema, hash)`` rows in column-major order, split-tagged.

    ``df`` should be a file scan (so rows can be tagged with their input
    split).  Under the ``skip`` policy each branch drops missing values on
    the normalised column before hashing, so only kept rows are hashed.
    With ``include_unmapped`` (batch parity option) unmapped string columns
    are melted too, in clear text, under their own names.  Passing a list
    as ``_cache`` persists the hashed columns (see ``run_transform``)
    and appends the persisted frame to it.
    """
    if SPLIT_FILE not in df.columns:
        df = tag_source_order(df)
    tags = [SPLIT_FILE, SPLIT_START]
    extra = []
    if spec.include_unmapped:
        mapped = set(spec.mapped_columns)
        extra = [c for c in string_columns(df) if c not in mapped and c not in tags and c != MALFORMED]
    fates = []
    if _counts_path:
        df = _fates(df, spec)
        fates = ["__bad", *[f"__none{i}" for i in range(len(spec.fields))]]
    norm = _normalized(df, spec, keep=tags + extra + fates)
    hashes = [sha256_hex(F.col(f"__norm{i}")) for i in range(len(spec.fields))]
    source = norm
    if _cache is not None:
        # hashes only: no normalised identifier is ever kept in clear text
        source = norm.select(*tags, *extra, *[h.alias(f"__hash{i}") for i, h in enumerate(hashes)],
                             *([_fate(i, F.col(f"__norm{i}"), spec).alias(f"__fate{i}")
                                for i in range(len(spec.fields))] if fates else []))
        source = source.persist(StorageLevel.MEMORY_AND_DISK)
        _cache.append(source)
        # build the cache in one stage now; otherwise every branch's stage
        # would start on it at once and park tasks on each other's blocks
        if _counts_path:
            _write_counts(source, spec, _counts_path)
        else:
            source.count()
        hashes = [F.col(f"__hash{i}") for i in range(len(spec.fields))]
    skip = spec.null_policy == "skip"
    branches = []
    for i, f in enumerate(spec.fields):
        key = F.col(f"__hash{i}" if _cache is not None else f"__norm{i}")
        b = source.where(key.isNotNull()) if skip else source
        branches.append(b.select(*tags, F.lit(i).alias(ORDINAL), F.lit(f.output_name).alias("schema"),
                                 hashes[i].alias("hash")))
    for j, c in enumerate(extra, start=len(spec.fields)):
        # unmapped strings get the common cleaning (NFKD + strip) but no hash
        v = clean_text(apply_null_policy_before(F.col(c), spec.null_policy))
        b = source.withColumn("__extra", v)
        b = b.where(F.col("__extra").isNotNull()) if skip else b
        branches.append(b.select(*tags, F.lit(j).alias(ORDINAL), F.lit(c).alias("schema"),
                                 F.col("__extra").alias("hash")))
    return reduce(DataFrame.unionAll, branches)


def hashed_unpivot(df: DataFrame, spec: AudienceSpec) -> DataFrame:
    """Long ``(schema, hash)`` rows in no particular order: one scan, one ``Expand``.

    For everything that needs no row order (counts, sizes); the mapped
    columns are normalised and hashed once per input row.
    """
    wide = hash_wide(df, spec)
    names = [f.output_name for f in spec.fields]
    pairs = F.array(*[F.struct(F.lit(n).alias("schema"), F.col(n).alias("hash")) for n in names])
    long = wide.select(F.inline(pairs))
    return long.where(F.col("hash").isNotNull()) if spec.null_policy == "skip" else long


def output_key_column(spec: AudienceSpec, schema_col: str = "schema",
                      chunk_col: str = "chunk", parts_col: str = "n_parts"):
    """Reference-style object key for each output row."""
    stem = strip_extension(F.lit(spec.source_key))
    seg = F.lit(spec.segment_name)
    suffix = chunk_suffix(F.col(chunk_col), F.col(parts_col))
    if spec.profile == "file":
        name = F.when(F.col(parts_col) > 1, F.concat(stem, suffix)).otherwise(stem)
        return F.concat_ws("/", F.lit("output"), F.lit("file"), seg,
                           F.lower(F.col(schema_col)), F.concat(name, F.lit(".csv")))
    return F.concat_ws("/", F.lit("output"), F.lit("batch"), seg,
                       F.concat(stem, suffix, F.lit(".csv.gz")))


def _transform(df: DataFrame, spec: AudienceSpec, cap: int,
               _cache: list | None = None, counts_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Result rows plus a per-group size table (tiny, already materialised)."""
    spec.validate()
    long = hashed_long(df, spec, _cache, counts_path)
    if spec.profile == "file":
        idx, offsets = with_file_order_index(long, index_name="__global",
                                             ordinal_index_name="row_id", return_offsets=True)
        out = balanced_split(idx, cap, index_col="row_id", rows_col="group_rows")
        sizes = offsets.groupBy(ORDINAL).agg(F.sum("__n").alias("n"))
    else:
        idx, offsets = with_file_order_index(long, index_name="row_id", return_offsets=True)
        out = balanced_split(idx, cap, index_col="row_id", rows_col="total_rows")
        sizes = offsets.agg(F.sum("__n").alias("n"))
    out = out.withColumn("segment_name", F.lit(spec.segment_name))
    out = out.withColumn("object_key", output_key_column(spec))
    cols = ["segment_name", "schema", "hash", "row_id", "chunk", "n_parts", "object_key"]
    return out.select(*cols), sizes


def transform_with_parts(df: DataFrame, spec: AudienceSpec,
                         cap_rows: int | None = None) -> tuple[DataFrame, int]:
    """``transform_frame`` plus the exact number of output parts.

    The part count is read from the per-split table (one row per input
    split) that the index step materialises anyway, so it costs no pass
    over the data; writers size their shuffle with it.
    """
    cap = cap_rows or spec.rows_per_file
    out, sizes = _transform(df, spec, cap)
    n_parts = sizes.agg(F.sum(F.ceil(F.col("n") / F.lit(cap)))).first()[0] or 0
    return out, int(n_parts)


@dataclass
class TransformRun:
    """Output rows, exact part count, and a ``release`` for the scan cache.

    ``chunks`` has the number of parts of each schema (batch profile: of ``""``).
    """

    rows: DataFrame
    n_parts: int
    chunks: dict[str, int] = field(default_factory=dict)
    _cached: list = field(default_factory=list)

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached.clear()


def run_transform(df: DataFrame, spec: AudienceSpec, cap_rows: int | None = None,
                  single_scan: bool | None = None, counts_path: str | None = None) -> TransformRun:
    """The transform for a job that writes its output, then releases it.

    ``single_scan`` (default: on for JSON/CSV uploads) parses the upload
    once: the split-tagged, hashed identifier columns are persisted
    (MEMORY_AND_DISK, partitioning and row order kept; a lost block is
    recomputed from the deterministic scan), and the per-kind branches of
    both passes read that instead of re-parsing text.  Measured at 1.5M
    rows: about 1.5x faster than one parse per branch and pass.  Call
    ``release()`` after writing.

    With ``counts_path`` (a new folder) the job that parses the upload also
    counts it, with no further scan: per source file and identifier kind the
    records, and the values accepted, without a value, empty after normalising
    and on malformed lines (a table, see ``read_counts``).
    """
    cap = cap_rows or spec.rows_per_file
    if single_scan is None:
        single_scan = spec.source_format in ("json", "csv")
    if counts_path and not single_scan:
        raise ValueError("counts come from the single scan")
    cache: list = [] if single_scan else None
    out, sizes = _transform(df, spec, cap, cache, counts_path)
    # one row per identifier kind at most
    per_kind = sizes.withColumn("parts", F.ceil(F.col("n") / F.lit(cap))).collect()
    if spec.profile == "file":
        chunks = {spec.fields[r[ORDINAL]].output_name: int(r.parts) for r in per_kind}
    else:
        chunks = {"": sum(int(r.parts or 0) for r in per_kind)}
    return TransformRun(out, sum(chunks.values()), chunks, cache or [])


COUNTS = ("source_file string, records long, schema string, accepted long, no_value long, empty long,"
          " malformed long")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts that ``run_transform`` has written."""
    return spark.read.schema(COUNTS).parquet(path)


def transform_frame(df: DataFrame, spec: AudienceSpec, cap_rows: int | None = None) -> DataFrame:
    """The whole transform on a scanned audience DataFrame.

    Result columns: ``segment_name, schema, hash, row_id, chunk, n_parts,
    object_key``.  File profile: ``row_id`` counts within the identifier
    kind and each kind is split on its own under the byte cap.  Batch
    profile: ``row_id`` is the position in the long table and the whole
    table is split under the row cap.  ``cap_rows`` overrides the
    profile's cap (rows per part).
    """
    return _transform(df, spec, cap_rows or spec.rows_per_file)[0]


def transform(spark: SparkSession, path: str | list[str], spec: AudienceSpec,
              cap_rows: int | None = None) -> DataFrame:
    """Scan ``path`` with the spec's explicit schema and transform it."""
    return transform_frame(scan_audience(spark, path, spec), spec, cap_rows)
