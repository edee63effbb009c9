"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver tables (or data Spark
derives from them), plus the DuckDB SQL that computes the same result.

Every query runs over whole tables and whole texts.  Where a query takes a
cap smaller than the destination's (to make splitting visible at small
scale), the cap is a named parameter of the query and the oracle uses the
same value.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import sha256_hex
from ..functions.normalize import nfkd, strip
from ..operators import activation as A
from ..operators import payloads as PL
from ..operators.reshape import MID, SPLIT_FILE, SPLIT_START, tag_source_order
from ..session import scratch_path
from ..sinks.writers import (read_file_profile, write_batch_profile, write_file_profile,
                             write_output)
from ..sources import discovery as D
from ..sources.audience import (relative_key, scan_hash_csv, scan_hash_files, scan_jsonl,
                                select_string_columns, union_by_name)
from ..spec import FILE_CAP_BYTES, HASH_LINE_BYTES, AudienceSpec, PiiField
from ..streaming.activation_stream import (PLAN_COLUMNS, read_outbox, read_payloads,
                                           start_activation_stream)
from . import oracle_sql as O
from .derived import (audience_catalogue_sql, audience_pages_dir, contacts_csv, contacts_frame,
                      contacts_jsonl, job_runs_dir, job_runs_sql, notifications_frame,
                      notifications_sql, queue_dir, queue_records, segment_catalogue_sql,
                      segment_pages_dir)
from .transform import (hash_wide, hashed_unpivot, normalize_all, transform_frame,
                        transform_with_parts)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# --- the audience specs used by the queries --------------------------------
SEGMENT = "contacts"
SOURCE_KEY = "uploads/contacts.json"
FILE_SPEC = AudienceSpec(
    "file", (PiiField("e-mail", "EMAIL"), PiiField("phone_number", "PHONE"),
             PiiField("mobile_advertiser_id", "GAID")), SEGMENT, SOURCE_KEY)
BATCH_SPEC = AudienceSpec(
    "batch", (PiiField("e-mail", "EMAIL"), PiiField("phone_number", "PHONE"),
              PiiField("mobile_advertiser_id", "MOBILE_AD_ID")), SEGMENT, SOURCE_KEY)
# Small caps so that splitting shows at test scale (parameters, not limits).
SMALL_ROW_CAP = 1_000
SMALL_BYTE_CAP = 64 * 1024

CONTACTS_SCHEMA = T.StructType([
    T.StructField("contact_id", T.LongType()),
    T.StructField("age", T.LongType()),
    T.StructField("e-mail", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("mobile_advertiser_id", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("full_name", T.StringType()),
])


def contacts_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_jsonl(spark, contacts_jsonl(spark, sf_dir), CONTACTS_SCHEMA)


def audience_scan(spark: SparkSession, sf_dir: str, spec: AudienceSpec) -> DataFrame:
    return scan_jsonl(spark, contacts_jsonl(spark, sf_dir), spec.read_schema(),
                      mode=spec.read_mode)


# ===========================================================================
# Scans, projection, normalisation, hashing
# ===========================================================================

CONTACT_COLS_SQL = ('contact_id, age, "e-mail", phone_number, mobile_advertiser_id, '
                    'segment, full_name')


@register("scan_jsonl", f"{O.with_ctes(O.CONTACTS_CTE)} SELECT {CONTACT_COLS_SQL} FROM c")
def q_scan_jsonl(spark, sf_dir):
    """JSON-lines audience scan with an explicit schema."""
    return contacts_scan(spark, sf_dir)


UNION_SEGMENTS = ("automobile", "building")


@register("union_by_name", O.with_ctes(O.CONTACTS_CTE) + (
    'SELECT contact_id, "e-mail", phone_number, NULL::VARCHAR AS mobile_advertiser_id, segment '
    "FROM c WHERE segment IN ('automobile', 'building') UNION ALL "
    'SELECT contact_id, "e-mail", phone_number, mobile_advertiser_id, segment '
    "FROM c WHERE segment NOT IN ('automobile', 'building')"))
def q_union_by_name(spark, sf_dir):
    """Two uploads with different columns, stacked by name.

    The contacts are written as two uploads: one for two segments without
    the advertising-id column, one for the rest with it.
    """
    contacts = contacts_frame(spark, sf_dir)
    in_first = F.col("segment").isin(*UNION_SEGMENTS)
    base = scratch_path(spark, "derived", "union_uploads")
    a_path, b_path = f"{base}/a", f"{base}/b"
    (contacts.where(in_first).select("contact_id", "e-mail", "phone_number", "segment")
     .write.json(a_path))
    (contacts.where(~in_first)
     .select("contact_id", "e-mail", "phone_number", "mobile_advertiser_id", "segment")
     .write.json(b_path))
    a = scan_jsonl(spark, a_path, "contact_id BIGINT, `e-mail` STRING, phone_number STRING, "
                                  "segment STRING")
    b = scan_jsonl(spark, b_path, "contact_id BIGINT, `e-mail` STRING, phone_number STRING, "
                                  "mobile_advertiser_id STRING, segment STRING")
    return union_by_name([a, b]).select("contact_id", "e-mail", "phone_number",
                                        "mobile_advertiser_id", "segment")


@register("select_string_cols", O.with_ctes(O.CONTACTS_CTE) +
          'SELECT "e-mail", phone_number, mobile_advertiser_id, segment, full_name FROM c')
def q_select_string_cols(spark, sf_dir):
    """Keep string-typed columns only."""
    return select_string_columns(contacts_scan(spark, sf_dir))


@register("select_pii", O.with_ctes(O.CONTACTS_CTE) +
          'SELECT "e-mail", phone_number, mobile_advertiser_id FROM c')
def q_select_pii(spark, sf_dir):
    """Mapped columns only, in mapping order."""
    return audience_scan(spark, sf_dir, FILE_SPEC).select(*FILE_SPEC.mapped_columns)


DROP_SPEC = AudienceSpec("file", (PiiField("e-mail", "EMAIL"),
                                  PiiField("mobile_advertiser_id", "GAID")), SEGMENT, SOURCE_KEY)


@register("drop_column", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE) +
          "SELECT sha256(email_n) AS EMAIL_SHA256, sha256(ad_n) AS GAID_SHA256 FROM n")
def q_drop_column(spark, sf_dir):
    """The phone column removed from the mapping; hashes of the rest."""
    return hash_wide(audience_scan(spark, sf_dir, DROP_SPEC), DROP_SPEC)


LITERAL_SPEC = AudienceSpec(FILE_SPEC.profile, FILE_SPEC.fields, SEGMENT, SOURCE_KEY,
                            null_policy="literal")


@register("null_policy", O.with_ctes(O.CONTACTS_CTE) + (
    f"SELECT sha256({O.email_sql(O.literal_none(chr(34) + 'e-mail' + chr(34)))}) AS EMAIL_SHA256, "
    f"sha256({O.phone_sql(O.literal_none('phone_number'))}) AS PHONE_SHA256, "
    f"sha256({O.ad_id_sql(O.literal_none('mobile_advertiser_id'))}) AS GAID_SHA256 FROM c"))
def q_null_policy(spark, sf_dir):
    """parity policy – nulls hashed as the text 'None', empties hashed."""
    return hash_wide(audience_scan(spark, sf_dir, LITERAL_SPEC), LITERAL_SPEC)


@register("nfkd", "SELECT doc_id, sha256(t) AS text_sha256, CAST(length(t) AS BIGINT) AS n_chars_nfkd "
          f"FROM (SELECT doc_id, {O.nfkd_sql('text')} AS t FROM documents)")
def q_nfkd(spark, sf_dir):
    """NFKD of every document's whole text (hash + length of the result)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", nfkd(F.col("text")).alias("t"))
    return docs.select("doc_id", sha256_hex(F.col("t")).alias("text_sha256"),
                       F.length("t").cast("long").alias("n_chars_nfkd"))


@register("strip", "SELECT doc_id, sha256(" + O.strip_sql("text") + ") AS text_sha256, "
          "CAST(length(" + O.strip_sql("text") + ") AS BIGINT) AS n_chars_stripped FROM documents")
def q_strip(spark, sf_dir):
    """strip Unicode whitespace from every document's whole text."""
    t = strip(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", sha256_hex(t).alias("text_sha256"),
        F.length(t).cast("long").alias("n_chars_stripped"))


def _normalize_one(spark: SparkSession, sf_dir: str, column: str, kind: str) -> DataFrame:
    spec = AudienceSpec("file", (PiiField(column, kind),), SEGMENT, SOURCE_KEY,
                        extra_columns=(("contact_id", "LONG"),))
    return normalize_all(audience_scan(spark, sf_dir, spec), spec, keep=["contact_id"])


@register("normalize_phone", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE) +
          "SELECT contact_id, phone_n AS phone_number FROM n")
def q_normalize_phone(spark, sf_dir):
    """digits only, no leading zeros (empty → null)."""
    return _normalize_one(spark, sf_dir, "phone_number", "PHONE")


@register("normalize_email", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE) +
          'SELECT contact_id, email_n AS "e-mail" FROM n')
def q_normalize_email(spark, sf_dir):
    """e-mail is NFKD + strip only (no lower-casing by default)."""
    return _normalize_one(spark, sf_dir, "e-mail", "EMAIL")


@register("normalize_ad_id", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE) +
          "SELECT contact_id, ad_n AS mobile_advertiser_id FROM n")
def q_normalize_ad_id(spark, sf_dir):
    """advertising ids lower-cased."""
    return _normalize_one(spark, sf_dir, "mobile_advertiser_id", "GAID")


@register("normalize_all", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE) +
          'SELECT contact_id, email_n AS "e-mail", phone_n AS phone_number, '
          "ad_n AS mobile_advertiser_id FROM n")
def q_normalize_all(spark, sf_dir):
    """F8: dispatch by identifier kind over all mapped columns."""
    spec = replace(FILE_SPEC, extra_columns=(("contact_id", "LONG"),))
    return normalize_all(audience_scan(spark, sf_dir, spec), spec, keep=["contact_id"])


@register("hash_wide", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE, O.hashed_cte("GAID")) +
          "SELECT EMAIL_SHA256, PHONE_SHA256, GAID_SHA256 FROM h")
def q_hash_wide(spark, sf_dir):
    """P5+F9: SHA-256 per mapped column, renamed <KIND>_SHA256."""
    return hash_wide(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC)


@register("melt_hashes", O.long_with("MOBILE_AD_ID") +
          f"SELECT schema, hash, '{SEGMENT}' AS segment_name FROM l")
def q_melt_hashes(spark, sf_dir):
    """R1+P6: wide → long (schema, hash) plus the constant segment name."""
    long = hashed_unpivot(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC)
    return long.select("schema", "hash", F.lit(SEGMENT).alias("segment_name"))


@register("schema_counts", O.long_with("MOBILE_AD_ID") +
          f"SELECT '{SEGMENT}' AS segment_name, schema, count(*) AS n_hashes FROM l GROUP BY schema")
def q_schema_counts(spark, sf_dir):
    """A1+A2: rows per identifier kind in the long table (flagship)."""
    long = hashed_unpivot(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC)
    return (long.groupBy("schema").agg(F.count(F.lit(1)).alias("n_hashes"))
            .select(F.lit(SEGMENT).alias("segment_name"), "schema", "n_hashes"))


@register("balanced_split", O.batch_split_sql(SMALL_ROW_CAP))
def q_balanced_split(spark, sf_dir):
    """Balanced contiguous parts of ≤ SMALL_ROW_CAP rows, global row index."""
    return transform_frame(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC,
                           cap_rows=SMALL_ROW_CAP)


PART_SUMMARY_SQL = ("SELECT schema, chunk, n_parts, count(*) AS n_rows, min(row_id) AS first_row, "
                    "max(row_id) AS last_row, CAST(sum(strlen(hash) + 1) AS BIGINT) AS n_bytes "
                    "FROM ({}) t GROUP BY schema, chunk, n_parts")


def part_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("schema", "chunk", "n_parts").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("row_id").alias("first_row"),
        F.max("row_id").alias("last_row"),
        F.sum(F.octet_length("hash") + 1).cast("long").alias("n_bytes"))


@register("split_by_rows", PART_SUMMARY_SQL.format(O.batch_split_sql(100_000)))
def q_split_by_rows(spark, sf_dir):
    """Batch profile under the destination's 100,000-row cap, per part."""
    return part_summary(transform_frame(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC))


@register("split_by_bytes", PART_SUMMARY_SQL.format(
    O.file_split_sql(SMALL_BYTE_CAP // HASH_LINE_BYTES)))
def q_split_by_bytes(spark, sf_dir):
    """R2: file profile under a byte cap (SMALL_BYTE_CAP), per identifier kind."""
    df = transform_frame(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC,
                         cap_rows=SMALL_BYTE_CAP // HASH_LINE_BYTES)
    return part_summary(df)


@register("output_keys", "SELECT object_key, schema, chunk, count(*) AS n_rows FROM ("
          + O.file_split_sql(SMALL_BYTE_CAP // HASH_LINE_BYTES) + ") t GROUP BY ALL")
def q_output_keys(spark, sf_dir):
    """K3+F14+F15: object key per output part (extension stripped, zero-padded)."""
    df = transform_frame(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC,
                         cap_rows=SMALL_BYTE_CAP // HASH_LINE_BYTES)
    return df.groupBy("object_key", "schema", "chunk").agg(F.count(F.lit(1)).alias("n_rows"))


@register("output_size", O.long_with("GAID") + (
    "SELECT schema, count(*) AS n_rows, CAST(sum(strlen(hash) + 1) AS BIGINT) AS n_bytes, "
    f"CAST(ceil(sum(strlen(hash) + 1) / {FILE_CAP_BYTES}) AS BIGINT) AS n_files_at_cap "
    "FROM l GROUP BY schema"))
def q_output_size(spark, sf_dir):
    """K4: bytes each identifier file would take, without a trial write."""
    long = hashed_unpivot(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC)
    size = F.sum(F.octet_length("hash") + 1)
    return long.groupBy("schema").agg(
        F.count(F.lit(1)).alias("n_rows"), size.cast("long").alias("n_bytes"),
        F.ceil(size / F.lit(FILE_CAP_BYTES)).cast("long").alias("n_files_at_cap"))


@register("transform", O.file_split_sql(O.FILE_CAP_ROWS))
def q_transform(spark, sf_dir):
    """The whole file-profile transform at the destination's cap."""
    return transform_frame(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC)


@register("file_profile_sink", "SELECT hash, segment_name, schema, chunk FROM ("
          + O.file_split_sql(SMALL_BYTE_CAP // HASH_LINE_BYTES) + ") t")
def q_file_profile_sink(spark, sf_dir):
    """K1: write headerless per-kind parts, read them back."""
    df, n_parts = transform_with_parts(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC,
                                       cap_rows=SMALL_BYTE_CAP // HASH_LINE_BYTES)
    path = write_file_profile(df, scratch_path(spark, "out", "file_profile"), num_parts=n_parts)
    return read_file_profile(spark, path)


@register("batch_profile_sink", "SELECT row_id, schema, hash, segment_name, chunk FROM ("
          + O.batch_split_sql(SMALL_ROW_CAP) + ") t")
def q_batch_profile_sink(spark, sf_dir):
    """K2+R5: gzipped CSV parts with header and row index, read back."""
    df, n_parts = transform_with_parts(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC,
                                       cap_rows=SMALL_ROW_CAP)
    path = write_batch_profile(df, scratch_path(spark, "out", "batch_profile"), num_parts=n_parts)
    back = spark.read.option("header", "true").option("basePath", path).schema(
        "row_id BIGINT, schema STRING, hash STRING, segment_name STRING, "
        "segment STRING, chunk BIGINT").csv(path)
    return back.select("row_id", "schema", "hash", "segment_name", "chunk")


@register("scan_hash_csv", "SELECT row_id, schema, hash, segment_name FROM ("
          + O.batch_split_sql(100_000) + ") t")
def q_scan_hash_csv(spark, sf_dir):
    """S3: read the gzipped batch-profile files with their header."""
    df, n_parts = transform_with_parts(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC)
    path = write_batch_profile(df, scratch_path(spark, "out", "batch_profile"), num_parts=n_parts)
    return scan_hash_csv(spark, f"{path}/*/*/*.csv.gz")


# ===========================================================================
# Activation: events, routing, catalogues, plan, dead letters, status
# ===========================================================================


NOTIF_CTE = f"nt AS ({notifications_sql()})"
# the rule of a deployment: one account and region, a bucket prefix of its own
RULE = A.EventRule(account="123456789012", region="us-east-1")
# rows without a source are malformed bodies
FILTERED_CTE = (
    f"f AS (SELECT * FROM nt WHERE source = '{A.EVENT_SOURCE}' "
    f"AND detail_type = '{A.EVENT_DETAIL_TYPE}' "
    f"AND account = '{RULE.account}' AND region = '{RULE.region}' "
    f"AND starts_with(bucket, '{A.BUCKET_PREFIX}') AND starts_with(object_key, '{A.KEY_PREFIX}'))")
ROUTED_CTE = (
    "r0 AS (SELECT message_id, bucket, object_key, size, url_decode(replace(object_key, '+', ' ')) AS key FROM f), "
    "r1 AS (SELECT *, regexp_extract(key, '[^/]*$', 0) AS file_name, "
    "string_split(regexp_replace(key, '/?[^/]*$', ''), '/') AS dirs FROM r0), "
    "r AS (SELECT message_id, bucket, object_key, size, key, file_name, dirs[2] AS profile, "
    "dirs[3] AS audience, regexp_replace(dirs[4], '^[^=/]*=', '') AS type_dir FROM r1)")
REASON_CTE = (
    "rr AS (SELECT *, CASE WHEN profile = 'file' AND upper(type_dir) IN "
    "('PHONE_SHA256', 'EMAIL_SHA256', 'GAID_SHA256', 'IDFA_SHA256') THEN upper(type_dir) END "
    "AS calculate_type FROM r), "
    "rs AS (SELECT *, CASE WHEN audience IS NULL OR audience = '' THEN 'BAD_KEY' "
    "WHEN profile NOT IN ('file', 'batch') THEN 'UNKNOWN_PROFILE' "
    "WHEN profile = 'file' AND type_dir IS NULL THEN 'BAD_KEY' "
    "WHEN profile = 'file' AND calculate_type IS NULL THEN 'UNSUPPORTED_TYPE' "
    "WHEN profile = 'batch' AND NOT ends_with(file_name, '.gz') THEN 'UNSUPPORTED_FILE' END AS reason0 "
    "FROM rr)")
AUD_CTE = (f"ac AS ({audience_catalogue_sql()}), "
           "al AS (SELECT name, arg_min(audience_id, page * 1000000 + position) AS audience_id "
           "FROM ac GROUP BY name)")
SEG_CTE = (f"sc AS ({segment_catalogue_sql()}), "
           "sl AS (SELECT name, arg_min(id, page * 1000000 + position) AS segment_id "
           "FROM sc GROUP BY name)")
PLAN_CTE = (
    "pj AS (SELECT rs.*, al.audience_id AS aid, coalesce(sl.segment_id, '0') AS sid FROM rs "
    "LEFT JOIN al ON al.name = rs.audience LEFT JOIN sl ON sl.name = rs.audience), "
    "pr AS (SELECT *, coalesce(reason0, CASE WHEN profile <> 'file' AND sid = '0' "
    "THEN 'SEGMENT_NOT_FOUND' END) AS reason, "
    "row_number() OVER (PARTITION BY audience, profile = 'file' AND reason0 IS NULL "
    "ORDER BY message_id) AS nth FROM pj), "
    "plan AS (SELECT message_id, bucket, key, file_name, profile, audience, calculate_type, "
    "CASE WHEN profile = 'file' THEN aid END AS audience_id, "
    "CASE WHEN profile <> 'file' THEN sid END AS segment_id, "
    "CASE WHEN reason IS NOT NULL THEN NULL WHEN profile = 'file' AND aid IS NULL AND nth = 1 THEN 'CREATE' "
    "WHEN profile = 'file' THEN 'APPEND' ELSE 'ADD_USERS' END AS action, reason, size FROM pr "
    "UNION ALL SELECT message_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'BAD_BODY', NULL "
    "FROM nt WHERE source IS NULL)")
PLAN_WITH = O.with_ctes(NOTIF_CTE, FILTERED_CTE, ROUTED_CTE, REASON_CTE, AUD_CTE, SEG_CTE,
                        PLAN_CTE)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.parse_records(spark.read.schema(A.QUEUE_SCHEMA).json(queue_dir(spark, sf_dir)))


def audiences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.audience_catalogue(spark.read.text(audience_pages_dir(spark, sf_dir)))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.segment_catalogue(spark.read.text(segment_pages_dir(spark, sf_dir)))


def activation_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.plan_activation(records(spark, sf_dir), audiences(spark, sf_dir),
                             segments(spark, sf_dir), rule=RULE)


@register("event_source", O.with_ctes(NOTIF_CTE) +
          "SELECT message_id, source, detail_type, account, region, bucket, object_key, size, "
          "source IS NULL AS malformed FROM nt")
def q_event_source(spark, sf_dir):
    """Queue records with a JSON body → flat notification columns."""
    return records(spark, sf_dir).select("message_id", "source", "detail_type", "account", "region",
                                         "bucket", "object_key", "size", "malformed")


@register("event_filter", O.with_ctes(NOTIF_CTE, FILTERED_CTE) +
          "SELECT message_id, source, detail_type, account, region, bucket, object_key, size FROM f")
def q_event_filter(spark, sf_dir):
    """Created objects under output/ in the artifacts buckets of one account and region."""
    return A.event_filter(records(spark, sf_dir), RULE).select(
        "message_id", "source", "detail_type", "account", "region", "bucket", "object_key", "size")


@register("route_key", O.with_ctes(NOTIF_CTE, FILTERED_CTE, ROUTED_CTE) +
          "SELECT message_id, key, file_name, profile, audience, type_dir FROM r")
def q_route_key(spark, sf_dir):
    """T2+F12+F13: decode the key, split into profile/audience/type/file."""
    return A.route_key(A.event_filter(records(spark, sf_dir), RULE)).select(
        "message_id", "key", "file_name", "profile", "audience", "type_dir")


@register("route_type", O.with_ctes(NOTIF_CTE, FILTERED_CTE, ROUTED_CTE, REASON_CTE) +
          "SELECT message_id, type_dir, calculate_type FROM rr WHERE profile = 'file'")
def q_route_type(spark, sf_dir):
    """Identifier type from the key, case-insensitive, null when unsupported."""
    routed = A.route_key(A.event_filter(records(spark, sf_dir), RULE))
    return routed.where(F.col("profile") == "file").select(
        "message_id", "type_dir", A.calculate_type(F.col("type_dir")).alias("calculate_type"))


@register("route_suffix", O.with_ctes(NOTIF_CTE, FILTERED_CTE, ROUTED_CTE) +
          "SELECT message_id, file_name, ends_with(file_name, '.gz') AS supported "
          "FROM r WHERE profile = 'batch'")
def q_route_suffix(spark, sf_dir):
    """Batch-profile files must be gzipped (.gz)."""
    routed = A.route_key(A.event_filter(records(spark, sf_dir), RULE))
    return routed.where(F.col("profile") == "batch").select(
        "message_id", "file_name", A.supported_file(F.col("file_name")).alias("supported"))


@register("audience_catalogue", f"SELECT name, audience_id, page, position FROM ({audience_catalogue_sql()}) a")
def q_audience_catalogue(spark, sf_dir):
    """Paged list responses → one row per listed audience."""
    return audiences(spark, sf_dir)


@register("segment_catalogue", f"SELECT name, id, page, position FROM ({segment_catalogue_sql()}) s")
def q_segment_catalogue(spark, sf_dir):
    """Segment responses → one row per segment."""
    return segments(spark, sf_dir)


@register("resolve_audience", O.with_ctes(AUD_CTE) + "SELECT name, audience_id FROM al")
def q_resolve_audience(spark, sf_dir):
    """Exact-name look-up table, first listed wins."""
    return A.first_by_name(audiences(spark, sf_dir), "audience_id")


@register("resolve_segment", PLAN_WITH +
          "SELECT message_id, audience, sid AS segment_id FROM pj WHERE profile = 'batch'")
def q_resolve_segment(spark, sf_dir):
    """Segment id per batch-profile record, 0 when the name is unknown."""
    routed = A.route_key(A.event_filter(records(spark, sf_dir), RULE))
    batch = routed.where(F.col("profile") == "batch")
    return A.resolve_segment(batch, segments(spark, sf_dir)).select(
        "message_id", "audience", "segment_id")


@register("activation_plan", PLAN_WITH + "SELECT * FROM plan")
def q_activation_plan(spark, sf_dir):
    """Route, resolve, decide APPEND / CREATE / ADD_USERS per record."""
    return activation_plan(spark, sf_dir)


@register("dead_letters", PLAN_WITH +
          "SELECT message_id, bucket, key, reason FROM plan WHERE reason IS NOT NULL")
def q_dead_letters(spark, sf_dir):
    """T3+T4: records that cannot be activated, with the reason."""
    return A.dead_letters(activation_plan(spark, sf_dir))


@register("activation_status", PLAN_WITH + (
    "SELECT message_id, CASE WHEN reason IS NULL THEN 200 ELSE 400 END AS status_code, "
    "CASE WHEN action = 'APPEND' THEN format('Audience {} is successfully updated', audience) "
    "WHEN action = 'CREATE' THEN format('Audience {} is successfully created', audience) "
    "WHEN action = 'ADD_USERS' THEN format('Users sent to segment {}', audience) "
    "ELSE format('ERROR {} for key {}', reason, coalesce(key, '')) END AS message FROM plan"))
def q_activation_status(spark, sf_dir):
    """T5: one status code and message per record."""
    return A.status_message(activation_plan(spark, sf_dir))


@register("upload_summary", PLAN_WITH + (
    "SELECT audience, count(*) AS n_files, count(reason) AS n_bad_files, "
    "count(*) FILTER (WHERE action = 'CREATE') AS n_create, "
    "count(*) FILTER (WHERE action = 'APPEND') AS n_append, "
    "count(*) FILTER (WHERE action = 'ADD_USERS') AS n_add_users FROM plan GROUP BY audience"))
def q_upload_summary(spark, sf_dir):
    """A5: per audience, files seen, bad files and actions taken."""
    plan = activation_plan(spark, sf_dir)
    act = F.col("action")
    return plan.groupBy("audience").agg(
        F.count(F.lit(1)).alias("n_files"), F.count("reason").alias("n_bad_files"),
        F.count(F.when(act == "CREATE", 1)).alias("n_create"),
        F.count(F.when(act == "APPEND", 1)).alias("n_append"),
        F.count(F.when(act == "ADD_USERS", 1)).alias("n_add_users"))


# ===========================================================================
# Discovery, manifests, run history, delivery payloads and responses
# ===========================================================================



def _count_union(cols: list[str], nn: bool) -> str:
    """Per-column fill counts; for CSV (``nn`` false) empty cells count as missing."""
    parts = []
    for c in cols:
        q = f'"{c}"'
        cnt = f"count({q})" if nn else f"count(NULLIF(CAST({q} AS VARCHAR), ''))"
        parts.append(f"SELECT '{c}' AS column_name, "
                     + (f"{cnt} AS n_records, {cnt} AS n_non_null" if nn else f"{cnt} AS n_non_null")
                     + " FROM c")
    return " UNION ALL ".join(parts)


ALL_CONTACT_COLUMNS = ["contact_id", "age", "e-mail", "phone_number", "mobile_advertiser_id",
                       "segment", "full_name"]


@register("discover_columns_json", O.with_ctes(O.CONTACTS_CTE) +
          _count_union(ALL_CONTACT_COLUMNS, True))
def q_discover_columns_json(spark, sf_dir):
    """Every top-level key of every record, with fill counts (no inference)."""
    return D.discover_columns_json(spark, contacts_jsonl(spark, sf_dir))


@register("discover_columns_csv", O.with_ctes(O.CONTACTS_CTE) +
          _count_union(ALL_CONTACT_COLUMNS, False))
def q_discover_columns_csv(spark, sf_dir):
    """Header columns of a CSV upload with non-null counts."""
    return D.discover_columns_csv(spark, contacts_csv(spark, sf_dir))


FIRST_N = 5


@register("first_rows", f"{O.with_ctes(O.CONTACTS_CTE)} SELECT {CONTACT_COLS_SQL} FROM c "
          f"ORDER BY contact_id LIMIT {FIRST_N}")
def q_first_rows(spark, sf_dir):
    """O2: the first records of an upload in file order (top-k, no full sort)."""
    scan = tag_source_order(contacts_scan(spark, sf_dir)).withColumn(
        MID, F.monotonically_increasing_id())
    return (scan.orderBy(SPLIT_FILE, SPLIT_START, MID).limit(FIRST_N)
            .select(*CONTACTS_SCHEMA.fieldNames()))


def written_parts(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the file-profile parts at the small byte cap, freshly written."""
    df, n_parts = transform_with_parts(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC,
                                       cap_rows=SMALL_BYTE_CAP // HASH_LINE_BYTES)
    return write_file_profile(df, scratch_path(spark, "out", "file_profile"), num_parts=n_parts)


def _manifest_sql(more: str = "") -> str:
    return ("SELECT concat('segment_name=', segment_name, '/schema=', schema, '/chunk=', chunk) AS folder, "
            "CAST(sum(strlen(hash) + 1) AS BIGINT) AS size" + more + " FROM ("
            + O.file_split_sql(SMALL_BYTE_CAP // HASH_LINE_BYTES) + ") t GROUP BY segment_name, schema, chunk")


ISO_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}(Z|[+-]\d{2}:\d{2})$"


def _listed(manifest: DataFrame) -> DataFrame:
    """Without the part's own file name, which is random."""
    return manifest.withColumn("folder", F.regexp_replace("key", "/[^/]*$", ""))


@register("file_manifest", _manifest_sql(", true AS iso_time"))
def q_file_manifest(spark, sf_dir):
    """S6+F17: listing of the written parts (key, ISO last-modified, size); no contents read."""
    m = D.file_manifest(spark, written_parts(spark, sf_dir), "*.csv")
    return _listed(m).select("folder", "size", F.col("last_modified").rlike(ISO_TIME).alias("iso_time"))


@register("manifest_sorted", _manifest_sql() + " ORDER BY size DESC, folder")
def q_manifest_sorted(spark, sf_dir):
    """O1: the listing sorted by size (largest first), then key."""
    m = D.file_manifest(spark, written_parts(spark, sf_dir), "*.csv")
    return _listed(D.sorted_manifest(m, "size")).select("folder", "size")


@register("job_runs", (
    "SELECT Id, strftime(StartedOn, '%Y-%m-%dT%H:%M:%S') AS StartedOn, JobRunState, "
    "ExecutionTime, CASE WHEN has_arguments THEN segment_arg END AS SegmentName "
    f"FROM ({job_runs_sql()}) j"))
def q_job_runs(spark, sf_dir):
    """Run history; SegmentName from the argument map where it exists."""
    return D.job_runs(spark, job_runs_dir(spark, sf_dir)).select(
        "Id", "StartedOn", "JobRunState", "ExecutionTime", "SegmentName")


def batch_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch-profile output rows (one file per chunk) at the small row cap."""
    return transform_frame(audience_scan(spark, sf_dir, BATCH_SPEC), BATCH_SPEC,
                           cap_rows=SMALL_ROW_CAP)


BATCH_PARTS_SQL = O.batch_split_sql(SMALL_ROW_CAP)
SEND_ORDER_SQL = ("CASE schema WHEN 'EMAIL_SHA256' THEN 1 WHEN 'MOBILE_AD_ID_SHA256' THEN 2 "
                  "WHEN 'PHONE_SHA256' THEN 3 END")


@register("supported_schemas", (
    f"WITH t AS ({BATCH_PARTS_SQL}), cnt AS (SELECT segment_name, chunk, schema, count(*) AS n "
    "FROM t GROUP BY ALL), opt AS (SELECT unnest(['EMAIL_SHA256', 'MOBILE_AD_ID_SHA256', "
    "'PHONE_SHA256']) AS schema), files AS (SELECT DISTINCT segment_name, chunk FROM cnt) "
    f"SELECT segment_name, chunk, {SEND_ORDER_SQL} AS send_order, schema, n AS n_rows FROM cnt "
    f"WHERE {SEND_ORDER_SQL} IS NOT NULL UNION ALL "
    f"SELECT f.segment_name, f.chunk, {SEND_ORDER_SQL.replace('schema', 'o.schema')} AS send_order, "
    "o.schema, 0 AS n_rows FROM files f, opt o WHERE NOT EXISTS (SELECT 1 FROM cnt c "
    "WHERE c.segment_name = f.segment_name AND c.chunk = f.chunk AND c.schema = o.schema)"))
def q_supported_schemas(spark, sf_dir):
    """P10+A1+A2: rows per supported schema in each output file, in send order."""
    return PL.supported_schemas(batch_parts(spark, sf_dir))


@register("hash_arrays", (
    "SELECT schema, row_id, CAST(len(string_split(hash, ', ')) AS INTEGER) AS n_items, "
    f"string_split(hash, ', ')[1] AS first_item FROM ({BATCH_PARTS_SQL}) t"))
def q_hash_arrays(spark, sf_dir):
    """each hash cell split on ', ' into a list."""
    df = PL.hash_lists(batch_parts(spark, sf_dir))
    return df.select("schema", "row_id", F.size("hash_list").alias("n_items"),
                     F.element_at("hash_list", 1).alias("first_item"))


@register("payloads", (
    "WITH t AS (" + BATCH_PARTS_SQL + "), g AS (SELECT segment_name, chunk, schema, "
    f"{SEND_ORDER_SQL} AS send_order, count(*) AS n_users, "
    "concat('{\"users\":[{\"schema\":[\"', schema, '\"],\"data\":[', "
    "string_agg(concat('[\"', hash, '\"]'), ',' ORDER BY row_id), ']}]}') AS payload "
    f"FROM t WHERE {SEND_ORDER_SQL} IS NOT NULL GROUP BY segment_name, chunk, schema) "
    "SELECT segment_name, chunk, send_order, schema, n_users, "
    "CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_sha256 FROM g"))
def q_payloads(spark, sf_dir):
    """A3+F16: one JSON request body per file and schema (bounded by the row cap)."""
    p = PL.payloads(batch_parts(spark, sf_dir))
    return p.select("segment_name", "chunk", "send_order", "schema", "n_users",
                    F.octet_length("payload").cast("long").alias("payload_bytes"),
                    sha256_hex(F.col("payload")).alias("payload_sha256"))


@register("upload_results", PLAN_WITH + (
    "SELECT audience, count(*) AS n_requests, CAST(sum(size // 65) AS BIGINT) AS n_uploaded_users "
    "FROM plan WHERE action = 'ADD_USERS' GROUP BY audience"))
def q_upload_results(spark, sf_dir):
    """A4: uploaded-user counts parsed from the responses, summed per segment.

    The responses log is derived from the outbox: one response per request,
    reporting the rows its file holds (size / 65 bytes per line).
    """
    sent = A.outbox(activation_plan(spark, sf_dir)).where(F.col("action") == "ADD_USERS")
    resp = sent.select("message_id", F.to_json(F.struct(
        F.lit("SUCCESS").alias("request_status"),
        F.array(F.struct(F.lit("SUCCESS").alias("sub_request_status"),
                         F.struct((F.col("size") / 65).cast("long").alias("number_uploaded_users"))
                         .alias("user"))).alias("users"))).alias("response"))
    path = scratch_path(spark, "derived", "responses")
    resp.write.json(path)
    parsed = PL.uploaded_users(spark.read.schema("message_id STRING, response STRING").json(path))
    joined = parsed.join(sent.select("message_id", "audience"), "message_id")
    return joined.groupBy("audience").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.sum("number_uploaded_users").cast("long").alias("n_uploaded_users"))


@register("activation_requests", (
    "WITH t AS (" + O.file_split_sql(SMALL_BYTE_CAP // HASH_LINE_BYTES) + ") "
    "SELECT segment_name, upper(schema) AS calculate_type, chunk, "
    "CAST(sum(strlen(hash) + 1) AS BIGINT) AS size, "
    "md5(string_agg(concat(hash, chr(10)), '' ORDER BY row_id)) AS file_signature "
    "FROM t GROUP BY segment_name, schema, chunk"))
def q_activation_requests(spark, sf_dir):
    """Upload request per written file: identifier type, size, md5 signature."""
    df, n_parts = transform_with_parts(audience_scan(spark, sf_dir, FILE_SPEC), FILE_SPEC,
                                       cap_rows=SMALL_BYTE_CAP // HASH_LINE_BYTES)
    path = write_file_profile(df, scratch_path(spark, "out", "file_profile"), num_parts=n_parts)
    sig = D.file_signatures(spark, path, "*.csv")
    return sig.select("segment_name", F.upper("schema").alias("calculate_type"), "chunk",
                      "size", "file_signature")


# ===========================================================================
# Streaming activation
# ===========================================================================


STREAM_FILES = 8
STREAM_FILES_PER_TRIGGER = 3


# Which record of a new audience comes first depends on the order in which files
# arrive, so its rows are compared as NEW, with the number of creations (one).
STREAM_COLUMNS = [c for c in PLAN_COLUMNS if c != "action"]


@register("stream_activation", PLAN_WITH + "SELECT " + ", ".join(STREAM_COLUMNS) + (
    ", CASE WHEN profile = 'file' AND audience_id IS NULL THEN 'NEW' ELSE action END AS action, "
    "CAST(CASE WHEN profile = 'file' AND audience_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_creates "
    "FROM plan WHERE reason IS NULL"))
def q_stream_activation(spark, sf_dir):
    """T1+T6: new queue files → outbox, once per object even when redelivered.

    All notifications are delivered, then every one is delivered a second
    time in later files (an at-least-once queue redelivering); the stream
    runs to completion (availableNow) in several micro-batches and the
    outbox is read back.
    """
    base = scratch_path(spark, "stream")
    src = f"{base}/queue"
    recs = notifications_frame(spark, sf_dir)
    queue_records(recs.repartitionByRange(STREAM_FILES, "event_time").sortWithinPartitions("event_time")).write.json(src)
    queue_records(recs.repartitionByRange(STREAM_FILES // 2, "event_time")).write.mode("append").json(src)
    q = start_activation_stream(spark, src, audiences(spark, sf_dir), segments(spark, sf_dir),
                                f"{base}/out", f"{base}/checkpoint",
                                max_files_per_trigger=STREAM_FILES_PER_TRIGGER, rule=RULE)
    q.awaitTermination()
    out = read_outbox(spark, f"{base}/out")
    creates = (out.where(F.col("action") == "CREATE").groupBy("audience")
               .agg(F.count(F.lit(1)).alias("n")))
    new = (F.col("profile") == "file") & F.col("audience_id").isNull()
    return out.join(creates, "audience", "left").select(
        *STREAM_COLUMNS, F.when(new, F.lit("NEW")).otherwise(F.col("action")).alias("action"),
        F.when(new, F.coalesce("n", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")).alias("n_creates"))


# ===========================================================================
# End to end, batch profile: transform → written parts → records → delivery
# ===========================================================================

DELIVERY_SEGMENT = "Audience 7"


def _delivery(spark: SparkSession, sf_dir: str):
    spec = replace(BATCH_SPEC, segment_name=DELIVERY_SEGMENT)
    rows, n_parts = transform_with_parts(audience_scan(spark, sf_dir, spec), spec,
                                         cap_rows=SMALL_ROW_CAP)
    base = scratch_path(spark, "delivery")
    write_output(rows, base, "batch", DELIVERY_SEGMENT, num_parts=n_parts)
    plan = A.plan_activation(_records_for(spark, base, "*.gz"), audiences(spark, sf_dir),
                             segments(spark, sf_dir))
    # the outbox is a table in its own right: materialise it once (one row per file)
    adds = A.outbox(plan).where(F.col("action") == "ADD_USERS").checkpoint(eager=True)
    # batch form: scan the output folder and join on key (no key list on the driver)
    requests = PL.delivery_requests(adds, scan_hash_files(spark, base))
    return adds, requests


def _chunk_of(key: str = "key"):
    return F.regexp_extract(F.col(key), r"chunk=([0-9]+)", 1).cast("long")


DELIVERY_SQL = (
    f"WITH t AS ({O.batch_split_sql(SMALL_ROW_CAP, segment=DELIVERY_SEGMENT)}), "
    + SEG_CTE + ", seg AS (SELECT segment_id FROM sl WHERE name = '" + DELIVERY_SEGMENT + "'), "
    "g AS (SELECT segment_name, chunk, schema, "
    f"{SEND_ORDER_SQL} AS send_order, count(*) AS n_users, "
    "concat('{\"users\":[{\"schema\":[\"', schema, '\"],\"data\":[', "
    "string_agg(concat('[\"', hash, '\"]'), ',' ORDER BY row_id), ']}]}') AS payload "
    f"FROM t WHERE {SEND_ORDER_SQL} IS NOT NULL GROUP BY segment_name, chunk, schema) ")


@register("batch_delivery", DELIVERY_SQL + (
    "SELECT segment_name AS audience, (SELECT segment_id FROM seg) AS segment_id, chunk, "
    "send_order, schema, n_users, sha256(payload) AS payload_sha256 FROM g"))
def q_batch_delivery(spark, sf_dir):
    """S3+A1+A3 end to end: the files a record names are read and grouped by
    schema into one request each (the batch handler)."""
    _, req = _delivery(spark, sf_dir)
    return req.select("audience", "segment_id", _chunk_of().alias("chunk"), "send_order",
                      "schema", "n_users", sha256_hex(F.col("payload")).alias("payload_sha256"))


@register("delivery_status", DELIVERY_SQL + (
    "SELECT segment_name AS audience, chunk, count(*) AS n_requests, "
    "CAST(sum(n_users) AS BIGINT) AS n_users, "
    "format('{} users in {} requests', sum(n_users), count(*)) AS response "
    "FROM g GROUP BY segment_name, chunk"))
def q_delivery_status(spark, sf_dir):
    """A2+A4+T5 end to end: one response line per delivered file."""
    adds, req = _delivery(spark, sf_dir)
    st = PL.delivery_status(adds, req)
    return st.select("audience", _chunk_of().alias("chunk"), "n_requests", "n_users", "response")


def _created_records(spark: SparkSession, base: str, glob: str) -> DataFrame:
    """Flat object-created notifications for every file written below ``base``
    (keys URL-encoded as the store sends them: space as '+')."""
    listing = D.file_manifest(spark, base, glob)
    return listing.select(
        F.md5("key").alias("message_id"),
        F.current_timestamp().alias("event_time"),
        F.lit(A.BUCKET_PREFIX + "-demo").alias("bucket"),
        F.lit(A.EVENT_DETAIL_TYPE).alias("detail_type"), F.lit(A.EVENT_SOURCE).alias("source"),
        "size", F.regexp_replace("key", " ", "+").alias("object_key"))


def _records_for(spark: SparkSession, base: str, glob: str) -> DataFrame:
    """Parsed queue records for every file written below ``base``."""
    return A.parse_records(queue_records(_created_records(spark, base, glob)))


@register("file_delivery", (
    f"WITH t AS ({O.file_split_sql(SMALL_BYTE_CAP // HASH_LINE_BYTES, segment=DELIVERY_SEGMENT)}), "
    + AUD_CTE + ", aud AS (SELECT audience_id FROM al WHERE name = '" + DELIVERY_SEGMENT + "') "
    "SELECT segment_name AS audience, (SELECT audience_id FROM aud) AS audience_id, "
    "CASE WHEN (SELECT audience_id FROM aud) IS NULL THEN 'CREATE' ELSE 'APPEND' END AS action, "
    "upper(schema) AS calculate_type, chunk, CAST(sum(strlen(hash) + 1) AS BIGINT) AS size, "
    "md5(string_agg(concat(hash, chr(10)), '' ORDER BY row_id)) AS file_signature "
    "FROM t GROUP BY segment_name, schema, chunk"))
def q_file_delivery(spark, sf_dir):
    """T7+J1+J3 end to end, file profile: each written part becomes a record,
    is routed and resolved (APPEND / CREATE), and its bytes are signed (md5)."""
    spec = replace(FILE_SPEC, segment_name=DELIVERY_SEGMENT)
    rows, n_parts = transform_with_parts(audience_scan(spark, sf_dir, spec), spec,
                                         cap_rows=SMALL_BYTE_CAP // HASH_LINE_BYTES)
    base = scratch_path(spark, "delivery")
    write_output(rows, base, "file", DELIVERY_SEGMENT, num_parts=n_parts)
    plan = A.plan_activation(_records_for(spark, base, "*.csv"), audiences(spark, sf_dir),
                             segments(spark, sf_dir))
    sent = A.outbox(plan)
    # batch form: sign every file below the folder, join on key (one row per file)
    sig = (D.file_signatures(spark, f"{base}/output/file", "*.csv", recursive=True)
           .select(relative_key(F.col("path"), base).alias("key"), "file_signature"))
    out = sent.join(sig, "key")
    return out.select("audience", "audience_id", "action", "calculate_type",
                      _chunk_of().alias("chunk"), "size", "file_signature")


@register("stream_delivery", DELIVERY_SQL + (
    "SELECT segment_name AS audience, (SELECT segment_id FROM seg) AS segment_id, chunk, "
    "send_order, schema, n_users, sha256(payload) AS payload_sha256 FROM g"))
def q_stream_delivery(spark, sf_dir):
    """T1+A3 end to end in the stream: written parts raise records, the stream
    routes them, reads the named files and writes one request per file and
    schema to the ``payload`` table (read back here)."""
    spec = replace(BATCH_SPEC, segment_name=DELIVERY_SEGMENT)
    rows, n_parts = transform_with_parts(audience_scan(spark, sf_dir, spec), spec,
                                         cap_rows=SMALL_ROW_CAP)
    base = scratch_path(spark, "stream_delivery")
    files_root = f"{base}/bucket"
    write_output(rows, files_root, "batch", DELIVERY_SEGMENT, num_parts=n_parts)
    # as many queue files, and so micro-batches, whatever the number of parts
    queue_records(_created_records(spark, files_root, "*.gz")).repartition(STREAM_FILES).write.json(f"{base}/queue")
    q = start_activation_stream(spark, f"{base}/queue", audiences(spark, sf_dir),
                                segments(spark, sf_dir), f"{base}/out", f"{base}/checkpoint",
                                max_files_per_trigger=STREAM_FILES_PER_TRIGGER,
                                files_root=files_root)
    q.awaitTermination()
    req = read_payloads(spark, f"{base}/out")
    return req.select("audience", "segment_id", _chunk_of().alias("chunk"), "send_order",
                      "schema", "n_users", sha256_hex(F.col("payload")).alias("payload_sha256"))


# the queries on keyed state and changes register themselves
from . import registry_state  # noqa: E402,F401
