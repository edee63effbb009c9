"""Inputs derived from the driver tables, written once per session.

The driver tables hold no contact data, activation events or catalogues,
so these are derived from them with plain SQL expressions that both Spark
and DuckDB evaluate identically (the oracle SQL reuses the same text).
Every derived table grows with its source table.

* ``contacts``       ← customer: an audience upload (JSON lines / CSV)
* ``notifications``  ← events:   object-created records under ``output/``
* ``audience pages`` ← supplier: destination audience catalogue, 100 per page
* ``segment pages``  ← part:     destination segment catalogue
* ``job runs``       ← orders:   transform run history with an argument map
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.activation import BUCKET_PREFIX, EVENT_DETAIL_TYPE, EVENT_SOURCE
from ..session import scratch_path

IDEOGRAPHIC_SPACE = "\u3000"
NO_BREAK_SPACE = "\u00a0"
TAB = "\t"


def contacts_exprs(q: str) -> list[str]:
    """Column expressions over ``customer``; ``q`` quotes identifiers."""
    email = f"{q}e-mail{q}"
    return [
        "c_custkey AS contact_id",
        "CAST(18 + c_custkey % 60 AS BIGINT) AS age",
        ("CASE c_custkey % 10 WHEN 3 THEN NULL "
         f"WHEN 1 THEN concat('{IDEOGRAPHIC_SPACE}', replace(c_name, '#', '.'), '@Example.com', '{NO_BREAK_SPACE}') "
         "WHEN 9 THEN concat(' ', lower(replace(c_name, '#', '_')), '@example.org ') "
         f"ELSE concat('  ', replace(c_name, '#', '.'), '@Example.com ') END AS {email}"),
        ("CASE c_custkey % 10 WHEN 5 THEN 'n/a' WHEN 8 THEN NULL "
         "WHEN 6 THEN concat('+', CAST(c_nationkey AS STRING), ' 555 ', lpad(CAST(c_custkey AS STRING), 7, '0')) "
         "ELSE concat('(0', CAST(200 + c_nationkey AS STRING), ')-', lpad(CAST(c_custkey AS STRING), 7, '0')) "
         "END AS phone_number"),
        ("CASE c_custkey % 10 WHEN 7 THEN NULL "
         f"WHEN 2 THEN concat(' ', upper(md5(c_name)), '{TAB}') "
         "WHEN 4 THEN '' "
         "ELSE concat(' ', upper(md5(c_name)), ' ') END AS mobile_advertiser_id"),
        "lower(c_mktsegment) AS segment",
        "c_name AS full_name",
    ]


CONTACT_COLUMNS = ["contact_id", "age", "e-mail", "phone_number", "mobile_advertiser_id",
                   "segment", "full_name"]


def contacts_sql() -> str:
    """DuckDB text of the contacts table (for oracle queries)."""
    return "SELECT " + ", ".join(contacts_exprs('"')) + " FROM customer"


def contacts_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = spark.read.parquet(os.path.join(sf_dir, "customer.parquet"))
    return cust.selectExpr(*contacts_exprs("`"))


_lock = threading.Lock()
_written: dict[tuple, str] = {}


def _once(spark: SparkSession, key: tuple, build) -> str:
    """Write a derived table once per (session, key) and return its path."""
    full = (spark.sparkContext.applicationId,) + key
    with _lock:
        if full not in _written:
            _written[full] = build()
        return _written[full]


def contacts_jsonl(spark: SparkSession, sf_dir: str) -> str:
    """Contacts as JSON lines, files in ``contact_id`` order (nulls omitted)."""
    def build() -> str:
        path = scratch_path(spark, "derived", "contacts_jsonl")
        contacts_frame(spark, sf_dir).orderBy("contact_id").write.json(path)
        return path
    return _once(spark, ("contacts_jsonl", sf_dir), build)


def contacts_csv(spark: SparkSession, sf_dir: str) -> str:
    """Contacts as CSV with header, files in ``contact_id`` order."""
    def build() -> str:
        path = scratch_path(spark, "derived", "contacts_csv")
        (contacts_frame(spark, sf_dir).orderBy("contact_id").write
         .option("header", "true").csv(path))
        return path
    return _once(spark, ("contacts_csv", sf_dir), build)


# --- activation inputs -------------------------------------------------------

# Each events row becomes one object-created notification.  Profile, audience,
# identifier directory and file suffix come from the row's own fields; a few
# rows land outside the pattern (other bucket, deleted object, temp prefix),
# some keys are too short, some types or suffixes unsupported.
NOTIFICATION_BASE = [
    # queues send ids that are text
    "concat(substring(md5(CAST(event_id AS STRING)), 1, 8), '-', CAST(event_id AS STRING)) AS message_id",
    "CAST(ts AS TIMESTAMP) AS event_time",
    f"CASE WHEN user_id % 7 = 0 THEN 'scratch-artifacts' ELSE '{BUCKET_PREFIX}-demo' END AS bucket",
    f"CASE WHEN event_type = 'error' AND value < 10 THEN 'Object Deleted' ELSE '{EVENT_DETAIL_TYPE}' END AS detail_type",
    f"'{EVENT_SOURCE}' AS source",
    "CASE WHEN user_id % 2 = 0 THEN 'file' ELSE 'batch' END AS profile",
    "concat('Audience ', regexp_extract(props, '[0-9]+', 0)) AS audience",
    ("CASE event_type WHEN 'click' THEN 'email_sha256' WHEN 'view' THEN 'PHONE_SHA256' "
     "WHEN 'purchase' THEN 'gaid_sha256' WHEN 'signup' THEN 'Idfa_Sha256' ELSE 'type_3' END AS type_dir"),
    "concat('part-', lpad(CAST(event_id AS STRING), 8, '0')) AS stem",
    "value",
    "CAST(round(value * 1000) AS BIGINT) AS size",
    "CASE WHEN user_id % 11 = 5 THEN '210987654321' ELSE '123456789012' END AS account",
    "CASE WHEN user_id % 13 = 4 THEN 'eu-west-1' ELSE 'us-east-1' END AS region",
    # some bodies arrive cut off
    "event_id % 61 = 7 AS broken",
]
NOTIFICATION_KEYS = [
    "message_id", "event_time", "bucket", "detail_type", "source", "size", "account", "region", "broken",
    ("CASE WHEN value > 150 THEN concat('transform_tmp/', type_dir, '/', stem, '.csv') "
     "WHEN value < 1 THEN concat('output/', stem, '.csv') "
     "WHEN profile = 'file' THEN concat('output/file/', replace(audience, ' ', '+'), '/', type_dir, '/', stem, '.csv') "
     "ELSE concat('output/batch/', replace(audience, ' ', '+'), '/', stem, "
     "CASE WHEN value < 20 THEN '.csv' ELSE '.csv.gz' END) END AS object_key"),
]


def notifications_sql() -> str:
    """DuckDB text of the flat notifications table, as a reader of the queue sees it."""
    inner = "SELECT " + ", ".join(NOTIFICATION_BASE) + " FROM events"
    flat = "SELECT " + ", ".join(NOTIFICATION_KEYS) + f" FROM ({inner}) nb"
    seen = [f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in
            ("bucket", "detail_type", "source", "size", "account", "region", "object_key")]
    return f"SELECT message_id, event_time, {', '.join(seen)} FROM ({flat}) nk"


def notifications_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    return ev.selectExpr(*NOTIFICATION_BASE).selectExpr(*NOTIFICATION_KEYS)


def queue_records(flat: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wrap flat notifications as queue records: ``messageId`` + JSON ``body``, and the columns named in ``keep``."""
    body = F.struct(
        F.lit("0").alias("version"),
        F.col("message_id").alias("id"),
        F.col("detail_type").alias("detail-type"),
        F.col("source").alias("source"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        *[F.col(c) for c in ("account", "region") if c in flat.columns],
        F.struct(F.struct(F.col("bucket").alias("name")).alias("bucket"),
                 F.struct(F.col("object_key").alias("key"), F.col("size").alias("size"),
                          F.md5(F.concat_ws("/", "object_key", "message_id")).alias("etag"))
                 .alias("object")).alias("detail"),
    )
    text = F.to_json(body)
    if "broken" in flat.columns:
        # ends in the middle of the document
        text = F.when(F.col("broken"), F.concat(F.lit("{"), F.col("message_id"))).otherwise(text)
    return flat.select(F.col("message_id").alias("messageId"), text.alias("body"), *keep)


def queue_dir(spark: SparkSession, sf_dir: str) -> str:
    """Queue records as JSON-lines files (several files, ordered by id)."""
    def build() -> str:
        path = scratch_path(spark, "derived", "queue")
        (queue_records(notifications_frame(spark, sf_dir).repartitionByRange("event_time")
                       .sortWithinPartitions("event_time")).write.json(path))
        return path
    return _once(spark, ("queue", sf_dir), build)


# Destination audience catalogue (file profile), one row per supplier; names
# repeat at larger scale, so "first listed wins" matters.
AUDIENCE_CATALOGUE = [
    "concat('Audience ', CAST((s_suppkey * 7) % 160 AS STRING)) AS name",
    "CAST(7000000 + s_suppkey AS STRING) AS audience_id",
    "CAST(floor(s_suppkey / 100) AS BIGINT) + 1 AS page",
    "CAST(s_suppkey % 100 AS BIGINT) AS position",
]
CATALOGUE_PAGE_SIZE = 100


def audience_catalogue_sql() -> str:
    return "SELECT " + ", ".join(AUDIENCE_CATALOGUE) + " FROM supplier"


def audience_pages_dir(spark: SparkSession, sf_dir: str) -> str:
    """Catalogue as landed list responses: one JSON document per page."""
    def build() -> str:
        sup = spark.read.parquet(os.path.join(sf_dir, "supplier.parquet"))
        rows = sup.selectExpr(*AUDIENCE_CATALOGUE)
        pages = rows.groupBy("page").agg(
            F.sort_array(F.collect_list(F.struct("position", "name", "audience_id"))).alias("items"))
        total_page = rows.agg(F.max("page")).first()[0] or 0
        doc = pages.select(F.to_json(F.struct(
            F.lit(0).alias("code"), F.lit("OK").alias("message"),
            F.struct(
                F.transform("items", lambda x: F.struct(x["name"].alias("name"),
                                                        x["audience_id"].alias("audience_id")))
                .alias("list"),
                F.struct(F.col("page").alias("page"),
                         F.lit(CATALOGUE_PAGE_SIZE).alias("page_size"),
                         F.lit(total_page).cast("long").alias("total_page"))
                .alias("page_info")).alias("data"))).alias("value"))
        path = scratch_path(spark, "derived", "audience_pages")
        doc.write.text(path)
        return path
    return _once(spark, ("audience_pages", sf_dir), build)


# Destination segment catalogue (batch profile), one row per part.
SEGMENT_CATALOGUE = [
    "concat('Audience ', CAST((p_partkey * 11) % 170 AS STRING)) AS name",
    "CAST(900000 + p_partkey AS STRING) AS id",
    "CAST(floor(p_partkey / 1000) AS BIGINT) AS page",
    "CAST(p_partkey % 1000 AS BIGINT) AS position",
]


def segment_catalogue_sql() -> str:
    return "SELECT " + ", ".join(SEGMENT_CATALOGUE) + " FROM part"


def segment_pages_dir(spark: SparkSession, sf_dir: str) -> str:
    """Segment look-up responses, at most 1,000 segments per document."""
    def build() -> str:
        part = spark.read.parquet(os.path.join(sf_dir, "part.parquet"))
        rows = part.selectExpr(*SEGMENT_CATALOGUE)
        docs = rows.groupBy("page").agg(F.sort_array(F.collect_list(
            F.struct("position", "name", "id"))).alias("items"))
        doc = docs.select(F.to_json(F.struct(
            F.lit("SUCCESS").alias("request_status"),
            # a first response may come without page information
            F.when(F.col("page") > 0, F.col("page")).alias("page"),
            F.transform("items", lambda x: F.struct(
                F.lit("SUCCESS").alias("sub_request_status"),
                F.struct(x["id"].alias("id"), x["name"].alias("name")).alias("segment")))
            .alias("segments"))).alias("value"))
        path = scratch_path(spark, "derived", "segment_pages")
        doc.write.text(path)
        return path
    return _once(spark, ("segment_pages", sf_dir), build)


# Transform run history, one run per order.
JOB_RUNS = [
    "concat('jr_', lpad(CAST(o_orderkey AS STRING), 10, '0')) AS Id",
    "o_orderdate AS StartedOn",
    ("CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END "
     "AS JobRunState"),
    "CAST(floor(o_totalprice / 100) AS BIGINT) AS ExecutionTime",
    "o_orderpriority <> '5-LOW' AS has_arguments",
    "concat('Audience ', CAST(o_custkey % 100 AS STRING)) AS segment_arg",
    "concat('uploads/', CAST(o_orderkey AS STRING), '.json') AS source_key_arg",
]


def job_runs_sql() -> str:
    return "SELECT " + ", ".join(JOB_RUNS) + " FROM orders"


def job_runs_dir(spark: SparkSession, sf_dir: str) -> str:
    """Run history as landed JSON: ``Arguments`` map present only on some runs."""
    def build() -> str:
        orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet"))
        runs = orders.selectExpr(*JOB_RUNS)
        args = F.when(F.col("has_arguments"), F.create_map(
            F.lit("--segment_name"), F.col("segment_arg"),
            F.lit("--source_key"), F.col("source_key_arg"),
            F.lit("--pii_fields"), F.lit('[{"column_name":"e-mail","pii_type":"EMAIL"}]')))
        out = runs.select("Id", F.date_format("StartedOn", "yyyy-MM-dd'T'HH:mm:ss").alias("StartedOn"),
                          "JobRunState", "ExecutionTime", args.alias("Arguments"))
        path = scratch_path(spark, "derived", "job_runs")
        out.write.json(path)
        return path
    return _once(spark, ("job_runs", sf_dir), build)
