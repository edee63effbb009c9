"""Batch-profile delivery tables: per-file schema groups, request payloads and
parsed responses.

A payload covers one (segment, file, schema) group; a file is one output
part, so a group never holds more than the row cap (100,000) and
``collect_list`` stays bounded per task.  Hashes are ordered by ``row_id``
inside the payload, so the text is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import split_hash_list
from .activation import SCHEMA_OPTIONS

# --- fixed values: delivery responses ----------------------------------------
NO_SCHEMAS = "no schemas were found"
DELIVERED = "%d users in %d requests"
# ---------------------------------------------------------------------------


def hash_lists(df: DataFrame) -> DataFrame:
    """each hash cell as a list (cells may join several hashes by ', ')."""
    return df.withColumn("hash_list", split_hash_list(F.col("hash")))


def schema_send_order() -> F.Column:
    """1-based position of ``schema`` in the destination's send order, else null."""
    expr = F.lit(None).cast("int")
    for i, s in reversed(list(enumerate(SCHEMA_OPTIONS, start=1))):
        expr = F.when(F.col("schema") == s, F.lit(i)).otherwise(expr)
    return expr


def supported_schemas(parts: DataFrame) -> DataFrame:
    """P10+A2: rows per supported schema in each file, in send order.

    Every supported schema is listed for every file, absent ones with
    ``n_rows = 0``: per file the schema counts are gathered into a map (at
    most a handful of entries) and the option list is exploded against it,
    in one pipeline, with no file × option cross product.
    """
    counts = (parts.groupBy("segment_name", "chunk", "schema")
              .agg(F.count(F.lit(1)).alias("n_rows")))
    per_file = counts.groupBy("segment_name", "chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("schema", "n_rows"))).alias("m"))
    options = F.array(*[F.struct(F.lit(i).alias("send_order"), F.lit(s).alias("schema"))
                        for i, s in enumerate(SCHEMA_OPTIONS, start=1)])
    return (per_file.select("segment_name", "chunk", "m", F.inline(options))
            .select("segment_name", "chunk", "send_order", "schema",
                    F.coalesce(F.col("m")[F.col("schema")], F.lit(0).cast("long"))
                    .alias("n_rows")))


def payloads(parts: DataFrame) -> DataFrame:
    """A3+F16: one JSON request body per (segment, file, supported schema)."""
    grouped = (parts.withColumn("send_order", schema_send_order())
               .where(F.col("send_order").isNotNull())
               .groupBy("segment_name", "chunk", "send_order", "schema")
               .agg(F.sort_array(F.collect_list(F.struct("row_id", "hash"))).alias("items")))
    data = F.transform("items", lambda x: split_hash_list(x["hash"]))
    body = F.to_json(F.struct(F.array(F.struct(
        F.array(F.col("schema")).alias("schema"), data.alias("data"))).alias("users")))
    return grouped.select("segment_name", "chunk", "send_order", "schema",
                          F.size("items").cast("long").alias("n_users"),
                          body.alias("payload"))


RESPONSE_SCHEMA = T.StructType([
    T.StructField("request_status", T.StringType()),
    T.StructField("users", T.ArrayType(T.StructType([
        T.StructField("sub_request_status", T.StringType()),
        T.StructField("user", T.StructType([
            T.StructField("number_uploaded_users", T.LongType())])),
    ]))),
])


def uploaded_users(responses: DataFrame, body_col: str = "response") -> DataFrame:
    """A4: uploaded-user count from each response body (null when absent)."""
    r = F.from_json(F.col(body_col), RESPONSE_SCHEMA)
    first = F.try_element_at(r["users"], F.lit(1))
    return responses.withColumn("number_uploaded_users", first["user"]["number_uploaded_users"])


def delivery_requests(adds: DataFrame, hash_rows: DataFrame) -> DataFrame:
    """Batch-profile delivery: one request per (file, supported schema).

    ``adds``: outbox rows with action ADD_USERS (``key``, ``audience``,
    ``segment_id``), bounded by the micro-batch; ``hash_rows``: the rows of
    the files those records name (``key``, ``row_id``, ``schema``, ``hash``).
    Each request is bounded by the part cap, as the file is.
    """
    rows = hash_rows.join(adds.select("key", "audience", "segment_id"), "key")
    grouped = (rows.withColumn("send_order", schema_send_order())
               .where(F.col("send_order").isNotNull())
               .groupBy("key", "audience", "segment_id", "send_order", "schema")
               .agg(F.sort_array(F.collect_list(F.struct("row_id", "hash"))).alias("items")))
    data = F.transform("items", lambda x: split_hash_list(x["hash"]))
    body = F.to_json(F.struct(F.array(F.struct(
        F.array(F.col("schema")).alias("schema"), data.alias("data"))).alias("users")))
    return grouped.select("key", "audience", "segment_id", "send_order", "schema",
                          F.size("items").cast("long").alias("n_users"), body.alias("payload"))


def delivery_status(adds: DataFrame, requests: DataFrame) -> DataFrame:
    """One status per ADD_USERS record: requests made, or no supported schema."""
    per_file = requests.groupBy("key").agg(F.count(F.lit(1)).alias("n_requests"),
                                           F.sum("n_users").alias("n_users"))
    out = adds.select("message_id", "key", "audience").join(per_file, "key", "left")
    return out.select(
        "message_id", "key", "audience",
        F.coalesce("n_requests", F.lit(0).cast("long")).alias("n_requests"),
        F.coalesce("n_users", F.lit(0).cast("long")).alias("n_users"),
        F.when(F.col("n_requests").isNull(), F.lit(NO_SCHEMAS))
        .otherwise(F.format_string(DELIVERED, F.col("n_users"),
                                   F.col("n_requests"))).alias("response"))


# --- file profile: form and bodies of the destination's requests --------------------

UPLOAD_RESPONSE_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("code", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("data", T.StructType([T.StructField("file_path", T.StringType())])),
])


def upload_forms(sent: DataFrame, advertiser_id: str) -> DataFrame:
    """The form that goes with each file: ``sent(message_id, key, calculate_type, file_signature)``."""
    return sent.select("message_id", "key", F.to_json(F.struct(
        F.lit(advertiser_id).alias("advertiser_id"), F.trim("file_signature").alias("file_signature"),
        "calculate_type")).alias("form"))


def uploaded_paths(docs: DataFrame) -> DataFrame:
    """Landed upload responses (JSON in ``value``) → request_id, code, error, file_path."""
    d = docs.select(F.from_json("value", UPLOAD_RESPONSE_SCHEMA).alias("d")).select("d.*")
    return d.where("request_id is not null and code is not null").select(
        "request_id", "code", F.col("message").alias("error"), F.col("data.file_path").alias("file_path"))


def audience_bodies(sent: DataFrame, uploaded: DataFrame, advertiser_id: str) -> DataFrame:
    """The request that follows an accepted upload: message_id, action, body.

    CREATE names the audience and its identifier type, APPEND the audience's id.  A file whose upload was
    refused or has not been answered, and an APPEND whose audience has no id yet, have no body.
    """
    paths = uploaded.where("code = 0 and file_path is not null").select("request_id", "file_path")
    own = sent.where("profile = 'file'").join(paths, F.col("message_id") == F.col("request_id"))
    common = [F.lit(advertiser_id).alias("advertiser_id"), F.array("file_path").alias("file_paths")]
    body = (F.when(F.col("action") == "CREATE", F.to_json(F.struct(
                *common, F.col("audience").alias("custom_audience_name"), "calculate_type")))
            .when(F.col("audience_id").isNotNull(), F.to_json(F.struct(
                F.lit("APPEND").alias("action"), *common, F.col("audience_id").alias("custom_audience_id")))))
    return own.select("message_id", "action", body.alias("body")).where("body is not null")
