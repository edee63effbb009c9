"""Activation: route each object-created record to its audience and decide
what to send, as stateless DataFrame operations (usable in batch and inside
a streaming ``foreachBatch``).

Per-record isolation: nothing raises on a bad record; every check yields a
``reason`` column instead, and records with a reason go to the dead-letter
table while the rest go to the outbox.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import base_name, decode_key, dir_part
from .lookup import sized_lookup

# --- fixed values: event pattern, supported identifier types ----------------
EVENT_SOURCE = "aws.s3"
EVENT_DETAIL_TYPE = "Object Created"
BUCKET_PREFIX = "uploader-etl-artifacts"
KEY_PREFIX = "output/"
# Identifier types the file-profile destination accepts (case-insensitive).
CALCULATE_TYPES = ("PHONE_SHA256", "EMAIL_SHA256", "GAID_SHA256", "IDFA_SHA256")
# Schemas the batch-profile destination accepts, in the order they are sent.
SCHEMA_OPTIONS = ("EMAIL_SHA256", "MOBILE_AD_ID_SHA256", "PHONE_SHA256")
BATCH_SUFFIX = ".gz"
# A plan's look-up of more names is joined by a shuffle of the records.
MAX_LOOKUP_NAMES = 200_000
# Status messages per record.
MSG_UPDATED = "Audience %s is successfully updated"
MSG_CREATED = "Audience %s is successfully created"
MSG_SENT = "Users sent to segment %s"
MSG_ERROR = "ERROR %s for key %s"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EventRule:
    """Which notifications concern the product; account and region are checked only when given."""

    source: str = EVENT_SOURCE
    detail_type: str = EVENT_DETAIL_TYPE
    bucket_prefix: str = BUCKET_PREFIX
    key_prefix: str = KEY_PREFIX
    account: str | None = None
    region: str | None = None

    def fits(self) -> Column:
        """True or false for each parsed record, never null."""
        cond = ((F.col("source") == self.source) & (F.col("detail_type") == self.detail_type)
                & F.col("bucket").startswith(self.bucket_prefix)
                & F.col("object_key").startswith(self.key_prefix))
        for name, value in (("account", self.account), ("region", self.region)):
            if value is not None:
                cond = cond & (F.col(name) == value)
        return F.coalesce(cond, F.lit(False))


QUEUE_SCHEMA = T.StructType([
    T.StructField("messageId", T.StringType()),
    T.StructField("body", T.StringType()),
])

BODY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("detail-type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("account", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("detail", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([
            T.StructField("key", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("etag", T.StringType()),
        ])),
    ])),
])


def parse_records(queue: DataFrame, with_time: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Queue records → flat notification columns, and the columns of ``queue`` named in ``keep``.

    ``malformed`` marks a body that is no notification (no JSON, or without
    source, type, bucket or key); its other columns may be null.

    The body is parsed inside ``inline_outer`` of a one-element array: a
    Generate is a boundary filters are not pushed through, so the event
    filter that follows reads the parsed columns and each body is parsed
    once (a plain projection would be re-parsed inside the pushed filter).
    """
    parsed = F.from_json("body", BODY_SCHEMA, {"mode": "PERMISSIVE"})
    # an id is text: queues send UUIDs
    flat = queue.select(F.col("messageId").alias("message_id"), *keep, F.inline_outer(F.array(parsed)))
    cols = [
        "message_id",
        F.col("source").alias("source"),
        F.col("`detail-type`").alias("detail_type"),
        F.col("detail.bucket.name").alias("bucket"),
        F.col("detail.object.key").alias("object_key"),
        F.col("detail.object.size").alias("size"),
        "account", "region",
        F.col("detail.object.etag").alias("etag"),
        *keep,
    ]
    if with_time:
        cols.append(F.to_timestamp("time").alias("event_time"))
    out = flat.select(*cols)
    needed = ("source", "detail_type", "bucket", "object_key")
    lacking = F.col(needed[0]).isNull()
    for c in needed[1:]:
        lacking = lacking | F.col(c).isNull()
    return out.withColumn("malformed", lacking)


def event_filter(df: DataFrame, rule: EventRule = EventRule()) -> DataFrame:
    """The rule in front of the queue: created objects under ``output/``."""
    return df.where(rule.fits())


def route_key(df: DataFrame) -> DataFrame:
    """Decode the key and split it into profile, audience, type dir, file name."""
    key = decode_key(F.col("object_key"))
    return (df.withColumn("key", key)
              .withColumn("file_name", base_name(F.col("key")))
              .withColumn("profile", dir_part(F.col("key"), 1))
              .withColumn("audience", dir_part(F.col("key"), 2))
              # a Hive-style directory (``schema=EMAIL_SHA256``) names its value
              .withColumn("type_dir", F.regexp_replace(dir_part(F.col("key"), 3),
                                                       "^[^=/]*=", "")))


def calculate_type(type_dir: Column) -> Column:
    """Upper-cased identifier type when supported, else null."""
    up = F.upper(type_dir)
    return F.when(up.isin(*CALCULATE_TYPES), up)


def supported_file(file_name: Column) -> Column:
    return file_name.endswith(BATCH_SUFFIX)


def route_reasons(df: DataFrame) -> DataFrame:
    """Per-record checks; ``reason`` is null for a routable record."""
    is_file = F.col("profile") == "file"
    ctype = F.when(is_file, calculate_type(F.col("type_dir")))
    reason = (F.when(F.col("malformed"), F.lit("BAD_BODY"))
              .when(F.col("key").isNull(), F.lit("UNDECODABLE_KEY"))
              .when(F.col("audience").isNull() | (F.col("audience") == ""), F.lit("BAD_KEY"))
              .when(~F.col("profile").isin("file", "batch"), F.lit("UNKNOWN_PROFILE"))
              .when(is_file & F.col("type_dir").isNull(), F.lit("BAD_KEY"))
              .when(is_file & ctype.isNull(), F.lit("UNSUPPORTED_TYPE"))
              .when(~is_file & ~supported_file(F.col("file_name")), F.lit("UNSUPPORTED_FILE")))
    return df.withColumn("calculate_type", ctype).withColumn("reason", reason)


# --- catalogues -------------------------------------------------------------

AUDIENCE_PAGE_SCHEMA = T.StructType([
    T.StructField("code", T.LongType()),
    T.StructField("data", T.StructType([
        T.StructField("list", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("audience_id", T.StringType())]))),
        T.StructField("page_info", T.StructType([
            T.StructField("page", T.LongType()),
            T.StructField("total_page", T.LongType())])),
    ])),
])

SEGMENT_PAGE_SCHEMA = T.StructType([
    T.StructField("request_status", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("segments", T.ArrayType(T.StructType([
        T.StructField("sub_request_status", T.StringType()),
        T.StructField("segment", T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("name", T.StringType())])),
    ]))),
])


def audience_catalogue(pages: DataFrame) -> DataFrame:
    """List responses (one JSON doc per page) → (name, audience_id, page, position).

    Ids are text (a destination may quote them); a response without page
    information is the first page.
    """
    doc = pages.select(F.from_json("value", AUDIENCE_PAGE_SCHEMA).alias("d"))
    return (doc.where(F.col("d.code") == 0)
            .select(F.coalesce("d.data.page_info.page", F.lit(0).cast("long")).alias("page"),
                    F.posexplode_outer("d.data.list").alias("position", "item"))
            .where(F.col("item").isNotNull())
            .select(F.col("item.name").alias("name"),
                    F.col("item.audience_id").alias("audience_id"),
                    "page", F.col("position").cast("long").alias("position")))


def catalogue_pages(pages: DataFrame) -> DataFrame:
    """Is the catalogue whole?  (page, status, n_documents, n_items) for every page that there should be.

    The responses name the number of pages; ``missing`` ones were never answered with code 0, ``repeated``
    ones several times, ``unexpected`` ones lie beyond that number.  All others are ``complete``.
    """
    doc = pages.select(F.from_json("value", AUDIENCE_PAGE_SCHEMA).alias("d")).where(F.col("d.code") == 0)
    seen = (doc.select(F.coalesce("d.data.page_info.page", F.lit(0).cast("long")).alias("page"),
                       F.coalesce(F.size("d.data.list"), F.lit(0)).cast("long").alias("n"),
                       F.col("d.data.page_info.total_page").alias("total"))
            .groupBy("page").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n").alias("n_items"),
                                 F.max("total").alias("total")))
    last = seen.agg(F.max("total").alias("last"))
    expected = last.where("last > 0").select(F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("page"))
    both = expected.withColumn("wanted", F.lit(True)).join(seen, "page", "full_outer")
    status = (F.when(F.col("n_documents").isNull(), F.lit("missing"))
              .when(F.col("wanted").isNull() & (F.col("page") > 0), F.lit("unexpected"))
              .when(F.col("n_documents") > 1, F.lit("repeated")).otherwise(F.lit("complete")))
    zero = F.lit(0).cast("long")
    return both.select("page", status.alias("status"), F.coalesce("n_documents", zero).alias("n_documents"),
                       F.coalesce("n_items", zero).alias("n_items"))


def segment_catalogue(docs: DataFrame) -> DataFrame:
    """Segment responses → (name, id, page, position)."""
    d = docs.select(F.from_json("value", SEGMENT_PAGE_SCHEMA).alias("d"))
    return (d.select(F.coalesce("d.page", F.lit(0).cast("long")).alias("page"),
                     F.posexplode_outer("d.segments").alias("position", "s"))
            .where(F.col("s").isNotNull())
            .select(F.col("s.segment.name").alias("name"), F.col("s.segment.id").alias("id"),
                    "page", F.col("position").cast("long").alias("position")))


def first_by_name(catalogue: DataFrame, value: str) -> DataFrame:
    """Exact-name look-up table, first listed entry wins (page, position).

    Listing order as one long, ``page << 31 | position`` (a position is an
    array index, below 2^31), keeps the aggregate hash-based.
    """
    order = F.shiftleft(F.coalesce(F.col("page"), F.lit(0)).cast("long"), 31) + F.col("position")
    return catalogue.groupBy("name").agg(F.min_by(value, order).alias(value))


def audience_lookup(catalogue: DataFrame) -> DataFrame:
    """(audience, audience_id): one row per distinct name, first listed wins."""
    return first_by_name(catalogue, "audience_id").withColumnRenamed("name", "audience")


def segment_lookup(catalogue: DataFrame) -> DataFrame:
    """(audience, segment_id): one row per distinct segment name, first wins."""
    return (first_by_name(catalogue, "id").withColumnRenamed("name", "audience")
            .withColumnRenamed("id", "segment_id"))


def resolve_audience(routed: DataFrame, catalogue: DataFrame | None = None,
                     lookup: DataFrame | None = None) -> DataFrame:
    """Attach ``audience_id`` (null when the audience does not exist yet).

    Pass ``lookup`` (from ``audience_lookup``) to skip re-deriving it, e.g. per micro-batch.
    """
    if lookup is not None:
        return routed.join(lookup, "audience", "left")
    return routed.join(audience_lookup(catalogue), "audience", "left")


def resolve_segment(routed: DataFrame, catalogue: DataFrame | None = None,
                    lookup: DataFrame | None = None) -> DataFrame:
    """Attach ``segment_id`` (0 when the segment is unknown)."""
    if lookup is not None:
        out = routed.join(lookup, "audience", "left")
    else:
        out = routed.join(segment_lookup(catalogue), "audience", "left")
    kind = out.schema["segment_id"].dataType
    return out.withColumn("segment_id", F.coalesce("segment_id", F.lit("0").cast(kind)))


def resolve_records(records: DataFrame, audiences: DataFrame | None = None,
                    segments: DataFrame | None = None,
                    lookups: tuple[DataFrame, DataFrame] | None = None,
                    rule: EventRule = EventRule()) -> DataFrame:
    """Filter, route and resolve per record: the columns of a plan, but the ``action``."""
    return _resolve(_routed(records, rule), audiences, segments, lookups)


def _routed(records: DataFrame, rule: EventRule) -> DataFrame:
    return route_reasons(route_key(records.where(rule.fits() | F.col("malformed"))))


def _resolve(routed: DataFrame, audiences: DataFrame | None, segments: DataFrame | None,
             lookups: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    aud_lk, seg_lk = lookups if lookups is not None else (None, None)
    with_aud = resolve_audience(routed, audiences, aud_lk)
    with_seg = resolve_segment(with_aud, segments, seg_lk)
    is_file = F.col("profile") == "file"
    reason = F.coalesce(F.col("reason"), F.when(
        ~is_file & (F.col("segment_id").cast("string") == "0"), F.lit("SEGMENT_NOT_FOUND")))
    return with_seg.select(
        "message_id", "bucket", "key", "file_name", "profile", "audience", "calculate_type",
        F.when(is_file, F.col("audience_id")).alias("audience_id"),
        F.when(~is_file, F.col("segment_id")).alias("segment_id"),
        reason.alias("reason"), "size")


def choose_actions(resolved: DataFrame, created: DataFrame | None = None,
                   routed: DataFrame | None = None) -> DataFrame:
    """The ``action`` of each resolved record (null where it has a ``reason``).

    Records that cannot be delivered must have their reason by now: the first record that can be
    (smallest message id) creates an audience that the catalogue does not list.  Where routing alone
    decides what can be delivered, ``routed`` (the records before the look-ups) is cheaper to read twice.
    """
    is_file = F.col("profile") == "file"
    # one row per audience: a minimum, combined before the shuffle
    first = ((resolved if routed is None else routed).where(is_file & F.col("reason").isNull())
             .groupBy("audience").agg(F.min(F.struct("message_id", "key")).alias("__first")))
    if created is not None:
        first = first.join(created.select("audience").distinct(), "audience", "left_anti")
    if routed is not None:
        first = sized_lookup(first, MAX_LOOKUP_NAMES)
    is_first = F.struct("message_id", "key").eqNullSafe(F.col("__first"))
    action = (F.when(F.col("reason").isNotNull(), F.lit(None).cast("string"))
              .when(is_file & F.col("audience_id").isNull() & is_first, F.lit("CREATE"))
              .when(is_file, F.lit("APPEND"))
              .otherwise(F.lit("ADD_USERS")))
    more = [c for c in resolved.columns if c not in PLAN_FIELDS]
    return resolved.join(first, "audience", "left").withColumn("action", action).select(*PLAN_FIELDS, *more)


PLAN_FIELDS = ("message_id", "bucket", "key", "file_name", "profile", "audience", "calculate_type",
               "audience_id", "segment_id", "action", "reason", "size")


def plan_activation(records: DataFrame, audiences: DataFrame | None = None,
                    segments: DataFrame | None = None,
                    lookups: tuple[DataFrame, DataFrame] | None = None,
                    rule: EventRule = EventRule(),
                    created: DataFrame | None = None) -> DataFrame:
    """Filter, route, resolve and decide per record.

    Output columns: message_id, bucket, key, file_name, profile, audience,
    calculate_type, audience_id, segment_id, action, reason, size.  ``action`` is
    APPEND / CREATE (file profile) or ADD_USERS (batch); ``reason`` is set
    for records that go to the dead-letter table; a malformed body goes there
    as ``BAD_BODY``, whatever the rule.

    An audience that the catalogue does not list is created once, by its
    first record (smallest message id); its other records append to it.
    ``created(audience)`` names audiences that an earlier batch created.
    """
    routed = _routed(records, rule)
    if lookups is None:
        lookups = audience_lookup(audiences), segment_lookup(segments)
    # made once and counted, so that the records stay where they are
    sized = tuple(sized_lookup(names, MAX_LOOKUP_NAMES) for names in lookups)
    return choose_actions(_resolve(routed, None, None, sized), created, routed)


def outbox(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("reason").isNull()).drop("reason")


def dead_letters(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("reason").isNotNull()).select("message_id", "bucket", "key", "reason")


def status_message(plan: DataFrame) -> DataFrame:
    """T5: a status code and message per record."""
    msg = (F.when(F.col("action") == "APPEND", F.format_string(MSG_UPDATED, F.col("audience")))
           .when(F.col("action") == "CREATE", F.format_string(MSG_CREATED, F.col("audience")))
           .when(F.col("action") == "ADD_USERS", F.format_string(MSG_SENT, F.col("audience")))
           .otherwise(F.format_string(MSG_ERROR, F.col("reason"), F.coalesce("key", F.lit("")))))
    code = F.when(F.col("reason").isNull(), F.lit(200)).otherwise(F.lit(400))
    return plan.select("message_id", code.alias("status_code"), msg.alias("message"))
