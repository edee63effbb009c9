"""Registered queries on keyed state and on changes of the output: redelivery, creation, retries, answers.

The streams read files that are written from the driver tables in slices of event time, one after the
other, as a queue would fill; each query runs its stream to the end and returns what it wrote.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import activation as A
from ..operators import payloads as PL
from ..session import SHUFFLES_GO, remove_path, scratch_path, settings
from ..sinks.commits import new_version
from ..sinks.writers import read_committed, replace_output, write_output, write_version
from ..sources.audience import scan_audience
from ..sources.listing import manifest_diff, read_snapshot, snapshot
from ..spec import HASH_LINE_BYTES
from ..streaming import stateful as S
from ..streaming.activation_stream import redelivery_key
from ..streaming.status_stream import response_status, responses
from . import oracle_sql as O
from .derived import contacts_frame, notifications_frame, queue_records
from .registry import (AUD_CTE, FILE_SPEC, FILTERED_CTE, NOTIF_CTE, PLAN_WITH, RULE, SMALL_BYTE_CAP,
                       activation_plan, audience_scan, register, table)
from .transform import read_counts, run_transform

SLICES, FILES_PER_SLICE = 4, 2
#: A slice of more rows has more files, so that they are written and read in as many tasks.
ROWS_PER_FILE = 200_000
#: Event times of the driver tables begin here; a slice holds this many days.
FIRST_DAY, SLICE_DAYS = "2024-01-01", 8
#: A last record whose time releases everything before it.
LAST_TIME = "2100-01-01 00:00:00"


def _land(df: DataFrame, path: str, time: str, as_text: bool = False) -> int:
    """``df`` as JSON files, slice after slice of ``time``; of text rows only ``value`` is written.

    Returns the number of files of a slice.  The rows are made once and kept by slice before that.
    """
    spark = df.sparkSession
    day = F.floor((F.unix_seconds(time) - F.unix_seconds(F.lit(FIRST_DAY).cast("timestamp"))) / 86400)
    own = F.least(F.greatest(F.floor(day / SLICE_DAYS), F.lit(0)), F.lit(SLICES - 1)).cast("int")
    sliced = df.withColumn("slice", own)
    sliced.write.partitionBy("slice").parquet(f"{path}_rows")
    made = spark.read.schema(sliced.schema).parquet(f"{path}_rows")
    most = made.groupBy("slice").count().agg(F.max("count")).first()[0] or 0
    files = max(FILES_PER_SLICE, -(-most // ROWS_PER_FILE))
    for k in range(SLICES):
        part = made.where(F.col("slice") == k).drop("slice").repartition(files)
        if as_text:
            part.select("value").write.mode("append").text(path)
        else:
            part.write.mode("append").json(path)
    return files


def _stream(spark: SparkSession, path: str, schema, files: int = FILES_PER_SLICE) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def _run(frame: DataFrame, base: str, count_rows: bool = True, keep_batches: int | None = None) -> DataFrame:
    """What the stream has written when all files are read."""
    spark, schema = frame.sparkSession, frame.schema
    with S.rocksdb_state(spark, count_rows=count_rows, keep_batches=keep_batches):
        q = (frame.writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/out")


def _number(column: str = "message_id"):
    return F.substring_index(column, "-", -1).cast("long")


def _last() -> F.Column:
    return F.lit(LAST_TIME).cast("timestamp")


# --- T6 ------------------------------------------------------------------------

#: A message is delivered again this long after each delivery.
REDELIVERED_AFTER_MINUTES = 40
DELIVERIES = 6
#: The queue holds about so many deliveries at a time: these are landed, read and removed before the next.
ROWS_IN_QUEUE = 4_000_000
#: The checkpoint keeps the state of so many micro-batches.
KEPT_BATCHES = 2
#: Parts of the state at most: a micro-batch has no more rows than the queue, and each part's store takes some MB.
STATE_PARTS = 64


def _cuts(deliveries: DataFrame, most: int) -> list[int]:
    """Seconds that part ``received`` in slices of about ``most`` rows, ``SLICES`` at least (fewer of few seconds)."""
    n = max(SLICES, -(-deliveries.count() // most))
    found = deliveries.agg(F.percentile_approx(
        F.unix_seconds("received"), [k / n for k in range(1, n)], max(10_000, 20 * n))).first()[0]
    return sorted(set(found or []))


def _within(time: str, low: int | None, high: int | None) -> F.Column:
    """Seconds of ``time`` from ``low`` on and before ``high``; rows without a time come first."""
    s = F.unix_seconds(time)
    from_low = s >= low if low is not None else F.lit(True)
    return from_low & (F.coalesce(s < high, F.lit(low is None)) if high is not None else F.lit(True))


def _delivered(flat: DataFrame) -> DataFrame:
    """A row for each delivery of a notification, with its number and time."""
    again = flat.withColumn("delivery", F.explode(F.sequence(F.lit(0).cast("long"), _number("messageId") % DELIVERIES)))
    return again.withColumn("received", F.col("event_time") + F.make_dt_interval(
        mins=F.col("delivery") * REDELIVERED_AFTER_MINUTES)).drop("event_time")


@register("redelivery_ttl", O.with_ctes(NOTIF_CTE, FILTERED_CTE) + (
    "SELECT message_id, delivery FROM (SELECT message_id, unnest(range(0, "
    "CAST(split_part(message_id, '-', 2) AS BIGINT) % 6 + 1)) AS delivery FROM "
    "(SELECT message_id FROM f UNION ALL SELECT message_id FROM nt WHERE source IS NULL) m) d "
    # 0, 40, 80 minutes lie in one window of 90; 120 is the first beyond it
    f"WHERE delivery % {-(-S.VISIBILITY_MINUTES // REDELIVERED_AFTER_MINUTES)} = 0"))
def q_redelivery_ttl(spark, sf_dir):
    """Every notification is delivered up to six times; one delivery in each visibility window goes on,
    and a key is forgotten when its window has passed."""
    base = scratch_path(spark, "redelivery")
    flat = notifications_frame(spark, sf_dir).where("message_id is not null")
    schema = T.StructType(A.QUEUE_SCHEMA.fields + [T.StructField("delivery", T.LongType()),
                                                   T.StructField("received", T.TimestampType())])
    cuts = _cuts(_delivered(flat.select(F.col("message_id").alias("messageId"), "event_time")), ROWS_IN_QUEUE)
    for low, high in zip([None, *cuts], [*cuts, None]):
        # those whose deliveries can be in the slice; the body of all deliveries is the same, and made once
        longest = 60 * REDELIVERED_AFTER_MINUTES * (DELIVERIES - 1)
        near = flat.where(_within("event_time", None if low is None else low - longest, high))
        landed = _delivered(queue_records(near, keep=("event_time",))).where(_within("received", low, high))
        (landed.write.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE).mode("append")
         .json(f"{base}/queue"))
        # the stream goes on from its checkpoint; what it has read leaves the queue
        recs = A.parse_records(spark.readStream.schema(schema).json(f"{base}/queue"), keep=("delivery", "received"))
        recs = recs.where(RULE.fits() | F.col("malformed")).withWatermark("received", "0 seconds")
        first = S.first_deliveries(recs, redelivery_key(), time_column="received",
                                   columns=["message_id", "delivery", "received"])
        parts = min(STATE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        with settings(spark, SHUFFLES_GO | {"spark.sql.shuffle.partitions": str(parts)}):
            out = _run(first.select("message_id", "delivery"), base, keep_batches=KEPT_BATCHES)
        remove_path(spark, f"{base}/queue")
    return out


# --- J3 ------------------------------------------------------------------------

#: Landed answers to creations, from ``part``: which attempt, its code and the new id.
CREATE_ANSWERS = [
    "concat('Audience ', CAST(p_partkey % 130 AS STRING)) AS audience",
    "CAST(floor(p_partkey / 130) AS BIGINT) + 1 AS attempt",
    "CAST(CASE WHEN p_size % 3 = 0 THEN 0 ELSE 40002 END AS BIGINT) AS code",
    "CAST(8000000 + p_partkey AS STRING) AS new_id",
]


@register("create_then_append", PLAN_WITH + (
    ", n AS (SELECT audience, count(*) AS files FROM plan WHERE reason IS NULL AND profile = 'file' "
    "AND audience_id IS NULL GROUP BY audience), "
    f"a AS (SELECT {', '.join(CREATE_ANSWERS)} FROM part), "
    "s AS (SELECT n.audience, files, count(attempt) AS answered, min(attempt) FILTER (code = 0) AS good, "
    "arg_min(new_id, attempt) FILTER (code = 0) AS new_id FROM n LEFT JOIN a USING (audience) GROUP BY ALL), "
    # attempts follow each other until one succeeds, an answer is missing or the files run out
    "m AS (SELECT *, least(files, coalesce(good, answered + 1)) AS made FROM s) "
    "SELECT audience, made AS n_creates, least(made, answered) - CASE WHEN made = good THEN 1 ELSE 0 END AS n_refused, "
    "CASE WHEN made = good THEN files - made ELSE 0 END AS n_appends, "
    "CASE WHEN made = good THEN new_id END AS audience_id FROM m").replace("made = good", "coalesce(made = good, false)"))
def q_create_then_append(spark, sf_dir):
    """The files of an unlisted audience wait for the answer to its creation, are appended with the id it
    gives, and take their turn as the next creation when it is refused."""
    base = scratch_path(spark, "create")
    sent = A.outbox(activation_plan(spark, sf_dir)).where("profile = 'file' and audience_id is null")
    sent.select("audience", "message_id", "key").repartition(2 * SLICES).write.json(f"{base}/files")
    answers = table(spark, sf_dir, "part").selectExpr(*CREATE_ANSWERS)
    answers.select(F.to_json(F.struct(
        F.concat_ws("#", "audience", "attempt").alias("request_id"), "code",
        F.when(F.col("code") == 0, "OK").otherwise("refused").alias("message"),
        F.struct(F.when(F.col("code") == 0, F.col("new_id")).alias("audience_id")).alias("data"))).alias("value")
    ).repartition(SLICES).write.text(f"{base}/answers")
    landed = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/answers")
    files = _stream(spark, f"{base}/files", "audience string, message_id string, key string")
    out = _run(S.create_then_append(files, S.create_responses(landed)), base)

    def n(action):
        return F.count(F.when(F.col("action") == action, 1))
    return out.groupBy("audience").agg(n("CREATE").alias("n_creates"), n("CREATE_REFUSED").alias("n_refused"),
                                       n("APPEND").alias("n_appends"), F.max("audience_id").alias("audience_id"))


# --- T3 ------------------------------------------------------------------------

ATTEMPTS, PAUSE_MINUTES = 3, 15
#: When an object comes into being, in minutes from its notification; some never do.
OBJECT_MINUTES = "CASE WHEN size % 5 <> 0 THEN (size % 7) * 12 - 10 END"


def _with_times(spark: SparkSession, sf_dir: str, plan: DataFrame) -> DataFrame:
    times = notifications_frame(spark, sf_dir).select("message_id", "event_time")
    return plan.join(times, "message_id")


@register("retry_dead_letters", PLAN_WITH + (
    f", o AS (SELECT message_id, {OBJECT_MINUTES} AS there FROM plan WHERE reason IS NULL) "
    "SELECT message_id, CAST(CASE WHEN there <= 0 THEN 1 "
    f"WHEN there <= {PAUSE_MINUTES} THEN 2 ELSE {ATTEMPTS} END AS BIGINT) AS attempts, "
    f"CASE WHEN there <= {3 * PAUSE_MINUTES} THEN '{S.DELIVER}' ELSE '{S.DEAD}' END AS outcome FROM o"))
def q_retry_dead_letters(spark, sf_dir):
    """A record whose object is not there yet is tried again with doubling pauses, and is a dead letter
    after the last attempt."""
    base = scratch_path(spark, "retries")
    _with_times(spark, sf_dir, A.outbox(activation_plan(spark, sf_dir))).select(
        "message_id", "key", "size", "event_time").write.parquet(f"{base}/outbox")
    sent = spark.read.parquet(f"{base}/outbox")  # used twice
    records = sent.select("message_id", "key", F.col("event_time").alias("at"))
    there = sent.withColumn("m", F.expr(OBJECT_MINUTES)).where("m is not null").select(
        F.lit(None).cast("string").alias("message_id"), "key",
        (F.col("event_time") + F.make_dt_interval(mins=F.col("m"))).alias("at"))
    last = spark.range(1).select(F.lit(None).cast("string").alias("message_id"), F.lit("").alias("key"), _last().alias("at"))
    files = _land(records.unionByName(there).unionByName(last), f"{base}/events", "at")
    events = _stream(spark, f"{base}/events", records.schema, files)
    out = _run(S.with_retries(events.where("message_id is not null"), events.where("message_id is null").select("key", "at"),
                              ATTEMPTS, PAUSE_MINUTES, keep_minutes=24 * 60), base)
    return out.select("message_id", "attempts", "outcome")


# --- T5 ------------------------------------------------------------------------

#: Landed answers, from ``orders``: to which notification, how long after it, code and text.
ANSWERS = [
    "concat(substring(md5(CAST(o_orderkey AS STRING)), 1, 8), '-', CAST(o_orderkey AS STRING)) AS request_id",
    "1 + o_custkey % 200 AS minutes",
    "CAST(CASE o_orderstatus WHEN 'P' THEN 40002 ELSE 0 END AS BIGINT) AS code",
    "o_orderpriority AS answer",
]
ANSWERED = "o_orderpriority <> '5-LOW'"
TIMEOUT_MINUTES = 90


@register("response_status", PLAN_WITH + (
    f", a AS (SELECT {', '.join(ANSWERS)} FROM orders WHERE {ANSWERED}) "
    "SELECT message_id, audience, action, coalesce(CASE WHEN code = 0 THEN 200 ELSE code END, 400) AS status_code, "
    "CASE WHEN code IS NULL THEN format('ERROR in uploading audience {}', audience) "
    "WHEN code <> 0 THEN format('ERROR in uploading audience {}: {}', audience, answer) "
    "WHEN action = 'APPEND' THEN format('Audience {} is successfully updated', audience) "
    "WHEN action = 'CREATE' THEN format('Audience {} is successfully created', audience) "
    "ELSE format('Users sent to segment {}', audience) END AS message "
    f"FROM plan LEFT JOIN a ON request_id = message_id AND minutes <= {TIMEOUT_MINUTES} WHERE reason IS NULL"))
def q_response_status(spark, sf_dir):
    """T5: the status of each request from the answer that lands for it; without one in time it has failed."""
    base = scratch_path(spark, "responses")
    sent = _with_times(spark, sf_dir, A.outbox(activation_plan(spark, sf_dir))).select(
        "message_id", "audience", "action", F.col("event_time").alias("sent_at"))
    last = spark.range(1).select(F.lit("last").alias("message_id"), F.lit("").alias("audience"),
                                 F.lit("").alias("action"), _last().alias("sent_at"))
    files = _land(sent.unionByName(last), f"{base}/sent", "sent_at")
    times = notifications_frame(spark, sf_dir).select(F.col("message_id").alias("request_id"), "event_time")
    docs = (table(spark, sf_dir, "orders").where(ANSWERED).selectExpr(*ANSWERS).join(times, "request_id")
            .withColumn("at", F.col("event_time") + F.make_dt_interval(mins=F.col("minutes")))
            .select("request_id", "code", F.col("answer").alias("message"), "at"))
    docs = docs.unionByName(spark.range(1).select(F.lit("nobody").alias("request_id"), F.lit(0).cast("long").alias("code"),
                                                  F.lit("").alias("message"), _last().alias("at")))
    text = docs.select("at", F.to_json(F.struct("request_id", "code", "message", F.date_format(
        "at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"))).alias("value"))
    answer_files = _land(text, f"{base}/answers", "at", as_text=True)
    landed = spark.readStream.option("maxFilesPerTrigger", answer_files).text(f"{base}/answers")
    return _run(response_status(_stream(spark, f"{base}/sent", sent.schema, files), responses(landed),
                                f"{TIMEOUT_MINUTES} minutes"), base, count_rows=False)


# --- S6, T1 ----------------------------------------------------------------------

STAYS, REWRITTEN = "Audience 1", "Audience 2"
CAPS = (SMALL_BYTE_CAP // HASH_LINE_BYTES, 5 * SMALL_BYTE_CAP // (2 * HASH_LINE_BYTES))


def _folders_sql(cap: int) -> str:
    return (f"SELECT concat('output/file/{REWRITTEN}/schema=', upper(schema), '/source=upload/chunk=', chunk) AS folder, "
            f"CAST(sum(strlen(hash) + 1) AS BIGINT) AS size FROM ({O.file_split_sql(cap, segment=REWRITTEN)}) t "
            "GROUP BY schema, chunk")


@register("manifest_diff", (
    f"WITH a AS ({_folders_sql(CAPS[0])}), b AS ({_folders_sql(CAPS[1])}) "
    "SELECT coalesce(b.folder, a.folder) AS folder, CASE WHEN a.folder IS NULL THEN 'new' "
    "WHEN b.folder IS NULL THEN 'gone' ELSE 'changed' END AS status, "
    "coalesce(b.size, a.size) AS size FROM a FULL OUTER JOIN b ON a.folder = b.folder"))
def q_manifest_diff(spark, sf_dir):
    """S6+T1: the output is listed in tasks before and after one of two uploads is written again in other
    parts; the two listings are merged into what is new, changed and gone."""
    base = scratch_path(spark, "changes")

    def write(segment, cap):
        spec = replace(FILE_SPEC, segment_name=segment)
        job = run_transform(audience_scan(spark, sf_dir, spec), spec, cap_rows=cap)
        write_output(job.rows, f"{base}/bucket", "file", segment, num_parts=job.n_parts, chunks=job.chunks)
        job.release()

    def by_folder(listing):
        return listing.groupBy(F.regexp_replace("key", "/[^/]*$", "").alias("key")).agg(
            F.sum("size").alias("size"), F.max("modified").alias("modified"))

    write(STAYS, CAPS[0])
    write(REWRITTEN, CAPS[0])
    snapshot(spark, f"{base}/bucket", f"{base}/before")
    write(REWRITTEN, CAPS[1])
    after = snapshot(spark, f"{base}/bucket", f"{base}/after")
    changes = manifest_diff(by_folder(read_snapshot(spark, f"{base}/before")), by_folder(after))
    return changes.select(F.col("key").alias("folder"), "status", "size")


# --- K1, P11: replacement as a whole -------------------------------------------------

@register("read_committed", (
    "SELECT 'after a failed run' AS moment, schema, chunk, count(*) AS n_rows, min(hash) AS first_hash "
    f"FROM ({O.file_split_sql(CAPS[0], segment=REWRITTEN)}) a GROUP BY schema, chunk UNION ALL "
    "SELECT 'after the next run', schema, chunk, count(*), min(hash) "
    f"FROM ({O.file_split_sql(CAPS[1], segment=REWRITTEN)}) b GROUP BY schema, chunk"))
def q_read_committed(spark, sf_dir):
    """K1+P11: an upload is written, written again by a run that ends before its commit, and replaced by a
    third; readers see the first version whole, then the third."""
    base = scratch_path(spark, "commits")
    spec = replace(FILE_SPEC, segment_name=REWRITTEN)

    def run(cap, whole):
        job = run_transform(audience_scan(spark, sf_dir, spec), spec, cap_rows=cap)
        if whole:
            replace_output(job.rows, base, "file", REWRITTEN, job.n_parts, schemas=list(job.chunks))
        else:
            write_version(job.rows, base, "file", REWRITTEN, new_version(), job.n_parts)
        job.release()

    def seen(moment, name):
        rows = read_committed(spark, base, "file", REWRITTEN)
        parts = rows.groupBy("schema", "chunk").agg(F.count(F.lit(1)).alias("n_rows"), F.min("hash").alias("first_hash"))
        parts.select(F.lit(moment).alias("moment"), "*").write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    run(CAPS[0], True)
    run(CAPS[1], False)
    before = seen("after a failed run", "seen_before")
    run(CAPS[1], True)
    return before.unionByName(seen("after the next run", "seen_after"))


# --- T7: bodies of the file profile ---------------------------------------------------

ADVERTISER = "700000000001"
#: Landed answers to uploads, from ``orders``.
UPLOAD_ANSWERS = [
    "concat(substring(md5(CAST(o_orderkey AS STRING)), 1, 8), '-', CAST(o_orderkey AS STRING)) AS request_id",
    "CAST(CASE o_orderstatus WHEN 'P' THEN 40000 ELSE 0 END AS BIGINT) AS code",
    "concat('uploads/', CAST(o_custkey AS STRING), '/', CAST(o_orderkey AS STRING)) AS file_path",
]


@register("file_requests", PLAN_WITH + (
    f", u AS (SELECT {', '.join(UPLOAD_ANSWERS)} FROM orders) "
    "SELECT message_id, action, CASE WHEN action = 'CREATE' THEN concat('{\"advertiser_id\":\"" + ADVERTISER + "\",\"file_paths\":[\"', "
    "file_path, '\"],\"custom_audience_name\":\"', audience, '\",\"calculate_type\":\"', calculate_type, '\"}') "
    "ELSE concat('{\"action\":\"APPEND\",\"advertiser_id\":\"" + ADVERTISER + "\",\"file_paths\":[\"', file_path, "
    "'\"],\"custom_audience_id\":\"', audience_id, '\"}') END AS body "
    "FROM plan JOIN u ON request_id = message_id AND code = 0 "
    "WHERE reason IS NULL AND profile = 'file' AND (action = 'CREATE' OR audience_id IS NOT NULL)"))
def q_file_requests(spark, sf_dir):
    """The body of the create or append request of each file whose upload was answered with a path."""
    base = scratch_path(spark, "uploads")
    answers = table(spark, sf_dir, "orders").selectExpr(*UPLOAD_ANSWERS)
    answers.select(F.to_json(F.struct("request_id", "code", F.when(F.col("code") > 0, "refused").alias("message"), F.struct(
        F.when(F.col("code") == 0, F.col("file_path")).alias("file_path")).alias("data"))).alias("value")).write.text(base)
    sent = A.outbox(activation_plan(spark, sf_dir))
    return PL.audience_bodies(sent, PL.uploaded_paths(spark.read.text(base)), ADVERTISER)


# --- A5: rows of each upload ------------------------------------------------------------

UPLOADS, BROKEN_EVERY = 5, 23


@register("upload_rows", O.with_ctes(O.CONTACTS_CTE, O.NORMALIZED_CTE) + (
    f", b AS (SELECT c.contact_id, c.contact_id % {UPLOADS} AS upload, c.contact_id % {BROKEN_EVERY} = 7 AS bad, "
    "unnest(['EMAIL_SHA256', 'PHONE_SHA256', 'GAID_SHA256']) AS schema, "
    "unnest([\"e-mail\", phone_number, mobile_advertiser_id]) AS raw, unnest([email_n, phone_n, ad_n]) AS norm "
    "FROM c JOIN n USING (contact_id)) "
    "SELECT upload, schema, count(*) AS records, count(*) FILTER (NOT bad AND norm IS NOT NULL) AS accepted, "
    "count(*) FILTER (NOT bad AND raw IS NULL) AS no_value, "
    "count(*) FILTER (NOT bad AND raw IS NOT NULL AND norm IS NULL) AS empty, "
    "count(*) FILTER (bad) AS malformed FROM b GROUP BY upload, schema"))
def q_upload_rows(spark, sf_dir):
    """A5: values accepted, missing, empty and on malformed lines of each source file, counted by the job that
    parses the upload."""
    base = scratch_path(spark, "upload_rows")
    contacts = contacts_frame(spark, sf_dir)
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in contacts.columns]))
    # some lines are cut off
    cut = F.when(F.col("contact_id") % BROKEN_EVERY == 7, F.substring(line, 1, 12)).otherwise(line)
    (contacts.select(cut.alias("value"), (F.col("contact_id") % UPLOADS).alias("upload"))
     .write.partitionBy("upload").text(f"{base}/in"))
    spec = replace(FILE_SPEC, read_mode="PERMISSIVE")
    job = run_transform(scan_audience(spark, f"{base}/in/*", spec), spec, counts_path=f"{base}/counts")
    write_output(job.rows, f"{base}/bucket", "file", spec.segment_name, num_parts=job.n_parts, chunks=job.chunks)
    job.release()
    counts = read_counts(spark, f"{base}/counts")
    upload = F.regexp_extract("source_file", "upload=([0-9]+)", 1).cast("long")
    return counts.groupBy(upload.alias("upload"), "schema").agg(*[
        F.sum(c).alias(c) for c in ("records", "accepted", "no_value", "empty", "malformed")])


# --- S10: completeness of a paged catalogue -------------------------------------------

PAGE_ROWS, LOST, TWICE = 10, 4, 3


@register("catalogue_pages", (
    f"WITH p AS (SELECT s_suppkey // {PAGE_ROWS} + 1 AS page, count(*) AS n FROM supplier GROUP BY ALL) "
    f"SELECT page, CASE WHEN page % {LOST} = 0 THEN 'missing' WHEN page % {TWICE} = 0 THEN 'repeated' ELSE 'complete' END AS status, "
    f"CASE WHEN page % {LOST} = 0 THEN 0 WHEN page % {TWICE} = 0 THEN 2 ELSE 1 END AS n_documents, "
    f"CASE WHEN page % {LOST} = 0 THEN 0 WHEN page % {TWICE} = 0 THEN 2 * n ELSE n END AS n_items FROM p"))
def q_catalogue_pages(spark, sf_dir):
    """Which pages of a landed catalogue are complete, which were lost and which came twice."""
    rows = table(spark, sf_dir, "supplier").select(
        (F.floor(F.col("s_suppkey") / PAGE_ROWS) + 1).cast("long").alias("page"),
        F.struct(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("audience_id")).alias("item"))
    total = rows.agg(F.max("page").alias("total_page"))
    pages = rows.groupBy("page").agg(F.collect_list("item").alias("list")).join(F.broadcast(total))  # one row
    doc = F.to_json(F.struct(
        # a lost page was answered with an error
        F.when(F.col("page") % LOST == 0, 50000).otherwise(0).alias("code"),
        F.struct("list", F.struct("page", "total_page").alias("page_info")).alias("data")))
    copies = F.when(F.col("page") % TWICE == 0, 2).otherwise(1)
    path = scratch_path(spark, "pages")
    pages.select(doc.alias("value"), F.explode(F.sequence(F.lit(1), copies))).select("value").write.text(path)
    return A.catalogue_pages(spark.read.text(path))
