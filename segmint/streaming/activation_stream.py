"""Structured Streaming activation job.

Queue records land as JSON-lines files; each new file is read once (file
source + checkpoint).  The event rule is applied first.  Redelivered records
(the queue is at-least-once) are then dropped by ``dropDuplicates`` on bucket,
object key and object version (its etag), whose state lives in the checkpoint,
so a replay never reaches the outbox twice, while a new upload to an old key
does.  Malformed bodies are told apart by message id.  Audiences created by an
earlier micro-batch are kept in the ``created`` table, so each is created once.
Each micro-batch is routed and resolved with the batch operators and written to
``outbox`` and ``dead_letter`` tables partitioned by batch id; a batch that
is re-run after a failure overwrites its own partition only (dynamic
partition overwrite), so the sink is idempotent too.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQuery

from ..operators.activation import (QUEUE_SCHEMA, EventRule, audience_lookup, choose_actions,
                                    parse_records, resolve_records, segment_lookup)
from ..operators.payloads import delivery_requests
from ..sources.audience import relative_key, scan_hash_files
from ..sources.discovery import file_signatures_of
from ..sources.listing import present_objects
from .stateful import first_deliveries, rocksdb_state

PLAN_COLUMNS = ["message_id", "bucket", "key", "file_name", "profile", "audience",
                "calculate_type", "audience_id", "segment_id", "action", "size"]


def _write_epoch(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("epoch").parquet(path))


def _mark_missing(resolved: DataFrame, files_root: str) -> DataFrame:
    """``OBJECT_NOT_READABLE`` for the records whose object is not there, looked up in tasks by key."""
    there = (present_objects(resolved.where(F.col("reason").isNull()), files_root)
             .select("key", F.lit(True).alias("__there")))
    return (resolved.join(there, "key", "left")
            .withColumn("reason", F.coalesce("reason", F.when(F.col("__there").isNull(), F.lit("OBJECT_NOT_READABLE"))))
            .drop("__there"))


def _deliver(spark: SparkSession, sent: DataFrame, files_root: str, epoch_id: int, payload_path: str) -> DataFrame:
    """Read the objects that a batch's deliverable records name; write batch-profile requests.

    Returns the outbox rows, file-profile ones with the md5 of their object.  The keys, bounded by the
    micro-batch, name the files to scan.
    """
    adds = sent.where(F.col("action") == "ADD_USERS")
    add_keys = [r.key for r in adds.select("key").distinct().toLocalIterator()]
    file_keys = [r.key for r in sent.where(F.col("profile") == "file")
                 .select("key").distinct().toLocalIterator()]
    if add_keys:
        req = delivery_requests(adds, scan_hash_files(spark, files_root, add_keys))
        _write_epoch(req.withColumn("epoch", F.lit(epoch_id)), payload_path)
    if file_keys:
        sig = (file_signatures_of(spark, files_root, file_keys)
               .select(relative_key(F.col("path"), files_root).alias("key"), "file_signature"))
        out = sent.join(sig, "key", "left")
    else:
        out = sent.withColumn("file_signature", F.lit(None).cast("string"))
    return out.select(*PLAN_COLUMNS, "file_signature", "epoch")


def redelivery_key() -> Column:
    """What makes two records the same: the object version, or the message id of a malformed body."""
    return (F.when(F.col("malformed"), F.concat(F.lit("m:"), F.col("message_id")))
            .otherwise(F.concat_ws("|", "bucket", "object_key", "etag")))


Catalogue = DataFrame | Callable[[], DataFrame]


def start_activation_stream(spark: SparkSession, queue_path: str, audiences: Catalogue,
                            segments: Catalogue, out_root: str, checkpoint: str,
                            max_files_per_trigger: int = 1,
                            available_now: bool = True,
                            files_root: str | None = None,
                            dedupe_watermark: str | None = None,
                            redelivery_minutes: float | None = None,
                            rule: EventRule = EventRule()) -> StreamingQuery:
    """Start the job; returns the running query (``awaitTermination`` to wait).

    ``audiences`` / ``segments`` are catalogues (name, id, page, position).  A
    DataFrame is one snapshot, whose name look-up is checkpointed once; a
    function is called for every micro-batch, so that a long-running job sees
    new audiences and segments.
    With ``files_root`` (where object keys resolve to files) the job also
    reads the named objects: batch-profile files become request bodies in
    the ``payload`` table, file-profile rows get the md5 ``file_signature``.

    Redelivery is removed by ``dropDuplicates``; its state holds one key per
    relevant object version ever seen.  ``dedupe_watermark`` (e.g. ``"1 day"``)
    bounds that state with ``dropDuplicatesWithinWatermark`` on the record's
    event time instead, at the price that records arriving later than the
    watermark are dropped as late; leave it unset unless the queue's
    redelivery window is known to be shorter.  ``redelivery_minutes`` (the queue's
    visibility window) bounds it without that price: the key of a record is kept in
    RocksDB for so long after its delivery (processing time) and then forgotten.
    """
    def lookup(catalogue: Catalogue, derive) -> Callable[[], DataFrame]:
        if callable(catalogue):
            return lambda: derive(catalogue())
        once = derive(catalogue).checkpoint(eager=True)
        return lambda: once

    audience_names, segment_names = lookup(audiences, audience_lookup), lookup(segments, segment_lookup)
    stream = (spark.readStream.schema(QUEUE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger).json(queue_path))
    recs = parse_records(stream, with_time=bool(dedupe_watermark))
    recs = recs.where(rule.fits() | F.col("malformed"))
    if redelivery_minutes:
        recs = first_deliveries(recs, redelivery_key(), redelivery_minutes)
    elif dedupe_watermark:
        recs = (recs.withColumn("__seen", redelivery_key()).withWatermark("event_time", dedupe_watermark)
                .dropDuplicatesWithinWatermark(["__seen"]).drop("event_time", "__seen"))
    else:
        recs = recs.withColumn("__seen", redelivery_key()).dropDuplicates(["__seen"]).drop("__seen")
    created_path = os.path.join(out_root, "created")
    created_schema = "audience string, epoch long"
    # an empty part, so that the first micro-batch finds the table
    spark.createDataFrame([], "audience string").coalesce(1).write.mode("overwrite").parquet(
        os.path.join(created_path, "epoch=-1"))
    outbox_path = os.path.join(out_root, "outbox")
    dead_path = os.path.join(out_root, "dead_letter")
    payload_path = os.path.join(out_root, "payload")

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # a batch that is run again must not see what its first run created
        created = (spark.read.schema(created_schema).parquet(created_path)
                   .where(F.col("epoch") < epoch_id))
        resolved = resolve_records(batch, lookups=(audience_names(), segment_names()), rule=rule).persist()
        # before an audience's first record is chosen: only one that can be delivered may create it
        ready = _mark_missing(resolved, files_root) if files_root else resolved
        plan = choose_actions(ready, created).withColumn("epoch", F.lit(epoch_id)).persist()
        try:
            dead = (plan.where(F.col("reason").isNotNull())
                    .select("message_id", "bucket", "key", "reason", "epoch"))
            sent = plan.where(F.col("reason").isNull())
            out = (_deliver(spark, sent, files_root, epoch_id, payload_path) if files_root
                   else sent.select(*PLAN_COLUMNS, "epoch"))
            _write_epoch(out, outbox_path)
            _write_epoch(dead, dead_path)
            _write_epoch(plan.where(F.col("action") == "CREATE").select("audience", "epoch"), created_path)
        finally:
            plan.unpersist()
            resolved.unpersist()

    writer = (recs.writeStream.foreachBatch(handle)
              .option("checkpointLocation", checkpoint)
              # unique: several activation streams may run in one session
              .queryName(f"activation_{uuid.uuid4().hex[:12]}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    if redelivery_minutes:
        with rocksdb_state(spark, idle_batches=not available_now):
            return writer.start()
    return writer.start()


OUTBOX_SCHEMA = ("message_id string, bucket string, key string, file_name string, profile string,"
                 " audience string, calculate_type string, audience_id string, segment_id string,"
                 " action string, size long, file_signature string, epoch long")
DEAD_SCHEMA = "message_id string, bucket string, key string, reason string, epoch long"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the job, empty when nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_outbox(spark: SparkSession, out_root: str) -> DataFrame:
    return _table(spark, os.path.join(out_root, "outbox"), OUTBOX_SCHEMA)


def read_dead_letters(spark: SparkSession, out_root: str) -> DataFrame:
    return _table(spark, os.path.join(out_root, "dead_letter"), DEAD_SCHEMA)


def read_payloads(spark: SparkSession, out_root: str) -> DataFrame:
    return _table(spark, os.path.join(out_root, "payload"),
                  "key string, audience string, segment_id string, send_order int, schema string,"
                  " n_users long, payload string, epoch long")
