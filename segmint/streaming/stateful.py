"""Keyed state of the activation stream: redelivery window, create-then-append, retries.

Three operators on ``transformWithState``, whose state lives key by key in the RocksDB store:

* ``first_deliveries``: a queue record that is delivered again within the visibility window is dropped;
  after the window its key is forgotten, so the state holds the keys of one window only;
* ``create_then_append``: the files of an audience that does not exist yet wait until its creation is
  answered, then go to the id the answer names; a refused creation moves on to the next file;
* ``with_retries``: a record whose object is not there is tried again with growing pauses, and is a dead
  letter after the last attempt.

The waiting files of an audience are map entries read one by one, so that a hot audience costs disk, not
memory.  The other two keep short states, many keys to a group, so that a micro-batch asks the store once
per group.  ``rocksdb_state`` selects the store for the queries started inside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import settings

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Counting the rows of the state looks every row up before it is written.
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
KEEP_BATCHES = "spark.sql.streaming.minBatchesToRetain"

# --- fixed values: queue settings ---------------------------------------------
#: How long a delivered message stays hidden; it is delivered again after that.
VISIBILITY_MINUTES = 90
# --- fixed values: state (a checkpoint is bound to them) -----------------------
#: Groups of keys of the operators that remember a key for a limited time.
BUCKETS = 4096
# -------------------------------------------------------------------------------


@contextmanager
def rocksdb_state(spark: SparkSession, idle_batches: bool = True, count_rows: bool = True,
                  keep_batches: int | None = None):
    """Streaming queries started inside keep their state in RocksDB (a query takes its settings at its start).

    Micro-batches without input run timers and emit what the watermark has released.  A query by
    processing time that is to end (``availableNow``) needs them off, as it would never be idle.
    Without ``count_rows`` the progress does not name the rows of the state, and writing one needs no look-up.
    ``keep_batches`` says of how many micro-batches the checkpoint keeps the state (the session's number unless
    given); older ones go.
    """
    values = {PROVIDER: ROCKSDB, IDLE_BATCHES: str(idle_batches).lower(), COUNT_ROWS: str(count_rows).lower()}
    if keep_batches is not None:
        values[KEEP_BATCHES] = str(keep_batches)
    with settings(spark, values):
        yield


def _row(names: list[str], row: Row) -> Row:
    return Row(**{n: row[n] for n in names})


def _bucket(key: str) -> F.Column:
    """Keys whose state is short are kept many to a group: each call to the store takes far longer than a row."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


# --- redelivery -----------------------------------------------------------------

class FirstDelivery(StatefulProcessor):
    """The first record of a key in each window; ``window_ms`` after it the key is forgotten.

    A group is a bucket of many keys: what it remembers is read and written as a whole, once in a
    micro-batch, and is the keys of one window.  By event time a record's place is its ``__at``, and a
    timer clears the keys whose window the watermark has passed.  By processing time the keys go when
    the bucket is next used, or the store itself forgets the bucket (time to live).
    """

    def __init__(self, names: list[str], key_type: T.DataType, window_ms: int, event_time: bool):
        self.names, self.window_ms, self.event_time = names, window_ms, event_time
        self.schema = T.StructType([T.StructField("key", key_type), T.StructField("at", T.LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", self.schema, None if self.event_time else self.window_ms)

    def _keep(self, seen: dict, now: int) -> None:
        """Write the keys whose window has not passed."""
        left = [(k, at) for k, at in seen.items() if at + self.window_ms > now]
        if left:
            self.seen.put(left)
        else:
            self.seen.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seen = {k: at for k, at in self.seen.get()}
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        if self.event_time:
            # the copies of one message in one micro-batch, in the order of their times
            rows = sorted(rows, key=lambda r: r["__at"])
        last = None
        for row in rows:
            at = row["__at"] if self.event_time else now
            before = seen.get(row["__key"])
            if before is None or at >= before + self.window_ms:
                seen[row["__key"]] = last = at
                yield _row(self.names, row)
        if last is not None:
            self._keep(seen, now)
            if self.event_time:
                self.handle.registerTimer(last + self.window_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        seen = {k: at for k, at in self.seen.get()}
        if seen:
            self._keep(seen, timerValues.getCurrentWatermarkInMs())
        return iter([])

    def close(self) -> None:
        pass


def first_deliveries(records: DataFrame, key, minutes: float = VISIBILITY_MINUTES,
                     time_column: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """``records`` without those that repeat a ``key`` within ``minutes`` of the one let through.

    A later delivery is let through again and begins a new window.  With ``time_column`` (a timestamp
    with a watermark) times are the records' own; records later than the watermark are dropped.
    Without it they are those of processing, and no record is late.  Only ``columns``, the time column among
    them, travel and come back (all of ``records`` unless given).
    """
    names = columns or records.columns
    at = F.unix_millis(time_column) if time_column else F.lit(0).cast("long")
    keyed = records.withColumns({"__key": key, "__at": at}).select(*names, "__key", "__at").withColumn(
        "__bucket", _bucket("__key"))
    return keyed.groupBy("__bucket").transformWithState(
        FirstDelivery(names, keyed.schema["__key"].dataType, int(minutes * 60_000), bool(time_column)),
        records.select(*names).schema, "Append", "EventTime" if time_column else "ProcessingTime")


# --- create, wait, append --------------------------------------------------------

ACTIONS = T.StructType([
    T.StructField("audience", T.StringType()), T.StructField("message_id", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("attempt", T.LongType()), T.StructField("audience_id", T.StringType()),
    T.StructField("code", T.LongType())])

CREATE_RESPONSE_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("code", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("data", T.StructType([T.StructField("audience_id", T.StringType())])),
])


class CreateThenAppend(StatefulProcessor):
    """One audience: none → pending (attempt n) → created, or back to none when the attempt is refused.

    ``phase`` is (status, attempt, audience id, message and key of the pending file, head and tail of the
    queue of waiting files).  Answers are kept by attempt until it is made, so they may come early, and
    an answer that comes twice counts once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.phase = handle.getValueState(
            "phase", "status string, attempt long, audience_id string, message_id string, key string, head long, tail long")
        self.waiting = handle.getMapState("waiting", "n long", "message_id string, key string")
        self.answers = handle.getMapState("answers", "attempt long", "code long, audience_id string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        audience = key[0]
        status, attempt, audience_id, message, file, head, tail = (
            self.phase.get() if self.phase.exists() else ("none", 0, None, None, None, 0, 0))

        def out(action, message, file, attempt=None, code=None):
            return Row(audience=audience, message_id=message, key=file, action=action, attempt=attempt,
                       audience_id=audience_id, code=code)

        for r in rows:
            if r["attempt"] is not None:
                if status != "created" and r["attempt"] >= attempt:
                    self.answers.updateValue((r["attempt"],), (r["code"], r["audience_id"]))
            elif status == "created":
                yield out("APPEND", r["message_id"], r["key"])
            else:
                self.waiting.updateValue((tail,), (r["message_id"], r["key"]))
                tail += 1
            # go on as far as files and answers reach
            while True:
                if status == "none" and head < tail:
                    message, file = self.waiting.getValue((head,))
                    self.waiting.removeKey((head,))
                    head, attempt, status = head + 1, attempt + 1, "pending"
                    yield out("CREATE", message, file, attempt)
                if status != "pending" or not self.answers.containsKey((attempt,)):
                    break
                code, given = self.answers.getValue((attempt,))
                self.answers.removeKey((attempt,))
                if code == 0:
                    status, audience_id = "created", given
                    yield out("CREATED", message, file, attempt, code)
                    for n in range(head, tail):
                        m, f = self.waiting.getValue((n,))
                        self.waiting.removeKey((n,))
                        yield out("APPEND", m, f)
                    head, tail = 0, 0
                    self.answers.clear()
                else:
                    status = "none"
                    yield out("CREATE_REFUSED", message, file, attempt, code)
        self.phase.update((status, attempt, audience_id, message, file, head, tail))

    def close(self) -> None:
        pass


def create_responses(docs: DataFrame) -> DataFrame:
    """Landed answers (JSON in ``value``) → audience, attempt, code, audience_id.

    The request id is ``<audience>#<attempt>``; other documents are no answers.
    """
    d = docs.select(F.from_json("value", CREATE_RESPONSE_SCHEMA).alias("d")).select("d.*")
    return d.select(
        F.regexp_extract("request_id", "^(.*)#([0-9]+)$", 1).alias("audience"),
        F.expr("try_cast(regexp_extract(request_id, '^(.*)#([0-9]+)$', 2) as long)").alias("attempt"),
        F.coalesce("code", F.lit(-1).cast("long")).alias("code"), F.col("data.audience_id").alias("audience_id")
    ).where(F.col("attempt").isNotNull())


def create_then_append(files: DataFrame, answers: DataFrame) -> DataFrame:
    """What to send for audiences that the catalogue does not list.

    ``files(audience, message_id, key)``: deliverable files, each once; ``answers`` from
    ``create_responses``.  Rows: CREATE (with its attempt), CREATED or CREATE_REFUSED (the answer's code),
    APPEND (with the id that the creation gave).  Files that come before the answer wait in the state.
    """
    both = files.select("audience", F.col("message_id").cast("string").alias("message_id"), "key",
                        F.lit(None).cast("long").alias("attempt"), F.lit(None).cast("long").alias("code"),
                        F.lit(None).cast("string").alias("audience_id")).unionByName(
        answers.select("audience", "attempt", "code", "audience_id"), allowMissingColumns=True)
    return both.groupBy("audience").transformWithState(CreateThenAppend(), ACTIONS, "Append", "None")


# --- retries ----------------------------------------------------------------------

OUTCOMES = T.StructType([
    T.StructField("message_id", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("attempts", T.LongType()), T.StructField("outcome", T.StringType()),
    T.StructField("at", T.LongType())])

DELIVER, DEAD = "DELIVER", "OBJECT_NOT_READABLE"


class Retries(StatefulProcessor):
    """Object keys: since when each object is there, and the messages that wait for it.

    A group holds one key or a bucket of them; its state is read and written as a whole, once in a
    micro-batch.  Attempt k of a message is due ``pause_ms * (2**k - 1)`` after it was received, and is
    decided when the watermark has passed it, so that every object event before it is known.  The first
    one succeeds at once where the object is known to have been there.
    """

    def __init__(self, attempts: int, pause_ms: int, keep_ms: int | None):
        self.attempts, self.pause_ms, self.keep_ms = attempts, pause_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.there = handle.getListState("there", "key string, at long")
        self.waiting = handle.getListState("waiting", "key string, message_id string, received long, attempt long")

    def _read(self) -> tuple[dict, dict]:
        return ({k: at for k, at in self.there.get()},
                {(k, m): (received, attempt) for k, m, received, attempt in self.waiting.get()})

    def _write(self, there: dict | None, waiting: dict | None) -> None:
        """The parts that have changed."""
        for state, rows in ((self.there, there and list(there.items())),
                            (self.waiting, waiting and [(*k, *v) for k, v in waiting.items()])):
            if rows:
                state.put(rows)
            elif rows is not None:
                state.clear()

    def _due(self, received: int, attempt: int) -> int:
        return received + self.pause_ms * ((1 << attempt) - 1)

    def _outcome(self, key, message, attempt, outcome, at) -> Row:
        return Row(message_id=message, key=key, attempts=attempt + 1, outcome=outcome, at=at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        there, waiting = self._read()
        timers, new_there, new_waiting = [], False, False
        for r in rows:
            own, at, message = r["key"], r["__at"], r["message_id"]
            since = there.get(own)
            if message is None:
                if since is None or at < since:
                    there[own], new_there = at, True
                if self.keep_ms is not None:
                    timers.append(at + self.keep_ms)
            elif since is not None and since <= at:
                yield self._outcome(own, message, 0, DELIVER, at)
            else:
                waiting[own, message], new_waiting = (at, 0), True
                timers.append(max(at, now + 1))
        self._write(there if new_there else None, waiting if new_waiting else None)
        if timers:
            self.handle.registerTimer(min(timers))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        there, waiting = self._read()
        left, next_ = {}, []
        for (own, message), (received, attempt) in waiting.items():
            since = there.get(own)
            while True:
                due = self._due(received, attempt)
                if due > now:
                    left[own, message] = (received, attempt)
                    next_.append(due)
                    break
                ready = since is not None and since <= due
                if ready or attempt + 1 == self.attempts:
                    yield self._outcome(own, message, attempt, DELIVER if ready else DEAD, due)
                    break
                attempt += 1
        kept = there
        if self.keep_ms is not None:
            wanted = {own for own, _ in left}
            kept = {k: at for k, at in there.items() if k in wanted or at + self.keep_ms > now}
            next_ += [at + self.keep_ms for at in kept.values() if at + self.keep_ms > now]
        self._write(kept if len(kept) < len(there) else None, left if left != waiting else None)
        if next_:
            self.handle.registerTimer(min(next_))

    def close(self) -> None:
        pass


def with_retries(records: DataFrame, objects: DataFrame, attempts: int = 3, pause_minutes: float = 15,
                 watermark: str = "0 seconds", keep_minutes: float | None = None) -> DataFrame:
    """An outcome for each of ``records(message_id, key, at)``: delivered or dead letter, at which attempt.

    ``objects(key, at)`` says when an object came into being.  Both ``at`` are event times.  Rows:
    message_id, key, attempts (made), outcome, at (milliseconds, when the last one was due).  An object is
    remembered for ``keep_minutes`` after its event, for ever unless given; a record that comes later waits
    for a new event.
    """
    both = (records.select(F.col("message_id").cast("string").alias("message_id"), "key", "at")
            .unionByName(objects.select(F.lit(None).cast("string").alias("message_id"), "key", "at")))
    timed = both.withWatermark("at", watermark).withColumn("__at", F.unix_millis("at"))
    # objects that are never forgotten would make a bucket ever larger: each key by itself
    own = _bucket("key") if keep_minutes is not None else F.xxhash64("key")
    return timed.withColumn("__bucket", own).groupBy("__bucket").transformWithState(
        Retries(attempts, int(pause_minutes * 60_000),
                None if keep_minutes is None else int(keep_minutes * 60_000)), OUTCOMES, "Append", "EventTime")
