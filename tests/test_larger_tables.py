"""Work that must not grow with each record: calls to the state store, shuffles of a plan, files of a slice."""

import os
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.operators import activation as A
from segmint.plans import registry_state as RS
from segmint.plans.registry import ORACLE
from segmint.streaming import stateful as S


class Store:
    """The calls that a processor makes, and a list state."""

    def __init__(self):
        self.calls, self.timers = 0, []

    def getListState(self, *_):
        store = self

        class State:
            rows: list = []

            def get(self):
                store.calls += 1
                return iter(self.rows)

            def put(self, rows):
                store.calls += 1
                self.rows = list(rows)

            def clear(self):
                store.calls += 1
                self.rows = []
        return State()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class Times:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_first_deliveries_ask_the_store_once_per_bucket():
    p, store = S.FirstDelivery(["n"], T.StringType(), 90, True), Store()
    p.init(store)
    rows = [Row(n=(k, at), __key=f"k{k}", __at=at) for k in range(500) for at in (100, 0, 50, 80)]
    got = sorted(r.n for r in p.handleInputRows((1,), iter(rows), Times(0)))
    assert got == sorted((k, at) for k in range(500) for at in (0, 100))
    again = [Row(n=(k, 120), __key=f"k{k}", __at=120) for k in range(400, 600)]
    assert sorted(r.n for r in p.handleInputRows((1,), iter(again), Times(100))) == [(k, 120) for k in range(500, 600)]
    assert store.calls <= 6 and max(store.timers) == 210
    assert list(p.handleExpiredTimer((1,), Times(190), None)) == [] and len(p.seen.rows) == 100
    assert list(p.handleExpiredTimer((1,), Times(210), None)) == [] and p.seen.rows == []


def test_retries_ask_the_store_once_per_bucket():
    p, store = S.Retries(3, 15, 1000), Store()
    p.init(store)
    rows = [Row(key=f"k{k}", message_id=m, __at=10) for k in range(300) for m in (("a", None) if k % 3 else ("a",))]
    list(p.handleInputRows((1,), iter(rows), Times(0)))
    assert store.calls <= 5
    first = [r for r in p.handleExpiredTimer((1,), Times(10), None)]
    assert len(first) == 200 and {(r.attempts, r.outcome) for r in first} == {(1, S.DELIVER)}
    rest = [r for r in p.handleExpiredTimer((1,), Times(55), None)]
    assert sorted(r.key for r in rest) == sorted(f"k{k}" for k in range(0, 300, 3))
    assert {(r.attempts, r.outcome) for r in rest} == {(3, S.DEAD)} and store.calls <= 20
    assert len(p.there.rows) == 200
    list(p.handleExpiredTimer((1,), Times(1010), None))
    assert p.there.rows == [] and p.waiting.rows == []


def test_a_plan_leaves_the_records_where_they_are(spark):
    schema = T.StructType(A.QUEUE_SCHEMA.fields)
    body = ('{"source":"aws.s3","detail-type":"Object Created","detail":{"bucket":{"name":"uploader-etl-artifacts"},'
            '"object":{"key":"output/file/%s/EMAIL_SHA256/%d.csv","size":1}}}')
    recs = A.parse_records(spark.createDataFrame([(str(i), body % ("ab"[i % 2], i)) for i in range(9)], schema))
    audiences = spark.createDataFrame([("a", "1", 1, 0)], "name string, audience_id string, page long, position long")
    segments = spark.createDataFrame([("s", "1", 1, 0)], "name string, id string, page long, position long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where no size is known
    try:
        plan = A.plan_activation(recs, audiences, segments)
        text = plan._jdf.queryExecution().executedPlan().toString()
        actions = sorted((r.message_id, r.action) for r in plan.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    assert actions == [(str(i), "CREATE" if i == 1 else "APPEND") for i in range(9)]


@pytest.mark.parametrize("rows, files", [(30, 2), (400, 5)])
def test_a_slice_of_more_rows_has_more_files(spark, tmp_path, monkeypatch, rows, files):
    monkeypatch.setattr(RS, "ROWS_PER_FILE", 80, raising=False)
    made = spark.range(rows).select("id", F.timestamp_seconds(F.lit(1704070800) + F.col("id")).alias("at"))
    assert RS._land(made, str(tmp_path / "q"), "at") == files
    assert spark.read.schema(made.schema).json(str(tmp_path / "q")).count() == rows


def test_the_queue_of_redeliveries_holds_one_slice_at_a_time(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i), i % 30, "click", 30.0 + i % 50, '{"k": %d}' % (i % 9)) for i in range(240)]
    rows += [(None, start, 1, "view", 40.0, "{}")] + rows[:20]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(RS, "ROWS_IN_QUEUE", 250, raising=False)
    run, queues, held = RS._run, [], []

    def looked_at(frame, base, *args, **kwargs):
        queues.append(base)
        held.append(spark.read.json(f"{base}/queue").count())
        return run(frame, base, *args, **kwargs)

    monkeypatch.setattr(RS, "_run", looked_at)
    got = sorted(tuple(r) for r in RS.q_redelivery_ttl(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet' WHERE event_id IS NOT NULL")
    want = con.execute(ORACLE["redelivery_ttl"]).fetchall()
    assert got == sorted(set(want)) and len(got) > 150  # an event that is there twice has one object version
    # all deliveries were in the queue, never many at a time
    assert sum(held) == sum(i % 6 + 1 for i in range(240)) + sum(i % 6 + 1 for i in range(20))
    assert max(held) < 350
    assert len(set(queues)) == 1 and not any(os.path.exists(f"{queues[0]}/{x}") for x in ("queue", "queue_rows"))
