"""Keyed state: redelivery window, create-then-append, retries, status of landed answers."""

import json
import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from segmint.streaming import stateful as S
from segmint.streaming.status_stream import response_status, responses

T0 = datetime(2024, 1, 1)


def land(spark, path, rows, schema):
    """One file; files are read in the order of landing."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)
    time.sleep(0.05)


def run(spark, frame, out, checkpoint, idle_batches=True):
    with S.rocksdb_state(spark, idle_batches):
        q = (frame.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(frame.schema).parquet(out).collect(), q


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def state_rows(q):
    return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]


# --- redelivery -------------------------------------------------------------

def test_redelivery_window_by_event_time_and_bounded_state(spark, tmp_path):
    src, schema = str(tmp_path / "q"), "k string, at timestamp, n long"
    rng = random.Random(1)
    days, want, n = [], [], 0
    for day in range(5):
        rows = []
        for k in range(40):  # new keys every day
            times = sorted(T0 + timedelta(days=day, minutes=rng.randrange(0, 600)) for _ in range(rng.randint(1, 6)))
            until = None
            for t in times:
                n += 1
                rows.append((f"{day}-{k}", t, n))
                if until is None or t >= until:
                    until = t + timedelta(minutes=90)
                    want.append(n)
        rng.shuffle(rows)
        days.append(rows)
    for rows in days:
        land(spark, src, rows, schema)
    records = stream(spark, src, schema).withWatermark("at", "0 seconds")
    got, q = run(spark, S.first_deliveries(records, F.col("k"), time_column="at"), str(tmp_path / "o"), str(tmp_path / "c"))
    same = defaultdict(int)
    for rows in days:
        for k, t, i in rows:
            same[i] = (k, t)
    # equal times of one key: any of the copies
    assert sorted(same[r.n] for r in got) == sorted(same[i] for i in want)
    assert max(state_rows(q)) <= 40 + 40 and sum(len(d) for d in days) > 400


def test_redelivery_by_processing_time_forgets_and_never_drops_late_records(spark, tmp_path):
    src, schema = str(tmp_path / "q"), "k string, n long"
    out, ck = str(tmp_path / "o"), str(tmp_path / "c")

    def go(rows):
        land(spark, src, rows, schema)
        frame = S.first_deliveries(stream(spark, src, schema), F.col("k"), minutes=5 / 60)
        return sorted(r.n for r in run(spark, frame, out, ck, idle_batches=False)[0])

    assert go([("a", 1), ("b", 2), ("a", 1)]) == [1, 2]
    time.sleep(6)  # the window has passed
    assert go([("a", 3), ("c", 4)]) == [1, 2, 3, 4]


# --- create, wait, append ------------------------------------------------------

FILES, ANSWERS = "audience string, message_id string, key string", "value string"


def answer(audience, attempt, code, audience_id=None):
    return (json.dumps({"request_id": f"{audience}#{attempt}", "code": code, "message": "m",
                        "data": {"audience_id": audience_id}}),)


def converse(spark, tmp_path, steps):
    f, a = str(tmp_path / "f"), str(tmp_path / "a")
    spark.createDataFrame([], FILES).write.json(f)
    spark.createDataFrame([], ANSWERS).write.text(a)
    rows = []
    for kind, step in steps:
        if kind == "files":
            land(spark, f, step, FILES)
        else:
            spark.createDataFrame(step, ANSWERS).coalesce(1).write.mode("append").text(a)
        frame = S.create_then_append(stream(spark, f, FILES), S.create_responses(spark.readStream.text(a)))
        rows, _ = run(spark, frame, str(tmp_path / "o"), str(tmp_path / "c"))
    return rows


def test_files_wait_for_the_answer_and_a_refusal_moves_on(spark, tmp_path):
    rows = converse(spark, tmp_path, [
        ("files", [("x", "u-1", "x/1"), ("x", "u-2", "x/2"), ("x", "u-3", "x/3"), ("y", "u-4", "y/1"), ("z", "u-5", "z/1")]),
        ("answers", [answer("x", 1, 40002), answer("y", 1, 0, "id-y"), ("no json",), answer("w", 1, 0, "id-w")]),
        ("files", [("y", "u-6", "y/2"), ("w", "u-7", "w/1")]),
        ("answers", [answer("x", 2, 0, "id-x"), answer("x", 1, 0, "late"), answer("y", 1, 0, "again")]),
        ("files", [("x", "u-8", "x/4")])])
    by = defaultdict(list)
    for r in rows:
        by[r.audience, r.action].append(r)
    first, second = by["x", "CREATE"]
    assert {first.attempt, second.attempt} == {1, 2} and [r.code for r in by["x", "CREATE_REFUSED"]] == [40002]
    assert len({r.message_id for r in by["x", "CREATE"] + by["x", "APPEND"]}) == 4
    assert [(r.audience_id, r.message_id) for r in by["x", "CREATED"]] == [("id-x", [r for r in by["x", "CREATE"] if r.attempt == 2][0].message_id)]
    assert {r.audience_id for r in by["x", "APPEND"]} == {"id-x"} and len(by["x", "APPEND"]) == 2
    assert [(r.message_id, r.audience_id) for r in by["y", "APPEND"]] == [("u-6", "id-y")]
    assert len(by["z", "CREATE"]) == 1 and not by["z", "CREATED"]
    assert [r.audience_id for r in by["w", "CREATED"]] == ["id-w"]  # the answer came before the request


# --- retries -----------------------------------------------------------------------

def test_retries_against_the_schedule(spark, tmp_path):
    src, schema = str(tmp_path / "q"), "message_id string, key string, at timestamp"
    rng = random.Random(4)
    events, want = [], {}
    for i in range(120):
        received = T0 + timedelta(minutes=rng.randrange(0, 1000))
        delay = rng.choice([None, -30, 0, 1, 15, 16, 45, 46, 300])
        there = None if delay is None else received + timedelta(minutes=delay)
        events.append((f"m-{i}", f"k{i}", received))
        if there is not None:
            events.append((None, f"k{i}", there))
        due = [received + timedelta(minutes=15 * (2 ** k - 1)) for k in range(3)]
        ok = [k for k in range(3) if there is not None and there <= due[k]]
        want[f"m-{i}"] = (ok[0] + 1, S.DELIVER) if ok else (3, S.DEAD)
    events.append((None, "tick", T0 + timedelta(days=9)))
    events.sort(key=lambda e: e[2])
    for lo in range(0, len(events), 60):
        land(spark, src, events[lo:lo + 60], schema)
    s = stream(spark, src, schema)
    frame = S.with_retries(s.where("message_id is not null"), s.where("message_id is null").select("key", "at"), keep_minutes=60)
    rows, q = run(spark, frame, str(tmp_path / "o"), str(tmp_path / "c"))
    assert {r.message_id: (r.attempts, r.outcome) for r in rows} == want and len(rows) == 120


# --- status of landed answers ---------------------------------------------------

@pytest.mark.parametrize("streaming", [True, False])
def test_status_from_landed_answers(spark, tmp_path, streaming):
    at = lambda m: T0 + timedelta(minutes=m)
    sent = [("u-1", "A", "CREATE", at(0)), ("u-2", "A", "APPEND", at(1)), ("u-3", "B", "APPEND", at(2)),
            ("u-4", "B", "ADD_USERS", at(3)), ("u-5", "C", "APPEND", at(4))]
    docs = [{"request_id": "u-1", "code": 0, "message": "OK", "time": "2024-01-01T00:30:00Z"},
            {"request_id": "u-2", "code": 40002, "message": "bad file", "time": "2024-01-01T00:05:00Z"},
            {"request_id": "u-3", "code": 0, "message": "OK", "time": "2024-01-01T03:00:00Z"},  # too late
            {"request_id": "u-4", "code": 0, "message": "OK", "time": "2024-01-01T00:04:00Z"},
            {"request_id": "u-9", "code": 0, "message": "of nobody", "time": "2024-01-01T00:04:00Z"},
            {"code": 1}]
    schema = "message_id string, audience string, action string, sent_at timestamp"
    if streaming:
        # a request and an answer of a later day move both watermarks
        land(spark, str(tmp_path / "s"), sent, schema)
        land(spark, str(tmp_path / "s"), [("tick", "-", "-", at(99999))], schema)
        for ds in (docs, [{"request_id": "tick2", "code": 0, "time": "2024-06-01T00:00:00Z"}]):
            spark.createDataFrame([(json.dumps(d),) for d in ds] + [("{cut",)], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "r"))
        requests = stream(spark, str(tmp_path / "s"), schema)
        answers = responses(spark.readStream.text(str(tmp_path / "r")))
        rows, _ = run(spark, response_status(requests, answers), str(tmp_path / "o"), str(tmp_path / "c"))
    else:
        answers = responses(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"))
        rows = response_status(spark.createDataFrame(sent, schema), answers).collect()
    got = {r.message_id: (r.status_code, r.message) for r in rows if r.message_id != "tick"}
    assert got == {"u-1": (200, "Audience A is successfully created"),
                   "u-2": (40002, "ERROR in uploading audience A: bad file"),
                   "u-3": (400, "ERROR in uploading audience B"), "u-4": (200, "Users sent to segment B"),
                   "u-5": (400, "ERROR in uploading audience C")}
