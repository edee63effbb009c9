"""Streaming activation: replay within a run and across a restart from the
checkpoint never reaches the outbox twice; bad records go to dead letters."""

import json

from segmint.operators import activation as A
from segmint.streaming.activation_stream import (read_dead_letters, read_outbox,
                                                 start_activation_stream)

BUCKET = "uploader-etl-artifacts-x"


def _records(keys, start=0):
    out = []
    for i, key in enumerate(keys, start=start):
        body = {"source": A.EVENT_SOURCE, "detail-type": A.EVENT_DETAIL_TYPE,
                "detail": {"bucket": {"name": BUCKET}, "object": {"key": key, "size": 650}}}
        out.append({"messageId": str(i), "body": json.dumps(body)})
    return out


def _with_etag(recs, etag):
    out = []
    for r in recs:
        body = json.loads(r["body"])
        body["detail"]["object"]["etag"] = etag
        out.append({"messageId": r["messageId"], "body": json.dumps(body)})
    return out


def _land(spark, path, recs):
    spark.createDataFrame(recs, A.QUEUE_SCHEMA).coalesce(1).write.mode("append").json(path)


def _catalogues(spark):
    aud = spark.createDataFrame([("known", 5, 1, 0)],
                                "name string, audience_id long, page long, position long")
    seg = spark.createDataFrame([("seg one", 2, 0, 0)],
                                "name string, id long, page long, position long")
    return aud, seg


def _run(spark, src, out, ckpt, **kw):
    aud, seg = _catalogues(spark)
    q = start_activation_stream(spark, src, aud, seg, out, ckpt, max_files_per_trigger=1, **kw)
    q.awaitTermination()


def test_replay_and_restart(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    keys = ["output/file/known/EMAIL_SHA256/a.csv", "output/file/new/phone_sha256/b.csv",
            "output/batch/seg+one/c.csv.gz", "output/batch/seg+one/d.csv",
            "output/e.csv"]
    _land(spark, src, _records(keys))
    _land(spark, src, _records(keys[:3]))          # redelivered in a later file
    _run(spark, src, out, ckpt)
    ob = {r.key: r for r in read_outbox(spark, out).collect()}
    assert set(ob) == {"output/file/known/EMAIL_SHA256/a.csv", "output/file/new/phone_sha256/b.csv",
                       "output/batch/seg one/c.csv.gz"}
    assert ob["output/file/known/EMAIL_SHA256/a.csv"].action == "APPEND"
    assert ob["output/file/new/phone_sha256/b.csv"].action == "CREATE"
    assert ob["output/batch/seg one/c.csv.gz"].segment_id == 2
    dl = {r.key: r.reason for r in read_dead_letters(spark, out).collect()}
    assert dl == {"output/batch/seg one/d.csv": "UNSUPPORTED_FILE", "output/e.csv": "BAD_KEY"}
    # restart from the checkpoint: old objects again plus one new object
    _land(spark, src, _records(keys[:2] + ["output/file/known/GAID_SHA256/f.csv"], start=100))
    _run(spark, src, out, ckpt)
    keys_after = [r.key for r in read_outbox(spark, out).collect()]
    assert len(keys_after) == len(set(keys_after)) == 4


def test_stream_delivery_payloads_signatures_and_missing(spark, tmp_path):
    import gzip
    import hashlib
    import os

    from segmint.streaming.activation_stream import read_payloads
    root = tmp_path / "bucket"
    bdir = root / "output" / "batch" / "seg one" / "chunk=0"
    bdir.mkdir(parents=True)
    with gzip.open(bdir / "p.csv.gz", "wt") as fh:
        fh.write("row_id,schema,hash,segment_name\n0,EMAIL_SHA256,h1,seg one\n"
                 "1,PHONE_SHA256,h2,seg one\n")
    fdir = root / "output" / "file" / "known" / "schema=EMAIL_SHA256" / "chunk=0"
    fdir.mkdir(parents=True)
    (fdir / "p.csv").write_text("h1\nh2\n")
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    _land(spark, src, _records(["output/batch/seg+one/chunk=0/p.csv.gz",
                                "output/file/known/schema=EMAIL_SHA256/chunk=0/p.csv"]))
    _land(spark, src, _records(["output/batch/seg+one/chunk=0/missing.csv.gz"], start=10))
    aud, seg = _catalogues(spark)
    q = start_activation_stream(spark, src, aud, seg, out, ckpt, max_files_per_trigger=1,
                                files_root=str(root))
    q.awaitTermination()
    pay = {r.schema: r.n_users for r in read_payloads(spark, out).collect()}
    assert pay == {"EMAIL_SHA256": 1, "PHONE_SHA256": 1}
    ob = {r.key: r for r in read_outbox(spark, out).collect()}
    f = ob["output/file/known/schema=EMAIL_SHA256/chunk=0/p.csv"]
    assert f.calculate_type == "EMAIL_SHA256" and f.action == "APPEND"
    assert f.file_signature == hashlib.md5(b"h1\nh2\n").hexdigest()
    assert "output/batch/seg one/chunk=0/missing.csv.gz" not in ob
    dl = {r.key: r.reason for r in read_dead_letters(spark, out).collect()}
    assert dl == {"output/batch/seg one/chunk=0/missing.csv.gz": "OBJECT_NOT_READABLE"}
    assert os.path.isdir(out)


def test_watermarked_dedupe_option(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    recs = _records(["output/file/known/EMAIL_SHA256/a.csv", "output/file/new/gaid_sha256/b.csv"])
    for r in recs:
        body = json.loads(r["body"])
        body["time"] = "2024-01-01T00:00:00Z"
        r["body"] = json.dumps(body)
    _land(spark, src, recs)
    _land(spark, src, recs)  # redelivered
    aud, seg = _catalogues(spark)
    q = start_activation_stream(spark, src, aud, seg, out, ckpt, max_files_per_trigger=1,
                                dedupe_watermark="1 day")
    q.awaitTermination()
    assert sorted(r.key for r in read_outbox(spark, out).collect()) == [
        "output/file/known/EMAIL_SHA256/a.csv", "output/file/new/gaid_sha256/b.csv"]


def test_new_version_malformed_body_and_second_batch_of_a_new_audience(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    key = "output/file/new/EMAIL_SHA256/a.csv"
    _land(spark, src, _with_etag(_records([key]), "v1"))
    _land(spark, src, [{"messageId": "90", "body": "{cut"}, {"messageId": "91", "body": "{cut"}])
    _run(spark, src, out, ckpt)
    _land(spark, src, _with_etag(_records([key], start=1), "v1"))   # redelivered
    _land(spark, src, _with_etag(_records([key], start=2), "v2"))   # uploaded again
    _land(spark, src, _with_etag(_records(["output/file/new/PHONE_SHA256/b.csv"], start=3), "v1"))
    _run(spark, src, out, ckpt)
    got = sorted((int(r.message_id), r.action) for r in read_outbox(spark, out).collect())
    assert got == [(0, "CREATE"), (2, "APPEND"), (3, "APPEND")]
    dead = sorted((int(r.message_id), r.reason) for r in read_dead_letters(spark, out).collect())
    assert dead == [(90, "BAD_BODY"), (91, "BAD_BODY")]


def test_mixed_batch_dead_letters_only_the_missing_object(spark, tmp_path):
    from segmint.streaming.activation_stream import read_payloads
    root = tmp_path / "bucket"
    fdir = root / "output" / "file" / "known" / "schema=EMAIL_SHA256"
    fdir.mkdir(parents=True)
    (fdir / "p.csv").write_text("h1\n")
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    _land(spark, src, _records(["output/file/known/schema=EMAIL_SHA256/p.csv",
                                "output/file/known/schema=EMAIL_SHA256/gone.csv"]))
    aud, seg = _catalogues(spark)
    start_activation_stream(spark, src, lambda: aud, lambda: seg, out, ckpt, files_root=str(root)).awaitTermination()
    assert [r.key for r in read_outbox(spark, out).collect()] == ["output/file/known/schema=EMAIL_SHA256/p.csv"]
    assert [(r.key, r.reason) for r in read_dead_letters(spark, out).collect()] == [
        ("output/file/known/schema=EMAIL_SHA256/gone.csv", "OBJECT_NOT_READABLE")]
    assert read_payloads(spark, out).count() == 0


def test_readers_of_a_job_that_wrote_nothing(spark, tmp_path):
    assert read_outbox(spark, str(tmp_path)).count() == 0
    assert read_dead_letters(spark, str(tmp_path)).count() == 0


def test_text_message_ids_and_creation_by_the_first_deliverable_record(spark, tmp_path):
    """The first record of a new audience names a missing object: the next one creates the audience."""
    import uuid
    root = tmp_path / "bucket"
    fdir = root / "output" / "file" / "fresh" / "schema=EMAIL_SHA256"
    fdir.mkdir(parents=True)
    for name in "bc":
        (fdir / f"{name}.csv").write_text(f"{name}\n")
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    recs = _records([f"output/file/fresh/schema=EMAIL_SHA256/{name}.csv" for name in "abc"])
    for r, u in zip(recs, sorted(str(uuid.UUID(int=i * 7 + 10**36)) for i in range(3))):
        r["messageId"] = u
    _land(spark, src, recs[:2])
    aud, seg = _catalogues(spark)
    start_activation_stream(spark, src, aud, seg, out, ckpt, files_root=str(root)).awaitTermination()
    _land(spark, src, recs[2:])
    start_activation_stream(spark, src, aud, seg, out, ckpt, files_root=str(root)).awaitTermination()
    assert sorted((r.message_id, r.action) for r in read_outbox(spark, out).collect()) == [
        (recs[1]["messageId"], "CREATE"), (recs[2]["messageId"], "APPEND")]
    assert [(r.message_id, r.reason) for r in read_dead_letters(spark, out).collect()] == [
        (recs[0]["messageId"], "OBJECT_NOT_READABLE")]
    assert [r.audience for r in spark.read.parquet(f"{out}/created").collect()] == ["fresh"]


def test_redelivery_window_option(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "q"), str(tmp_path / "out"), str(tmp_path / "ck")
    keys = ["output/file/known/EMAIL_SHA256/a.csv", "output/file/known/GAID_SHA256/b.csv"]
    _land(spark, src, _records(keys))
    _land(spark, src, _records(keys))
    _run(spark, src, out, ckpt, redelivery_minutes=90)
    _land(spark, src, _records(keys[:1], start=7))
    _run(spark, src, out, ckpt, redelivery_minutes=90)
    assert sorted(r.key for r in read_outbox(spark, out).collect()) == sorted(keys)
