"""Outputs that are replaced as a whole: a run that fails at any point leaves one whole version."""

import glob
import os

import pytest

from segmint.operators.payloads import audience_bodies, upload_forms, uploaded_paths
from segmint.plans.jobs import run_transform_job
from segmint.plans.transform import read_counts
from segmint.sinks import commits, writers
from segmint.sinks.writers import read_committed, replace_output

ROWS = "segment_name string, schema string, chunk long, row_id long, hash string"


def rows(spark, tag, chunks, schemas=("EMAIL_SHA256", "PHONE_SHA256")):
    return spark.createDataFrame([("s", k, c, i, f"{tag}{c}{i}") for k in schemas for c in range(chunks) for i in range(3)], ROWS)


def seen(spark, root, profile="file", source="up/a b.json"):
    return sorted(r.hash for r in read_committed(spark, root, profile, "s", source).collect())


@pytest.mark.parametrize("profile", ["file", "batch"])
def test_a_failure_before_or_after_the_commit_leaves_a_whole_version(spark, tmp_path, monkeypatch, profile):
    root, kw = str(tmp_path), {"source": "up/a b.json", "schemas": ["EMAIL_SHA256", "PHONE_SHA256"]}
    assert seen(spark, root, profile) == []
    replace_output(rows(spark, "a", 4), root, profile, "s", **kw)
    first = seen(spark, root, profile)
    assert len(first) == 24 and all(h[0] == "a" for h in first)

    def fail(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", fail)  # parts written, never switched
        with pytest.raises(RuntimeError):
            replace_output(rows(spark, "b", 2), root, profile, "s", **kw)
    assert seen(spark, root, profile) == first
    with monkeypatch.context() as m:
        m.setattr(commits, "drop_superseded", fail)  # switched, the old version still there
        with pytest.raises(RuntimeError):
            replace_output(rows(spark, "c", 2), root, profile, "s", **kw)
    assert len(seen(spark, root, profile)) == 12 and all(h[0] == "c" for h in seen(spark, root, profile))
    replace_output(rows(spark, "d", 1), root, profile, "s", **kw)
    assert len(seen(spark, root, profile)) == 6
    # committed versions that were replaced are gone; other uploads are not touched
    left = {p.split("version=")[1].split("/")[0] for p in glob.glob(f"{root}/**/version=*/", recursive=True)}
    assert len(left) == 2  # the current one, and the one that was never committed
    replace_output(rows(spark, "z", 1), root, profile, "s", source="other", schemas=kw["schemas"])
    assert len(seen(spark, root, profile)) == 6 and seen(spark, root, profile, "other")[0][0] == "z"


def test_two_commits_at_once_have_one_winner(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "b")
    commits.commit(spark, base, "u", "one")
    monkeypatch.setattr(commits, "history", lambda *a: ["one"])  # both see one commit
    commits.commit(spark, base, "u", "aa")
    commits.commit(spark, base, "u", "bb")
    monkeypatch.undo()
    assert commits.history(spark, base, "u") == ["one", "aa", "bb"] and commits.current(spark, base, "u") == "bb"


def test_job_counts_rows_per_source_file(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"e-mail":" x@y.z "}\n{"e-mail":"   "}\n{"e-mail":null}\n{"cut\n{"other":1}\n')
    (src / "b.json").write_text('{"e-mail":"b@y.z"}\n')
    run = run_transform_job(spark, str(src), str(tmp_path / "out"), "file", '[{"column_name":"e-mail","pii_type":"EMAIL"}]',
                            "seg", "in.json", runs_path=str(tmp_path / "runs"), counts_path=str(tmp_path / "counts"),
                            read_mode="PERMISSIVE")
    assert (run["ValuesAccepted"], run["ValuesDropped"]) == (2, 4)
    got = {os.path.basename(r.source_file): (r.records, r.accepted, r.no_value, r.empty, r.malformed)
           for r in read_counts(spark, f"{tmp_path}/counts/run={run['Id']}").collect()}
    assert got == {"a.json": (5, 1, 2, 1, 1), "b.json": (1, 1, 0, 0, 0)}
    assert spark.read.json(str(tmp_path / "runs")).first().ValuesAccepted == 2


def test_file_profile_forms_and_bodies(spark):
    sent = spark.createDataFrame(
        [("m1", "k1", "file", "A \"q\"", "EMAIL_SHA256", None, "CREATE", " sig "), ("m2", "k2", "file", "B", "GAID_SHA256", "77", "APPEND", "s"),
         ("m3", "k3", "file", "C", "GAID_SHA256", None, "APPEND", "s"), ("m4", "k4", "file", "D", "GAID_SHA256", "1", "APPEND", "s"),
         ("m5", "k5", "batch", "E", None, "1", "ADD_USERS", None)],
        "message_id string, key string, profile string, audience string, calculate_type string, audience_id string, action string, file_signature string")
    docs = spark.createDataFrame([(d,) for d in (
        '{"request_id":"m1","code":0,"message":"OK","data":{"file_path":"p/1"}}', '{"request_id":"m2","code":0,"data":{"file_path":"p/2"}}',
        '{"request_id":"m3","code":0,"data":{"file_path":"p/3"}}', '{"request_id":"m4","code":40002,"message":"bad"}',
        '{"request_id":"m5","code":0,"data":{"file_path":"p/5"}}', "{cut")], "value string")
    got = {r.message_id: r.body for r in audience_bodies(sent, uploaded_paths(docs), "9").collect()}
    assert got == {"m1": '{"advertiser_id":"9","file_paths":["p/1"],"custom_audience_name":"A \\"q\\"","calculate_type":"EMAIL_SHA256"}',
                   "m2": '{"action":"APPEND","advertiser_id":"9","file_paths":["p/2"],"custom_audience_id":"77"}'}
    forms = {r.message_id: r.form for r in upload_forms(sent.where("profile = 'file'"), "9").collect()}
    assert forms["m1"] == '{"advertiser_id":"9","file_signature":"sig","calculate_type":"EMAIL_SHA256"}' and len(forms) == 4
