import gzip
import os

from segmint.plans.jobs import run_transform_job
from segmint.sources.discovery import job_runs
from segmint.sources.audience import scan_hash_csv

# fixed fixture values: two sample records and their mapping
FX1_LINES = [
    '{"age":35,"e-mail":" fake_email@doesnotexist.com ","phone_number":"(123)-123-1234",'
    '"mobile_advertiser_id":" 918F1D4F-D195-4A8B-AF47-44683FE11DB9 "}',
    '{"age":39,"e-mail":" fake_email@doesnotexist.com ","phone_number":"(123)-123-1234",'
    '"mobile_advertiser_id":" 918F1D4F-D195-4A8B-AF47-44683FE11DB9 "}',
]
MAPPING = ('[{"column_name":"e-mail","pii_type":"EMAIL"},'
           '{"column_name":"phone_number","pii_type":"PHONE"},'
           '{"column_name":"mobile_advertiser_id","pii_type":"MOBILE_AD_ID"}]')


def test_batch_job_end_to_end(spark, tmp_path):
    src = tmp_path / "in" / "mydata.json"
    src.parent.mkdir()
    src.write_text("\n".join(FX1_LINES) + "\n")
    out, runs = str(tmp_path / "out"), str(tmp_path / "runs")
    run = run_transform_job(spark, str(src), out, "batch", MAPPING, "myaudience",
                            "mydata.json", runs_path=runs)
    assert run["JobRunState"] == "SUCCEEDED" and run["n_parts"] == 1
    rows = scan_hash_csv(spark, f"{out}/output/batch/myaudience/*/*/*.csv.gz").orderBy("row_id").collect()
    # column-major, in mapping order
    assert [r.schema for r in rows] == (
        ["EMAIL_SHA256"] * 2 + ["PHONE_SHA256"] * 2 + ["MOBILE_AD_ID_SHA256"] * 2)
    assert [r.row_id for r in rows] == list(range(6))
    assert {r.segment_name for r in rows} == {"myaudience"}
    files = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.endswith(".gz")]
    with gzip.open(files[0], "rt") as fh:
        assert fh.readline().strip() == "row_id,schema,hash,segment_name"
    hist = job_runs(spark, runs).collect()
    assert len(hist) == 1 and hist[0].SegmentName == "myaudience"
    # re-running the same upload replaces its parts instead of duplicating them
    run_transform_job(spark, str(src), out, "batch", MAPPING, "myaudience", "mydata.json")
    again = scan_hash_csv(spark, f"{out}/output/batch/myaudience/*/*/*.csv.gz").count()
    assert again == len(rows)


def test_file_job_headerless_parts(spark, tmp_path):
    src = tmp_path / "mydata.json"
    src.write_text("\n".join(FX1_LINES) + "\n")
    out = str(tmp_path / "out")
    run_transform_job(spark, str(src), out, "file", MAPPING.replace("MOBILE_AD_ID", "GAID"),
                      "myaudience", "mydata.json")
    parts = sorted(d for d, _, fs in os.walk(out) if any(f.endswith(".csv") for f in fs))
    assert len(parts) == 3  # one part per identifier kind
    for d in parts:
        body = "".join(open(os.path.join(d, f)).read() for f in os.listdir(d) if f.endswith(".csv"))
        lines = body.splitlines()
        assert len(lines) == 2 and all(len(x) == 64 for x in lines)


def test_manifest_and_object_metadata(spark, tmp_path):
    from segmint.sources.discovery import file_manifest, object_metadata
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("{}\n")
    (tmp_path / "y.csv").write_text("h\n1\n")
    rows = {r.key: r for r in file_manifest(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a/x.json", "y.csv"} and rows["y.csv"].size == 4
    assert "T" in rows["y.csv"].last_modified
    one = object_metadata(spark, str(tmp_path), "a/x.json").collect()
    assert len(one) == 1 and one[0].size == 3


def test_cli_transform_list_columns_runs(spark, tmp_path, capsys):
    from segmint.cli import main
    src = tmp_path / "mydata.json"
    src.write_text("\n".join(FX1_LINES) + "\n")
    out, runs = str(tmp_path / "out"), str(tmp_path / "runs")
    assert main(["transform", "--source", str(src), "--output", out, "--profile", "batch",
                 "--pii-fields", MAPPING, "--segment-name", "myaudience", "--runs", runs]) == 0
    assert '"JobRunState": "SUCCEEDED"' in capsys.readouterr().out
    main(["list", "--root", out])
    listed = capsys.readouterr().out
    assert "output/batch/myaudience/source=mydata.json/chunk=0/" in listed and ".csv.gz" in listed
    main(["list", "--root", str(tmp_path), "--key", "mydata.json"])
    one = capsys.readouterr().out.strip().splitlines()
    assert len(one) == 1 and '"key": "mydata.json"' in one[0]
    main(["columns", "--path", str(src)])
    cols = capsys.readouterr().out
    assert '"column_name": "e-mail"' in cols and '"n_records": 2' in cols
    main(["runs", "--path", runs])
    assert '"SegmentName": "myaudience"' in capsys.readouterr().out


def test_cli_activate(spark, tmp_path):
    from segmint.cli import main
    from segmint.plans.derived import audience_pages_dir, queue_dir, segment_pages_dir
    from segmint.streaming.activation_stream import read_dead_letters, read_outbox
    from tests.conftest import SF_SMALL
    out = str(tmp_path / "act")
    assert main(["activate", "--queue", queue_dir(spark, SF_SMALL),
                 "--audiences", audience_pages_dir(spark, SF_SMALL),
                 "--segments", segment_pages_dir(spark, SF_SMALL),
                 "--out", out, "--checkpoint", str(tmp_path / "ck"),
                 "--max-files-per-trigger", "4"]) == 0
    n_out, n_dead = read_outbox(spark, out).count(), read_dead_letters(spark, out).count()
    n_in = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    # exactly the records that the default rule lets through, and the malformed ones
    from segmint.operators import activation as A
    queue = spark.read.schema(A.QUEUE_SCHEMA).json(queue_dir(spark, SF_SMALL))
    recs = A.parse_records(queue)
    relevant = recs.where(A.EventRule().fits() | recs.malformed).count()
    assert n_out > 0 and n_dead > 0 and n_out + n_dead == relevant < n_in


def test_malformed_line_fails_unless_permissive(spark, tmp_path):
    import pytest
    from segmint.plans.transform import transform
    from segmint.spec import AudienceSpec
    src = tmp_path / "bad.json"
    src.write_text(FX1_LINES[0] + "\n{not json\n" + FX1_LINES[1] + "\n")
    spec = AudienceSpec.from_args("batch", MAPPING, "s")
    with pytest.raises(Exception, match="(?i)malformed"):
        transform(spark, str(src), spec).count()
    lenient = AudienceSpec.from_args("batch", MAPPING, "s", read_mode="PERMISSIVE")
    assert transform(spark, str(src), lenient).count() == 6


def _upload(path, n, start=0):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f'{{"e-mail":"u{i}@example.com"}}\n' for i in range(start, start + n)))
    return str(path)


MAIL = '[{"column_name":"e-mail","pii_type":"EMAIL"}]'


def test_a_smaller_rerun_replaces_the_whole_upload(spark, tmp_path, monkeypatch):
    from segmint import spec as S
    out = str(tmp_path / "out")
    for profile, attr, cap in (("batch", "BATCH_CAP_ROWS", 100), ("file", "FILE_CAP_BYTES", 6500)):
        monkeypatch.setattr(S, attr, cap)
        glob = f"{out}/output/{profile}/seg" + ("/schema=*" if profile == "file" else "") + "/source=*/chunk=*"
        for n, chunks in ((950, 10), (120, 2)):
            src = _upload(tmp_path / f"{profile}.json", n)
            run = run_transform_job(spark, src, out, profile, MAIL, "seg", "a/up.json")
            assert run["n_parts"] == chunks
            rows = spark.read.option("header", profile == "batch").csv(glob).count()
            assert rows == n, (profile, n)


def test_a_kind_that_is_no_longer_mapped_goes(spark, tmp_path):
    src = tmp_path / "up.json"
    src.write_text("\n".join(FX1_LINES) + "\n")
    out = str(tmp_path / "out")
    run_transform_job(spark, str(src), out, "file", MAPPING.replace("MOBILE_AD_ID", "GAID"), "seg", "up.json")
    run_transform_job(spark, str(src), out, "file", MAIL, "seg", "up.json")
    left = [d for d, _, fs in os.walk(out) if any(f.endswith(".csv") for f in fs)]
    assert len(left) == 1 and "schema=EMAIL_SHA256" in left[0]


def test_uploads_of_one_base_name_stay_apart(spark, tmp_path):
    out = str(tmp_path / "out")
    for k, n in (("a", 5), ("b", 3)):
        run_transform_job(spark, _upload(tmp_path / k / "contacts.json", n, 10 * n), out, "batch", MAIL, "seg",
                          f"{k}/contacts.json")
    assert scan_hash_csv(spark, f"{out}/output/batch/seg/*/*/*.csv.gz").count() == 8


def test_cli_lists_everything(spark, tmp_path, capsys):
    from segmint.cli import main
    for i in range(1100):
        (tmp_path / "many" / f"{i % 7}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "many" / f"{i % 7}" / f"{i}.txt").write_text("x")
    main(["list", "--root", str(tmp_path / "many")])
    assert len(capsys.readouterr().out.strip().splitlines()) == 1100
    main(["list", "--root", str(tmp_path / "many"), "--limit", "3"])
    assert len(capsys.readouterr().out.strip().splitlines()) == 3
