"""Listings in tasks against os.walk, and differences of two listings."""

import os

from segmint.sources import listing as L


def walked(root):
    return {os.path.relpath(os.path.join(d, f), root): os.path.getsize(os.path.join(d, f))
            for d, _, names in os.walk(root) for f in names}


def test_listing_equals_a_walk(spark, tmp_path):
    for i in range(60):
        d = tmp_path / f"a{i % 4}" / f"b={i % 7} x" / ("c" * (i % 3 + 1))
        d.mkdir(parents=True, exist_ok=True)
        (d / f"f{i}é.csv").write_bytes(b"x" * i)
    (tmp_path / "top.txt").write_text("t")
    want = walked(tmp_path)
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / ".hidden").mkdir()
    (tmp_path / "empty").mkdir()
    for root in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}/"):
        assert {r.key: r["size"] for r in L.list_objects(spark, root).collect()} == want
    assert L.list_objects(spark, str(tmp_path / "nowhere")).count() == 0
    keys = spark.createDataFrame([(k,) for k in [*want, *want, "a0/none.csv", "a0", None]], "key string")
    assert {r.key: r["size"] for r in L.present_objects(keys, str(tmp_path)).collect()} == want


def test_difference_of_snapshots(spark, tmp_path):
    root = tmp_path / "root"
    for name in "abcd":
        (root / name).mkdir(parents=True)
        (root / name / "f").write_text(name)
    before = L.snapshot(spark, str(root), str(tmp_path / "s1"))
    (root / "b" / "f").write_text("longer")
    os.utime(root / "c" / "f", (1, 1))
    os.rename(root / "d" / "f", tmp_path / "d")
    (root / "e").mkdir()
    (root / "e" / "f").write_text("e")
    after = L.snapshot(spark, str(root), str(tmp_path / "s2"))
    got = {r.key: (r.status, r["size"]) for r in L.manifest_diff(before, after).collect()}
    assert got == {"b/f": ("changed", 6), "c/f": ("changed", 1), "d/f": ("gone", 1), "e/f": ("new", 1)}
    assert L.manifest_diff(after, L.read_snapshot(spark, str(tmp_path / "s2"))).count() == 0
