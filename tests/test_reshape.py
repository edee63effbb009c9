import numpy as np
from pyspark.sql import functions as F
import pytest

from segmint.operators.reshape import (balanced_split, melt_by_branches, tag_source_order,
                                       with_file_order_index)


@pytest.mark.parametrize("n,cap", [(1, 1), (10, 3), (11, 4), (1000, 7), (999, 1000), (2501, 100)])
def test_balanced_chunk_matches_array_split(spark, n, cap, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(n).repartition(5).sortWithinPartitions("id").write.json(path)
    scan = tag_source_order(spark.read.schema("id long").json(path))
    idx = with_file_order_index(scan, index_name="row_id")
    out = balanced_split(idx, cap).select("row_id", "chunk", "n_parts").collect()
    k = -(-n // cap)
    sizes = [len(p) for p in np.array_split(np.arange(n), k)]
    got = np.bincount([r.chunk for r in out], minlength=k).tolist()
    assert got == sizes and max(got) <= cap
    assert sorted(r.row_id for r in out) == list(range(n))
    # contiguity: chunk is non-decreasing along row_id
    by_row = sorted(out, key=lambda r: r.row_id)
    assert all(a.chunk <= b.chunk for a, b in zip(by_row, by_row[1:]))


def test_file_order_index_follows_files_and_offsets(spark, tmp_path):
    path = str(tmp_path / "ordered")
    spark.range(5000).repartitionByRange(6, "id").sortWithinPartitions("id").write.json(path)
    for max_bytes in ("4096", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", max_bytes)
        scan = tag_source_order(spark.read.schema("id long").json(path))
        rows = with_file_order_index(scan, index_name="row_id").select("id", "row_id").collect()
        assert all(r.id == r.row_id for r in rows), max_bytes
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_column_major_melt_with_nulls(spark, tmp_path):
    path = str(tmp_path / "wide")
    data = [(i, None if i % 3 == 0 else f"a{i}", f"b{i}") for i in range(50)]
    spark.createDataFrame(data, "id long, a string, b string").coalesce(2).write.json(path)
    scan = tag_source_order(spark.read.schema("id long, a string, b string").json(path))
    long = melt_by_branches(scan, [("a", "A"), ("b", "B")], keep=["__split_file", "__split_start"])
    rows = with_file_order_index(long, index_name="row_id").orderBy("row_id").collect()
    n_a = sum(1 for d in data if d[1] is not None)
    assert [r.schema for r in rows] == ["A"] * n_a + ["B"] * 50
    assert len(rows) == n_a + 50


def test_index_on_in_memory_frame_follows_partition_order(spark):
    df = spark.range(0, 997, numPartitions=7).withColumn("v", F.col("id").cast("string"))
    tagged = tag_source_order(df)  # no files: empty name, block start -1
    long = melt_by_branches(tagged, [("v", "V")], keep=["id", "__split_file", "__split_start"])
    rows = with_file_order_index(long, index_name="row_id").select("id", "row_id").collect()
    assert all(r.id == r.row_id for r in rows) and len(rows) == 997


def test_prefix_offsets_distributed_matches_cumsum(spark):
    from segmint.operators.reshape import prefix_offsets
    rows = [(i % 3, f"f{i // 7:04d}", i, (i * 37) % 11 + 1) for i in range(500)]
    df = spark.createDataFrame(rows, "o int, f string, s long, n long").checkpoint(eager=True)
    got = {(r.o, r.f, r.s): r.off for r in
           prefix_offsets(df, ["o", "f", "s"], n_col="n", out_col="off",
                          rows_per_bucket=37).collect()}
    expect, acc = {}, 0
    for o, f, s_, n in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        expect[(o, f, s_)] = acc
        acc += n
    assert got == expect


def test_index_with_many_splits_and_small_buckets(spark, tmp_path, monkeypatch):
    import segmint.operators.reshape as R
    path = str(tmp_path / "many")
    spark.range(3000).repartitionByRange(12, "id").sortWithinPartitions("id").write.json(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        orig = R.prefix_offsets
        monkeypatch.setattr(R, "prefix_offsets",
                            lambda c, o, **kw: orig(c, o, rows_per_bucket=5, **kw))
        scan = tag_source_order(spark.read.schema("id long").json(path))
        rows = with_file_order_index(scan, index_name="row_id").select("id", "row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.id == r.row_id for r in rows) and len(rows) == 3000
