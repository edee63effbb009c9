"""Every registered query against its DuckDB oracle at sf0.01 (rows-only
queries: they must run and return rows)."""

import pytest

from segmint.plans.compare import compare
from segmint.plans.registry import ORACLE, QUERIES

from .conftest import SF_ORACLE


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, SF_ORACLE, QUERIES, ORACLE)
    if name in ORACLE:
        assert res["status"] == "match", res
    else:
        assert res["spark_rows"] > 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 3
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nfkd_query_against_brute_force(spark):
    """The rows-only NFKD query equals Python's unicodedata on whole texts."""
    import hashlib
    import unicodedata

    import pyarrow.parquet as pq

    from .conftest import SF_SMALL
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expect = {}
    for d in docs:
        t = unicodedata.normalize("NFKD", d["text"]) if d["text"] is not None else None
        expect[d["doc_id"]] = (hashlib.sha256(t.encode()).hexdigest() if t is not None else None,
                               len(t) if t is not None else None)
    got = {r.doc_id: (r.text_sha256, r.n_chars_nfkd)
           for r in QUERIES["nfkd"](spark, SF_SMALL).collect()}
    assert got == expect


def test_manifest_against_os_stat(spark):
    """The listing equals a plain os.stat walk of the folder, sorted as asked."""
    import os
    from datetime import datetime, timezone

    from segmint.sources.discovery import file_manifest, sorted_manifest

    from .conftest import SF_SMALL
    names = sorted(n for n in os.listdir(SF_SMALL) if n.endswith(".parquet"))
    stat = {n: os.stat(os.path.join(SF_SMALL, n)) for n in names}
    manifest = file_manifest(spark, SF_SMALL, "*.parquet")
    rows = {r.key: r for r in manifest.collect()}
    assert sorted(rows) == names
    for n in names:
        assert rows[n].size == stat[n].st_size
        mtime = datetime.fromtimestamp(stat[n].st_mtime, tz=timezone.utc)
        assert rows[n].last_modified.startswith(mtime.strftime("%Y-%m-%dT%H:%M:%S"))
    ordered = [r.key for r in sorted_manifest(manifest, "size").collect()]
    assert ordered == sorted(names, key=lambda n: (-stat[n].st_size, n))
    sizes = [r.size for r in QUERIES["manifest_sorted"](spark, SF_SMALL).collect()]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) > 1
