"""Property tests against plain-Python models."""

import os

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmint.functions.paths import base_name, dir_part, strip_extension
from segmint.operators.reshape import balanced_chunk

# raise for a deeper search, e.g. SEGMINT_EXAMPLES=500
N_EXAMPLES = int(os.environ.get("SEGMINT_EXAMPLES", "30"))


@settings(max_examples=N_EXAMPLES, deadline=None)
@given(st.integers(min_value=1, max_value=5000), st.integers(min_value=1, max_value=700))
def test_balanced_chunk_equals_array_split(spark, n, cap):
    k = -(-n // cap)
    expect = np.concatenate([np.full(len(p), i) for i, p in
                             enumerate(np.array_split(np.arange(n), k))])
    df = spark.range(n).select(balanced_chunk(F.col("id"), F.lit(n), F.lit(k)).alias("c"))
    got = np.array([r.c for r in df.orderBy(F.monotonically_increasing_id()).collect()])
    assert (got == expect).all()


SEGMENT = st.text(alphabet=st.sampled_from("ab/._- 0"), min_size=0, max_size=24)


def _model(key):
    head, tail = os.path.split(key)
    parts = head.split("/")
    return (tail, parts[2] if len(parts) > 2 else None, parts[3] if len(parts) > 3 else None)


@settings(max_examples=N_EXAMPLES, deadline=None)
@given(st.lists(SEGMENT, min_size=1, max_size=12))
def test_key_parts_match_path_split(spark, keys):
    # os.path.split drops trailing slashes of the head; keys with '//' or a
    # trailing '/' in the directory part are not produced by the writers
    keys = [k for k in keys if "//" not in k and not k.startswith("/")]
    if not keys:
        return
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k", base_name(F.col("k")).alias("f"), dir_part(F.col("k"), 2).alias("a"),
        dir_part(F.col("k"), 3).alias("t"), strip_extension(F.col("k")).alias("x"))
    for r in df.collect():
        assert (r.f, r.a, r.t) == _model(r.k), r.k
        assert r.x == os.path.splitext(r.k)[0], r.k


def test_empty_upload_gives_empty_output(spark, tmp_path):
    from segmint.plans.registry import BATCH_SPEC
    from segmint.plans.transform import transform_with_parts
    from segmint.sinks.writers import write_output
    from segmint.sources.audience import scan_jsonl
    src = tmp_path / "empty.json"
    src.write_text("")
    rows, n_parts = transform_with_parts(scan_jsonl(spark, str(src), BATCH_SPEC.read_schema()),
                                         BATCH_SPEC)
    assert n_parts == 0 and rows.count() == 0
    write_output(rows, str(tmp_path / "out"), "batch", "s", num_parts=n_parts)


TEXT = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=16)


@settings(max_examples=N_EXAMPLES, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=15))
def test_decode_key_inverts_quote_plus(spark, keys):
    from urllib.parse import quote_plus, unquote_plus

    from segmint.functions.paths import decode_key
    enc = [quote_plus(k, safe="/") for k in keys]
    df = spark.createDataFrame([(e,) for e in enc], "e string")
    got = [r.d for r in df.select(decode_key(F.col("e")).alias("d")).collect()]
    assert got == [unquote_plus(e) for e in enc] == keys


@settings(max_examples=N_EXAMPLES, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=15))
def test_phone_rule_matches_python(spark, values):
    import re
    import unicodedata

    from segmint.functions.normalize import normalized
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.p for r in df.select(normalized(F.col("v"), "PHONE").alias("p")).collect()]
    expect = []
    for v in values:
        p = re.sub(r"[^0-9]+", "", unicodedata.normalize("NFKD", v).strip()).lstrip("0")
        expect.append(p or None)
    assert got == expect


@settings(max_examples=N_EXAMPLES, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=15))
def test_ad_id_rule_matches_python(spark, values):
    import unicodedata

    from segmint.functions.normalize import normalized
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.p for r in df.select(normalized(F.col("v"), "GAID").alias("p")).collect()]
    expect = [unicodedata.normalize("NFKD", v).strip().lower() or None for v in values]
    assert got == expect
