import hashlib
import os
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmint.functions.hashing import hashed
from segmint.functions.normalize import clean_text, nfkd, normalized, strip
from segmint.functions.paths import (base_name, chunk_suffix, dir_part, split_hash_list,
                                     strip_extension)

FX1 = (" fake_email@doesnotexist.com ", "(123)-123-1234", " 918F1D4F-D195-4A8B-AF47-44683FE11DB9 ")


def one(spark, col_expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col_expr(F.col("v")).alias("o")).first()["o"]


def test_fx1_normalisation(spark):
    email, phone, ad = FX1
    assert one(spark, lambda c: normalized(c, "EMAIL"), email) == "fake_email@doesnotexist.com"
    assert one(spark, lambda c: normalized(c, "PHONE"), phone) == "1231231234"
    assert one(spark, lambda c: normalized(c, "GAID"), ad) == "918f1d4f-d195-4a8b-af47-44683fe11db9"


def test_fx1_hashes_match_python(spark):
    for value, kind, expect in zip(FX1, ("EMAIL", "PHONE", "MOBILE_AD_ID"),
                                   ("fake_email@doesnotexist.com", "1231231234",
                                    "918f1d4f-d195-4a8b-af47-44683fe11db9")):
        got = one(spark, lambda c: hashed(c, kind), value)
        assert got == hashlib.sha256(expect.encode()).hexdigest()
        assert len(got) == 64 and got == got.lower()


def test_email_not_lowercased_by_default(spark):
    assert one(spark, lambda c: normalized(c, "EMAIL"), " A@B.COM ") == "A@B.COM"
    assert one(spark, lambda c: normalized(c, "EMAIL", lowercase_email=True), " A@B.COM ") == "a@b.com"


def test_unicode_cases(spark):
    cases = {"ﬁle": "file", "０４": "04", " x ": " x ", "İ": "İ",
             "café": "café", "plain": "plain"}
    rows = [(k,) for k in cases]
    df = spark.createDataFrame(rows, "v string").select("v", nfkd(F.col("v")).alias("o"))
    got = {r.v: r.o for r in df.collect()}
    assert got == cases


def test_phone_fullwidth_digits(spark):
    assert one(spark, lambda c: normalized(c, "PHONE"), "０４５-555") == "45555"


def test_null_policies(spark):
    assert one(spark, lambda c: normalized(c, "PHONE"), None) is None
    assert one(spark, lambda c: normalized(c, "PHONE"), "n/a") is None
    assert one(spark, lambda c: normalized(c, "PHONE", "literal"), "n/a") == ""
    assert one(spark, lambda c: normalized(c, "EMAIL", "literal"), None) == "None"


WHITESPACE = [chr(i) for i in range(0x3100) if chr(i).isspace()]


def test_strip_equals_python_strip(spark):
    rows = [(w + "a" + w + "b" + w,) for w in WHITESPACE] + [("".join(WHITESPACE) + "x",)]
    df = spark.createDataFrame(rows, "v string").select("v", strip(F.col("v")).alias("o"))
    for r in df.collect():
        assert r.o == r.v.strip()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)),
                        max_size=12), min_size=1, max_size=20))
def test_clean_text_matches_python_and_is_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select("v", clean_text(F.col("v")).alias("o"),
                    normalized(F.col("v"), "PHONE").alias("p")).collect()
    for r in out:
        assert r.o == unicodedata.normalize("NFKD", r.v).strip()
        if r.p is not None:
            assert r.p.isdigit() and r.p.isascii() and not r.p.startswith("0")
    again = spark.createDataFrame([(r.o,) for r in out], "v string").select(
        clean_text(F.col("v")).alias("o")).collect()
    assert [r.o for r in again] == [r.o for r in out]


def test_strip_extension_matches_splitext(spark):
    keys = ["mydata.json", "a/b/c.csv.gz", ".hidden", "a/.hidden", "noext", "a.b/c", "a/b.",
            "..x", "dir/..x.y", "x.tar.gz"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.o for r in df.select("k", strip_extension(F.col("k")).alias("o")).collect()}
    assert got == {k: os.path.splitext(k)[0] for k in keys}


def test_key_parts_fx9(spark):
    df = spark.createDataFrame([("test1/test2/test3/PHONE_SHA256/test4.zip",), ("test1/test4.zip",)],
                               "k string")
    rows = df.select(base_name(F.col("k")).alias("f"), dir_part(F.col("k"), 3).alias("t"),
                     dir_part(F.col("k"), 2).alias("a")).collect()
    assert (rows[0].f, rows[0].t, rows[0].a) == ("test4.zip", "PHONE_SHA256", "test3")
    assert rows[1].a is None and rows[1].t is None


def test_hash_lists_fx8(spark):
    df = spark.createDataFrame([("a, b, c",), ("f",)], "h string")
    assert [r.l for r in df.select(split_hash_list(F.col("h")).alias("l")).collect()] == [
        ["a", "b", "c"], ["f"]]


def test_chunk_suffix_padding(spark):
    df = spark.createDataFrame([(0, 1), (8, 12), (11, 12), (99, 100)], "c long, n long")
    got = [r.s for r in df.select(chunk_suffix(F.col("c"), F.col("n")).alias("s")).collect()]
    assert got == ["1", "09", "12", "100"]
