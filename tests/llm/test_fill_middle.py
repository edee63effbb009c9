"""Fill-in-the-middle against brute force, and its wavelet matrix against plain counting."""

import hashlib
import random
import re

import numpy as np
import pytest

from segmint.llm import fill_middle as M
from segmint.llm import registry as R
from segmint.plans.compare import compare
from tests.conftest import SF_ORACLE


def test_query_matches_sql(llm):
    assert compare(llm, "op11_fill_in_middle", SF_ORACLE, R.QUERIES, R.ORACLE)["status"] == "match"


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 4096])
def test_ranks_and_places_equal_counting(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 5, n).astype(np.uint8)
    m = M.WaveletMatrix(x, 3)
    lo = rng.integers(0, n + 1, 200)
    hi = np.minimum(n, lo + rng.integers(0, n + 1, 200))
    for first in range(5):
        for last in range(first, 5):
            hit = (x >= first) & (x <= last)
            assert m.count(first, last, lo, hi).tolist() == [int(hit[a:b].sum()) for a, b in zip(lo, hi)]
            k = rng.integers(0, 9, 200)
            for a, b, c, p in zip(lo, hi, k, m.place(first, last, lo, hi, k)):
                assert a <= p <= b and hit[a:p].sum() <= c and (p == b or hit[a:p + 1].sum() > c)


def units(text, unit):
    """The text in units by regular expressions; what stands before the first one belongs to it."""
    if unit == "char":
        return list(text)
    if unit == "line":
        return re.findall(r"[^\n]*\n|[^\n]+$", text)
    got = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
    return [text[:len(text) - len("".join(got))] + got[0], *got[1:]] if got else []


def brute(doc_id, text, unit):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    u = units(text, unit)
    n = len(u)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle = "".join(u[:a]), "".join(u[a:b])
    suffix = text[len(prefix) + len(middle):]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (n, "plain", None, None, text)
    if h4 % 100 < 20:
        return (n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}")


@pytest.mark.parametrize("unit", list(M.UNITS))
def test_hostile_texts_equal_brute_force(llm, edge, unit):
    rng = random.Random(3)
    bits = ["<", ">", "P", "S", "M", "<P", "S>", "<M>", " ", "\n", "\n\n", "\t ", "é", "漢", "😀", "word", " ", "\x00", "\r\n"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(3000)]
    rows += [(None, "no id"), (None, "no id"), (7, "repeated row"), (7, "repeated row"), (-5, "negative")]
    rows += [(r.doc_id, r.text) for r in edge.collect()]
    docs = llm.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, output string")
    out = M.fill_in_middle(docs, unit=unit)
    got = out.withColumn("back", M.restored(out.output, out.form)).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in got), key=key) == sorted(
        ((i, *brute(i, t, unit)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.back) for r in got), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def test_partitioning_changes_nothing_and_an_empty_table_gives_nothing(llm, edge, empty):
    def rows(parts):
        return sorted(map(str, M.fill_in_middle(edge.repartition(parts)).collect()))
    assert rows(1) == rows(9)
    assert M.fill_in_middle(empty).count() == 0


def test_other_marks_and_shares(llm):
    docs = llm.createDataFrame([(i, f"text {i} <P>") for i in range(300)], "doc_id long, text string")
    out = M.fill_in_middle(docs, sentinels=("[p]", "[s]", "[m]"), plain_percent=0, spm_percent=100)
    rows = out.withColumn("back", M.restored(out.output, out.form, ("[p]", "[s]", "[m]"))).collect()
    assert {r.form for r in rows} == {"spm"}
    assert all(r.output.startswith("[s]") and r.back == f"text {r.doc_id} <P>" for r in rows)
