"""Phrase mining against SQL and against plain counting, with samples that propose too little."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from segmint.llm import collocations as C
from segmint.llm import registry as R
from segmint.plans.compare import compare
from tests.conftest import SF_ORACLE

DOCS = "doc_id long, text string, lang string, n long, phrase string, words string"
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_query_matches_sql(llm):
    assert compare(llm, "op12_collocations", SF_ORACLE, R.QUERIES, R.ORACLE)["status"] == "match"


def brute_counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, support, top):
    f, n = brute_counts(rows)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= support}
    longer = Counter()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i:i + k]] = max(longer[lang, w[i:i + k]], a)
    out = []
    for lang in n:
        best = []
        for (g, w), a in cand.items():
            if g == lang and not 100 * longer[g, w] >= 80 * a:
                score, _, l, r = min((2000000 * a // (f[g, w[:k]] + f[g, w[k:]]), k, f[g, w[:k]], f[g, w[k:]])
                                     for k in range(1, len(w)))
                best.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def talk(seed, docs=400):
    """Words with a few habits, so that phrases of all lengths are frequent."""
    rng = random.Random(seed)
    vocab = ["a", "B", "c", "é", "漢", "<x>", "\x00", "word", "'", "-"] + [f"w{i}" for i in range(25)]
    fixed = ["new york city hall", "of the a", "of the b", "to be or not", "w1 w2 w3", "é 漢"]
    rows = []
    for i in range(docs):
        bits = []
        for _ in range(rng.randint(0, 60)):
            bits.append(rng.choice(fixed) if rng.random() < .3 else rng.choice(vocab))
            bits.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ". "]))
        rows.append((i, "".join(bits), rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows


def mined(llm, rows, **kw):
    docs = llm.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS).repartition(5)
    return sorted(tuple(r) for r in C.collocations(docs, **kw).collect())


@pytest.mark.parametrize("support,sample_of", [(30, 4), (5, 1), (8, 40)])
def test_equals_plain_counting(llm, support, sample_of):
    rows = talk(support)
    assert mined(llm, rows, support=support, top=50, sample_of=sample_of) == brute(rows, support, 50)


def test_failed_borders_are_expanded_until_closed(llm, monkeypatch):
    """A sample that proposes nothing: words, pairs, triples and quadruples come in by expansion alone."""
    passes = []
    counted = C._counted
    monkeypatch.setattr(C, "_counted", lambda docs, proposed, support: passes.append(len(proposed)) or counted(docs, proposed, support))
    monkeypatch.setattr(C, "proposals", lambda *a: np.zeros(1 << (C.FILTER_BITS - 3), np.uint8))
    rows = talk(4)
    assert mined(llm, rows, support=10, top=40) == brute(rows, 10, 40)
    assert passes == [1, 2, 3, 4]


def test_full_filter_counts_everything(llm, monkeypatch):
    """All false positives: more is counted, the result is the same."""
    monkeypatch.setattr(C, "proposals", lambda *a: np.full(1 << (C.FILTER_BITS - 3), 255, np.uint8))
    rows = talk(9)
    assert mined(llm, rows, support=10, top=40) == brute(rows, 10, 40)


def test_long_texts_span_flushes():
    """Phrases across the end of a flush count once, in every order of blocks."""
    import pyarrow as pa
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdef") for _ in range(n)) + "." for n in (3, 5000, 17, 0, 2999, 64)]
    want, _ = brute_counts([(0, t, "x") for t in texts])
    flush = C.FLUSH
    for C.FLUSH in (7, 64, 1000, flush):
        got = Counter()
        for words, size in C.flushes(iter([pa.RecordBatch.from_pydict({"text": texts, "lang": ["x"] * len(texts)})])):
            for k in range(1, 5):
                mask = words.valid(k).copy()
                mask[size:] = False
                lang, text, n = words.phrases(k, mask)
                for p, c in zip(text.to_pylist(), n.tolist()):
                    got["x", tuple(p.decode().split(" "))] += c
        assert got == want
    C.FLUSH = flush


def test_edges(llm, edge, empty):
    rows = [(r.doc_id, r.text, r.lang) for r in edge.collect()]
    assert mined(llm, rows, support=3, top=30) == brute(rows, 3, 30)
    assert C.collocations(empty).count() == 0
    nulls = [(None, None, None), (None, "a b a b a b", None), (1, "a b", "und"), (1, "a b", "und"), (2, " .,;\n", "xx")]
    assert mined(llm, nulls, support=2, top=5) == brute(nulls, 2, 5)


def test_scores_are_exact_beyond_64_bits(llm, monkeypatch):
    a, l, r = 3 * 10**13 + 7, 4 * 10**13 + 1, 5 * 10**13 + 3
    rows = [("en", "", 0, 10**15), ("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a)]
    known = llm.createDataFrame(rows, "lang string, phrase string, words int, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *x: known)
    assert [tuple(x) for x in C.collocations(None).collect()] == [
        ("en", 1, "x y", a, l, r, 10**15, 2000000 * a // (l + r))]
