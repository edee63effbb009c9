"""Operators that compare documents, and the pipeline, against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from segmint.llm import exact_dedup, near_dedup, substring_dedup
from segmint.llm import registry as R
from segmint.llm.common import components, join_unique
from segmint.plans.compare import compare
from tests.conftest import SF_ORACLE, SF_SMALL

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_components(texts):
    """(set size, smallest id reachable) of each id."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    u, by_word = Union(sets), defaultdict(set)
    freq = defaultdict(int)
    for s in set(sets.values()):
        for x in s:
            freq[x] += 1
    first = {}
    for i, s in sets.items():
        if s and s in first:
            u.join(i, first[s])
        elif s:
            first[s] = i
    for s, i in first.items():
        # a link shares one of the rarest quarter of the shingles
        rare = sorted(s, key=lambda x: (freq[x], x))[:len(s) - -(-len(s) * 3 // 4) + 1]
        for j in set().union(*(by_word[x] for x in rare)):
            n = len(s & sets[j])
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                u.join(i, j)
        for x in s:
            by_word[x].add(i)
    return {i: (len(sets[i]), u.find(i)) for i in sets}


def documents(sf):
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}


# --- helpers -----------------------------------------------------------------------

def test_components_of_paths_stars_and_cycles(llm):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(rng.randrange(300, 420), rng.randrange(300, 420)) for _ in range(90)] + [(5, 5), (None, 3), (7, None)]
    u = Union(range(500))
    for a, b in edges:
        if a is not None and b is not None:
            u.join(a, b)
    got = {r.v: r.root for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: u.find(x) for x in touched}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_join_unique_hot_keys_change_nothing(llm):
    rows = llm.createDataFrame([(k, i) for i in range(400) for k in ("hot", f"k{i % 50}", None)], "key string, i long")
    right = llm.createDataFrame([("hot", 400, 1), ("k1", 8, 2), ("k2", 8, 3), ("zz", 1, 4)], "key string, freq long, v long")
    want = sorted((r.i, r.v) if r.v is not None else (r.i, -1) for r in rows.join(right, "key", "left").collect())
    from pyspark.sql import functions as F
    for least, most in ((1, 2), (100, 1), (10**9, 5)):
        got = join_unique(rows, right, "key", "freq", [F.col("i")], hot_min=least, hot_keys=most)
        assert sorted((r.i, r.v if r.v is not None else -1) for r in got.collect()) == want
        kept = join_unique(rows, right, "key", "freq", [F.col("i")], matched=True, hot_min=least, hot_keys=most)
        assert kept.count() == sum(v != -1 for _, v in want)


# --- exact copies --------------------------------------------------------------------

def test_exact_query_matches_sql(llm):
    assert compare(llm, "op9_block_naming", SF_ORACLE, R.QUERIES, R.ORACLE)["status"] == "match"


def test_exact_edges_and_hot_groups(llm, edge, empty, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_MIN", 2)   # the broadcast way
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    want = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        seen = set()
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            want.append((str(i), str(keep), len(ids), i == keep and keep not in seen))
            seen.add(i)
    got = [(str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_dedup(edge).collect()]
    assert sorted(got) == sorted(want)
    kept = exact_dedup.drop_copies(edge)
    assert kept.columns == edge.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


# --- near copies -----------------------------------------------------------------------

def test_near_query_against_brute_force(llm):
    want = brute_components(documents(SF_ORACLE))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in R.QUERIES["op7_minhash"](llm, SF_ORACLE).collect()}
    assert got == want


def test_near_family_of_mutual_and_chained_copies(llm):
    """Copies of one original with edits of their own, most of them linked only through others; and a chain."""
    rng = random.Random(2)
    base = [f"t{rng.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(250):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        texts[i] = " ".join(w)
    chain = [f"c{k}" for k in range(100)]
    for i in range(250, 290):  # each differs a little from the one before, the ends share nothing
        texts[i] = " ".join(chain)
        chain = chain[4:] + [f"c{i}_{k}" for k in range(4)]
    df = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    want = brute_components(texts)
    assert {i: x for i, x in got.items() if i >= 250} == {i: x for i, x in want.items() if i >= 250}
    # never joined wrongly; of the many links inside one large bucket, one that alone holds a copy may be missed
    parts, whole = Union(texts), Union(texts)
    for i, (_, c) in got.items():
        parts.join(i, c)
        assert want[i][1] == want[c][1]
    for i, (_, c) in want.items():
        whole.join(i, c)
    family = max((sum(whole.find(j) == whole.find(i) for j in range(250)), whole.find(i)) for i in range(250))[1]
    inside = [i for i in range(250) if whole.find(i) == family]
    largest = max(sum(parts.find(j) == parts.find(i) for j in inside) for i in inside)
    assert largest >= 0.98 * len(inside)


def test_near_edges(llm, edge, empty):
    got = near_dedup.near_duplicates(edge).collect()
    assert len(got) == edge.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert {by[1][0].n_shingles, by[2][0].n_shingles, by[3][0].n_shingles} == {0}
    assert by[6][0].component_id == by[7][0].component_id == 6 and not by[7][0].kept
    assert all(r.component_id is None and r.kept for r in by[None])
    assert by[4][0].component_id == 4 and by[5][0].n_shingles == 1
    out = near_dedup.keep_one_of_each(edge)
    assert out.columns == edge.columns and out.count() == edge.count() - 2
    assert near_dedup.near_duplicates(empty).count() == 0


def test_signatures_agree_as_often_as_sets(llm):
    rng = np.random.default_rng(3)
    same = []
    for _ in range(60):
        x = rng.integers(1, 1 << 62, 100, dtype=np.uint64)
        a, b = x[:80], np.concatenate([x[20:80], x[80:]])  # 60 of 100
        s = near_dedup.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
        same.append((s[0] == s[1]).mean())
    assert abs(np.mean(same) - 0.6) < 0.04
    few = near_dedup.signatures(np.array([5, 9], np.uint64), np.array([2]))
    assert len(np.unique(few)) == 2  # densified: no bin stays empty


# --- passages ----------------------------------------------------------------------------

def test_nearest_smaller_against_loops():
    rng = np.random.default_rng(0)
    v = rng.integers(1, 40, 500).astype(np.uint64)
    v[[0, 200, 499]] = 0
    left, right = substring_dedup.nearest_smaller(v)
    for i in np.flatnonzero(v):
        lo, hi = i - 1, i + 1
        while v[lo] > v[i]:
            lo -= 1
        while v[hi] >= v[i]:
            hi += 1
        assert (left[i], right[i]) == (lo, hi)


def test_passages_cover_every_repeated_window(llm):
    docs = {i: words(t) for i, t in documents(SF_ORACLE).items()}
    where = defaultdict(set)
    for i, w in docs.items():
        for k in range(len(w) - 49):
            where[tuple(w[k:k + 50])].add(i)
    rows = R.QUERIES["op3_compact_windows"](llm, SF_ORACLE).collect()
    marked = {i: np.zeros(len(w), bool) for i, w in docs.items()}
    for r in rows:
        a, b = docs[r.source_doc_id][r.source_start:r.source_end], docs[r.doc_id][r.start:r.end]
        x, y = ({tuple(z[k:k + 5]) for k in range(len(z) - 4)} for z in (a, b))
        assert min(len(a), len(b)) >= 50 and r.source_doc_id < r.doc_id
        assert abs(len(x & y) / len(x | y) - r.similarity) < 1e-9 and r.similarity >= 0.75
        marked[r.doc_id][r.start:r.end] = True
    n = 0
    for i, w in docs.items():
        for k in range(len(w) - 49):
            if min(where[tuple(w[k:k + 50])]) < i:
                n += 1
                assert marked[i][k:k + 50].all(), (i, k)
    assert n > 1000


def test_near_passages_inside_other_texts(llm):
    rng = random.Random(7)
    fresh = lambda n: [f"z{rng.randrange(10**7)}" for _ in range(n)]
    texts, pairs = [], []
    for p in range(40):
        passage = fresh(110)
        for c in range(2):
            own = list(passage)
            for _ in range(2 * c):  # two words changed
                own[rng.randrange(10, 100)] = fresh(1)[0]
            texts.append((2 * p + c, " ".join(fresh(rng.randint(0, 200)) + own + fresh(rng.randint(0, 200)))))
        pairs.append((2 * p, 2 * p + 1))
    df = llm.createDataFrame(texts, "doc_id long, text string")
    got = {(r.source_doc_id, r.doc_id) for r in substring_dedup.repeated_passages(df).collect()}
    assert got <= set(pairs) and len(got) >= 0.95 * len(pairs)


def test_passages_edges(llm, edge, empty):
    got = substring_dedup.repeated_passages(edge).collect()
    assert {(r.source_doc_id, r.doc_id) for r in got} == {(6, 7)}
    assert substring_dedup.repeated_passages(empty).count() == 0


# --- pipeline -------------------------------------------------------------------------------

def test_pipeline_stages_at_small_scale(llm):
    import corpus_pipeline
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, kept[-1], SF_SMALL)
        assert out.columns == docs.columns, name
        kept.append(llm.createDataFrame(out.collect(), docs.schema))
    assert len(names) == 5
    text = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    # exact copies: of equal normalised texts the smallest id
    first = {}
    for i in sorted(text[1]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text[1][i]), i)
    assert set(text[2]) == set(first.values())
    # near copies: the smallest id of each component
    assert set(text[3]) == {i for i, (_, c) in brute_components(text[2]).items() if i == c}
    # benchmark items: whoever contains one goes
    from segmint.llm.decontaminate import normal
    items = [normal(r["text"]).strip() for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    leaked = {i for i, t in text[3].items() if any(b in normal(t) for b in items)}
    assert leaked.isdisjoint(text[4]) and set(text[3]) - leaked == set(text[4])
    seq = corpus_pipeline.run(llm, SF_SMALL)
    assert {r.doc_id for r in seq.select("doc_id").distinct().collect()} == set(text[4])


@pytest.mark.parametrize("stage", range(4))
def test_pipeline_stage_on_edge_rows(llm, edge, empty, stage):
    import corpus_pipeline
    name, f = corpus_pipeline.STAGES[stage]
    assert f(llm, edge, SF_SMALL).columns == edge.columns
    assert f(llm, empty, SF_SMALL).count() == 0
