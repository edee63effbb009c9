"""Families of near copies in large buckets: the components are those of brute force."""

import random

from segmint.llm import near_dedup
from tests.llm.test_corpus import brute_components


def test_near_family_in_large_buckets_is_exact(llm):
    rng = random.Random(5)
    base = [f"t{rng.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(1200):
        w = list(base)
        for k in rng.sample(range(len(w)), rng.randint(3, 6)):
            w[k] = f"e{rng.randrange(10**7)}"
        texts[i] = " ".join(w)
    df = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    want = brute_components(texts)
    assert {i for i in want if got[i] != want[i]} == set()
