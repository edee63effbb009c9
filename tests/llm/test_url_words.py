"""Word counts of pages do not depend on how the rows are dealt."""

import random
import re
from collections import Counter

from segmint.llm import url_filter


def plain(html):
    """Words outside of tags; a tag that is never closed hides the rest."""
    text = re.sub(r"<[^>]*(>|$)", "<", html or "")
    return Counter(w.lower() for w in re.findall(r"[A-Za-z\u0080-\U0010ffff]+", text) if w.isascii() and len(w) <= url_filter.LONGEST_WORD)


def test_words_end_with_their_page(llm):
    rng = random.Random(4)
    bits = ["hello", "<b>", "</b", ">", "<", " ", "é", "World", "x" * 30, "1", "\n"]
    pages = ["hello"] * 8 + [None, ""] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    want = sum((plain(p) for p in pages), Counter())
    for parts in (1, 8):
        df = llm.createDataFrame([(p,) for p in pages], "html string").repartition(parts)
        assert {r.word: r.n for r in url_filter.word_counts(df).collect()} == want
