"""Phrase collocations by Toivonen's sampling: a sample proposes, full passes count exactly, until closed.

1. A hashed share of the documents proposes phrases of up to four words that look frequent at a
   lowered support.  In the sample, a phrase of three or four words is counted only where all its
   word pairs are proposed.
2. A full pass counts exactly what is proposed and its negative border: every single word, and every
   phrase whose two parts (all but its last word, all but its first) are proposed.
3. Where a counted phrase reaches the support without having been proposed, the border has failed: the
   frequent phrases known so far become the proposals, and a further full pass counts the phrases that
   their border adds.  This goes on until every frequent phrase is a proposal; a phrase cannot be more
   frequent than its parts, so then none is missing.

Proposals travel as a filter of ``2 ** FILTER_BITS`` bits, whatever their number.  A false positive only
has one more phrase counted; counts are keyed by the phrase itself, never by a hash.  A task counts a
flush of up to ``FLUSH`` words in arrays, by word numbers of that flush, before anything is shuffled.

A candidate is a phrase of two words and more with the support.  Its score is the least, over its cuts
into two parts, of ``2,000,000 * a / (l + r)``; candidates that mostly occur inside a longer one go.

Defined cases: null text counts as empty; null ``lang`` counts as ``und``.  Every row counts, also
with a null or repeated doc_id.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.llm.arrays import LOWER, blocks, mix, span_hashes
from segmint.llm.common import written

LONGEST = 4
SUPPORT = 30
#: A share of 1 / SAMPLE_OF of the documents is the sample.
SAMPLE_OF = 4
#: The sample's support lies so many standard deviations below the expected one.
SLACK = 0.5
#: The proposals' filter: 2 MB; a fuller one only has more counted.
FILTER_BITS = 24
_RANGE_BITS = 4
#: Words counted at a time; their numbers take 21 bits, three of them a 64-bit key.
FLUSH = 1 << 18
_NUMBER = 21
#: Between phrase and language in a key; no phrase holds it.
BETWEEN = "\t"
#: The best of a language are first taken in so many groups.
TOP_GROUPS = 256

_FOLD = LOWER.astype(np.uint8)
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_rng = np.random.default_rng(12)
_LEFT, _RIGHT = (_rng.integers(1, 1 << 63, LONGEST + 1, dtype=np.uint64) | np.uint64(1) for _ in range(2))


class Words:
    """A flush: consecutive words as numbers of ``vocabulary``, and whether each one's piece goes on."""

    def __init__(self, blocks_: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], langs: list[str]):
        data, lengths, joined, lang = (np.concatenate(x) for x in zip(*blocks_))
        offsets = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        column = pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                       [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        column = column.dictionary_encode()
        words, number = column.dictionary, column.indices.to_numpy().astype(np.int64)
        # one number for each word of a language
        own = pa.array(lang * len(words) + number).dictionary_encode()
        self.number = own.indices.to_numpy().astype(np.int64)
        pair = own.dictionary.to_numpy()
        self.vocabulary = words.take(pa.array(pair % max(len(words), 1)))
        self.lang = pair // max(len(words), 1)
        self.langs, self.joined = langs, joined
        _, off, raw = words.buffers()
        bounds = np.frombuffer(off, np.int64)[:len(words) + 1]
        text = np.frombuffer(raw, np.uint8) if raw is not None and len(words) else np.zeros(0, np.uint8)
        word_hash = span_hashes(text, bounds[:-1], bounds[1:], fold=False)
        lang_hash = np.array([_text_hash(x) for x in langs], np.uint64)
        self._word_hash = mix(word_hash[pair % max(len(words), 1)] ^ lang_hash[self.lang])
        self._hashes: dict[int, np.ndarray] = {1: self._word_hash[self.number]}
        self._valid: dict[int, np.ndarray] = {1: np.ones(len(self.number), bool)}

    def valid(self, k: int) -> np.ndarray:
        """Whether a phrase of ``k`` words begins at each place."""
        if k not in self._valid:
            v = self.valid(k - 1).copy()
            n = len(v)
            v[:max(n - k + 1, 0)] &= self.joined[k - 2:n - 1] if n >= k else False
            v[max(n - k + 1, 0):] = False
            self._valid[k] = v
        return self._valid[k]

    def hashes(self, k: int) -> np.ndarray:
        """A hash of the phrase of ``k`` words at each place (meaningless where it is not valid)."""
        if k not in self._hashes:
            last = np.roll(self._hashes[1], 1 - k)
            self._hashes[k] = mix(self.hashes(k - 1) * _LEFT[k] + last * _RIGHT[k])
        return self._hashes[k]

    def inside(self, k: int, bits: np.ndarray) -> np.ndarray:
        """Whether the phrase of ``k`` words at each place passes the filter."""
        at = self.hashes(k) >> np.uint64(64 - FILTER_BITS)
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def parts_inside(self, k: int, bits: np.ndarray) -> np.ndarray:
        """Places where a phrase of ``k`` words begins whose two parts of ``k - 1`` pass the filter."""
        one = self.inside(k - 1, bits) & self.valid(k - 1)
        return self.valid(k) & one & np.roll(one, -1)

    def phrases(self, k: int, mask: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(lang numbers, phrases, occurrences) of the distinct phrases of ``k`` words at ``mask``."""
        at = np.flatnonzero(mask)
        keys = self.number[at]
        mask_bits = (1 << _NUMBER) - 1
        levels = []
        for j in range(1, k):
            if j == 3:  # three numbers fill a key: go on with the number of the triple
                triples, keys = np.unique(keys, return_inverse=True)
                levels.append(triples)
            keys = (keys << _NUMBER) | self.number[at + j]
        keys, counts = np.unique(keys, return_counts=True)
        tail = []
        for j in range(k - 1, 0, -1):
            tail.append(keys & mask_bits)
            keys = keys >> _NUMBER
            if j == 3:
                keys = levels[0][keys]
        numbers = [keys, *reversed(tail)]
        text = self.vocabulary.take(pa.array(numbers[0]))
        if k > 1:
            blank = pa.scalar(b" ", pa.large_binary())
            text = pc.binary_join_element_wise(text, *(self.vocabulary.take(pa.array(x)) for x in numbers[1:]), blank)
        return self.lang[numbers[0]], text, counts


def _text_hash(text: str) -> np.uint64:
    raw = np.frombuffer(text.encode(), np.uint8)
    return span_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]), fold=False)[0]


def flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, int]]:
    """Words of ``text`` and ``lang`` columns, at most ``FLUSH`` places at a time; count from that many places."""
    langs: dict[str, int] = {}
    kept, size = [], 0
    for batch in batches:
        own = np.array([langs.setdefault(x, len(langs)) for x in batch.column("lang").to_pylist()], np.int64)
        for at, rows, data, offsets in blocks(batch.column("text")):
            data = _FOLD[data]
            gap = _GAP[data]
            if gap.all():
                continue
            before = np.ones(len(data), bool)
            before[1:] = gap[:-1]
            before[offsets[:-1][offsets[:-1] < len(data)]] = True
            after = np.ones(len(data), bool)
            after[:-1] = gap[1:]
            after[offsets[1:][offsets[1:] > 0] - 1] = True
            starts = np.flatnonzero(~gap & before)
            lengths = np.flatnonzero(~gap & after) + 1 - starts
            row = np.searchsorted(offsets, starts, "right") - 1
            piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
            joined = np.zeros(len(starts), bool)
            joined[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
            word, lang = data[~gap], own[at + row]
            first = np.concatenate([[0], np.cumsum(lengths)])
            # a long text goes in several flushes; each sees the words that end its last phrases
            for lo in range(0, len(starts), FLUSH):
                hi = min(lo + FLUSH, len(starts))
                if size and size + hi - lo > FLUSH:
                    yield Words(kept, list(langs)), size
                    kept, size = [], 0
                to = min(hi + LONGEST - 1, len(starts))
                kept.append((word[first[lo]:first[to]], lengths[lo:to], joined[lo:to], lang[lo:to]))
                size += hi - lo
                if to > hi:
                    yield Words(kept, list(langs)), size
                    kept, size = [], 0
    if size:
        yield Words(kept, list(langs)), size


# --- the sample ---------------------------------------------------------------

def _propose(docs: DataFrame, low: int, masks: Callable[[Words], dict[int, np.ndarray]]) -> np.ndarray:
    """A filter of the phrases that occur ``low`` times in ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, size in flushes(batches):
            for k, mask in masks(words).items():
                mask[size:] = False
                h, n = np.unique(words.hashes(k)[mask], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    found = docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= low)
    return bit_filter(found.select("h"))


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """The filter of ``hashes(h)``, ``2 ** FILTER_BITS`` bits whatever their number.

    Ranges of bits are set in tasks; the driver gets each range once.
    """
    range_bytes = 1 << (FILTER_BITS - _RANGE_BITS - 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("bit").to_numpy()
            for r in np.unique(at >> (FILTER_BITS - _RANGE_BITS)).tolist():
                bits = own.setdefault(r, np.zeros(range_bytes, np.uint8))
                inside = at[at >> (FILTER_BITS - _RANGE_BITS) == r] - (r << (FILTER_BITS - _RANGE_BITS))
                np.bitwise_or.at(bits, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        for r, bits in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([bits.tobytes()], pa.binary())],
                                             names=["range", "bits"])

    bit = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    dealt = (hashes.select(bit.alias("bit")).distinct()
             .repartition(1 << _RANGE_BITS, F.shiftright("bit", FILTER_BITS - _RANGE_BITS)))
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in dealt.mapInArrow(run, "range long, bits binary").collect():
        at = r["range"] * range_bytes
        out[at:at + range_bytes] |= np.frombuffer(r.bits, np.uint8)
    return out


def lowered_support(support: int, sample_of: int) -> int:
    expected = support / sample_of
    return max(1, int(expected - SLACK * expected ** 0.5))


def proposals(docs: DataFrame, support: int, sample_of: int) -> np.ndarray:
    """The filter of what a sample of ``docs(doc_id, text, lang)`` shows to be frequent."""
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit(12)), F.lit(sample_of)) == 0)
    low = lowered_support(support, sample_of)
    short = _propose(sample, low, lambda w: {1: w.valid(1).copy(), 2: w.valid(2).copy()})
    shared = docs.sparkSession.sparkContext.broadcast(short)

    def longer(w: Words) -> dict[int, np.ndarray]:
        pair = w.inside(2, shared.value) & w.valid(2)
        out, mask = {}, pair
        for k in range(3, LONGEST + 1):
            mask = mask & w.valid(k) & np.roll(pair, 2 - k)
            out[k] = mask.copy()
        return out

    return short | _propose(sample, low, longer)


# --- full passes ----------------------------------------------------------------

def _counted(docs: DataFrame, proposed: list[np.ndarray], support: int) -> DataFrame:
    """(lang, phrase, words, n) of the frequent ones among what the last filter and its border add.

    The first pass counts all words too; a row without a phrase has the number of words of a language.
    """
    shared = [docs.sparkSession.sparkContext.broadcast(x) for x in proposed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [x.value for x in shared]
        for words, size in flushes(batches):
            names = pa.array([x.encode() for x in words.langs], pa.large_binary())
            for k in range(1 if len(filters) == 1 else 2, LONGEST + 1):
                mask = words.valid(1).copy() if k == 1 else words.parts_inside(k, filters[-1])
                for earlier in filters[:-1]:
                    mask &= ~words.parts_inside(k, earlier)
                mask[size:] = False
                lang, text, n = words.phrases(k, mask)
                if k == 1:
                    total = np.bincount(lang, weights=n, minlength=len(words.langs)).astype(np.int64)
                    has = np.flatnonzero(total)
                    yield _rows(pa.array([b""] * len(has), pa.large_binary()), names.take(pa.array(has)), total[has])
                yield _rows(text, names.take(pa.array(lang)), n)

    # a flush has combined what repeats: most of its phrases are rare, and combining them again before the
    # shuffle would only cost memory
    counts = (docs.mapInArrow(run, "key string, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
              .filter((F.col("n") >= support) | F.col("key").startswith(BETWEEN)))
    phrase = F.substring_index("key", BETWEEN, 1)
    return counts.select(F.expr(f"substring(key, char_length(substring_index(key, '{BETWEEN}', 1)) + 2)").alias("lang"),
                         phrase.alias("phrase"), F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("words"),
                         "n")


def _rows(text: pa.Array, lang: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    key = pc.binary_join_element_wise(text, lang, pa.scalar(BETWEEN.encode(), pa.large_binary()))
    return pa.RecordBatch.from_arrays([key.cast(pa.large_string()).cast(pa.string()), pa.array(n)], names=["key", "n"])


def _hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each phrase of ``lang, text, words``, as the filters know it."""
    for batch in batches:
        by = batch.column("words").to_numpy()
        for k in np.unique(by).tolist():
            own = batch.filter(pa.array(by == k))
            for words, size in flushes(iter([own])):
                # phrases of k words follow each other, cut off by the end of their text
                h = words.hashes(k)[:size][words.valid(k)[:size]]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, sample_of: int = SAMPLE_OF) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of up to four words that occur ``support`` times.

    Besides, one row with the empty phrase for each language: its number of words.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    proposed = [proposals(docs, support, sample_of)]
    known = written(_counted(docs, proposed, support), "phrases")
    while True:
        # what has no extension need not be a proposal
        parts = known.filter(F.col("words").between(1, LONGEST - 1)).select("lang", F.col("phrase").alias("text"), "words")
        hashes = written(parts.mapInArrow(_hash_phrases, "h long"), "hashes")
        if not hashes.filter(~_passes(proposed[-1], docs)).limit(1).count():
            return known
        proposed.append(bit_filter(hashes))
        known = written(known.union(_counted(docs, proposed, support)), "phrases")


def _passes(bits: np.ndarray, docs: DataFrame) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def passes(h: pd.Series) -> pd.Series:
        at = h.to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        return pd.Series((shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1)

    return passes("h")


# --- scores ----------------------------------------------------------------------

def _times(factor: int, c: str) -> Column:
    """An exact product, beyond 64 bits too."""
    return F.lit(factor).cast("decimal(10,0)") * F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = 2000, sample_of: int = SAMPLE_OF) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    known = frequent_phrases(docs, support, sample_of)
    sizes = known.filter("phrase = ''").select("lang", F.col("n").alias("total"))
    known = known.filter("phrase <> ''")
    candidates = known.filter("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    # what occurs mostly inside a longer candidate goes
    spans = [(s, k) for k in range(2, LONGEST) for s in range(1, LONGEST - k + 2)]
    inner = candidates.filter("words > 2").select("lang", "a", F.explode(F.filter(F.array(*[
        F.when((F.col("words") > k) & (F.col("words") >= s + k - 1), F.array_join(F.slice("w", s, k), " "))
        for s, k in spans]), lambda x: x.isNotNull())).alias("phrase"))
    outer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = candidates.join(outer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_times(100, "longer") < _times(80, "a"))).drop("longer")

    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda c: F.struct(
        c.alias("c"), F.array_join(F.slice("w", F.lit(1), c), " ").alias("one"),
        F.array_join(F.slice("w", c + 1, F.col("words") - c), " ").alias("two")))
    cut = left.select("lang", "phrase", "a", F.explode(cuts).alias("x")).select("lang", "phrase", "a", "x.*")
    for side, value in (("one", "l"), ("two", "r")):
        cut = cut.join(known.select("lang", F.col("phrase").alias(side), F.col("n").alias(value)), ["lang", side])
    score = F.expr("cast(2000000 * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0)) as long)")
    scored = (cut.withColumn("score", score).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "c", "l", "r")).alias("least"))
              .select("lang", "phrase", "a", "least.score", "least.l", "least.r"))

    # the best of groups first, so that no task orders all phrases of a language
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    scored = scored.withColumn("_group", F.pmod(F.xxhash64("phrase"), F.lit(TOP_GROUPS)))
    best = (scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order)))
            .filter(F.col("rank") <= top))
    ranked = (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= top))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
