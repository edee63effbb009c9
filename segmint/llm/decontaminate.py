"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts and items are lower-cased and white space runs become one blank.  The CGK embedding walks over a
text: step j notes the sign it stands on and goes on if a random table says so for (j, sign).  Two
texts of small edit distance soon walk in step again, so their notes have a small Hamming distance.

* From every word of an item a walk of ``STEPS`` starts (an anchor); its notes at ``REPEATS`` samples of
  ``BITS`` random steps are LSH keys.
* From every word of every document the same walk starts; whole blocks of documents walk at once.  A
  shared key makes the item-sized window around it a candidate, if the notes of all steps also have
  a Hamming distance of at most ``NEAR``.  A leaked item has as many chances as it has words.
* Each candidate is confirmed by the exact edit distance between the whole item and the best
  substring around the window: at most ``MAX_EDITS`` of the item's length.

Items are sent to the tasks in slices of at most ``SLICE_CHARS`` characters; a larger benchmark takes
several scans, each with a bounded broadcast.  Documents are not shuffled.

Defined cases: null texts count as empty.  Items shorter than ``LEAST`` normalised characters are left
out, as they occur by chance; null item_ids stay null; repeated items are each reported.  Rows without
doc_id are searched like others.  Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.arrays import blocks, ragged_arange
from segmint.llm.common import plain_documents

STEPS = 80
REPEATS = 6
BITS = 6
NEAR = 0.4
MAX_EDITS = 0.1
LEAST = 20
SLICE_CHARS = 4_000_000

_rng = np.random.default_rng(88)
#: Signs of a walk: 5-bit classes of the low byte of a lower-cased code point; 0 is the blank.
_SIGN = np.zeros(256, np.uint8)
_SIGN[:] = 1 + _rng.permutation(256) % 31
for _c in range(26):
    _SIGN[97 + _c] = 1 + _c
    _SIGN[65 + _c] = 1 + _c
for _c in range(0xC0, 0xDF):
    _SIGN[_c] = _SIGN[_c + 32]
_SIGN[[0x20, *range(9, 14)]] = 0
_GO = _rng.integers(0, 2, (STEPS, 32)).astype(np.int64)
_SAMPLES = np.sort(np.stack([_rng.choice(STEPS, BITS, replace=False) for _ in range(REPEATS)]), axis=1)
_BLANK = re.compile(r"[\x20\x09-\x0D]+")


def normal(text: str) -> str:
    """Lower case with single blanks; a code point whose lower case is longer stays as it is."""
    text = _BLANK.sub(" ", text)
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def walk(signs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(STEPS, starts) notes; ``signs`` must go on for STEPS behind the last start."""
    notes = np.empty((STEPS, len(starts)), np.uint8)
    at, go = starts.astype(np.int64), np.empty(len(starts), np.int64)
    for j in range(STEPS):
        np.take(signs, at, out=notes[j], mode="clip")
        np.take(_GO[j], notes[j], out=go, mode="clip")
        at += go
    return notes


def sample(notes: np.ndarray, repeat: int) -> np.ndarray:
    key = notes[_SAMPLES[repeat][0]].astype(np.uint32)
    for j in _SAMPLES[repeat][1:]:
        key = (key << np.uint32(5)) | notes[j]
    return key


def _signs(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs with blanks collapsed, places they have in ``points``)."""
    s = _SIGN[points & 255]
    s[(points > 255) & (s == 0)] = 31
    again = np.zeros(len(s), bool)
    again[1:] = (s[1:] == 0) & (s[:-1] == 0)
    kept = np.flatnonzero(~again)
    return s[kept], kept


def _starts(signs: np.ndarray) -> np.ndarray:
    begin = signs != 0
    begin[1:] &= signs[:-1] == 0
    return np.flatnonzero(begin)


def _points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)


class Items:
    """Anchors, keys and match masks of a slice of the benchmark."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        self.texts = [normal(t).strip() for _, t in items]
        owner, offset, notes = [], [], []
        for k, t in enumerate(self.texts):
            if len(t) < LEAST:
                continue
            signs, kept = _signs(_points(t.encode()))
            s = _starts(signs)
            # walks that would leave the item say nothing about it; short items have the first only
            s = s[(s + STEPS // 2 <= len(signs)) | (s == s[0])]
            notes.append(walk(np.append(signs, np.zeros(STEPS, np.uint8)), s))
            owner.append(np.full(len(s), k))
            offset.append(kept[s])
        self.owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        self.offset = np.concatenate(offset) if offset else np.zeros(0, np.int64)
        self.notes = np.concatenate(notes, axis=1).T.copy() if notes else np.zeros((0, STEPS), np.uint8)
        self.keys, self.order, self.maybe = [], [], []
        for r in range(REPEATS):
            key = sample(self.notes.T, r)
            order = np.argsort(key, kind="stable")
            self.keys.append(key[order])
            self.order.append(order)
            filled = np.zeros(1 << 20, bool)
            filled[self._slot(key)] = True
            self.maybe.append(filled)
        self.masks = {}

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key * np.uint32(2654435761)) >> np.uint32(12)

    def candidates(self, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, anchor) pairs that share a key and have near notes."""
        pairs = []
        for r in range(REPEATS):
            key = sample(notes, r)
            at = np.flatnonzero(self.maybe[r][self._slot(key)])
            lo = np.searchsorted(self.keys[r], key[at], "left")
            n = np.searchsorted(self.keys[r], key[at], "right") - lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            w, a = np.repeat(at, n), self.order[r][np.repeat(lo, n) + ragged_arange(n)]
            for b in range(0, len(w), 1 << 16):
                ww, aa = w[b:b + (1 << 16)], a[b:b + (1 << 16)]
                near = (notes[:, ww].T != self.notes[aa]).mean(1) <= NEAR
                pairs.append((ww[near], aa[near]))
        return tuple(np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2

    def best(self, k: int, text: str) -> tuple[int, int, int]:
        """(edits, start, end) of the substring of ``text`` that is nearest to item k."""
        item = self.texts[k]
        edits, end = _nearest(self._mask(k, False), len(item), text)
        if edits > MAX_EDITS * len(item):
            return edits, 0, 0
        _, length = _nearest(self._mask(k, True), len(item), text[:end][::-1], True)
        return edits, end - length, end

    def _mask(self, k: int, back: bool) -> dict[str, int]:
        if (k, back) not in self.masks:
            mask: dict[str, int] = {}
            for i, c in enumerate(reversed(self.texts[k]) if back else self.texts[k]):
                mask[c] = mask.get(c, 0) | 1 << i
            self.masks[k, back] = mask
        return self.masks[k, back]


def _nearest(mask: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(least edits, end) over substrings of text, or over its prefixes; bit-parallel columns."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, edits = full, 0, m
    least, end = m, 0
    for i, c in enumerate(text, 1):
        eq = mask.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        hp = down | (full & ~(xh | up))
        hn = up & xh
        edits += bool(hp & top) - bool(hn & top)
        hp = (hp << 1 | anchored) & full
        hn = (hn << 1) & full
        up = hn | (full & ~(xv | hp))
        down = hp & xv
        if edits < least:
            least, end = edits, i
    return least, end


def search(column: pa.Array, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits) of every occurrence's best place per row and item; code points."""
    if not len(items.owner):
        return
    for at, rows, data, offsets in blocks(column):
        if not len(data):
            continue
        points = _points(data.tobytes())
        begin = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        signs, kept = _signs(points)
        first = np.searchsorted(kept, begin)
        starts = np.union1d(_starts(signs), first[:-1][first[:-1] < first[1:]])
        notes = walk(np.append(signs, np.zeros(STEPS, np.uint8)), starts)
        window, anchor = items.candidates(notes)
        if not len(window):
            continue
        # from here on, places count normalised code points of their row
        row = np.searchsorted(first, starts[window], "right") - 1
        guess = starts[window] - first[row] - items.offset[anchor]
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        texts: dict[int, str] = {}
        tried: set[tuple[int, int, int]] = set()
        for r, k, g in zip(row.tolist(), items.owner[anchor].tolist(), guess.tolist()):
            size = len(items.texts[k])
            slack = int(MAX_EDITS * size) + 4
            if (r, k, g // slack) in tried:
                continue
            tried.add((r, k, g // slack))
            if r not in texts:
                texts[r] = normal(data[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8"))
            low = max(0, g - slack)
            edits, s, e = items.best(k, texts[r][low:g + size + slack])
            if edits <= MAX_EDITS * size and (edits, low + s) < found.get((r, k), (edits + 1, 0))[:2]:
                found[r, k] = (edits, low + s, low + e)
        for (r, k), (edits, s, e) in sorted(found.items()):
            raw = kept[first[r]:first[r + 1]] - begin[r]
            yield at + r, k, int(raw[s]), int(raw[e - 1]) + 1, edits


def _slices(benchmark: DataFrame) -> Iterator[Items]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.char_length("text")).alias("n")).first().n or 0
    n = max(1, -(-2 * total // SLICE_CHARS))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield Items([(r.item_id, r.text) for r in own.sort("item_id", "text").collect()])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: the best place of every item that a document contains."""
    out = None
    for items in _slices(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column("doc_id")
                rows = list(search(b.column("text"), sent.value))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([sent.value.ids[r[1]] for r in rows], pa.int64()),
                     *[pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4)]],
                    names=["doc_id", "item_id", "start", "end", "edits"])

        one = plain_documents(docs).mapInArrow(run, "doc_id long, item_id long, start long, end long, edits long")
        out = one if out is None else out.union(one)
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns stay, nothing is shuffled."""
    out, at = docs, docs.columns.index("text")
    for items in _slices(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                stays = np.ones(b.num_rows, bool)
                for r in search(b.column(at).cast(pa.string()), sent.value):
                    stays[r[0]] = False
                yield b.filter(pa.array(stays))

        out = out.mapInArrow(run, docs.schema)
    return out
