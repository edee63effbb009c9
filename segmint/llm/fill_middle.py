"""Fill-in-the-middle: a text is cut at two drawn places and written as prefix, suffix, middle.

Every byte of a block of texts gets a character class (see ``character_classes``) and the classes of
the block go into one wavelet matrix.  The classes are ordered so that the first bytes of characters,
of words and of lines each are a range of classes: the units in a stretch of text are a difference of
two rank queries, and the place behind ``k`` units comes from bisection on these ranks.  All texts of a
block are asked at once.

Which places, and which form, depends on ``sha256("<seed>:<doc_id>")`` alone, so a retried task or
another partitioning gives the same rows.  With ``n`` units the first two of its 32-bit groups modulo
``n + 1`` are the cuts; the third says whether the text stays plain, the fourth whether the suffix comes
first (``spm``) or the prefix (``psm``).  A text that is empty or contains a sentinel stays plain.

Defined cases: null counts as empty, and the empty text is plain.  A null doc_id is drawn from
``"<seed>:"``; null and repeated doc_ids stay, row by row, and rows of one id and text get one result.
A text without a unit (blanks only, by words) is cut at its start twice.  Other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.arrays import SPACE, blocks
from segmint.llm.common import plain_documents

#: Marks in front of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 texts so many stay plain, and of the others so many of 100 begin with the suffix.
PLAIN_PERCENT, SPM_PERCENT = 10, 20

_INSIDE, _PLAIN, _WORD, _WORD_AND_LINE, _LINE = range(5)
#: The classes (from, up to) that begin a unit.
UNITS = {"char": (_PLAIN, _LINE), "word": (_WORD, _WORD_AND_LINE), "line": (_WORD_AND_LINE, _LINE)}
_BITS = 3


class WaveletMatrix:
    """Rank over a sequence of small numbers, for arrays of places at once.

    Level by level, from the highest bit, the numbers are dealt stably into those without and those
    with the bit; a level keeps its bits in 64-bit words with the ones counted before each word.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.size, self.levels = len(symbols), []
        x = symbols
        for b in range(bits - 1, -1, -1):
            bit = (x >> b) & 1
            packed = np.packbits(bit.astype(bool), bitorder="little")
            words = np.zeros(len(x) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self.levels.append((b, words, before, len(x) - int(before[-1])))
            x = np.concatenate([x[bit == 0], x[bit == 1]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[w] + np.bitwise_count(words[w] & low)

    def below(self, symbol: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many numbers under ``symbol`` stand in each ``[lo, hi)``."""
        if symbol >= 1 << len(self.levels):
            return hi - lo
        out = np.zeros(len(lo), np.int64)
        for b, words, before, zeros in self.levels:
            one_lo, one_hi = self._ones(words, before, lo), self._ones(words, before, hi)
            if (symbol >> b) & 1:
                out += (hi - one_hi) - (lo - one_lo)
                lo, hi = zeros + one_lo, zeros + one_hi
            else:
                lo, hi = lo - one_lo, hi - one_hi
        return out

    def count(self, first: int, last: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many numbers from ``first`` to ``last`` stand in each ``[lo, hi)``."""
        return self.below(last + 1, lo, hi) - self.below(first, lo, hi)

    def place(self, first: int, last: int, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The greatest place in ``[lo, hi]`` with at most ``k`` such numbers between ``lo`` and it."""
        low, high = lo.copy(), hi + 1
        while (high - low > 1).any():
            mid = (low + high) >> 1
            fits = self.count(first, last, lo, mid) <= k
            low, high = np.where(fits, mid, low), np.where(fits, high, mid)
        return low


def character_classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A class per byte: inside a character, first byte of a character, of a word, of a line, of both."""
    n = len(data)
    begin = np.zeros(n + 1, bool)
    begin[offsets[:-1]] = True
    begin = begin[:n]
    gap = SPACE[data]
    line, word = begin.copy(), begin.copy()
    line[1:] |= data[:-1] == 0x0A
    word[1:] |= gap[:-1]
    word &= ~gap
    out = np.full(n, _PLAIN, np.uint8)
    out[(data & 0xC0) == 0x80] = _INSIDE
    out[word] = _WORD
    out[line] = _LINE
    out[word & line] = _WORD_AND_LINE
    return out


def draws(seed: int, doc_ids: list[int | None]) -> np.ndarray:
    """(rows, 4) unsigned 32-bit numbers, by seed and id alone."""
    own = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest() for i in doc_ids]
    return np.array([struct.unpack(">4I", d[:16]) for d in own], np.int64).reshape(-1, 4)


def fill_in_middle(docs: DataFrame, seed: int = 1, unit: str = "char", plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """doc_id, n, form, prefix_units, middle_units, output of every row of ``docs``; no shuffle.

    ``n`` is the number of units (``char``: code points, ``word``: words with the blanks behind them,
    ``line``); the two unit counts are null for a plain text.
    """
    first, last = UNITS[unit]
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for at, rows, data, offsets in blocks(batch.column("text")):
                own = ids.slice(at, rows)
                h = draws(seed, own.to_pylist())
                lo, hi = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
                matrix = WaveletMatrix(character_classes(data, offsets), _BITS)
                n = matrix.count(first, last, lo, hi)
                k = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                cuts = [np.where(c == 0, lo, matrix.place(first, last, lo, hi, c)) for c in k.T]
                raw = data.tobytes()
                forms, outputs = [], []
                for a, x, y, b, h3, h4 in zip(lo.tolist(), *(c.tolist() for c in cuts), hi.tolist(),
                                              *(h[:, 2:] % 100).T.tolist()):
                    text = raw[a:b]
                    if not text or h3 >= 100 - plain_percent or any(mark in text for mark in (p, s, m)):
                        forms.append("plain")
                        outputs.append(text)
                    elif h4 < spm_percent:
                        forms.append("spm")
                        outputs.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
                plain = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(n), pa.array(forms, pa.string()), pa.array(k[:, 0], mask=plain),
                     pa.array(k[:, 1] - k[:, 0], mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    return plain_documents(docs).mapInArrow(
        run, "doc_id long, n long, form string, prefix_units long, middle_units long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone.

    The text holds no sentinel, and none can begin inside it and end in a real one, so each is found
    at its only place.
    """
    part = F.split(output, "|".join(re.escape(x) for x in sentinels), -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
