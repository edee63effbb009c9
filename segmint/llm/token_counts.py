"""Token counts for a piece vocabulary by rank-synchronous merging of ragged numpy arrays.

The vocabulary is a sentencepiece BPE model with byte fallback.  Texts become code points, a blank
the mark U+2581, with one mark in front.  Two neighbouring code points that stand side by side in no
piece can never merge; texts are cut there into pre-tokens.  The distinct pre-tokens of a batch are
one ragged array: in each round every pre-token applies its own lowest rank, at all its places at
once, until no pair is left; the surviving symbols are counted.  A code point without a piece counts
its UTF-8 bytes.

A round equals the sequential left-to-right order: places are applied only up to the first one whose
new neighbour pairs rank as low or lower, as those would come next.

Defined cases: null counts as empty, and the empty text has no token; null and repeated doc_ids stay,
one row per row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from segmint.llm.arrays import blocks
from segmint.llm.common import plain_documents
from segmint.llm.remember import Memory, spans

MARK = 0x2581
NONE = np.int32(2**31 - 1)
#: Distinct pre-tokens whose counts a worker remembers (16 bytes each).
REMEMBERED = 1 << 20


class PieceCounter:
    """Counts tokens as the sentencepiece library would, for one model file."""

    def __init__(self, model_file: str):
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(m.get_piece_size())
               if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        pieces = [m.id_to_piece(i) for i in ids]
        scores = np.array([m.get_score(i) for i in ids])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        at = {p: k for k, p in enumerate(pieces)}
        self.size = len(pieces)
        self.char = np.full(0x110000, -1, np.int32)
        near: set[tuple[int, int]] = set()
        found: dict[int, int] = {}
        for p, k in at.items():
            if len(p) == 1:
                self.char[ord(p)] = k
            for a, b in zip(p, p[1:]):
                near.add((ord(a), ord(b)))
            for c in range(1, len(p)):
                left, right = at.get(p[:c]), at.get(p[c:])
                if left is not None and right is not None:
                    found[left * self.size + right] = k
        self.pairs = np.array(sorted(found), np.int64)
        self.merged = np.array([found[x] for x in self.pairs.tolist()], np.int32)
        self.ranks = rank[self.merged]
        self.near = np.array(sorted((a << 21) | b for a, b in near), np.int64)
        self._near_low = self._low_table(near)
        # a code point takes four bytes
        self.memory = Memory(self._count_parts, REMEMBERED, 256)

    @staticmethod
    def _low_table(near: set[tuple[int, int]]) -> np.ndarray:
        t = np.zeros((512, 512), bool)  # for most texts' letters, without a search
        for a, b in near:
            a, b = (511 if a == MARK else a), (511 if b == MARK else b)
            if a < 512 and b < 512:
                t[a, b] = True
        return t

    def may_join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether code points a, b stand side by side in a piece."""
        x = np.where(a == MARK, 511, a)
        y = np.where(b == MARK, 511, b)
        low = (x < 512) & (y < 512) & (a != 511) & (b != 511)
        out = np.zeros(len(a), bool)
        out[low] = self._near_low[x[low], y[low]]
        rest = np.flatnonzero(~low)
        if len(rest):
            key = (a[rest].astype(np.int64) << 21) | b[rest]
            k = np.minimum(np.searchsorted(self.near, key), len(self.near) - 1)
            out[rest] = self.near[k] == key
        return out

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or NONE, merged piece) of each pair of pieces."""
        key = left.astype(np.int64) * self.size + right
        k = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[k] == key
        return np.where(hit, self.ranks[k], NONE), np.where(hit, self.merged[k], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols that survive in each ragged sequence (each at least one symbol long)."""
        out = np.ones(len(lengths), np.int32)
        who = np.arange(len(lengths))
        sym, lens = symbols, lengths.astype(np.int64)

        def ranked(sym, lens):
            rk, mg = np.full(len(sym), NONE), np.full(len(sym), -1, np.int32)
            ends = np.cumsum(lens) - 1
            inner = np.ones(len(sym), bool)
            inner[ends] = False
            i = np.flatnonzero(inner)
            rk[i], mg[i] = self.pair(sym[i], sym[i + 1])
            return rk, mg

        rk, mg = ranked(sym, lens) if len(sym) else (None, None)
        while len(who):
            first = np.cumsum(lens) - lens
            low = np.minimum.reduceat(rk, first)
            live = low != NONE
            if not live.all():
                out[who[~live]] = lens[~live]
                keep = np.repeat(live, lens)
                sym, rk, mg = sym[keep], rk[keep], mg[keep]
                who, lens, low = who[live], lens[live], low[live]
                if not len(who):
                    break
                first = np.cumsum(lens) - lens
            n = len(sym)
            seq = np.repeat(np.arange(len(lens)), lens)
            best = rk == low[seq]
            # overlapping places (aaa): from the left, every second one
            place = np.flatnonzero(best)
            new_run = np.ones(len(place), bool)
            new_run[1:] = np.diff(place) != 1
            run = np.cumsum(new_run) - 1
            place = place[(place - place[new_run][run]) % 2 == 0]
            # stop behind the first place whose new pairs come before what is left of this rank
            got, s = mg[place], seq[place]
            sel = np.zeros(n, bool)
            sel[place] = True
            bad = np.zeros(len(place), bool)
            has_right = place + 2 < first[s] + lens[s]
            r = np.flatnonzero(has_right)
            bad[r] = self.pair(got[r], sym[place[r] + 2])[0] <= low[s[r]]
            has_left = place > first[s]
            r = np.flatnonzero(has_left)
            before = place[r] - 1
            joined = (before > 0) & sel[np.maximum(before - 1, 0)] & (before - 1 >= first[s[r]])
            left = np.where(joined, mg[np.maximum(before - 1, 0)], sym[before])
            bad[r] |= self.pair(left, got[r])[0] <= low[s[r]]
            if bad.any():
                c = np.cumsum(bad)
                begin = np.concatenate([[True], s[1:] != s[:-1]])
                base = (c - bad)[begin][np.cumsum(begin) - 1]
                place = place[(c - bad) - base == 0]
                got, s = mg[place], seq[place]
            sym = sym.copy()
            sym[place] = got
            keep = np.ones(n, bool)
            keep[place + 1] = False
            touched = np.zeros(n, bool)
            touched[place] = True
            touched[place[place > 0] - 1] = True
            # the symbol before a merged one may itself be gone: then the one before that changes
            gone = place[place > 1]
            touched[gone[~keep[gone - 1]] - 2] = True
            lens = lens - np.bincount(s, minlength=len(lens))
            sym, rk, mg, touched = sym[keep], rk[keep], mg[keep], touched[keep]
            last = np.zeros(len(sym), bool)
            last[np.cumsum(lens) - 1] = True
            rk[last], mg[last] = NONE, -1
            i = np.flatnonzero(touched & ~last)
            rk[i], mg[i] = self.pair(sym[i], sym[i + 1])
        return out

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, tokens) of each text."""
        n_bytes, n_tokens = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        for at, rows, data, offsets in blocks(column):
            n_bytes[at:at + rows] = np.diff(offsets)
            n_tokens[at:at + rows] = self._count_block(data, offsets)
        return n_bytes, n_tokens

    def _count_block(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(rows, np.int64)
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.int32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        width = np.diff(lead)
        full = np.flatnonzero(width > 0)
        # one mark in front of each text that isn't empty
        cp = np.insert(np.where(cp == 0x20, MARK, cp), lead[:-1][full], MARK)
        begins = lead[:-1][full] + np.arange(len(full))
        n = len(cp)
        cut = np.ones(n, bool)
        cut[1:] = ~self.may_join(cp[:-1], cp[1:])
        cut[begins] = True
        starts = np.flatnonzero(cut)
        tokens = self._pretokens(cp, starts)
        sums = np.add.reduceat(tokens, np.searchsorted(starts, begins))
        out = np.zeros(rows, np.int64)
        out[full] = sums
        return out

    def _pretokens(self, cp: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each of the consecutive pre-tokens that begin at ``starts``."""
        return self.memory.look_up(spans(cp, np.append(starts, len(cp)))).to_numpy()

    def _count_parts(self, parts: list[bytes]) -> pa.Array:
        """Tokens of each pre-token, given as 32-bit code points."""
        points = np.frombuffer(b"".join(parts), np.int32)
        m = np.array([len(p) // 4 for p in parts], np.int64)
        sym = self.char[points]
        first = np.cumsum(m) - m
        c = np.zeros(len(parts), np.int64)
        if len(parts):
            alone = sym[first] < 0  # without a piece: nothing joins it, so it stands alone
            p = points[first[alone]]
            c[alone] = 1 + (p >= 0x80) + (p >= 0x800) + (p >= 0x10000)
            c[~alone] = self.merge(sym[np.repeat(~alone, m)], m[~alone])
        return pa.array(c)


_COUNTERS: dict[str, PieceCounter] = {}


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_file not in _COUNTERS:
            _COUNTERS[model_file] = PieceCounter(model_file)
        for b in batches:
            n_bytes, n_tokens = _COUNTERS[model_file].count(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return plain_documents(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
