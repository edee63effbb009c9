"""Packing by power-of-two decomposition.

A document of L ids (its tokens and one end id) is cut along the binary digits of L: pieces of
``MAX`` ids while they fit, then one piece for each power of two in the rest, longest first.  Each
piece is a sequence of its own, so no sequence crosses documents, none is padded, and sequences of
one bucket (the power of two) batch together.

Ids come from the tokenizers library.  White space is dropped by this vocabulary, and between an
ASCII letter, a digit and other ASCII signs (but the apostrophe) its pre-tokens always end; texts are
cut there, and each distinct piece of text, compared by its bytes, is encoded once and remembered per worker.  A text that
contains a special string is encoded whole.

Defined cases: null counts as empty, and an empty text is the end id alone.  Null and repeated
doc_ids stay, row by row.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.arrays import LOWER, SPACE, blocks
from segmint.llm.common import plain_documents
from segmint.llm.remember import Memory, spans

MAX = 4096
END_ID = 2
#: Distinct pieces of text whose ids a worker remembers.
REMEMBERED = 1 << 20

_FOLD = LOWER.astype(np.uint8)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN &= ~_LETTER & ~_DIGIT
_SIGN[39] = False  # the apostrophe may begin a pre-token such as 's


class WordEncoder:
    """Ids of whole texts, by way of remembered ids of their pieces."""

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(lambda parts: pa.array(self._encode([p.decode() for p in parts]), pa.list_(pa.uint32())), REMEMBERED)

    def _encode(self, parts: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(parts)
        other = []
        for i, p in enumerate(parts):
            if p.isascii() and p.isalpha():
                out[i] = [t.id for t in self.model.tokenize(p.lower())]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch([parts[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids per row, all their ids) of consecutive blocks of texts."""
        for at, rows, data, offsets in blocks(column):
            whole = [r for r in range(rows) if any(x in data[offsets[r]:offsets[r + 1]].tobytes() for x in self.special)] \
                if any(x in data.tobytes() for x in self.special) else []
            counts, ids = self._pieces(data, offsets)
            if whole:
                bounds = np.concatenate([[0], np.cumsum(counts)])
                each = [ids[bounds[r]:bounds[r + 1]] for r in range(rows)]
                for r in whole:
                    text = data[offsets[r]:offsets[r + 1]].tobytes().decode()
                    each[r] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                counts, ids = np.array([len(x) for x in each]), np.concatenate(each)
            yield at, counts, ids

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, n = len(offsets) - 1, len(data)
        if not n:
            return np.zeros(rows, np.int64), np.zeros(0, np.uint32)
        gap = SPACE[data]
        # kinds: 0 other, 1 letter, 2 sign, 3 digit; a cut where both sides are known and differ, or at a digit
        kind = _LETTER[data].astype(np.int8) + 2 * _SIGN[data] + 3 * _DIGIT[data]
        cut = np.ones(n, bool)
        a, b = kind[:-1], kind[1:]
        cut[1:] = gap[:-1] | ((a > 0) & (b > 0) & ((a != b) | (b == 3)))
        cut[offsets[:-1][offsets[:-1] < n]] = True
        begins = np.flatnonzero(cut | gap)
        ends = np.append(begins[1:], n)
        real = ~gap[begins]
        begins, ends = begins[real], ends[real]
        # pieces without the white space between them, A-Z folded as the vocabulary does
        bounds = np.concatenate([[0], np.cumsum(ends - begins)])
        found = self.memory.look_up(spans(_FOLD[data[~gap]], bounds))
        bounds = found.offsets.to_numpy()[np.searchsorted(begins, offsets)]
        return np.diff(bounds), found.flatten().to_numpy()


def cuts(length: int, most: int = MAX) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``length`` ids: binary digits, longest first."""
    out, at = [], 0
    while length - at >= most:
        out.append((at, most))
        at += most
    bit = most >> 1
    while bit:
        if (length - at) & bit:
            out.append((at, bit))
            at += bit
        bit >>= 1
    return out


_ENCODERS: dict[str, WordEncoder] = {}

PIECES = ("doc_id long, start long, length long, doc_tokens long, bucket int, ids binary")


def pack(docs: DataFrame, tokenizer_file: str, most: int = MAX, end_id: int = END_ID) -> DataFrame:
    """The sequences: doc_id, start, length, doc_tokens, bucket, ids, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers; ``bucket`` is the power of two; every piece is
    one sequence (offset 0).  Nothing is shuffled: ``sequence_id`` follows the order of the scanned
    rows, which a retried task reads again in the same order.
    """
    if most & (most - 1):
        raise ValueError("most must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            for at, counts, ids in _ENCODERS[tokenizer_file].encode(b.column("text")):
                rows, low = [], 0
                for r, c in enumerate(counts.tolist()):
                    own = np.append(ids[low:low + c], end_id).astype("<u4").tobytes()
                    low += c
                    rows += [(doc_ids[at + r], s, n, c + 1, n.bit_length() - 1, own[4 * s:4 * (s + n)])
                             for s, n in cuts(c + 1, most)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "start", "length", "doc_tokens", "bucket", "ids"])

    pieces = plain_documents(docs).mapInArrow(run, PIECES)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(sequences: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder for each length, ready for batches of one shape."""
    sequences.write.partitionBy("bucket").parquet(path)
