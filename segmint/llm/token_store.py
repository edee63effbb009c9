"""Token ids of a corpus in files: Simple-8b words, in ascending doc_id order, read back at array speed.

A 64-bit word holds a selector in its upper 4 bits and ids of one width in the other 60 (``SELECTORS``):
sixty ids of 1 bit, four of 15, three of 20 and so on; the greatest number of next ids that fit is taken.
Selector 0 is the escape for ids of more than 60 bits: its payload is a place among the segment's
``escapes``, which hold such ids whole.

The files are Parquet.  A row is a segment: whole documents in order, together ``SEGMENT`` ids or more.

=========== ============== ===================================================================
part        int            the write task; parts follow each other in doc_id order
first       long           ids of the part before this segment
n_ids       long           ids of the segment
doc_ids     array<long>    its documents
lengths     array<long>    ids of each
offsets     binary         unsigned 32-bit, little-endian: first word of every block of ``BLOCK`` ids
words       binary         the words, little-endian
escapes     binary         unsigned 64-bit, little-endian
=========== ============== ===================================================================

A block begins a new word, so that any id is found by its block, and all blocks of a segment are coded
at once, word by word in step, and decoded selector by selector.

Rows are dealt by ranges of (doc_id, hash of the text, row), so neither a null nor a repeated doc_id
can fill one task.  Where a part begins in the corpus follows from the sums of the parts, at most
``MOST_PARTS`` rows.

Defined cases: null text counts as empty, and an empty text is the end id alone.  Null doc_ids come
first; rows of one doc_id stand in the order of their texts' hashes and all stay.  Other columns are
ignored; an empty table gives no segments.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segmint.llm.arrays import blocks
from segmint.llm.common import plain_documents
from segmint.llm.remember import Memory, spans

#: (ids in a word, bits of each) by selector; selector 0 is the escape, selector 1 a run of zeros.
SELECTORS = ((1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
_COUNT = np.array([c for c, _ in SELECTORS], np.int64)
_PAYLOAD = np.uint64((1 << 60) - 1)
#: Ids of a block, and the least of a segment that is not its part's last.
BLOCK, SEGMENT = 256, 16384
#: The sums of so many parts are broadcast at most (two numbers each).
MOST_PARTS = 1 << 16
_GROUP = 256
#: Distinct pieces of text whose ids a worker remembers, and their greatest length in bytes.
REMEMBERED, REMEMBERED_BYTES = 1 << 20, 64
_TEXT_BLOCK = 1 << 22

SEGMENTS = ("part int, first long, n_ids long, doc_ids array<long>, lengths array<long>,"
            " offsets binary, words binary, escapes binary")


# --- the code ---------------------------------------------------------------

def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, words, escapes) of unsigned 64-bit ``ids``."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    best = _best_selectors(ids, np.repeat(ends, ends - starts))
    # every block goes one word further in each round
    at, live, places, owners = starts.copy(), np.arange(len(starts)), [], []
    while len(live):
        places.append(at[live])
        owners.append(live)
        at[live] += _COUNT[best[at[live]]]
        live = live[at[live] < ends[live]]
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    place, owner = np.concatenate(places)[order], owner[order]
    selector = best[place]
    words = selector.astype(np.uint64) << np.uint64(60)
    padded = np.append(ids, np.zeros(int(_COUNT.max()), np.uint64))
    for s in np.unique(selector).tolist():
        count, bits = SELECTORS[s]
        k = np.flatnonzero(selector == s)
        if s == 0:
            words[k] |= np.arange(len(k), dtype=np.uint64)
        elif bits:
            j = np.arange(count)
            values = padded[place[k][:, None] + j]
            values[place[k][:, None] + j >= ends[owner[k]][:, None]] = 0  # the next block's
            words[k] |= np.bitwise_or.reduce(values << (j * bits).astype(np.uint64), axis=1)
    offsets = np.searchsorted(owner, np.arange(len(starts))).astype(np.uint32)
    return offsets, words, ids[place[selector == 0]]


def _best_selectors(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place the selector of the most ids from there to its block's end."""
    n = len(ids)
    where = np.arange(n)
    best = np.zeros(n, np.int64)  # what nothing else holds is escaped
    for s in range(len(SELECTORS) - 1, 0, -1):
        count, bits = SELECTORS[s]
        wide = ids >> np.uint64(bits) != 0
        if wide.all():
            break  # narrower ones fit nowhere either
        next_wide = np.where(wide, where, n)
        next_wide = np.minimum.accumulate(next_wide[::-1])[::-1]
        best[(next_wide >= np.minimum(where + count, ends)) & ~wide] = s
    return best


def decode(offsets: np.ndarray, words: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of a segment."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & _PAYLOAD
    held = _COUNT[selector]
    # a word's place: its block's, and what the words of the block before it hold
    before = np.cumsum(held) - held
    first = offsets.astype(np.int64)
    in_block = np.diff(np.append(first, len(words)))
    place = before - np.repeat(before[first], in_block) + np.repeat(np.arange(len(first)) * block, in_block)
    end = np.repeat(np.minimum((np.arange(len(first)) + 1) * block, n), in_block)
    for s in np.unique(selector).tolist():
        count, bits = SELECTORS[s]
        k = np.flatnonzero(selector == s)
        if s == 0:
            out[place[k]] = escapes[payload[k].astype(np.int64)]
        elif bits:
            j = np.arange(count)
            values = (payload[k][:, None] >> (j * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)
            to = place[k][:, None] + j
            own = to < end[k][:, None]
            out[to[own]] = values[own]
    return out


def decode_block(offsets: np.ndarray, words: np.ndarray, escapes: np.ndarray, n: int, b: int,
                 block: int = BLOCK) -> np.ndarray:
    """The ids of block ``b`` alone, from its words."""
    to = int(offsets[b + 1]) if b + 1 < len(offsets) else len(words)
    return decode(np.zeros(1, np.uint32), words[int(offsets[b]):to], escapes, min(block, n - b * block), block)


# --- text to ids -------------------------------------------------------------

#: Kinds of bytes that are certain: letter, sign, digit (Latin and Cyrillic letters beyond ASCII: ``_letters``).
_LETTER, _SIGN, _DIGIT = 1, 2, 3
_KIND = np.zeros(256, np.int8)
_KIND[33:127] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_APOSTROPHE = 39
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A, 0x09, 0x0D]] = True
#: First bytes of two-byte letters: U+00C0 to U+027F but the signs U+00D7 and U+00F7, U+0400 to U+047F.
_TWO = np.zeros(256, bool)
_TWO[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = True
#: A piece that is one pre-token, after the rules below.
_ONE = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9\xd0\xd1][\x80-\xbf])+"
                  rb"|[0-9]+|[!-&(-/:-@\[-`{-~]+)")
#: A byte-level vocabulary writes a byte as its character where that is printable, the others behind U+0100 in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind, whether certainly the last byte of a character that is no white space) of each byte."""
    kind = _KIND[data]
    solid = kind > 0
    inner = (data & 0xC0) == 0x80
    if inner.any():
        two = inner[1:] & _TWO[data[:-1]] & ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
        kind[1:][two] = _LETTER
        kind[:-1][two] = _LETTER
        # white space beyond ASCII begins with C2, E1, E2 or E3
        solid[1:] |= inner[1:] & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        solid[2:] |= inner[2:] & (data[:-2] >= 0xE4) & (data[:-2] <= 0xEF)
        solid[3:] |= inner[3:] & (data[:-3] >= 0xF0)
    return kind, solid


class ByteEncoder:
    """Ids of whole texts for a byte-level vocabulary whose pre-tokens are a blank and a run of one kind.

    A pre-token ends before white space; behind a letter, digit or sign but the apostrophe, where another
    kind begins; before the last blank of several; and behind a line feed or tab that something follows.
    Texts are cut where that is certain; each distinct piece, compared by its bytes, is encoded by the
    library once and remembered.  A text with a special string is encoded whole.
    """

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(lambda parts: pa.array(self._encode(parts), pa.list_(pa.uint32())), REMEMBERED, REMEMBERED_BYTES)

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(parts)
        other = []
        for i, p in enumerate(parts):
            if _ONE.fullmatch(p):
                text = p.decode("latin-1")
                text = text.replace(" ", "\u0120") if p.isascii() else text.translate(_BYTE_CHARS)
                out[i] = [t.id for t in self.model.tokenize(text)]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch([parts[i].decode() for i in other],
                                                           add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids per row, all their ids) of consecutive blocks of texts."""
        for at, rows, data, offsets in blocks(column, _TEXT_BLOCK):
            counts, ids = self._pieces(data, offsets)
            raw = data.tobytes()
            if any(x in raw for x in self.special):
                bounds = np.concatenate([[0], np.cumsum(counts)])
                each = [ids[bounds[r]:bounds[r + 1]] for r in range(rows)]
                for r in range(rows):
                    text = raw[offsets[r]:offsets[r + 1]]
                    if any(x in text for x in self.special):
                        each[r] = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
                counts, ids = np.array([len(x) for x in each]), np.concatenate(each)
            yield at, counts, ids

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.uint32)
        kind, solid = _letters(data)
        blank = _BLANK[data]
        cut, begin = np.zeros(n, bool), np.zeros(n, bool)
        begin[offsets[:-1][offsets[:-1] < n]] = True
        a, b = kind[:-1], kind[1:]
        cut[1:] = (solid[:-1] & blank[1:]) | ((a > 0) & (b > 0) & (a != b) & (data[:-1] != _APOSTROPHE))
        cut[1:] |= blank[:-1] & (data[:-1] != 0x20) & (b > 0)
        cut[1:-1] |= blank[:-2] & blank[1:-1] & (b[1:] > 0) & ~begin[2:]
        begins = np.flatnonzero(cut | begin)
        found = self.memory.look_up(spans(data, np.append(begins, n)))
        bounds = found.offsets.to_numpy()[np.searchsorted(begins, offsets)]
        return np.diff(bounds), found.flatten().to_numpy()


_ENCODERS: dict[str, ByteEncoder] = {}


# --- files -------------------------------------------------------------------

def _segment(part: int, first: int, doc_ids: list, lengths: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    offsets, words, escapes = encode(flat)
    row = [(part, pa.int32()), (first, pa.int64()), (len(flat), pa.int64()), (doc_ids, pa.list_(pa.int64())),
           (lengths, pa.list_(pa.int64())), (offsets.astype("<u4").tobytes(), pa.binary()),
           (words.astype("<u8").tobytes(), pa.binary()), (escapes.astype("<u8").tobytes(), pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in row], names=[
        "part", "first", "n_ids", "doc_ids", "lengths", "offsets", "words", "escapes"])


def write_ids(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 0, parts: int | None = None) -> None:
    """The ids of every text and ``end_id``, in ascending doc_id order, as files below ``path``.

    ``parts`` is the number of write tasks, ``spark.sql.shuffle.partitions`` unless given.
    """
    parts = min(parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = ByteEncoder(tokenizer_file)
        part, first, size = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, ids = [], [], []
        end = np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for at, counts, flat in _ENCODERS[tokenizer_file].encode(batch.column("text")):
                low = 0
                for r, c in enumerate(counts.tolist()):
                    doc_ids.append(names[at + r])
                    lengths.append(c + 1)
                    ids += [flat[low:low + c], end]
                    low, size = low + c, size + c + 1
                    if size >= SEGMENT:
                        yield _segment(part, first, doc_ids, lengths, ids)
                        first, size, doc_ids, lengths, ids = first + size, 0, [], [], []
        if doc_ids:
            yield _segment(part, first, doc_ids, lengths, ids)

    rows = plain_documents(docs).withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    (rows.repartitionByRange(parts, "doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "_row")
     .select("doc_id", "text").mapInArrow(run, SEGMENTS)
     .write.option("compression", "uncompressed").parquet(path))  # the words are dense already


def part_starts(segments: DataFrame) -> DataFrame:
    """(part, before): ids of all parts before each, by two levels of running sums."""
    totals = (segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
              .withColumn("_group", F.floor(F.col("part") / _GROUP).cast("int")))
    groups = totals.groupBy("_group").agg(F.sum("n").alias("n"))
    upto = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # at most MOST_PARTS / _GROUP rows
    groups = groups.select("_group", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (totals.withColumn("_own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, "_group")
            .select("part", (F.col("_base") + F.col("_own")).alias("before")))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document in the files.

    ``start`` counts the ids of all documents before it.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                ids = decode(np.frombuffer(s["offsets"], "<u4"), np.frombuffer(s["words"], "<u8"),
                             np.frombuffer(s["escapes"], "<u8"), s["n_ids"]).astype("<u4").tobytes()
                lengths = np.array(s["lengths"], np.int64)
                at = np.cumsum(lengths) - lengths
                own = [ids[4 * a:4 * (a + n)] for a, n in zip(at.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), s["part"], np.int32)), pa.array(s["doc_ids"], pa.int64()),
                     pa.array(s["first"] + at), pa.array(lengths), pa.array(own, pa.binary())],
                    names=["part", "doc_id", "at", "n_tokens", "ids"])

    rows = segments.mapInArrow(run, "part int, doc_id long, at long, n_tokens long, ids binary")
    return (rows.join(F.broadcast(part_starts(segments)), "part")
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids"))
