"""Simple-8b files: round trips of the code, ids as the library gives them, places in the corpus."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from segmint.llm import registry as R
from segmint.llm import token_store as S
from tests.conftest import SF_SMALL

BYTES = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
@pytest.mark.parametrize("widths", [(0,), (1,), (16,), (0, 1, 15, 16), tuple(range(65)), (61, 64)])
def test_code_round_trip(n, widths):
    rng = random.Random(n)
    ids = np.array([rng.getrandbits(rng.choice(widths)) for _ in range(n)], np.uint64)
    offsets, words, escapes = S.encode(ids)
    assert S.decode(offsets, words, escapes, n).tolist() == ids.tolist()
    assert escapes.tolist() == [x for x in ids.tolist() if x >= 1 << 60]
    for b in range(len(offsets)):
        assert S.decode_block(offsets, words, escapes, n, b).tolist() == ids[b * S.BLOCK:(b + 1) * S.BLOCK].tolist()


def test_words_follow_the_selector_table():
    """Decoded word by word, in plain Python."""
    rng = random.Random(1)
    ids = [rng.getrandbits(rng.choice((0, 3, 9, 15, 17, 33, 60, 63))) for _ in range(3000)]
    offsets, words, escapes = S.encode(np.array(ids, np.uint64))
    for b, start in enumerate(offsets.tolist()):
        own, got, at = ids[b * S.BLOCK:(b + 1) * S.BLOCK], [], start
        while len(got) < len(own):
            w = int(words[at])
            count, bits = S.SELECTORS[w >> 60]
            payload = w & ((1 << 60) - 1)
            got += [int(escapes[payload])] if w >> 60 == 0 else [
                (payload >> (bits * j)) & ((1 << bits) - 1) for j in range(count)]
            at += 1
        assert got[:len(own)] == own and not any(got[len(own):])
    assert len(S.encode(np.zeros(1200, np.uint64))[1]) < 20 and len(S.encode(np.full(1200, 30000))[1]) == 300


def hostile():
    rng = random.Random(2)
    bits = ["<|endoftext|>", "<|endof", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "don't", "!'re", "é", "漢字", " ", "　",
            " ", "\u0085", " ", "a", "Word", "12", "3", ".", "...", "\x00", "\x1c", "😀", "_", "   ", "ǅ", "²"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(20000)]


def test_ids_of_hostile_texts_equal_the_library(monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 400)
    monkeypatch.setattr(S, "_TEXT_BLOCK", 5000)
    texts = [*hostile(), "", " ", "x" * 3000, "ab" * 400 + " ab", "\n" * 100, "<|endoftext|>", "0110100110010110" * 64 + " 1001011001101001" * 64]
    lib = Tokenizer.from_file(BYTES)
    enc = S.ByteEncoder(BYTES)
    for _ in range(2):  # the second time with remembered pieces
        got = []
        for _, counts, ids in enc.encode(pa.array(texts)):
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def expected(docs):
    """Rows of (doc_id, text) in file order."""
    lib, at, out = Tokenizer.from_file(BYTES), 0, []
    for i, t in docs:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_against_the_library(llm):
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = R.QUERIES["op13_simple8b"](llm, SF_SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected(
        sorted((d["doc_id"], d["text"]) for d in docs))


@pytest.mark.parametrize("parts", [1, 7, 600])
def test_files_of_any_number_of_parts(llm, tmp_path, parts, monkeypatch):
    docs = [(i * 3 % 1000, f"text {i} " * (i % 50)) for i in range(1000)]
    S.write_ids(llm.createDataFrame(docs, "doc_id long, text string").repartition(5), BYTES, str(tmp_path / "a"), parts=parts)
    got = S.read_ids(llm, str(tmp_path / "a")).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in got) == [
        (a, i, n, c) for i, a, n, c in expected(sorted(docs))]


def test_edges(llm, edge, empty, tmp_path):
    S.write_ids(edge.withColumns({"part": edge.k, "_tie": edge.k, "ids": edge.k}), BYTES, str(tmp_path / "e"), end_id=9)
    rows = sorted(S.read_ids(llm, str(tmp_path / "e")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows[:2]] == [None, None] and [r.doc_id for r in rows[2:]] == sorted(r.doc_id for r in rows[2:])
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]).tolist()
    assert all(r.ids[-4:] == b"\x09\0\0\0" and len(r.ids) == 4 * r.n_tokens for r in rows) and len(rows) == edge.count()
    S.write_ids(empty, BYTES, str(tmp_path / "0"))
    assert S.read_ids(llm, str(tmp_path / "0")).count() == 0
