"""Words that polynomial hashes cannot tell apart, names that clash, a vocabulary package that is not there."""

import random
import subprocess
import sys

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from segmint.llm import exact_dedup, near_dedup, packing, token_counts
from segmint.llm.arrays import word_hashes
from segmint.llm.remember import Memory, spans


def thue_morse(n):
    """The word and its complement: equal under every polynomial modulo 2**64 from 1,024 letters on."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_one_polynomial_hash_keep_their_own_ids_and_counts():
    import sentencepiece
    texts = list(thue_morse(1024) + thue_morse(2048))
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    enc = packing.WordEncoder(P.path("word_bpe_49k.json"))
    got = [x.tolist() for _, c, ids in enc.encode(pa.array(texts)) for x in np.split(ids, np.cumsum(c)[:-1])]
    assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    piece = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    _, n = token_counts.PieceCounter(P.path("piece_bpe_32k.model")).count(pa.array(texts))
    assert n.tolist() == [len(x) for x in piece.encode(texts)]


def test_documents_of_such_words_are_no_near_duplicates(llm):
    one, two = thue_morse(1024)
    docs = llm.createDataFrame([(1, f"{one} " * 6), (2, f"{two} " * 6)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()) == [(1, 1), (2, 2)]


def test_word_hashes_depend_on_bytes_and_length_only():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abAB\x00\xff", k=rng.randint(1, 40))) for _ in range(5000)} | {b"a" * n for n in range(1, 60)})
    for fold in (False, True):
        got = {}
        for order in (words, words[::-1]):
            data = np.frombuffer(b"".join(order), np.uint8)
            ends = np.cumsum([len(w) for w in order])
            for w, h in zip(order, word_hashes(data, ends - [len(w) for w in order], ends, fold).tolist()):
                key = w.lower() if fold else w
                assert got.setdefault(key, h) == h
        assert len(set(got.values())) == len(got)


def test_memory_that_forgets_gives_the_same_values():
    asked = []
    memory = Memory(lambda parts: asked.extend(parts) or pa.array([len(p) for p in parts], pa.int64()), 50, longest=6)
    rng = random.Random(1)
    for _ in range(30):
        parts = [bytes(rng.choices(b"xy", k=rng.randint(1, 9))) for _ in range(40)]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        got = memory.look_up(spans(np.frombuffer(b"".join(parts), np.uint8), bounds))
        assert got.to_pylist() == [len(p) for p in parts]
        assert len(memory.known) <= 50 and all(len(p) <= 6 for p in memory.known.to_pylist())


def test_exact_dedup_keeps_columns_of_any_name(llm):
    names = ["doc_id", "text", "_sha", "_id", "_gone", "own_sha", "gone_id", "gone_sha", "kept", "keep_id"]
    rows = [(i, t, *(f"{n}{i}" for n in names[2:])) for i, t in [(1, "a  b"), (2, "a b"), (3, "c"), (4, None), (5, "")]]
    docs = llm.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    out = exact_dedup.drop_copies(docs)
    assert out.columns == names and sorted(tuple(r) for r in out.collect()) == [r for r in rows if r[0] in (1, 3, 4)]


def test_entry_works_without_the_vocabularies():
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e;"
            "q = e.queries(); assert 'schema_counts' in q and 'op2_packing' not in q and len(q) > 50")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
