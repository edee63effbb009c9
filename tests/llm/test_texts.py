"""Operators that judge each document by itself, against the libraries and brute force."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq

from segmint.llm import chat_format, decontaminate, packing, pii_surrogates, quality_pu, token_counts, url_filter
from segmint.llm import registry as R
from segmint.plans.compare import compare
from tests.conftest import SF_ORACLE, SF_SMALL

PIECE, WORD = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")


def documents(sf=SF_SMALL):
    return pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()


def noise(alphabet, n, seed, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


# --- token counts -------------------------------------------------------------

def test_piece_counts_equal_the_library():
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = (["", " ", "a", "</s><s> [INST]", "a" * 3000, " " * 500, "\x00a", "=" * 77]
             + noise("ab \n▁é<s>/'ing12漢😀\t", 2000, 1) + noise("thesinagr ", 500, 2, 200) + noise(" -=_*.#", 500, 3))
    n_bytes, n_tokens = token_counts.PieceCounter(PIECE).count(pa.array([*texts, None]))
    assert n_tokens.tolist() == [len(x) for x in lib.encode(texts)] + [0]
    assert n_bytes.tolist() == [len(t.encode()) for t in texts] + [0]


def test_piece_counts_query(llm):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    docs = documents()
    want = {d["doc_id"]: (len(d["text"].encode()), len(lib.encode(d["text"]))) for d in docs}
    got = R.QUERIES["op5_token_counts"](llm, SF_SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_piece_counts_edges(edge, empty):
    got = token_counts.count_tokens(edge, PIECE).collect()
    assert len(got) == edge.count() and sum(r.n_tokens == 0 for r in got) == 3
    assert token_counts.count_tokens(empty, PIECE).count() == 0


# --- packing -------------------------------------------------------------------

def test_cuts_are_binary_and_gapless():
    for n in [*range(1, 300), 4095, 4096, 4097, 8191, 100_001]:
        cuts = packing.cuts(n)
        assert [s for s, _ in cuts] == [sum(x for _, x in cuts[:k]) for k in range(len(cuts))]
        assert sum(x for _, x in cuts) == n and all(x & (x - 1) == 0 and x <= 4096 for _, x in cuts)
        assert sorted((x for _, x in cuts), reverse=True) == [x for _, x in cuts]


def test_encoder_equals_the_library():
    frag = ["ab", "Zé", "\u0301", " ", "\n", "'s", "'", "'re", "12", "!", "$", "-", "ß", "İ", "ΑΣ", "<|endoftext|>",
            "<|END", "漢", "😀", "\x00", "\u00a0", "²", "…", "—", "<", "\u0338", "="]
    rng = random.Random(4)
    texts = ["", None, "</s>"] + ["".join(rng.choice(frag) for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    enc = packing.WordEncoder(WORD)
    got = []
    for _, counts, ids in enc.encode(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_packing_query_round_trip(llm):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD)
    docs = documents()
    ids = {d["doc_id"]: e.ids + [2] for d, e in zip(docs, tok.encode_batch([d["text"] for d in docs],
                                                                            add_special_tokens=False))}
    rows = R.QUERIES["op2_packing"](llm, SF_SMALL).collect()
    seen = {i: 0 for i in ids}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *own)) and 1 << r.bucket == r.length
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in ids.items()}
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_packing_edges_and_buckets(llm, edge, empty, tmp_path):
    rows = packing.pack(edge, WORD)
    assert rows.where("doc_tokens = 1").count() == 4  # null, empty and blank texts: the end id alone
    assert packing.pack(empty, WORD).count() == 0
    packing.write_buckets(rows, str(tmp_path / "b"))
    assert llm.read.parquet(str(tmp_path / "b")).count() == rows.count()


# --- chat ------------------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, parts string, n int"


def test_chat_query_matches_sql(llm):
    assert compare(llm, "op6_prefix_target", SF_SMALL, R.QUERIES, R.ORACLE)["status"] == "match"


def test_chat_reads_back_hostile_texts(llm):
    rng = random.Random(5)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", " [/ROLE] ", "\\", "\\\\", " ", "\n", "a", "$1", "<s>[ROLE] user [/ROLE] x </s>"]
    rows, want = [], {}
    for c in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "to\nol</s>", ""]),
                  "".join(rng.choice(bits) for _ in range(rng.randint(0, 7)))) for _ in range(rng.randint(1, 6))]
        want[c] = turns
        rows += [(c, t, r, x, "p", 1) for t, (r, x) in enumerate(turns)]
    examples = chat_format.expand(llm.createDataFrame(rows, TALK))
    for e in examples.collect():
        if e.target is not None:
            role, text = want[e.conv_id][e.target]
            assert role == "assistant"
    for r in chat_format.digest(examples).collect():
        turns = want[r.conv_id]
        loss = "".join(x for role, x in turns if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_edges(llm):
    rows = [(1, 0, None, None, "p", 1), (1, None, "assistant", "late", "p", 1), (None, 0, "assistant", "x", "p", 1),
            (2, 0, "assistant", "b", "p", 1), (2, 0, "assistant", "a", "p", 1), (2, 0, "assistant", "a", "p", 1)]
    got = {r.conv_id: r for r in chat_format.digest(chat_format.expand(llm.createDataFrame(rows, TALK))).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {1: (2, 4), None: (1, 1), 2: (3, 3)}
    assert got[2].loss_sha256 == hashlib.sha256(b"aab").hexdigest()
    assert chat_format.digest(chat_format.expand(llm.createDataFrame([], TALK))).count() == 0


# --- quality ---------------------------------------------------------------------

def test_quality_held_out_accuracy(llm):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = R.QUERIES["op10_quality_pu"](llm, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert np.mean([b for a, b in held if a == 1]) > 0.99


def test_class_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    one = lambda n, m: np.hstack([rng.normal(m, 1, (n, 3)), np.ones((n, 1))])
    for prior in (0.3, 0.7):
        mixed = np.vstack([one(int(4000 * prior), 2), one(int(4000 * (1 - prior)), -2)])
        got = quality_pu.class_prior(one(3000, 2), mixed[rng.permutation(len(mixed))])
        assert abs(got - prior) < 0.06


def test_quality_edges(llm, edge, empty):
    labels = llm.createDataFrame([(6, 1), (6, 1), (5, None), (None, 1), (7, 0)], "doc_id long, quality int")
    w, _ = quality_pu.fit(edge, labels)
    assert quality_pu.score(edge, w).count() == edge.count()
    w, prior = quality_pu.fit(empty, labels.limit(0))
    assert not w.any() and quality_pu.score(edge, w).where("score <> 0.5").count() == 0
    assert quality_pu.score(empty, w).count() == 0
    assert quality_pu.keep_good(edge, w).columns == edge.columns and quality_pu.keep_good(edge, w).count() == edge.count()


# --- urls --------------------------------------------------------------------------

def _rule(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.RULES:
        h, s, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(s + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def test_url_rules_by_brute_force(llm):
    urls = ["http://ORG/", "http://org", "https://a.example.org/es/1?x", "http://b.example.org/en/12#t", "HTTP://x.COM/FR/",
            "http://x.com/fr/", "ftp://y.com/de/", "nothing", "", None, "http://u://v.org/", "http://notorg/", "http://com/de/",
            "http://Ä.org/a\nb", "http://example.org/en/2", "://org/x", "http://h?q=org/"]
    df = llm.createDataFrame([(i, u, "<p>some words</p>", "s", 0.5) for i, u in enumerate(urls)],
                             "page_id long, url string, html string, shape string, score double")
    for r in url_filter.judge(df).collect():
        host, path, best = _rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0)).count() == 0
    both = url_filter.judge(df.union(df)).count()
    assert both == 2 * len(urls)


def test_url_query(llm):
    pages = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in R.QUERIES["op4_url_words"](llm, SF_SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        host, path, best = _rule(p["url"])
        r = got[p["page_id"]]
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]) and r.verdict in ("allow", "block")


def test_viterbi_against_all_splits():
    known = {"the": 50, "rest": 20, "there": 10, "st": 3, "he": 5, "t": 1, "free": 30, "bets": 9, "be": 40, "ts": 1}

    def cost(w, total=200):
        return np.log(known[w] / total) if w in known else np.log(10 / total) - len(w) * np.log(10)

    def splits(s):
        return [[s]] + [[s[:i]] + x for i in range(1, len(s)) for x in splits(s[i:])]

    for s in ("therest", "freebets", "zzthe", "theretheq"):
        spans = {(i, j): known[s[i:j]] for i in range(len(s)) for j in range(i + 1, len(s) + 1) if s[i:j] in known}
        got = url_filter.viterbi(s, spans, 200)
        assert abs(sum(map(cost, got)) - max(sum(map(cost, x)) for x in splits(s))) < 1e-9


# --- decontamination -----------------------------------------------------------------

def test_decontamination_finds_every_exact_item(llm):
    items = pq.read_table(f"{SF_ORACLE}/benchmark.parquet").to_pylist()
    docs = documents(SF_ORACLE)
    norm = {d["doc_id"]: decontaminate.normal(d["text"]) for d in docs}
    want = {(i, b["item_id"]) for b in items for i, t in norm.items() if decontaminate.normal(b["text"]).strip() in t}
    rows = R.QUERIES["op8_cgk_decontamination"](llm, SF_ORACLE).collect()
    assert want and {(r.doc_id, r.item_id) for r in rows if r.edits == 0} == want
    text, item = {d["doc_id"]: d["text"] for d in docs}, {b["item_id"]: b["text"] for b in items}
    for r in rows:
        if r.edits == 0:
            assert decontaminate.normal(text[r.doc_id][r.start:r.end]) == decontaminate.normal(item[r.item_id]).strip()


def _edited(text, n, rng):
    s = list(text)
    for _ in range(n):
        p, kind = rng.randrange(len(s)), rng.random()
        if kind < 1 / 3:
            s[p] = rng.choice("etaonis ")
        elif kind < 2 / 3:
            del s[p]
        else:
            s.insert(p, rng.choice("etaonis "))
    return "".join(s)


def test_decontamination_recall_under_edits_and_distance():
    rng = random.Random(6)
    items = [(b["item_id"], b["text"]) for b in pq.read_table(f"{SF_ORACLE}/benchmark.parquet").to_pylist()]
    made = decontaminate.Items(items)
    base = [d["text"] for d in documents(SF_ORACLE) if 1500 < len(d["text"]) < 4000][:len(items)]
    texts = []
    for (_, t), b in zip(items, base):
        c = b.index(" ", len(b) // 2)
        texts.append(b[:c] + "\n" + _edited(t, int(0.05 * len(t)), rng) + " " + b[c:])
    found = {(r, k) for r, k, *_ in decontaminate.search(pa.array(texts), made)}
    assert np.mean([(k, k) in found for k in range(len(base))]) > 0.95

    def levenshtein_substring(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    for k, (_, t) in enumerate(items[:6]):
        t = decontaminate.normal(t).strip()
        window = "xx " + _edited(t, 9, rng) + " yy"
        mask = made._mask(k, False)
        assert decontaminate._nearest(mask, len(t), window)[0] == levenshtein_substring(t, window)


def test_decontamination_edges(llm, edge, empty):
    items = llm.createDataFrame([(1, None), (2, ""), (None, LONG_ITEM), (3, "tiny"), (3, LONG_ITEM)],
                                "item_id long, text string")
    docs = edge.union(llm.createDataFrame([(50, f"before {LONG_ITEM.upper()} after", "", "", "", "")], edge.schema))
    got = sorted((r.doc_id, r.item_id or 0, r.edits) for r in decontaminate.leaks(docs, items).collect())
    assert got == [(50, 0, 0), (50, 3, 0)]
    assert decontaminate.drop_leaked(docs, items).count() == docs.count() - 1
    assert decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_leaked(docs, items).columns == docs.columns


LONG_ITEM = "Which of these seven statements about slow rivers is the one that no reader would call false?"


# --- personal data -------------------------------------------------------------------

KEY = b"k"


def _check_surrogates(texts, rows):
    """texts and rows (text, replaced) by id: what was found is gone, clean text stays, the mapping is one to one."""
    mapping, originals = {}, set()
    for i, t in texts.items():
        spans = pii_surrogates.detect(t)
        new, replaced = rows[i]
        assert len(spans) == len(replaced)
        rest_old, rest_new, a, b = [], [], 0, 0
        for (s, e, kind, entity), r in zip(spans, replaced):
            rest_old.append(t[a:s])
            rest_new.append(new[b:r["start"]])
            a, b = e, r["end"]
            made = pii_surrogates.canonical(kind, new[r["start"]:r["end"]])
            mapping.setdefault((kind.split(":")[0], entity), set()).add(made)
            originals.add((kind.split(":")[0], entity))
        if t is not None:
            assert rest_old + [t[a:]] == rest_new + [new[b:]]
    assert all(len(v) == 1 for v in mapping.values())
    made = [(k, x) for (k, _), v in mapping.items() for x in v]
    assert len(set(made)) == len(made) and not set(made) & originals


def test_surrogates_query(llm):
    texts = {d["doc_id"]: d["text"] for d in documents()}
    rows = {r.doc_id: (r.text, r.replaced) for r in R.QUERIES["op1_pii_surrogates"](llm, SF_SMALL).collect()}
    _check_surrogates(texts, rows)


def test_surrogates_formats_and_coreference(llm, edge, empty):
    t = ("Dr. Anna Schmidt met Mr. Schmidt; call 310-555-4510 or +1 (310) 555-4510. DE89370400440532013000, 10.1.2.3,"
         " card 4111 1111 1111 1111, a.b@c-d.org and A.B@C-D.ORG, г-жа Мария Иванова, 123-45-6789")
    df = llm.createDataFrame([(1, t, "x", "y"), (2, None, "x", "y"), (3, "clean text", "x", "y"), (None, "q@w.de", "x", "y")],
                             "doc_id long, text string, spans string, rk string")
    rows = {r.doc_id: (r.text, r.replaced) for r in pii_surrogates.replace_pii(df, KEY).collect()}
    _check_surrogates({1: t, 2: None, 3: "clean text", None: "q@w.de"}, rows)
    by = {}
    for x in rows[1][1]:
        by.setdefault(x["kind"], []).append(rows[1][0][x["start"]:x["end"]])
    assert by["given:f:latin"][0] in pii_surrogates.GIVEN["latin", "f"] and len(set(by["surname:latin"])) == 1
    assert re.sub(r"\D", "", by["phone"][1])[1:] == re.sub(r"\D", "", by["phone"][0])
    assert pii_surrogates._mod97(by["iban"][0]) == 1 and by["ipv4"][0].startswith("10.")
    assert pii_surrogates.luhn(by["number"][0].replace(" ", "")) and by["email"][1] == by["email"][0].upper()
    assert pii_surrogates.script(by["given:f:cyrillic"][0]) == "cyrillic"
    assert rows[2][0] is None and rows[3][0] == "clean text"
    got = pii_surrogates.replace_pii(edge, KEY)
    assert got.count() == edge.count() and got.where("size(replaced) > 0").count() == 0
    assert pii_surrogates.replace_pii(empty, KEY).count() == 0


def test_surrogate_collisions_are_refused(llm):
    # a space of few numbers: proposals meet one another and the corpus's own entities
    entities = llm.createDataFrame([("number", f"{i:013d}") for i in range(40)], "kind string, entity string")
    got = pii_surrogates.assign(entities, KEY,
                                lambda key, kind, e, attempt: f"{(int(e) * 7 + attempt * 13) % 100:013d}").collect()
    assert len(got) == 40 == len({r.surrogate for r in got}) and all(int(r.surrogate) >= 40 for r in got)
