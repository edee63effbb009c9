"""URL filter: fixed rules first; else segmented host and path words, scored by naive Bayes.

* Words and their frequencies are counted over the whole visible text of all pages.
* Distinct parts of hosts and paths (runs of letters) are split by the most probable word sequence
  (Viterbi over unigrams; an unknown string of n letters has the probability 10 / (N * 10**n)).
  Only the counts of the parts' own substrings are joined, so no vocabulary is broadcast.
* A multinomial naive Bayes over these words learns from all urls that a rule judges, and from seed
  words of unwanted sites that get a fixed share of the blocked class.  It judges the other urls.

Urls are handled as shapes (host and path with each number as ``0``), so a host with very many pages
is counted once; hot words, parts and shapes reach their rows through ``join_unique``.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and is judged by
the class prior alone.  Null and repeated page_ids stay, row by row; other columns are ignored; an
empty table gives no rows.  Without judged urls both classes are equally likely.
Only runs of a-z and of digits are words: letters of other scripts are left out of parts and counts, so a
host in another script has the prior alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.arrays import blocks, word_hashes
from segmint.llm.common import join_unique, written

#: (verdict, host and path) of the rules.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
#: Words of unwanted sites: known to be blocked whatever the rules say, so they count in that class
#: only, each as much as SEED_SHARE of its words.
SEEDS = ["adult", "bet", "bets", "casino", "cheap", "free", "gambling", "loan", "loans", "pills", "poker",
         "porn", "sex", "slots", "spam", "viagra", "win", "xxx"]
SEED_SHARE = 0.05
#: Added to every word's count.
SMOOTH = 0.1
LONGEST_WORD = 24


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) as the rules see them."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null; a short list written by hand."""
    out = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of up to ``LONGEST_WORD`` ASCII letters outside of tags, counted per block before they are shuffled."""
    low = np.zeros(256, bool)
    low[[*range(65, 91), *range(97, 123)]] = True
    for b in batches:
        for _, _, data, offsets in blocks(b.column("html")):
            n = len(data)
            if not n:
                continue
            at = np.arange(n)
            begin = np.zeros(n, np.int64)
            begin[offsets[:-1][offsets[:-1] < n]] = offsets[:-1][offsets[:-1] < n]
            last_open = np.maximum.accumulate(np.where(data == ord("<"), at, -1))
            last_close = np.maximum.accumulate(np.where(data == ord(">"), at, -1))
            inside = (last_open > last_close) & (last_open >= np.maximum.accumulate(begin))
            letter = (low[data] | (data >= 128)) & ~inside
            first, last = np.ones(n, bool), np.ones(n, bool)  # no word goes on in the next page
            first[1:], last[:-1] = ~letter[:-1], ~letter[1:]
            first[offsets[:-1][offsets[:-1] < n]] = True
            last[offsets[1:][offsets[1:] > 0] - 1] = True
            starts, ends = np.flatnonzero(letter & first), np.flatnonzero(letter & last) + 1
            other = np.concatenate([[0], np.cumsum(data >= 128)])
            plain = (other[ends] == other[starts]) & (ends - starts <= LONGEST_WORD)
            starts, ends = starts[plain], ends[plain]
            _, first, count = np.unique(word_hashes(data, starts, ends), return_index=True, return_counts=True)
            raw = data.tobytes()
            word = [raw[s:e].decode().lower() for s, e in zip(starts[first].tolist(), ends[first].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(count.astype(np.int64))],
                                             names=["word", "n"])


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the visible text of all pages."""
    html = pages.select(F.coalesce("html", F.lit("")).alias("html"))
    return html.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(part: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of ``part``; of equals, the one whose last word is longest."""
    best, cut = [0.0] + [-math.inf] * len(part), [0] * (len(part) + 1)
    for j in range(1, len(part) + 1):
        for i in range(max(0, j - LONGEST_WORD), j):
            n = known.get((i, j), 0)
            p = math.log(n / total) if n else math.log(10 / total) - (j - i) * math.log(10)
            if best[i] + p > best[j]:
                best[j], cut[j] = best[i] + p, i
    out, j = [], len(part)
    while j:
        out.append(part[cut[j]:j])
        j = cut[j]
    return out[::-1]


def segment(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """(part, words) of distinct strings of letters."""
    total = counts.agg(F.sum("n").alias("n")).first().n or 1
    grid = (parts.select("part", F.explode(F.sequence(F.lit(0), F.char_length("part") - 1)).alias("i"))
            .select("part", "i", F.explode(F.sequence(F.col("i") + 1, F.least(
                F.col("i") + LONGEST_WORD, F.char_length("part")))).alias("j"))
            .withColumn("word", F.expr("substring(part, i + 1, j - i)")))
    own = grid.select("word").distinct().join(counts, "word")
    freq = grid.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    known = (join_unique(grid, own.join(freq, "word"), "word", "freq", [F.col("part"), F.col("i")])
             .groupBy("part").agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("i", "j", "n"))).alias("k")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [viterbi(p, {(x["i"], x["j"]): x["n"] for x in k}, total)
                     for p, k in zip(b.column("part").to_pylist(), b.column("k").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(words, pa.list_(pa.string()))],
                                             names=["part", "words"])

    return known.mapInArrow(run, "part string, words array<string>")


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of block; null under a rule) of every page."""
    host, path = split_url(F.col("url"))
    seen = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    seen = seen.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("by_rule"),
        F.concat_ws(" ", "host", F.regexp_replace("path", "[0-9]+", "0")).alias("shape"))
    shapes = written(
        seen.groupBy("shape").agg(F.first("host").alias("host"), F.count(F.lit(1)).alias("freq"),
                                  F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked"),
                                  F.count(F.when(F.col("by_rule") == "allow", 1)).alias("allowed")), "shapes")
    # the host's last label is what rules go by, so it is no word; numbers count as one word
    name = F.regexp_replace("host", r"\.[^.]*$", "")
    path0 = F.expr("substring(shape, char_length(host) + 2)")
    parts = shapes.select("shape", "blocked", "allowed", F.explode(F.regexp_extract_all(
        F.lower(F.concat_ws(" ", name, path0)), F.lit("[a-z]+|[0-9]+"), F.lit(0))).alias("part"))
    parts = parts.withColumn("part", F.when(F.col("part").rlike("^[0-9]"), "0").otherwise(F.col("part")))
    used = parts.groupBy("part").agg(F.count(F.lit(1)).alias("freq"))
    counts = written(word_counts(pages), "counts")  # used several times
    split = segment(used.filter("part <> '0'").select("part"), counts)
    split = used.join(split, "part", "left").select(
        "part", "freq", F.coalesce("words", F.array(F.lit("#"))).alias("words"))
    words = written(join_unique(parts, split, "part", "freq", [F.col("shape")])
                    .select("shape", "blocked", "allowed", F.explode("words").alias("word")), "words")
    odds = _log_odds(words)
    scored = (join_unique(words.select("shape", "word"), odds, "word", "freq", [F.col("shape")])
              .groupBy("shape").agg(F.sum("odds").alias("odds")))
    both = shapes.agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a")).first()
    prior = math.log(((both.b or 0) + 1) / ((both.a or 0) + 1))
    by_shape = shapes.join(scored, "shape", "left").select(
        "shape", "freq", (F.coalesce("odds", F.lit(0.0)) + prior).alias("score"))
    out = join_unique(seen, by_shape, "shape", "freq", [F.col("page_id"), F.col("path")])
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"),
                      F.when(F.col("rule").isNull(), F.round("score", 6)).alias("score"))


def _log_odds(words: DataFrame) -> DataFrame:
    """(word, freq, odds): log P(word | block) - log P(word | allow), SMOOTH added to every count."""
    seeds = words.sparkSession.createDataFrame([(w,) for w in SEEDS], "word string").withColumn("seed", F.lit(True))
    counts = words.groupBy("word").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"),
                                       F.count(F.lit(1)).alias("freq"))
    t = counts.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v")).first()
    b, a, v = t.b or 0, t.a or 0, t.v or 1
    extra = max(1.0, SEED_SHARE * b)
    all_b, all_a = b + SMOOTH * v + extra * len(SEEDS), a + SMOOTH * v
    n_b = F.col("b") + SMOOTH + F.when(F.col("seed"), F.lit(extra)).otherwise(F.lit(0.0))
    return (counts.join(F.broadcast(seeds), "word", "left")
            .select("word", "freq", (F.log(n_b / F.lit(float(all_b))) -
                                     F.log((F.when(F.col("seed"), 0).otherwise(F.col("a")) + SMOOTH) / F.lit(float(all_a)))).alias("odds")))
