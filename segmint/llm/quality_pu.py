"""A quality classifier from positive and unlabelled texts (non-negative PU learning).

Trusted positives are the rows that ``labels.quality`` marks 1; unlabelled texts are labelled rows
with their label hidden; a 0 is never used.  Both are bounded samples (``MAX_POSITIVE``,
``MAX_UNLABELLED``), chosen by a hash of the id.  The share of positives among the unlabelled is
estimated from the two samples: a first classifier tells them apart, and the least ratio of what both
have above a threshold, with its sampling error, bounds the prior.  Then a linear model minimises

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss l; where the second term would go below zero, a step is cut back, so the
model cannot win by memorising the positives.

A text is seen only through numbers taken over all its bytes and words (``features``).  Its id,
language, source and labels are no inputs.

Defined cases: null text counts as empty, and the empty text has a score like any other; rows without
doc_id are scored, count as not held out and never train; ids that repeat in ``labels`` are positive
if all their labels are 1; null labels are ignored.  Without positives or unlabelled texts every score
is 0.5.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.arrays import blocks, shingles, span_hashes, words
from segmint.llm.common import plain_documents

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 20_000
FOLDS = 5
THRESHOLD = 0.3
BUCKETS = 64

#: Classes of bytes: each ASCII sign by itself; letters of either case, digits, blanks, line ends,
#: other control characters and bytes of other scripts as one each.
_CLASS = np.zeros(256, np.int64)
_signs = [b for b in range(33, 127) if not chr(b).isalnum()]
for _k, _members in enumerate([range(0, 32), [32, 9], [10, 13], range(48, 58), range(65, 91), range(97, 123),
                               range(128, 256), *[[b] for b in _signs]]):
    _CLASS[list(_members)] = _k
CLASSES = 7 + len(_signs)
N_FEATURES = CLASSES + BUCKETS + 8


def features(column: pa.Array) -> np.ndarray:
    """(rows, N_FEATURES) of texts: shares of byte classes and hashed words, repetition, lengths."""
    out = np.zeros((len(column), N_FEATURES), np.float32)
    for at, rows, data, offsets in blocks(column):
        size = np.diff(offsets)
        row = np.repeat(np.arange(rows), size)
        by_class = np.bincount(row * CLASSES + _CLASS[data], minlength=rows * CLASSES).reshape(rows, CLASSES)
        starts, ends, n = words(data, offsets)
        h = span_hashes(data, starts, ends)
        word_row = np.repeat(np.arange(rows), n)
        by_bucket = np.bincount(word_row * BUCKETS + (h % BUCKETS).astype(np.int64),
                                minlength=rows * BUCKETS).reshape(rows, BUCKETS)
        grams, _, n_grams = shingles(h, n)
        upper = (data >= 65) & (data <= 90)
        lower = ((data >= 97) & (data <= 122)) | (data >= 128)
        up, low = (np.concatenate([[0], np.cumsum(x)]) for x in (upper, lower))
        n_up, n_low = up[ends] - up[starts], low[ends] - low[starts]
        share = 1 / np.maximum(n, 1)
        f = out[at:at + rows]
        f[:, :CLASSES] = np.sqrt(by_class / np.maximum(size, 1)[:, None])
        f[:, CLASSES:CLASSES + BUCKETS] = np.sqrt(by_bucket * share[:, None])
        rest = (np.log1p(size) / 10, np.log1p(n) / 10,
                np.bincount(word_row, ends - starts, rows) * share / 10,
                np.bincount(word_row[1:], (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1]), rows) * share,
                _distinct(word_row, h, rows) * share,
                _distinct(np.repeat(np.arange(rows), n_grams), grams, rows) / np.maximum(n_grams, 1),
                np.bincount(word_row, (n_up > 1) & (n_low == 0), rows) * share,
                np.bincount(word_row, n_up + n_low == 0, rows) * share)
        for k, x in enumerate(rest):
            f[:, CLASSES + BUCKETS + k] = x
    return out


def _distinct(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    return np.bincount(r[first], minlength=rows)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _newton(x: np.ndarray, target: np.ndarray, weight: np.ndarray, allowed=lambda z: True,
            rounds: int = 25, ridge: float = 1e-3) -> np.ndarray:
    """Minimises sum(weight * softplus(x w)) - target . w; steps that ``allowed`` refuses are halved."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)

    def value(w: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, x @ w) - target @ w + 0.5 * (keep * w * w).sum())

    now = value(w)
    for _ in range(rounds):
        s = _sigmoid(x @ w)
        gradient = x.T @ (weight * s) - target + keep * w
        curve = (x * (weight * s * (1 - s))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while size > 1e-4 and (value(w - size * step) > now or not allowed(w - size * step)):
            size /= 2
        if size <= 1e-4:
            break
        w = w - size * step
        now, before = value(w), now
        if before - now < 1e-9:
            break
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled (feature rows with a constant)."""
    x = np.vstack([positive, unlabelled])
    p = len(positive)
    # odd rows fit the classifier, even rows are counted
    fit = np.arange(len(x)) % 2 == 1
    y = np.arange(len(x)) < p
    weight = np.where(y, 0.5 / max((fit & y).sum(), 1), 0.5 / max((fit & ~y).sum(), 1))[fit]
    w = _newton(x[fit], x[fit].T @ (weight * y[fit]), weight)
    z = x[~fit] @ w
    zp, zu = np.sort(z[y[~fit]]), np.sort(z[~y[~fit]])
    if not len(zp) or not len(zu):
        return 0.5
    at = np.quantile(zp, np.linspace(0, 0.9, 91))
    above_p = 1 - np.searchsorted(zp, at) / len(zp)
    above_u = 1 - np.searchsorted(zu, at) / len(zu)
    error = np.sqrt(above_p * (1 - above_p) / len(zp)) + np.sqrt(above_u * (1 - above_u) / len(zu))
    return float(np.clip(np.min((above_u + error) / np.maximum(above_p, 1e-9)), 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, the last one the constant; the estimated prior).

    With the logistic loss l(g) - l(-g) = -g, so the risk is convex: the mean of softplus(g) over the
    unlabelled less prior times the mean of g over the positives.  Newton steps that would make the
    negatives' part of the risk negative are cut back.
    """
    if not len(positive) or not len(unlabelled):
        return np.zeros(N_FEATURES + 1), 0.5
    raw = np.vstack([positive, unlabelled]).astype(np.float64)
    mean, scale = raw.mean(0), raw.std(0) + 1e-3
    x = np.hstack([(raw - mean) / scale, np.ones((len(raw), 1))])
    xp, xu = x[:len(positive)], x[len(positive):]
    prior = class_prior(xp, xu)

    def allowed(w: np.ndarray) -> bool:
        return np.logaddexp(0, xu @ w).mean() - prior * np.logaddexp(0, xp @ w).mean() >= 0

    w = _newton(xu, prior * xp.mean(0), np.full(len(xu), 1 / len(xu)), allowed)
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum()), prior


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _sample(ids: DataFrame, most: int, salt: int) -> DataFrame:
    """About ``most`` of the ids at the utmost, by a hash, whatever their number."""
    n = ids.count()
    share = min(1.0, most / max(n, 1))
    return ids.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < int(share * 1_000_000))


def _features_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        f = features(b.column("text"))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("positive"), pa.array([r.tobytes() for r in f], pa.binary())],
            names=["doc_id", "positive", "f"])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and prior, from the labelled rows outside the held-out fold."""
    docs = plain_documents(docs)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
             .filter("doc_id is not null and quality is not null").filter(fold(F.col("doc_id")) != 0)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    positive = _sample(known.filter("quality = 1").select("doc_id"), MAX_POSITIVE, 1)
    hidden = _sample(known.select("doc_id"), MAX_UNLABELLED, 2)
    chosen = positive.withColumn("positive", F.lit(True)).union(hidden.withColumn("positive", F.lit(False)))
    # bounded by the two parameters above, so the ids can be broadcast
    rows = (docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "positive", "text")
            .mapInArrow(_features_batches, "doc_id long, positive boolean, f binary")
            # an id may stand on many rows: one of them
            .groupBy("doc_id", "positive").agg(F.min("f").alias("f")).collect())
    rows.sort(key=lambda r: (r.doc_id, r.positive))
    made = {k: np.array([np.frombuffer(r.f, np.float32) for r in rows if r.positive == k]).reshape(-1, N_FEATURES)
            for k in (True, False)}
    return train(made[True], made[False])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = features(b.column("text")).astype(np.float64) @ weights[:-1] + weights[-1]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_sigmoid(z))], names=["doc_id", "score"])

    return (plain_documents(docs).mapInArrow(run, "doc_id long, score double")
            .select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` without the rows that score below the threshold; all columns stay, nothing is shuffled."""
    kinds = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [f.name for f in kinds].index("text")
        for b in batches:
            z = features(b.column(at).cast(pa.string()).fill_null("")).astype(np.float64) @ weights[:-1] + weights[-1]
            yield b.filter(pa.array(_sigmoid(z) >= THRESHOLD))

    return docs.mapInArrow(run, kinds)
