"""MinHash near-duplicates: one-permutation hashing, optimal densification, bands, star candidates.

1. Every document becomes its set of distinct five-word shingles (64-bit hashes).  Documents of one
   set are one class; only classes go on.
2. One-permutation hashing: one hash per shingle picks a bin and a value, each bin keeps its least
   value.  Optimal densification: an empty bin takes the value of the first filled bin on its own
   random probe sequence, so two sets agree in a bin with the probability of their similarity.
3. ``BANDS`` bands of ``ROWS`` bins are bucket keys.  At similarity 0.75 a pair shares no bucket with a
   probability of about 1e-4.
4. Stars: in each bucket every class is compared with one centre, the class that meets the most others
   in all its buckets (in a family of copies that is the original), and in a quarter of the buckets
   with a second one.  Both counts are linear in the bucket.
5. Where a bucket's classes still form several components, they are finished exactly.  Buckets that share
   classes make one group, so each class is in one group at most.  A group has a consensus, the shingles
   that more than half of its classes hold, and a class x is known by its difference to it, ``dx`` of D
   shingles.  As ``|x ^ y| = |dx ^ dy|``, a link, ``|x ^ y| <= (|x| + |y|) / 7``, needs
   ``|dx & dy| >= o = (Dx + Dy - (|x| + |y|) / 7) / 2``.

   * Where ``o <= 0`` the pair is a link, and so is each of the two with the class of the greatest slack
     ``|x| / 7 - D``: every class is compared with that one where the slacks allow it.
   * Otherwise both differences hold a common shingle among their first ``D - o + 1`` by rising frequency in
     the group (prefix filter), with the least ``o`` that a partner can have.  Of two classes the nearer one
     to the consensus gets the shorter prefix; classes of the component that has the greatest slack meet
     the others by themselves, as these are farther away.  Shingles of one class alone take places in the
     prefix but are not sent.

6. Each candidate is confirmed on the full shingle sets of both texts.

Defined cases: null text counts as empty; a text of fewer than five words has one shingle, its whole
word sequence; without words the set is empty and linked with nothing.  The vertices of the result
are doc_ids: rows that repeat an id share its component.  A null doc_id is linked with nothing and
its component is null; the row stays.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.arrays import blocks, mix, shingle_sets, shingles, word_hashes, words
from segmint.llm.common import components, join_unique, plain_documents, written

BANDS, ROWS = 24, 4
BINS = 128  # a power of two, at least BANDS * ROWS; the first BANDS * ROWS of them form the bands
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 75
LINK = f"common * 100 >= total * {PERCENT}"
#: The distances in a group fall into cells of a share of its longest class.
CELLS = 16
_EMPTY = np.uint64(2**64 - 1)
_rng = np.random.default_rng(77)
#: The probe sequences of densification: for each bin a random order of all bins.
_PROBES = np.argsort(_rng.random((BANDS * ROWS, BINS)), axis=1)


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(rows, BANDS * ROWS) bin values of ragged shingle hashes; rows without shingles are all empty."""
    rows = len(counts)
    low = np.full(rows * BINS, _EMPTY, np.uint64)
    x = mix(hashes + np.uint64(0x9E3779B97F4A7C15))
    slot = np.repeat(np.arange(rows), counts) * BINS + (x & np.uint64(BINS - 1)).astype(np.int64)
    np.minimum.at(low, slot, x >> np.uint64(7))
    low = low.reshape(rows, BINS)
    out = low[:, :BANDS * ROWS].copy()
    empty = out == _EMPTY
    for k in range(BINS):  # the k-th probe of every bin that is still empty
        r, b = np.nonzero(empty)
        if not len(r):
            break
        got = low[r, _PROBES[b, k]]
        out[r, b] = got
        empty[r, b] = got == _EMPTY
        if k == BINS - 1:
            break
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(rows, BANDS) bucket keys: a hash of the band's bins and its number."""
    s = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                          (len(s), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key ^ s[:, :, r])
    return key


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for at, rows, data, offsets in blocks(batch.column("text")):
            starts, ends, per_row = words(data, offsets)
            h, _, count = shingles(word_hashes(data, starts, ends), per_row)
            # distinct shingles of each row, sorted
            row = np.repeat(np.arange(rows), count)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, row = h[first], row[first]
            n = np.bincount(row, minlength=rows)
            bounds = np.concatenate([[0], np.cumsum(n)])
            vid = [int.from_bytes(hashlib.blake2b(h[bounds[r]:bounds[r + 1]].tobytes(), digest_size=8).digest(),
                                  "little", signed=True) if n[r] else None for r in range(rows)]
            keys = band_keys(signatures(h, n)).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * BANDS + 1, BANDS, dtype=np.int32)),
                                            pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([ids.slice(at, rows), pa.array(n.astype(np.int64)),
                                              pa.array(vid, pa.int64()), flat],
                                             names=["doc_id", "n_shingles", "vid", "keys"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full-set similarity of each pair's two texts."""
    for b in batches:
        texts: dict[str, np.ndarray] = {}
        sides = []
        for side in ("text_a", "text_b"):
            col = b.column(side).dictionary_encode()
            sets = dict(shingle_sets(col.dictionary))
            sides.append([sets[i] for i in col.indices.to_pylist()])
        both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)]
        union = [len(x) + len(y) - n for x, y, n in zip(*sides, both)]
        texts.clear()
        yield pa.RecordBatch.from_arrays(
            [b.column("a"), b.column("b"), pa.array(both, pa.int64()), pa.array(union, pa.int64())],
            names=["a", "b", "common", "total"])


def compared(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """``pairs(a, b)`` of classes with the sizes of intersection and union of their full sets."""
    # AQE splits a centre with very many members on the side of the pairs
    one = pairs.join(texts.select(F.col("vid").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("vid").alias("b"), F.col("text").alias("text_b")), "b")
    return written(two.select("a", "b", "text_a", "text_b")
                   .mapInArrow(_verify, "a long, b long, common long, total long"), name)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (see the module)."""
    docs = plain_documents(docs)
    rows = docs.mapInArrow(_sketch, "doc_id long, n_shingles long, vid long, keys array<long>")
    members = written(rows.select("doc_id", "n_shingles", "vid"), "members")
    # the sketch is computed again rather than stored with 24 keys per copy: it moves less
    classes = (rows.filter("vid is not null and doc_id is not null").groupBy("vid")
               .agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys")))
    in_bucket = classes.select("vid", F.explode("keys").alias("key"))
    sizes = (in_bucket.groupBy("key").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
             .withColumn("size", F.col("freq")))
    met = written(join_unique(in_bucket.withColumn("bucket", F.col("key")), sizes, "key", "freq",
                              [F.col("vid"), F.col("key")], matched=True), "buckets")
    # how many classes a class meets: in a family of copies the original meets the most
    weight = met.groupBy("vid").agg(F.sum("size").alias("weight"))
    met = written(met.join(weight, "vid"), "weighted")
    # a bucket's first centre meets the most; a quarter of the buckets have a second one, drawn by hash
    centres = (met.groupBy("bucket")
               .agg(F.count(F.lit(1)).alias("freq"), F.max_by("vid", F.struct("weight", "vid")).alias("c1"),
                    F.min_by("vid", F.xxhash64("vid", "bucket")).alias("c2"))
               .withColumn("c2", F.when(F.pmod("bucket", F.lit(4)) == 0, F.col("c2"))))
    shared = met
    with_centres = join_unique(met.select("vid", "bucket"), centres, "bucket", "freq", [F.col("vid")])
    stars = (with_centres.select("vid", F.explode(F.array("c1", "c2")).alias("c"))
             .filter("vid <> c")
             .select(F.least("vid", "c").alias("a"), F.greatest("vid", "c").alias("b")).distinct())
    stars = written(stars, "stars")
    ends = stars.select(F.explode(F.array("a", "b")).alias("vid")).distinct()
    reps = (members.filter("vid is not null").groupBy("vid").agg(F.min("doc_id").alias("doc_id"))
            .join(ends, "vid"))
    texts = _texts(docs, written(reps, "involved"))
    tested = compared(stars, texts, "tested")
    links = tested.filter(LINK).select("a", "b")
    parts = components(links)
    rest = written(_remaining(shared, parts, tested, texts), "rest")
    links = links.union(compared(rest, texts, "tested").filter(LINK).select("a", "b"))
    parts = components(links)
    return _labelled(members, parts)


def _texts(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """(vid, text) of one document of each class in ``involved(vid, doc_id)``."""
    # merged whatever the sizes, so that the plan is the same at every scale
    got = docs.join(involved.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    # an id may stand on several rows: its row must have the class's set
    own = got.mapInArrow(_with_vid, "doc_id long, vid long, text string")
    return written(own.join(involved, ["doc_id", "vid"]).dropDuplicates(["vid"]).select("vid", "text"), "texts")


def _with_vid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vid = [int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)
               if len(h) else None for _, h in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(vid, pa.int64()), batch.column("text")],
                                         names=["doc_id", "vid", "text"])


def _rooted(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """``shared`` with the component of each class; one without any link is a component of its own."""
    return shared.join(parts.withColumnRenamed("v", "vid"), "vid", "left").select(
        "bucket", "size", "weight", "vid", F.coalesce("root", "vid").alias("root"))


def _remaining(shared: DataFrame, parts: DataFrame, tested: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs (a, b) of one bucket and of different components that may be links and weren't compared."""
    # of a bucket of two the star has compared the only pair
    s = written(_rooted(shared.filter(F.col("size") > 2), parts), "rooted")
    mixed = (s.groupBy("bucket").agg(F.count(F.lit(1)).alias("freq"), F.min("root").alias("lo"),
                                     F.max("root").alias("hi"), F.max_by("vid", F.struct("weight", "vid")).alias("c1"))
             .filter("lo <> hi").select("bucket", "freq", "c1"))
    s = written(join_unique(s, mixed, "bucket", "freq", [F.col("vid")], matched=True)
                .select("vid", "root", "c1").distinct(), "mixed")
    groups = components(s.select(F.col("vid").alias("a"), F.col("c1").alias("b")))
    members = (s.select("vid", "root").distinct()
               .join(groups.select(F.col("v").alias("vid"), F.col("root").alias("group")), "vid"))
    sets = written(members.join(texts, "vid").select("group", "vid", "root", "text")
                   .mapInArrow(_sets, "group long, vid long, root long, n long, hs array<long>"), "sets")
    held = written(_held(sets), "held")
    near = _differences(sets, held)
    pairs = _slack_pairs(near).union(_prefix_pairs(near, held))
    return (pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
            .join(tested.select("a", "b"), ["a", "b"], "left_anti"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hs = [h.view(np.int64) for _, h in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("group", "vid", "root")), pa.array([len(h) for h in hs], pa.int64()),
             pa.array(hs, pa.list_(pa.int64()))], names=["group", "vid", "root", "n", "hs"])


def _of_group(rows: DataFrame, per_group: DataFrame, scatter: str = "vid") -> DataFrame:
    """``rows`` with the values that ``per_group(group, freq, ...)`` has for their group, whatever its size."""
    return (join_unique(rows.withColumn("_g", F.col("group")), per_group, "group", "freq", [F.col(scatter)])
            .withColumnRenamed("_g", "group"))


def _held(sets: DataFrame) -> DataFrame:
    """(group, h, f): how many classes of the group hold a shingle, where several do."""
    return (sets.select("group", F.explode("hs").alias("h")).groupBy("group", "h")
            .agg(F.count(F.lit(1)).alias("f")).filter("f > 1"))


def _differences(sets: DataFrame, held: DataFrame) -> DataFrame:
    """Each class with its difference to its group's consensus, and what the prefixes depend on.

    ``added`` has its own shingles, ``lacking`` those of the consensus that it has not, with the number of
    classes that lack them; ``d`` counts both.
    """
    sizes = sets.groupBy("group").agg(F.count(F.lit(1)).alias("freq"), F.max("n").alias("most"))
    # more than half of a group hold each: at most twice the shingles of its mean class
    of = held.groupBy("group").agg(F.count(F.lit(1)).alias("freq")).join(
        sizes.select("group", F.col("freq").alias("of")), "group")
    common = (_of_group(held, of, "h").filter("2 * f > of")
              .groupBy("group").agg(F.sort_array(F.collect_list(
                  F.struct("h", (F.col("of") - F.col("f")).alias("f")))).alias("common")))
    every = _of_group(sets, sizes.join(common, "group", "left")).withColumn(
        "common", F.coalesce("common", F.expr("array()").cast("array<struct<h: long, f: long>>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, cs = batch.column("hs"), batch.column("common")
            own_at, own = hs.offsets.to_numpy(), hs.values.to_numpy()
            common_at, h, f = cs.offsets.to_numpy(), *(cs.values.field(k).to_numpy() for k in (0, 1))
            added, lacking = [], []
            for r in range(len(batch)):
                x = own[own_at[r]:own_at[r + 1]]
                c = slice(common_at[r], common_at[r + 1])
                added.append(x[~np.isin(x, h[c])])
                gone = ~np.isin(h[c], x)
                lacking.append([{"h": a, "f": b} for a, b in zip(h[c][gone].tolist(), f[c][gone].tolist())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("group", "vid", "root", "n", "most")),
                 pa.array([len(a) + len(b) for a, b in zip(added, lacking)], pa.int64()),
                 pa.array(added, pa.list_(pa.int64())),
                 pa.array(lacking, pa.list_(pa.struct([("h", pa.int64()), ("f", pa.int64())])))],
                names=["group", "vid", "root", "n", "most", "d", "added", "lacking"])

    near = written(every.select("group", "vid", "root", "n", "most", "hs", "common").mapInArrow(
        run, "group long, vid long, root long, n long, most long, d long, added array<long>,"
             " lacking array<struct<h: long, f: long>>"), "differences")
    # of each group the class of the greatest slack; the least distances inside and outside its component
    best = near.groupBy("group").agg(F.count(F.lit(1)).alias("freq"), F.max_by(
        F.struct("vid", "root", "n", "d"), F.struct(F.col("n") - 7 * F.col("d"), F.col("vid"))).alias("best"))
    narrow = written(_of_group(near.select("group", "vid", "root", "d"), best), "slacks")
    inside = F.col("root") == F.col("best.root")
    least = narrow.groupBy("group").agg(F.count(F.lit(1)).alias("freq"), F.min(F.when(inside, F.col("d"))).alias("low"),
                                        F.min(F.when(~inside, F.col("d"))).alias("cut"))
    budgets = written(_of_group(narrow.select("group", "vid", "best", inside.alias("inside")), least), "budgets")
    return near.join(budgets.drop("group"), "vid")


def _slack_pairs(near: DataFrame) -> DataFrame:
    """(x, y): classes that are links of the one of greatest slack by their distances alone."""
    return (near.filter("not inside and 7 * (d + best.d) <= n + best.n")
            .select(F.col("vid").alias("x"), F.col("best.vid").alias("y")))


def _prefix_pairs(near: DataFrame, held: DataFrame) -> DataFrame:
    """(x, y): classes of a group and of different components whose prefixes share a shingle."""
    # frequencies of the shingles that several differences hold; the others need not be known
    rare = held.select(F.xxhash64("group", "h").alias("key"), "f", F.col("f").alias("freq"))
    own = near.select("vid", "group", F.explode("added").alias("h"))
    known = join_unique(own.withColumn("key", F.xxhash64("group", "h")), rare, "key", "freq", [F.col("vid")],
                        matched=True).select("vid", "h", "f")
    lacking = near.select("vid", F.explode("lacking").alias("x")).select("vid", "x.h", "x.f").filter("f > 1")
    rising = (known.unionByName(lacking).groupBy("vid")
              .agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("shingles")))
    # a partner has at most a third more shingles
    span = F.col("n") + F.least(F.floor(4 * F.col("n") / 3), F.col("most"))

    def prefix(nearest: str | None) -> Column:
        """D - o + 1, with the least o of a partner that is not nearer to the consensus than ``nearest`` (or itself)."""
        partner = 7 * F.col("d") if nearest is None else F.greatest(7 * F.col(nearest), 7 * F.col("d") - span)
        return F.col("d") + 1 - F.greatest(F.lit(1), F.ceil((partner + 7 * F.col("d") - span) / 14))

    # of the shingles of one class alone none can be shared: a partner's distance has an upper limit too
    size = F.size("shingles")
    whole = near.select("group", "vid", "root", "n", "d", "inside", "cut", "low", "most", span.alias("span"), prefix(None).alias("own"),
                        prefix("cut").alias("to_cut"), prefix("low").alias("to_low")).join(rising, "vid")
    whole = whole.withColumns({"shared": size.cast("long"), "limit": F.floor((14 * size + F.col("span") - 7 * F.col("d")) / 7)})
    # partners meet by cells of the distance of the second one
    width = F.greatest(F.lit(1), F.floor(F.col("most") / CELLS))
    placed = (whole.select("*", F.posexplode("shingles").alias("k", "s")).withColumn("h", F.col("s.h"))
              .withColumn("place", F.col("d") - F.col("shared") + F.col("k") + 1))
    # the component of the greatest slack meets the others (0); the others meet each other (1), the nearer one first
    nearest = F.when(F.col("inside"), F.greatest("cut", F.ceil((7 * F.col("d") - F.col("span")) / 7))).otherwise(F.col("d"))
    first = (placed.filter((F.col("place") <= F.when(F.col("inside"), F.col("to_cut")).otherwise(F.col("own")))
                           & (nearest <= F.col("limit")))
             .select("group", "h", F.when(F.col("inside"), 0).otherwise(1).alias("kind"),
                     F.explode(F.sequence(F.floor(nearest / width), F.floor(F.col("limit") / width))).alias("cell"),
                     *(F.col(c).alias(c + "_x") for c in ("vid", "root", "n", "d", "shared"))))
    second = (placed.filter("not inside")
              .select("*", F.explode(F.array(
                  F.struct(F.lit(0).alias("kind"), F.col("to_low").alias("p"), F.col("low").alias("nearest")),
                  F.struct(F.lit(1).alias("kind"), F.col("to_cut").alias("p"), F.col("cut").alias("nearest")))).alias("r"))
              .filter("place <= r.p and r.nearest <= limit")
              .select("group", "h", "r.kind", F.floor(F.col("d") / width).alias("cell"),
                      *(F.col(c).alias(c + "_y") for c in ("vid", "root", "n", "d", "shared"))))
    may = ("root_x <> root_y and 3 * greatest(n_x, n_y) <= 4 * least(n_x, n_y) and 7 * abs(d_x - d_y) <= n_x + n_y"
           " and 7 * (d_x + d_y) <= 14 * least(shared_x, shared_y) + n_x + n_y"
           " and (kind = 0 or d_x < d_y or (d_x = d_y and vid_x < vid_y))")
    return (first.join(second, ["group", "kind", "cell", "h"]).filter(may)
            .select(F.col("vid_x").alias("x"), F.col("vid_y").alias("y")))


def _labelled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Component ids of documents: classes joined by links, and ids that stand on several rows."""
    roots = parts.select(F.col("v").alias("vid"), "root")
    real = members.filter("doc_id is not null and vid is not null")
    classes = (real.groupBy("vid").agg(F.min("doc_id").alias("doc_id")).join(roots, "vid", "left")
               .select("vid", "doc_id", F.coalesce("root", "vid").alias("root")))
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = written(classes.join(least, "root").select("vid", "component_id"), "classes")
    # ids on several classes join these (rare: only where a doc_id repeats)
    twice = real.groupBy("doc_id").agg(F.min("vid").alias("lo"), F.max("vid").alias("hi")).filter("lo <> hi")
    out = members.join(of_class, "vid", "left")
    if not twice.isEmpty():
        own = out.filter("component_id is not null").select("doc_id", "component_id").distinct()
        again = components(own.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")))
        out = out.join(again.withColumnRenamed("v", "doc_id"), "doc_id", "left").withColumn(
            "component_id", F.coalesce("root", "component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
                      component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns stay."""
    dropped = written(near_duplicates(docs).filter("not kept").select("doc_id").distinct(), "dropped")
    # merged whatever the sizes, so that the plan is the same at every scale
    return docs.join(dropped.hint("merge"), "doc_id", "left_anti")
