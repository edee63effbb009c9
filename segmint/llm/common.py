"""Spark helpers shared by the operators: tables, row hygiene, skew-safe joins, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.session import remove_path, scratch_path

#: A key that is rarer than this never needs its own treatment in a join.
HOT_MIN = 1000
#: So many of the most frequent keys are broadcast; any other key has at most 1/256 of the rows.
HOT_KEYS = 256


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application (like ``--py-files``).

    Workers import it by name, so what a worker has remembered (vocabularies, encoded words) outlives a task.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not package.endswith(".zip") and os.path.isdir(package):
        out = os.path.join(tempfile.mkdtemp(prefix="segmint-py-"), "segmint_package.zip")
        with zipfile.ZipFile(out, "w") as z:
            for folder, _, names in os.walk(package):
                for n in sorted(names):
                    if n.endswith(".py"):
                        path = os.path.join(folder, n)
                        z.write(path, os.path.join(os.path.basename(package), os.path.relpath(path, package)))
        spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below ``spark.checkpoint.dir``: lineage is cut and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made and that nothing reads any more."""
    for t in tables:
        for path in {os.path.dirname(f) for f in t.inputFiles()}:
            remove_path(t.sparkSession, path)


def plain_documents(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text``, null text as empty; further columns, whatever their names, go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def join_unique(rows: DataFrame, unique: DataFrame, key: str, freq: str, scatter: list[Column],
                matched: bool = False, hot_min: int = HOT_MIN, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join of ``rows`` to ``unique`` (one row per ``key``) that no hot key can skew.

    ``unique[freq]`` says how many rows a key has.  The at most ``hot_keys`` most frequent keys are
    broadcast (bounded by their number; a key beyond them has at most a ``1/hot_keys`` share of all
    rows), and their rows travel under a scattered stand-in key.  No row is dropped: both ways give one
    result.  ``matched`` keeps only rows that have a partner.  ``freq`` and ``key`` are not returned.
    """
    kind = rows.schema[key].dataType
    values = [c for c in unique.columns if c not in (key, freq)]
    hot = (unique.filter(F.col(freq) >= hot_min).orderBy(F.col(freq).desc(), key).limit(hot_keys)
           .select(key, F.struct(*values).alias("_hot")))
    one = rows.join(F.broadcast(hot), key, "left").withColumn("_is_hot", F.col("_hot").isNotNull())
    one = one.withColumn(key, F.when(F.col("_is_hot"), F.xxhash64(*scatter).cast(kind)).otherwise(F.col(key)))
    rest = unique.select(key, F.struct(*values).alias("_rest"), F.lit(False).alias("_is_hot"))
    both = one.join(rest, [key, "_is_hot"], "left")
    got = F.coalesce("_hot", "_rest")
    if matched:
        both = both.filter(got.isNotNull())
    return both.select(*[c for c in rows.columns if c != key], *[got[v].alias(v) for v in values])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(v, root)``, root the smallest member.

    Alternating large-star and small-star steps.  Each step takes a minimum per vertex (combined
    before the shuffle) and joins it back, so a vertex with very many neighbours is never gathered.
    Vertices without an edge do not appear.  Null ends are ignored.
    """
    pairs = written(edges.filter("a is not null and b is not null and a <> b")
                    .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                    .distinct(), name)
    while True:
        both = pairs.union(pairs.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.least("lo", F.min("hi")).alias("m"))
        large = (both.join(least, "lo").filter("hi > lo")
                 .select(F.col("m").alias("lo"), "hi").filter("lo <> hi").distinct())
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(down, "hi")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("hi")),
                                           F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e"))
                 .select("e.*").filter("lo <> hi").distinct())
        after = written(small, name)
        # a star forest: no vertex is both a root and a member, and no member has two roots
        members = after.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("hi").alias("d")).first()
        open_ = 0 if members.n != members.d else after.join(
            after.select(F.col("hi").alias("lo")).distinct(), "lo", "left_semi").limit(1).count()
        pairs = after
        if members.n == members.d and open_ == 0:
            break
    return pairs.select(F.col("hi").alias("v"), F.col("lo").alias("root")).union(
        pairs.select(F.col("lo").alias("v"), F.col("lo").alias("root")).distinct())
