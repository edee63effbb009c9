"""Exact deduplication by deterministic block naming (DataFrame functions only).

Each normalised text is cut into blocks of ``BLOCK`` code points.  Equal blocks get one integer name:
the distinct blocks are sorted and numbered, so a name can neither collide nor change when a lost
task is run again.  Then adjacent names are paired and the pairs named in the same way, level by
level, until each document has one name.  Texts are equal exactly if they reach the same name on the
same level.

A block or pair shared by very many documents is named once, after combining on the map side, and
reaches them through ``join_unique``, so no task gets a hot group.

Defined cases: null text counts as empty; the empty text is a text like any other (one empty block).
Rows with a null ``doc_id`` take part; they stay only if no equal text has an id.  Of fully equal
rows (same id and text) one is kept.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import HOT_KEYS, HOT_MIN, free_names, join_unique, plain_documents, written

BLOCK = 1024
#: A run of white space that one blank has to replace; a single blank is left as it is.
RUN = r"[\x09-\x0D\x20][\x09-\x0D\x20]+|[\x09-\x0D]"


def named(rows: DataFrame, scatter: list[str]) -> DataFrame:
    """``rows(k, ...)`` with ``name``, one integer for each distinct string ``k``, instead of ``k``.

    The names are made in the partitions that the join reads, so the keys are moved only once for the
    distinct ones and once for the rows.
    """
    distinct = rows.groupBy("k").agg(F.count(F.lit(1)).alias("freq"))
    names = distinct.sortWithinPartitions("k").withColumn("name", F.monotonically_increasing_id())
    # hot keys are numbered among themselves (at most HOT_KEYS rows), below zero; so both kinds stay apart
    hot = (distinct.filter(F.col("freq") >= HOT_MIN).orderBy(F.col("freq").desc(), "k").limit(HOT_KEYS)
           .select("k", (-1 - F.monotonically_increasing_id()).alias("hot")))
    one = rows.join(F.broadcast(hot), "k", "left")
    # a stand-in is longer than any key, so it meets none
    stand_in = F.rpad(F.xxhash64(*scatter).cast("string"), BLOCK + 1, "#")
    one = one.withColumn("k", F.when(F.col("hot").isNull(), F.col("k")).otherwise(stand_in))
    # freq is read here too, so that both uses of ``distinct`` share one shuffle
    named_or_hot = F.coalesce("hot", F.when(F.col("freq").isNotNull(), F.col("name")))
    return one.join(names, "k", "left").withColumn("name", named_or_hot).drop("k", "hot", "freq")


def identities(docs: DataFrame) -> DataFrame:
    """(doc_id, sha, copies, level, name): equal texts, and only they, share level and name.

    One row per distinct id and text; ``copies`` counts its rows; ``sha`` tells texts of one id apart.
    """
    text = F.regexp_replace(F.col("text"), RUN, " ")
    blocks = (plain_documents(docs).select("doc_id", text.alias("t"))
              .select("doc_id", F.sha2("t", 256).alias("sha"),
                      F.regexp_extract_all("t", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("b"))
              .select("doc_id", F.unhex("sha").alias("sha"), F.posexplode_outer("b").alias("i", "k"))
              .select("doc_id", "sha", F.coalesce("i", F.lit(0)).alias("i"), F.coalesce("k", F.lit("")).alias("k")))
    level, done, state = 0, [], None
    while True:
        rows = named(blocks, ["doc_id", "sha", "i"])
        copies = F.sum(F.when(F.col("i") == 0, 1).otherwise(0)) if level == 0 else F.first("copies")
        state = written(
            rows.groupBy("doc_id", "sha")
            .agg(F.array_sort(F.collect_set(F.struct("i", "name"))).alias("n"), copies.alias("copies"))
            .select("doc_id", "sha", "copies", F.col("n.name").alias("n"), F.size("n").alias("size")), "names")
        done.append(state.filter("size = 1")
                    .select("doc_id", "sha", "copies", F.lit(level).alias("level"), F.col("n")[0].alias("name")))
        active = state.filter("size > 1")
        if active.isEmpty():
            break
        pair = F.expr("transform(sequence(0, size - 1, 2),"
                      " j -> concat_ws(',', cast(n[j] as string), cast(get(n, j + 1) as string)))")
        blocks = active.select("doc_id", "sha", "copies", F.posexplode(pair).alias("i", "k"))
        level += 1
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, sha, copies, keep_id, group_size) of each distinct id and text."""
    ids = identities(docs).withColumn("key", F.concat_ws(":", "level", "name"))
    groups = ids.groupBy("key").agg(F.min("doc_id").alias("keep_id"),
                                    F.sum("copies").alias("group_size"),
                                    F.count(F.lit(1)).alias("freq"))
    rows = join_unique(ids, groups, "key", "freq", [F.col("doc_id"), F.col("sha")])
    return rows.select("doc_id", "sha", "copies", "keep_id", F.col("group_size").cast("long").alias("group_size"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (see the module)."""
    rows = grouped(docs).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select("doc_id", "keep_id", "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns stay."""
    found = written(grouped(docs), "groups")
    sha = F.unhex(F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), RUN, " "), 256))
    own, gone_id, gone_sha = free_names(docs, "own_sha", "gone_id", "gone_sha")
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        F.col("doc_id").alias(gone_id), F.col("sha").alias(gone_sha))
    out = docs.withColumn(own, sha)
    # merged whatever the sizes, so that the plan is the same at every scale
    out = out.join(gone.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id))
                   & (F.col(own) == F.col(gone_sha)), "left_anti")
    if not found.filter("copies > 1").isEmpty():  # fully equal rows, else there is nothing to drop
        out = out.dropDuplicates(["doc_id", own])
    return out.drop(own)
