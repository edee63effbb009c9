"""Wide → long, a global row index without a single-partition window, and
balanced contiguous splitting under a per-part cap.

Global index (``with_file_order_index``)
---------------------------------------
Rows must be numbered in *source order* (file name, then byte offset), as
the original single-process job did, without funnelling data through one
task.  Each row gets ``(split_key, m)`` where ``split_key`` identifies the
input split it came from (file name + block start, plus an ordinal for
unioned branches) and ``m = monotonically_increasing_id()``; rows of one
split are consecutive in ``m``.  A tiny aggregate (one row per split: count
and min m) gets prefix sums in split order, and is joined back by
broadcast.  Its size is bounded by the number of input splits, not by the
data, and is checked before the broadcast hint is applied; its prefix
sums are computed distributed (``prefix_offsets``).  No shuffle of
the data itself happens; everything is deterministic for a file scan, so
the two passes (count, then write) and any task retry see the same ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import join_small

SPLIT_FILE = "__split_file"
SPLIT_START = "__split_start"
ORDINAL = "__ordinal"
MID = "__mid"
PART = "__part"


def tag_source_order(df: DataFrame) -> DataFrame:
    """Attach the input split identity; call directly on a file scan."""
    return df.withColumn(SPLIT_FILE, F.input_file_name()).withColumn(
        SPLIT_START, F.input_file_block_start())


def melt_by_branches(df: DataFrame, columns: list[tuple[str, str]],
                     keep: list[str] | None = None, drop_nulls: bool = True,
                     value_name: str = "hash", name_name: str = "schema") -> DataFrame:
    """Wide → long in *column-major* order (all rows of column 1, then 2 …).

    Built as a union of one narrow projection per column, so the union's
    partitions come out in column order; with ``drop_nulls`` each branch
    filters before the union and no null row is ever materialised.
    ``columns`` is a list of (source column, schema label).
    """
    keep = keep or []
    branches = []
    for i, (col, label) in enumerate(columns):
        b = df.select(*keep, F.lit(i).alias(ORDINAL), F.lit(label).alias(name_name),
                      F.col(col).cast("string").alias(value_name))
        if drop_nulls:
            b = b.where(F.col(value_name).isNotNull())
        branches.append(b)
    return reduce(DataFrame.unionAll, branches)


def prefix_offsets(counts: DataFrame, order: list[str], n_col: str = "__n",
                   out_col: str = "__off", rows_per_bucket: int = 250_000) -> DataFrame:
    """Exclusive prefix sum of ``n_col`` in ``order``, computed distributed.

    ``counts`` is a small per-split table, but it grows with the input (one
    row per split), so it is not run through a single-partition window:
    it is range-partitioned into buckets by ``order``; each bucket sums its
    own prefix (a window partitioned by bucket), and the bucket totals (one
    row per bucket) get their prefix in one tiny window and are broadcast
    back.  ``counts`` must be materialised (deterministic) beforehand.
    """
    n = counts.count()
    cols = [F.col(c) for c in order]
    if n <= rows_per_bucket:
        # small enough for one task by a fixed bound: a single window
        w = Window.orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn(out_col, F.coalesce(F.sum(n_col).over(w), F.lit(0)))
    buckets = -(-n // rows_per_bucket)
    ranged = (counts.repartitionByRange(buckets, *cols)
              .withColumn("__bucket", F.spark_partition_id())).checkpoint(eager=True)
    totals = ranged.groupBy("__bucket").agg(F.sum(n_col).alias("__btotal"))
    starts = totals.withColumn("__bstart", F.coalesce(F.sum("__btotal").over(
        Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("__bucket").orderBy(*cols).rowsBetween(
        Window.unboundedPreceding, -1)
    local = ranged.withColumn(out_col, F.coalesce(F.sum(n_col).over(within), F.lit(0)))
    # one row per bucket: a proven bound, broadcast without a check
    return (local.join(F.broadcast(starts.select("__bucket", "__bstart")), "__bucket")
            .withColumn(out_col, F.col(out_col) + F.col("__bstart"))
            .drop("__bucket", "__bstart"))


def with_file_order_index(long_df: DataFrame, index_name: str = "row_id",
                          ordinal_index_name: str | None = None,
                          max_splits: int = 4_000_000,
                          return_offsets: bool = False):
    """Number rows 0..n-1 in (ordinal, file, block start, m) order.

    ``long_df`` must carry ``SPLIT_FILE``/``SPLIT_START`` (from
    ``tag_source_order``) and optionally ``ORDINAL`` (from
    ``melt_by_branches``).  Adds ``index_name`` and ``total_rows``; with
    ``ordinal_index_name`` also a numbering that restarts for each ordinal
    (each melted column) and ``group_rows`` (rows of that ordinal), so a
    later split needs no extra pass.  With ``return_offsets`` also returns
    the materialised per-split table (one row per input split and ordinal),
    from which part counts can be read cheaply.
    """
    if ORDINAL not in long_df.columns:
        long_df = long_df.withColumn(ORDINAL, F.lit(0))
    # The partition number (high bits of the id) completes the split key: for
    # a file scan it changes nothing (a split lives in one partition); for a
    # DataFrame not read from files (no file name) it makes each partition
    # its own "split", numbered in partition order.
    tagged = (long_df.withColumn(MID, F.monotonically_increasing_id())
              .withColumn(PART, F.shiftright(F.col(MID), 33)))
    keys = [ORDINAL, SPLIT_FILE, SPLIT_START, PART]
    counts = (tagged.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("__n"), F.min(MID).alias("__m0"))
              .checkpoint(eager=True))
    offsets = prefix_offsets(counts, keys)
    # total rows: sum of a one-row-per-split table (partial aggregation)
    total = counts.agg(F.sum("__n")).first()[0] or 0
    offsets = offsets.withColumn("total_rows", F.lit(total).cast("long"))
    if ordinal_index_name:
        # ordinals are the leading sort key, so each one is a contiguous run:
        # its numbering is the global offset minus the run's first offset.
        # One row per ordinal (melted column): a proven bound.
        runs = offsets.groupBy(ORDINAL).agg(F.min("__off").alias("__obase"),
                                            F.sum("__n").alias("group_rows"))
        offsets = offsets.join(F.broadcast(runs), ORDINAL)
    offsets = offsets.checkpoint(eager=True)
    joined = join_small(tagged, offsets.drop("__n"), keys, max_rows=max_splits)
    out = joined.withColumn(index_name, F.col("__off") + F.col(MID) - F.col("__m0"))
    if ordinal_index_name:
        out = out.withColumn(ordinal_index_name,
                             F.col("__off") - F.col("__obase") + F.col(MID) - F.col("__m0"))
    out = out.drop("__off", "__obase", "__m0", MID, PART)
    return (out, offsets) if return_offsets else out


def balanced_chunk(index: Column, n_rows: Column, n_parts: Column) -> Column:
    """Part number (0-based) of a 0-based row index for a balanced split.

    ``n_rows`` rows in ``n_parts`` contiguous parts, the first
    ``n_rows % n_parts`` parts one row longer (the ``array_split`` rule).
    """
    q = F.floor(n_rows / n_parts).cast("long")
    rem = n_rows - q * n_parts
    big = rem * (q + 1)
    return (F.when(index < big, F.floor(index / (q + 1)))
            .otherwise(rem + F.floor((index - big) / q))).cast("long")


def parts_needed(n_rows: Column, cap_rows: int) -> Column:
    """Smallest part count with no part above ``cap_rows`` (≥1 when rows exist)."""
    return F.ceil(n_rows / F.lit(cap_rows)).cast("long")


def balanced_split(indexed: DataFrame, cap_rows: int, index_col: str = "row_id",
                   rows_col: str = "total_rows", chunk_name: str = "chunk",
                   parts_name: str = "n_parts") -> DataFrame:
    """Assign ``chunk`` so the rows split into balanced parts ≤ ``cap_rows``.

    ``rows_col`` holds the size of the group the index runs over (from
    ``with_file_order_index``); no extra pass over the data is needed.
    """
    n_parts = parts_needed(F.col(rows_col), cap_rows)
    return (indexed.withColumn(parts_name, n_parts)
                   .withColumn(chunk_name, balanced_chunk(F.col(index_col), F.col(rows_col),
                                                          F.col(parts_name))))
