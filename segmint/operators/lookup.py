"""Joins against small look-up tables, broadcast only behind a size check.

The look-up sides here (catalogues, per-split offsets, per-group sizes) are
bounded by the number of audiences, splits or groups, never by the number
of data rows, but that bound is still checked at run time: the side is
counted first, and only a side at or under ``max_rows`` is hinted for
broadcast.  A larger side falls back to a normal shuffle join, which AQE
may still turn into a broadcast from real shuffle statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def fits_broadcast(small: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    """True when ``small`` has at most ``max_rows`` rows (reads ≤ max_rows+1)."""
    return small.limit(max_rows + 1).count() <= max_rows


def sized_lookup(small: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Materialise a look-up table once and hint broadcast only if it is small.

    For look-ups reused many times (e.g. every micro-batch of a stream).
    """
    small = small.checkpoint(eager=True)
    return F.broadcast(small) if fits_broadcast(small, max_rows) else small


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
               materialize: bool = False) -> DataFrame:
    """Join ``big`` to ``small``; broadcast ``small`` only if it is proven small.

    ``materialize`` checkpoints ``small`` first (to the shared checkpoint
    dir), for look-ups that are themselves an aggregate over the big side:
    the aggregate then runs once, and the size check reads the result.
    """
    if materialize:
        small = small.checkpoint(eager=True)
    side = F.broadcast(small) if fits_broadcast(small, max_rows) else small
    return big.join(side, on=on, how=how)
