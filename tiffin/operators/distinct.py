"""COUNT(DISTINCT id) as day-level state: bitmaps of ids that merge exactly over any days.

A table of distinct counts can't be added up over days, but the sets can. A day's state
holds, per group and block of 64 ids, one bitmap of the ids seen (a long); the state of
several days merges by OR, and the bits set are the count. So a month's or a year's counts
read the state, not the events, and late rows rebuild the state of their own day alone.

A bitmap is as wide as one id, so the state has at most a row of a few longs for each distinct (day, group,
id), however thin the ids lie, and one for 64 of them where they are handed out in sequence. Both aggregates
are hash aggregates over longs: they combine before the shuffle, spill, and deal a hot group by its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITMAP = "id_block", "id_bitmap"


def day_state(df: DataFrame, day: str, keys: Sequence[str | Column], id_col: str) -> DataFrame:
    """(day, keys, id_block, id_bitmap) of ``df``. Null ids count for nothing, but keep their group (block null)."""
    number = F.col(id_col).cast("long")
    block = F.shiftright(number, 6).alias(BLOCK)  # rounds down below zero, too
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))
    return df.groupBy(day, *keys, block).agg(F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias(BITMAP))


def merged_counts(state: DataFrame, keys: Sequence[str], out_col: str) -> DataFrame:
    """Distinct ids per ``keys`` over all days of ``state``; coarser keys than the state's count each id once, too."""
    blocks = state.groupBy(*keys, BLOCK).agg(F.bit_or(BITMAP).alias(BITMAP))
    return blocks.groupBy(*keys).agg(F.sum(F.bit_count(BITMAP)).alias(out_col))
