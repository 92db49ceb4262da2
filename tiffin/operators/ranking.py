"""Order-dependent numbering that stays distributed under skew, as one lazy plan.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts every row of a group in
one task, and ``percent_rank() OVER (ORDER BY v)`` without a partition puts all
rows there. Both are rebuilt from buckets that follow the order: rows are numbered
or summed within a bucket, and a narrow table with one row a bucket carries what
stands before it. No bound depends on the data, and no job runs before the action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of :func:`rank_cuts` for each factor of e in the value: a bucket spans 1/256 of its value.
STEPS_PER_E = 256


def _row_keys(group_cols: list[str], buckets: list[Column]) -> dict[str, Column]:
    """The group and its buckets as columns without nulls, so that the window and the join share one exchange.

    Group columns are whole numbers; a null group is one group, apart from 0.
    """
    keys: dict[str, Column] = {}
    for i, c in enumerate(group_cols):
        keys |= {f"_g{i}": F.coalesce(F.col(c), F.lit(0)).cast("long"), f"_n{i}": F.col(c).isNull()}
    return keys | {f"_bucket{i}": F.coalesce(b.cast("long"), F.lit(-(1 << 62))) for i, b in enumerate(buckets)}


def _before(counts: DataFrame, group: list[str], buckets: list[str]) -> DataFrame:
    """``counts`` (group, buckets, _rows) with ``_before``, the group's rows in all earlier buckets.

    Level by level: sums over the coarsest bucket are added up within the group, those of
    the next within one coarse bucket, and so on, so no window holds more than one level's buckets.
    """
    *outer, last = buckets
    earlier = Window.partitionBy(*group, *outer).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    own = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if not outer:
        return own
    coarse = counts.groupBy(*group, *outer).agg(F.sum("_rows").alias("_rows"))
    base = _before(coarse, group, outer).select(*group, *outer, F.col("_before").alias("_base"))
    return own.join(base, [*group, *outer]).withColumn("_before", F.col("_before") + F.col("_base")).drop("_base")


def sequence_within(
    df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str, *buckets: Column, context: DataFrame | None = None
) -> DataFrame:
    """Add ``out_col`` = 1-based ROW_NUMBER within ``group_cols`` by ``order_cols``.

    Each of ``buckets``, from the coarsest on, is a whole number that grows with the order
    (null first, as in the order); a finer one lies within one coarser bucket. Rows are numbered within (group, buckets), and the
    group's rows in earlier buckets, from a narrow aggregate, are added. The wide rows are shuffled
    once, by (group, buckets), for the window and the join together. The one limit left is
    a single finest bucket of a single group, which is one task's work.

    ``context``, at most one row a group with the first of ``group_cols`` as its key, is joined to the narrow
    aggregate (null to nothing), so its columns reach the rows in the same shuffle.
    """
    keys = _row_keys(group_cols, list(buckets))
    names = list(keys)
    counts = df.select(*[e.alias(c) for c, e in keys.items()]).groupBy(*names).agg(F.count(F.lit(1)).alias("_rows"))
    levels = [c for c in names if c.startswith("_bucket")]
    before = _before(counts, names[: -len(levels)], levels).drop("_rows")
    if context is not None:
        known = context.withColumnRenamed(group_cols[0], "_key")
        before = before.join(known, (F.col("_g0") == F.col("_key")) & ~F.col("_n0"), "left").drop("_key")
    in_bucket = Window.partitionBy(*names).orderBy(*order_cols)
    numbered = df.withColumns(keys).withColumn("_row", F.row_number().over(in_bucket))
    joined = numbered.join(before, names)
    return joined.withColumn(out_col, (F.col("_row") + F.col("_before")).cast("long")).drop("_row", "_before", *names)


def rank_cuts(df: DataFrame, value_col: str, floors: list[float]) -> Column:
    """The smallest value whose PERCENT_RANK over all rows reaches each floor: a scalar struct c0, c1, ...

    The rank of a value is the share of the other rows with a smaller one, so it grows
    with the value, and a row reaches a floor exactly if its value reaches the cut. Equal
    values are one row with a count; counts are summed within logarithmic buckets, and
    the buckets' totals (a few thousand rows at most, whatever the data) give what
    stands before each. A cut is null where no rank reaches its floor.
    """
    value = F.col(value_col)
    bucket = F.signum(value) * F.floor(F.log1p(F.abs(value)) * STEPS_PER_E)
    values = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", bucket.cast("long"))
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = values.groupBy("_bucket").agg(F.sum("_n").alias("_rows"))
    totals = totals.select(
        "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"), F.sum("_rows").over(every).alias("_all")
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("_within", F.coalesce(F.sum("_n").over(in_bucket), F.lit(0))).join(totals, "_bucket")
    rank = F.when(F.col("_all") > 1, (F.col("_base") + F.col("_within")) / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    cuts = [F.min(F.when(rank >= floor, value)).alias(f"c{i}") for i, floor in enumerate(floors)]
    return placed.agg(F.struct(*cuts)).scalar()
