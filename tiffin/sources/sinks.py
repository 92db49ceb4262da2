"""Sinks: staging models as temporary views, marts as named Parquet tables of one schema.

Day-partitioned marts are written with ``partitionBy(date)`` so date filters
prune folders, and rows are sorted within each task on (date, cluster keys),
so Parquet min/max statistics let scans skip row groups. Sorted on (a, b, c), only filters on a
skip much; where each key is filtered alone, rows are sorted along a Z-order curve over all of them
instead, and Parquet bloom filters say which row groups lack an id.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


Z_BITS = 6


def z_cuts(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> dict[str, list]:
    """For each numeric column the cuts that deal its values to 2^``bits`` buckets of about equal rows.

    One pass over the columns: quantile sketches, merged; 2^bits - 1 numbers a column reach the driver.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, shares).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def _bucket(value: Column, cuts: list) -> Column:
    """The number of ``cuts`` that are not above ``value``, 0 for null."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda cut: cut <= value)) if cuts else F.lit(0)


def z_value(cuts: dict[str, list]) -> Column:
    """Place on the Z-order curve: the bits of the columns' buckets (nulls in the first) in turn, the highest first."""
    value = F.lit(0).cast("long")
    bits = max((len(v).bit_length() for v in cuts.values()), default=0)
    buckets = [_bucket(F.col(c), v) for c, v in cuts.items()]
    for bit in reversed(range(bits)):
        for bucket in buckets:
            value = F.shiftleft(value, 1).bitwiseOR(F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("long"))
    return value


def _bloom_filters(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """Bloom filters for these columns, as large as their values need (Parquet writes none where a dictionary does)."""
    if columns:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return writer


def _laid_out(
    df: DataFrame, partition_by: str | None, cluster_by: Sequence[str], cuts: dict[str, list] | None = None
) -> DataFrame:
    """With ``partition_by``, rows are rebalanced on the date (AQE splits a day that holds a
    large share of the rows across several tasks and merges small ones, so neither one huge
    task nor many tiny files), then sorted within each task on (date, *cluster_by), or with ``cuts`` on
    (date, Z-order over the columns of the cuts)."""
    order = [z_value(cuts)] if cuts else list(cluster_by)
    if partition_by:
        return df.hint("rebalance", F.col(partition_by)).sortWithinPartitions(partition_by, *order)
    return df.sortWithinPartitions(*order) if order else df


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = (), mode: str = "overwrite",
    cuts: dict[str, list] | None = None,
) -> None:
    """Write ``df`` as Parquet under ``path``; with ``cuts`` (:func:`z_cuts`) in Z-order and with bloom filters."""
    writer = _bloom_filters(_laid_out(df, partition_by, cluster_by, cuts).write.mode(mode), list(cuts or ()))
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_named_table(
    df: DataFrame, table: str, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = (),
    cuts: dict[str, list] | None = None,
) -> str:
    """Write ``df`` as the external Parquet table ``table``; returns the folder of this version, below ``path``.

    Each write is a new folder and a table of its own name. Only when it is complete does it
    take the name ``table``: a write that fails leaves the old table and its files as they were.
    Folders of earlier versions stay for readers that still use them; their owner removes them.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder, new, old = f"{path.rstrip('/')}/version={version}", f"{table}_new_{version}", f"{table}_old_{version}"
    writer = _laid_out(df, partition_by, cluster_by, cuts).write.mode("errorifexists").option("path", folder)
    writer = _bloom_filters(writer, list(cuts or ()))
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return folder


def overwrite_days(df: DataFrame, path: str, partition_by: str, cluster_by: Sequence[str] = ()) -> None:
    """Replace in the day-partitioned table under ``path`` the days that ``df`` has rows of, and no other."""
    writer = _laid_out(df, partition_by, cluster_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)


# The marts' schema.
SCHEMA = "marts"
# Partition and cluster settings of each mart.
MART_LAYOUT = {
    "fact_orders": ("order_date", ("channel", "city", "order_status")),
    "fact_delivery": ("order_date", ("restaurant_id", "courier_id", "customer_id")),
    "fact_user_metrics": ("order_date", ("channel", "customer_segment", "order_status")),
    "fact_funnel": ("session_date", ("channel", "device")),
    "dim_users": (None, ()),
    "dim_restaurants": (None, ()),
    "dim_couriers": (None, ()),
    "fact_channel_performance": (None, ()),
}
# Marts whose cluster keys are ids that are looked up one at a time.
Z_ORDERED = ("fact_delivery",)
