"""Data-quality checks. Each returns the offending rows; an empty result is a pass.

Key checks report (model, column_name, failure_type, failed_value) and union
the per-model results by name, so any number of models go into one report.
Duplicate detection is a partial aggregate per key, so a hot key costs one
group, never one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.operators.orders import sla_threshold

REPORT_COLUMNS = ["model", "column_name", "failure_type", "failed_value"]
STAGING_KEYS = {
    "stg_orders": ["order_id"],
    "stg_events": ["event_id"],
    "stg_sessions": ["session_id"],
    "stg_users": ["customer_id"],
    "stg_restaurants": ["restaurant_id"],
    "stg_couriers": ["courier_id"],
    "stg_order_items": ["item_id"],
    "stg_exchange_rates": ["period"],
}
MART_KEYS = {
    "fact_orders": ["order_id"],
    "fact_delivery": ["order_id"],
    "fact_user_metrics": ["order_id"],
    "dim_users": ["customer_id"],
    "dim_restaurants": ["restaurant_id"],
    "dim_couriers": ["courier_id"],
    "fact_funnel": ["session_date", "channel", "campaign", "device", "city"],
    "fact_channel_performance": ["channel", "campaign", "voucher_code"],
}
# Key columns the mart not-null check inspects (campaign and voucher may be NULL).
MART_NOT_NULL_KEYS = {
    **{k: v for k, v in MART_KEYS.items() if len(v) == 1},
    "fact_funnel": ["session_date", "channel", "device", "city"],
    "fact_channel_performance": ["channel"],
}


def _key_text(keys: Sequence[str], first_raw: bool) -> Column:
    """Key value as text: a single key cast to string; several joined by '|'
    with NULL spelled out (the first one cast, not spelled, for date keys)."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    parts = []
    for i, k in enumerate(keys):
        value = F.col(k).cast("string")
        parts.append(value if (i == 0 and first_raw) else F.coalesce(value, F.lit("NULL")))
        if i < len(keys) - 1:
            parts.append(F.lit("|"))
    return F.concat(*parts)


def _report(
    model: str, keys: Sequence[str], failure: str, rows: DataFrame, first_raw: bool, kind: Column | None = None
) -> DataFrame:
    return rows.select(
        F.lit(model).alias("model"),
        F.lit("+".join(keys)).alias("column_name"),
        (F.lit(failure) if kind is None else kind).alias("failure_type"),
        _key_text(keys, first_raw).alias("failed_value"),
    )


def _first_is_date(df: DataFrame, keys: Sequence[str]) -> bool:
    return len(keys) > 1 and dict(df.dtypes).get(keys[0]) == "date"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def check_unique(models: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per duplicated key value per model."""
    parts = []
    for name, (df, keys) in models.items():
        dups = df.groupBy(*keys).count().filter(F.col("count") > 1)
        parts.append(_report(name, keys, "duplicate", dups, _first_is_date(df, keys)))
    return _union(parts)


def check_not_null(
    models: Mapping[str, tuple[DataFrame, Sequence[str]]],
    checked: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per row whose key has a NULL in a checked column.

    ``checked`` names the key columns inspected per model (default: all of
    the key); the reported value always shows the whole key."""
    parts = []
    for name, (df, keys) in models.items():
        cols = list((checked or {}).get(name, keys))
        parts.append(_report(name, keys, "null", df.filter(any_missing(cols)), _first_is_date(df, keys)))
    return _union(parts)


def any_missing(columns: Sequence[str]) -> Column:
    """Whether a key column is null."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def key_metrics(columns: Sequence[str]) -> list[Column]:
    """Aggregates for ``DataFrame.observe``: rows, and rows with a null among ``columns``."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(any_missing(columns)).alias("missing_keys")]


def sla_metrics() -> list[Column]:
    """Aggregates for ``DataFrame.observe``: delivered orders whose flag and rounded threshold disagree, by side."""
    total, rounded = F.col("total_delivery_mins"), F.round(sla_threshold(), 1)
    base = (F.col("order_status") == "delivered") & total.isNotNull()
    flag = F.col("is_sla_breach")
    return [
        F.count_if(base & flag & (total <= rounded)).alias("sla_false_positive"),
        F.count_if(base & ~flag & (total > rounded)).alias("sla_false_negative"),
    ]


def check_written(tables: Mapping[str, DataFrame], metrics: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The key report over written marts: each is read once, for its key columns alone.

    One aggregate by key finds repeated keys and, only where the build's ``metrics`` counted
    any, those with a null: a null key's row is reported as often as it stands there.
    """
    parts = []
    for name, df in tables.items():
        keys, checked = MART_KEYS[name], MART_NOT_NULL_KEYS[name]
        groups = df.groupBy(*keys).count()
        failures = F.when(F.col("count") > 1, F.array(F.struct(F.lit("duplicate").alias("type"), F.lit(1).cast("long").alias("times"))))
        found = F.coalesce(failures, F.expr("array()").cast("array<struct<type:string,times:bigint>>"))
        if metrics[name]["missing_keys"]:
            nulls = F.when(any_missing(checked), F.array(F.struct(F.lit("null").alias("type"), F.col("count").alias("times"))))
            found = F.concat(found, F.coalesce(nulls, F.expr("array()").cast("array<struct<type:string,times:bigint>>")))
        rows = groups.select(*keys, F.explode(found).alias("_f")).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_f.times"))))
        parts.append(_report(name, keys, "", rows, _first_is_date(df, keys), F.col("_f.type")))
    return _union(parts)


def check_cancelled_orders(orders: DataFrame) -> DataFrame:
    """Cancelled or failed orders that carry a non-zero amount."""
    amounts = ["gmv", "net_revenue", "courier_commission", "platform_fee", "restaurant_fee"]
    nonzero = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0.0)) != 0 for c in amounts])
    return orders.filter(F.col("order_status").isin("cancelled", "failed") & nonzero).select(
        "order_id", "order_status", *amounts
    )


def check_sla_consistency(orders: DataFrame) -> DataFrame:
    """Breach flags that disagree with the threshold rounded to 0.1 minute."""
    total = F.col("total_delivery_mins")
    rounded = F.round(sla_threshold(), 1)
    base = orders.filter((F.col("order_status") == "delivered") & total.isNotNull())

    def side(flag: bool, cond: Column, label: str) -> DataFrame:
        return base.filter((F.col("is_sla_breach") == flag) & cond).select(
            "order_id",
            "total_delivery_mins",
            "delivery_distance_km",
            rounded.alias("sla_threshold_mins"),
            "is_sla_breach",
            F.lit(label).alias("failure_type"),
        )

    return side(True, total <= rounded, "false_positive").unionByName(side(False, total > rounded, "false_negative"))
