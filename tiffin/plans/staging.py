"""Staging models: typed, cleaned and enriched views over the raw sources.

Every function takes the raw source DataFrame (text or typed columns) and
returns a lazy plan; casts are no-ops when the input is already typed. Timestamps
become zone-less UTC, whether they come as text, zone-less or zoned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.semantics import is_weekend_day, nullif_empty, utc_timestamp
from tiffin.operators import funnel as fn
from tiffin.operators import orders as od

def stg_couriers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("courier_id").cast("long").alias("courier_id"),
        "city",
        "vehicle_type",
        utc_timestamp(raw, "joined_at"),
        "courier_tier",
        F.col("rating").cast("double").alias("rating"),
    )


def stg_restaurants(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("restaurant_id").cast("long").alias("restaurant_id"),
        "restaurant_name",
        "cuisine_type",
        "city",
        F.col("is_partner").cast("boolean").alias("is_partner"),
        F.col("rating").cast("double").alias("rating"),
    )


def stg_exchange_rates(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("month").cast("long").alias("month"),
        F.col("year").cast("long").alias("year"),
        "period",
        "lcy",
        F.col("usd_to_lcy").cast("double").alias("usd_to_lcy"),
        F.col("lcy_to_usd").cast("double").alias("lcy_to_usd"),
        "source",
    )


def stg_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("customer_id").cast("long").alias("customer_id"),
        "city",
        utc_timestamp(raw, "registered_at"),
        "gender",
        "phone_number",
    )


def stg_sessions(raw: DataFrame) -> DataFrame:
    start = utc_timestamp(raw, "session_start_at")
    return raw.select(
        F.col("session_id").cast("long").alias("session_id"),
        F.col("user_id").cast("long").alias("user_id"),
        "channel",
        nullif_empty("campaign").alias("campaign"),
        "device",
        "city",
        start.alias("session_start_at"),
        F.to_date(start).alias("session_date"),
        is_weekend_day(start).alias("is_weekend"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    price, qty = F.col("unit_price").cast("double"), F.col("quantity").cast("long")
    return raw.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.col("order_id").cast("long").alias("order_id"),
        "item_name",
        "cuisine_type",
        price.alias("unit_price"),
        qty.alias("quantity"),
        (price * qty).alias("total_amount"),
    )


STG_EVENTS_COLUMNS = [
    "event_id", "session_id", "user_id", "event_timestamp", "event_date", "event_name", "page_name",
    "channel", "campaign", "device", "city", "voucher_code", "funnel_stage", "stage_order",
]


def stg_events(raw: DataFrame) -> DataFrame:
    ts = utc_timestamp(raw, "event_timestamp")
    typed = raw.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("session_id").cast("long").alias("session_id"),
        F.col("user_id").cast("long").alias("user_id"),
        ts.alias("event_timestamp"),
        F.to_date(ts).alias("event_date"),
        "event_name",
        "page_name",
        "channel",
        nullif_empty("campaign").alias("campaign"),
        "device",
        "city",
        nullif_empty("voucher_code").alias("voucher_code"),
    )
    return fn.op_funnel_stage(typed).select(*STG_EVENTS_COLUMNS)


def typed_orders(raw: DataFrame) -> DataFrame:
    """The typing step of stg_orders."""
    return raw.select(
        *[F.col(c).cast("long").alias(c) for c in ("order_id", "session_id", "customer_id", "restaurant_id", "courier_id")],
        "channel",
        nullif_empty("campaign").alias("campaign"),
        nullif_empty("voucher_code").alias("voucher_code"),
        "device",
        "city",
        "destination_name",
        F.col("delivery_distance_km").cast("double").alias("delivery_distance_km"),
        "order_type",
        *[utc_timestamp(raw, c) for c in ("placed_at", "food_ready_at", "picked_up_at", "delivered_at")],
        "order_status",
        nullif_empty("cancel_note").alias("cancel_note"),
        F.col("food_price").cast("double").alias("food_price"),
        F.col("discount_amount").cast("double").alias("discount_amount"),
    )


def _enriched(df: DataFrame) -> DataFrame:
    for op in (od.op_calendar, od.op_time_slot, od.op_order_type, od.op_cancel_attribution, od.op_durations):
        df = op(df)
    for op in (od.op_pricing, od.op_sla_classify, od.op_bottleneck):
        df = op(df)
    return df


def enriched_orders(raw: DataFrame) -> DataFrame:
    """stg_orders without the customer's order number: one projection of the orders, no shuffle.

    What doesn't read user_order_number or is_first_order builds on this, as the plan for
    the number stays even where nobody reads it.
    """
    return _enriched(typed_orders(raw))


def stg_orders(raw: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """Typed orders through the nine order operators; 47 columns, and those of ``context`` (one row a customer_id).

    Orders are numbered first, so that the shuffle carries the typed columns and none of
    those derived from them; the context comes with the numbers.
    """
    own = [] if context is None else [c for c in context.columns if c != "customer_id"]
    return _enriched(od.op_order_sequence(typed_orders(raw), context)).select(*od.STG_ORDERS_COLUMNS, *own)
