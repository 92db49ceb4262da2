"""Marts: dimensions and facts composed from staging models and operators.

Grain. The SQL these marts reproduce fans out in three places (the RFM step
keeps one row per delivered order, and two facts join an order-grain table on
customer_id). ``grain="contract"`` (default) builds the documented grain: one
row per customer / order / delivered order, each delivered order counted once
in ranks, churn counts and peer averages. ``grain="as_written"`` reproduces
the fanned-out SQL row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.operators import customers as cu
from tiffin.operators import funnel as fn
from tiffin.operators import scorecards as sc

CONTRACT, AS_WRITTEN = "contract", "as_written"

# The output columns of each mart, in model order.
DIM_USERS_COLUMNS = [
    "customer_id", "city", "gender", "registered_at", "phone_number", "customer_segment", "r_score",
    "f_score", "m_score", "rfm_total", "recency_days", "first_channel", "first_campaign",
    "first_order_date", "last_order_date",
]
USER_CONTEXT_COLUMNS = [
    "customer_segment", "r_score", "f_score", "m_score", "rfm_total", "recency_days", "first_channel",
    "first_campaign", "first_order_date", "last_order_date",
]
FACT_USER_METRICS_COLUMNS = [
    "order_id", "session_id", "customer_id", "restaurant_id", "courier_id", "order_date", "order_period",
    "placed_at", "order_status", "order_type", "order_type_name", "channel", "campaign", "voucher_code",
    "device", "city", "destination_name", "delivery_distance_km", "time_slot", "is_weekend", "is_peak_hour",
    "order_hour", "cancel_note", "is_cancelled_by_driver", "is_cancelled_by_restaurant",
    "is_cancelled_by_customer", "is_first_order", "user_order_number", "prep_time_mins", "courier_wait_mins",
    "courier_ride_mins", "total_delivery_mins", "is_sla_breach", "delivery_bucket", "dominant_bottleneck",
    "customer_segment", "churn_risk_tier", "r_score", "f_score", "m_score", "rfm_total", "recency_days",
    "first_channel", "first_campaign", "first_order_date", "last_order_date", "lcy", "usd_to_lcy",
    "lcy_to_usd",
    *[f"{c}_lcy" for c in cu.MONEY_COLUMNS],
    *[f"{c}_usd" for c in cu.MONEY_COLUMNS],
]
FACT_ORDERS_COLUMNS = [
    "order_id", "session_id", "customer_id", "restaurant_id", "courier_id", "channel", "campaign",
    "voucher_code", "device", "city", "destination_name", "delivery_distance_km", "order_type",
    "order_type_name", "placed_at", "food_ready_at", "picked_up_at", "delivered_at", "order_date",
    "order_hour", "is_weekend", "is_peak_hour", "time_slot", "order_status", "cancel_note",
    "is_cancelled_by_driver", "is_cancelled_by_restaurant", "is_cancelled_by_customer", "prep_time_mins",
    "courier_wait_mins", "courier_ride_mins", "total_delivery_mins", "is_sla_breach", "delivery_bucket",
    "dominant_bottleneck", "food_price", "discount_amount", "base_delivery_price", "delivery_price",
    "platform_fee", "restaurant_fee", "courier_commission", "gmv", "net_revenue", "user_order_number",
    "is_first_order", "restaurant_name", "cuisine_type", "is_partner_restaurant", "restaurant_rating",
    "courier_vehicle", "courier_tier", "courier_rating", "customer_segment", "churn_risk_tier",
]
FACT_DELIVERY_COLUMNS = [
    "order_id", "customer_id", "restaurant_id", "courier_id", "order_date", "placed_at", "food_ready_at",
    "picked_up_at", "delivered_at", "order_status", "cancel_note", "is_cancelled_by_driver",
    "is_cancelled_by_restaurant", "is_cancelled_by_customer", "channel", "city", "destination_name",
    "delivery_distance_km", "is_long_distance", "order_type", "time_slot", "is_weekend", "is_peak_hour",
    "restaurant_name", "cuisine_type", "is_partner_restaurant", "restaurant_rating", "courier_vehicle",
    "courier_tier", "courier_rating", "customer_segment", "churn_risk_tier", "prep_time_mins",
    "courier_wait_mins", "courier_ride_mins", "total_delivery_mins", "sla_threshold_mins", "is_sla_breach",
    "mins_over_threshold", "delivery_bucket", "dominant_bottleneck", "is_prep_bottleneck",
    "is_courier_bottleneck", "prep_share_pct", "wait_share_pct", "ride_share_pct",
    "restaurant_avg_prep_mins", "prep_vs_restaurant_avg", "courier_avg_ride_mins", "ride_vs_courier_avg",
]
DIM_RESTAURANTS_COLUMNS = [
    "restaurant_id", "restaurant_name", "cuisine_type", "city", "is_partner", "rating", "total_orders",
    "delivered_orders", "cancelled_orders", "cancelled_by_restaurant", "fulfillment_rate",
    "avg_prep_time_mins", "avg_total_delivery_mins", "sla_breached_orders", "sla_breach_rate",
    "total_food_revenue", "total_restaurant_fee_paid", "unique_customers",
]
DIM_COURIERS_COLUMNS = [
    "courier_id", "city", "vehicle_type", "joined_at", "courier_tier", "courier_rating", "total_orders",
    "delivered_orders", "cancelled_orders", "cancelled_by_driver", "completion_rate", "avg_ride_mins",
    "avg_wait_mins", "avg_distance_km", "sla_breached_orders", "sla_breach_rate", "total_commission_earned",
    "unique_customers_served", "performance_vs_tier",
]


# ---------------------------------------------------------------- scorecards

def dim_restaurants(restaurants: DataFrame, orders: DataFrame) -> DataFrame:
    stats = sc.op_restaurant_stats(orders)
    return restaurants.join(stats, "restaurant_id", "left").select(*DIM_RESTAURANTS_COLUMNS)


def dim_couriers(couriers: DataFrame, orders: DataFrame) -> DataFrame:
    stats = sc.op_courier_stats(orders)
    joined = couriers.withColumnRenamed("rating", "courier_rating").join(stats, "courier_id", "left")
    return sc.op_courier_vs_tier(joined).select(*DIM_COURIERS_COLUMNS)


# ---------------------------------------------------------------- funnel

def fact_funnel(events: DataFrame) -> DataFrame:
    return fn.op_funnel_rates(fn.op_funnel_counts(events))


def fact_channel_performance(funnel: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    order_agg = fn.op_channel_order_agg(orders)
    funnel_agg = fn.op_funnel_rollup(funnel)
    checkout = fn.op_checkout_counts(events)
    joined = order_agg.join(funnel_agg, ["channel", "campaign"], "left").join(
        checkout, ["channel", "campaign", "voucher_code"], "left"
    )
    return fn.op_channel_ratios(joined).select(*fn.CHANNEL_PERFORMANCE_COLUMNS)


# ---------------------------------------------------------------- users

def user_scores(orders: DataFrame) -> DataFrame:
    """Per customer with a delivered order: activity, r/f/m scores, segment."""
    activity = cu.customer_activity(cu.delivered_orders(orders))
    return cu.op_segment(cu.op_rfm_scores(activity))


def _with_no_order_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in cu.NO_ORDER_DEFAULTS.items()}).withColumns(
        {c: F.col(c).cast("long") for c in ("r_score", "f_score", "m_score", "rfm_total")}
    )


def customer_context(users: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per user or customer with a delivered order: the dim_users columns
    (null for customers who aren't users), is_user, and the churn tier (null
    without a delivered order).

    One aggregate of the delivered orders gives scores and churn counts alike; the
    order facts join this table once.
    """
    scores = user_scores(orders)
    known = users.withColumn("is_user", F.lit(True))
    ctx = _with_no_order_defaults(known.join(scores, "customer_id", "full"))
    ctx = ctx.withColumns({c: F.when(F.col("is_user"), F.col(c)) for c in USER_CONTEXT_COLUMNS})
    tier = F.when(
        F.col("delivered_orders").isNotNull(),
        cu.churn_tier(F.col("customer_segment"), F.col("sla_breaches"), F.col("delivered_orders")),
    )
    return ctx.withColumn("churn_risk_tier", tier).select(*DIM_USERS_COLUMNS, "is_user", "churn_risk_tier")


def dim_users(context: DataFrame) -> DataFrame:
    """The users of a :func:`customer_context`."""
    return context.filter("is_user").select(*DIM_USERS_COLUMNS)


def dim_users_as_written(users: DataFrame, orders: DataFrame) -> DataFrame:
    """RFM scored per delivered order (ranked over order rows), so a customer
    appears once per delivered order."""
    delivered = cu.delivered_orders(orders)
    activity = cu.customer_activity(delivered)
    scored = activity.withColumns(
        {"r_score": cu.r_score(F.col("recency_days")), "f_score": cu.f_score(F.col("orders_in_90d"))}
    )
    rows = delivered.select("customer_id").join(scored, "customer_id", "left")
    rows = rows.withColumn("gmv_in_90d", F.coalesce("gmv_in_90d", F.lit(0.0)))
    segmented = cu.op_segment(rows.withColumn("m_score", cu.m_score(rows.select("gmv_in_90d"), "gmv_in_90d")))
    return _with_no_order_defaults(users.join(segmented, "customer_id", "left")).select(*DIM_USERS_COLUMNS)


def churn_counts(orders: DataFrame) -> DataFrame:
    """Delivered orders and SLA breaches per customer (a partial aggregate)."""
    return (
        cu.delivered_orders(orders)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            cu.count_true(F.col("is_sla_breach") == True).alias("sla_breaches"),  # noqa: E712
        )
    )


METRICS_CONTEXT = ["customer_id", *USER_CONTEXT_COLUMNS, "churn_risk_tier"]


def fact_user_metrics(orders: DataFrame, context: DataFrame | None, fx: DataFrame) -> DataFrame:
    """Orders with user context, churn tier and USD amounts.

    ``context`` is a :func:`customer_context`; None where the orders have METRICS_CONTEXT already.
    """
    joined = orders if context is None else orders.join(context.select(*METRICS_CONTEXT), "customer_id", "left")
    joined = joined.withColumn("churn_risk_tier", F.coalesce("churn_risk_tier", F.lit("LOW")))
    return cu.op_fx_convert(joined, fx).select(*FACT_USER_METRICS_COLUMNS)


def fact_user_metrics_as_written(orders: DataFrame, dim: DataFrame, fx: DataFrame) -> DataFrame:
    """The SQL's joins against a dim_users with one row per delivered order:
    churn counts and order rows are both multiplied by that fan-out."""
    dim = dim.select("customer_id", *USER_CONTEXT_COLUMNS)
    delivered = cu.delivered_orders(orders).select("customer_id", "is_sla_breach")
    churn = (
        delivered.join(dim.select("customer_id", "customer_segment"), "customer_id", "left")
        .groupBy("customer_id", "customer_segment")
        .agg(F.count(F.lit(1)).alias("_n"), cu.count_true(F.col("is_sla_breach") == True).alias("_b"))  # noqa: E712
        .select("customer_id", cu.churn_tier(F.col("customer_segment"), F.col("_b"), F.col("_n")).alias("churn_risk_tier"))
    )
    joined = (
        orders.join(dim, "customer_id", "left")
        .join(churn, "customer_id", "left")
        .withColumn("churn_risk_tier", F.coalesce("churn_risk_tier", F.lit("LOW")))
    )
    return cu.op_fx_convert(joined, fx).select(*FACT_USER_METRICS_COLUMNS)


# ---------------------------------------------------------------- order facts

def _party_columns(restaurants: DataFrame, couriers: DataFrame) -> tuple[DataFrame, DataFrame]:
    rest = restaurants.select(
        "restaurant_id",
        "restaurant_name",
        "cuisine_type",
        F.col("is_partner").alias("is_partner_restaurant"),
        F.col("rating").alias("restaurant_rating"),
    )
    cour = couriers.select(
        "courier_id",
        F.col("vehicle_type").alias("courier_vehicle"),
        "courier_tier",
        F.col("rating").alias("courier_rating"),
    )
    return rest, cour


def _order_dimensions(orders: DataFrame, restaurants: DataFrame, couriers: DataFrame) -> DataFrame:
    rest, cour = _party_columns(restaurants, couriers)
    return orders.join(rest, "restaurant_id", "left").join(cour, "courier_id", "left")


TIER_COLUMNS = ["customer_id", "customer_segment", "churn_risk_tier"]


def _join_tiers(df: DataFrame, context: DataFrame | None) -> DataFrame:
    # Every order with a customer_id has a fact_user_metrics row whose tier
    # defaults to LOW; an order without one matches nothing.
    joined = df if context is None else df.join(context.select(*TIER_COLUMNS), "customer_id", "left")
    return joined.withColumn(
        "churn_risk_tier", F.when(F.col("customer_id").isNotNull(), F.coalesce("churn_risk_tier", F.lit("LOW")))
    )


def fact_orders(orders: DataFrame, restaurants: DataFrame, couriers: DataFrame, context: DataFrame | None) -> DataFrame:
    """Wide order fact; ``context`` is a :func:`customer_context`, None where the orders have TIER_COLUMNS already."""
    return _join_tiers(_order_dimensions(orders, restaurants, couriers), context).select(*FACT_ORDERS_COLUMNS)


def fact_delivery(orders: DataFrame, restaurants: DataFrame, couriers: DataFrame, context: DataFrame) -> DataFrame:
    """Delivered orders against SLA and per-party averages.

    The averages are joined to the party tables first (null parties are a group of
    their own), so the wide rows pass three joins: restaurant, courier, customer.
    """
    delivered = cu.delivered_orders(orders)
    prep, ride = sc.party_averages(delivered)
    rest, cour = _party_columns(restaurants, couriers)
    rest = _with_average(rest, prep, "restaurant_id")
    cour = _with_average(cour, ride, "courier_id")
    joined = delivered.join(rest, delivered["restaurant_id"].eqNullSafe(rest["_party_restaurant_id"]), "left")
    joined = joined.join(cour, joined["courier_id"].eqNullSafe(cour["_party_courier_id"]), "left")
    return sc.op_delivery_metrics(_join_tiers(joined, context)).select(*FACT_DELIVERY_COLUMNS)


def _with_average(party: DataFrame, average: DataFrame, key: str) -> DataFrame:
    """Parties and averages by ``_party_<key>``; a party without an id describes no order, but null orders have an average."""
    party = party.filter(F.col(key).isNotNull())
    avg = average.withColumnRenamed(key, "_key")
    both = party.join(avg, party[key].eqNullSafe(avg["_key"]), "full")
    return both.withColumn(f"_party_{key}", F.coalesce(key, "_key")).drop(key, "_key")


def fact_orders_as_written(orders: DataFrame, restaurants: DataFrame, couriers: DataFrame, metrics: DataFrame) -> DataFrame:
    """The SQL's join to every fact_user_metrics row of the customer; for tests on small inputs."""
    joined = _order_dimensions(orders, restaurants, couriers).join(metrics.select(*TIER_COLUMNS), "customer_id", "left")
    return joined.select(*FACT_ORDERS_COLUMNS)


def fact_delivery_as_written(orders: DataFrame, restaurants: DataFrame, couriers: DataFrame, metrics: DataFrame) -> DataFrame:
    """As :func:`fact_orders_as_written`; the multiplied rows are the basis of the averages."""
    joined = _order_dimensions(cu.delivered_orders(orders), restaurants, couriers)
    joined = joined.join(metrics.select(*TIER_COLUMNS), "customer_id", "left")
    return sc.op_delivery_metrics(sc.op_party_avgs(joined)).select(*FACT_DELIVERY_COLUMNS)
