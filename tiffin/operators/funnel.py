"""Conversion-funnel and channel sub-operators."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.operators.distinct import day_state, merged_counts
from tiffin.functions.semantics import count_true, safe_divide

# event/page names per funnel stage, and the stage order.
STAGES = [
    "APP_VISIT", "BROWSE", "ADD_TO_CART", "CHECKOUT",
    "BOOKING_ACCEPTED", "FOOD_READY_PICKUP", "DELIVERED",
]
STAGE_COLUMNS = [
    "s1_app_visit", "s2_browse", "s3_add_to_cart", "s4_checkout",
    "s5_booking_accepted", "s6_food_ready_pickup", "s7_delivered",
]
BROWSE_LIST_EVENTS = ("page_view", "restaurant_click", "search_query")
BROWSE_LIST_PAGES = ("restaurant_listing", "search")
BROWSE_DETAIL_EVENTS = ("menu_impression", "scroll_depth")
CART_EVENTS = ("add_to_cart", "cart_view")
CHECKOUT_EVENTS = ("voucher_applied", "checkout_start", "payment_page_view")
NO_CAMPAIGN = "NONE"
NO_VOUCHER = "NO_VOUCHER"
FUNNEL_KEYS = ["session_date", "channel", "campaign", "device", "city"]
CHANNEL_KEYS = ["channel", "campaign", "voucher_code"]

# (rate column, numerator stage column, denominator stage column)
RATES = [
    ("cvr_visit_to_browse", "s2_browse", "s1_app_visit"),
    ("cvr_browse_to_cart", "s3_add_to_cart", "s2_browse"),
    ("cvr_cart_to_checkout", "s4_checkout", "s3_add_to_cart"),
    ("cvr_checkout_to_booking", "s5_booking_accepted", "s4_checkout"),
    ("cvr_booking_to_pickup", "s6_food_ready_pickup", "s5_booking_accepted"),
    ("cvr_pickup_to_delivered", "s7_delivered", "s6_food_ready_pickup"),
    ("cvr_end_to_end", "s7_delivered", "s1_app_visit"),
]
STEP_SUFFIXES = [
    "visit_to_browse", "browse_to_cart", "cart_to_checkout",
    "checkout_to_booking", "booking_to_pickup", "pickup_to_delivered",
]


def op_funnel_stage(df: DataFrame) -> DataFrame:
    """funnel_stage and stage_order from event_name x page_name (the two disagree
    for list/detail events on other pages: stage NOISE, order 2)."""
    ev, page = F.col("event_name"), F.col("page_name")
    home_visit = (ev == "page_view") & (page == "home")
    stage = (
        F.when(home_visit, F.lit("APP_VISIT"))
        .when(ev.isin(*BROWSE_LIST_EVENTS) & page.isin(*BROWSE_LIST_PAGES), F.lit("BROWSE"))
        .when(ev.isin(*BROWSE_DETAIL_EVENTS) & (page == "restaurant_detail"), F.lit("BROWSE"))
        .when(ev.isin(*CART_EVENTS), F.lit("ADD_TO_CART"))
        .when(ev.isin(*CHECKOUT_EVENTS), F.lit("CHECKOUT"))
        .when(ev == "order_placed", F.lit("BOOKING_ACCEPTED"))
        .when(ev == "order_ready_notification", F.lit("FOOD_READY_PICKUP"))
        .when(ev == "order_delivered", F.lit("DELIVERED"))
        .otherwise(F.lit("NOISE"))
    )
    order = (
        F.when(home_visit, F.lit(1))
        .when(ev.isin(*BROWSE_LIST_EVENTS, *BROWSE_DETAIL_EVENTS), F.lit(2))
        .when(ev.isin(*CART_EVENTS), F.lit(3))
        .when(ev.isin(*CHECKOUT_EVENTS), F.lit(4))
        .when(ev == "order_placed", F.lit(5))
        .when(ev == "order_ready_notification", F.lit(6))
        .when(ev == "order_delivered", F.lit(7))
        .otherwise(F.lit(0))
    )
    return df.withColumns({"funnel_stage": stage, "stage_order": order.cast("long")})


def op_funnel_counts(events: DataFrame) -> DataFrame:
    """NOISE dropped; one row per (date, channel, campaign, device, city) with
    seven stage event counts (events, not distinct users)."""
    stage = F.col("funnel_stage")
    return (
        events.filter(stage != "NOISE")
        .groupBy(
            F.col("event_date").alias("session_date"),
            "channel",
            F.coalesce("campaign", F.lit(NO_CAMPAIGN)).alias("campaign"),
            "device",
            "city",
        )
        .agg(*[count_true(stage == s).alias(c) for s, c in zip(STAGES, STAGE_COLUMNS)])
    )


def op_funnel_rates(counts: DataFrame) -> DataFrame:
    """Step rates (unrounded), absolute drops and rounded drop-off rates."""
    rates = {name: safe_divide(num, den) for name, num, den in RATES}
    drops = {
        f"drop_{sfx}": F.col(STAGE_COLUMNS[i]) - F.col(STAGE_COLUMNS[i + 1]) for i, sfx in enumerate(STEP_SUFFIXES)
    }
    dropoffs = {
        f"dropoff_{sfx}": F.round(F.lit(1) - safe_divide(RATES[i][1], RATES[i][2]), 4)
        for i, sfx in enumerate(STEP_SUFFIXES)
    }
    return counts.select(*FUNNEL_KEYS, *STAGE_COLUMNS, *[c.alias(n) for n, c in {**rates, **drops, **dropoffs}.items()])


def op_funnel_rollup(funnel: DataFrame) -> DataFrame:
    """Funnel re-aggregated to (channel, campaign): visit and conversion totals,
    unweighted means of the daily rates."""
    mean = lambda c: F.round(F.avg(c), 4)
    return funnel.groupBy("channel", "campaign").agg(
        F.sum("s1_app_visit").alias("total_visits"),
        F.sum("s7_delivered").alias("total_conversions"),
        mean("cvr_visit_to_browse").alias("avg_cvr_visit_browse"),
        mean("cvr_browse_to_cart").alias("avg_cvr_browse_cart"),
        mean("cvr_cart_to_checkout").alias("avg_cvr_cart_checkout"),
        mean("cvr_end_to_end").alias("avg_cvr_end_to_end"),
        mean("dropoff_visit_to_browse").alias("avg_dropoff_visit_browse"),
        mean("dropoff_browse_to_cart").alias("avg_dropoff_browse_cart"),
        mean("dropoff_cart_to_checkout").alias("avg_dropoff_cart_checkout"),
    )


def _channel_keys() -> list[Column]:
    return [
        F.col("channel"),
        F.coalesce("campaign", F.lit(NO_CAMPAIGN)).alias("campaign"),
        F.coalesce("voucher_code", F.lit(NO_VOUCHER)).alias("voucher_code"),
    ]


CHANNEL_ORDER_COLUMNS = [
    *CHANNEL_KEYS, "total_orders", "unique_customers", "first_orders", "repeat_orders", "total_gmv", "total_discount",
    "total_net_revenue", "avg_order_value", "discount_rate", "net_revenue_per_customer", "sla_breached_orders", "sla_breach_rate",
]


def op_checkout_counts(events: DataFrame) -> DataFrame:
    """Distinct sessions with a CHECKOUT event per (channel, campaign, voucher)."""
    return (
        events.filter(F.col("funnel_stage") == "CHECKOUT")
        .groupBy(*_channel_keys())
        .agg(F.count_distinct("session_id").alias("checkout_sessions"))
    )


def checkout_days(events: DataFrame) -> DataFrame:
    """Sessions with a CHECKOUT event as mergeable state per (event_date, channel, campaign, voucher)."""
    return day_state(events.filter(F.col("funnel_stage") == "CHECKOUT"), "event_date", _channel_keys(), "session_id")


def checkout_counts_of(days: DataFrame) -> DataFrame:
    """:func:`op_checkout_counts` over the days whose state ``days`` holds."""
    return merged_counts(days, CHANNEL_KEYS, "checkout_sessions")


def first_orders(orders: DataFrame) -> DataFrame:
    """Customers whose first order (by placed_at, order_id; null customers are one) came by each (channel, campaign, voucher).

    An arg-min per customer: the least (placed_at, order_id) carries its keys, so no order is
    numbered, and a hot customer is one group of a partial aggregate.
    """
    keyed = orders.select("customer_id", "placed_at", "order_id", *_channel_keys())
    least = keyed.groupBy("customer_id").agg(F.min(F.struct("placed_at", "order_id", *CHANNEL_KEYS)).alias("_first"))
    return least.groupBy(*[F.col(f"_first.{k}").alias(k) for k in CHANNEL_KEYS]).agg(F.count(F.lit(1)).alias("first_orders"))


def op_channel_order_agg(orders: DataFrame) -> DataFrame:
    """Order aggregates per (channel, campaign, voucher), all statuses; ``orders`` need no order number."""
    breach = count_true(F.col("is_sla_breach") == True)  # noqa: E712
    customers = F.count_distinct("customer_id")
    totals = orders.groupBy(*_channel_keys()).agg(
        F.count(F.lit(1)).alias("total_orders"),
        customers.alias("unique_customers"),
        F.round(F.sum("gmv"), 0).alias("total_gmv"),
        F.round(F.sum("discount_amount"), 0).alias("total_discount"),
        F.round(F.sum("net_revenue"), 0).alias("total_net_revenue"),
        F.round(F.avg("gmv"), 0).alias("avg_order_value"),
        F.round(safe_divide(F.sum("discount_amount"), F.sum("gmv")), 4).alias("discount_rate"),
        F.round(safe_divide(F.sum("net_revenue"), customers), 0).alias("net_revenue_per_customer"),
        breach.alias("sla_breached_orders"),
        F.round(safe_divide(breach, count_true(F.col("order_status") == "delivered")), 4).alias("sla_breach_rate"),
    )
    firsts = first_orders(orders).toDF(*[f"_{k}" for k in CHANNEL_KEYS], "first_orders")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in CHANNEL_KEYS])
    first = F.coalesce("first_orders", F.lit(0).cast("long"))
    joined = totals.join(firsts, same, "left").withColumns({"first_orders": first, "repeat_orders": F.col("total_orders") - first})
    return joined.select(*CHANNEL_ORDER_COLUMNS)


CHANNEL_PERFORMANCE_COLUMNS = [
    "channel", "campaign", "voucher_code", "total_visits", "total_conversions", "avg_cvr_visit_browse",
    "avg_cvr_browse_cart", "avg_cvr_cart_checkout", "avg_cvr_end_to_end", "avg_dropoff_visit_browse",
    "avg_dropoff_browse_cart", "avg_dropoff_cart_checkout", "checkout_sessions", "checkout_to_order_cvr",
    "total_orders", "unique_customers", "first_orders", "repeat_orders", "first_order_ratio", "total_gmv",
    "total_discount", "total_net_revenue", "avg_order_value", "discount_rate", "net_revenue_per_customer",
    "net_revenue_per_visit", "net_revenue_per_checkout", "sla_breached_orders", "sla_breach_rate",
]


def op_channel_ratios(joined: DataFrame) -> DataFrame:
    """Ratios across the order, funnel and checkout aggregates."""
    return joined.withColumns(
        {
            "checkout_to_order_cvr": F.round(safe_divide("total_orders", "checkout_sessions"), 4),
            "first_order_ratio": F.round(safe_divide("first_orders", "total_orders"), 4),
            "net_revenue_per_visit": F.round(safe_divide("total_net_revenue", "total_visits"), 2),
            "net_revenue_per_checkout": F.round(safe_divide("total_net_revenue", "checkout_sessions"), 2),
        }
    )
