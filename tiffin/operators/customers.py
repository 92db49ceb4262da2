"""Customer sub-operators: first touch, RFM scores, segment, churn risk, FX.

The model's per-customer CTEs (first touch, 90-day window, recency, churn
counts) all aggregate the same delivered orders by customer_id, so
:func:`customer_activity` computes them in one hash aggregate (partial
aggregation on the map side; a hot customer adds rows to one output group, not
to one task). The "last delivered date" is an uncorrelated scalar subquery
that Spark evaluates once and reuses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.semantics import count_true, safe_divide, year_month
from tiffin.operators.ranking import rank_cuts

# Fixed values of the RFM and churn rules.
RFM_WINDOW_DAYS = 90
RECENCY_STEPS = ((30, 3), (60, 2))  # days <= limit -> r_score, else 1
FREQUENCY_STEPS = ((5, 3), (2, 2))  # orders >= floor -> f_score, else 1
MONETARY_STEPS = ((0.70, 3), (0.30, 2))  # percent rank >= floor -> m_score, else 1
SEGMENT_FLOORS = (("REGULAR", 7), ("OCCASIONAL", 5))  # VIP = 3/3/3 first, else AT_RISK
HIGH_VALUE_SEGMENTS = ("VIP", "REGULAR")
CHURN_HIGH_RATE, CHURN_MEDIUM_RATE, CHURN_MIN_BREACHES = 0.40, 0.30, 2
NO_ORDER_DEFAULTS = {"customer_segment": "AT_RISK", "r_score": 1, "f_score": 1, "m_score": 1, "rfm_total": 3}
MONEY_COLUMNS = [
    "food_price", "discount_amount", "base_delivery_price", "delivery_price", "platform_fee",
    "restaurant_fee", "courier_commission", "gmv", "net_revenue",
]

DELIVERED = "delivered"


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == DELIVERED)


def last_order_date(delivered: DataFrame) -> Column:
    """MAX(order_date) over all delivered orders, as a scalar subquery."""
    return delivered.agg(F.max("order_date")).scalar()


def _first_by_time(c: str) -> Column:
    # First value by placed_at (ties broken by order_id); keeps a NULL value.
    return F.min_by(c, F.struct("placed_at", "order_id"))


def customer_activity(delivered: DataFrame) -> DataFrame:
    """One row per customer with a delivered order: first touch, 90-day
    activity, recency and SLA counts."""
    last = last_order_date(delivered)
    rows = delivered.withColumn("_in_window", F.col("order_date") >= F.date_sub(last, RFM_WINDOW_DAYS))
    in_window = F.col("_in_window")
    agg = rows.groupBy("customer_id").agg(
        _first_by_time("channel").alias("first_channel"),
        _first_by_time("campaign").alias("first_campaign"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        count_true(in_window).alias("orders_in_90d"),
        F.coalesce(F.round(F.sum(F.when(in_window, F.col("gmv"))), 0), F.lit(0.0)).alias("gmv_in_90d"),
        F.count(F.lit(1)).alias("delivered_orders"),
        count_true(F.col("is_sla_breach") == True).alias("sla_breaches"),  # noqa: E712
    )
    return agg.withColumn("recency_days", F.datediff(last, F.col("last_order_date")).cast("long"))


def op_first_touch(delivered: DataFrame) -> DataFrame:
    return customer_activity(delivered).select(
        "customer_id", "first_channel", "first_campaign", "first_order_date", "last_order_date"
    )


def op_rfm_window(delivered: DataFrame) -> DataFrame:
    """Customers with at least one delivered order in the last 90 days."""
    last = last_order_date(delivered)
    return (
        delivered.filter(F.col("order_date") >= F.date_sub(last, RFM_WINDOW_DAYS))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("orders_in_90d"), F.round(F.sum("gmv"), 0).alias("gmv_in_90d"))
    )


def r_score(days: Column) -> Column:
    (d1, s1), (d2, s2) = RECENCY_STEPS
    return F.when(days <= d1, F.lit(s1)).when(days <= d2, F.lit(s2)).otherwise(F.lit(1)).cast("long")


def f_score(orders_90d: Column) -> Column:
    (n1, s1), (n2, s2) = FREQUENCY_STEPS
    return F.when(orders_90d >= n1, F.lit(s1)).when(orders_90d >= n2, F.lit(s2)).otherwise(F.lit(1)).cast("long")


def m_score(rows: DataFrame, value_col: str) -> Column:
    """Score of a value by its percent rank among ``rows``, from the values at which the rank reaches each floor."""
    cuts = rank_cuts(rows, value_col, [floor for floor, _ in MONETARY_STEPS])
    score = None
    for i, (_, s) in enumerate(MONETARY_STEPS):
        reached = F.col(value_col) >= cuts.getField(f"c{i}")
        score = F.when(reached, F.lit(s)) if score is None else score.when(reached, F.lit(s))
    return score.otherwise(F.lit(1)).cast("long")


def op_recency(delivered: DataFrame) -> DataFrame:
    return customer_activity(delivered).select(
        "customer_id", "recency_days", r_score(F.col("recency_days")).alias("r_score")
    )


def op_rfm_scores(activity: DataFrame) -> DataFrame:
    """r, f and m scores per customer; m is the percent rank of 90-day GMV
    among customers with a delivered order (distributed rank)."""
    return activity.withColumns(
        {
            "r_score": r_score(F.col("recency_days")),
            "f_score": f_score(F.col("orders_in_90d")),
            "m_score": m_score(activity.select("gmv_in_90d"), "gmv_in_90d"),
        }
    )


def op_segment(scores: DataFrame) -> DataFrame:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    total = r + f + m
    (n1, t1), (n2, t2) = SEGMENT_FLOORS
    segment = (
        F.when((r == 3) & (f == 3) & (m == 3), F.lit("VIP"))
        .when(total >= t1, F.lit(n1))
        .when(total >= t2, F.lit(n2))
        .otherwise(F.lit("AT_RISK"))
    )
    return scores.withColumns({"rfm_total": total, "customer_segment": segment})


def churn_tier(segment: Column, breaches: Column, orders: Column) -> Column:
    rate = safe_divide(breaches, orders)
    enough = breaches >= CHURN_MIN_BREACHES
    return (
        F.when(segment.isin(*HIGH_VALUE_SEGMENTS) & (rate >= CHURN_HIGH_RATE) & enough, F.lit("HIGH"))
        .when((rate >= CHURN_MEDIUM_RATE) & enough, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def op_churn_risk(activity_with_segment: DataFrame) -> DataFrame:
    """Churn tier per customer with a delivered order (others default to LOW)."""
    return activity_with_segment.select(
        "customer_id",
        churn_tier(F.col("customer_segment"), F.col("sla_breaches"), F.col("delivered_orders")).alias("churn_risk_tier"),
    )


def op_fx_convert(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Month key, the month's rate (NULL outside the rate table), and each money
    column as ``_lcy`` (unchanged) and ``_usd`` (rounded to cents).

    The join follows the rate table: an order gets a row for each rate of its month, so the
    table should hold one (``check_unique`` on ``period`` tells). Its size is left to the planner.
    """
    rates = fx.select(F.col("period").alias("order_period"), "lcy", "usd_to_lcy", "lcy_to_usd")
    keyed = orders.withColumn("order_period", year_month("order_date"))
    joined = keyed.join(rates, "order_period", "left")
    rate = F.col("lcy_to_usd")
    return joined.withColumns(
        {
            **{f"{c}_lcy": F.col(c) for c in MONEY_COLUMNS},
            **{f"{c}_usd": F.round(F.col(c) * rate, 2) for c in MONEY_COLUMNS},
        }
    )
