"""Restaurant and courier scorecards, and per-party delivery baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.operators.distinct import day_state
from tiffin.functions.semantics import count_true, safe_divide
from tiffin.operators.orders import sla_threshold

# Fixed values of the courier tier rule.
GOLD_UNDERPERFORMING_RATE = 0.30
BRONZE_OVERPERFORMING_RATE = 0.10
LONG_DISTANCE_KM = 7

DELIVERED = "delivered"


def _delivered() -> Column:
    return F.col("order_status") == DELIVERED


def _when_delivered(c: str) -> Column:
    return F.when(_delivered(), F.col(c))


def _breaches() -> Column:
    return count_true(F.col("is_sla_breach") == True)  # noqa: E712


def op_restaurant_stats(orders: DataFrame) -> DataFrame:
    """Per restaurant, all statuses; cancelled_orders counts every non-delivered status."""
    delivered = count_true(_delivered())
    return orders.groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        delivered.alias("delivered_orders"),
        count_true(F.col("order_status") != DELIVERED).alias("cancelled_orders"),
        count_true(F.col("is_cancelled_by_restaurant")).alias("cancelled_by_restaurant"),
        F.round(safe_divide(delivered, F.count(F.lit(1))), 4).alias("fulfillment_rate"),
        F.round(F.avg(_when_delivered("prep_time_mins")), 1).alias("avg_prep_time_mins"),
        F.round(F.avg(_when_delivered("total_delivery_mins")), 1).alias("avg_total_delivery_mins"),
        _breaches().alias("sla_breached_orders"),
        F.round(safe_divide(_breaches(), delivered), 4).alias("sla_breach_rate"),
        F.round(F.sum(_when_delivered("food_price")), 0).alias("total_food_revenue"),
        F.round(F.sum(_when_delivered("restaurant_fee")), 0).alias("total_restaurant_fee_paid"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def restaurant_customer_days(orders: DataFrame) -> DataFrame:
    """A restaurant's customers as mergeable state per order_date."""
    return day_state(orders, "order_date", ["restaurant_id"], "customer_id")


def courier_customer_days(orders: DataFrame) -> DataFrame:
    """A courier's customers as mergeable state per order_date."""
    return day_state(orders, "order_date", ["courier_id"], "customer_id")


def op_courier_stats(orders: DataFrame) -> DataFrame:
    """Per courier, all statuses; total_orders is a distinct order count.

    Two distinct counts over different columns in one aggregate would copy every order
    (Expand), so distinct orders are counted on their own narrow columns.
    """
    delivered = count_true(_delivered())
    distinct = orders.groupBy(F.col("courier_id").alias("_courier")).agg(F.count_distinct("order_id").alias("total_orders"))
    stats = orders.groupBy("courier_id").agg(
        delivered.alias("delivered_orders"),
        count_true(F.col("order_status") != DELIVERED).alias("cancelled_orders"),
        count_true(F.col("is_cancelled_by_driver")).alias("cancelled_by_driver"),
        F.round(safe_divide(delivered, F.count(F.lit(1))), 4).alias("completion_rate"),
        F.round(F.avg(_when_delivered("courier_ride_mins")), 1).alias("avg_ride_mins"),
        F.round(F.avg(_when_delivered("courier_wait_mins")), 1).alias("avg_wait_mins"),
        F.round(F.avg("delivery_distance_km"), 2).alias("avg_distance_km"),
        _breaches().alias("sla_breached_orders"),
        F.round(safe_divide(_breaches(), delivered), 4).alias("sla_breach_rate"),
        F.round(F.sum(_when_delivered("courier_commission")), 0).alias("total_commission_earned"),
        F.count_distinct("customer_id").alias("unique_customers_served"),
    )
    return stats.join(distinct, stats["courier_id"].eqNullSafe(distinct["_courier"])).select(
        "courier_id", "total_orders", *[c for c in stats.columns if c != "courier_id"]
    )


def courier_vs_tier(tier: Column, breach_rate: Column) -> Column:
    return (
        F.when((tier == "gold") & (breach_rate >= GOLD_UNDERPERFORMING_RATE), F.lit("UNDERPERFORMING"))
        .when((tier == "bronze") & (breach_rate <= BRONZE_OVERPERFORMING_RATE), F.lit("OVERPERFORMING"))
        .otherwise(F.lit("EXPECTED"))
    )


def op_courier_vs_tier(couriers_with_stats: DataFrame) -> DataFrame:
    return couriers_with_stats.withColumn(
        "performance_vs_tier", courier_vs_tier(F.col("courier_tier"), F.col("sla_breach_rate"))
    )


def party_averages(delivered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean prep per restaurant and mean ride per courier: one row a party, a null party being one group."""
    prep = F.round(F.avg("prep_time_mins"), 1).alias("restaurant_avg_prep_mins")
    ride = F.round(F.avg("courier_ride_mins"), 1).alias("courier_avg_ride_mins")
    return delivered.groupBy("restaurant_id").agg(prep), delivered.groupBy("courier_id").agg(ride)


def op_party_avgs(delivered: DataFrame) -> DataFrame:
    """Mean prep per restaurant and mean ride per courier, joined to every delivered order.

    Same values as ``avg() OVER (PARTITION BY party)``, but computed as two partial
    aggregates joined back: the windows would shuffle the rows twice and put a hot
    restaurant in one task. A NULL party is one group for a window, hence the null-safe
    join. Wide rows should be joined to party tables that hold the averages already.
    """
    prep, ride = party_averages(delivered)
    prep, ride = prep.withColumnRenamed("restaurant_id", "_rid"), ride.withColumnRenamed("courier_id", "_cid")
    out = delivered.join(prep, delivered["restaurant_id"].eqNullSafe(prep["_rid"]), "left")
    out = out.join(ride, out["courier_id"].eqNullSafe(ride["_cid"]), "left")
    return out.drop("_rid", "_cid")


def op_delivery_metrics(df: DataFrame) -> DataFrame:
    km, total = F.col("delivery_distance_km"), F.col("total_delivery_mins")
    limit = sla_threshold(km)
    return df.withColumns(
        {
            "sla_threshold_mins": F.round(limit, 1),
            "is_long_distance": km > LONG_DISTANCE_KM,
            "mins_over_threshold": F.when(F.col("is_sla_breach") == True, F.round(total - limit, 1)),  # noqa: E712
            "is_prep_bottleneck": F.col("dominant_bottleneck") == "RESTAURANT_PREP",
            "is_courier_bottleneck": F.col("dominant_bottleneck").isin("COURIER_WAIT", "COURIER_RIDE"),
            "prep_share_pct": F.round(safe_divide("prep_time_mins", total), 4),
            "wait_share_pct": F.round(safe_divide("courier_wait_mins", total), 4),
            "ride_share_pct": F.round(safe_divide("courier_ride_mins", total), 4),
            "prep_vs_restaurant_avg": F.round(F.col("prep_time_mins") - F.col("restaurant_avg_prep_mins"), 1),
            "ride_vs_courier_avg": F.round(F.col("courier_ride_mins") - F.col("courier_avg_ride_mins"), 1),
        }
    )
