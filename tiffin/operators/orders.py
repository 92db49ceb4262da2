"""Order enrichment sub-operators.

Each takes a DataFrame of typed orders and adds columns in one projection.
They compose in this order inside ``stg_orders``: calendar, time slot, order
type, cancel attribution, durations, pricing, SLA, bottleneck; the order sequence comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.semantics import is_weekend_day, minutes_between, strict_greatest
from tiffin.operators.ranking import sequence_within

# Fixed values of the order model.
PEAK_HOURS = ((11, 13), (18, 21))
TIME_SLOTS = (("LUNCH", 11, 13), ("DINNER", 18, 21), ("BREAKFAST", 7, 10))  # else OFF_PEAK
ORDER_TYPES = {"priority": ("PRIORITY_DELIVERY", 7000), "saver": ("SAVER_DELIVERY", -2000)}
REGULAR_ORDER_TYPE = ("REGULAR_DELIVERY", 0)
DRIVER_NOTES = ("driver_cancelled", "driver_no_show")
RESTAURANT_NOTES = ("restaurant_closed", "restaurant_too_busy", "out_of_stock")
CUSTOMER_NOTE = "customer_cancelled"
MIN_DELIVERY_PRICE = 15000.0
PRICE_PER_KM = 2000
PLATFORM_FEE_RATE = 0.01
RESTAURANT_FEE_RATE = 0.02
COURIER_SHARE = 0.80
PLATFORM_SHARE = 0.20
SLA_BASE_MINS = 30
SLA_MINS_PER_KM = 3
BUCKETS = (("FAST", 0.75), ("ON_TIME", 1.0), ("SLOW", 1.25))  # else VERY_SLOW

DELIVERED = "delivered"


def _hour() -> Column:
    return F.hour("placed_at")


def op_calendar(df: DataFrame) -> DataFrame:
    h = _hour()
    return df.withColumns(
        {
            "order_date": F.to_date("placed_at"),
            "order_hour": h.cast("long"),
            "is_weekend": is_weekend_day("placed_at"),
            "is_peak_hour": h.between(*PEAK_HOURS[0]) | h.between(*PEAK_HOURS[1]),
        }
    )


def op_time_slot(df: DataFrame) -> DataFrame:
    h = _hour()
    slot = None
    for name, lo, hi in TIME_SLOTS:
        slot = F.when(h.between(lo, hi), F.lit(name)) if slot is None else slot.when(h.between(lo, hi), F.lit(name))
    return df.withColumn("time_slot", slot.otherwise(F.lit("OFF_PEAK")))


def op_order_type(df: DataFrame) -> DataFrame:
    t = F.col("order_type")
    name, adj = None, None
    for key, (label, amount) in ORDER_TYPES.items():
        name = F.when(t == key, F.lit(label)) if name is None else name.when(t == key, F.lit(label))
        adj = F.when(t == key, F.lit(amount)) if adj is None else adj.when(t == key, F.lit(amount))
    return df.withColumns(
        {
            "order_type_name": name.otherwise(F.lit(REGULAR_ORDER_TYPE[0])),
            "order_type_adj": adj.otherwise(F.lit(REGULAR_ORDER_TYPE[1])).cast("long"),
        }
    )


def op_cancel_attribution(df: DataFrame) -> DataFrame:
    note = F.col("cancel_note")
    return df.withColumns(
        {
            "is_cancelled_by_driver": note.isin(*DRIVER_NOTES),
            "is_cancelled_by_restaurant": note.isin(*RESTAURANT_NOTES),
            "is_cancelled_by_customer": note == CUSTOMER_NOTE,
        }
    )


def op_durations(df: DataFrame) -> DataFrame:
    delivered = F.col("order_status") == DELIVERED

    def leg(start: str, end: str) -> Column:
        return F.when(delivered & F.col(end).isNotNull(), minutes_between(start, end))

    return df.withColumns(
        {
            "prep_time_mins": leg("placed_at", "food_ready_at"),
            "courier_wait_mins": leg("food_ready_at", "picked_up_at"),
            "courier_ride_mins": leg("picked_up_at", "delivered_at"),
            "total_delivery_mins": leg("placed_at", "delivered_at"),
        }
    )


def op_order_sequence(df: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """user_order_number (all statuses, by placed_at then order_id) and is_first_order.

    Orders are numbered within a customer's second, plus the customer's orders of earlier seconds of the hour and of
    earlier hours: a customer with a third of all orders in one hour is 3,600 groups. ``context`` (one row a
    customer_id) reaches the orders in the same shuffle.
    """
    second = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.date_trunc("second", "placed_at").cast("timestamp_ntz"))
    hour = F.floor(second / 3600)
    seq = sequence_within(df, ["customer_id"], ["placed_at", "order_id"], "user_order_number", hour, second, context=context)
    return seq.withColumn("is_first_order", F.col("user_order_number") == 1)


def op_pricing(df: DataFrame) -> DataFrame:
    km = F.col("delivery_distance_km")
    base = strict_greatest(F.lit(MIN_DELIVERY_PRICE), km * PRICE_PER_KM)
    food = F.col("food_price")
    platform_fee = F.round(food * F.lit(PLATFORM_FEE_RATE), 0)
    restaurant_fee = F.round(food * F.lit(RESTAURANT_FEE_RATE), 0)
    with_base = df.withColumn("base_delivery_price", base)
    delivery = F.col("base_delivery_price") + F.col("order_type_adj")
    return with_base.withColumns(
        {
            "delivery_price": delivery,
            "platform_fee": platform_fee,
            "restaurant_fee": restaurant_fee,
            "courier_commission": F.round(delivery * F.lit(COURIER_SHARE), 0),
            "gmv": food + delivery + platform_fee - F.col("discount_amount"),
            "net_revenue": platform_fee + restaurant_fee + F.round(delivery * F.lit(PLATFORM_SHARE), 0),
        }
    )


def sla_threshold(km: Column | None = None) -> Column:
    km = F.col("delivery_distance_km") if km is None else km
    return F.lit(SLA_BASE_MINS) + km * SLA_MINS_PER_KM


def _not_measured() -> Column:
    return (F.col("order_status") != DELIVERED) | F.col("total_delivery_mins").isNull()


def op_sla_classify(df: DataFrame) -> DataFrame:
    total, limit = F.col("total_delivery_mins"), sla_threshold()
    bucket = F.when(_not_measured(), F.lit(None).cast("string"))
    for name, factor in BUCKETS:
        bucket = bucket.when(total <= (limit * factor if factor != 1.0 else limit), F.lit(name))
    return df.withColumns(
        {
            "is_sla_breach": F.when(_not_measured(), F.lit(None).cast("boolean")).otherwise(total > limit),
            "delivery_bucket": bucket.otherwise(F.lit("VERY_SLOW")),
        }
    )


def op_bottleneck(df: DataFrame) -> DataFrame:
    prep, wait, ride = F.col("prep_time_mins"), F.col("courier_wait_mins"), F.col("courier_ride_mins")
    top = strict_greatest(prep, wait, ride)
    return df.withColumn(
        "dominant_bottleneck",
        F.when(_not_measured(), F.lit(None).cast("string"))
        .when(prep == top, F.lit("RESTAURANT_PREP"))
        .when(wait == top, F.lit("COURIER_WAIT"))
        .otherwise(F.lit("COURIER_RIDE")),
    )


# The stg_orders output columns, in model order.
STG_ORDERS_COLUMNS = [
    "order_id", "session_id", "customer_id", "restaurant_id", "courier_id", "channel", "campaign",
    "voucher_code", "device", "city", "destination_name", "delivery_distance_km", "order_type",
    "order_type_name", "order_type_adj", "placed_at", "food_ready_at", "picked_up_at", "delivered_at",
    "order_date", "order_hour", "is_weekend", "is_peak_hour", "time_slot", "order_status", "cancel_note",
    "is_cancelled_by_driver", "is_cancelled_by_restaurant", "is_cancelled_by_customer", "prep_time_mins",
    "courier_wait_mins", "courier_ride_mins", "total_delivery_mins", "is_sla_breach", "delivery_bucket",
    "dominant_bottleneck", "food_price", "discount_amount", "base_delivery_price", "delivery_price",
    "platform_fee", "restaurant_fee", "courier_commission", "gmv", "net_revenue", "user_order_number",
    "is_first_order",
]
