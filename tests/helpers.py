"""Hand-made raw rows for operator tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tiffin.plans import staging as st

SF_SMALL = "/root/testdata/sf0.001"

ORDER_SCHEMA = (
    "order_id long, session_id long, customer_id long, restaurant_id long, courier_id long, channel string, "
    "campaign string, voucher_code string, device string, city string, destination_name string, "
    "delivery_distance_km double, order_type string, placed_at timestamp_ntz, food_ready_at timestamp_ntz, "
    "picked_up_at timestamp_ntz, delivered_at timestamp_ntz, order_status string, cancel_note string, "
    "food_price double, discount_amount double"
)
BASE = datetime(2024, 3, 6, 12, 0, 0)  # a Wednesday


def order(order_id: int, **kw) -> dict:
    row = dict(
        order_id=order_id, session_id=order_id, customer_id=1, restaurant_id=10, courier_id=20,
        channel="organic", campaign="", voucher_code="", device="ios", city="X", destination_name="zone_1",
        delivery_distance_km=10.0, order_type="regular", placed_at=BASE, food_ready_at=None,
        picked_up_at=None, delivered_at=None, order_status="delivered", cancel_note="",
        food_price=100000.0, discount_amount=0.0,
    )
    row.update(kw)
    return row


def delivered(order_id: int, placed: datetime, prep_s: int, wait_s: int, ride_s: int, **kw) -> dict:
    ready = placed + timedelta(seconds=prep_s)
    picked = ready + timedelta(seconds=wait_s)
    done = picked + timedelta(seconds=ride_s)
    return order(order_id, placed_at=placed, food_ready_at=ready, picked_up_at=picked, delivered_at=done, **kw)


def raw_orders(spark: SparkSession, rows: list[dict]) -> DataFrame:
    cols = [c.split()[0] for c in ORDER_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ORDER_SCHEMA)


def typed(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return st.typed_orders(raw_orders(spark, rows))


def by_id(df: DataFrame, key: str = "order_id") -> dict:
    return {r[key]: r.asDict() for r in df.collect()}


def day(offset: int) -> datetime:
    return datetime.combine(date(2024, 6, 30) + timedelta(days=offset), datetime.min.time()) + timedelta(hours=12)
