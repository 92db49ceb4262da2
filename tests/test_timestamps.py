"""Raw timestamps as text, zone-less or zoned give the same zone-less UTC, in any session time zone."""

import pytest
from helpers import BASE, delivered, order, raw_orders
from pyspark.sql import functions as F

from tiffin.plans import staging as st

TIMES = ["placed_at", "food_ready_at", "picked_up_at", "delivered_at"]


@pytest.fixture(params=["UTC", "Asia/Singapore", "America/New_York"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def _variants(raw):
    text = raw.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TIMES})
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zoned = raw.withColumns({c: F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(c))) for c in TIMES})
    return {"plain": raw, "text": text, "zoned": zoned}


def test_orders(spark, zone):
    raw = raw_orders(spark, [delivered(1, BASE, 600, 61, 3000), order(2, order_status="failed", placed_at=None)])
    rows = {}
    for kind, df in _variants(raw).items():
        out = st.stg_orders(df)
        assert all(out.schema[c].dataType.typeName() == "timestamp_ntz" for c in TIMES), kind
        rows[kind] = sorted(map(str, out.collect()))
    assert rows["plain"] == rows["text"] == rows["zoned"]
    first = st.stg_orders(raw).filter("order_id = 1").first()
    assert (first.order_hour, first.time_slot, first.prep_time_mins, first.placed_at) == (12, "LUNCH", 10, BASE)


def test_events_sessions_users_couriers(spark, zone):
    micros = 1_709_683_200_000_000  # 2024-03-06 00:00 UTC
    base = spark.range(1).select(F.timestamp_micros(F.lit(micros)).alias("zoned"))
    cases = {
        "stg_users": ("customer_id", "registered_at", "city gender phone_number"),
        "stg_couriers": ("courier_id", "joined_at", "city vehicle_type courier_tier rating"),
        "stg_sessions": ("session_id", "session_start_at", "user_id channel campaign device city"),
        "stg_events": ("event_id", "event_timestamp", "session_id user_id event_name page_name channel campaign device city voucher_code"),
    }
    for model, (key, ts, others) in cases.items():
        raw = base.select(F.lit("1").alias(key), F.col("zoned").alias(ts), *[F.lit("1").alias(c) for c in others.split()])
        got = getattr(st, model)(raw).first()
        text = getattr(st, model)(raw.withColumn(ts, F.lit("2024-03-06 00:00:00"))).first()
        empty = getattr(st, model)(raw.withColumn(ts, F.lit(""))).first()
        assert got == text and str(got[ts]) == "2024-03-06 00:00:00" and empty[ts] is None
