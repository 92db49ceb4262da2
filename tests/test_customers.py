from datetime import datetime, timedelta

from helpers import by_id, day, delivered, order, raw_orders
from pyspark.sql import functions as F

from tiffin.operators import customers as cu
from tiffin.plans import marts as mt
from tiffin.plans import staging as st
from tiffin.sources.seeds import exchange_rates_usd

USER_SCHEMA = "customer_id long, city string, registered_at timestamp_ntz, gender string, phone_number string"


def stg(spark, rows):
    return st.stg_orders(raw_orders(spark, rows))


def users(spark, ids):
    return spark.createDataFrame([(i, "X", datetime(2023, 1, 1), "M", "08") for i in ids], USER_SCHEMA)


def test_recency_and_window_boundaries(spark):
    # global last delivered date is day(0); customer c's last order is day(-offset)
    offsets = {1: 30, 2: 31, 3: 60, 4: 61}
    rows = [delivered(100, day(0), 60, 60, 600, customer_id=9)]
    rows += [delivered(c, day(-o), 60, 60, 600, customer_id=c) for c, o in offsets.items()]
    # 90-day window is inclusive: day(-90) counts, day(-91) does not
    rows += [delivered(200, day(-90), 60, 60, 600, customer_id=5), delivered(201, day(-91), 60, 60, 600, customer_id=5)]
    act = by_id(cu.customer_activity(cu.delivered_orders(stg(spark, rows))), "customer_id")
    assert {c: act[c]["recency_days"] for c in offsets} == offsets
    rec = by_id(cu.op_recency(cu.delivered_orders(stg(spark, rows))), "customer_id")
    assert [rec[c]["r_score"] for c in (1, 2, 3, 4)] == [3, 2, 2, 1]
    assert act[5]["orders_in_90d"] == 1 and act[5]["gmv_in_90d"] > 0


def test_frequency_and_monetary_scores(spark):
    # 11 customers with distinct 90-day GMV -> percent ranks 0.0, 0.1, ..., 1.0
    rows, oid = [], 0
    for c in range(11):
        n = [1, 2, 4, 5, 5, 1, 1, 1, 1, 1, 1][c]
        for k in range(n):
            oid += 1
            rows.append(delivered(oid, day(-k), 60, 60, 600, customer_id=c, food_price=1000.0 * (c + 1) / n))
    act = cu.customer_activity(cu.delivered_orders(stg(spark, rows)))
    got = by_id(cu.op_rfm_scores(act), "customer_id")
    assert [got[c]["f_score"] for c in range(5)] == [1, 2, 2, 3, 3]
    ranks = sorted(range(11), key=lambda c: got[c]["gmv_in_90d"])
    m = [got[c]["m_score"] for c in ranks]
    assert m == [1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3]  # >= 0.30 -> 2, >= 0.70 -> 3, exactly at the edges


def test_segments(spark):
    df = spark.createDataFrame([(3, 3, 3), (3, 3, 1), (3, 2, 2), (1, 2, 2), (2, 1, 1)], "r_score long, f_score long, m_score long")
    got = [(r.rfm_total, r.customer_segment) for r in cu.op_segment(df).collect()]
    assert got == [(9, "VIP"), (7, "REGULAR"), (7, "REGULAR"), (5, "OCCASIONAL"), (4, "AT_RISK")]


def test_churn_tiers(spark):
    df = spark.createDataFrame(
        [("VIP", 2, 5), ("OCCASIONAL", 2, 5), ("REGULAR", 3, 10), ("VIP", 1, 2), ("REGULAR", 3, 11), (None, 2, 5)],
        "customer_segment string, sla_breaches long, delivered_orders long",
    ).withColumn("customer_id", F.monotonically_increasing_id())
    got = [r.churn_risk_tier for r in cu.op_churn_risk(df).orderBy("customer_id").collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "MEDIUM"]


def test_first_touch_keeps_null_campaign_and_breaks_ties(spark):
    t = datetime(2024, 2, 1, 9)
    rows = [delivered(7, t, 60, 60, 600, customer_id=1, campaign="", channel="push"),
            delivered(5, t, 60, 60, 600, customer_id=1, campaign="C1", channel="social"),
            delivered(9, t - timedelta(hours=1), 60, 60, 600, customer_id=2, campaign="", channel="direct"),
            delivered(8, t, 60, 60, 600, customer_id=2, campaign="C2", channel="organic")]
    got = by_id(cu.op_first_touch(cu.delivered_orders(stg(spark, rows))), "customer_id")
    assert (got[1]["first_channel"], got[1]["first_campaign"]) == ("social", "C1")  # tie -> lower order_id
    assert (got[2]["first_channel"], got[2]["first_campaign"]) == ("direct", None)  # NULL campaign kept


def test_dim_users_defaults_and_as_written_fanout(spark):
    rows = [delivered(1, day(0), 60, 60, 600, customer_id=1), delivered(2, day(-1), 60, 60, 600, customer_id=1),
            delivered(3, day(-2), 60, 60, 600, customer_id=2), order(4, customer_id=3, order_status="cancelled")]
    o, u = stg(spark, rows), users(spark, [1, 2, 3, 4])
    dim = by_id(mt.dim_users(mt.customer_context(u, o)), "customer_id")
    assert len(dim) == 4
    assert (dim[4]["customer_segment"], dim[4]["r_score"], dim[4]["rfm_total"], dim[4]["recency_days"]) == ("AT_RISK", 1, 3, None)
    aw = mt.dim_users_as_written(u, o)
    assert sorted(r.customer_id for r in aw.collect()) == [1, 1, 2, 3, 4]


def test_fx_month_without_rate(spark):
    rows = [delivered(1, datetime(2024, 3, 5, 12), 60, 60, 600, food_price=123457.0),
            delivered(2, datetime(2024, 7, 5, 12), 60, 60, 600)]
    got = by_id(cu.op_fx_convert(stg(spark, rows), st.stg_exchange_rates(exchange_rates_usd(spark))))
    assert got[1]["order_period"] == "2024-03" and got[1]["lcy"] == "'IDR'"
    assert got[1]["food_price_usd"] == round(123457.0 * 6.366e-05, 2) and got[1]["food_price_lcy"] == 123457.0
    assert got[2]["order_period"] == "2024-07" and got[2]["lcy_to_usd"] is None and got[2]["gmv_usd"] is None


def test_fact_user_metrics_churn_counts_each_delivered_order_once(spark):
    # 2 delivered, 1 breach: contract rate 0.5 but 1 breach -> LOW; as written the fan-out doubles breaches.
    rows = [delivered(1, day(0), 60, 60, 600, customer_id=1, delivery_distance_km=1.0),  # 12 min > 33? no
            delivered(2, day(-1), 60, 60, 3000, customer_id=1, delivery_distance_km=1.0)]  # 52 min > 33 breach
    o, u = stg(spark, rows), users(spark, [1])
    fx = st.stg_exchange_rates(exchange_rates_usd(spark))
    contract = mt.fact_user_metrics(o, mt.customer_context(u, o), fx)
    assert {r.churn_risk_tier for r in contract.collect()} == {"LOW"} and contract.count() == 2
    aw = mt.fact_user_metrics_as_written(o, mt.dim_users_as_written(u, o), fx)
    assert aw.count() == 4
