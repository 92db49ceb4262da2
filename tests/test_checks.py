from datetime import date

from helpers import BASE, delivered, order, raw_orders
from pyspark.sql import functions as F

from tiffin.operators import checks as ck
from tiffin.plans import staging as st


def test_unique_and_not_null_find_planted_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "order_id long")
    f = spark.createDataFrame(
        [(date(2024, 1, 1), "push", None, "ios", "X"), (date(2024, 1, 1), "push", None, "ios", "X"),
         (None, "push", "C1", "ios", "X")],
        "session_date date, channel string, campaign string, device string, city string",
    )
    keys = ["session_date", "channel", "campaign", "device", "city"]
    dup = {(r.model, r.failed_value) for r in ck.check_unique({"fact_orders": (a, ["order_id"]), "fact_funnel": (f, keys)}).collect()}
    assert dup == {("fact_orders", "1"), ("fact_funnel", "2024-01-01|push|NULL|ios|X")}
    nul = ck.check_not_null({"fact_orders": (a, ["order_id"]), "fact_funnel": (f, keys)},
                            {"fact_funnel": ["session_date", "channel", "device", "city"]}).collect()
    assert sorted((r.model, r.column_name, r.failure_type, r.failed_value) for r in nul) == [
        ("fact_funnel", "session_date+channel+campaign+device+city", "null", None),  # CONCAT with NULL date
        ("fact_orders", "order_id", "null", None),
    ]


def test_cancelled_orders_with_money_are_reported(spark):
    rows = [order(1, order_status="cancelled", cancel_note="customer_cancelled"),  # priced -> violation
            order(2, order_status="delivered"),
            order(3, order_status="failed", delivery_distance_km=None, food_price=0.0)]  # gmv NULL, fees 0
    got = ck.check_cancelled_orders(st.stg_orders(raw_orders(spark, rows))).collect()
    assert [r.order_id for r in got] == [1]


def test_sla_consistency_false_positive_from_rounding(spark):
    # 9.99 km -> threshold 59.97, shown rounded as 60.0; 60 min is a breach yet <= 60.0
    rows = [delivered(1, BASE, 60, 60, 3480, delivery_distance_km=9.99),
            delivered(2, BASE, 60, 60, 3480, delivery_distance_km=10.0)]
    got = ck.check_sla_consistency(st.stg_orders(raw_orders(spark, rows))).collect()
    assert [(r.order_id, r.failure_type, r.sla_threshold_mins) for r in got] == [(1, "false_positive", 60.0)]


def test_sla_consistency_false_negative_on_planted_flag(spark):
    o = st.stg_orders(raw_orders(spark, [delivered(1, BASE, 60, 60, 3600)]))  # 61 min > 60
    planted = o.withColumn("is_sla_breach", F.lit(False))
    got = ck.check_sla_consistency(planted).collect()
    assert [(r.order_id, r.failure_type) for r in got] == [(1, "false_negative")]
