from helpers import BASE, by_id, delivered, order, raw_orders

from tiffin.operators import scorecards as sc
from tiffin.plans import staging as st


def test_courier_vs_tier_boundaries(spark):
    df = spark.createDataFrame(
        [(1, "gold", 0.30), (2, "gold", 0.29), (3, "bronze", 0.10), (4, "bronze", 0.11), (5, "bronze", None),
         (6, "silver", 0.9)],
        "courier_id long, courier_tier string, sla_breach_rate double",
    )
    got = by_id(sc.op_courier_vs_tier(df), "courier_id")
    assert [got[i]["performance_vs_tier"] for i in range(1, 7)] == [
        "UNDERPERFORMING", "EXPECTED", "OVERPERFORMING", "EXPECTED", "EXPECTED", "EXPECTED"]


def test_party_avgs_match_window_including_null_party(spark):
    rows = [delivered(1, BASE, 600, 60, 600, restaurant_id=None, courier_id=1),
            delivered(2, BASE, 1200, 60, 1200, restaurant_id=None, courier_id=1),
            delivered(3, BASE, 300, 60, 300, restaurant_id=7, courier_id=None)]
    d = st.stg_orders(raw_orders(spark, rows))
    got = by_id(sc.op_party_avgs(d))
    assert got[1]["restaurant_avg_prep_mins"] == 15.0 and got[3]["restaurant_avg_prep_mins"] == 5.0
    assert got[1]["courier_avg_ride_mins"] == 15.0 and got[3]["courier_avg_ride_mins"] == 5.0


def test_restaurant_and_courier_stats(spark):
    rows = [delivered(1, BASE, 600, 60, 600, customer_id=1), delivered(2, BASE, 600, 60, 3000, customer_id=2),
            order(3, order_status="cancelled", cancel_note="out_of_stock", customer_id=1),
            order(4, order_status="failed", cancel_note="driver_no_show", customer_id=3)]
    o = st.stg_orders(raw_orders(spark, rows))
    r = sc.op_restaurant_stats(o).collect()[0]
    assert (r.total_orders, r.delivered_orders, r.cancelled_orders, r.cancelled_by_restaurant) == (4, 2, 2, 1)
    assert (r.fulfillment_rate, r.sla_breached_orders, r.sla_breach_rate, r.unique_customers) == (0.5, 1, 0.5, 3)
    c = sc.op_courier_stats(o).collect()[0]
    assert (c.total_orders, c.cancelled_by_driver, c.completion_rate, c.avg_distance_km) == (4, 1, 0.5, 10.0)


def test_delivery_metrics(spark):
    rows = [delivered(1, BASE, 600, 60, 3000, delivery_distance_km=7.25)]
    d = sc.op_party_avgs(st.stg_orders(raw_orders(spark, rows)))
    got = sc.op_delivery_metrics(d).collect()[0]
    assert got.sla_threshold_mins == 51.8 and got.is_long_distance and got.is_sla_breach
    assert got.mins_over_threshold == 9.3 and got.prep_share_pct == 0.1639  # 9.25 rounds half up
    assert got.prep_vs_restaurant_avg == 0.0 and not got.is_prep_bottleneck and got.is_courier_bottleneck
