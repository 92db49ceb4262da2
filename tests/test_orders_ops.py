from datetime import datetime, timedelta

from helpers import BASE, by_id, delivered, order, raw_orders, typed

from tiffin.operators import orders as od
from tiffin.plans import staging as st


def test_calendar_and_slots(spark):
    hours = [6, 7, 10, 11, 13, 14, 17, 18, 21, 22]
    rows = [order(h, placed_at=datetime(2024, 3, 9, h, 30)) for h in hours]  # Saturday
    rows.append(order(100, placed_at=datetime(2024, 3, 10, 12)))  # Sunday
    rows.append(order(101, placed_at=datetime(2024, 3, 11, 12)))  # Monday
    got = by_id(od.op_time_slot(od.op_calendar(typed(spark, rows))))
    slots = {h: got[h]["time_slot"] for h in hours}
    assert slots == {6: "OFF_PEAK", 7: "BREAKFAST", 10: "BREAKFAST", 11: "LUNCH", 13: "LUNCH", 14: "OFF_PEAK",
                     17: "OFF_PEAK", 18: "DINNER", 21: "DINNER", 22: "OFF_PEAK"}
    assert {h: got[h]["is_peak_hour"] for h in hours} == {
        6: False, 7: False, 10: False, 11: True, 13: True, 14: False, 17: False, 18: True, 21: True, 22: False}
    assert got[6]["is_weekend"] and got[100]["is_weekend"] and not got[101]["is_weekend"]
    assert got[6]["order_hour"] == 6 and str(got[6]["order_date"]) == "2024-03-09"


def test_order_type_including_null(spark):
    rows = [order(1, order_type="priority"), order(2, order_type="saver"), order(3, order_type="regular"),
            order(4, order_type=None)]
    got = by_id(od.op_order_type(typed(spark, rows)))
    assert [(got[i]["order_type_name"], got[i]["order_type_adj"]) for i in range(1, 5)] == [
        ("PRIORITY_DELIVERY", 7000), ("SAVER_DELIVERY", -2000), ("REGULAR_DELIVERY", 0), ("REGULAR_DELIVERY", 0)]


def test_cancel_attribution(spark):
    notes = ["driver_cancelled", "driver_no_show", "restaurant_closed", "restaurant_too_busy", "out_of_stock",
             "customer_cancelled", ""]
    rows = [order(i, order_status="cancelled", cancel_note=n) for i, n in enumerate(notes)]
    got = by_id(od.op_cancel_attribution(typed(spark, rows)))
    flags = [(got[i]["is_cancelled_by_driver"], got[i]["is_cancelled_by_restaurant"],
              got[i]["is_cancelled_by_customer"]) for i in range(len(notes))]
    assert flags[:6] == [(True, False, False), (True, False, False), (False, True, False), (False, True, False),
                         (False, True, False), (False, False, True)]
    assert flags[6] == (None, None, None)  # empty note -> NULL -> IN is NULL


def test_durations_truncate_and_guard(spark):
    placed = datetime(2024, 3, 6, 0, 30, 59)
    rows = [
        order(1, placed_at=placed, food_ready_at=placed + timedelta(seconds=61),
              picked_up_at=placed + timedelta(seconds=179), delivered_at=datetime(2024, 3, 6, 1, 15, 0)),
        order(2, placed_at=placed, food_ready_at=None, picked_up_at=placed + timedelta(minutes=20),
              delivered_at=placed + timedelta(minutes=40)),
        order(3, order_status="cancelled", placed_at=placed, food_ready_at=placed + timedelta(minutes=5)),
    ]
    got = by_id(od.op_durations(typed(spark, rows)))
    assert (got[1]["prep_time_mins"], got[1]["courier_wait_mins"], got[1]["total_delivery_mins"]) == (1, 1, 44)
    assert got[2]["prep_time_mins"] is None and got[2]["courier_wait_mins"] is None
    assert (got[2]["courier_ride_mins"], got[2]["total_delivery_mins"]) == (20, 40)
    assert all(got[3][c] is None for c in ("prep_time_mins", "courier_wait_mins", "total_delivery_mins"))


def test_pricing(spark):
    rows = [
        order(1, delivery_distance_km=5.0, food_price=150.0),  # base floor 15000, fee 1.5 -> 2
        order(2, delivery_distance_km=10.0, order_type="priority", food_price=250.0, discount_amount=10000.0),
        order(3, delivery_distance_km=None),
        order(4, delivery_distance_km=10.0, order_type="saver", food_price=100000.0),
    ]
    got = by_id(od.op_pricing(od.op_order_type(typed(spark, rows))))
    assert got[1]["base_delivery_price"] == 15000.0 and got[1]["platform_fee"] == 2.0
    assert got[1]["restaurant_fee"] == 3.0 and got[1]["delivery_price"] == 15000.0
    assert got[2]["delivery_price"] == 27000.0 and got[2]["courier_commission"] == 21600.0
    assert got[2]["gmv"] == 250.0 + 27000.0 + 3.0 - 10000.0
    assert got[2]["net_revenue"] == 3.0 + 5.0 + 5400.0
    assert got[3]["base_delivery_price"] is None and got[3]["gmv"] is None and got[3]["platform_fee"] == 1000.0
    assert got[4]["delivery_price"] == 18000.0 and got[4]["net_revenue"] == 1000.0 + 2000.0 + 3600.0


def test_sla_buckets_at_thresholds(spark):
    # 10 km -> threshold 60 min: FAST <= 45, ON_TIME <= 60, SLOW <= 75
    totals = {1: 45, 2: 46, 3: 60, 4: 61, 5: 75, 6: 76}
    rows = [delivered(i, BASE, 60, 60, m * 60 - 120) for i, m in totals.items()]
    rows.append(delivered(7, BASE, 60, 60, 600, delivery_distance_km=None))
    rows.append(order(8, order_status="failed"))
    got = by_id(od.op_sla_classify(od.op_durations(typed(spark, rows))))
    assert [got[i]["delivery_bucket"] for i in range(1, 7)] == ["FAST", "ON_TIME", "ON_TIME", "SLOW", "SLOW", "VERY_SLOW"]
    assert [got[i]["is_sla_breach"] for i in range(1, 7)] == [False, False, False, True, True, True]
    assert got[7]["is_sla_breach"] is None and got[7]["delivery_bucket"] == "VERY_SLOW"
    assert got[8]["is_sla_breach"] is None and got[8]["delivery_bucket"] is None


def test_bottleneck_ties_and_null_leg(spark):
    rows = [
        delivered(1, BASE, 600, 600, 600),  # all tie -> prep
        delivered(2, BASE, 300, 600, 600),  # wait = ride -> wait
        delivered(3, BASE, 300, 300, 900),  # ride
        delivered(4, BASE, 900, 300, 300),  # prep
    ]
    rows.append(order(5, food_ready_at=None, picked_up_at=BASE + timedelta(minutes=30),
                      delivered_at=BASE + timedelta(minutes=40)))  # NULL leg -> ride
    got = by_id(od.op_bottleneck(od.op_durations(typed(spark, rows))))
    assert [got[i]["dominant_bottleneck"] for i in range(1, 6)] == [
        "RESTAURANT_PREP", "COURIER_WAIT", "COURIER_RIDE", "RESTAURANT_PREP", "COURIER_RIDE"]


def test_sequence_ties_by_order_id_all_statuses(spark):
    rows = [order(5, placed_at=BASE), order(3, placed_at=BASE), order(4, placed_at=BASE - timedelta(days=1),
            order_status="cancelled"), order(9, customer_id=2, placed_at=BASE)]
    got = by_id(od.op_order_sequence(typed(spark, rows)))
    assert [got[i]["user_order_number"] for i in (4, 3, 5, 9)] == [1, 2, 3, 1]
    assert got[4]["is_first_order"] and not got[3]["is_first_order"]


def test_stg_orders_shape(spark):
    df = st.stg_orders(raw_orders(spark, [delivered(1, BASE, 60, 60, 60)]))
    assert df.columns == od.STG_ORDERS_COLUMNS and len(df.columns) == 47
