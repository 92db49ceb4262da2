"""DuckDB SQL for the registered queries, written from the rules and not from the Spark code.

Each query starts from the driver's raw tables, derives the fixture sources, stages
them and builds what is asked. What the rules state as cases is data here: events and
pages, hours, order types and cancel notes are lookup tables, a customer's orders are
one list, delivery legs are a list whose place of the maximum names the bottleneck,
the share of the SLA limit that a delivery used is cut into buckets, and one aggregate
of a customer's deliveries feeds scores and churn alike. The rank of a value
counts the rows below it.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body.strip())


def with_ctes(final: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


# ------------------------------------------------------------------ fixture sources

CHANNEL_BY_U = "CASE {u} % 5 WHEN 0 THEN 'paid_search' WHEN 1 THEN 'social' WHEN 2 THEN 'push' WHEN 3 THEN 'organic' ELSE 'direct' END"
CAMPAIGN_BY = "CASE {k} % 3 WHEN 0 THEN '' WHEN 1 THEN 'C1' ELSE 'C2' END"
VOUCHER_BY = "CASE WHEN {k} % 4 <> 0 THEN '' WHEN {k} % 8 = 0 THEN 'V10' ELSE 'V20' END"

cte("fx_lines", [], """
SELECT l_orderkey, min(l_partkey) AS restaurant_id, min(l_suppkey) AS courier_id
FROM lineitem GROUP BY l_orderkey
""")

cte("fx_orders", ["fx_lines"], """
SELECT
    o.o_orderkey AS k,
    CASE WHEN o.o_custkey % 50 = 7 THEN o.o_custkey - 7 ELSE o.o_custkey END AS customer_id,
    li.restaurant_id,
    li.courier_id,
    o.o_orderpriority,
    o.o_totalprice,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(
        (date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 190) * 86400
        + (o.o_orderkey * 7919) % 86400 AS BIGINT)) AS placed_at,
    CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 0 THEN 'cancelled'
         WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 3 = 1 THEN 'failed'
         ELSE 'delivered' END AS order_status
FROM orders o
LEFT JOIN fx_lines li ON li.l_orderkey = o.o_orderkey
""")

cte("raw_orders", ["fx_orders"], f"""
SELECT
    fo.k AS order_id,
    fo.k AS session_id,
    fo.customer_id,
    fo.restaurant_id,
    fo.courier_id,
    CASE substr(fo.o_orderpriority, 1, 1) WHEN '1' THEN 'paid_search' WHEN '2' THEN 'social'
        WHEN '3' THEN 'push' WHEN '4' THEN 'organic' WHEN '5' THEN 'direct' END AS channel,
    {CAMPAIGN_BY.format(k='fo.k')} AS campaign,
    {VOUCHER_BY.format(k='fo.k')} AS voucher_code,
    CASE WHEN fo.k % 2 = 0 THEN 'ios' ELSE 'android' END AS device,
    n.n_name AS city,
    'zone_' || CAST(fo.k % 10 AS VARCHAR) AS destination_name,
    CASE WHEN fo.k % 97 = 0 THEN NULL
         WHEN fo.k % 13 = 0 THEN CAST((1 + (fo.k * 31) % 60) // 4 AS DOUBLE) + CAST(0.328125 AS DOUBLE)
         ELSE CAST(1 + (fo.k * 31) % 60 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS delivery_distance_km,
    CASE fo.k % 5 WHEN 0 THEN 'priority' WHEN 1 THEN 'saver' ELSE 'regular' END AS order_type,
    fo.placed_at,
    CASE WHEN fo.order_status = 'delivered' AND fo.k % 101 <> 0
         THEN fo.placed_at + to_seconds(CAST(300 + (fo.k * 13) % 1500 AS BIGINT)) END AS food_ready_at,
    CASE WHEN fo.order_status = 'delivered'
         THEN fo.placed_at + to_seconds(CAST(300 + (fo.k * 13) % 1500 + (fo.k * 17) % 900 AS BIGINT)) END AS picked_up_at,
    CASE WHEN fo.order_status = 'delivered'
         THEN fo.placed_at + to_seconds(CAST(300 + (fo.k * 13) % 1500 + (fo.k * 17) % 900
                                             + 480 + (fo.k * 29) % 2700 AS BIGINT)) END AS delivered_at,
    fo.order_status,
    CASE WHEN fo.order_status = 'delivered' THEN ''
         ELSE CASE fo.k % 6 WHEN 0 THEN 'driver_cancelled' WHEN 1 THEN 'driver_no_show'
                WHEN 2 THEN 'restaurant_closed' WHEN 3 THEN 'restaurant_too_busy'
                WHEN 4 THEN 'out_of_stock' ELSE 'customer_cancelled' END END AS cancel_note,
    round(fo.o_totalprice, 0) AS food_price,
    CASE WHEN fo.k % 8 = 0 THEN CAST(10000 AS DOUBLE) WHEN fo.k % 8 = 4 THEN CAST(20000 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS discount_amount
FROM fx_orders fo
LEFT JOIN customer c ON c.c_custkey = fo.customer_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")

cte("fx_event_names", [], """
SELECT * FROM (VALUES
    ('view', 0, 'page_view', 'home'),
    ('view', 1, 'page_view', 'restaurant_listing'),
    ('view', 2, 'page_view', 'search'),
    ('view', 3, 'page_view', 'restaurant_detail'),
    ('click', 0, 'restaurant_click', 'restaurant_listing'),
    ('click', 1, 'menu_impression', 'restaurant_detail'),
    ('click', 2, 'add_to_cart', 'cart'),
    ('click', 3, 'cart_view', 'cart'),
    ('signup', 0, 'search_query', 'search'),
    ('signup', 1, 'checkout_start', 'checkout'),
    ('signup', 2, 'voucher_applied', 'checkout'),
    ('signup', 3, 'payment_page_view', 'checkout'),
    ('purchase', 0, 'order_placed', 'order_status'),
    ('purchase', 1, 'order_ready_notification', 'order_status'),
    ('purchase', 2, 'order_delivered', 'order_status'),
    ('purchase', 3, 'order_delivered', 'order_status'),
    ('error', 0, 'app_error', 'error'),
    ('error', 1, 'app_error', 'error'),
    ('error', 2, 'app_error', 'error'),
    ('error', 3, 'app_error', 'error')
) t(event_type, slot, event_name, page_name)
""")

cte("raw_events", ["fx_event_names"], f"""
SELECT
    e.event_id,
    e.user_id * 100000 + date_diff('day', DATE '1970-01-01', CAST(e.ts AS DATE)) AS session_id,
    e.user_id,
    e.ts AS event_timestamp,
    m.event_name,
    m.page_name,
    {CHANNEL_BY_U.format(u='e.user_id')} AS channel,
    {CAMPAIGN_BY.format(k='e.user_id')} AS campaign,
    CASE WHEN (e.user_id // 60) % 2 = 0 THEN 'ios' ELSE 'android' END AS device,
    n.n_name AS city,
    {VOUCHER_BY.format(k='e.user_id')} AS voucher_code
FROM events e
LEFT JOIN fx_event_names m ON m.event_type = e.event_type AND m.slot = e.event_id % 4
LEFT JOIN nation n ON n.n_nationkey = e.user_id % 4
""")

cte("raw_sessions", ["raw_events"], f"""
SELECT
    s.session_id,
    s.session_id // 100000 AS user_id,
    {CHANNEL_BY_U.format(u='(s.session_id // 100000)')} AS channel,
    {CAMPAIGN_BY.format(k='(s.session_id // 100000)')} AS campaign,
    CASE WHEN ((s.session_id // 100000) // 60) % 2 = 0 THEN 'ios' ELSE 'android' END AS device,
    n.n_name AS city,
    s.session_start_at
FROM (SELECT session_id, min(event_timestamp) AS session_start_at FROM raw_events GROUP BY session_id) s
LEFT JOIN nation n ON n.n_nationkey = (s.session_id // 100000) % 4
""")

cte("raw_users", [], """
SELECT
    c.c_custkey AS customer_id,
    n.n_name AS city,
    TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST((c.c_custkey * 37) % 365 AS INTEGER)) AS registered_at,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
    '08' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS phone_number
FROM customer c
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")

cte("raw_restaurants", [], """
SELECT
    p.p_partkey AS restaurant_id,
    p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR) AS restaurant_name,
    p.p_type AS cuisine_type,
    n.n_name AS city,
    CASE WHEN p.p_size % 3 = 0 THEN '0' ELSE '1' END AS is_partner,
    CAST(3.0 AS DOUBLE) + CAST(p.p_partkey % 21 AS DOUBLE) / 10 AS rating
FROM part p
LEFT JOIN nation n ON n.n_nationkey = p.p_partkey % 25
""")

cte("raw_couriers", [], """
SELECT
    s.s_suppkey AS courier_id,
    n.n_name AS city,
    CASE WHEN s.s_suppkey % 10 <= 1 THEN 'bicycle' WHEN s.s_suppkey % 10 = 2 THEN 'car' ELSE 'motorcycle' END AS vehicle_type,
    TIMESTAMP '2022-01-01 00:00:00' + to_days(CAST((s.s_suppkey * 53) % 700 AS INTEGER)) AS joined_at,
    CASE WHEN s.s_suppkey % 5 = 0 THEN 'gold' WHEN s.s_suppkey % 5 <= 2 THEN 'bronze' ELSE 'silver' END AS courier_tier,
    CAST(3.0 AS DOUBLE) + CAST(s.s_suppkey % 21 AS DOUBLE) / 10 AS rating
FROM supplier s
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
""")

cte("raw_order_items", [], """
SELECT
    l.l_orderkey * 1000000 + row_number() OVER (
        PARTITION BY l.l_orderkey
        ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS item_id,
    l.l_orderkey AS order_id,
    p.p_name AS item_name,
    p.p_type AS cuisine_type,
    p.p_retailprice AS unit_price,
    l.l_quantity AS quantity
FROM lineitem l
JOIN part p ON p.p_partkey = l.l_partkey
""")

cte("raw_exchange_rates", [], """
SELECT * FROM (VALUES
    (1, 2024, '2024-01', '''IDR''', 15610.1, 6.406e-05, 'x-rates.com'),
    (2, 2024, '2024-02', '''IDR''', 15660.49, 6.385e-05, 'x-rates.com'),
    (3, 2024, '2024-03', '''IDR''', 15709.51, 6.366e-05, 'x-rates.com'),
    (4, 2024, '2024-04', '''IDR''', 16079.94, 6.219e-05, 'x-rates.com'),
    (5, 2024, '2024-05', '''IDR''', 16069.31, 6.223e-05, 'x-rates.com'),
    (6, 2024, '2024-06', '''IDR''', 16351.01, 6.116e-05, 'x-rates.com')
) t(month, year, period, lcy, usd_to_lcy, lcy_to_usd, source)
""")

# ------------------------------------------------------------------ staging

cte("stg_couriers", ["raw_couriers"], """
SELECT CAST(courier_id AS BIGINT) AS courier_id, city, vehicle_type, CAST(joined_at AS TIMESTAMP) AS joined_at,
       courier_tier, CAST(rating AS DOUBLE) AS rating
FROM raw_couriers
""")

cte("stg_restaurants", ["raw_restaurants"], """
SELECT CAST(restaurant_id AS BIGINT) AS restaurant_id, restaurant_name, cuisine_type, city,
       CAST(is_partner AS BOOLEAN) AS is_partner, CAST(rating AS DOUBLE) AS rating
FROM raw_restaurants
""")

cte("stg_exchange_rates", ["raw_exchange_rates"], """
SELECT CAST(month AS BIGINT) AS month, CAST(year AS BIGINT) AS year, period, lcy,
       CAST(usd_to_lcy AS DOUBLE) AS usd_to_lcy, CAST(lcy_to_usd AS DOUBLE) AS lcy_to_usd, source
FROM raw_exchange_rates
""")

cte("stg_users", ["raw_users"], """
SELECT CAST(customer_id AS BIGINT) AS customer_id, city, CAST(registered_at AS TIMESTAMP) AS registered_at,
       gender, phone_number
FROM raw_users
""")

cte("stg_sessions", ["raw_sessions"], """
SELECT CAST(session_id AS BIGINT) AS session_id, CAST(user_id AS BIGINT) AS user_id, channel,
       NULLIF(campaign, '') AS campaign, device, city,
       CAST(session_start_at AS TIMESTAMP) AS session_start_at,
       CAST(CAST(session_start_at AS TIMESTAMP) AS DATE) AS session_date,
       (dayofweek(CAST(session_start_at AS TIMESTAMP)) + 1) IN (1, 7) AS is_weekend
FROM raw_sessions
""")

cte("stg_order_items", ["raw_order_items"], """
SELECT CAST(item_id AS BIGINT) AS item_id, CAST(order_id AS BIGINT) AS order_id, item_name, cuisine_type,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) * CAST(quantity AS BIGINT) AS total_amount
FROM raw_order_items
""")

# One row for each event and page with a meaning of its own; page '*' is any other page.
STAGE_RULES = [
    ("page_view", "home", "APP_VISIT", 1),
    *[(e, p, "BROWSE", 2) for e in ("page_view", "restaurant_click", "search_query") for p in ("restaurant_listing", "search")],
    *[(e, "restaurant_detail", "BROWSE", 2) for e in ("menu_impression", "scroll_depth")],
    *[(e, "*", "NOISE", 2) for e in ("page_view", "restaurant_click", "search_query", "menu_impression", "scroll_depth")],
    *[(e, "*", "ADD_TO_CART", 3) for e in ("add_to_cart", "cart_view")],
    *[(e, "*", "CHECKOUT", 4) for e in ("voucher_applied", "checkout_start", "payment_page_view")],
    ("order_placed", "*", "BOOKING_ACCEPTED", 5),
    ("order_ready_notification", "*", "FOOD_READY_PICKUP", 6),
    ("order_delivered", "*", "DELIVERED", 7),
]


def values(rows: list[tuple], columns: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(str(r) for r in rows) + f") t({columns})"


cte("stage_rules", [], values(STAGE_RULES, "event_name, page_name, stage, ord"))
cte("stg_events", ["raw_events", "stage_rules"], """
SELECT e.* EXCLUDE (event_timestamp, campaign, voucher_code),
    CAST(e.event_timestamp AS TIMESTAMP) AS event_timestamp,
    CAST(e.event_timestamp AS DATE) AS event_date,
    nullif(e.campaign, '') AS campaign,
    nullif(e.voucher_code, '') AS voucher_code,
    coalesce(here.stage, anywhere.stage, 'NOISE') AS funnel_stage,
    CAST(coalesce(here.ord, anywhere.ord, 0) AS BIGINT) AS stage_order
FROM raw_events e
LEFT JOIN stage_rules here ON here.event_name = e.event_name AND here.page_name = e.page_name
LEFT JOIN stage_rules anywhere ON anywhere.event_name = e.event_name AND anywhere.page_name = '*'
""")

# Orders: lookups by hour, type and note; the customer's order list; legs and limit once, then everything read off them.
cte("hours", [], """
SELECT h, h IN (11, 12, 13, 18, 19, 20, 21) AS peak,
    coalesce(map {7: 'BREAKFAST', 8: 'BREAKFAST', 9: 'BREAKFAST', 10: 'BREAKFAST', 11: 'LUNCH', 12: 'LUNCH', 13: 'LUNCH',
        18: 'DINNER', 19: 'DINNER', 20: 'DINNER', 21: 'DINNER'}[h], 'OFF_PEAK') AS slot
FROM range(24) t(h)
""")
cte("order_types", [], values([("priority", "PRIORITY_DELIVERY", 7000), ("saver", "SAVER_DELIVERY", -2000)], "kind, name, adj"))
NOTE_PARTIES = [
    ("driver_cancelled", "driver"), ("driver_no_show", "driver"), ("restaurant_closed", "restaurant"),
    ("restaurant_too_busy", "restaurant"), ("out_of_stock", "restaurant"), ("customer_cancelled", "customer"),
]
cte("note_parties", [], values(NOTE_PARTIES, "note, party"))
cte("order_numbers", ["raw_orders"], """
SELECT unnest(ids) AS order_id, unnest(range(1, len(ids) + 1)) AS user_order_number
FROM (SELECT list(order_id ORDER BY placed_at NULLS FIRST, order_id) AS ids FROM raw_orders GROUP BY customer_id)
""")
LEG = "if(is_delivered, date_sub('minute', {a}, {b}), NULL)"
cte("measured", ["raw_orders"], f"""
SELECT *,
    order_status = 'delivered' AS is_delivered,
    [{LEG.format(a="placed_at", b="food_ready_at")}, {LEG.format(a="food_ready_at", b="picked_up_at")},
     {LEG.format(a="picked_up_at", b="delivered_at")}] AS legs,
    {LEG.format(a="placed_at", b="delivered_at")} AS total,
    30 + 3 * delivery_distance_km AS sla_limit,
    is_delivered AND total IS NOT NULL AS is_measured,
    total / sla_limit AS used,
    if(delivery_distance_km IS NULL, NULL, greatest(15000.0::DOUBLE, 2000 * delivery_distance_km)) AS base_price,
    round(food_price / 100, 0) AS one_percent,
    round(food_price / 50, 0) AS two_percent
FROM raw_orders
""")
cte("stg_orders", ["measured", "hours", "order_types", "note_parties", "order_numbers"], """
SELECT m.order_id, session_id, customer_id, restaurant_id, courier_id, channel, nullif(campaign, '') AS campaign,
    nullif(voucher_code, '') AS voucher_code, device, city, destination_name, delivery_distance_km, order_type,
    coalesce(t.name, 'REGULAR_DELIVERY') AS order_type_name, CAST(coalesce(t.adj, 0) AS BIGINT) AS order_type_adj,
    placed_at, food_ready_at, picked_up_at, delivered_at,
    CAST(placed_at AS DATE) AS order_date, CAST(h.h AS BIGINT) AS order_hour, isodow(placed_at) > 5 AS is_weekend,
    h.peak AS is_peak_hour, h.slot AS time_slot, order_status, nullif(cancel_note, '') AS cancel_note,
    if(nullif(cancel_note, '') IS NULL, NULL, p.party IS NOT DISTINCT FROM 'driver') AS is_cancelled_by_driver,
    if(nullif(cancel_note, '') IS NULL, NULL, p.party IS NOT DISTINCT FROM 'restaurant') AS is_cancelled_by_restaurant,
    if(nullif(cancel_note, '') IS NULL, NULL, p.party IS NOT DISTINCT FROM 'customer') AS is_cancelled_by_customer,
    legs[1] AS prep_time_mins, legs[2] AS courier_wait_mins, legs[3] AS courier_ride_mins, total AS total_delivery_mins,
    if(is_measured, used > 1, NULL) AS is_sla_breach,
    if(is_measured, coalesce(['FAST', 'ON_TIME', 'SLOW', 'VERY_SLOW'][1 + (used > 0.75)::INT + (used > 1)::INT + (used > 1.25)::INT],
        'VERY_SLOW'), NULL) AS delivery_bucket,
    if(is_measured, if(list_count(legs) = 3,
        ['RESTAURANT_PREP', 'COURIER_WAIT', 'COURIER_RIDE'][list_position(legs, list_max(legs))], 'COURIER_RIDE'), NULL)
        AS dominant_bottleneck,
    food_price, discount_amount, base_price AS base_delivery_price, base_price + order_type_adj AS delivery_price,
    one_percent AS platform_fee, two_percent AS restaurant_fee,
    round((base_price + order_type_adj) * 0.8::DOUBLE, 0) AS courier_commission,
    food_price + (base_price + order_type_adj) + one_percent - discount_amount AS gmv,
    one_percent + two_percent + round((base_price + order_type_adj) * 0.2::DOUBLE, 0) AS net_revenue,
    n.user_order_number, n.user_order_number = 1 AS is_first_order
FROM measured m
JOIN order_numbers n ON n.order_id = m.order_id
LEFT JOIN hours h ON h.h = hour(placed_at)
LEFT JOIN order_types t ON t.kind = order_type
LEFT JOIN note_parties p ON p.note = cancel_note
""")

# ------------------------------------------------------------------ customers

cte("delivered", ["stg_orders"], """
SELECT *, order_date + 90 >= max(order_date) OVER () AS is_recent, max(order_date) OVER () AS last_day
FROM stg_orders WHERE order_status = 'delivered'
""")
# All that the marts know of a customer, from one aggregate.
cte("activity", ["delivered"], """
SELECT customer_id,
    first({'channel': channel, 'campaign': campaign} ORDER BY placed_at NULLS FIRST, order_id) AS touch,
    touch['channel'] AS first_channel, touch['campaign'] AS first_campaign,
    min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    count(*) FILTER (is_recent) AS orders_in_90d,
    coalesce(round(sum(gmv) FILTER (is_recent), 0), 0) AS gmv_in_90d,
    CAST(any_value(last_day) - max(order_date) AS BIGINT) AS recency_days,
    count(*) AS n_delivered, count(*) FILTER (is_sla_breach) AS n_breached
FROM delivered GROUP BY customer_id
""")


def scored(rows: str) -> str:
    """Scores of rows with the activity's columns; the rank of a value counts the rows with smaller ones."""
    return f"""
WITH smaller AS (
    SELECT gmv_in_90d, sum(count(*)) OVER (ORDER BY gmv_in_90d) - count(*) AS less, sum(count(*)) OVER () AS n
    FROM {rows} GROUP BY gmv_in_90d
)
SELECT a.*, 3 - (recency_days > 30)::INT - (recency_days > 60)::INT AS r_score,
    1 + (orders_in_90d >= 2)::INT + (orders_in_90d >= 5)::INT AS f_score,
    1 + (n > 1 AND less >= 0.3 * (n - 1))::INT + (n > 1 AND less >= 0.7 * (n - 1))::INT AS m_score,
    r_score + f_score + m_score AS rfm_total,
    if(rfm_total = 9, 'VIP', if(rfm_total >= 7, 'REGULAR', if(rfm_total >= 5, 'OCCASIONAL', 'AT_RISK'))) AS customer_segment
FROM {rows} a JOIN smaller USING (gmv_in_90d)
"""


cte("rfm", ["activity"], scored("activity"))
cte("activity_by_order", ["delivered", "activity"], "SELECT a.* FROM delivered d JOIN activity a ON a.customer_id IS NOT DISTINCT FROM d.customer_id")
cte("rfm_by_order", ["activity_by_order"], scored("activity_by_order"))
USER_FIELDS = """customer_segment, r_score, f_score, m_score, rfm_total, recency_days, first_channel, first_campaign,
    first_order_date, last_order_date"""
SCORED_USERS = """
SELECT customer_id, u.city, u.gender, u.registered_at, u.phone_number,
    CASE WHEN known THEN coalesce(customer_segment, 'AT_RISK') END AS customer_segment,
    {scores},
    recency_days, first_channel, first_campaign, first_order_date, last_order_date, n_delivered, n_breached, known
FROM (SELECT *, true AS known FROM stg_users) u {join} JOIN {rfm} USING (customer_id)
""".replace("{scores}", ",\n    ".join(
    f"CASE WHEN known THEN CAST(coalesce({c}, {d}) AS BIGINT) END AS {c}"
    for c, d in (("r_score", 1), ("f_score", 1), ("m_score", 1), ("rfm_total", 3))))
cte("people", ["stg_users", "rfm"], SCORED_USERS.format(join="FULL", rfm="rfm"))
cte("context", ["people"], f"""
SELECT customer_id, n_delivered,
    CASE WHEN n_delivered IS NULL THEN NULL
         WHEN n_breached < 2 OR n_breached < 0.3 * n_delivered THEN 'LOW'
         WHEN n_breached >= 0.4 * n_delivered AND customer_segment IN ('VIP', 'REGULAR') THEN 'HIGH'
         ELSE 'MEDIUM' END AS tier,
    {", ".join(f"if(known, {c.strip()}, NULL) AS {c.strip()}" for c in USER_FIELDS.split(","))}
FROM people
""")
DIM_USERS = f"SELECT customer_id, city, gender, registered_at, phone_number, {USER_FIELDS} FROM {{people}} WHERE known"
cte("dim_users", ["people"], DIM_USERS.format(people="people"))
cte("people_by_order", ["stg_users", "rfm_by_order"], SCORED_USERS.format(join="LEFT", rfm="rfm_by_order"))
cte("dim_users_by_order", ["people_by_order"], DIM_USERS.format(people="people_by_order"))

# ------------------------------------------------------------------ order facts

MONEY = ["food_price", "discount_amount", "base_delivery_price", "delivery_price", "platform_fee",
         "restaurant_fee", "courier_commission", "gmv", "net_revenue"]
cte("fact_user_metrics", ["stg_orders", "context", "stg_exchange_rates"], f"""
SELECT o.* EXCLUDE (order_type_adj, food_ready_at, picked_up_at, delivered_at, {", ".join(MONEY)}),
    x.period_key AS order_period, {USER_FIELDS}, coalesce(tier, 'LOW') AS churn_risk_tier, lcy, usd_to_lcy, lcy_to_usd,
    {", ".join(f"{m} AS {m}_lcy, round({m} * lcy_to_usd, 2) AS {m}_usd" for m in MONEY)}
FROM stg_orders o
CROSS JOIN LATERAL (SELECT strftime(o.order_date, '%Y-%m') AS period_key) x
LEFT JOIN stg_exchange_rates fx ON fx.period = x.period_key
LEFT JOIN context c ON c.customer_id = o.customer_id
""")
cte("parties", ["stg_orders", "stg_restaurants", "stg_couriers", "context"], """
SELECT o.*, restaurant_name, cuisine_type, is_partner AS is_partner_restaurant, r.rating AS restaurant_rating,
    vehicle_type AS courier_vehicle, courier_tier, c.rating AS courier_rating, customer_segment,
    if(o.customer_id IS NULL, NULL, coalesce(tier, 'LOW')) AS churn_risk_tier
FROM stg_orders o
LEFT JOIN context x ON x.customer_id = o.customer_id
LEFT JOIN stg_couriers c ON c.courier_id = o.courier_id
LEFT JOIN stg_restaurants r ON r.restaurant_id = o.restaurant_id
""")
cte("fact_orders", ["parties"], "SELECT * EXCLUDE (order_type_adj) FROM parties")
cte("prep_norms", ["delivered"], "SELECT restaurant_id, round(avg(prep_time_mins), 1) AS restaurant_avg_prep_mins FROM delivered GROUP BY ALL")
cte("ride_norms", ["delivered"], "SELECT courier_id, round(avg(courier_ride_mins), 1) AS courier_avg_ride_mins FROM delivered GROUP BY ALL")
NOT_IN_DELIVERY = [
    "session_id", "campaign", "voucher_code", "device", "order_type_name", "order_type_adj", "order_hour", *MONEY,
    "user_order_number", "is_first_order",
]
cte("fact_delivery", ["parties", "prep_norms", "ride_norms"], f"""
SELECT p.* EXCLUDE ({", ".join(NOT_IN_DELIVERY)}, sla),
    restaurant_avg_prep_mins, courier_avg_ride_mins,
    round(prep_time_mins - restaurant_avg_prep_mins, 1) AS prep_vs_restaurant_avg,
    round(courier_ride_mins - courier_avg_ride_mins, 1) AS ride_vs_courier_avg,
    delivery_distance_km > 7 AS is_long_distance,
    round(sla, 1) AS sla_threshold_mins,
    if(is_sla_breach, round(total_delivery_mins - sla, 1), NULL) AS mins_over_threshold,
    dominant_bottleneck = 'RESTAURANT_PREP' AS is_prep_bottleneck,
    dominant_bottleneck <> 'RESTAURANT_PREP' AS is_courier_bottleneck,
    {", ".join(f"round({c} / nullif(total_delivery_mins, 0), 4) AS {n}_share_pct"
               for c, n in (("prep_time_mins", "prep"), ("courier_wait_mins", "wait"), ("courier_ride_mins", "ride")))}
FROM (SELECT *, 30 + 3 * delivery_distance_km AS sla FROM parties WHERE order_status = 'delivered') p
LEFT JOIN prep_norms a ON a.restaurant_id IS NOT DISTINCT FROM p.restaurant_id
LEFT JOIN ride_norms b ON b.courier_id IS NOT DISTINCT FROM p.courier_id
""")

# ------------------------------------------------------------------ scorecards

cte("flagged", ["stg_orders"], "SELECT *, order_status = 'delivered' AS ok FROM stg_orders")


def scorecard(key: str, own: dict[str, str]) -> str:
    """Counts that both parties share, then their own measures."""
    shared = {
        "delivered_orders": "count(*) FILTER (ok)",
        "cancelled_orders": "count(*) FILTER (NOT ok)",
        "sla_breached_orders": "count(*) FILTER (is_sla_breach)",
        "sla_breach_rate": "round(count(*) FILTER (is_sla_breach) / nullif(count(*) FILTER (ok), 0), 4)",
    }
    return f"SELECT {key}, " + ", ".join(f"{e} AS {c}" for c, e in (shared | own).items()) + " FROM flagged GROUP BY ALL"


cte("restaurant_stats", ["flagged"], scorecard("restaurant_id", {
    "total_orders": "count(*)",
    "cancelled_by_restaurant": "count(*) FILTER (is_cancelled_by_restaurant)",
    "fulfillment_rate": "round(avg(coalesce(ok, false)::INT), 4)",
    "avg_prep_time_mins": "round(avg(prep_time_mins) FILTER (ok), 1)",
    "avg_total_delivery_mins": "round(avg(total_delivery_mins) FILTER (ok), 1)",
    "total_food_revenue": "round(sum(food_price) FILTER (ok), 0)",
    "total_restaurant_fee_paid": "round(sum(restaurant_fee) FILTER (ok), 0)",
    "unique_customers": "count(DISTINCT customer_id)",
}))
cte("courier_stats", ["flagged"], scorecard("courier_id", {
    "total_orders": "count(DISTINCT order_id)",
    "cancelled_by_driver": "count(*) FILTER (is_cancelled_by_driver)",
    "completion_rate": "round(avg(coalesce(ok, false)::INT), 4)",
    "avg_ride_mins": "round(avg(courier_ride_mins) FILTER (ok), 1)",
    "avg_wait_mins": "round(avg(courier_wait_mins) FILTER (ok), 1)",
    "avg_distance_km": "round(avg(delivery_distance_km), 2)",
    "total_commission_earned": "round(sum(courier_commission) FILTER (ok), 0)",
    "unique_customers_served": "count(DISTINCT customer_id)",
}))
cte("dim_restaurants", ["stg_restaurants", "restaurant_stats"], "SELECT * FROM stg_restaurants LEFT JOIN restaurant_stats USING (restaurant_id)")
cte("dim_couriers", ["stg_couriers", "courier_stats"], """
SELECT c.* RENAME (rating AS courier_rating), s.* EXCLUDE (courier_id),
    coalesce(map {'gold': if(sla_breach_rate >= 0.3, 'UNDERPERFORMING', NULL),
                  'bronze': if(sla_breach_rate <= 0.1, 'OVERPERFORMING', NULL)}[courier_tier], 'EXPECTED') AS performance_vs_tier
FROM stg_couriers c LEFT JOIN courier_stats s USING (courier_id)
""")

# ------------------------------------------------------------------ funnel and channel

STAGES = ["app_visit", "browse", "add_to_cart", "checkout", "booking_accepted", "food_ready_pickup", "delivered"]
STAGE_COLUMNS = [f"s{i}_{name}" for i, name in enumerate(STAGES, 1)]
STEPS = ["visit_to_browse", "browse_to_cart", "cart_to_checkout", "checkout_to_booking", "booking_to_pickup", "pickup_to_delivered"]
MOVES = list(zip(STEPS, STAGE_COLUMNS, STAGE_COLUMNS[1:]))
FUNNEL_KEY = "session_date, channel, campaign, device, city"
cte("funnel_counts", ["stg_events"], f"""
SELECT {FUNNEL_KEY}, {", ".join(f"coalesce(stages['{n.upper()}'], 0)::BIGINT AS {c}" for n, c in zip(STAGES, STAGE_COLUMNS))}
FROM (
    SELECT event_date AS session_date, channel, coalesce(campaign, 'NONE') AS campaign, device, city, histogram(funnel_stage) AS stages
    FROM stg_events WHERE funnel_stage <> 'NOISE' GROUP BY ALL
)
""")
cte("fact_funnel", ["funnel_counts"], f"""
SELECT *, {", ".join(f"{b} / nullif({a}, 0) AS cvr_{s}" for s, a, b in MOVES)},
    {STAGE_COLUMNS[-1]} / nullif({STAGE_COLUMNS[0]}, 0) AS cvr_end_to_end,
    {", ".join(f"{a} - {b} AS drop_{s}" for s, a, b in MOVES)},
    {", ".join(f"round(1 - cvr_{s}, 4) AS dropoff_{s}" for s, _, _ in MOVES)}
FROM funnel_counts
""")
MEANS = {
    **{f"avg_cvr_{n}": f"cvr_{s}" for n, s in (("visit_browse", STEPS[0]), ("browse_cart", STEPS[1]), ("cart_checkout", STEPS[2]))},
    "avg_cvr_end_to_end": "cvr_end_to_end",
    **{f"avg_dropoff_{n}": f"dropoff_{s}" for n, s in (("visit_browse", STEPS[0]), ("browse_cart", STEPS[1]), ("cart_checkout", STEPS[2]))},
}
cte("funnel_rollup", ["fact_funnel"], f"""
SELECT channel, campaign, sum({STAGE_COLUMNS[0]})::BIGINT AS total_visits, sum({STAGE_COLUMNS[-1]})::BIGINT AS total_conversions,
    {", ".join(f"round(avg({e}), 4) AS {c}" for c, e in MEANS.items())}
FROM fact_funnel GROUP BY ALL
""")
SPELLED = "coalesce(campaign, 'NONE') AS campaign, coalesce(voucher_code, 'NO_VOUCHER') AS voucher_code"
cte("checkouts", ["stg_events"], f"""
SELECT channel, campaign, voucher_code, count(*) AS checkout_sessions
FROM (SELECT DISTINCT channel, {SPELLED}, session_id FROM stg_events WHERE funnel_stage = 'CHECKOUT' AND session_id IS NOT NULL)
GROUP BY ALL
""")
cte("channel_orders", ["flagged"], f"""
SELECT channel, campaign, voucher_code, count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
    count(*) FILTER (is_first_order) AS first_orders, total_orders - first_orders AS repeat_orders,
    round(sum(gmv), 0) AS total_gmv, round(sum(discount_amount), 0) AS total_discount,
    round(sum(net_revenue), 0) AS total_net_revenue, round(avg(gmv), 0) AS avg_order_value,
    round(sum(discount_amount) / nullif(sum(gmv), 0), 4) AS discount_rate,
    round(sum(net_revenue) / nullif(unique_customers, 0), 0) AS net_revenue_per_customer,
    count(*) FILTER (is_sla_breach) AS sla_breached_orders,
    round(sla_breached_orders / nullif(count(*) FILTER (ok), 0), 4) AS sla_breach_rate
FROM (SELECT * REPLACE (coalesce(campaign, 'NONE') AS campaign, coalesce(voucher_code, 'NO_VOUCHER') AS voucher_code) FROM flagged)
GROUP BY ALL
""")
cte("fact_channel_performance", ["channel_orders", "funnel_rollup", "checkouts"], """
SELECT *,
    round(total_orders / nullif(checkout_sessions, 0), 4) AS checkout_to_order_cvr,
    round(first_orders / nullif(total_orders, 0), 4) AS first_order_ratio,
    round(total_net_revenue / nullif(total_visits, 0), 2) AS net_revenue_per_visit,
    round(total_net_revenue / nullif(checkout_sessions, 0), 2) AS net_revenue_per_checkout
FROM channel_orders LEFT JOIN funnel_rollup USING (channel, campaign) LEFT JOIN checkouts USING (channel, campaign, voucher_code)
""")

# ------------------------------------------------------------------ checks

MART_KEYS = {
    "fact_orders": ["order_id"], "fact_delivery": ["order_id"], "fact_user_metrics": ["order_id"],
    "dim_users": ["customer_id"], "dim_restaurants": ["restaurant_id"], "dim_couriers": ["courier_id"],
    "fact_funnel": FUNNEL_KEY.split(", "), "fact_channel_performance": ["channel", "campaign", "voucher_code"],
}
NULLABLE = {"fact_funnel": ["campaign"], "fact_channel_performance": ["campaign", "voucher_code"]}
STAGING_KEYS = {
    "stg_orders": ["order_id"], "stg_events": ["event_id"], "stg_sessions": ["session_id"], "stg_users": ["customer_id"],
    "stg_restaurants": ["restaurant_id"], "stg_couriers": ["courier_id"], "stg_order_items": ["item_id"],
    "stg_exchange_rates": ["period"],
}
DATES = ("session_date", "event_date")


def report(model: str, keys: list[str], failure: str, rest: str) -> str:
    """Rows of a key report; in a composite key a null is spelled out, but for a leading date."""
    spelled = [f"CAST({k} AS VARCHAR)" for k in keys]
    if len(keys) > 1:
        spelled = [t if i == 0 and k in DATES else f"coalesce({t}, 'NULL')" for i, (k, t) in enumerate(zip(keys, spelled))]
    text = " || '|' || ".join(spelled)
    return f"SELECT '{model}' AS model, '{'+'.join(keys)}' AS column_name, '{failure}' AS failure_type, {text} AS failed_value FROM {model} {rest}"


def repeated(keys: dict[str, list[str]]) -> list[str]:
    return [report(m, k, "duplicate", f"GROUP BY {', '.join(k)} HAVING count(*) > 1") for m, k in keys.items()]


def missing(keys: dict[str, list[str]], nullable: dict[str, list[str]]) -> list[str]:
    return [
        report(m, k, "null", "WHERE " + " OR ".join(f"{c} IS NULL" for c in k if c not in nullable.get(m, [])))
        for m, k in keys.items()
    ]


def checked(reports: list[str], *needed: str) -> str:
    return with_ctes("\nUNION ALL\n".join(reports), *needed)


CHECK_UNIQUE = checked(repeated(MART_KEYS), *MART_KEYS)
CHECK_NOT_NULL = checked(missing(MART_KEYS, NULLABLE), *MART_KEYS)
CHECK_STAGING_KEYS = checked(repeated(STAGING_KEYS) + missing(STAGING_KEYS, {}), *STAGING_KEYS)
CHECK_REPEATED_KEYS = checked(
    repeated({
        "lineitem": ["l_orderkey", "l_linenumber"],
        "stg_events": ["event_date", "channel", "campaign", "voucher_code"],
        "stg_orders": ["channel", "campaign", "voucher_code"],
    }),
    "stg_events", "stg_orders",
)
CHECK_MISSING_KEYS = checked(
    missing({"stg_orders": ["order_id", "restaurant_id", "campaign"], "stg_sessions": ["campaign"]}, {"stg_orders": ["order_id", "campaign"]}),
    "stg_orders", "stg_sessions",
)
CHECK_CANCELLED = with_ctes("""
SELECT order_id, order_status, gmv, net_revenue, courier_commission, platform_fee, restaurant_fee
FROM stg_orders
WHERE order_status IN ('cancelled', 'failed')
  AND len(list_filter([gmv, net_revenue, courier_commission, platform_fee, restaurant_fee], lambda x: x <> 0)) > 0
""", "stg_orders")
CHECK_SLA = with_ctes("""
SELECT order_id, total_delivery_mins, delivery_distance_km, shown AS sla_threshold_mins, is_sla_breach,
    if(is_sla_breach, 'false_positive', 'false_negative') AS failure_type
FROM (SELECT *, round(30 + 3 * delivery_distance_km, 1) AS shown FROM stg_orders WHERE order_status = 'delivered')
WHERE is_sla_breach <> (total_delivery_mins > shown)
""", "stg_orders")


def _cols(table: str, cols: str) -> str:
    return with_ctes(f"SELECT {cols} FROM {table}", table)


FD_METRICS = """order_id, sla_threshold_mins, is_long_distance, mins_over_threshold, is_prep_bottleneck,
    is_courier_bottleneck, prep_share_pct, wait_share_pct, ride_share_pct, prep_vs_restaurant_avg, ride_vs_courier_avg"""
FX_COLS = "order_id, order_period, lcy, usd_to_lcy, lcy_to_usd, " + ", ".join(
    [f"{m}_lcy" for m in MONEY] + [f"{m}_usd" for m in MONEY]
)

ORACLE_SQL: dict[str, str] = {
    # staging
    "stg_couriers": _cols("stg_couriers", "*"),
    "stg_restaurants": _cols("stg_restaurants", "*"),
    "stg_users": _cols("stg_users", "*"),
    "stg_sessions": _cols("stg_sessions", "*"),
    "stg_order_items": _cols("stg_order_items", "*"),
    "stg_events": _cols("stg_events", "*"),
    "stg_orders": _cols("stg_orders", "*"),
    # marts
    "dim_users": _cols("dim_users", "*"),
    "dim_restaurants": _cols("dim_restaurants", "*"),
    "dim_couriers": _cols("dim_couriers", "*"),
    "fact_funnel": _cols("fact_funnel", "*"),
    "fact_user_metrics": _cols("fact_user_metrics", "*"),
    "fact_orders": _cols("fact_orders", "*"),
    "fact_delivery": _cols("fact_delivery", "*"),
    "fact_channel_performance": _cols("fact_channel_performance", "*"),
    "dim_users_as_written": _cols("dim_users_by_order", "*"),
    # order sub-operators
    "op_calendar": _cols("stg_orders", "order_id, order_date, order_hour, is_weekend, is_peak_hour"),
    "op_time_slot": _cols("stg_orders", "order_id, time_slot"),
    "op_order_type": _cols("stg_orders", "order_id, order_type, order_type_name, order_type_adj"),
    "op_cancel_attribution": _cols(
        "stg_orders", "order_id, cancel_note, is_cancelled_by_driver, is_cancelled_by_restaurant, is_cancelled_by_customer"
    ),
    "op_durations": _cols(
        "stg_orders", "order_id, prep_time_mins, courier_wait_mins, courier_ride_mins, total_delivery_mins"
    ),
    "op_order_sequence": _cols("stg_orders", "order_id, customer_id, user_order_number, is_first_order"),
    "op_pricing": _cols(
        "stg_orders",
        "order_id, base_delivery_price, delivery_price, platform_fee, restaurant_fee, courier_commission, gmv, net_revenue",
    ),
    "op_sla_classify": _cols("stg_orders", "order_id, is_sla_breach, delivery_bucket"),
    "op_bottleneck": _cols("stg_orders", "order_id, dominant_bottleneck"),
    # funnel and channel sub-operators
    "op_funnel_stage": _cols("stg_events", "event_id, event_name, page_name, funnel_stage, stage_order"),
    "op_funnel_counts": _cols("funnel_counts", "*"),
    "op_funnel_rates": _cols(
        "fact_funnel",
        "session_date, channel, campaign, device, city, "
        + ", ".join([f"cvr_{s}" for s in STEPS] + ["cvr_end_to_end"] + [f"drop_{s}" for s in STEPS]
                    + [f"dropoff_{s}" for s in STEPS]),
    ),
    "op_funnel_rollup": _cols("funnel_rollup", "*"),
    "op_checkout_counts": _cols("checkouts", "*"),
    "op_checkout_counts_of_days": _cols("checkouts", "*"),
    "op_channel_order_agg": _cols("channel_orders", "*"),
    "op_channel_ratios": _cols(
        "fact_channel_performance",
        "channel, campaign, voucher_code, checkout_to_order_cvr, first_order_ratio, net_revenue_per_visit, "
        "net_revenue_per_checkout",
    ),
    # customer sub-operators
    "op_first_touch": _cols("activity", "customer_id, first_channel, first_campaign, first_order_date, last_order_date"),
    "op_rfm_window": with_ctes(
        "SELECT customer_id, count(*) AS orders_in_90d, round(sum(gmv), 0) AS gmv_in_90d FROM delivered WHERE is_recent GROUP BY ALL",
        "delivered",
    ),
    "op_recency": _cols("rfm", "customer_id, recency_days, r_score::BIGINT AS r_score"),
    "op_rfm_scores": _cols(
        "rfm", "customer_id, orders_in_90d, gmv_in_90d, recency_days, " + ", ".join(f"{c}::BIGINT AS {c}" for c in ("r_score", "f_score", "m_score"))
    ),
    "op_segment": _cols("rfm", "customer_id, rfm_total::BIGINT AS rfm_total, customer_segment"),
    "op_churn_risk": with_ctes("SELECT customer_id, tier AS churn_risk_tier FROM context WHERE tier IS NOT NULL", "context"),
    "op_fx_convert": _cols("fact_user_metrics", FX_COLS),
    # delivery and scorecard sub-operators
    "op_party_avgs": _cols(
        "fact_delivery", "order_id, restaurant_id, courier_id, restaurant_avg_prep_mins, courier_avg_ride_mins"
    ),
    "op_delivery_metrics": _cols("fact_delivery", FD_METRICS),
    "op_restaurant_stats": _cols("restaurant_stats", "*"),
    "op_restaurant_customers_of_days": _cols("restaurant_stats", "restaurant_id, unique_customers"),
    "op_courier_customers_of_days": _cols("courier_stats", "courier_id, unique_customers_served"),
    "op_courier_stats": _cols("courier_stats", "*"),
    "op_courier_vs_tier": _cols("dim_couriers", "courier_id, courier_tier, sla_breach_rate, performance_vs_tier"),
    # checks
    "check_unique": CHECK_UNIQUE,
    "check_not_null": CHECK_NOT_NULL,
    "check_staging_keys": CHECK_STAGING_KEYS,
    "check_repeated_keys": CHECK_REPEATED_KEYS,
    "check_missing_keys": CHECK_MISSING_KEYS,
    "check_cancelled_orders": CHECK_CANCELLED,
    "check_sla_consistency": CHECK_SLA,
}
