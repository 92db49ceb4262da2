"""Raw delivery-marketplace sources derived from the driver's TPC-H-style tables.

The models expect orders, events, sessions, users, order items, restaurants,
couriers and FX rates. The test tables hold none of these, so each source is a
deterministic function of them (see FIXTURES.md part B). Integer arithmetic
only, quarter-kilometre distances and whole-unit prices, so money and SLA
thresholds are exact in binary. Optional strings are ``''`` when empty, as a
raw source would deliver them; staging does the typing and NULLIF.

Every source is a Spark plan over the whole input tables: partial aggregates
for per-order line facts, joins for names, no driver-side data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.functions.semantics import ts_literal
from tiffin.operators.ranking import sequence_within
from tiffin.sources.seeds import exchange_rates_usd

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the mapping (FIXTURES.md part B).
CHANNEL_BY_PRIORITY_DIGIT = {"1": "paid_search", "2": "social", "3": "push", "4": "organic", "5": "direct"}
CHANNEL_BY_INDEX = ["paid_search", "social", "push", "organic", "direct"]
CANCEL_NOTES = [
    "driver_cancelled", "driver_no_show", "restaurant_closed",
    "restaurant_too_busy", "out_of_stock", "customer_cancelled",
]
# (driver event_type, event_id % 4) -> (event_name, page_name)
EVENT_NAMES = {
    ("view", 0): ("page_view", "home"),
    ("view", 1): ("page_view", "restaurant_listing"),
    ("view", 2): ("page_view", "search"),
    ("view", 3): ("page_view", "restaurant_detail"),
    ("click", 0): ("restaurant_click", "restaurant_listing"),
    ("click", 1): ("menu_impression", "restaurant_detail"),
    ("click", 2): ("add_to_cart", "cart"),
    ("click", 3): ("cart_view", "cart"),
    ("signup", 0): ("search_query", "search"),
    ("signup", 1): ("checkout_start", "checkout"),
    ("signup", 2): ("voucher_applied", "checkout"),
    ("signup", 3): ("payment_page_view", "checkout"),
    ("purchase", 0): ("order_placed", "order_status"),
    ("purchase", 1): ("order_ready_notification", "order_status"),
    ("purchase", 2): ("order_delivered", "order_status"),
    ("purchase", 3): ("order_delivered", "order_status"),
    ("error", 0): ("app_error", "error"),
    ("error", 1): ("app_error", "error"),
    ("error", 2): ("app_error", "error"),
    ("error", 3): ("app_error", "error"),
}
# 21/64 km past a whole one: an SLA limit of 0.984375 past a whole minute, which rounds up to the next.
NEAR_MINUTE_KM = 0.328125
PLACED_EPOCH = "2024-01-01 00:00:00"
ORDERDATE_EPOCH = "1995-01-01"
REGISTERED_EPOCH = "2023-01-01 00:00:00"
JOINED_EPOCH = "2022-01-01 00:00:00"
# A session is a user's day: user * SESSION_DAYS + days since DAY_EPOCH (below SESSION_DAYS until 2243).
DAY_EPOCH, SESSION_DAYS = "1970-01-01", 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _campaign(k: Column) -> Column:
    return _case(k % 3, {0: "", 1: "C1", 2: "C2"})


def _voucher(k: Column) -> Column:
    return F.when(k % 4 != 0, F.lit("")).when(k % 8 == 0, F.lit("V10")).otherwise(F.lit("V20"))


def _plus_seconds(base: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts_literal(base))


def _plus_days(base: str, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts_literal(base))


def _nation_names(nation: DataFrame, key: str, out: str) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("long").alias(key), F.col("n_name").alias(out))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("restaurant_id"), F.min("l_suppkey").alias("courier_id"))
    )
    customer_city = read_table(spark, sf_dir, "customer").join(
        _nation_names(read_table(spark, sf_dir, "nation"), "c_nationkey", "city"), "c_nationkey", "left"
    ).select(F.col("c_custkey").alias("customer_id"), "city")

    k = F.col("o_orderkey")
    delivered = F.col("order_status") == "delivered"
    placed_offset = (
        F.datediff(F.to_date("o_orderdate"), F.lit(ORDERDATE_EPOCH).cast("date")).cast("long") % 190 * 86400
        + k * 7919 % 86400
    )
    ready_offset = 300 + k * 13 % 1500
    pickup_offset = ready_offset + k * 17 % 900
    ride_offset = 480 + k * 29 % 2700
    base = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").select(
        k.alias("order_id"),
        k.alias("session_id"),
        F.when(F.col("o_custkey") % 50 == 7, F.col("o_custkey") - 7).otherwise(F.col("o_custkey")).alias("customer_id"),
        "restaurant_id",
        "courier_id",
        _case(F.substring("o_orderpriority", 1, 1), CHANNEL_BY_PRIORITY_DIGIT).alias("channel"),
        _campaign(k).alias("campaign"),
        _voucher(k).alias("voucher_code"),
        F.when(k % 2 == 0, F.lit("ios")).otherwise(F.lit("android")).alias("device"),
        F.concat(F.lit("zone_"), (k % 10).cast("string")).alias("destination_name"),
        F.when(k % 97 == 0, F.lit(None).cast("double"))
        .when(k % 13 == 0, F.floor((1 + k * 31 % 60) / 4).cast("double") + F.lit(NEAR_MINUTE_KM))
        .otherwise((1 + k * 31 % 60).cast("double") * F.lit(0.25))
        .alias("delivery_distance_km"),
        F.when(k % 5 == 0, F.lit("priority")).when(k % 5 == 1, F.lit("saver")).otherwise(F.lit("regular")).alias("order_type"),
        _plus_seconds(PLACED_EPOCH, placed_offset).alias("placed_at"),
        F.when((F.col("o_orderstatus") == "P") & (k % 3 == 0), F.lit("cancelled"))
        .when((F.col("o_orderstatus") == "P") & (k % 3 == 1), F.lit("failed"))
        .otherwise(F.lit("delivered"))
        .alias("order_status"),
        F.round("o_totalprice", 0).alias("food_price"),
        F.when(k % 8 == 0, F.lit(10000.0)).when(k % 8 == 4, F.lit(20000.0)).otherwise(F.lit(0.0)).alias("discount_amount"),
        ready_offset.alias("_ready"),
        pickup_offset.alias("_pickup"),
        (pickup_offset + ride_offset).alias("_delivered"),
        (k % 101 == 0).alias("_no_ready"),
        (k % 6).alias("_note"),
    )
    placed = F.col("placed_at")
    timed = base.withColumns(
        {
            "food_ready_at": F.when(delivered & ~F.col("_no_ready"), F.timestamp_add("SECOND", F.col("_ready"), placed)),
            "picked_up_at": F.when(delivered, F.timestamp_add("SECOND", F.col("_pickup"), placed)),
            "delivered_at": F.when(delivered, F.timestamp_add("SECOND", F.col("_delivered"), placed)),
            "cancel_note": F.when(delivered, F.lit("")).otherwise(_case(F.col("_note"), dict(enumerate(CANCEL_NOTES)))),
        }
    )
    with_city = timed.join(customer_city, "customer_id", "left")
    return with_city.select(
        "order_id", "session_id", "customer_id", "restaurant_id", "courier_id", "channel", "campaign",
        "voucher_code", "device", "city", "destination_name", "delivery_distance_km", "order_type",
        "placed_at", "food_ready_at", "picked_up_at", "delivered_at", "order_status", "cancel_note",
        "food_price", "discount_amount",
    )


def _user_attributes(u: Column, nation_city: Column) -> dict[str, Column]:
    return {
        "channel": _case(u % 5, dict(enumerate(CHANNEL_BY_INDEX))),
        "campaign": _campaign(u),
        "device": F.when(F.floor(u / 60) % 2 == 0, F.lit("ios")).otherwise(F.lit("android")),
        "city": nation_city,
    }


def _event_name_table(spark: SparkSession) -> DataFrame:
    """The fixed (event_type, slot) -> (event_name, page_name) table: 20 rows."""
    rows = [(t, i, name, page) for (t, i), (name, page) in EVENT_NAMES.items()]
    return spark.createDataFrame(rows, "event_type string, _slot long, event_name string, page_name string")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Names come from a broadcast lookup join rather than a CASE chain, so the
    # optimizer cannot inline a 20-branch expression into every later filter.
    events = read_table(spark, sf_dir, "events").withColumn("_slot", F.col("event_id") % 4)
    nation = _nation_names(read_table(spark, sf_dir, "nation"), "_nk", "_city")
    names = F.broadcast(_event_name_table(spark))
    e, u = F.col("event_id"), F.col("user_id")
    mapped = (
        events.join(names, ["event_type", "_slot"], "left")
        .withColumn("_nk", u % 4)
        .join(nation, "_nk", "left")
    )
    attrs = _user_attributes(u, F.col("_city"))
    return mapped.select(
        e.alias("event_id"),
        (u * SESSION_DAYS + F.datediff(F.to_date("ts"), F.lit(DAY_EPOCH).cast("date"))).cast("long").alias("session_id"),
        u.alias("user_id"),
        F.col("ts").alias("event_timestamp"),
        "event_name",
        "page_name",
        attrs["channel"].alias("channel"),
        attrs["campaign"].alias("campaign"),
        attrs["device"].alias("device"),
        attrs["city"].alias("city"),
        _voucher(u).alias("voucher_code"),
    )


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user and day: start = first event; attributes follow the user."""
    starts = raw_events(spark, sf_dir).groupBy("session_id").agg(F.min("event_timestamp").alias("session_start_at"))
    nation = _nation_names(read_table(spark, sf_dir, "nation"), "_nk", "_city")
    u = F.floor(F.col("session_id") / SESSION_DAYS).cast("long")
    with_user = starts.withColumn("user_id", u).withColumn("_nk", u % 4).join(nation, "_nk", "left")
    attrs = _user_attributes(F.col("user_id"), F.col("_city"))
    return with_user.select(
        "session_id",
        "user_id",
        attrs["channel"].alias("channel"),
        attrs["campaign"].alias("campaign"),
        attrs["device"].alias("device"),
        attrs["city"].alias("city"),
        "session_start_at",
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = _nation_names(read_table(spark, sf_dir, "nation"), "c_nationkey", "city")
    c = F.col("c_custkey")
    return customer.join(nation, "c_nationkey", "left").select(
        c.alias("customer_id"),
        "city",
        _plus_days(REGISTERED_EPOCH, (c * 37 % 365).cast("int")).alias("registered_at"),
        F.when(c % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.concat(F.lit("08"), F.lpad(c.cast("string"), 9, "0")).alias("phone_number"),
    )


def _rating(key: Column) -> Column:
    return F.lit(3.0) + (key % 21) / 10


def raw_restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    nation = _nation_names(read_table(spark, sf_dir, "nation"), "_nk", "city")
    p = F.col("p_partkey")
    return part.withColumn("_nk", p % 25).join(nation, "_nk", "left").select(
        p.alias("restaurant_id"),
        F.concat(F.col("p_name"), F.lit(" "), p.cast("string")).alias("restaurant_name"),
        F.col("p_type").alias("cuisine_type"),
        "city",
        F.when(F.col("p_size") % 3 == 0, F.lit("0")).otherwise(F.lit("1")).alias("is_partner"),
        _rating(p).alias("rating"),
    )


def raw_couriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    nation = _nation_names(read_table(spark, sf_dir, "nation"), "s_nationkey", "city")
    s = F.col("s_suppkey")
    return supplier.join(nation, "s_nationkey", "left").select(
        s.alias("courier_id"),
        "city",
        F.when(s % 10 <= 1, F.lit("bicycle")).when(s % 10 == 2, F.lit("car")).otherwise(F.lit("motorcycle")).alias("vehicle_type"),
        _plus_days(JOINED_EPOCH, (s * 53 % 700).cast("int")).alias("joined_at"),
        F.when(s % 5 == 0, F.lit("gold")).when(s % 5 <= 2, F.lit("bronze")).otherwise(F.lit("silver")).alias("courier_tier"),
        _rating(s).alias("rating"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per line that has a part; the line number repeats within an
    order, so items are numbered by the full line content after the join (within
    an order's line number, plus the order's earlier line numbers)."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    joined = lines.join(part, lines["l_partkey"] == part["p_partkey"], "inner")
    numbered = sequence_within(
        joined,
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        "_line_seq",
        F.col("l_linenumber"),
    )
    return numbered.select(
        (F.col("l_orderkey") * 1_000_000 + F.col("_line_seq")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("cuisine_type"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_quantity").alias("quantity"),
    )


@dataclass
class RawSources:
    """Lazy raw sources for one table folder."""

    spark: SparkSession
    sf_dir: str

    def orders(self) -> DataFrame:
        return raw_orders(self.spark, self.sf_dir)

    def events(self) -> DataFrame:
        return raw_events(self.spark, self.sf_dir)

    def sessions(self) -> DataFrame:
        return raw_sessions(self.spark, self.sf_dir)

    def users(self) -> DataFrame:
        return raw_users(self.spark, self.sf_dir)

    def restaurants(self) -> DataFrame:
        return raw_restaurants(self.spark, self.sf_dir)

    def couriers(self) -> DataFrame:
        return raw_couriers(self.spark, self.sf_dir)

    def order_items(self) -> DataFrame:
        return raw_order_items(self.spark, self.sf_dir)

    def exchange_rates_usd(self) -> DataFrame:
        return exchange_rates_usd(self.spark)
