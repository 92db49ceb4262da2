"""Z-ordered tables with bloom filters, and distinct counts merged from day-level state."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from helpers import SF_SMALL
from tiffin.operators import distinct as ds
from tiffin.operators import funnel as fn
from tiffin.sources import sinks

IDS = ("restaurant_id", "courier_id", "customer_id")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def groups_holding(path, column, value):
    """Row groups whose statistics allow ``value``, and all row groups."""
    import glob

    import pyarrow.parquet as pq

    kept = total = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(name).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            kept += stats.min <= value <= stats.max
            total += 1
    return kept, total


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def deliveries(spark):
    ids = [(F.abs(F.xxhash64("id", F.lit(i))) % 5000).alias(c) for i, c in enumerate(IDS)]
    return spark.range(0, 200_000, 1, 1).select(F.lit(date(2024, 3, 1)).alias("order_date"), *ids, F.col("id").alias("order_id"))


def test_z_order_prunes_for_each_id(spark, deliveries, tmp_path):
    small = {"parquet.block.size": str(64 * 1024), "parquet.page.row.count.limit": "2000"}
    plain, curve = f"{tmp_path}/plain", f"{tmp_path}/curve"
    for path, cuts in ((plain, None), (curve, sinks.z_cuts(deliveries, IDS))):
        laid = sinks._laid_out(deliveries, "order_date", IDS, cuts)
        laid.write.options(**small).partitionBy("order_date").parquet(path)
    assert same(spark.read.parquet(plain), spark.read.parquet(curve))
    share = {}
    for path in (plain, curve):
        for c in IDS:
            kept, total = groups_holding(path, c, 2500)
            share[path, c] = kept / total
            assert total > 20
    assert share[plain, "courier_id"] > 0.9 and share[plain, "customer_id"] > 0.9
    assert all(share[curve, c] < 0.6 for c in IDS)


def test_bloom_filters_skip_row_groups_that_lack_an_id(spark, tmp_path):
    # even numbers in no order: statistics allow any odd one, only the bloom filter knows that it isn't there
    df = spark.range(0, 400_000, 1, 1).select((F.abs(F.xxhash64("id") % (5 * 10**11)) * 2).alias("courier_id"))
    options = {"parquet.enable.dictionary": "false"}
    with_filter, without = f"{tmp_path}/with", f"{tmp_path}/without"
    sinks._bloom_filters(df.write.options(**options), ["courier_id"]).parquet(with_filter)
    df.write.options(**options).parquet(without)
    absent = F.col("courier_id") == 500_000_000_001
    read = {p: scanned_rows(spark.read.parquet(p).filter(absent)) for p in (with_filter, without)}
    assert read[with_filter] == 0 and read[without] > 0
    some = df.first()[0]
    assert spark.read.parquet(with_filter).filter(F.col("courier_id") == some).count() >= 1


def test_z_order_of_nulls_one_value_and_no_rows(spark, tmp_path):
    rows = [(date(2024, 1, 1), None, 5, i) for i in range(50)] + [(date(2024, 1, 2), i, 5, None) for i in range(50)]
    df = spark.createDataFrame(rows, "order_date date, a long, b long, c long")
    for n, part in enumerate((df, df.limit(0))):
        path = f"{tmp_path}/t{n}"
        sinks.write_table(part, path, "order_date", ("a", "b", "c"), cuts=sinks.z_cuts(part, ["a", "b", "c"]))
        assert same(spark.read.schema(df.schema).parquet(path).select(df.columns), part)


# ---------------------------------------------------------------- distinct counts

def test_days_merge_to_the_counts_of_all(spark):
    rng = random.Random(11)
    start = date(2024, 1, 1)
    hot = [(start + timedelta(days=rng.randrange(5)), "hot", rng.randrange(3000)) for _ in range(4000)]
    odd = [None, 0, -1, -40_000, 32_767, 32_768, 32_769, 2**40, 2**62]
    rest = [(start + timedelta(days=rng.randrange(5)), rng.choice(["a", "b", None]), rng.choice(odd)) for _ in range(300)]
    df = spark.createDataFrame([*hot, *rest, (start, "only null", None)], "day date, k string, id long")
    state = ds.day_state(df, "day", ["k"], "id")
    want = df.groupBy("k").agg(F.count_distinct("id").alias("n"))
    assert same(ds.merged_counts(state, ["k"], "n"), want)
    few = state.filter(F.col("day") < start + timedelta(days=2))
    assert same(ds.merged_counts(few, ["k"], "n"), df.filter(F.col("day") < start + timedelta(days=2)).groupBy("k").agg(F.count_distinct("id").alias("n")))
    assert ds.merged_counts(state, [], "n").first()["n"] == df.select("id").dropna().distinct().count()
    assert ds.merged_counts(ds.day_state(df.limit(0), "day", ["k"], "id"), ["k"], "n").count() == 0


def test_late_events_rebuild_the_state_of_their_day(spark, tmp_path):
    events = entry._events(spark, SF_SMALL)
    path = f"{tmp_path}/checkout_days"
    late_day = events.filter("funnel_stage = 'CHECKOUT'").agg(F.max("event_date")).first()[0]
    early = events.filter(~((F.col("event_date") == late_day) & (F.col("session_id") % 2 == 0)))
    sinks.write_table(fn.checkout_days(early), path, "event_date")
    assert not same(fn.checkout_counts_of(spark.read.parquet(path)), fn.op_checkout_counts(events))
    sinks.overwrite_days(fn.checkout_days(events.filter(F.col("event_date") == late_day)), path, "event_date")
    assert same(fn.checkout_counts_of(spark.read.parquet(path)), fn.op_checkout_counts(events))


def state_of_strewn_ids(spark):
    """Couriers' and restaurants' state of 4,000 orders, hardly two of them of one party and day, by customers far apart."""
    from tiffin.operators import scorecards as sc

    k = F.col("id")
    day = F.date_add(F.lit(date(2024, 1, 1)), (k % 40).cast("int"))
    orders = spark.range(4000).select(day.alias("order_date"), (k % 501).alias("courier_id"), (k % 1999).alias("restaurant_id"), (k * 7919 % 900_001).alias("customer_id"))
    return orders, sc.courier_customer_days(orders), sc.restaurant_customer_days(orders)


def sizes(state):
    """Bytes of the widest and of all rows of a state, from what Spark's own row format takes (8 bytes a value, and what has no fixed width)."""
    width = [F.length(c) if kind == "binary" else F.lit(8) for c, kind in state.dtypes]
    return state.select(sum(width).alias("w")).agg(F.max("w"), F.sum("w")).first()


def test_couriers_state_is_as_large_as_its_ids(spark):
    orders, couriers, _ = state_of_strewn_ids(spark)
    widest, total = sizes(couriers)
    assert widest <= 64 and total <= 64 * orders.count()
    want = orders.groupBy("courier_id").agg(F.count_distinct("customer_id").alias("n"))
    merged = ds.merged_counts(couriers, ["courier_id"], "n")
    assert same(merged, want)
    # longs alone, in hash aggregates: a sort of every group's bitmap filled a task's memory
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged._jdf.queryExecution().executedPlan().toString().count("HashAggregate") >= 4


def test_restaurants_state_is_as_large_as_its_ids(spark):
    orders, _, restaurants = state_of_strewn_ids(spark)
    widest, total = sizes(restaurants)
    assert widest <= 64 and total <= 64 * orders.count()
    merged = ds.merged_counts(restaurants, ["restaurant_id"], "n")
    assert same(merged, orders.groupBy("restaurant_id").agg(F.count_distinct("customer_id").alias("n")))
    dense = ds.day_state(orders.withColumn("customer_id", F.col("customer_id") % 640), "order_date", [], "customer_id")
    assert dense.count() <= 40 * 10  # ids in sequence share bitmaps
