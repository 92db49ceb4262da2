"""Plans of the order facts and the channel mart, table replacement, rebuilt days, seeds by header, checks of a build."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tiffin.operators import checks as ck
from tiffin.operators import funnel as fn
from tiffin.operators import ranking as rk
from tiffin.plans import staging as st
from tiffin.plans.models import Models, build, refresh_funnel
from tiffin.sources import sinks
from tiffin.sources.fixtures import RawSources
from tiffin.sources.seeds import read_seed_csv, rejected_seed_rows


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def exchanges(df):
    """(partitioning, output columns) of each planned shuffle."""
    found, waiting = [], [df._jdf.queryExecution().sparkPlan()]
    planned = df._jdf.queryExecution().executedPlan()
    waiting = [planned.initialPlan() if hasattr(planned, "initialPlan") else planned]
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "Exchange":
            found.append((node.outputPartitioning().toString(), node.output().toString()))
        waiting += [node.children().apply(i) for i in range(node.children().size())]
    return found


# ---------------------------------------------------------------- first orders

def test_first_orders_equal_numbered_orders(spark):
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    rows = [
        (rng.choice([None, 0, 0, 0, *range(9)]), rng.choice([None, *[base + timedelta(hours=h) for h in range(5)]]), i,
         rng.choice([None, "push", "organic"]), rng.choice([None, "C1"]), rng.choice([None, "V1", "V2"]))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "customer_id long, placed_at timestamp_ntz, order_id long, channel string, campaign string, voucher_code string")
    w = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    first = df.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    want = first.groupBy(*fn._channel_keys()).agg(F.count(F.lit(1)).alias("first_orders"))
    assert same(fn.first_orders(df), want)
    assert fn.first_orders(df.limit(0)).count() == 0


@pytest.mark.parametrize("key", ["fact_channel_performance", "op_channel_order_agg"])
def test_channel_performance_numbers_no_order(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    assert "row_number" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert all("food_ready_at" not in out for _, out in exchanges(df))


# ---------------------------------------------------------------- one wide shuffle

@pytest.mark.parametrize("name", ["fact_orders", "fact_user_metrics"])
def test_number_and_context_come_in_one_shuffle(spark, tmp_path, name):
    raw = RawSources(spark, SF_SMALL)
    models = Models(raw)
    for table in ("customer_context", "stg_restaurants", "stg_couriers"):
        getattr(models, table)().write.parquet(str(tmp_path / table))
        models.overrides[table] = spark.read.parquet(str(tmp_path / table))
    raw.orders().write.parquet(str(tmp_path / "orders"))

    class Stored:
        def __init__(self):
            self.spark = spark

        def orders(self):
            return spark.read.parquet(str(tmp_path / "orders"))

        exchange_rates_usd = raw.exchange_rates_usd

    got = getattr(Models(Stored(), dict(models.overrides)), name)()
    assert same(got, getattr(Models(raw, {"stg_orders": st.stg_orders(raw.orders())}), name)())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        planned = getattr(Models(Stored(), dict(models.overrides)), name)()
        wide = [part for part, out in exchanges(planned) if "discount_amount" in out]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_customer = [p for p in wide if "_g0" in p or "customer_id" in p]
    assert len(by_customer) == 1 and "_bucket1" in by_customer[0]


def test_hot_customer_hour_is_numbered_over_its_seconds(spark):
    n = 4000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("customer_id"),
        (F.lit("2024-01-01 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 37 % 3600) + F.lit(0.25))).alias("placed_at"),
        F.col("id").alias("order_id"),
    )
    from tiffin.operators import orders as od

    w = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    got = od.op_order_sequence(df).select("order_id", "user_order_number")
    assert same(got, df.select("order_id", F.row_number().over(w).cast("long").alias("user_order_number")))
    second = F.floor(F.unix_seconds(F.col("placed_at").cast("timestamp")))
    most = df.groupBy("customer_id", second).count().agg(F.max("count")).first()[0]
    assert most < n / 100  # the most that one task's group numbers


def test_nested_buckets_equal_row_number(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 11 != 0, F.col("id") * 13 % 101 - 20).alias("v"), "id")
    got = rk.sequence_within(df, ["g"], ["v", "id"], "n", F.floor(F.col("v") / 50), F.floor(F.col("v") / 10), F.floor(F.col("v") / 2))
    assert same(got, df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("long")))


# ---------------------------------------------------------------- sinks

def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS sink_test")
    rows = spark.range(10).withColumn("day", F.lit("2024-01-01").cast("date"))
    first = sinks.write_named_table(rows, "sink_test.t", str(tmp_path / "t"), "day")
    broken = rows.withColumn("x", F.expr("if(id = 7, raise_error('task fails'), id)"))
    with pytest.raises(Exception, match="task fails"):
        sinks.write_named_table(broken, "sink_test.t", str(tmp_path / "t"), "day")
    assert spark.table("sink_test.t").columns == ["id", "day"] and spark.table("sink_test.t").count() == 10
    second = sinks.write_named_table(rows.filter("id < 4").withColumn("y", F.lit(1)), "sink_test.t", str(tmp_path / "t"), "day")
    assert spark.table("sink_test.t").count() == 4 and "y" in spark.table("sink_test.t").columns
    assert [t.name for t in spark.catalog.listTables("sink_test") if not t.isTemporary] == ["t"]
    assert first != second and spark.read.parquet(first).count() == 10  # for readers that began before
    spark.sql("DROP TABLE sink_test.t")


def test_late_events_rebuild_their_days_alone(spark, tmp_path):
    events = Models(RawSources(spark, SF_SMALL)).stg_events()
    late = F.col("event_id") % 9 == 0
    days = [r.event_date for r in events.select("event_date").distinct().orderBy("event_date").collect()]
    touched = days[2:5]
    early = events.filter(~(late & F.col("event_date").isin(touched)))
    path = str(tmp_path / "funnel")
    sinks.write_table(Models(None, {"stg_events": early}).fact_funnel(), path, *sinks.MART_LAYOUT["fact_funnel"])
    before = {p: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "funnel").glob("session_date=*")}
    refresh_funnel(Models(None, {"stg_events": events}), path, touched)
    full = Models(None, {"stg_events": events}).fact_funnel()
    assert same(spark.read.parquet(path).select(*full.columns), full)
    changed = {p.name for p, files in before.items() if sorted(f.name for f in p.iterdir()) != files}
    assert changed == {f"session_date={d}" for d in touched}


# ---------------------------------------------------------------- seeds

def test_seed_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "couriers.csv"
    path.write_text("rating,vehicle_type,city,courier_id,extra,joined_at,courier_tier\n4.5,bicycle,Jakarta,1,x,2024-01-01,gold\n")
    row = read_seed_csv(spark, str(path), "couriers").first()
    assert (row.courier_id, row.city, row.vehicle_type, row.courier_tier) == ("1", "Jakarta", "bicycle", "gold")
    assert st.stg_couriers(read_seed_csv(spark, str(path), "couriers")).first().courier_id == 1


@pytest.mark.parametrize("header,named", [("courier_id,city,joined_at,courier_tier,rating", "vehicle_type"), ("courier_id,city,city,vehicle_type,joined_at,courier_tier,rating", "city")])
def test_a_wrong_header_fails_by_name(spark, tmp_path, header, named):
    path = tmp_path / "couriers.csv"
    path.write_text(header + "\n1,2,3,4,5\n")
    with pytest.raises(ValueError, match=named):
        read_seed_csv(spark, str(path), "couriers")


def test_short_and_long_seed_rows_are_reported(spark, tmp_path):
    path = tmp_path / "couriers.csv"
    lines = ["1,Jakarta,bicycle,2024-01-01,gold,4.5", "2,Bandung,car", "3,Medan,car,2024-01-01,gold,4.5,more", '4,"Kota, Baru",car,2024-01-01,gold,']
    path.write_bytes(("courier_id,city,vehicle_type,joined_at,courier_tier,rating\r\n" + "\r\n".join(lines) + "\r\n").encode())
    good = read_seed_csv(spark, str(path), "couriers")
    assert [(r.courier_id, r.city, r.rating) for r in good.collect()] == [("1", "Jakarta", "4.5"), ("4", "Kota, Baru", None)]
    assert good.count() == 2
    assert [r.line for r in rejected_seed_rows(spark, str(path), "couriers").collect()] == lines[1:3]


# ---------------------------------------------------------------- checks of a build

def test_a_build_counts_on_the_way_and_checks_what_it_wrote(spark, tmp_path):
    metrics = {}
    models = Models(RawSources(spark, SF_SMALL))
    paths = build(models, str(tmp_path / "out"), metrics=metrics)
    assert metrics["fact_orders"] == {"rows": 1500, "missing_keys": 0}
    found = ck.check_sla_consistency(models.stg_orders()).groupBy("failure_type").count().collect()
    assert {r.failure_type: r["count"] for r in found} == {
        k.removeprefix("sla_"): v for k, v in metrics["stg_orders"].items() if k.startswith("sla_") and v
    }
    tables = {name: spark.read.parquet(paths[name]) for name in ck.MART_KEYS}
    report = ck.check_written(tables, metrics)
    assert report.count() == 0
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(tables) and "Join" not in plan

    planted = tables["fact_orders"].limit(5).union(tables["fact_orders"].limit(2).withColumn("order_id", F.lit(None).cast("long")))
    planted = planted.union(planted.filter("order_id is not null").limit(1))
    mine = {"fact_orders": planted}
    got = ck.check_written(mine, {"fact_orders": {"missing_keys": 2}})
    keyed = {"fact_orders": (planted, ["order_id"])}
    assert same(got, ck.check_unique(keyed).unionByName(ck.check_not_null(keyed)))
