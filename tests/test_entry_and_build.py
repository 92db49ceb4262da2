import os
import tempfile

from helpers import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tiffin.plans import marts as mt
from tiffin.plans.models import STAGING, Models, build
from tiffin.sources.fixtures import RawSources
from tiffin.sources.schemas import RAW_COLUMNS
from tiffin.sources.sinks import MART_LAYOUT
from tiffin.sources.seeds import exchange_rates_usd, read_seed_csv
from tiffin.plans import staging as st


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["channel", "campaign", "voucher_code"] and len(df.columns) == 29


MARTS = set(MART_LAYOUT)


def test_build_writes_named_marts_and_views(spark):
    out = tempfile.mkdtemp(prefix="tiffin-build-")
    timings = {}
    paths = build(Models(RawSources(spark, SF_SMALL)), out, timings)
    assert set(timings) == set(paths) == MARTS | {"stg_orders", "customer_context"}
    assert {r.tableName for r in spark.sql("SHOW TABLES IN marts").collect() if not r.isTemporary} == MARTS
    assert any(p.startswith("order_date=") for p in os.listdir(paths["fact_orders"]))
    fo = spark.table("marts.fact_orders")
    assert fo.count() == 1500
    # a date filter prunes partitions
    plan = fo.filter(F.col("order_date") == "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    for name in STAGING:
        assert spark.catalog.listTables("marts") and spark.table(name).count() > 0
    assert spark.table("stg_orders").count() == 1500
    again = build(Models(RawSources(spark, SF_SMALL)), tempfile.mkdtemp(prefix="tiffin-build-"))
    assert spark.table("marts.fact_orders").count() == 1500 and again != paths


def test_read_seed_csv_crlf(spark, tmp_path):
    p = tmp_path / "fx.csv"
    p.write_bytes(b"month,year,period,lcy,usd_to_lcy,lcy_to_usd,source\r\n1,2024,2024-01,'IDR',15610.1,6.406e-05,x-rates.com\r\n")
    df = st.stg_exchange_rates(read_seed_csv(spark, str(p), "exchange_rates_usd"))
    r = df.collect()[0]
    assert r.source == "x-rates.com" and r.lcy == "'IDR'" and r.month == 1 and r.lcy_to_usd == 6.406e-05
    assert df.columns == RAW_COLUMNS["exchange_rates_usd"]


def test_fixed_fx_seed(spark):
    fx = st.stg_exchange_rates(exchange_rates_usd(spark))
    assert fx.count() == 6 and [r.period for r in fx.orderBy("period").collect()][-1] == "2024-06"


def test_models_from_stored_tables_and_seed_csvs(spark, tmp_path):
    """Write the raw sources as a lake would hold them (Parquet tables, CSV
    seeds with CRLF), read them back with SourceTables, and get the same marts."""
    from tiffin.sources.tables import SourceTables

    fixture = RawSources(spark, SF_SMALL)
    lake, seeds = tmp_path / "raw", tmp_path / "seeds"
    for name in ("orders", "events", "sessions", "users", "order_items"):
        getattr(fixture, name)().write.parquet(str(lake / name))
    seeds.mkdir()
    for name in ("couriers", "restaurants", "exchange_rates_usd"):
        pdf = getattr(fixture, name)().toPandas()
        (seeds / f"{name}.csv").write_bytes(pdf.to_csv(index=False, lineterminator="\r\n").encode())
    from_lake = Models(SourceTables(spark, str(lake), seeds_dir=str(seeds)))
    from_fixture = Models(fixture)
    for name in ("fact_orders", "dim_couriers", "fact_channel_performance", "stg_restaurants"):
        a, b = getattr(from_lake, name)(), getattr(from_fixture, name)()
        assert a.dtypes == b.dtypes, name  # names and types (Parquet reads every column as nullable)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_wide_tables_have_no_single_partition_exchange(spark):
    """SURVEY §7.2 step 8: as the build computes them (reading the written
    lower levels), no wide table funnels its rows through one partition."""
    out = tempfile.mkdtemp(prefix="tiffin-sp-")
    build(Models(RawSources(spark, SF_SMALL)), out)
    for name in ("fact_user_metrics", "fact_orders", "fact_delivery", "stg_orders"):
        m = Models(RawSources(spark, SF_SMALL))
        for dep in ("stg_orders", "customer_context"):
            if dep != name:
                m.overrides[dep] = spark.read.parquet(f"{out}/{dep}")
        df = getattr(m, name)()
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange SinglePartition" not in plan, name


def test_fact_delivery_has_three_wide_joins(spark):
    m = Models(RawSources(spark, SF_SMALL))
    frames = [m.stg_orders(), m.stg_restaurants(), m.stg_couriers(), m.customer_context()]
    out = tempfile.mkdtemp(prefix="tiffin-fd-")
    for i, df in enumerate(frames):
        df.write.parquet(f"{out}/{i}")
    stored = [spark.read.parquet(f"{out}/{i}") for i in range(4)]
    plan = mt.fact_delivery(*stored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3 and plan.count("Join FullOuter") == 2


def test_day_partitioned_sink_rebalances_on_the_date(spark):
    from tiffin.sources.sinks import write_table

    df = Models(RawSources(spark, SF_SMALL)).stg_orders()
    out = tempfile.mkdtemp(prefix="tiffin-sink-")
    write_table(df, out, "order_date", ("channel", "city"))
    # the writer plan: a rebalance exchange on the date, then a sort on (date, cluster keys)
    planned = df.hint("rebalance", F.col("order_date")).sortWithinPartitions("order_date", "channel", "city")
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert spark.read.parquet(out).count() == 1500
