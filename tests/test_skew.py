"""End to end with a planted hot key: one customer holds a third of all orders."""

from helpers import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from tiffin.plans import marts as mt
from tiffin.plans import staging as st
from tiffin.sources.fixtures import RawSources


def _hot_orders(spark):
    raw = RawSources(spark, SF_SMALL).orders()
    return raw.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(7)).otherwise(F.col("customer_id")))


def test_hot_customer_is_numbered_exactly(spark):
    raw = _hot_orders(spark)
    got = st.stg_orders(raw).select("order_id", "user_order_number")
    w = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    want = st.typed_orders(raw).select("order_id", F.row_number().over(w).cast("long").alias("user_order_number"))
    assert got.count() == 1500
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_customer_marts_keep_grain(spark):
    raw = _hot_orders(spark)
    users = st.stg_users(RawSources(spark, SF_SMALL).users())
    dim = mt.dim_users(mt.customer_context(users, st.enriched_orders(raw)))
    assert dim.count() == 150 and dim.select("customer_id").distinct().count() == 150
    hot = dim.filter("customer_id = 7").collect()[0]
    assert hot.f_score == 3 and hot.r_score == 3
