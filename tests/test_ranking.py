import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tiffin.operators import customers as cu
from tiffin.operators import ranking as rk


def _skewed(spark, n=6000):
    # customer 0 holds 40% of rows; placed_at has many ties; a NULL customer group and NULL times too
    df = spark.range(0, n).select(
        F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(F.col("id") % 97).cast("long").alias("customer_id"),
        F.when(F.col("id") % 41 != 0, F.col("id") % 17 - 5).alias("placed_at"),
        F.col("id").alias("order_id"),
    )
    nulls = spark.createDataFrame([(None, 3, n + 1), (None, 1, n + 2)], "customer_id long, placed_at long, order_id long")
    return df.unionByName(nulls)


def _same(got, want):
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _numbered(df, width=4):
    return rk.sequence_within(df, ["customer_id"], ["placed_at", "order_id"], "seq", F.floor(F.col("placed_at") / width))


def _builtin(df):
    w = Window.partitionBy("customer_id").orderBy("placed_at", "order_id")
    return df.withColumn("seq", F.row_number().over(w).cast("long"))


def test_sequence_within_equals_row_number_under_skew(spark):
    df = _skewed(spark)
    assert _same(_numbered(df), _builtin(df))
    assert _same(_numbered(df, 1), _builtin(df))
    assert _same(_numbered(df, 1000), _builtin(df))


def test_hot_null_group_beside_group_zero(spark):
    df = _skewed(spark).withColumn("customer_id", F.when(F.col("customer_id") != 3, F.col("customer_id")))
    assert _same(_numbered(df), _builtin(df))


def test_sequence_shuffles_the_rows_once(spark):
    df = _skewed(spark).repartition(4).withColumn("wide", F.lit("x"))
    plan = _numbered(df)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 4  # the rows once; the counts by bucket, by group for the running sum, and back


def test_empty(spark):
    df = _skewed(spark).limit(0)
    assert _numbered(df).count() == 0


def _scores(df):
    got = df.withColumn("m", cu.m_score(df.select("v"), "v"))
    pct = F.percent_rank().over(Window.orderBy("v"))
    want = df.withColumn("m", F.when(pct >= 0.70, 3).when(pct >= 0.30, 2).otherwise(1).cast("long"))
    return got, want


def test_cuts_give_the_scores_of_the_builtin_rank(spark):
    rng = random.Random(7)
    for values in (
        [float(rng.randint(0, 50)) for _ in range(500)],
        [rng.uniform(-1e3, 1e9) for _ in range(300)],
        [0.0] * 400 + [float(i) for i in range(100)],
        [float(i) for i in range(11)],
        [5.0] * 10,
        [3.0],
        [-1.5, 0.0, 1.5],
    ):
        df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
        got, want = _scores(df)
        assert _same(got, want), values[:5]


def test_cuts_rank_within_buckets(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    plan = df.withColumn("m", cu.m_score(df, "v"))._jdf.queryExecution().executedPlan().toString()
    assert "percent_rank" not in plan
