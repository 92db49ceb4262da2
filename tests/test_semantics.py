from datetime import datetime

from pyspark.sql import functions as F

from tiffin.functions import minutes_between, safe_divide, strict_greatest


def test_safe_divide_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (3, 4), (None, 2), (2, None)], "a int, b int")
    got = [r[0] for r in df.select(safe_divide("a", "b")).collect()]
    assert got == [None, 0.75, None, None]


def test_strict_greatest_propagates_null(spark):
    df = spark.createDataFrame([(1, 5, 3), (1, None, 3)], "a int, b int, c int")
    got = [r[0] for r in df.select(strict_greatest("a", "b", "c")).collect()]
    assert got == [5, None]
    # Spark's own greatest skips NULL: the helper exists because of this.
    assert df.select(F.greatest("a", "b", "c")).collect()[1][0] == 3


def test_minutes_truncate(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 30, 59), datetime(2024, 1, 1, 1, 15, 0)),
         (datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 59))],
        "s timestamp_ntz, e timestamp_ntz",
    )
    assert [r[0] for r in df.select(minutes_between("s", "e")).collect()] == [44, 0]
