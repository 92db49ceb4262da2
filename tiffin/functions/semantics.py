"""Column helpers that reproduce the warehouse dialect the models were written in.

Spark's defaults differ from it in a few places; every helper here is one such
difference, expressed with built-in JVM functions so it stays inside codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Double division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def strict_greatest(*cols: ColumnOrName) -> Column:
    """GREATEST that is NULL when any argument is NULL (Spark's skips NULLs)."""
    columns = [col(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*columns))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole minutes from start to end, truncated toward zero."""
    return F.timestamp_diff("MINUTE", col(start), col(end))


def nullif_empty(c: ColumnOrName) -> Column:
    return F.nullif(col(c), F.lit(""))


def utc_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a zone-less timestamp in UTC, whatever the session time zone.

    Text is cast (``''`` is null), zone-less timestamps and dates stay as they are, and a
    zoned timestamp becomes its instant's wall clock in UTC.
    """
    kind = df.schema[name].dataType.typeName()
    if kind == "string":
        return nullif_empty(name).cast("timestamp_ntz").alias(name)
    if kind == "timestamp":
        return F.timestamp_add("MICROSECOND", F.unix_micros(name), ts_literal("1970-01-01 00:00:00")).alias(name)
    return F.col(name).cast("timestamp_ntz").alias(name)


def is_weekend_day(ts: ColumnOrName) -> Column:
    """Sunday (1) or Saturday (7)."""
    return F.dayofweek(col(ts)).isin(1, 7)


def as_long(c: ColumnOrName) -> Column:
    return col(c).cast("long")


def count_true(cond: Column) -> Column:
    """COUNTIF: rows where cond is TRUE (NULL counts as not true)."""
    return F.count_if(cond)


def year_month(d: ColumnOrName) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def ts_literal(text: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")
