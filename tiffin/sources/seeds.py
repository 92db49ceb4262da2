"""Seed tables: CSV readers and the fixed monthly FX table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tiffin.sources.schemas import RAW_COLUMNS


_CORRUPT = "_corrupt_record"


def _seed_rows(spark: SparkSession, path: str, source: str) -> DataFrame:
    """All rows as text under their header's names, and ``_corrupt_record`` with the line of a row that is too short or too long.

    The header decides where a column is; a header that lacks one, or has one twice, fails by name.
    """
    header = [c.strip() for c in spark.read.option("header", False).csv(path).first() or []]
    wanted = RAW_COLUMNS[source]
    missing, twice = [c for c in wanted if c not in header], sorted({c for c in header if header.count(c) > 1})
    if missing or twice:
        raise ValueError(f"seed {source} ({path}): header lacks {missing}, has twice {twice}")
    schema = StructType([StructField(c, StringType()) for c in [*header, _CORRUPT]])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    # Always true, but it keeps every column in the scan: Spark judges a row's length by what it parses.
    return reader.schema(schema).csv(path).filter(F.length(F.concat_ws("", *header)) >= 0)


def read_seed_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Read a seed CSV with a header row as text columns, in the source's order whatever the file's.

    Columns are found by their header's names; others than the source's are ignored, and rows of another
    length than the header go to :func:`rejected_seed_rows`. The default line separator handles CRLF files (a
    trailing CR is not kept in the last column); staging casts the text to the model types.
    """
    return _seed_rows(spark, path, source).filter(F.col(_CORRUPT).isNull()).select(*RAW_COLUMNS[source])


def rejected_seed_rows(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(source, line) of the rows that :func:`read_seed_csv` leaves out: every row is in one of the two."""
    rows = _seed_rows(spark, path, source).filter(F.col(_CORRUPT).isNotNull())
    return rows.select(F.lit(source).alias("source"), F.col(_CORRUPT).alias("line"))


# The monthly USD exchange-rate seed (month, year, period, lcy,
# usd_to_lcy, lcy_to_usd, source). The currency code keeps its literal quotes.
EXCHANGE_RATES_USD = [
    (1, 2024, "2024-01", "'IDR'", 15610.1, 6.406e-05, "x-rates.com"),
    (2, 2024, "2024-02", "'IDR'", 15660.49, 6.385e-05, "x-rates.com"),
    (3, 2024, "2024-03", "'IDR'", 15709.51, 6.366e-05, "x-rates.com"),
    (4, 2024, "2024-04", "'IDR'", 16079.94, 6.219e-05, "x-rates.com"),
    (5, 2024, "2024-05", "'IDR'", 16069.31, 6.223e-05, "x-rates.com"),
    (6, 2024, "2024-06", "'IDR'", 16351.01, 6.116e-05, "x-rates.com"),
]

_FX_SCHEMA = StructType(
    [
        StructField("month", LongType()),
        StructField("year", LongType()),
        StructField("period", StringType()),
        StructField("lcy", StringType()),
        StructField("usd_to_lcy", DoubleType()),
        StructField("lcy_to_usd", DoubleType()),
        StructField("source", StringType()),
    ]
)


def exchange_rates_usd(spark: SparkSession) -> DataFrame:
    """The FX seed: one row per month, so its size is bounded by the calendar."""
    return spark.createDataFrame(EXCHANGE_RATES_USD, _FX_SCHEMA)
