"""Raw sources read from stored tables: the production input of ``Models``.

``SourceTables`` has the same methods as the fixture's ``RawSources``, so
``Models(SourceTables(spark, "/lake/raw", seeds_dir="/lake/seeds"))`` builds
every model from real data. Event-style sources are read as stored tables
(Parquet by default, any format Spark reads); the three seeds (couriers,
restaurants, monthly FX) are CSV files with a header, as shipped with the
models. Staging casts every column, so text or typed columns both work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tiffin.sources.schemas import RAW_COLUMNS
from tiffin.sources.seeds import read_seed_csv

SEEDS = ("couriers", "restaurants", "exchange_rates_usd")


@dataclass
class SourceTables:
    spark: SparkSession
    base_path: str
    fmt: str = "parquet"
    seeds_dir: str | None = None
    options: dict | None = None

    def _table(self, name: str) -> DataFrame:
        if name in SEEDS and self.seeds_dir:
            return read_seed_csv(self.spark, f"{self.seeds_dir.rstrip('/')}/{name}.csv", name)
        reader = self.spark.read.format(self.fmt).options(**(self.options or {}))
        if self.fmt == "csv":
            reader = reader.option("header", True)
        return reader.load(f"{self.base_path.rstrip('/')}/{name}").select(*RAW_COLUMNS[name])

    def orders(self) -> DataFrame:
        return self._table("orders")

    def events(self) -> DataFrame:
        return self._table("events")

    def sessions(self) -> DataFrame:
        return self._table("sessions")

    def users(self) -> DataFrame:
        return self._table("users")

    def restaurants(self) -> DataFrame:
        return self._table("restaurants")

    def couriers(self) -> DataFrame:
        return self._table("couriers")

    def order_items(self) -> DataFrame:
        return self._table("order_items")

    def exchange_rates_usd(self) -> DataFrame:
        return self._table("exchange_rates_usd")
