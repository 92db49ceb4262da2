"""All models over one set of raw sources, built lazily.

``Models(raw)`` exposes each staging model and mart as a method returning a
lazy DataFrame; nothing runs until an action. ``build`` registers the staging
models as views, writes stg_orders (which several marts read) and the customer
context, and writes the marts as tables, level by level; a written table is the
lineage cut between levels.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tiffin.operators import checks as ck
from tiffin.plans import marts as mt
from tiffin.plans import staging as st
from tiffin.sources.fixtures import RawSources
from tiffin.sources.sinks import (
    MART_LAYOUT,
    SCHEMA,
    Z_ORDERED,
    overwrite_days,
    register_view,
    write_named_table,
    write_table,
    z_cuts,
)
from tiffin.sources.tables import SourceTables


@dataclass
class Models:
    raw: RawSources | SourceTables  # any object with one method per raw source
    overrides: dict[str, DataFrame] = field(default_factory=dict)

    def _get(self, name: str, make) -> DataFrame:
        if name not in self.overrides:
            self.overrides[name] = make()
        return self.overrides[name]

    # staging
    def stg_orders(self) -> DataFrame:
        return self._get("stg_orders", lambda: st.stg_orders(self.raw.orders()))

    def enriched_orders(self) -> DataFrame:
        """stg_orders for models that don't read the customer's order number."""
        if "stg_orders" in self.overrides:
            return self.overrides["stg_orders"]
        return self._get("enriched_orders", lambda: st.enriched_orders(self.raw.orders()))

    def stg_events(self) -> DataFrame:
        return self._get("stg_events", lambda: st.stg_events(self.raw.events()))

    def stg_sessions(self) -> DataFrame:
        return self._get("stg_sessions", lambda: st.stg_sessions(self.raw.sessions()))

    def stg_users(self) -> DataFrame:
        return self._get("stg_users", lambda: st.stg_users(self.raw.users()))

    def stg_restaurants(self) -> DataFrame:
        return self._get("stg_restaurants", lambda: st.stg_restaurants(self.raw.restaurants()))

    def stg_couriers(self) -> DataFrame:
        return self._get("stg_couriers", lambda: st.stg_couriers(self.raw.couriers()))

    def stg_order_items(self) -> DataFrame:
        return self._get("stg_order_items", lambda: st.stg_order_items(self.raw.order_items()))

    def stg_exchange_rates(self) -> DataFrame:
        return self._get("stg_exchange_rates", lambda: st.stg_exchange_rates(self.raw.exchange_rates_usd()))

    # customers, once for all marts
    def customer_context(self) -> DataFrame:
        return self._get("customer_context", lambda: mt.customer_context(self.stg_users(), self.enriched_orders()))

    # marts
    def dim_users(self) -> DataFrame:
        return self._get("dim_users", lambda: mt.dim_users(self.customer_context()))

    def dim_restaurants(self) -> DataFrame:
        return self._get("dim_restaurants", lambda: mt.dim_restaurants(self.stg_restaurants(), self.enriched_orders()))

    def dim_couriers(self) -> DataFrame:
        return self._get("dim_couriers", lambda: mt.dim_couriers(self.stg_couriers(), self.enriched_orders()))

    def fact_funnel(self) -> DataFrame:
        return self._get("fact_funnel", lambda: mt.fact_funnel(self.stg_events()))

    def _orders_in_context(self, columns: list[str]) -> tuple[DataFrame, DataFrame | None]:
        """stg_orders and the customer context to join; where stg_orders isn't stored, numbers and
        context reach the orders in one shuffle, and nothing is left to join."""
        if "stg_orders" in self.overrides:
            return self.stg_orders(), self.customer_context()
        return st.stg_orders(self.raw.orders(), self.customer_context().select(*columns)), None

    def fact_user_metrics(self) -> DataFrame:
        return self._get(
            "fact_user_metrics",
            lambda: mt.fact_user_metrics(*self._orders_in_context(mt.METRICS_CONTEXT), self.stg_exchange_rates()),
        )

    def fact_orders(self) -> DataFrame:
        def made() -> DataFrame:
            orders, context = self._orders_in_context(mt.TIER_COLUMNS)
            return mt.fact_orders(orders, self.stg_restaurants(), self.stg_couriers(), context)

        return self._get("fact_orders", made)

    def fact_delivery(self) -> DataFrame:
        return self._get(
            "fact_delivery",
            lambda: mt.fact_delivery(
                self.enriched_orders(), self.stg_restaurants(), self.stg_couriers(), self.customer_context()
            ),
        )

    def fact_channel_performance(self) -> DataFrame:
        return self._get(
            "fact_channel_performance",
            lambda: mt.fact_channel_performance(self.fact_funnel(), self.enriched_orders(), self.stg_events()),
        )


class AsWritten(Models):
    """The models with the SQL's fan-out, row for row: dim_users has a row for each delivered order, and
    what joins it multiplies. dim_users grows with the orders; the facts with the square of a customer's
    orders and more, so they are for tests on small inputs."""

    def dim_users(self) -> DataFrame:
        return self._get("dim_users", lambda: mt.dim_users_as_written(self.stg_users(), self.enriched_orders()))

    def fact_user_metrics(self) -> DataFrame:
        return self._get(
            "fact_user_metrics",
            lambda: mt.fact_user_metrics_as_written(self.stg_orders(), self.dim_users(), self.stg_exchange_rates()),
        )

    def fact_orders(self) -> DataFrame:
        return self._get(
            "fact_orders",
            lambda: mt.fact_orders_as_written(
                self.stg_orders(), self.stg_restaurants(), self.stg_couriers(), self.fact_user_metrics()
            ),
        )

    def fact_delivery(self) -> DataFrame:
        return self._get(
            "fact_delivery",
            lambda: mt.fact_delivery_as_written(
                self.enriched_orders(), self.stg_restaurants(), self.stg_couriers(), self.fact_user_metrics()
            ),
        )


STAGING = [
    "stg_orders", "stg_order_items", "stg_events", "stg_sessions",
    "stg_users", "stg_restaurants", "stg_couriers", "stg_exchange_rates",
]
# Build levels: a level reads only what lower levels wrote. Heaviest first within a level.
LEVELS = [
    ["stg_orders", "fact_funnel"],
    ["customer_context", "dim_restaurants", "dim_couriers"],
    ["fact_delivery", "fact_orders", "fact_user_metrics", "fact_channel_performance", "dim_users"],
]


def build(
    models: Models, out_dir: str, timings: dict[str, float] | None = None, concurrency: int = 4, schema: str = SCHEMA,
    metrics: dict[str, dict[str, int]] | None = None,
) -> dict[str, str]:
    """Register the staging views and write the marts as tables ``schema``.name under ``out_dir``.

    stg_orders and the customer context are written once, as several marts read them; the
    other staging models stay views over their sources. Models of one level do not depend on
    each other and are submitted ``concurrency`` at a time (the warehouse build's thread
    count); Spark interleaves their jobs. A written table is the lineage cut: a lost
    executor re-runs at most the current level's tasks. ``timings`` receives the seconds
    spent writing each table, ``metrics`` what is counted of each mart and of stg_orders on the way (rows, rows with a
    null key, SLA flags that disagree), without another read. Returns the tables' folders.
    """
    spark = models.raw.spark
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for level in LEVELS for name in level}

    def write(name: str) -> tuple[str, float]:
        t0 = time.perf_counter()
        df = getattr(models, name)()
        seen = Observation(name)
        if name in MART_LAYOUT:
            df = df.observe(seen, *ck.key_metrics(ck.MART_NOT_NULL_KEYS[name]))
            # the cuts come from the stored orders, so the mart isn't computed twice
            cuts = z_cuts(models.stg_orders(), MART_LAYOUT[name][1]) if name in Z_ORDERED else None
            paths[name] = write_named_table(df, f"{schema}.{name}", paths[name], *MART_LAYOUT[name], cuts=cuts)
        else:
            own = ck.sla_metrics() if name == "stg_orders" else []
            write_table(df.observe(seen, *ck.key_metrics(["customer_id"]), *own), paths[name])
        if metrics is not None:
            metrics[name] = seen.get
        return name, round(time.perf_counter() - t0, 3)

    for level in LEVELS:
        with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
            for name, seconds in pool.map(write, level):
                if timings is not None:
                    timings[name] = seconds
        for name in level:
            models.overrides[name] = spark.read.parquet(paths[name])
    for name in STAGING:
        register_view(getattr(models, name)(), name)
    return paths


def refresh_funnel(models: Models, path: str, days: list) -> None:
    """Rebuild these days of the written fact_funnel under ``path`` from all events of the days, late ones included.

    A day's funnel depends on its own events, so only the days that new events touch are
    read and replaced (dynamic partition overwrite); a day that has lost all its funnel rows keeps its old ones.
    """
    day, clustered = MART_LAYOUT["fact_funnel"]
    events = models.stg_events().filter(F.col("event_date").isin(days))
    overwrite_days(mt.fact_funnel(events), path, day, clustered)
