"""The bench's work in DuckDB: the same tables written, the same models evaluated alone.

A build writes stg_orders, the customer context and the eight marts as Parquet (day-partitioned
where the Spark build partitions), marts read the written stg_orders and context, and every other
staging model is evaluated in full. Prints one JSON line like bench.py.

Usage: python scripts/duckdb_build.py [sf_dir] [runs]
"""

from __future__ import annotations

import json
import re
import statistics
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from oracle.duckdb_sql import CTES, with_ctes  # noqa: E402
from tiffin.plans.models import LEVELS, STAGING  # noqa: E402
from tiffin.sources.sinks import MART_LAYOUT  # noqa: E402

SOURCE = {"customer_context": "people"}  # the context with the dim_users columns
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def sql(name: str, written: dict[str, str]) -> str:
    """The model's SQL, reading what is written instead of building it again."""
    name = SOURCE.get(name, name)
    kept = {n: CTES[n] for n in CTES}
    try:
        for table, path in written.items():
            CTES[SOURCE.get(table, table)] = ([], f"SELECT * FROM read_parquet('{path}')")
        return with_ctes(f"SELECT * FROM {name}", name)
    finally:
        CTES.update(kept)


def evaluated(con: duckdb.DuckDBPyConnection, query: str) -> float:
    t0 = time.perf_counter()
    con.execute(f"CREATE OR REPLACE TEMP TABLE evaluated AS {query}")
    return time.perf_counter() - t0


def one_build(con: duckdb.DuckDBPyConnection) -> float:
    out, written = tempfile.mkdtemp(prefix="tiffin-duckdb-"), {}
    t0 = time.perf_counter()
    for level in LEVELS:
        done = {}
        for name in level:
            by, cluster = MART_LAYOUT.get(name, (None, ()))
            order = f" ORDER BY {', '.join([by, *cluster])}" if by else ""
            options = f", PARTITION_BY ({by})" if by else ""
            target = f"{out}/{name}" if by else f"{out}/{name}.parquet"
            con.execute(f"COPY ({sql(name, written)}{order}) TO '{target}' (FORMAT parquet{options})")
            if name in ("stg_orders", "customer_context"):
                done[name] = target
        written |= done
    for name in STAGING:
        if name != "stg_orders":
            evaluated(con, sql(name, written))
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    one_build(con)
    totals = [one_build(con) for _ in range(runs)]
    alone = {
        name: round(statistics.median(evaluated(con, sql(name, {})) for _ in range(runs)), 3)
        for name in [*STAGING, *MART_LAYOUT]
    }
    sf = re.sub("^sf", "", Path(sf_dir).name)
    print(json.dumps({"metric": "duckdb_full_build_median", "value": round(statistics.median(totals), 3), "unit": "sec", "queries": alone, "builds": [round(t, 3) for t in totals], "sf": sf}))


if __name__ == "__main__":
    main()
