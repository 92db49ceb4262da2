"""Building a query runs no job but the reading of Parquet footers."""

import re
import uuid

import pytest
from helpers import SF_SMALL

import __spark_entry__ as entry

OWN = [k for k in entry.queries() if not re.match(r"op\d+_|pipeline$", k)]


def _jobs(spark, build):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "plan")
    try:
        df = build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    store = sc._jsc.sc().statusStore()
    names = [store.job(i).name() for i in sc.statusTracker().getJobIdsForGroup(group)]
    return df, [n for n in names if not n.startswith("parquet at")]


@pytest.mark.parametrize("key", OWN)
def test_no_job_before_the_action(spark, key):
    _, jobs = _jobs(spark, lambda: entry.queries()[key](spark, SF_SMALL))
    assert jobs == []


def _scans(df, table):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0].count(f"{table}.parquet]")


def test_dim_users_reads_its_sources_few_times(spark):
    df = entry.queries()["dim_users"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan  # nobody reads the order's number
