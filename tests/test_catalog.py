"""The registered queries: complete, backed by an oracle, and equal to it on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.catalog.registry import catalog
from tools.check_oracle import TABLES, TYPES, value

QUICK = (
    "latest_version", "dim_customers_history", "asof_join", "mart_funnel_daily", "mart_daily_channel",
    "mart_cohort_retention", "idempotent_append", "test_unique", "watermark_lag", "null_rate_channel",
    "daily_volume_anomaly", "kpi_overview", "moved_customers", "funnel_conversion_14d",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.oracles) == set(catalog.queries)
    assert set(catalog.queries) <= set(driver.queries())
    assert len(catalog.queries) > 90


def test_every_oracle_parses_and_plans(duck):
    for name, sql in driver.oracle_sql().items():
        duck.execute(f"explain {sql}")


def test_entry(spark):
    flagship = driver.entry(spark)
    assert flagship.columns[0] == "order_id" and not flagship.isEmpty()


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_oracle(spark, duck, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(driver.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cur.description}
    assert {n: TYPES.get(t, t) for n, t in df.dtypes} == types
    names = [d[0] for d in cur.description]
    mine = [tuple(value(r[df.columns.index(n)]) for n in names) for r in got]
    assert sorted(mine) == sorted(tuple(value(v) for v in r) for r in cur.fetchall())
