"""Red tests: each fault must turn its own check red, and no other."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.catalog import check_queries
from tidemark.catalog.inputs import Shop
from tidemark.operators import assertions, drift
from tidemark.plans import checks, marts, staging
from tidemark.plans.build import DataTestError, Warehouse, raise_on_failed_tests
from tidemark.plans.suite import declared_tests
from tidemark.session import scratch_path
from tidemark.sources import shop
from tidemark.specs import FCT_ORDERS_CONTRACT, TABLES


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    """Raw without the null channels the inputs carry, stored once."""
    frames = {s.name: shop.RAW[s.name](spark, sf_dir) for s in TABLES}
    frames["orders"] = frames["orders"].fillna("organic", ["channel"])
    out = {}
    for name, df in frames.items():
        path = scratch_path(spark, name)
        df.write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


@pytest.fixture(scope="module")
def models(spark, raw):
    return Warehouse(spark, scratch_path(spark, "marts")).build(raw)


def verdicts(models):
    results = assertions.run_tests(declared_tests(models)).collect()
    assert len(results) == 47
    return {r.test for r in results if r.verdict != "pass"}


def test_clean_build_is_green(models):
    assert verdicts(models) == set()


def test_negative_price(models):
    items = models["stg_order_items"]
    bad = items.withColumn("unit_price", F.when(F.col("quantity") > 48, -F.col("unit_price")).otherwise(F.col("unit_price")))
    assert not checks.negative_amounts(bad).isEmpty()
    assert checks.negative_amounts(items).isEmpty()


def test_null_channel_and_orphan_orders(models):
    orders = models["stg_orders"]
    stray = orders.limit(5).withColumns(
        {"order_id": F.col("order_id") + 90_000_000, "customer_id": F.col("customer_id") + 99_000_000, "channel": F.lit(None).cast("string")}
    )
    changed = models | {"stg_orders": orders.unionByName(stray)}
    assert verdicts(changed) == {
        "not_null stg_orders.channel", "relationships stg_orders.customer_id", "fct_orders_is_complete",
    }
    fact = marts.fct_orders(stray, models["stg_order_items"], models["dim_products"], models["dim_customers_history"])
    assert assertions.nulls(fact, "country").count() == 5


def test_gap_in_history(models):
    history = models["dim_customers_history"]
    shifted = F.when(F.col("version_number") == 1, F.col("valid_to") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("valid_to"))
    broken = history.withColumn("valid_to", shifted)
    moved = history.filter("NOT is_current").select("customer_id").distinct().count()
    assert moved > 0
    found = checks.history_broken(broken)
    assert rows(found.select("problem").distinct()) == [("discontinuous",)]
    assert found.select("customer_id").distinct().count() == moved


def test_double_current_row(models):
    history = models["dim_customers_history"].withColumn("is_current", F.lit(True))
    assert rows(checks.history_broken(history).select("problem").distinct()) == [("open_periods",)]


def test_changed_totals_and_stale_mart(models):
    lines = models["fct_order_items"]
    assert not checks.totals_off(
        models["fct_orders"], lines.withColumn("line_revenue", F.col("line_revenue") + 1)
    ).isEmpty()
    daily = models["mart_daily_channel"]
    first_day = daily.agg(F.min("order_date")).first()[0]
    assert rows(checks.daily_channel_off(daily.filter(F.col("order_date") != F.lit(first_day)), models["fct_orders"]), "order_date", "mart_revenue") == [
        (first_day, None)
    ]


def test_missing_and_stale_orders(models):
    fact = models["fct_orders"]
    first = fact.agg(F.min("order_id")).first()[0]
    old = fact.filter(F.col("order_id") != first).withColumn(
        "order_updated_at",
        F.when(F.col("order_id") == first + 1, F.lit("1990-01-01").cast("timestamp_ntz")).otherwise(F.col("order_updated_at")),
    )
    found = checks.orders_incomplete(models["stg_orders"], models["stg_order_items"], old)
    expected = [("absent", first)]
    if not fact.filter(F.col("order_id") == first + 1).isEmpty():
        expected.append(("outdated", first + 1))
    assert rows(found) == expected


def test_late_events_inside_and_beyond_the_lookback(spark, raw, models):
    events = staging.stg_web_events(raw["web_events"])
    funnel = models["mart_funnel_daily"]
    newest = events.agg(F.max("event_date")).first()[0]

    def late(days):
        at = (F.lit(newest).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days))).alias("event_ts")
        extra = spark.range(50).select(
            (F.col("id") + 10_000_000).alias("event_id"), (F.col("id") + 10_000_000).alias("session_id"),
            F.lit(None).cast("long").alias("customer_id"), at, F.to_date(at).alias("event_date"),
            F.lit("page_view").alias("event_type"), F.lit("mobile").alias("device"),
            F.lit(newest).cast("timestamp_ntz").alias("ingested_at"),
        )
        return events.unionByName(extra)

    inside = late(2)
    assert checks.funnel_off(inside, marts.funnel_incremental(funnel, inside)).isEmpty()
    beyond = late(6)
    merged = marts.funnel_incremental(funnel, beyond)
    assert checks.funnel_off(beyond, merged).count() == 1
    assert checks.funnel_off(beyond, marts.mart_funnel_daily(beyond)).isEmpty()


def test_retention_rate_out_of_range(models):
    retention = models["mart_cohort_retention"]
    assert checks.not_a_rate(retention.withColumn("retention_rate", F.col("retention_rate") + 2)).count() == retention.count()


def test_contract(models):
    schema = models["fct_orders"].schema
    drift.enforce_contract(FCT_ORDERS_CONTRACT, schema, "fct_orders")
    retyped = models["fct_orders"].withColumn("units", F.col("units").cast("int")).schema
    with pytest.raises(drift.ContractError, match="units"):
        drift.enforce_contract(FCT_ORDERS_CONTRACT, retyped, "fct_orders")
    with pytest.raises(drift.ContractError, match="columns"):
        drift.enforce_contract(FCT_ORDERS_CONTRACT, models["fct_orders"].drop("cogs").schema, "fct_orders")


def test_personal_data_stays_in_raw(raw, models):
    published = {n: df for n, df in models.items() if not n.startswith("raw")}
    assert checks.private_columns(published) == []
    assert checks.private_columns({"raw_customers": raw["customers"]}) == [("raw_customers", "email")]
    assert checks.bad_hashes(models["dim_customers"]).isEmpty()


def test_freshness(spark, raw):
    newest = raw["customers"].agg(F.max("_loaded_at")).first()[0]

    def status(hours):
        now = F.lit(newest).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))
        return checks.source_freshness({"customers": raw["customers"]}, now).first().status

    assert [status(h) for h in (1, 26, 27, 50, 51)] == ["pass", "pass", "warn", "warn", "error"]
    empty = raw["customers"].filter(F.lit(False))
    assert checks.source_freshness({"customers": empty}, F.lit(newest).cast("timestamp_ntz")).first().status == "error"


def test_severity_and_summary(spark):
    some, none = spark.range(3).toDF("x"), spark.range(0).toDF("x")
    tests = [
        assertions.DataTest("a", none),
        assertions.DataTest("b", some, "warn"),
        assertions.DataTest("c", some),
        assertions.row_test("d", some, F.col("x") > 0),
        assertions.row_test("e", some, F.col("x") > 5),
    ]
    results = assertions.run_tests(tests)
    assert rows(results, "test", "violations", "verdict") == [("a", 0, "pass"), ("b", 3, "warn"), ("c", 3, "fail"), ("d", 2, "fail"), ("e", 0, "pass")]
    assert rows(assertions.summarise(results)) == [(2, 1, 2)]
    with pytest.raises(DataTestError, match="c: 3 rows"):
        raise_on_failed_tests(results)


def test_pii_scan_makes_shared_models_once(spark, sf_dir):
    models = check_queries._models(Shop(spark, sf_dir))
    for name in ("stg_orders", "stg_order_items", "fct_orders", "dim_customers_history"):
        assert "Exchange" not in models[name]._jdf.queryExecution().executedPlan().toString()
