"""Incremental models equal full ones, and the whole cycle stops when reconciliation fails."""

import time
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.assertions import run_tests
from tidemark.operators.merge import table_difference
from tidemark.operators.versions import latest_version
from tidemark.plans import marts, reconcile, staging
from tidemark.plans.build import Warehouse, run_cycle
from tidemark.plans.suite import declared_tests
from tidemark.session import scratch_path
from tidemark.sources import shop
from tidemark.sources.raw_store import RawStore
from tidemark.sources.tables import list_names, write_parts
from tidemark.specs import TABLES

CUTOFF = "1998-01-01 00:00:00"
EVENT_CUTOFF = "2024-01-25 00:00:00"


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    out = {}
    for s in TABLES:
        df = shop.RAW[s.name](spark, sf_dir)
        if s.name == "orders":
            df = df.fillna("organic", ["channel"])
        path = scratch_path(spark, s.name)
        df.write.parquet(path)
        out[s.name] = spark.read.parquet(path)
    return out


def until(raw, order_cutoff=CUTOFF, event_cutoff=EVENT_CUTOFF):
    cut = {s.name: event_cutoff if s.name == "web_events" else order_cutoff for s in TABLES}
    return {s.name: raw[s.name].filter(F.col(s.cursor) <= F.lit(cut[s.name]).cast("timestamp_ntz")) for s in TABLES}


def test_incremental_build_equals_full_build(spark, raw):
    # Late events only up to the lookback; later ones are the known blind spot.
    lateness = F.col("ingested_at") <= F.col("event_ts") + F.expr("INTERVAL 3 DAYS")
    raw = raw | {"web_events": raw["web_events"].filter(lateness)}
    step = Warehouse(spark, scratch_path(spark, "step"))
    # The history must not change between the steps: the fact does not watch it.
    step.build(until(raw) | {"customers": raw["customers"], "products": raw["products"]})
    incremental = step.build(raw)
    full = Warehouse(spark, scratch_path(spark, "full")).build(raw)
    for name in ("fct_orders", "fct_order_items", "mart_daily_channel", "mart_funnel_daily", "mart_customer_rfm"):
        left, right, a, b = table_difference(incremental[name], full[name]).first()
        assert (a, b) == (0, 0) and left == right > 0, name


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that stay; Spark deletes them a moment after a query."""
    for _ in range(50):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.1)
    return found


def test_build_in_parts_equals_build_in_one(spark, raw):
    odd = raw["orders"].limit(1).withColumns({"order_id": F.lit(None).cast("long"), "customer_id": F.lit(None).cast("long")})
    raw = raw | {"orders": raw["orders"].union(odd)}
    one = Warehouse(spark, scratch_path(spark, "one"))
    parts = Warehouse(spark, scratch_path(spark, "parts"), part_rows=raw["order_items"].count() // 2)  # three parts
    for step in (until(raw), raw):
        want, got = one.build(step), parts.build(step)
        assert parts.observed == one.observed != {}
        for name in want:
            left, right, a, b = table_difference(want[name], got[name]).first()
            assert (a, b) == (0, 0) and left == right > 0, name


def test_build_leaves_only_its_models(spark, raw):
    """Neither shuffle files nor what its steps hand on."""
    warehouse, before = Warehouse(spark, scratch_path(spark, "lean")), shuffle_files(spark)
    warehouse.build(until(raw))
    warehouse.build(raw)
    assert not left_over(spark, before)
    scratch = warehouse.root.rsplit("/", 1)[0]
    assert not list_names(spark, f"{scratch}/order-*") + list_names(spark, f"{scratch}/current-items-*") + list_names(spark, f"{scratch}/merge-delta-*")


def test_parts_are_written_one_after_the_other(spark):
    path, seen = scratch_path(spark, "parted"), []

    def frames():
        for i in range(3):
            seen.append((len(list_names(spark, f"{path}/part-*")), list_names(spark, f"{path}/_SUCCESS")))
            yield spark.range(i, i + 1).coalesce(1)

    assert rows(write_parts(path, frames())) == [(0,), (1,), (2,)]
    assert seen == [(0, []), (1, []), (2, [])] and list_names(spark, f"{path}/_SUCCESS")


def test_tests_of_a_build_leave_no_files(spark, raw):
    """Each test is counted by itself, and what several tests read is stored only meanwhile."""
    warehouse = Warehouse(spark, scratch_path(spark, "tested-marts"), part_rows=raw["order_items"].count() // 2)
    models = warehouse.build(raw)
    lazily, before = rows(run_tests(declared_tests(models))), shuffle_files(spark)
    assert rows(warehouse.run_tests(models)) == lazily and len(lazily) == 47
    assert not left_over(spark, before)
    assert not list_names(spark, f"{warehouse.root.rsplit('/', 1)[0]}/tested-" + "[0-9a-f]" * 32)


def test_empty_target_counts_as_first_build(spark, raw):
    warehouse = Warehouse(spark, scratch_path(spark, "empty"))
    none = {n: df.filter(F.lit(False)) for n, df in raw.items()}
    warehouse.build(none)
    assert warehouse.build(raw)["fct_orders"].count() == raw["orders"].select("order_id").distinct().count()


def test_point_in_time_attribution(spark, raw):
    """An order keeps the country its customer lived in when it was placed."""
    history = marts.dim_customers_history(staging.stg_customer_versions(raw["customers"]))
    moved = history.filter("country IS NOT NULL").groupBy("customer_id").agg(F.count_distinct("country").alias("n")).filter("n > 1")
    orders = staging.stg_orders(raw["orders"]).join(moved, "customer_id", "left_semi")
    fact = marts.fct_orders(orders, staging.stg_order_items(raw["order_items"]), staging.stg_products(raw["products"]), history)
    assert fact.count() == orders.count() > 0
    spans = {}
    for r in history.collect():
        spans.setdefault(r.customer_id, []).append(r)
    for r in fact.select("customer_id", "order_ts", "country").collect():
        [hit] = [h for h in spans[r.customer_id] if h.valid_from <= r.order_ts < h.valid_to]
        assert r.country == hit.country


def test_unknown_event_type_reaches_no_stage(spark):
    events = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), "mystery", "tv"), (2, datetime(2024, 1, 1), "purchase", "tv")],
        "session_id long, event_ts timestamp_ntz, event_type string, device string",
    )
    funnel = marts.mart_funnel_daily(events)
    assert rows(funnel, "stage_order", "sessions") == [(n, 1) for n in range(1, 6)]


def test_session_is_dated_by_its_first_event_in_the_lookback(spark):
    """A session that straddles the edge of the window belongs to the day before it."""
    rows_in = [(1, datetime(2024, 1, 6, 23), "page_view", "tv"), (1, datetime(2024, 1, 7, 1), "purchase", "tv"),
               (2, datetime(2024, 1, 10), "page_view", "tv")]
    events = spark.createDataFrame(rows_in, "session_id long, event_ts timestamp_ntz, event_type string, device string")
    delta = marts.funnel_delta(events, F.lit("2024-01-07").cast("date"))
    assert rows(delta, "event_date", "stage_order") == [(datetime(2024, 1, 10).date(), 1)]


def test_cycle_builds_only_after_clean_reconciliation(spark, raw):
    sources = {
        s.name: latest_version(raw[s.name], s.pk, [s.cursor]).select(*s.columns) for s in TABLES
    }
    store = RawStore(spark, scratch_path(spark, "store"))
    warehouse = Warehouse(spark, scratch_path(spark, "marts"))
    loads, models, tests = run_cycle(store, warehouse, sources, ("2024-01", "2024-01"), "run-1", now=datetime(2024, 2, 9))
    assert all(r.rows_inserted == r.rows_extracted for r in loads)
    assert tests.filter("verdict <> 'pass'").isEmpty()
    assert store.dq_results().count() == 14
    built = warehouse.snapshot("mart_daily_channel").version()
    # The month of the events is no longer registered: recorded, raised, and nothing built.
    with pytest.raises(reconcile.DataQualityError, match="default_partition_empty"):
        run_cycle(store, warehouse, sources, ("2023-01", "2023-12"), "run-2", now=datetime(2024, 2, 10))
    assert store.dq_results().filter("run_label = 'run-2' AND status = 'fail'").count() == 1
    assert warehouse.snapshot("mart_daily_channel").version() == built


def test_delta_of_many_orders_picks_items_in_one_exchange(spark, raw):
    products, history = staging.stg_products(raw["products"]), marts.dim_customers_history(staging.stg_customer_versions(raw["customers"]))
    since = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    few, many = (marts.fct_orders_delta(raw["orders"], raw["order_items"], products, history, since, n) for n in (10**6, 0))
    assert rows(few) == rows(many) and few.count() > 0
    text = many._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") < few._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi")


def test_lines_for_totals_are_those_of_the_item_fact(spark, raw):
    products, items = staging.stg_products(raw["products"]), staging.stg_order_items(raw["order_items"])
    orders = staging.stg_orders(raw["orders"]).filter("order_id % 3 > 0")
    fact = marts.fct_order_items(items, orders.withColumn("country", F.lit("x")), products)
    columns = ("order_item_id", "order_id", "line_revenue")
    assert rows(marts.order_line_revenue(items, orders, products)) == rows(fact, *columns)
