"""Loads: incremental, idempotent, atomic; drift stops before anything is written."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from tidemark.operators import drift
from tidemark.operators.merge import extract_range
from tidemark.operators.versions import latest_version
from tidemark.plans.load import LogSource, load_all, load_batch, load_table
from tidemark.session import scratch_path
from tidemark.sources.raw_store import RawStore, load_status, watermarks
from tidemark.sources.tables import list_names
from tidemark.specs import ORDERS, PRODUCTS, TABLES, WEB_EVENTS

T1, T2, T3 = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 9)


@pytest.fixture
def store(spark):
    return RawStore(spark, scratch_path(spark, "store"))


def orders(spark, *changes):
    data = [(i, 1, T1, status, "email", None, T1, at) for i, status, at in changes]
    return spark.createDataFrame(data, ORDERS.schema)


def events(spark, *data):
    return spark.createDataFrame([(i, 1, None, ts, "page_view", "mobile", at) for i, ts, at in data], WEB_EVENTS.schema)


def test_incremental_versions_and_idempotence(spark, store):
    first = load_table(store, ORDERS, orders(spark, (1, "pending", T1), (2, "pending", T2)), now=T2)
    assert (first.rows_extracted, first.rows_inserted, first.watermark_from, first.watermark_to) == (2, 2, None, T2)
    again = load_table(store, ORDERS, orders(spark, (1, "pending", T1), (2, "pending", T2)))
    assert (again.rows_extracted, again.rows_inserted, again.rows_ignored) == (1, 0, 1)
    # No overlap: a row at the watermark is not read again.
    none = load_table(store, ORDERS, orders(spark, (1, "pending", T1), (2, "pending", T2)), overlap_seconds=0)
    assert none.rows_extracted == 0
    third = load_table(store, ORDERS, orders(spark, (1, "completed", T3), (2, "pending", T2)))
    assert (third.rows_extracted, third.rows_inserted, third.watermark_from) == (2, 1, T2)
    assert rows(store.read_raw(ORDERS), "order_id", "status", "_batch_id") == [
        (1, "completed", 4), (1, "pending", 1), (2, "pending", 1),
    ]
    assert rows(store.read_raw(ORDERS).filter("_batch_id = 1"), "_loaded_at") == [(T2,), (T2,)]
    full = load_table(store, ORDERS, orders(spark, (1, "completed", T3), (2, "pending", T2)), full=True)
    assert (full.rows_extracted, full.rows_inserted) == (2, 0)


def test_a_log_is_cut_to_the_range_before_its_newest_versions_are_picked(spark, store):
    log = orders(spark, (1, "pending", T1), (1, "completed", T3), (2, "pending", T1), (3, "pending", T2), (3, "refunded", T2), (4, "pending", None))
    source = LogSource(log, lambda df: latest_version(df, ["order_id"], ["updated_at"]))
    for bounds in ((T3,), (T3, T2), (T3, T2, 3600 * 12), (T3, T1, 0)):
        assert rows(source.extract("updated_at", *bounds)) == rows(extract_range(source.rows, "updated_at", *bounds))
    plan = source.extract("updated_at", T3, T2)._jdf.queryExecution().optimizedPlan().toString()
    assert "updated_at" in plan[plan.index("Aggregate"):].split("Filter", 1)[1].splitlines()[0]
    upper = source.changed(lambda df: df.withColumn("status", F.upper("status")))
    first = load_table(store, ORDERS, upper)
    assert (first.rows_extracted, first.rows_inserted, first.watermark_to) == (3, 3, T3)
    assert rows(store.read_raw(ORDERS), "order_id", "status") == [(1, "COMPLETED"), (2, "PENDING"), (3, "REFUNDED")]


def test_rows_picked_by_key_are_not_shuffled_again(spark, store, monkeypatch):
    """Neither in a first load nor when what they meet is small; rows that raw has are still left out."""
    written = []
    write = store.write_batch
    monkeypatch.setattr(store, "write_batch", lambda spec, df, batch_id: (written.append(df), write(spec, df, batch_id)))
    pick = lambda df: latest_version(df, ["order_id"], ["updated_at"])
    log = orders(spark, (1, "pending", T1), (1, "completed", T3), (2, "pending", T1), (3, "pending", T2), (3, "refunded", T2))
    first = load_table(store, ORDERS, LogSource(log, pick, ORDERS.pk))
    later = log.union(orders(spark, (4, "pending", T3), (5, "pending", T3)))
    second = load_table(store, ORDERS, LogSource(later, pick, ORDERS.pk))
    assert [(r.rows_extracted, r.rows_inserted) for r in (first, second)] == [(3, 3), (3, 2)]
    assert rows(store.read_raw(ORDERS), "order_id", "status") == [(1, "completed"), (2, "pending"), (3, "refunded"), (4, "pending"), (5, "pending")]
    for df in written:
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "Aggregate" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    load_table(store, PRODUCTS, spark.createDataFrame([(1, "a", "b", None, None, T1, T1)] * 2, PRODUCTS.schema))
    assert store.read_raw(PRODUCTS).count() == 1  # without a key copies are looked for


def test_change_without_new_cursor_is_a_duplicate(spark, store):
    load_table(store, ORDERS, orders(spark, (1, "pending", T1)))
    result = load_table(store, ORDERS, orders(spark, (1, "refunded", T1)))
    assert (result.rows_extracted, result.rows_inserted) == (1, 0)


def test_watermark_never_moves_back(spark, store):
    load_table(store, ORDERS, orders(spark, (1, "pending", T3)))
    load_table(store, ORDERS, orders(spark, (2, "pending", T1)), full=True)
    assert store.watermark(ORDERS) == T3
    assert store.read_raw(ORDERS).count() == 2


def test_late_events_enter_by_ingestion_time_and_new_months_appear(spark, store):
    jan, feb = datetime(2024, 1, 5), datetime(2024, 2, 3)
    load_table(store, WEB_EVENTS, events(spark, (1, jan, T1)))
    late = load_table(store, WEB_EVENTS, events(spark, (1, jan, T1), (2, jan, T3), (3, feb, T3)), overlap_seconds=0)
    assert (late.rows_extracted, late.rows_inserted) == (2, 2)
    # The same event delivered again later is known by id and event time.
    again = load_table(store, WEB_EVENTS, events(spark, (1, jan, datetime(2024, 1, 3))))
    assert (again.rows_extracted, again.rows_inserted) == (1, 0)
    assert rows(store.read_raw(WEB_EVENTS), "event_id", "event_month") == [
        (1, "2024-01"), (2, "2024-01"), (3, "2024-02"),
    ]
    assert list_names(spark, f"{store.root}/raw/web_events/_batch_id=2/event_month=2024-02")


def test_failed_load_changes_nothing_and_can_be_repeated(spark, store):
    load_table(store, ORDERS, orders(spark, (1, "pending", T1)))
    source = orders(spark, (1, "completed", T3), (2, "pending", T2))
    broken = source.withColumn(
        "status", F.when(F.col("order_id") == 2, F.raise_error(F.lit("disk full")).cast("string")).otherwise(F.col("status"))
    )
    with pytest.raises(Exception, match="disk full"):
        load_table(store, ORDERS, broken, "nightly")
    assert store.read_raw(ORDERS).count() == 1
    assert store.watermark(ORDERS) == T1
    audit = {r.batch_id: r for r in store.audit().collect()}
    assert audit[2].status == "failed" and "disk full" in audit[2].error and len(audit[2].error) <= 1500
    assert audit[2].run_label == "nightly" and audit[2].duration_seconds > 0
    retry = load_table(store, ORDERS, source)
    assert (retry.batch_id, retry.rows_inserted) == (3, 2)


def test_batch_without_audit_row_is_invisible(spark, store):
    """The writer died after the data and before the commit."""
    load_table(store, ORDERS, orders(spark, (1, "pending", T1)))
    store.publish(ORDERS, 2, "running", started_at=T1)
    store.write_batch(ORDERS, orders(spark, (7, "pending", T3)).withColumn("_loaded_at", F.lit(T3).cast("timestamp_ntz")), 2)
    assert rows(store.read_raw(ORDERS), "order_id") == [(1,)]
    result = load_table(store, ORDERS, orders(spark, (1, "pending", T1), (7, "pending", T3)))
    assert (result.batch_id, result.rows_inserted) == (3, 1)


def test_empty_source(spark, store):
    result = load_table(store, PRODUCTS, spark.createDataFrame([], PRODUCTS.schema))
    assert (result.rows_extracted, result.rows_inserted, result.watermark_to) == (0, 0, None)
    assert store.watermark(PRODUCTS) is None
    assert [r.status for r in store.audit().collect()] == ["success"]


def test_load_all_and_status(spark, store):
    results = load_all(
        store, {"orders": orders(spark, (1, "pending", T1)), "web_events": events(spark, (1, T1, T2))},
        tables=[ORDERS, WEB_EVENTS],
    )
    assert [(r.table_name, r.rows_inserted) for r in results] == [("orders", 1), ("web_events", 1)]
    with pytest.raises(drift.SchemaDriftError):
        load_table(store, ORDERS, orders(spark, (1, "x", T3)).drop("channel"))
    assert rows(load_status(store.audit())) == [("orders", T1, "failed", None), ("web_events", T2, "success", 1)]
    assert rows(watermarks(store.audit())) == [("orders", T1), ("web_events", T2)]


def test_added_column_warns_and_loads(spark, store):
    load_table(store, ORDERS, orders(spark, (1, "pending", T1)).withColumn("coupon_code", F.lit("X")))
    assert rows(store.drift(), "kind", "column_name", "severity") == [("column_added", "coupon_code", "warn")]
    assert "coupon_code" not in store.read_raw(ORDERS).columns


def test_renamed_column_stops_before_any_write(spark, store):
    with pytest.raises(drift.SchemaDriftError, match="channel"):
        load_table(store, ORDERS, orders(spark, (1, "pending", T1)).withColumnRenamed("channel", "sales_channel"))
    assert rows(store.drift(), "kind", "column_name", "severity") == [
        ("column_added", "sales_channel", "warn"), ("column_missing", "channel", "error"),
    ]
    assert not list_names(spark, f"{store.root}/raw/*") and not list_names(spark, f"{store.root}/stage/*")
    assert store.watermark(ORDERS) is None


def test_retyped_column_is_drift_but_precision_is_not(spark):
    source = orders(spark, (1, "pending", T1))
    wider = source.withColumn("discount_pct", F.col("discount_pct").cast("decimal(12,4)"))
    assert drift.detect(ORDERS, wider.schema, ORDERS.raw_schema) == []
    retyped = source.withColumn("customer_id", F.col("customer_id").cast("string"))
    assert [(d.kind, d.column_name) for d in drift.detect(ORDERS, retyped.schema, ORDERS.raw_schema)] == [
        ("type_changed", "customer_id")
    ]


def test_delivered_batch_is_loaded_once(spark, store):
    batch = events(spark, (1, T1, T1), (1, T1, T2), (2, T1, T1))
    assert load_batch(store, WEB_EVENTS, batch, "stream-0").rows_inserted == 2
    assert load_batch(store, WEB_EVENTS, batch, "stream-0") is None
    assert load_batch(store, WEB_EVENTS, batch, "stream-1").rows_inserted == 0
    assert store.watermark(WEB_EVENTS) == T2


def test_parallel_loads_all_keep_their_drift_rows(spark, store):
    """Five tables side by side, each with a new column: none fails and no finding is lost."""
    sources = {
        s.name: spark.createDataFrame([], drift_free(s)).withColumn("coupon_code", F.lit("X")) for s in TABLES
    }
    load_all(store, sources, "wider")
    assert store.audit().filter("status = 'failed'").count() == 0
    found = rows(store.drift(), "table_name", "column_name", "severity")
    assert found == sorted((s.name, "coupon_code", "warn") for s in TABLES)


def drift_free(spec):
    return T.StructType([f for f in spec.raw_schema.fields if f.name not in ("_batch_id", "_loaded_at")])


def test_failed_insert_leaves_no_stage_and_its_whole_error(spark, store):
    broken = orders(spark, (1, "pending", T1)).withColumn("status", F.raise_error(F.lit("x" * 4000)).cast("string"))
    with pytest.raises(Exception):
        load_table(store, ORDERS, broken)
    assert not list_names(spark, f"{store.root}/stage/orders/*")
    assert len(store.audit().first().error) > 4000


def test_empty_delivery_reads_no_raw(spark, store):
    assert load_batch(store, WEB_EVENTS, events(spark, (1, T1, T1)).limit(0), "none").rows_inserted == 0
    assert not list_names(spark, f"{store.root}/raw/*")
