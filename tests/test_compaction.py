"""The compacted load log, merged batches, and the registry of months."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import reconcile
from tidemark.plans.load import load_batch, load_table
from tidemark.session import scratch_path
from tidemark.sources import raw_store
from tidemark.sources.raw_store import DEFAULT_MONTH, RawStore, months_between
from tidemark.sources.tables import list_names
from tidemark.specs import ORDERS, WEB_EVENTS

T0 = datetime(2024, 1, 1)


def orders(spark, *ids, at=T0):
    return spark.createDataFrame([(i, 1, T0, "pending", "email", None, T0, at) for i in ids], ORDERS.schema).coalesce(1)


def events(spark, *data):
    return spark.createDataFrame([(i, 1, None, ts, "page_view", "tv", ts) for i, ts in data], WEB_EVENTS.schema)


def commit(store, batch_id, df, reached, status="success"):
    if status != "success":
        store.publish(ORDERS, batch_id, "running", run_label=f"run-{batch_id}", started_at=T0)
    store.write_batch(ORDERS, df.withColumn("_loaded_at", F.lit(T0).cast("timestamp_ntz")), batch_id)
    if status:
        store.publish(ORDERS, batch_id, status, run_label=f"run-{batch_id}", started_at=T0, watermark_to=reached if status == "success" else None)


def files(store):
    """Everything a load has to list: attempts, states, folders of rows."""
    pattern = ("ops/load_audit/table_name=orders/*", "ops/load_log/table_name=orders/state=*", "raw/orders/*", "raw/orders/merged/*")
    return sum(len(list_names(store.spark, f"{store.root}/{p}")) for p in pattern)


def test_many_batches_keep_the_log_small(spark):
    store = RawStore(spark, scratch_path(spark, "store"), compact_every=10)
    seen = []
    for i in range(1, 121):
        commit(store, i, orders(spark, i), T0 + timedelta(hours=i))
        store.compact_if_due(ORDERS)
        if i % 30 == 29:
            seen.append((files(store), len(store.visible(ORDERS))))
    assert max(f for f, _ in seen) <= 2 * 10 * 2 + 2 * raw_store.MERGE_FOLDERS and max(v for _, v in seen) <= 10 + raw_store.MERGE_FOLDERS
    assert sorted(rows(store.read_raw(ORDERS), "order_id", "_batch_id")) == [(i, i) for i in range(1, 121)]
    assert store.watermark(ORDERS) == T0 + timedelta(hours=120) and store.next_batch_id() == 121
    assert store.audit().count() == 120 and store.audit().filter("run_label = 'run-7' and status = 'success'").count() == 1
    assert store.has_run(ORDERS, "run-1") and not store.has_run(ORDERS, "run-121")
    # Delivered again long after: known from the snapshot. New rows meet those of merged batches.
    assert load_batch(store, ORDERS, orders(spark, 1), "run-1") is None
    again = load_table(store, ORDERS, orders(spark, 120, 121, at=T0 + timedelta(hours=120)), full=True)
    assert (again.batch_id, again.rows_inserted) == (121, 2)
    assert load_table(store, ORDERS, orders(spark, 120, 121, at=T0 + timedelta(hours=120)), full=True).rows_inserted == 0


def test_readers_see_one_state_across_a_compaction(spark, monkeypatch):
    store = RawStore(spark, scratch_path(spark, "store"))
    for i in (1, 2):
        commit(store, i, orders(spark, i), T0 + timedelta(hours=i))
    commit(store, 3, orders(spark, 99), None, "failed")
    commit(store, 4, orders(spark, 98), None, None)  # its writer died
    before = store.read_raw(ORDERS)
    store.compact(ORDERS)
    assert [f.level for f in store.visible(ORDERS)] == [1]
    assert rows(before, "order_id") == rows(store.read_raw(ORDERS), "order_id") == [(1,), (2,)]
    assert rows(store.audit(), "batch_id", "status") == [(1, "success"), (2, "success"), (3, "failed"), (4, "running")]
    commit(store, 5, orders(spark, 5), T0 + timedelta(hours=5))
    published = raw_store.publish_text

    def crash(spark, target, text):
        if target.endswith("state.json"):
            raise RuntimeError("lost")
        published(spark, target, text)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(raw_store, "publish_text", crash)
        store.compact(ORDERS)
    assert rows(store.read_raw(ORDERS), "order_id") == [(1,), (2,), (5,)]
    store.compact(ORDERS)
    assert rows(store.read_raw(ORDERS), "order_id", "_batch_id") == [(1, 1), (2, 2), (5, 5)]
    assert not list_names(spark, f"{store.root}/raw/orders/_batch_id=3") and store.next_batch_id() == 6
    assert store.read_raw(ORDERS, T0 + timedelta(hours=5)).count() == 1


def test_compacting_nothing(spark):
    store = RawStore(spark, scratch_path(spark, "store"))
    store.compact(ORDERS)
    assert store.watermark(ORDERS) is None and store.read_raw(ORDERS).count() == 0 and store.next_batch_id() == 1


def status(store):
    return reconcile.default_partition_empty(store.read_raw(WEB_EVENTS)).first()


def test_unregistered_months_wait_in_the_default_folder(spark, monkeypatch):
    store = RawStore(spark, scratch_path(spark, "store"), months_on_demand=False)
    assert store.register_months(WEB_EVENTS, datetime(2023, 12, 5), datetime(2024, 1, 2)) == ["2023-12", "2024-01"]
    jan, feb, far = datetime(2024, 1, 5), datetime(2024, 2, 5), datetime(2035, 1, 1)
    load_table(store, WEB_EVENTS, events(spark, (1, jan), (2, feb)))
    load_table(store, WEB_EVENTS, events(spark, (3, jan), (4, far)), full=True)
    held = rows(store.read_raw(WEB_EVENTS), "event_id", "event_month", "_batch_id")
    assert held == [(1, "2024-01", 1), (2, DEFAULT_MONTH, 1), (3, "2024-01", 2), (4, DEFAULT_MONTH, 2)]
    assert status(store)[2:] == ("fail", "0", "2", "unregistered_months=2")
    # Rows in the default folder are known to later loads.
    assert load_table(store, WEB_EVENTS, events(spark, (2, feb), (4, far)), full=True).rows_inserted == 0
    store.register_months(WEB_EVENTS, feb, feb)
    assert status(store)[2:] == ("fail", "0", "1", "unregistered_months=1")
    # The writer dies between registering the month and moving its rows.
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(RawStore, "compact", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        store.register_months(WEB_EVENTS, far, far)
    assert status(store)[2] == "fail"
    assert store.register_months(WEB_EVENTS, far, far) == []
    assert status(store)[2:] == ("pass", "0", "0", "")
    assert rows(store.read_raw(WEB_EVENTS), "event_id", "event_month", "_batch_id") == [
        (1, "2024-01", 1), (2, "2024-02", 1), (3, "2024-01", 2), (4, "2035-01", 2),
    ]


def test_months_on_demand_and_inside_a_load(spark):
    store = RawStore(spark, scratch_path(spark, "store"), compact_every=2)
    store.months_on_demand = False
    load_table(store, WEB_EVENTS, events(spark, (1, datetime(2024, 1, 5))))
    assert status(store)[2] == "fail"
    store.months_on_demand = True
    # The load registers its month while it runs; the rows that waited move out, and its own batch becomes visible after.
    load_table(store, WEB_EVENTS, events(spark, (2, datetime(2024, 1, 7)), (3, datetime(2024, 3, 1))), full=True)
    assert status(store)[2] == "pass" and store.months(WEB_EVENTS) == ["2024-01", "2024-02", "2024-03"]
    assert rows(store.read_raw(WEB_EVENTS), "event_id", "event_month") == [(1, "2024-01"), (2, "2024-01"), (3, "2024-03")]


def test_month_range():
    assert months_between(datetime(2023, 11, 30), datetime(2024, 2, 1)) == ["2023-11", "2023-12", "2024-01", "2024-02"]
