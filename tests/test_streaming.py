"""Streams against a batch run over the same files."""

from datetime import datetime, timedelta

import pytest
from conftest import rows

from tidemark.plans import marts
from tidemark.session import scratch_path
from tidemark.sources.raw_store import RawStore
from tidemark.sources.readers import stream_files
from tidemark.specs import WEB_EVENTS
from tidemark.streaming import jobs

DAY0 = datetime(2024, 1, 10)


def event(i, session, day, kind="page_view", hour=1):
    at = DAY0 + timedelta(days=day, hours=hour)
    return (i, session, None, at, kind, "tv", at)


def land(spark, folder, *events):
    spark.createDataFrame(list(events), WEB_EVENTS.schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return stream_files(spark, folder, WEB_EVENTS.schema, max_files=1)


def test_funnel_stream_equals_batch_over_several_files(spark):
    folder, at = scratch_path(spark, "in"), scratch_path(spark, "ckpt")
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))

    def run():
        jobs.stream_funnel(stream(spark, folder), tables, at).awaitTermination()

    land(spark, folder, event(1, 100, 0), event(2, 101, 0, "purchase"))
    run()
    land(spark, folder, event(3, 100, 0, "add_to_cart", hour=5), event(4, 102, 1))
    run()
    land(spark, folder, event(5, 103, 2), event(6, 104, 0, "mystery"))
    run()
    batch = marts.mart_funnel_daily(spark.read.parquet(folder))
    assert rows(tables.funnel.read()) == rows(batch)


def test_events_beyond_the_lookback_are_dropped(spark):
    folder, at = scratch_path(spark, "in"), scratch_path(spark, "ckpt")
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
    # The watermark moves after a micro-batch, so the cut works from the one after the next on.
    for batch in (
        [event(1, 100, 0)],
        [event(2, 101, 5)],
        [event(3, 102, 6)],
        [event(4, 103, 0), event(5, 104, 4)],  # six days late, and inside the lookback
    ):
        assert tables.late().count() == 0
        land(spark, folder, *batch)
        jobs.run_funnel(stream(spark, folder), tables, at)
    days = rows(tables.funnel.read().filter("stage_order = 1"), "event_date", "sessions")
    assert [(d.day - DAY0.day, n) for d, n in days] == [(0, 1), (4, 1), (5, 1), (6, 1)]
    late = tables.late().collect()
    assert [r.late_sessions for r in late] == [1]
    assert late[0].watermark.date() == (DAY0 + timedelta(days=3)).date()


def test_late_events_of_one_run_over_three_files_are_counted(spark):
    folder, at = scratch_path(spark, "in"), scratch_path(spark, "ckpt")
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
    for batch in (
        [event(1, 100, 9)],
        [event(2, 101, 9)],
        # Two events of one session and day are one late session; those of another day or session are more.
        [event(3, 102, 0), event(4, 102, 0, "purchase", hour=3), event(5, 102, 1), event(6, 103, 0), event(7, 104, 8)],
    ):
        land(spark, folder, *batch)
    jobs.run_funnel(stream(spark, folder), tables, at)
    assert sum(r.late_sessions for r in tables.late().collect()) == 3
    assert rows(tables.sessions.read(), "session_id") == [(100,), (101,), (104,)]
    # Noting the same query again, or running on with nothing new, counts nothing twice.
    jobs.run_funnel(stream(spark, folder), tables, at)
    assert sum(r.late_sessions for r in tables.late().collect()) == 3


def test_funnel_upsert_can_be_repeated(spark):
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
    day = DAY0.date()
    first = spark.createDataFrame([(1, day, "tv", 1), (2, day, "tv", 5)], "session_id long, event_date date, device string, furthest_stage int")
    later = spark.createDataFrame([(1, day, "tv", 3)], first.schema)
    for delta in (first, later, later):
        tables.upsert(delta)
    assert rows(tables.funnel.read(), "stage_order", "sessions") == [(1, 2), (2, 2), (3, 2), (4, 1), (5, 1)]


def test_dedupe_stream_drops_copies_across_files(spark):
    folder, out, at = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    land(spark, folder, event(1, 100, 0), event(1, 100, 0), event(2, 100, 0))
    land(spark, folder, event(2, 100, 0), event(3, 100, 1))
    # The same id at another time is another event.
    land(spark, folder, event(1, 100, 1))
    unique = jobs.dedupe_events(stream(spark, folder), "3 days")
    jobs.append_files(unique, out, at).awaitTermination()
    got = rows(spark.read.schema(WEB_EVENTS.schema).parquet(out), "event_id", "event_ts")
    assert [(i, t.day - DAY0.day) for i, t in got] == [(1, 0), (1, 1), (2, 0), (3, 1)]


def test_stream_load_resumes_and_loads_each_batch_once(spark):
    folder, at = scratch_path(spark, "in"), scratch_path(spark, "ckpt")
    store = RawStore(spark, scratch_path(spark, "store"))

    def run(checkpoint):
        jobs.stream_load(stream(spark, folder), store, WEB_EVENTS, checkpoint, "events").awaitTermination()

    land(spark, folder, event(1, 100, 0), event(2, 100, 0))
    run(at)
    land(spark, folder, event(2, 100, 0), event(3, 100, 40))
    run(at)
    assert rows(store.read_raw(WEB_EVENTS), "event_id", "_batch_id", "event_month") == [
        (1, 1, "2024-01"), (2, 1, "2024-01"), (3, 2, "2024-02"),
    ]
    # A query that lost its progress delivers the same batches again; they are already committed.
    run(scratch_path(spark, "ckpt"))
    assert store.read_raw(WEB_EVENTS).count() == 3
    assert store.audit().count() == 2


def test_late_but_unique_events_are_kept(spark):
    folder, out, at = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    for i, (day, arrival) in enumerate([(0, 0), (30, 30), (31, 31), (2, 32)]):
        row = event(i, 100, day)
        land(spark, folder, (*row[:-1], DAY0 + timedelta(days=arrival)))
        jobs.append_files(jobs.dedupe_events(stream(spark, folder), "10 days"), out, at).awaitTermination()
    assert len(rows(spark.read.schema(WEB_EVENTS.schema).parquet(out), "event_id")) == 4


SESSIONS = "session_id long, event_date date, device string, furthest_stage int"


def test_session_over_midnight_counts_on_its_first_day(spark):
    first, second = DAY0.date(), (DAY0 + timedelta(days=1)).date()
    parts = [(1, first, "tv", 1), (1, second, "tv", 5)]
    seen = []
    for batches in ([parts], [parts[:1], parts[1:]]):
        tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
        for batch in batches:
            tables.upsert(spark.createDataFrame(batch, SESSIONS))
        seen.append(rows(tables.funnel.read(), "event_date", "stage_order", "sessions"))
    assert seen[0] == seen[1] == [(first, i, 1) for i in range(1, 6)]


def test_crash_between_sessions_and_counts_is_made_good(spark, monkeypatch):
    first, second = DAY0.date(), (DAY0 + timedelta(days=1)).date()
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
    tables.upsert(spark.createDataFrame([(1, second, "tv", 1), (2, second, "tv", 1)], SESSIONS))
    moved = spark.createDataFrame([(1, first, "tv", 2)], SESSIONS)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(tables.funnel, "replace", crash)
        tables.upsert(moved)
    tables.upsert(moved)
    assert rows(tables.funnel.read(), "event_date", "stage_order", "sessions") == [(first, 1, 1), (first, 2, 1), (second, 1, 1)]
