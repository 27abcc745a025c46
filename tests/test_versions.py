"""Latest version, type-2 history and point-in-time lookup against brute force, with and without hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import versions
from tidemark.operators.skew import find_hot_keys

DAY0 = datetime(2020, 1, 1)
FIRST, LAST = datetime(1970, 1, 1), datetime(9999, 12, 31)


def random_log(seed, keys=12, count=400):
    """Versions of a few keys; key 1 holds more than a third. (key, ts) is unique."""
    rng = random.Random(seed)
    seen, log = set(), []
    while len(log) < count:
        key = 1 if rng.random() < 0.4 else rng.randint(2, keys)
        ts = DAY0 + timedelta(hours=rng.randint(0, 5000))
        if (key, ts) not in seen:
            seen.add((key, ts))
            log.append((key, ts, rng.choice(["A", "B", None]), rng.choice(["x", "y"])))
    return log


def brute_scd2(log):
    out = []
    for key in sorted({r[0] for r in log}):
        kept, last = [], object()
        for _, ts, a, b in sorted((r for r in log if r[0] == key), key=lambda r: r[1]):
            if (a, b) != last:
                kept.append((ts, a, b))
                last = (a, b)
        for i, (ts, a, b) in enumerate(kept):
            end = kept[i + 1][0] if i + 1 < len(kept) else LAST
            out.append((key, a, b, FIRST if i == 0 else ts, end, i + 1 == len(kept), i + 1))
    return sorted(out, key=repr)


def log_frame(spark, log):
    return spark.createDataFrame(log, "k long, ts timestamp_ntz, a string, b string")


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_equals_brute_force(spark, hot_rows, seed):
    log = random_log(seed)
    history = versions.scd2(log_frame(spark, log), "k", "ts", ["a", "b"], hot_rows)
    assert rows(history) == brute_scd2(log)


def test_hot_keys_are_found_and_cut(spark):
    df = log_frame(spark, random_log(3))
    assert find_hot_keys(df, "k", "ts") is None
    hot = find_hot_keys(df, "k", "ts", hot_rows=60)
    tagged = hot.tag(df)
    assert rows(tagged.filter("_hot").select("k").distinct()) == [(1,)]
    assert tagged.filter("NOT _hot").filter("_chunk <> 0").isEmpty()
    # Chunks are consecutive in time.
    spans = tagged.filter("_hot").groupBy("_chunk").agg(F.min("ts"), F.max("ts")).orderBy("_chunk").collect()
    assert len(spans) > 1
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def brute_asof(facts, history):
    out = []
    for fid, key, ts in facts:
        hits = [h for h in history if h[0] == key and h[3] <= ts < h[4]] if key is not None else []
        assert len(hits) <= 1
        out.append((fid, key, ts, *(hits[0][1:3] if hits else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("path", ["broadcast", "scan", "scan with hot keys"])
def test_asof_join_equals_brute_force(spark, path):
    log = random_log(4)
    history = brute_scd2(log)
    # A gap, and a history that starts late, must give nulls.
    history = [h for h in history if not (h[0] == 3 and h[6] == 2) and not (h[0] == 4 and h[6] == 1)]
    rng = random.Random(5)
    facts = [
        (i, rng.choice([1, 1, 1, 2, 3, 4, 99, None]), DAY0 + timedelta(hours=rng.randint(-50, 5100)))
        for i in range(500)
    ]
    facts += [(1000 + i, h[0], max(h[3], DAY0)) for i, h in enumerate(history)]  # exactly at the start
    options = {
        "broadcast": {"max_versions": 10_000},
        "scan": {"max_bytes": 0},
        "scan with hot keys": {"max_bytes": 0, "hot_rows": 40},
    }[path]
    joined = versions.asof_join(
        spark.createDataFrame(facts, "f long, k long, ts timestamp_ntz"),
        spark.createDataFrame(
            history,
            "k long, a string, b string, valid_from timestamp_ntz, valid_to timestamp_ntz, c boolean, n long",
        ),
        "k",
        "ts",
        ["a", "b"],
        **options,
    )
    assert rows(joined, "f", "k", "ts", "a", "b") == brute_asof(facts, history)


def test_large_or_deep_history_is_not_broadcast(spark):
    history = versions.scd2(log_frame(spark, random_log(6)), "k", "ts", ["a", "b"])
    size = versions.measure(history, "k")
    assert size.rows == history.count()
    assert not size.broadcastable(max_bytes=10)
    assert not size.broadcastable(max_group=1)
    assert size.broadcastable()
    facts = spark.createDataFrame([(1, 1, DAY0)], "f long, k long, ts timestamp_ntz")

    def plan(**options):
        joined = versions.asof_join(facts, history, "k", "ts", ["a"], **options)
        return joined._jdf.queryExecution().toString()

    assert "strategy=broadcast" in plan(max_versions=1_000)
    assert "strategy=broadcast" not in plan(max_bytes=10)


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_history_gaps(spark, hot_rows):
    history = versions.scd2(log_frame(spark, random_log(7)), "k", "ts", ["a", "b"])
    assert versions.history_gaps(history, "k", hot_rows).isEmpty()
    broken = history.filter(~((F.col("k") == 1) & (F.col("version_number") == 30)))
    assert rows(versions.history_gaps(broken, "k", hot_rows)) == [(1,)]


def test_latest_version_and_ties(spark):
    log = [(1, 1, "a"), (1, 3, "c"), (1, 2, "z"), (2, 5, "p"), (2, 5, "q"), (3, 1, None)]
    df = spark.createDataFrame(log, "k long, t long, v string")
    assert rows(versions.latest_version(df, ["k"], ["t"])) == [(1, 3, "c"), (2, 5, "q"), (3, 1, None)]
    assert rows(versions.distinct_on(df, ["k"], ["t"], ["v"])) == [("c",), ("q",), (None,)]


def test_latest_version_combines_before_the_shuffle(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr("0L AS k", "id AS t", "id AS v")
    latest = versions.latest_version(df, ["k"], ["t"])
    assert "partial_max" in latest._jdf.queryExecution().executedPlan().toString()
    assert rows(latest) == [(0, 19_999, 19_999)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_both_asof_paths_agree_on_odd_periods(spark, hot_rows):
    """Overlaps, gaps, periods of no length and periods that begin together."""
    at = lambda d: DAY0 + timedelta(days=d)
    periods = [
        (1, "a", at(1), at(10)), (1, "b", at(3), at(5)), (1, "c", at(12), at(12)), (1, "d", at(20), at(22)), (1, "e", at(20), at(25)),
        (2, "f", at(0), at(9)), (2, "g", at(9), at(9)), (2, "h", at(9), at(30)), (None, "n", at(0), at(40)),
    ]
    facts = [(i, k, at(d)) for i, (k, d) in enumerate((k, d) for k in (1, 2, 3, None) for d in range(28))]

    def expected(k, ts):
        begun = [p for p in periods if k is not None and p[0] == k and p[2] <= ts]
        last = max(begun, key=lambda p: (p[2], p[3]), default=None)
        return last[1] if last and ts < last[3] else None

    left = spark.createDataFrame(facts, "f long, k long, ts timestamp_ntz")
    right = spark.createDataFrame(periods, "k long, a string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    want = sorted(((f, expected(k, ts)) for f, k, ts in facts), key=repr)
    for max_bytes in (versions.BROADCAST_BYTES, 0):
        got = versions.asof_join(left, right, "k", "ts", ["a"], max_bytes=max_bytes, hot_rows=hot_rows)
        assert rows(got, "f", "a") == want


def test_hot_null_key_is_split(spark):
    df = spark.createDataFrame([(None, DAY0 + timedelta(hours=i), "x") for i in range(200)] + [(1, DAY0, "y")], "k long, ts timestamp_ntz, a string")
    hot = find_hot_keys(df, "k", "ts", hot_rows=60)
    assert rows(hot.splits, "k") == [(None,)]
    same = lambda n: rows(versions.scd2(df, "k", "ts", ["a"], hot_rows=n), "k", "valid_from", "version_number", "is_current")
    assert same(60) == same(1_000_000)


D1, D2, D3 = (DAY0 + timedelta(days=n) for n in range(3))


def test_asof_scan_takes_points_from_a_cheaper_frame(spark):
    history = spark.createDataFrame([(1, D1, D2, "a"), (1, D2, D3, "b"), (2, D1, D2, "c")], "k long, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    facts = spark.createDataFrame([(1, D1), (1, D1), (1, D2), (1, D3), (2, D2), (None, D1)], "k long, ts timestamp_ntz")
    points = facts.union(spark.createDataFrame([(2, D1), (7, D1)], facts.schema))
    want = rows(versions.asof_join(facts, history, "k", "ts", ["v"]))
    for hot_rows in (1, 1000):
        got = versions.asof_join(facts, history, "k", "ts", ["v"], max_bytes=0, hot_rows=hot_rows, points=points)
        assert rows(got) == want == sorted([(1, D1, "a"), (1, D1, "a"), (1, D2, "b"), (1, D3, None), (2, D2, None), (None, D1, None)], key=repr)
