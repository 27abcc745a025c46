"""Counts taken while writing, bitmaps that roll up, and checksums that lead to the keys that differ."""

from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.assertions import DataTest, RowCounts, row_test, run_tests
from tidemark.operators.bitmaps import daily_bitmaps, distinct_by
from tidemark.plans import reconcile
from tidemark.plans.reconcile import Loaded
from tidemark.session import scratch_path
from tidemark.sources.tables import SnapshotTable
from tidemark.specs import ORDERS


def test_row_counts_of_a_write(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "z"), (None, None)], "id long, v string").repartition(3)
    tests = {"no id": F.col("id").isNull(), "no v": F.col("v").isNull(), "big": F.col("id") > 5}
    counts = RowCounts(tests)
    written = SnapshotTable(spark, scratch_path(spark, "t")).write(counts.attach(df))
    assert counts.get() == {"no id": 2, "no v": 2, "big": 0} and written.columns == df.columns
    observed = counts.get()
    scanned = rows(run_tests([row_test(k, df, c) for k, c in tests.items()]))
    known = [row_test(k, df.filter(F.raise_error(F.lit("scanned")).isNull()), c, observed=observed[k]) for k, c in tests.items()]
    assert rows(run_tests(known)) == scanned  # without reading the model
    mixed = run_tests([*known[:1], row_test("no v", df, tests["no v"]), DataTest("two", df.limit(2), "warn")])
    assert rows(mixed, "test", "violations", "verdict") == [("no id", 2, "fail"), ("no v", 2, "fail"), ("two", 2, "warn")]


def test_row_counts_of_an_empty_model(spark):
    df = spark.createDataFrame([], "id long")
    counts = RowCounts({"no id": F.col("id").isNull()})
    SnapshotTable(spark, scratch_path(spark, "t")).write(counts.attach(df))
    assert counts.get() in ({"no id": 0}, {})


def test_bitmaps_roll_up_exactly(spark):
    day0 = date(2024, 1, 1)
    data = [(day0 + timedelta(days=i % 40), (i * 7919) % 100_003 - 50, "ab"[i % 2], i % 5 != 0) for i in range(4000)]
    data += [(day0, None, "a", True), (None, 5, "a", True), (day0, 2**40 + 3, None, True)]
    df = spark.createDataFrame(data, "d date, c long, g string, ok boolean").repartition(5)
    bitmaps = daily_bitmaps(df, "d", "c", F.col("ok"), ["g"])
    kept = df.filter("ok and c is not null")
    for grain, unit in (("P1D", "day"), ("P1W", "week"), ("P1M", "month")):
        want = kept.groupBy(F.trunc("d", unit).alias("day") if unit != "day" else F.col("d").alias("day"), "g").agg(F.count_distinct("c").alias("n"))
        assert rows(distinct_by(bitmaps, grain, "n", ["g"])) == rows(want)
    assert distinct_by(bitmaps, None, "n").first().n == kept.select("c").distinct().count()
    assert distinct_by(bitmaps.limit(0), None, "n").first().n == 0


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


@pytest.mark.parametrize("fanout, depth", [(4, 1), (4, 4), (64, 3)])
def test_differing_keys_are_found(spark, fanout, depth):
    source = [None, *range(500)]
    raw = [None, *(k + (k == 7) - (k == 301) for k in range(500) if k != 40), 40, 40, -9]  # 7 -> 8, 301 -> 300: the sum agrees but for -9
    found = reconcile.key_differences(keys(spark, source), keys(spark, raw), "k", fanout, depth)
    assert rows(found) == [(-9, "raw"), (301, "source"), (7, "source")]
    assert rows(reconcile.key_differences(keys(spark, source), keys(spark, source * 2), "k", fanout, depth)) == []
    assert rows(reconcile.key_differences(keys(spark, []), keys(spark, [None]), "k", fanout, depth)) == [(None, "raw")]


def test_sums_that_agree_by_accident_fail(spark):
    from datetime import datetime

    at = datetime(2024, 1, 1)

    def orders(ids):
        return spark.createDataFrame([(i, 1, at, "pending", None, None, at, at) for i in ids], ORDERS.schema)

    verdicts = {r.check_name: r for r in reconcile.parity(Loaded(ORDERS, orders([1, 5, 9]), orders([2, 4, 9]), at)).collect()}
    assert verdicts["rowcount_parity"].expected == verdicts["rowcount_parity"].actual == "3 keys, checksum 15"
    assert verdicts["rowcount_parity"].status == "fail"
