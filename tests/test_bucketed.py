"""Merges into a bucketed table: bucket to bucket, partitions taken from the delta."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.merge import SchemaMismatchError
from tidemark.session import scratch_path
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.tables import list_names

SCHEMA = "id long, month string, v long"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def table(spark):
    made = BucketedTable(spark, scratch_path(spark, "b"), F.col("month"), frame(spark, []).schema, "id", buckets=4)
    made.overwrite(frame(spark, [(i, f"2024-0{i % 3 + 1}", i) for i in range(300)] + [(999, None, 1)]))
    return made


def plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[0]


def test_merge_exchanges_the_delta_only(spark, table):
    delta = frame(spark, [(3, "2024-01", -3), (1000, "2024-01", 7), (4, "2024-02", -4)])
    text = plan(table.merge_plan(delta, ["2024-01", "2024-02"]))
    assert len(re.findall(r"Exchange hashpartitioning\(_is", text)) == 1 == len(re.findall(r"\bExchange\b", text))
    assert "Bucketed: true" in text and "2024-03" not in re.sub(r"PartitionFilters[^]]*]", "", text)


def test_merge_swaps_by_key_and_keeps_untouched_files(spark, table):
    before = table.partitions()
    assert set(before) == {"2024-01", "2024-02", "2024-03", "none"}
    delta = frame(spark, [(3, "2024-01", -3), (1000, "2024-01", 7), (1001, "2024-09", 9), (999, None, 2)])
    assert table.merge(delta, ["id"]) == ["2024-01", "2024-09", "none"]
    after = table.partitions()
    assert after["2024-02"] == before["2024-02"] and after["2024-01"] > before["2024-01"]
    want = [(i, f"2024-0{i % 3 + 1}", i) for i in range(300) if i != 3] + [(3, "2024-01", -3), (1000, "2024-01", 7), (1001, "2024-09", 9), (999, None, 2)]
    assert rows(table.read()) == sorted(want, key=repr)
    assert rows(table.read(["2024-09"])) == [(1001, "2024-09", 9)] and rows(table.read([])) == []
    # A file per bucket and partition, and what a reader of the state before still needs.
    assert 0 < len(list_names(spark, f"{table.path}/data/_version={after['2024-01']}/_part=2024-01/*.parquet")) <= 4
    assert table.merge(frame(spark, []), ["id"]) == []
    assert not [t.name for t in spark.catalog.listTables() if "_write_" in t.name]


def test_readers_keep_their_state_while_a_merge_commits(spark, table):
    held = table.read()
    table.merge(frame(spark, [(3, "2024-01", -3)]), ["id"])
    assert rows(held.filter("id = 3"), "v") == [(3,)] and rows(table.read().filter("id = 3"), "v") == [(-3,)]


def test_first_merge_builds_and_errors_change_nothing(spark, table):
    fresh = BucketedTable(spark, scratch_path(spark, "b"), F.col("month"), frame(spark, []).schema, "id")
    assert rows(fresh.read()) == []
    assert fresh.merge(frame(spark, [(1, "2024-01", 1)]), ["id"]) == ["2024-01"]
    assert rows(fresh.read()) == [(1, "2024-01", 1)]
    with pytest.raises(SchemaMismatchError):
        table.merge(frame(spark, [(3, "2024-01", 1)]).withColumn("extra", F.lit(1)), ["id"])
    with pytest.raises(ValueError):
        table.merge(frame(spark, [(3, "2024-01", 1)]), ["month"])
    assert table.read().count() == 301


def test_buckets_follow_the_rows(spark):
    def open_table():
        return BucketedTable(spark, path, F.col("month"), frame(spark, []).schema, "id", buckets=2, bucket_rows=100)

    path = scratch_path(spark, "b")
    data = [(i, f"2024-0{i % 3 + 1}", i) for i in range(620)]
    open_table().overwrite(frame(spark, data[:300]), 300)
    table = open_table()
    assert table.read().count() == 300 and table.buckets == 3
    assert table.merge(frame(spark, [(3, "2024-01", -3)]), ["id"]) == ["2024-01"] and table.buckets == 3
    held = table.read()
    # Twice the rows that a bucket should have, and more: all partitions are bucketed anew.
    table.merge(frame(spark, [r for r in data if r[0] >= 300]), ["id"])
    assert open_table().partitions().keys() == table.partitions().keys() and table.buckets == 7
    assert held.count() == 300
    assert rows(open_table().read()) == rows(frame(spark, [(3, "2024-01", -3), *(r for r in data if r[0] != 3)]))
    delta = frame(spark, [(4, "2024-02", -4)])
    text = plan(table.merge_plan(delta, ["2024-02"]))
    assert "SelectedBucketsCount: 7 out of 7" in text and len(re.findall(r"\bExchange\b", text)) == 1
    assert table.merge(delta, ["id"]) == ["2024-02"] and rows(open_table().read().filter("id = 4"), "v") == [(-4,)]
