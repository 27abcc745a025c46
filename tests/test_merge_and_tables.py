import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.session import scratch_path
from tidemark.sources.tables import PartitionedTable, SnapshotTable, list_names


def frame(spark, data):
    return spark.createDataFrame(data, "id long, month string, v long")


def test_extract_bounds(spark):
    df = spark.createDataFrame(
        [(i, f"2024-01-01 0{i}:00:00") for i in range(6)], "id long, t string"
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))

    def ids(**kw):
        return rows(merge.extract_range(df, "t", "2024-01-01 04:00:00", **kw), "id")

    assert ids() == [(0,), (1,), (2,), (3,), (4,)]
    # Strict below, inclusive above.
    assert ids(watermark="2024-01-01 02:00:00") == [(3,), (4,)]
    assert ids(watermark="2024-01-01 02:00:00", overlap_seconds=3600) == [(2,), (3,), (4,)]


def test_new_rows_ignores_known_and_repeated_keys(spark):
    existing = frame(spark, [(1, "a", 10)])
    staged = frame(spark, [(1, "a", 99), (2, "a", 1), (2, "a", 2), (2, "a", 2), (2, "b", 7)])
    assert rows(merge.new_rows(staged, existing, ["id", "month"])) == [(2, "a", 2), (2, "b", 7)]


def test_small_batch_filters_the_known_rows_before_they_travel(spark):
    path = scratch_path(spark, "raw")
    frame(spark, [(i, "a", i) for i in range(5000)]).write.parquet(path)
    existing = spark.read.parquet(path)
    staged = frame(spark, [(1, "a", 99), (7000, "a", 1), (7000, "a", 2), (3, "b", 5)])
    few, many = merge.new_rows(staged, existing, ["id", "month"], 4), merge.new_rows(staged, existing, ["id", "month"], merge.BROADCAST_KEYS + 1)
    assert rows(few) == rows(many) == [(3, "b", 5), (7000, "a", 2)]
    plan = few._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("LeftSemi") == 1 and "BroadcastHashJoin" in plan
    assert "LeftSemi" not in many._jdf.queryExecution().sparkPlan().toString()


def test_incremental_merge_replaces_by_key(spark):
    before = frame(spark, [(1, "a", 1), (2, "a", 2), (2, "b", 3)])
    delta = frame(spark, [(2, "c", 9), (5, "a", 5)])
    assert rows(merge.incremental_merge(before, delta, ["id"])) == [(1, "a", 1), (2, "c", 9), (5, "a", 5)]
    with pytest.raises(merge.SchemaMismatchError):
        merge.incremental_merge(before, delta.withColumn("v", F.col("v").cast("int")), ["id"])
    with pytest.raises(merge.SchemaMismatchError):
        merge.incremental_merge(before, delta.withColumn("extra", F.lit(1)), ["id"])


def test_table_difference_counts_copies(spark):
    left = frame(spark, [(1, "a", 1), (1, "a", 1), (2, None, 2)])
    right = frame(spark, [(1, "a", 1), (2, None, 2), (3, "x", 3)])
    assert rows(merge.table_difference(left, right)) == [(3, 3, 1, 1)]
    assert rows(merge.table_difference(left, left)) == [(3, 3, 0, 0)]
    empty = left.filter(F.lit(False))
    assert rows(merge.table_difference(empty, empty)) == [(0, 0, 0, 0)]


def test_snapshot_switches_versions_and_ignores_unfinished_ones(spark):
    table = SnapshotTable(spark, scratch_path(spark, "t"))
    assert not table.exists()
    table.write(frame(spark, [(1, "a", 1)]))
    table.write(table.read().withColumn("v", F.col("v") + 1))  # reads the version it replaces
    assert rows(table.read()) == [(1, "a", 2)]
    # A write that dies leaves a folder without its marker.
    frame(spark, [(9, "z", 9)]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.path}/v=3"
    )
    assert rows(table.read()) == [(1, "a", 2)]
    table.write(frame(spark, [(4, "d", 4)]))
    assert table.version() == 4 and rows(table.read()) == [(4, "d", 4)]


def test_partitioned_merge_rewrites_only_touched_partitions(spark):
    table = PartitionedTable(spark, scratch_path(spark, "p"), F.col("month"), frame(spark, []).schema)
    assert not table.exists()
    table.merge(frame(spark, [(1, "2024-01", 1), (2, "2024-01", 2), (3, "2024-02", 3), (4, "2024-03", 4)]), ["id"])
    before = table.partitions()
    # 3 moves from the second month to the first, which leaves the second empty.
    touched = table.merge(frame(spark, [(3, "2024-01", 30), (5, None, 5)]), ["id"])
    assert sorted(touched) == ["2024-01", "2024-02", "none"]
    after = table.partitions()
    assert after["2024-03"] == before["2024-03"]
    assert "2024-02" not in after
    assert rows(table.read()) == [
        (1, "2024-01", 1), (2, "2024-01", 2), (3, "2024-01", 30), (4, "2024-03", 4), (5, None, 5),
    ]
    assert rows(table.read(["2024-03"])) == [(4, "2024-03", 4)]
    assert rows(table.read([])) == []
    assert table.merge(frame(spark, []), ["id"]) == []
    # Files of the untouched month were not written again.
    assert len(list_names(spark, f"{table.path}/data/_version=*/_part=2024-03")) == 1
