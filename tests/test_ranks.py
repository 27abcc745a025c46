import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from tidemark.operators import ranks


@pytest.mark.parametrize("n", [1, 3, 5, 7])
@pytest.mark.parametrize("count", [0, 1, 4, 5, 1003])
def test_ntile_equals_window(spark, n, count):
    rng = random.Random(count)
    # A third of all rows share one value.
    data = [(i, 1 if rng.random() < 0.34 else rng.randint(0, 50)) for i in range(count)]
    df = spark.createDataFrame(data, "id long, v long").repartition(4)
    order = [("v", False), ("id", True)]
    tiles = ranks.global_ntile(df, order, n, "tile")
    window = Window.orderBy(F.desc("v"), "id")
    assert rows(tiles) == rows(df.withColumn("tile", F.ntile(n).over(window)))


def test_rank_is_a_dense_position_over_several_partitions(spark):
    df = spark.range(0, 5000, 1, 8).withColumn("v", F.col("id") % 10)
    ranked, total = ranks.global_rank(df, [("v", True), ("id", False)], "pos")
    assert total == 5000
    got = ranked.orderBy("v", F.desc("id")).select("pos").collect()
    assert [r[0] for r in got] == list(range(5000))


def test_nulls_sort_last_ascending_and_first_descending(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "id long, v long")
    up, _ = ranks.global_rank(df, [("v", True)], "pos")
    down, _ = ranks.global_rank(df, [("v", False)], "pos")
    assert rows(up, "id", "pos") == [(1, 2), (2, 1), (3, 0)]
    assert rows(down, "id", "pos") == [(1, 0), (2, 1), (3, 2)]
