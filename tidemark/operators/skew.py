"""Ordered work inside a key when one key may hold a large share of all rows.

A window partitioned by a key sends all rows of that key to one task. That is right while every key
is small. When a probe finds keys above a limit, their rows are cut into consecutive time chunks at
fixed split points, the windows run per (key, chunk), and the few values that cross a chunk border are
looked up in a table with one row per hot chunk. Results are the same on both paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import checkpointed

# A key is hot above this many rows, whatever the size of the data; its chunks have about as many. So the split points are
# one per this many rows at most: the planner broadcasts their table while it is small and shuffles it otherwise.
HOT_ROWS = 1_000_000
SAMPLES_PER_CHUNK = 20

CHUNK = "_chunk"
_SPLITS = "_splits"


@dataclass(frozen=True)
class HotKeys:
    """Split points of the hot keys: (key, [t1 < t2 < ...]), a row per hot key."""

    key: str
    order: str
    splits: DataFrame

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the chunk number of each row; rows of other keys are all in chunk 0."""
        order = F.col(self.order)
        chunk = F.size(F.filter(F.col(_SPLITS), lambda s: s <= order))
        return (
            _left_join(df, self.splits, self.key)
            .withColumn(CHUNK, F.when(F.col(_SPLITS).isNull(), F.lit(0)).otherwise(chunk))
            .withColumn("_hot", F.col(_SPLITS).isNotNull())
            .drop(_SPLITS)
        )


def find_hot_keys(
    df: DataFrame, key: str, order: str, hot_rows: int = HOT_ROWS, seed: int = 7
) -> HotKeys | None:
    """Probe the key counts (partially aggregated before the shuffle); None when no key is hot.

    Rows with a null key count as one key. The split points are made and kept as a table, one value per chunk.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if (counts.agg(F.max("_n")).first()[0] or 0) <= hot_rows:
        return None
    hot = checkpointed(counts.filter(F.col("_n") > hot_rows).select(F.col(key).alias("_hot_key")))
    sampled = df.select(key, order).join(hot, F.col(key).eqNullSafe(F.col("_hot_key")), "left_semi")
    sampled = sampled.sample(min(1.0, SAMPLES_PER_CHUNK / hot_rows), seed=seed)
    points = F.array_sort(F.collect_set(order))
    every = F.filter(points, lambda _, i: (i + 1) % SAMPLES_PER_CHUNK == 0)
    # A key without sampled rows has no split; it is one chunk.
    return HotKeys(key, order, checkpointed(sampled.groupBy(key).agg(every.alias(_SPLITS))))


def _left_join(df: DataFrame, small: DataFrame, *keys: str) -> DataFrame:
    """Left join on keys that may be null."""
    named = small.withColumnsRenamed({k: f"_{k}_of_small" for k in keys})
    same = [df[k].eqNullSafe(named[f"_{k}_of_small"]) for k in keys]
    return df.join(named, same, "left").drop(*[f"_{k}_of_small" for k in keys])


def _edges(df: DataFrame, key: str, **aggs: Column) -> DataFrame:
    """One row per hot (key, chunk)."""
    return df.filter("_hot").groupBy(key, CHUNK).agg(*[c.alias(a) for a, c in aggs.items()])


class OrderedKey:
    """lag, lead and row_number by ``order`` within ``key``, safe for hot keys.

    ``df`` must come from :meth:`prepare`, and (key, order) must be unique.
    """

    def __init__(self, key: str, order: str, hot: HotKeys | None = None):
        self.key, self.order, self.hot = key, order, hot
        parts = [key] if hot is None else [key, CHUNK]
        self._window = Window.partitionBy(*parts).orderBy(order)
        self._chunks = Window.partitionBy(key).orderBy(CHUNK)

    def prepare(self, df: DataFrame) -> DataFrame:
        return df if self.hot is None else self.hot.tag(df)

    def finish(self, df: DataFrame) -> DataFrame:
        return df if self.hot is None else df.drop(CHUNK, "_hot")

    def previous(self, df: DataFrame, value: Column, alias: str) -> DataFrame:
        """``struct(v)`` of the preceding row, or a null struct on the first row of the key."""
        return self._neighbour(df, value, alias, F.lag, F.max_by, F.lag)

    def next(self, df: DataFrame, value: Column, alias: str) -> DataFrame:
        """``struct(v)`` of the following row, or a null struct on the last row of the key."""
        return self._neighbour(df, value, alias, F.lead, F.min_by, F.lead)

    def _neighbour(self, df, value, alias, inside, edge, across) -> DataFrame:
        boxed = F.struct(value.alias("v"))
        out = df.withColumn(alias, inside(boxed).over(self._window))
        if self.hot is None:
            return out
        edges = _edges(df, self.key, _edge=edge(boxed, F.col(self.order))).select(
            self.key, CHUNK, across("_edge").over(self._chunks).alias("_carry")
        )
        return (
            _left_join(out, edges, self.key, CHUNK)
            .withColumn(alias, F.coalesce(F.col(alias), F.col("_carry")))
            .drop("_carry")
        )

    def number(self, df: DataFrame, alias: str) -> DataFrame:
        """1-based row number within the key."""
        out = df.withColumn(alias, F.row_number().over(self._window).cast("long"))
        if self.hot is None:
            return out
        before = self._chunks.rowsBetween(Window.unboundedPreceding, -1)
        edges = _edges(df, self.key, _n=F.count(F.lit(1))).select(
            self.key, CHUNK, F.sum("_n").over(before).alias("_offset")
        )
        return (
            _left_join(out, edges, self.key, CHUNK)
            .withColumn(alias, F.col(alias) + F.coalesce(F.col("_offset"), F.lit(0)))
            .drop("_offset")
        )

    def last_seen(self, df: DataFrame, value: Column, alias: str) -> DataFrame:
        """The newest non-null ``value`` at or before each row."""
        upto = self._window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = df.withColumn(alias, F.last(value, ignorenulls=True).over(upto))
        if self.hot is None:
            return out
        before = self._chunks.rowsBetween(Window.unboundedPreceding, -1)
        newest = F.max_by(value, F.when(value.isNotNull(), F.col(self.order)))
        edges = _edges(df, self.key, _newest=newest).select(
            self.key, CHUNK, F.last("_newest", ignorenulls=True).over(before).alias("_carry")
        )
        return (
            _left_join(out, edges, self.key, CHUNK)
            .withColumn(alias, F.coalesce(F.col(alias), F.col("_carry")))
            .drop("_carry")
        )
