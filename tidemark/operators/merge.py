"""Adding only what is new, and replacing only what changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import wall_clock
from tidemark.operators.versions import latest_version


class SchemaMismatchError(RuntimeError):
    """The delta of an incremental model no longer has the columns of its target."""


def _bound(value, dtype) -> Column:
    return wall_clock(value) if dtype.typeName() == "timestamp_ntz" else F.lit(value).cast(dtype)


def extract_range(df: DataFrame, cursor: str, upper, watermark=None, overlap_seconds: int = 0) -> DataFrame:
    """Rows with ``watermark - overlap < cursor <= upper``; everything up to ``upper`` on a first load. An ``upper`` of None is no bound.

    Both bounds are literals on the bare column, so they reach a Parquet or JDBC scan.
    """
    dtype = df.schema[cursor].dataType
    picked = df if upper is None else df.filter(F.col(cursor) <= _bound(upper, dtype))
    if watermark is None:
        return picked
    lower = _bound(watermark, dtype) - F.make_dt_interval(secs=F.lit(overlap_seconds))
    return picked.filter(F.col(cursor) > lower)


def dedupe_batch(staged: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key; of several copies the one with the greatest other columns, so reruns agree."""
    return latest_version(staged, key, [])


#: A batch of up to so many rows is broadcast by its keys; some tens of megabytes with the keys of the specs.
BROADCAST_KEYS = 1_000_000


def new_rows(
    staged: DataFrame, existing: DataFrame | None, key: Sequence[str], staged_rows: int | None = None, *,
    existing_rows: int | None = None, distinct: bool = False,
) -> DataFrame:
    """Staged rows whose key is neither in ``existing`` nor repeated inside the batch. An ``existing`` of None has no rows.

    When ``existing_rows`` is known and small, its keys go to the scan of the batch. Otherwise, when ``staged_rows`` is known and small, the
    batch's keys go to the scan of ``existing``, of which then only rows with such a key travel; else its keys are shuffled.
    A batch that is ``distinct`` has a key once, so its rows need not meet by key.
    """
    fresh = staged if distinct else dedupe_batch(staged, key)
    if existing is None:
        return fresh.select(*staged.columns)
    known = existing.select(*key)
    if existing_rows is not None and existing_rows <= BROADCAST_KEYS:
        known = F.broadcast(known)
    elif staged_rows is not None and staged_rows <= BROADCAST_KEYS:
        known = known.join(F.broadcast(staged.select(*key)), list(key), "left_semi")
    return fresh.join(known, list(key), "left_anti").select(*staged.columns)


def check_same_columns(target: DataFrame, delta: DataFrame) -> None:
    want = [(f.name, f.dataType) for f in target.schema.fields]
    have = [(f.name, f.dataType) for f in delta.schema.fields]
    if want != have:
        raise SchemaMismatchError(f"target has {want}, delta has {have}")


def incremental_merge(existing: DataFrame, delta: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``delta`` swapped in by key; other columns must be the same."""
    check_same_columns(existing, delta)
    kept = existing.join(delta.select(*key), list(key), "left_anti").select(*existing.columns)
    return kept.unionByName(delta)


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: size of both sides and how many rows (with multiplicity) only one of them has.

    Counts each distinct row once per side in a single aggregation, where two ``exceptAll`` would
    shuffle both tables twice.
    """
    columns = left.columns
    tagged = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_row = tagged.groupBy(*columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    zero = F.lit(0).cast("long")
    return per_row.agg(
        F.coalesce(F.sum("_l"), zero).alias("left_rows"),
        F.coalesce(F.sum("_r"), zero).alias("right_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_l") - F.col("_r"), zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("_r") - F.col("_l"), zero)), zero).alias("only_right"),
    )
