"""Exact distinct counts that can be rolled up: bitmaps of ids per day, merged into weeks, months or any span."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.metrics import GRAINS


def daily_bitmaps(df: DataFrame, day: str, counted: str, where: Column | None = None, group_by: Sequence[str] = ()) -> DataFrame:
    """One row per day, group and bucket of 32,768 consecutive ids: the ids seen, as bits.

    The ids must be whole numbers; rows without an id or outside ``where`` set no bit. Bits are set on the map side, so
    a day with a third of all rows sends one bitmap per task and bucket. Dense ids need few buckets.
    """
    seen = df.filter(F.col(counted).isNotNull() & (F.lit(True) if where is None else where))
    bucket = F.bitmap_bucket_number(counted).alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(counted)).alias("ids")
    return seen.groupBy(F.col(day).cast("date").alias("day"), *group_by, bucket).agg(bits)


def distinct_by(bitmaps: DataFrame, grain: str | None, alias: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids per span (``P1D``, ``P1W``, ``P1M``, or None for all days) and group, from the bitmaps alone."""
    span = [] if grain is None else [F.trunc("day", GRAINS[grain]).alias("day") if grain != "P1D" else F.col("day")]
    merged = bitmaps.groupBy(*span, *group_by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("_n"))
    keys = [*(["day"] if span else []), *group_by]
    return merged.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(alias))
