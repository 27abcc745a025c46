"""Current state, type-2 history and point-in-time lookup from a log of row versions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.operators.skew import HOT_ROWS, OrderedKey, find_hot_keys
from tidemark.session import stored

# The open ends of a history.
BEGINNING = "1970-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"

# A history is broadcast only when measured to be below both limits.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_VERSIONS_PER_KEY = 64


def latest_version(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest`` columns per key; remaining columns break ties.

    ``max(struct)`` aggregates on the map side, so of a key with many versions each task ships one row.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    best = F.max(F.struct(*newest, *rest)).alias("_row")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest row per key with only the listed columns, read no wider than needed."""
    needed = list(dict.fromkeys([*keys, *order, *columns]))
    return latest_version(df.select(*needed), keys, order).select(*columns)


def scd2(
    df: DataFrame, key: str, ts: str, tracked: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per period in which the tracked columns stayed the same.

    The first period starts at 1970 and the open one ends in 9999. ``(key, ts)`` must be unique.
    """
    versions = df.select(key, *tracked, ts)
    ordered = OrderedKey(key, ts, find_hot_keys(versions, key, ts, hot_rows))
    state = F.struct(*tracked)
    seen = ordered.previous(ordered.prepare(versions), state, "_prev")
    changes = seen.filter(
        F.col("_prev").isNull() | ~F.col("_prev.v").eqNullSafe(state)
    ).withColumn("_first", F.col("_prev").isNull()).drop("_prev")
    out = ordered.next(changes, F.col(ts), "_next")
    out = ordered.number(out, "version_number")
    ts_type = df.schema[ts].dataType
    return out.select(
        key,
        *tracked,
        F.when(F.col("_first"), F.lit(BEGINNING).cast(ts_type)).otherwise(F.col(ts)).alias("valid_from"),
        F.coalesce(F.col("_next.v"), F.lit(END_OF_TIME).cast(ts_type)).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        "version_number",
    )


def history_gaps(
    history: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys whose next period does not start where the last one ended, once per gap."""
    periods = history.select(key, "valid_from", "valid_to")
    ordered = OrderedKey(key, "valid_from", find_hot_keys(periods, key, "valid_from", hot_rows))
    out = ordered.next(ordered.prepare(periods), F.col("valid_from"), "_next")
    return out.filter(F.col("_next.v") != F.col("valid_to")).select(key)


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int
    largest_group: int

    def broadcastable(self, max_bytes: int = BROADCAST_BYTES, max_group: int | None = None) -> bool:
        return self.bytes <= max_bytes and (max_group is None or self.largest_group <= max_group)


def measure(df: DataFrame, key: str) -> SideSize:
    """Row count, an upper estimate of the in-memory bytes, and the largest key group; one job."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = 16 * len(df.columns) + 16
    width = F.lit(fixed)
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b"))
    n, b, g = per_key.agg(F.sum("n"), F.sum("b"), F.max("n")).first()
    return SideSize(n or 0, b or 0, g or 0)


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
    max_versions: int = BROADCAST_VERSIONS_PER_KEY,
    hot_rows: int = HOT_ROWS,
    points: DataFrame | None = None,
) -> DataFrame:
    """Left join each fact to the newest period that began at or before ``ts``, if it still runs then.

    So a fact meets at most one period: where periods overlap the later one counts, also after its end; in a gap, and
    after a period of no length, there is none. Of periods that begin together the one that ends last counts. A history
    measured to be small, with few periods per key, is broadcast and the facts are not shuffled. Any other
    history is resolved for the distinct (key, ts) points by one ordered pass per key, which is linear in points plus
    periods, and the facts join the result on both columns, so a busy key spreads over its timestamps. Both ways
    give the same rows; the size only picks the plan.

    ``points`` has the key and instant of every fact, where a frame that costs less than the facts does; others in it do no harm.
    """
    # The history is built once, then measured and joined from its stored copy.
    periods = stored(history.select(key, "valid_from", "valid_to", *attributes), "history")
    if measure(periods, key).broadcastable(max_bytes, max_versions):
        h = F.broadcast(_without_overlaps(periods, key, attributes).withColumnRenamed(key, "_key"))
        inside = (
            (F.col(key) == F.col("_key"))
            & (F.col(ts) >= F.col("valid_from"))
            & (F.col(ts) < F.col("valid_to"))
        )
        return facts.join(h, inside, "left").drop("_key", "valid_from", "valid_to")
    return _asof_scan(facts, periods, key, ts, attributes, hot_rows, facts if points is None else points)


def _without_overlaps(periods: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One period per beginning, ended where the next one begins. For small histories."""
    newest = F.max(F.struct("valid_to", *attributes)).alias("_period")
    single = periods.groupBy(key, "valid_from").agg(newest)
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    ends = F.least(F.col("_period.valid_to"), following)
    return single.select(key, "valid_from", ends.alias("valid_to"), *[F.col(f"_period.{a}").alias(a) for a in attributes])


def _asof_scan(facts, periods, key, ts, attributes, hot_rows, points) -> DataFrame:
    period = F.struct("valid_to", *attributes)
    points = points.select(key, F.col(ts).alias("_at")).filter(F.col(key).isNotNull())
    marks = periods.select(key, F.col("valid_from").alias("_at"), period.alias("_period"))
    # One row per (key, instant): equal points, and a point and a period that start together, merge into one.
    empty = F.lit(None).cast(marks.schema["_period"].dataType)
    both = points.select(key, "_at", empty.alias("_period"), F.lit(True).alias("_asked")).unionByName(marks.withColumn("_asked", F.lit(False)))
    # Probed with repeats, which only makes more keys hot, and needs no exchange of the points.
    hot = find_hot_keys(both.select(key, "_at"), key, "_at", hot_rows)
    placed = both.repartition(key) if hot is None else both  # then one exchange serves the grouping and the windows
    timeline = placed.groupBy(key, "_at").agg(F.max("_period").alias("_period"), F.max("_asked").alias("_asked"))
    ordered = OrderedKey(key, "_at", hot)
    seen = ordered.last_seen(ordered.prepare(timeline), F.col("_period"), "_found")
    alive = F.col("_at") < F.col("_found.valid_to")
    answers = ordered.finish(seen).filter("_asked").select(
        key,
        F.col("_at").alias(ts),
        *[F.when(alive, F.col(f"_found.{a}")).alias(a) for a in attributes],
    )
    return facts.join(answers, [key, ts], "left").select(*facts.columns, *attributes)
