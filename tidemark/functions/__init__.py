"""Column expressions shared by the models. Everything here stays in generated JVM code."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.specs import EVENT_TYPES, FUNNEL_STAGES

MONEY = T.DecimalType(20, 2)


def wall_clock(value: datetime | str) -> Column:
    """A ``timestamp_ntz`` literal. Python datetimes go in as text: as they are, they would become zoned
    timestamps and shift with the session time zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def money(col: Column) -> Column:
    return col.cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def email_hash(email: Column) -> Column:
    return F.md5(F.lower(email))


def pipe_key(*parts: Column) -> Column:
    """md5 of the parts as text joined by ``|``; null as soon as one part is null."""
    text = [p.cast("string") for p in parts]
    joined = reduce(lambda left, right: F.concat(left, F.lit("|"), right), text)
    return F.md5(joined)


def month_of(date: Column) -> Column:
    return F.trunc(date, "month")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``, by year and month only."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def funnel_stage(event_type: Column) -> Column:
    """1..5 for a known event type, null for any other."""
    branches = [(event_type == name, n) for n, name in enumerate(EVENT_TYPES, start=1)]
    head, *rest = branches
    return reduce(lambda case, b: case.when(*b), rest, F.when(*head))


def stage_label(stage_order: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in FUNNEL_STAGES]), stage_order)


def rfm_segment(r: Column, f: Column) -> Column:
    """Segment by recency and frequency score; the first rule that holds decides."""
    return (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when(r >= 4, "Recent")
        .when((r <= 2) & (f >= 3), "At risk")
        .otherwise("Needs attention")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds between two wall-clock timestamps, with microseconds; no time zone involved."""
    gap = end - start
    parts = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}
    seconds = [F.date_part(F.lit(p), gap).cast("decimal(18,6)") * F.lit(n) for p, n in parts.items()]
    return reduce(lambda a, b: a + b, seconds).cast("decimal(18,6)")


def utc_instant(ts: Column) -> Column:
    """A UTC wall-clock ``timestamp_ntz`` as the instant it names, in any session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def with_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, other columns untouched: the shape a BI client reads."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
