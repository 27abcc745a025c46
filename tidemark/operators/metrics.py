"""Named business metrics and the one query shape every chart uses."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import ratio

Metric = Callable[[], Column]

# The time grains charts ask for.
GRAINS = {"P1D": "day", "P1W": "week", "P1M": "month"}


@dataclass(frozen=True)
class Dataset:
    time_column: str | None
    metrics: Mapping[str, Metric] = field(default_factory=dict)


def _completed(value: Column) -> Column:
    return F.when(F.col("is_completed"), value)


def _completed_orders() -> Column:
    return F.count(_completed(F.lit(1)))


def _completed_sum(column: str) -> Column:
    return F.sum(_completed(F.col(column)))


def _mean(column: str) -> Column:
    """Average of a decimal column with one rounding, at the end."""
    return ratio(F.sum(column), F.count(column))


DATASETS: dict[str, Dataset] = {
    "orders": Dataset(
        "order_date",
        {
            "revenue": lambda: F.sum(_completed(F.col("net_revenue")).otherwise(0)),
            "orders": _completed_orders,
            "aov": lambda: ratio(_completed_sum("net_revenue"), _completed_orders()),
            "gross_margin_pct": lambda: ratio(
                _completed_sum("gross_margin"), _completed_sum("net_revenue")
            ),
            "active_customers": lambda: F.count_distinct(_completed(F.col("customer_id"))),
            "refund_rate": lambda: F.avg(F.when(F.col("status") == "refunded", 1.0).otherwise(0.0)),
        },
    ),
    "daily": Dataset("order_date", {"mart_revenue": lambda: F.sum("net_revenue")}),
    "funnel": Dataset("event_date", {"sessions": lambda: F.sum("sessions")}),
    "retention": Dataset(None, {"avg_retention": lambda: _mean("retention_rate")}),
    "rfm": Dataset(None, {"customers": lambda: F.count(F.lit(1))}),
    "loads": Dataset(
        "started_at",
        {
            "rows_loaded": lambda: F.coalesce(F.sum("rows_inserted"), F.lit(0).cast("long")),
            "failed_loads": lambda: F.count(F.when(F.col("status") == "failed", 1)),
            "avg_seconds": lambda: _mean("duration_seconds"),
        },
    ),
    "dq": Dataset(
        "checked_at",
        {
            "checks": lambda: F.count(F.lit(1)),
            "failing_checks": lambda: F.count(F.when(F.col("status") == "fail", 1)),
        },
    ),
    "drift": Dataset("detected_at", {"drift_events": lambda: F.count(F.lit(1))}),
}


def metric_query(
    df: DataFrame,
    dataset: str,
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    grain: str | None = None,
    time_range: tuple[str | None, str | None] = (None, None),
    filters: Mapping[str, Sequence] | None = None,
    order_desc: str | None = None,
    row_limit: int | None = None,
) -> DataFrame:
    """Filter, bucket time, group, aggregate, and optionally keep the top rows by one metric.

    ``time_range`` is half-open. With ``grain`` the time column is grouped by the start of its bucket
    (weeks start on Monday). A limit comes with a total order, so it always keeps the same rows.
    """
    spec = DATASETS[dataset]
    start, end = time_range
    if start is not None:
        df = df.filter(F.col(spec.time_column) >= F.lit(start).cast(df.schema[spec.time_column].dataType))
    if end is not None:
        df = df.filter(F.col(spec.time_column) < F.lit(end).cast(df.schema[spec.time_column].dataType))
    for column, allowed in (filters or {}).items():
        df = df.filter(F.col(column).isin(list(allowed)))
    keys: list = list(group_by)
    if grain is not None:
        bucket = F.trunc(F.col(spec.time_column).cast("date"), GRAINS[grain]) if grain != "P1D" else F.col(
            spec.time_column
        ).cast("date")
        keys.insert(0, bucket.alias(spec.time_column))
    out = df.groupBy(*keys).agg(*[spec.metrics[m]().alias(m) for m in metrics])
    if row_limit is not None:
        names = [c for c in out.columns if c not in metrics]
        first = [F.col(order_desc).desc_nulls_first()] if order_desc else []
        out = out.orderBy(*first, *[F.col(n).asc_nulls_last() for n in names]).limit(row_limit)
    elif order_desc:
        out = out.orderBy(F.col(order_desc).desc_nulls_first())
    return out


def with_share(df: DataFrame, metric: str, alias: str) -> DataFrame:
    """Share of each already aggregated row in the total of ``metric``."""
    total = df.agg(F.sum(metric).alias("total"))
    return df.withColumn(alias, ratio(F.col(metric), total.scalar()))
