"""The queries behind the two dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.metrics import metric_query, with_share

ORDER_KPIS = ("revenue", "orders", "aov", "gross_margin_pct", "active_customers", "refund_rate")
TABLE_ROWS = 200  # what the table charts of the two dashboards show
LOAD_COLUMNS = (
    "batch_id", "table_name", "status", "started_at", "rows_extracted", "rows_inserted", "duration_seconds", "error",
)
DRIFT_COLUMNS = ("detected_at", "table_name", "kind", "column_name", "severity", "detail")


def kpi_overview(orders: DataFrame, **query) -> DataFrame:
    return metric_query(orders, "orders", ORDER_KPIS, **query)


def weekly_channel_revenue(daily: DataFrame, channels: Sequence[str] | None = None) -> DataFrame:
    filters = {"channel": channels} if channels else None
    return metric_query(daily, "daily", ["mart_revenue"], ["channel"], grain="P1W", filters=filters)


def web_funnel(funnel: DataFrame) -> DataFrame:
    return metric_query(funnel, "funnel", ["sessions"], ["stage"], order_desc="sessions")


def retention_heatmap(retention: DataFrame) -> DataFrame:
    return metric_query(retention, "retention", ["avg_retention"], ["months_since_signup", "cohort_month"])


def customers_by_segment(rfm: DataFrame) -> DataFrame:
    return with_share(metric_query(rfm, "rfm", ["customers"], ["rfm_segment"]), "customers", "share")


def country_segment_table(orders: DataFrame, limit: int | None = None) -> DataFrame:
    metrics = ["revenue", "orders", "aov", "gross_margin_pct", "refund_rate"]
    return metric_query(
        orders, "orders", metrics, ["country", "segment"], order_desc="revenue", row_limit=limit
    )


def rows_loaded_per_day(audit: DataFrame) -> DataFrame:
    return metric_query(audit, "loads", ["rows_loaded"], ["table_name"], grain="P1D")


def checks_by_status_per_day(results: DataFrame) -> DataFrame:
    return metric_query(results, "dq", ["checks"], ["status"], grain="P1D")


def recent_loads(audit: DataFrame, tables: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    picked = audit.filter(F.col("table_name").isin(list(tables))) if tables else audit
    newest = picked.select(*LOAD_COLUMNS).orderBy(F.desc("batch_id"))
    return newest if limit is None else newest.limit(limit)


def drift_log(drift: DataFrame, limit: int | None = None) -> DataFrame:
    order = [F.desc("detected_at"), "table_name", "column_name", "kind"]
    newest = drift.select(*DRIFT_COLUMNS).orderBy(*order)
    return newest if limit is None else newest.limit(limit)
