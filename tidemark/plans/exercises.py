"""Ad-hoc questions against the marts and the bookkeeping tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import money, month_of, ratio
from tidemark.operators.versions import latest_version


def revenue_by_month(orders: DataFrame) -> DataFrame:
    return (
        orders.filter("is_completed")
        .groupBy(month_of(F.col("order_date")).alias("month"))
        .agg(money(F.sum("net_revenue")).alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .orderBy("month")
    )


def channel_margin(orders: DataFrame) -> DataFrame:
    margin = ratio(F.sum("gross_margin"), F.sum("net_revenue"))
    return (
        orders.filter("is_completed")
        .groupBy(F.coalesce("channel", F.lit("unknown")).alias("channel"))
        .agg(F.round(margin, 3).alias("margin_pct"))
        .orderBy(F.desc_nulls_first("margin_pct"))
    )


def moved_customers(history: DataFrame, limit: int | None = None) -> DataFrame:
    """Full history of customers seen in more than one country; the first rows by customer and time."""
    moved = (
        history.groupBy("customer_id")
        .agg(F.min("country").alias("a"), F.max("country").alias("b"))
        .filter(F.col("a") != F.col("b"))
    )
    out = (
        history.join(moved, "customer_id", "left_semi")
        .select("customer_id", "country", "valid_from", "valid_to", "is_current")
        .orderBy("customer_id", "valid_from")
    )
    return out if limit is None else out.limit(limit)


def funnel_conversion(funnel: DataFrame, days: int = 14) -> DataFrame:
    """Sessions per stage in the newest days of data, and their share of the first stage."""
    newest = funnel.agg(F.max("event_date")).scalar()
    stages = (
        funnel.filter(F.col("event_date") > F.date_sub(newest, days))
        .groupBy("stage", "stage_order")
        .agg(F.sum("sessions").alias("sessions"))
    )
    # At most one row per funnel stage is left here.
    first = F.first("sessions").over(Window.orderBy("stage_order"))
    return stages.select(
        "stage", "sessions", F.round(ratio(F.col("sessions"), first), 3).alias("of_page_views"), "stage_order"
    ).orderBy("stage_order").drop("stage_order")


def retention_triangle(retention: DataFrame, months: int = 6, limit: int | None = None) -> DataFrame:
    out = (
        retention.filter(F.col("months_since_signup") <= months)
        .select("cohort_month", "months_since_signup", "retention_rate")
        .orderBy("cohort_month", "months_since_signup")
    )
    return out if limit is None else out.limit(limit)


def load_stats(audit: DataFrame) -> DataFrame:
    seconds = ratio(F.sum("duration_seconds"), F.count("duration_seconds"))
    return (
        audit.filter(F.col("status") == "success")
        .groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.round(seconds, 2).alias("avg_seconds"),
            F.sum("rows_inserted").alias("rows_inserted"),
        )
        .orderBy("table_name")
    )


def latest_dq(results: DataFrame) -> DataFrame:
    columns = ["check_name", "table_name", "status", "expected", "actual", "checked_at"]
    return latest_version(results.select(*columns), ["check_name", "table_name"], ["checked_at"])
