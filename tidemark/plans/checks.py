"""Business rules the models must keep. Each returns the rows that break its rule."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import seconds_between
from tidemark.operators.versions import history_gaps
from tidemark.plans.marts import changed_at

TOLERANCE = 0.005

# Age limits of raw data in hours, and columns that must not leave raw.
FRESH_WARN_HOURS = 26
FRESH_ERROR_HOURS = 50
PRIVATE_COLUMNS = ("email", "full_name_raw")


def is_negative_amount() -> Column:
    return (F.col("unit_price") < 0) | (F.col("quantity") <= 0)


def negative_amounts(items: DataFrame) -> DataFrame:
    return items.filter(is_negative_amount()).select("order_item_id", "order_id", "quantity", "unit_price")


def totals_off(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders whose revenue is not the sum of their lines."""
    lines = order_items.groupBy("order_id").agg(F.sum("line_revenue").alias("line_total"))
    both = orders.select("order_id", "gross_revenue").join(lines, "order_id")
    return both.filter(F.abs(F.col("gross_revenue") - F.col("line_total")) > TOLERANCE)


def daily_channel_off(daily: DataFrame, orders: DataFrame) -> DataFrame:
    """Days on which the daily mart and the order fact disagree, including days only one side has."""
    mart = daily.groupBy("order_date").agg(F.sum("net_revenue").alias("mart_revenue"))
    fact = (
        orders.filter("is_completed").groupBy("order_date").agg(F.sum("net_revenue").alias("fact_revenue"))
    )
    gap = F.coalesce("mart_revenue", F.lit(0)) - F.coalesce("fact_revenue", F.lit(0))
    return mart.join(fact, "order_date", "full").filter(F.abs(gap) > TOLERANCE)


def funnel_off(events: DataFrame, funnel: DataFrame) -> DataFrame:
    """Days whose session count in the events differs from the first funnel stage."""
    expected = (
        events.groupBy("session_id")
        .agg(F.to_date(F.min("event_ts")).alias("event_date"))
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("sessions_in_events"))
    )
    actual = (
        funnel.filter(F.col("stage") == "Page view").groupBy("event_date").agg(F.sum("sessions").alias("_n"))
    )
    return (
        expected.join(actual, "event_date", "left")
        .select("event_date", "sessions_in_events", F.coalesce("_n", F.lit(0).cast("long")).alias("sessions_in_mart"))
        .filter(F.col("sessions_in_mart") != F.col("sessions_in_events"))
    )


def orders_incomplete(orders: DataFrame, items: DataFrame, fact: DataFrame) -> DataFrame:
    """Orders the fact does not have, and orders it has in an older state; one left join finds both."""
    expected = changed_at(orders, items)
    both = expected.join(fact.select("order_id", "order_updated_at"), "order_id", "left")
    problem = F.when(F.col("order_updated_at").isNull(), "absent").when(
        F.col("order_updated_at") != F.col("changed_at"), "outdated"
    )
    return both.select(problem.alias("problem"), "order_id").filter(F.col("problem").isNotNull())


def history_broken(history: DataFrame) -> DataFrame:
    """Customers with a gap or overlap, and customers without exactly one open period."""
    gaps = history_gaps(history, "customer_id").withColumn("problem", F.lit("discontinuous"))
    current = F.count(F.when(F.col("is_current"), 1))
    open_periods = (
        history.groupBy("customer_id")
        .agg(current.alias("_n"))
        .filter(F.col("_n") != 1)
        .select("customer_id", F.lit("open_periods").alias("problem"))
    )
    return gaps.unionByName(open_periods)


def is_not_a_rate() -> Column:
    return (F.col("retention_rate") < 0) | (F.col("retention_rate") > 1)


def not_a_rate(retention: DataFrame) -> DataFrame:
    return retention.filter(is_not_a_rate()).select("cohort_month", "months_since_signup", "retention_rate")


def source_freshness(raw: Mapping[str, DataFrame], now: Column) -> DataFrame:
    """Age of the newest load per raw table, judged against the limits. One narrow aggregate per table."""
    rows = [
        df.agg(F.max("_loaded_at").alias("newest_load")).select(F.lit(name).alias("table_name"), "newest_load")
        for name, df in raw.items()
    ]
    hours = (seconds_between(F.col("newest_load"), now) / 3600).cast("double")
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > FRESH_ERROR_HOURS), "error")
        .when(F.col("age_hours") > FRESH_WARN_HOURS, "warn")
        .otherwise("pass")
    )
    return reduce(DataFrame.unionByName, rows).withColumn("age_hours", hours).withColumn("status", status)


def private_columns(tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """Published columns that carry personal data in the clear; needs no job."""
    return [(name, c) for name, df in tables.items() for c in df.columns if c in PRIVATE_COLUMNS]


def bad_hashes(df: DataFrame, column: str = "email_hash") -> DataFrame:
    return df.filter(F.length(column) != 32)


def pii_scan(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per published table: forbidden columns, rows, and rows whose email hash is not an md5."""
    found = private_columns(tables)

    def row(name: str, df: DataFrame) -> DataFrame:
        wrong = F.count(F.when(F.length("email_hash") != 32, 1)) if "email_hash" in df.columns else F.lit(0)
        return df.agg(F.count(F.lit(1)).alias("rows_scanned"), wrong.cast("long").alias("bad_hashes")).select(
            F.lit(name).alias("table_name"),
            F.lit(sum(t == name for t, _ in found)).cast("long").alias("private_columns"),
            "rows_scanned",
            "bad_hashes",
        )

    return reduce(DataFrame.unionByName, [row(n, df) for n, df in tables.items()])
