"""Staging models: newest version per key, typed and cleaned. Lazy; nothing is written.

Picking the newest version compares whole rows, so the optimizer cannot drop a column of it later. Callers
that need only some columns name them, and the scan reads no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import email_hash
from tidemark.operators.versions import latest_version

NEWEST = ("updated_at", "_loaded_at")
CUSTOMERS = (
    "customer_id", "full_name", "email_hash", "country", "segment", "acquisition_channel", "signup_date",
    "created_at", "updated_at",
)
PRODUCTS = ("product_id", "product_name", "category", "unit_price", "unit_cost", "updated_at")
ORDERS = ("order_id", "customer_id", "order_ts", "status", "channel", "discount_pct", "updated_at")
ORDER_ITEMS = ("order_item_id", "order_id", "product_id", "quantity", "unit_price", "updated_at")
ITEM_TIES = ("product_id", "quantity", "unit_price")

Columns = Sequence[str] | None


def _current(raw: DataFrame, key: str, columns: Sequence[str], newest: Sequence[str]) -> DataFrame:
    needed = list(dict.fromkeys([*columns, *newest]))
    return latest_version(raw.select(*needed), [key], newest).select(*columns)


def stg_customers(raw: DataFrame, columns: Columns = None) -> DataFrame:
    """Current customers. The email leaves raw only as a hash."""
    hashed = raw.withColumn("email_hash", email_hash(F.col("email")))
    return _current(hashed, "customer_id", columns or CUSTOMERS, NEWEST)


def stg_products(raw: DataFrame, columns: Columns = None) -> DataFrame:
    return _current(raw, "product_id", columns or PRODUCTS, NEWEST)


def stg_orders(raw: DataFrame) -> DataFrame:
    rows = _current(raw, "order_id", ORDERS, NEWEST)
    return rows.select(*ORDERS[:3], F.to_date("order_ts").alias("order_date"), *ORDERS[3:])


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _current(raw, "order_item_id", ORDER_ITEMS, [*NEWEST, *ITEM_TIES])


def stg_web_events(raw: DataFrame) -> DataFrame:
    """Events never change, so there is nothing to pick."""
    return raw.select(
        "event_id", "session_id", "customer_id", "event_ts", F.to_date("event_ts").alias("event_date"),
        "event_type", "device", "ingested_at",
    )


def stg_customer_versions(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", "country", "segment", "signup_date", "updated_at", "_loaded_at")
