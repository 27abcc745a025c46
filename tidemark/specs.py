"""Declared tables: keys, cursors and schemas of the shop's change-log sources.

Timestamps are UTC wall-clock ``timestamp_ntz`` throughout, which is how the parquet inputs carry
them, so no result depends on the session time zone and filters on them reach the scan uncast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LINEAGE_COLUMNS = ("_batch_id", "_loaded_at")
DEFAULT_OVERLAP_SECONDS = 3600
FUNNEL_LOOKBACK_DAYS = 3

_TS = T.TimestampNTZType()
_MONEY = T.DecimalType(10, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


@dataclass(frozen=True)
class TableSpec:
    name: str
    pk: tuple[str, ...]
    cursor: str
    schema: T.StructType
    version_column: str = "updated_at"
    partition_column: str | None = None

    @property
    def raw_key(self) -> tuple[str, ...]:
        """What makes two raw rows the same observation."""
        return (*self.pk, self.version_column)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType(
            self.schema.fields
            + [T.StructField("_batch_id", T.LongType()), T.StructField("_loaded_at", _TS)]
        )


CUSTOMERS = TableSpec(
    "customers",
    ("customer_id",),
    "updated_at",
    _schema(
        customer_id=T.LongType(),
        full_name=T.StringType(),
        email=T.StringType(),
        country=T.StringType(),
        segment=T.StringType(),
        acquisition_channel=T.StringType(),
        signup_date=T.DateType(),
        created_at=_TS,
        updated_at=_TS,
    ),
)
PRODUCTS = TableSpec(
    "products",
    ("product_id",),
    "updated_at",
    _schema(
        product_id=T.LongType(),
        product_name=T.StringType(),
        category=T.StringType(),
        unit_price=_MONEY,
        unit_cost=_MONEY,
        created_at=_TS,
        updated_at=_TS,
    ),
)
ORDERS = TableSpec(
    "orders",
    ("order_id",),
    "updated_at",
    _schema(
        order_id=T.LongType(),
        customer_id=T.LongType(),
        order_ts=_TS,
        status=T.StringType(),
        channel=T.StringType(),
        discount_pct=T.DecimalType(4, 2),
        created_at=_TS,
        updated_at=_TS,
    ),
)
ORDER_ITEMS = TableSpec(
    "order_items",
    ("order_item_id",),
    "updated_at",
    _schema(
        order_item_id=T.LongType(),
        order_id=T.LongType(),
        product_id=T.LongType(),
        quantity=T.IntegerType(),
        unit_price=_MONEY,
        created_at=_TS,
        updated_at=_TS,
    ),
)
WEB_EVENTS = TableSpec(
    "web_events",
    ("event_id",),
    "ingested_at",
    _schema(
        event_id=T.LongType(),
        session_id=T.LongType(),
        customer_id=T.LongType(),
        event_ts=_TS,
        event_type=T.StringType(),
        device=T.StringType(),
        ingested_at=_TS,
    ),
    version_column="event_ts",
    partition_column="event_ts",
)

TABLES: tuple[TableSpec, ...] = (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, WEB_EVENTS)
TABLES_BY_NAME = {spec.name: spec for spec in TABLES}

# The domains the data tests accept.
ORDER_STATUSES = ("pending", "completed", "cancelled", "refunded")
EVENT_TYPES = ("page_view", "product_view", "add_to_cart", "begin_checkout", "purchase")
FUNNEL_STAGES = ("Page view", "Product view", "Add to cart", "Begin checkout", "Purchase")
RFM_SEGMENTS = ("Champions", "Loyal", "Recent", "At risk", "Needs attention")

# The published column contract of the order fact: names in order, with their types.
FCT_ORDERS_CONTRACT = _schema(
    order_id=T.LongType(),
    customer_id=T.LongType(),
    order_ts=_TS,
    order_date=T.DateType(),
    status=T.StringType(),
    channel=T.StringType(),
    discount_pct=T.DecimalType(4, 2),
    country=T.StringType(),
    segment=T.StringType(),
    items_count=T.LongType(),
    units=T.LongType(),
    gross_revenue=T.DecimalType(20, 2),
    discount_amount=T.DecimalType(20, 2),
    net_revenue=T.DecimalType(20, 2),
    cogs=T.DecimalType(20, 2),
    gross_margin=T.DecimalType(20, 2),
    is_completed=T.BooleanType(),
    order_updated_at=_TS,
)

SESSION_SCHEMA = _schema(
    session_id=T.LongType(), event_date=T.DateType(), device=T.StringType(), furthest_stage=T.IntegerType()
)
FUNNEL_SCHEMA = _schema(
    funnel_key=T.StringType(),
    event_date=T.DateType(),
    device=T.StringType(),
    stage=T.StringType(),
    stage_order=T.IntegerType(),
    sessions=T.LongType(),
)
