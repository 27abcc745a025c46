"""Marts: dimensions, order facts, daily revenue, funnel, retention and RFM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import (
    funnel_stage,
    money,
    month_of,
    months_between_starts,
    pipe_key,
    rfm_segment,
    stage_label,
)
from tidemark.operators.merge import BROADCAST_KEYS, incremental_merge
from tidemark.operators.ranks import global_ntile
from tidemark.operators.versions import asof_join, scd2
from tidemark.plans.staging import stg_order_items, stg_orders
from tidemark.session import scratch_path, stored
from tidemark.sources.tables import delete_path, write_parts
from tidemark.specs import FUNNEL_LOOKBACK_DAYS


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "full_name", "email_hash", "country", "segment", "acquisition_channel", "signup_date",
        "updated_at",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "unit_price", "unit_cost")


def dim_customers_history(versions: DataFrame) -> DataFrame:
    return scd2(versions, "customer_id", "updated_at", ["country", "segment"])


def item_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """Per order: newest item change, and counts and sums over the items whose product is known.

    One left join and one aggregation give both, where two separate aggregates would shuffle the items
    twice.
    """
    known = F.col("_known")
    cost = products.select("product_id", "unit_cost", F.lit(True).alias("_known"))
    priced = items.select("order_id", "product_id", "quantity", "unit_price", "updated_at").join(
        cost, "product_id", "left"
    )
    return priced.groupBy("order_id").agg(
        F.max("updated_at").alias("items_updated_at"),
        F.count(F.when(known, 1)).alias("items_count"),
        F.sum(F.when(known, F.col("quantity"))).alias("units"),
        money(F.sum(F.when(known, F.col("quantity") * F.col("unit_price")))).alias("gross_revenue"),
        money(F.sum(F.when(known, F.col("quantity") * F.col("unit_cost")))).alias("cogs"),
    )


def _changed_at() -> Column:
    return F.greatest("updated_at", F.coalesce("items_updated_at", "updated_at"))


def changed_at(orders: DataFrame, items: DataFrame) -> DataFrame:
    """When an order or any of its items last changed."""
    newest = items.groupBy("order_id").agg(F.max("updated_at").alias("items_updated_at"))
    return (
        orders.select("order_id", "updated_at")
        .join(newest, "order_id", "left")
        .select("order_id", _changed_at().alias("changed_at"))
    )


def order_money(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order with all amounts; everything of the order fact but country and segment."""
    gross, cogs = F.coalesce("gross_revenue", money(F.lit(0))), F.coalesce("cogs", money(F.lit(0)))
    rate = F.col("discount_pct")
    zero = F.lit(0).cast("long")
    return orders.join(item_totals(items, products), "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_ts",
        "order_date",
        "status",
        "channel",
        "discount_pct",
        F.coalesce("items_count", zero).alias("items_count"),
        F.coalesce("units", zero).alias("units"),
        gross.alias("gross_revenue"),
        money(F.round(gross * rate, 2)).alias("discount_amount"),
        money(F.round(gross * (1 - rate), 2)).alias("net_revenue"),
        cogs.alias("cogs"),
        money(F.round(gross * (1 - rate) - cogs, 2)).alias("gross_margin"),
        (F.col("status") == "completed").alias("is_completed"),
        _changed_at().alias("order_updated_at"),
    )


FCT_ORDERS = (
    "order_id", "customer_id", "order_ts", "order_date", "status", "channel", "discount_pct", "country",
    "segment", "items_count", "units", "gross_revenue", "discount_amount", "net_revenue", "cogs",
    "gross_margin", "is_completed", "order_updated_at",
)


def fct_orders(orders: DataFrame, items: DataFrame, products: DataFrame, history: DataFrame) -> DataFrame:
    """One row per order, with country and segment as of the moment of the order."""
    rows = order_money(orders, items, products)
    # The instants come from the orders alone; reading them from the rows would sum up the items again.
    return asof_join(rows, history, "customer_id", "order_ts", ["country", "segment"], points=orders).select(*FCT_ORDERS)


#: Rows of order items that are worked on at a time in a build.
PART_ROWS = 20_000_000


def in_part(key: str, parts: int, part: int) -> Column:
    """Whether a row is in one of the parts that its key, as text, deals it to. On the key of a staging model this filters raw."""
    return F.lit(True) if parts == 1 else F.pmod(F.hash(F.col(key).cast("string")), F.lit(parts)) == part


def write_fct_orders(path: str, orders: DataFrame, items: DataFrame, products: DataFrame, history: DataFrame, parts: int) -> DataFrame:
    """:func:`fct_orders` stored below ``path``; ``items`` should be stored.

    The amounts are worked out by parts of the orders, the as-of columns by parts of the customers, each with its shuffle files of its own.
    """
    def money_of(i: int) -> DataFrame:
        own = in_part("order_id", parts, i)
        return order_money(orders.filter(own), items.filter(own), products)

    def placed(rows: DataFrame, i: int) -> DataFrame:
        own = in_part("customer_id", parts, i)
        return asof_join(rows.filter(own), history.filter(own), "customer_id", "order_ts", ["country", "segment"]).select(*FCT_ORDERS)

    spark, place = orders.sparkSession, scratch_path(orders.sparkSession, "order-money")
    rows = write_parts(place, (money_of(i) for i in range(parts)))
    out = write_parts(path, (placed(rows, i) for i in range(parts)))
    delete_path(spark, place)
    return out


def fct_orders_delta(
    raw_orders: DataFrame, raw_items: DataFrame, products: DataFrame, history: DataFrame, since: Column, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """The order fact for orders that changed after ``since``.

    An order changed when a version of it or of one of its items is newer, so the changed ids come from
    two cursor-filtered scans; only those orders and items are then read in full. The ids are stored,
    because three joins read them.

    Of few changed orders the ids go to the scans, of which then only their items travel. Of many, the newest version of every item is
    picked in the one exchange that finding the touched items would take as well; items of other orders then meet no order.
    """
    changed = changed_orders(raw_orders, raw_items, since)
    orders = stg_orders(raw_orders.join(changed, "order_id", "left_semi"))
    if changed.count() > broadcast_keys:
        items = stg_order_items(raw_items).join(changed, "order_id", "left_semi")
    else:
        touched = raw_items.join(F.broadcast(changed), "order_id", "left_semi").select("order_item_id").distinct()
        items = stg_order_items(raw_items.join(touched, "order_item_id", "left_semi"))
    return fct_orders(orders, items, products, history)


def changed_orders(raw_orders: DataFrame, raw_items: DataFrame, since: Column) -> DataFrame:
    """The ids of orders of which a version, or the newest version of an item, is newer than ``since``; stored."""
    newer = F.col("updated_at") > since
    ids = raw_orders.filter(newer).select("order_id").union(stg_order_items(raw_items.filter(newer)).select("order_id"))
    return stored(ids.distinct(), "changed-orders")


def fct_orders_incremental(
    existing: DataFrame, raw_orders: DataFrame, raw_items: DataFrame, products: DataFrame, history: DataFrame
) -> DataFrame:
    """The existing fact with changed orders swapped in. An empty target must be built in full instead."""
    since = existing.agg(F.max("order_updated_at")).scalar()
    delta = stored(fct_orders_delta(raw_orders, raw_items, products, history, since), "order-delta")
    return incremental_merge(existing, delta, ["order_id"])


def order_line_revenue(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The revenue of :func:`fct_order_items` by line, for consumers that read nothing of the order but its id."""
    lines = items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price").join(products.select("product_id"), "product_id")
    known = lines.join(orders.select("order_id"), "order_id", "left_semi")
    return known.select("order_item_id", "order_id", money(F.col("quantity") * F.col("unit_price")).alias("line_revenue"))


def fct_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Line grain with the state of the order; rebuilt in full because that state changes later."""
    head = orders.select("order_id", "order_date", "status", "channel", "country")
    goods = products.select("product_id", "product_name", "category", "unit_cost")
    return (
        items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price")
        .join(goods, "product_id")
        .join(head, "order_id")
        .select(
            "order_item_id",
            "order_id",
            "order_date",
            "status",
            "channel",
            "country",
            "product_id",
            "product_name",
            "category",
            "quantity",
            money(F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
            money(F.col("quantity") * F.col("unit_cost")).alias("line_cost"),
        )
    )


def mart_daily_channel(orders: DataFrame) -> DataFrame:
    return (
        orders.filter("is_completed")
        .groupBy("order_date", F.coalesce("channel", F.lit("unknown")).alias("channel"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money(F.sum("net_revenue")).alias("net_revenue"),
            money(F.sum("gross_margin")).alias("gross_margin"),
        )
    )


def sessionize(events: DataFrame) -> DataFrame:
    """One row per session: its first day, its device and the furthest funnel stage."""
    return events.groupBy("session_id").agg(
        F.to_date(F.min("event_ts")).alias("event_date"),
        F.min("device").alias("device"),
        F.max(funnel_stage(F.col("event_type"))).alias("furthest_stage"),
    )


def funnel_of_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions reaching each stage per day and device.

    Sessions are first counted by furthest stage; each count then adds to that stage and all before it.
    The expansion works on day x device x 5 counts instead of on sessions. A session without a known
    stage reaches none.
    """
    reached = (
        sessions.filter(F.col("furthest_stage").isNotNull())
        .groupBy("event_date", "device", "furthest_stage")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stage = F.explode(F.sequence(F.lit(1), F.col("furthest_stage"))).alias("stage_order")
    counts = (
        reached.select("event_date", "device", stage, "n")
        .groupBy("event_date", "device", "stage_order")
        .agg(F.sum("n").alias("sessions"))
        .withColumn("stage", stage_label(F.col("stage_order")))
    )
    return counts.select(
        pipe_key(F.col("event_date"), F.col("device"), F.col("stage")).alias("funnel_key"),
        "event_date",
        "device",
        "stage",
        "stage_order",
        "sessions",
    )


def mart_funnel_daily(events: DataFrame) -> DataFrame:
    return funnel_of_sessions(sessionize(events))


def funnel_delta(events: DataFrame, first_day: Column) -> DataFrame:
    """The funnel of sessions that start on or after ``first_day``.

    These are the sessions with events from that day on and none before it. Only the recent events are grouped, and the result
    is stored; of the older events those of recent sessions are picked by a semi-join before anything is
    shuffled, as long as the recent sessions are few enough to be broadcast.
    """
    day = F.to_date("event_ts")
    recent = stored(sessionize(events.filter(day >= first_day)), "recent-sessions")
    older = events.filter(day < first_day).select("session_id").join(recent.select("session_id"), "session_id", "left_semi")
    return funnel_of_sessions(recent.join(older.distinct(), "session_id", "left_anti"))


def funnel_incremental(
    existing: DataFrame, events: DataFrame, lookback_days: int = FUNNEL_LOOKBACK_DAYS
) -> DataFrame:
    first_day = F.date_sub(existing.agg(F.max("event_date")).scalar(), lookback_days)
    return incremental_merge(existing, stored(funnel_delta(events, first_day), "funnel-delta"), ["funnel_key"])


def mart_cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Share of each signup cohort with a completed order k months later.

    Orders are reduced to distinct (customer, month) before the join, so a busy customer joins with at
    most one row per month, and counting those rows counts customers.
    """
    cohorts = customers.select("customer_id", month_of(F.col("signup_date")).alias("cohort_month"))
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    months = (
        orders.filter("is_completed")
        .select("customer_id", month_of(F.col("order_date")).alias("order_month"))
        .distinct()
    )
    offset = months_between_starts(F.col("order_month"), F.col("cohort_month"))
    activity = (
        months.join(cohorts, "customer_id")
        .select("cohort_month", offset.alias("months_since_signup"))
        .filter(F.col("months_since_signup") >= 0)
        .groupBy("cohort_month", "months_since_signup")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    rate = F.col("active_customers").cast("decimal(20,0)") / F.col("cohort_size").cast("decimal(20,0)")
    return activity.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_since_signup",
        "cohort_size",
        "active_customers",
        F.round(rate, 4).cast("decimal(10,4)").alias("retention_rate"),
    )


def mart_customer_rfm(orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary quintiles per customer; ties broken by customer_id.

    Ranking by the last order date is ranking by recency, so the newest date of the data is only needed
    once the per-customer rows are stored.
    """
    scored = (
        orders.filter("is_completed")
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("_last"),
            F.count(F.lit(1)).alias("frequency"),
            money(F.sum("net_revenue")).alias("monetary"),
        )
    )
    for column, score in (("_last", "r_score"), ("frequency", "f_score"), ("monetary", "m_score")):
        scored = global_ntile(scored, [(column, True), ("customer_id", True)], 5, score)
    newest = scored.agg(F.max("_last")).scalar()
    return scored.select(
        "customer_id",
        F.date_diff(newest, F.col("_last")).alias("recency_days"),
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        rfm_segment(F.col("r_score"), F.col("f_score")).alias("rfm_segment"),
    )
