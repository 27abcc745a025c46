"""Staging models, marts and the operators they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import catalog
from tidemark.catalog.inputs import Shop
from tidemark.catalog.oracle_views import VIEWS, _FCT_ORDERS, _FUNNEL, _SESSIONS, _STG_ORDER_ITEMS, _STG_ORDERS
from tidemark.functions import with_doubles
from tidemark.operators import merge, ranks, versions
from tidemark.plans import marts, staging
from tidemark.session import stored

ORDER_CUTOFF = "1998-01-01 00:00:00"
EVENT_CUTOFF = "2024-01-25 00:00:00"

# Models as they stood at the cutoffs, for everything that works on prior state.
VIEWS["old_orders"] = f"select * from raw_orders where updated_at <= timestamp '{ORDER_CUTOFF}'"
VIEWS["old_order_items"] = f"select * from raw_order_items where updated_at <= timestamp '{ORDER_CUTOFF}'"
VIEWS["old_stg_orders"] = _STG_ORDERS.format(raw="old_orders")
VIEWS["old_stg_order_items"] = _STG_ORDER_ITEMS.format(raw="old_order_items")
VIEWS["old_fct_orders"] = _FCT_ORDERS.format(orders="old_stg_orders", items="old_stg_order_items")
VIEWS["old_events"] = f"select * from raw_web_events where ingested_at <= timestamp '{EVENT_CUTOFF}'"
VIEWS["old_sessions"] = _SESSIONS.format(events="old_events")
VIEWS["old_funnel"] = _FUNNEL.format(sessions="old_sessions")
VIEWS["fct_delta"] = """
select * from fct_orders where order_updated_at > (select max(order_updated_at) from old_fct_orders)"""
VIEWS["fct_merged"] = """
select * from old_fct_orders where order_id not in (select order_id from fct_delta)
union all by name select * from fct_delta"""
VIEWS["recent_sessions"] = """
select * from sessions where event_date >= (select max(event_date) - 3 from old_funnel)"""
VIEWS["funnel_fresh"] = _FUNNEL.format(sessions="recent_sessions")
VIEWS["funnel_merged"] = """
select * from old_funnel where funnel_key not in (select funnel_key from funnel_fresh)
union all by name select * from funnel_fresh"""


def at_cutoff(df: DataFrame, cursor: str, cutoff: str) -> DataFrame:
    return df.filter(F.col(cursor) <= F.lit(cutoff).cast("timestamp_ntz"))


def old_fct_orders(shop: Shop) -> DataFrame:
    """Stored, like any target of an incremental model: merging reads it more than once."""
    orders = staging.stg_orders(at_cutoff(shop.raw("orders"), "updated_at", ORDER_CUTOFF))
    items = staging.stg_order_items(at_cutoff(shop.raw("order_items"), "updated_at", ORDER_CUTOFF))
    return stored(marts.fct_orders(orders, items, shop.product_costs, shop.history), "old-orders")


def old_order_money(shop: Shop) -> DataFrame:
    """The order fact at the cutoff without its as-of columns, for consumers that read it once and do not read them."""
    orders = staging.stg_orders(at_cutoff(shop.raw("orders"), "updated_at", ORDER_CUTOFF))
    items = staging.stg_order_items(at_cutoff(shop.raw("order_items"), "updated_at", ORDER_CUTOFF))
    return marts.order_money(orders, items, shop.product_costs)


def merged_fct_orders(shop: Shop) -> DataFrame:
    return marts.fct_orders_incremental(
        old_fct_orders(shop), shop.raw("orders"), shop.raw("order_items"), shop.product_costs, shop.history
    )


def old_funnel(shop: Shop) -> DataFrame:
    events = staging.stg_web_events(at_cutoff(shop.raw("web_events"), "ingested_at", EVENT_CUTOFF))
    return stored(marts.mart_funnel_daily(events), "old-funnel")


def merged_funnel(shop: Shop) -> DataFrame:
    return marts.funnel_incremental(old_funnel(shop), shop.events)


# --- staging -------------------------------------------------------------------------------------


@catalog.add("latest_version", """
select order_id, customer_id, status, channel, cast(discount_pct as double) as discount_pct, updated_at, _batch_id
from (select *, row_number() over (partition by order_id order by updated_at desc, _batch_id desc) as rn
      from raw_orders) t where rn = 1""")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Shop(spark, sf_dir).raw("orders").select(
        "order_id", "customer_id", "status", "channel", "discount_pct", "updated_at", "_batch_id"
    )
    return with_doubles(versions.latest_version(raw, ["order_id"], ["updated_at", "_batch_id"]))


@catalog.add("stg_customers", "select * from stg_customers")
def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).customers


@catalog.add("stg_products", """
select product_id, product_name, category, cast(unit_price as double) as unit_price,
       cast(unit_cost as double) as unit_cost, updated_at from stg_products""")
def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).products)


@catalog.add("stg_orders", """
select order_id, customer_id, order_ts, order_date, status, channel, cast(discount_pct as double) as discount_pct,
       updated_at from stg_orders""")
def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).orders)


@catalog.add("stg_order_items", """
select order_item_id, order_id, product_id, quantity, cast(unit_price as double) as unit_price, updated_at
from stg_order_items""")
def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).items)


@catalog.add("stg_web_events", """
select event_id, session_id, customer_id, event_ts, cast(event_ts as date) as event_date, event_type, device, ingested_at
from raw_web_events""")
def stg_web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).events


@catalog.add("stg_customer_versions", """
select customer_id, country, segment, signup_date, updated_at, updated_at + interval '1' hour as _loaded_at
from raw_customers""")
def stg_customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_customer_versions(Shop(spark, sf_dir).raw("customers"))


@catalog.add("distinct_on", """
select distinct on (order_item_id) order_item_id, quantity, cast(unit_price as double) as unit_price
from raw_order_items order by order_item_id, updated_at desc, product_id desc, quantity desc, unit_price desc""")
def distinct_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ["updated_at", "product_id", "quantity", "unit_price"]
    return with_doubles(
        versions.distinct_on(
            Shop(spark, sf_dir).raw("order_items"), ["order_item_id"], newest,
            ["order_item_id", "quantity", "unit_price"],
        )
    )


# --- dimensions and history ----------------------------------------------------------------------


@catalog.add("dim_customers", """
select customer_id, full_name, email_hash, country, segment, acquisition_channel, signup_date, updated_at
from stg_customers""")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_customers(Shop(spark, sf_dir).customers)


@catalog.add("dim_products", """
select product_id, product_name, category, cast(unit_price as double) as unit_price,
       cast(unit_cost as double) as unit_cost from stg_products""")
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(marts.dim_products(Shop(spark, sf_dir).products))


def _history_as_text(df: DataFrame) -> DataFrame:
    # The year 9999 does not fit nanosecond timestamps some clients convert to.
    return df.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@catalog.add("dim_customers_history", """
select customer_id, country, segment, cast(valid_from as varchar) as valid_from, cast(valid_to as varchar) as valid_to,
       is_current, version_number from dim_customers_history""")
def dim_customers_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history_as_text(Shop(spark, sf_dir).history)


@catalog.add("asof_join", """
select order_id, customer_id, order_ts, if(order_ts < found.valid_to, found.country, null) as country,
       if(order_ts < found.valid_to, found.segment, null) as segment
from stg_orders asof left join (select customer_id, valid_from as order_ts, valid_to, country, segment from dim_customers_history) found
  using (customer_id, order_ts)""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    facts = shop.orders.select("order_id", "customer_id", "order_ts")
    return versions.asof_join(facts, shop.history, "customer_id", "order_ts", ["country", "segment"])


# --- order facts ---------------------------------------------------------------------------------

_FCT_OUT = """
select order_id, customer_id, order_ts, order_date, status, channel, cast(discount_pct as double) as discount_pct,
       country, segment, cast(items_count as bigint) as items_count, cast(units as bigint) as units,
       cast(gross_revenue as double) as gross_revenue, cast(discount_amount as double) as discount_amount,
       cast(net_revenue as double) as net_revenue, cast(cogs as double) as cogs,
       cast(gross_margin as double) as gross_margin, is_completed, order_updated_at from {}"""


@catalog.add("fct_orders", _FCT_OUT.format("fct_orders"))
def fct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).fct_orders)


@catalog.add("revenue_by_country_at_order_time", """
select country, count(*) as orders, cast(sum(net_revenue) as double) as revenue
from fct_orders where is_completed group by country""")
def revenue_by_country_at_order_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(
        Shop(spark, sf_dir)
        .fct_orders.filter("is_completed")
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("net_revenue").alias("revenue"))
    )


@catalog.add("changed_at", "select order_id, order_updated_at as changed_at from fct_orders")
def changed_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return marts.changed_at(shop.orders, shop.items)


@catalog.add("fct_orders_incremental", _FCT_OUT.format("fct_merged"))
def fct_orders_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(merged_fct_orders(Shop(spark, sf_dir)))


@catalog.add("fct_order_items", """
select order_item_id, order_id, order_date, status, channel, country, product_id, product_name, category, quantity,
       cast(line_revenue as double) as line_revenue, cast(line_cost as double) as line_cost from fct_order_items""")
def fct_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).fct_order_items)


@catalog.add("mart_daily_channel", """
select order_date, channel, orders, cast(net_revenue as double) as net_revenue,
       cast(gross_margin as double) as gross_margin from mart_daily_channel""")
def mart_daily_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).daily_channel)


# --- funnel --------------------------------------------------------------------------------------


@catalog.add("sessionize", "select session_id, event_date, device, furthest_stage from sessions")
def sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sessionize(Shop(spark, sf_dir).events)


@catalog.add("mart_funnel_daily", "select * from mart_funnel_daily")
def mart_funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).funnel


@catalog.add("funnel_incremental", "select * from funnel_merged")
def funnel_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_funnel(Shop(spark, sf_dir))


# --- retention, RFM, ranks -----------------------------------------------------------------------


@catalog.add("mart_cohort_retention", "select * from mart_cohort_retention")
def mart_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).retention)


@catalog.add("mart_customer_rfm", """
select customer_id, recency_days, frequency, cast(monetary as double) as monetary, cast(r_score as int) as r_score,
       cast(f_score as int) as f_score, cast(m_score as int) as m_score, rfm_segment from mart_customer_rfm""")
def mart_customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(Shop(spark, sf_dir).rfm)


@catalog.add("global_ntile", """
select order_item_id, updated_at, cast(quantity as int) as quantity,
       cast(ntile(7) over (order by quantity desc, order_item_id, updated_at) as int) as tile
from (select distinct order_item_id, updated_at, max(quantity) as quantity from raw_order_items
      group by order_item_id, updated_at) t""")
def global_ntile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Shop(spark, sf_dir).raw("order_items")
    rows = raw.groupBy("order_item_id", "updated_at").agg(F.max("quantity").alias("quantity"))
    order = [("quantity", False), ("order_item_id", True), ("updated_at", True)]
    return ranks.global_ntile(rows, order, 7, "tile")


# --- materialization -----------------------------------------------------------------------------


@catalog.add("incremental_merge", """
select order_date, channel, orders, cast(net_revenue as double) as net_revenue, cast(gross_margin as double) as gross_margin
from (
  select o.* from (select order_date, coalesce(channel, 'unknown') as channel, count(*) as orders,
                          sum(net_revenue) as net_revenue, sum(gross_margin) as gross_margin
                   from old_fct_orders where is_completed group by 1, 2) o
  anti join mart_daily_channel m on o.order_date = m.order_date and o.channel = m.channel
  union all by name select * from mart_daily_channel) t""")
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    before = marts.mart_daily_channel(old_order_money(shop))
    return with_doubles(merge.incremental_merge(before, shop.daily_channel, ["order_date", "channel"]))


_DIFFERENCE = """
select (select count(*) from {l}) as left_rows, (select count(*) from {r}) as right_rows,
       (select count(*) from (select * from {l} except all select * from {r}) a) as only_left,
       (select count(*) from (select * from {r} except all select * from {l}) b) as only_right"""


@catalog.add("incremental_equals_full_orders", _DIFFERENCE.format(l="fct_merged", r="fct_orders"))
def incremental_equals_full_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return merge.table_difference(merged_fct_orders(shop), shop.fct_orders)


@catalog.add("incremental_equals_full_funnel", _DIFFERENCE.format(l="funnel_merged", r="mart_funnel_daily"))
def incremental_equals_full_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events later than the lookback make this one differ, which is what the check is for."""
    shop = Shop(spark, sf_dir)
    return merge.table_difference(merged_funnel(shop), shop.funnel)
