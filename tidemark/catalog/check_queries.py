"""Data tests and reconciliation, each run on a state of the data in which it finds something."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import catalog
from tidemark.catalog.inputs import Shop
from tidemark.catalog.model_queries import (
    EVENT_CUTOFF,
    ORDER_CUTOFF,
    at_cutoff,
    merged_funnel,
    old_fct_orders,
    old_order_money,
)
from tidemark.catalog.ops_inputs import (
    NULL_RATE_SQL,
    VOLUME_SQL,
    ALL_READ,
    all_checks,
    all_checks_sql,
    amount_sql,
    behind,
    complete,
    lossy_items,
    parity_sql,
)
from tidemark.catalog.oracle_views import VIEWS
from tidemark.functions import with_doubles
from tidemark.operators import assertions
from tidemark.operators.drift import ContractError, enforce_contract
from tidemark.operators.merge import SchemaMismatchError, incremental_merge
from tidemark.plans import checks, marts, reconcile, staging
from tidemark.session import stored
from tidemark.specs import FCT_ORDERS_CONTRACT, TABLES

READ = ALL_READ.isoformat(sep=" ")
NOW = "2024-02-03 21:00:00"  # a day after the newest event


@catalog.add("test_unique", """
select order_item_id, count(*) as n from raw_order_items where order_item_id is not null
group by order_item_id having count(*) > 1""")
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.not_unique(Shop(spark, sf_dir).raw("order_items"), "order_item_id")


@catalog.add("test_not_null", "select order_id, customer_id, status from stg_orders where channel is null")
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assertions.nulls(Shop(spark, sf_dir).orders, "channel").select("order_id", "customer_id", "status")


@catalog.add("test_accepted_values", """
select order_id, status from stg_orders where status is not null and status not in ('pending', 'completed')""")
def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a list that forgets two statuses."""
    orders = Shop(spark, sf_dir).orders.select("order_id", "status")
    return assertions.not_accepted(orders, "status", ["pending", "completed"])


@catalog.add("test_relationships", """
select order_item_id, order_id from stg_order_items
where order_id is not null and order_id not in (select order_id from old_stg_orders)""")
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose order was not loaded yet at the cutoff."""
    shop = Shop(spark, sf_dir)
    loaded = staging.stg_orders(at_cutoff(shop.raw("orders"), "updated_at", ORDER_CUTOFF))
    return assertions.orphans(shop.items.select("order_item_id", "order_id"), "order_id", loaded, "order_id")


@catalog.add("no_negative_amounts", """
select order_item_id, order_id, quantity, cast(-unit_price as double) as unit_price from stg_order_items
where quantity = 50 and -unit_price < 0""")
def no_negative_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a source bug that negated the price of full boxes of 50."""
    price = F.when(F.col("quantity") == 50, -F.col("unit_price")).otherwise(F.col("unit_price"))
    items = Shop(spark, sf_dir).items.withColumn("unit_price", price)
    return with_doubles(checks.negative_amounts(items))


TOTALS_OFF = """
select order_id, cast(sum(head) as double) as gross_revenue, cast(sum(line) as double) as line_total
from (select order_id, gross_revenue as head, null as line from {fact}
      union all select order_id, null, line_revenue from fct_order_items)
group by order_id having count(head) > 0 and count(line) > 0 and abs(sum(head) - sum(line)) > 0.005"""
DAYS_OFF = """
select order_date, cast(sum(mart) as double) as mart_revenue, cast(sum(fact) as double) as fact_revenue
from (select order_date, net_revenue as mart, null as fact from mart_daily_channel
      union all select order_date, null, net_revenue from {fact} where is_completed)
group by order_date having abs(ifnull(sum(mart), 0) - ifnull(sum(fact), 0)) > 0.005"""
SESSIONS_OFF = """
select event_date, cast(sum(seen) as bigint) as sessions_in_events, cast(sum(counted) as bigint) as sessions_in_mart
from (select event_date, 1 as seen, 0 as counted from sessions
      union all select event_date, 0, sessions from {funnel} where stage_order = 1)
group by event_date having sum(seen) > 0 and sum(seen) <> sum(counted)"""
ORDERS_OFF = """
select if(mine.order_id is null, 'absent', 'outdated') as problem, order_id
from fct_orders now left join {fact} mine using (order_id)
where mine.order_updated_at is distinct from now.order_updated_at"""
PERIODS_OFF = """
select p.customer_id, 'discontinuous' as problem
from {history} p asof join {history} n on p.customer_id = n.customer_id and p.valid_from < n.valid_from
where p.valid_to <> n.valid_from
union all
select customer_id, 'open_periods' from {history} group by customer_id having sum(cast(is_current as int)) <> 1"""


@catalog.add("order_totals_reconcile", TOTALS_OFF.format(fact="old_fct_orders"))
def order_totals_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order fact left behind at the cutoff against today's lines."""
    shop = Shop(spark, sf_dir)
    lines = marts.order_line_revenue(shop.items, shop.orders, shop.product_costs)
    return with_doubles(checks.totals_off(old_order_money(shop), lines))


@catalog.add("daily_channel_matches_orders", DAYS_OFF.format(fact="old_fct_orders"))
def daily_channel_matches_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's daily mart against the order fact at the cutoff."""
    shop = Shop(spark, sf_dir)
    return with_doubles(checks.daily_channel_off(shop.daily_channel, old_order_money(shop)))


@catalog.add("funnel_matches_events", SESSIONS_OFF.format(funnel="funnel_merged"))
def funnel_matches_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental funnel, which misses events later than its lookback."""
    shop = Shop(spark, sf_dir)
    return checks.funnel_off(shop.events, merged_funnel(shop))


@catalog.add("fct_orders_is_complete", ORDERS_OFF.format(fact="old_fct_orders"))
def fct_orders_is_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact at the cutoff against today's staging."""
    shop = Shop(spark, sf_dir)
    return checks.orders_incomplete(shop.orders, shop.items, old_order_money(shop))


@catalog.add("scd2_is_contiguous", "with thinned as (select * from dim_customers_history where version_number <> 2)"
             + PERIODS_OFF.format(history="thinned"))
def scd2_is_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history that lost every second period."""
    return checks.history_broken(Shop(spark, sf_dir).history.filter(F.col("version_number") != 2))


@catalog.add("retention_is_a_rate", """
select cohort_month, months_since_signup, round(retention_rate * 20, 4) as retention_rate
from mart_cohort_retention where retention_rate * 20 < 0 or retention_rate * 20 > 1""")
def retention_is_a_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates measured against one in twenty of each cohort."""
    retention = Shop(spark, sf_dir).retention.withColumn("retention_rate", F.col("retention_rate") * 20)
    return with_doubles(checks.not_a_rate(retention))


@catalog.add("source_freshness", f"""
select *, if(age_hours > 50, 'error', if(age_hours > 26, 'warn', 'pass')) as status
from (select *, (epoch_us(timestamp '{NOW}') - epoch_us(newest_load)) / 3.6e9 as age_hours from ("""
             + " union all ".join(f"select '{s.name}' as table_name, max({s.cursor}) + to_hours(1) as newest_load from raw_{s.name}" for s in TABLES)
             + "))")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    tables = {s.name: shop.raw(s.name) for s in TABLES}
    return checks.source_freshness(tables, F.lit(NOW).cast("timestamp_ntz"))


_HASHED = ("stg_customers", "dim_customers")


def _models(shop: Shop) -> dict[str, DataFrame]:
    """All fifteen models of both layers; those that others are made of are stored, so each is made once."""
    shop.orders, shop.items = stored(shop.orders, "orders"), stored(shop.items, "items")
    shop.history, shop.fct_orders = stored(shop.history, "periods"), stored(shop.fct_orders, "fact")
    shop.order_money = shop.fct_orders
    return {
        "stg_customers": shop.customers,
        "stg_products": shop.products,
        "stg_orders": shop.orders,
        "stg_order_items": shop.items,
        "stg_web_events": shop.events,
        "stg_customer_versions": staging.stg_customer_versions(shop.raw("customers")),
        "dim_customers": marts.dim_customers(shop.customers),
        "dim_products": marts.dim_products(shop.products),
        "dim_customers_history": shop.history,
        "fct_orders": shop.fct_orders,
        "fct_order_items": shop.fct_order_items,
        "mart_daily_channel": shop.daily_channel,
        "mart_funnel_daily": shop.funnel,
        "mart_cohort_retention": shop.retention,
        "mart_customer_rfm": shop.rfm,
    }


@catalog.add("pii_scan", "\nunion all by name\n".join(f"""
select '{t}' as table_name, cast(0 as bigint) as private_columns, count(*) as rows_scanned,
       {"count(*) filter (where length(email_hash) <> 32)" if t in _HASHED else "cast(0 as bigint)"}
       as bad_hashes from {t}""" for t in (
    "stg_customers", "stg_products", "stg_orders", "stg_order_items", "stg_web_events", "stg_customer_versions", "dim_customers",
    "dim_products", "dim_customers_history", "fct_orders", "fct_order_items", "mart_daily_channel", "mart_funnel_daily",
    "mart_cohort_retention", "mart_customer_rfm")))
def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pii_scan(_models(Shop(spark, sf_dir)))


@catalog.add("contract", """
select c.column_name, c.refused, o.orders_as_published
from (values (cast(null as varchar), false), ('net_revenue', true), ('order_id', true)) c(column_name, refused),
     (select count(*) as orders_as_published from fct_orders) o""")
def contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact as published, with amounts as text, and with its key in another place; and its rows as published."""
    fact = Shop(spark, sf_dir).fct_orders
    builds = {
        None: fact,
        "net_revenue": fact.withColumn("net_revenue", F.col("net_revenue").cast("string")),
        "order_id": fact.select(*[c for c in fact.columns if c != "order_id"], "order_id"),
    }

    def refused(build: DataFrame) -> bool:
        try:
            enforce_contract(FCT_ORDERS_CONTRACT, build.schema, "fct_orders")
        except ContractError:
            return True
        return False

    cases = spark.createDataFrame([(c, refused(b)) for c, b in builds.items()], "column_name string, refused boolean")
    return cases.withColumn("orders_as_published", fact.agg(F.count(F.lit(1)).alias("n")).scalar())


@catalog.add("on_schema_change", """
select c.change, c.refused, (select count(*) from fct_merged) as rows_after
from (values ('none', false), ('column added', true), ('column dropped', true), ('column retyped', true)) c(change, refused)""")
def on_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta that no longer has the target's columns is refused; the one that has them is merged."""
    shop = Shop(spark, sf_dir)
    old = old_fct_orders(shop)
    since = old.agg(F.max("order_updated_at")).scalar()
    delta = marts.fct_orders_delta(shop.raw("orders"), shop.raw("order_items"), shop.product_costs, shop.history, since)
    changes = {
        "none": delta,
        "column added": delta.withColumn("coupon_code", F.lit("X")),
        "column dropped": delta.drop("segment"),
        "column retyped": delta.withColumn("units", F.col("units").cast("string")),
    }

    def refused(changed: DataFrame) -> bool:
        try:
            incremental_merge(old, changed, ["order_id"])
        except SchemaMismatchError:
            return True
        return False

    cases = spark.createDataFrame([(c, refused(d)) for c, d in changes.items()], "change string, refused boolean")
    merged = incremental_merge(old, stored(delta, "order-delta"), ["order_id"])
    return cases.withColumn("rows_after", merged.agg(F.count(F.lit(1)).alias("n")).scalar())


# --- reconciliation ------------------------------------------------------------------------------


def _only(check: str, *parts: str) -> str:
    union = "\nunion all by name\n".join(f"select * from ({p}) u" for p in parts)
    return f"select * from ({union}) c where check_name = '{check}'"


def _parities(shop: Shop) -> DataFrame:
    tables = [
        complete(shop, "customers"), complete(shop, "products"), behind(shop, "orders"), lossy_items(shop),
        behind(shop, "web_events"),
    ]
    return reduce(DataFrame.unionByName, [reconcile.parity(t) for t in tables])


_PARITIES_SQL = (
    parity_sql("customers", "raw_customers", READ),
    parity_sql("products", "raw_products", READ),
    parity_sql("orders", "old_orders", ORDER_CUTOFF),
    parity_sql("order_items", "lossy_order_items", READ),
    parity_sql("web_events", "old_events", EVENT_CUTOFF),
)


@catalog.add("watermark_lag", _only("watermark_lag", *_PARITIES_SQL))
def watermark_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parities(Shop(spark, sf_dir)).filter(F.col("check_name") == "watermark_lag")


@catalog.add("rowcount_parity", _only("rowcount_parity", *_PARITIES_SQL))
def rowcount_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parities(Shop(spark, sf_dir)).filter(F.col("check_name") == "rowcount_parity")


# Items of which some are lost and others have a wrong key, such that the number and the sum of the keys agree.
VIEWS["swapped_order_items"] = """
select * replace (case when order_item_id % 997 = 0 then -order_item_id when order_item_id % 991 = 0 then order_item_id + 5 else order_item_id end
                  as order_item_id) from raw_order_items"""


def _swapped(items: DataFrame) -> DataFrame:
    k = F.col("order_item_id")
    return items.withColumn("order_item_id", F.when(k % 997 == 0, -k).when(k % 991 == 0, k + 5).otherwise(k))


@catalog.add("key_differences", """
with s as (select distinct order_item_id as key from raw_order_items), r as (select distinct order_item_id as key from swapped_order_items)
select key, 'source' as side from s where key not in (select key from r)
union all select key, 'raw' from r where key not in (select key from s)""")
def key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys differ, found by descending into the hash buckets whose checksums do."""
    items = Shop(spark, sf_dir).raw("order_items").select("order_item_id")
    return reconcile.key_differences(items, _swapped(items), "order_item_id")


@catalog.add("amount_parity", amount_sql("lossy_order_items"))
def amount_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.amount_parity(lossy_items(Shop(spark, sf_dir)))


@catalog.add("null_rate_channel", NULL_RATE_SQL.format(raw="raw_orders"))
def null_rate_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.null_rate_channel(Shop(spark, sf_dir).raw("orders"))


@catalog.add("daily_volume_anomaly", VOLUME_SQL.format(raw="raw_web_events"))
def daily_volume_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.daily_volume(Shop(spark, sf_dir).raw("web_events"))


@catalog.add("run_checks", all_checks_sql("old_orders", ORDER_CUTOFF, "old_events", EVENT_CUTOFF))
def run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_checks(Shop(spark, sf_dir), partial=True)
