"""Loads, stored tables and streams. Those with state write it to a fresh folder of the shared scratch."""

from __future__ import annotations

from contextlib import suppress
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import catalog
from tidemark.catalog.check_queries import DAYS_OFF, PERIODS_OFF, SESSIONS_OFF, TOTALS_OFF
from tidemark.catalog.inputs import Shop
from tidemark.catalog.model_queries import EVENT_CUTOFF, ORDER_CUTOFF, _FCT_OUT, at_cutoff
from tidemark.catalog.ops_inputs import STATE_CUTOFFS, load_audit, log_now, log_then, source_now, two_loads_sql
from tidemark.catalog.oracle_views import VIEWS, _FCT_ORDERS, _STG_ORDER_ITEMS, _STG_ORDERS
from tidemark.functions import wall_clock, with_doubles
from tidemark.operators.drift import SchemaDriftError, raw_projection
from tidemark.operators.merge import extract_range, new_rows
from tidemark.operators.metrics import metric_query
from tidemark.operators.versions import latest_version
from tidemark.plans import dashboards, marts, reconcile, staging
from tidemark.plans.build import Warehouse, orders_table
from tidemark.plans.load import LogSource, load_all, load_table, results_frame
from tidemark.plans.suite import ACCEPTED_VALUES, NOT_NULL, RELATIONSHIPS, UNIQUE
from tidemark.session import scratch_path, stored
from tidemark.sources import shop as shop_source
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.raw_store import RawStore, load_status, watermarks
from tidemark.sources.readers import stream_files
from tidemark.sources.tables import SnapshotTable
from tidemark.specs import ORDER_ITEMS, ORDERS, TABLES, TABLES_BY_NAME, WEB_EVENTS
from tidemark.streaming import jobs

RUN_AT = datetime(2024, 2, 10, 6)
LATE_CUTOFF = "1997-12-01 00:00:00"
MERGE_CUTOFF = "2001-10-05 00:00:00"
# Buckets a month of the order fact at least; larger tables get more.
BUCKETS = 2

# --- extract and append --------------------------------------------------------------------------

_ORDER_COLUMNS = """order_id, customer_id, order_ts, status, channel, cast(discount_pct as double) as discount_pct,
       created_at, updated_at"""


@catalog.add("incremental_extract", f"""
select {_ORDER_COLUMNS} from src_orders where updated_at > timestamp '{ORDER_CUTOFF}' - interval '3600' second""")
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = source_now(Shop(spark, sf_dir), "orders")
    upper = source.agg(F.max("updated_at")).first()[0]
    return with_doubles(extract_range(source, "updated_at", upper, ORDER_CUTOFF, 3600))


@catalog.add("overlap_reread", f"""
select updated_at <= timestamp '{ORDER_CUTOFF}' as read_before, count(*) as orders, min(updated_at) as first_change,
       max(updated_at) as last_change
from src_orders where updated_at > timestamp '{ORDER_CUTOFF}' - interval '259200' second group by 1""")
def overlap_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a three-day overlap reads again, next to what is new."""
    source = source_now(Shop(spark, sf_dir), "orders")
    upper = source.agg(F.max("updated_at")).first()[0]
    again = F.col("updated_at") <= F.lit(ORDER_CUTOFF).cast("timestamp_ntz")
    return (
        extract_range(source, "updated_at", upper, ORDER_CUTOFF, 259_200)
        .groupBy(again.alias("read_before"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.min("updated_at").alias("first_change"),
            F.max("updated_at").alias("last_change"),
        )
    )


@catalog.add("idempotent_append", f"""
select distinct on (order_item_id, updated_at) order_item_id, order_id, product_id, quantity,
       cast(unit_price as double) as unit_price, created_at, updated_at
from raw_order_items
where updated_at > timestamp '{LATE_CUTOFF}'
  and (order_item_id, updated_at) not in (select (order_item_id, updated_at) from old_order_items)
order by order_item_id, updated_at, product_id desc, quantity desc, raw_order_items.unit_price desc""")
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that overlaps raw by a month and repeats keys inside itself."""
    raw = Shop(spark, sf_dir).raw("order_items").select(*ORDER_ITEMS.columns)
    staged = raw.filter(F.col("updated_at") > F.lit(LATE_CUTOFF).cast("timestamp_ntz"))
    existing = at_cutoff(raw, "updated_at", ORDER_CUTOFF)
    return with_doubles(new_rows(staged, existing, ORDER_ITEMS.raw_key))


@catalog.add("lineage_columns", f"""
select order_id, status, updated_at, cast(7 as bigint) as _batch_id, timestamp '{RUN_AT}' as _loaded_at
from raw_orders where updated_at > timestamp '{ORDER_CUTOFF}'""")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Shop(spark, sf_dir).raw("orders").select("order_id", "status", "updated_at")
    fresh = new_rows(raw, at_cutoff(raw, "updated_at", ORDER_CUTOFF), ORDERS.raw_key)
    return fresh.withColumns(
        {"_batch_id": F.lit(7).cast("long"), "_loaded_at": wall_clock(RUN_AT)}
    )


@catalog.add("raw_projection", f"select {_ORDER_COLUMNS} from src_orders")
def raw_projection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with a column raw does not know, in another order."""
    source = source_now(Shop(spark, sf_dir), "orders")
    wider = source.select(F.upper("status").alias("coupon_code"), *reversed(source.columns))
    return with_doubles(wider.select(*raw_projection(ORDERS.raw_schema)))


@catalog.add("watermark_advance", """
select table_name, max(watermark_to) as high_watermark from load_audit where status = 'success' group by table_name""")
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks(load_audit(Shop(spark, sf_dir)))


@catalog.add("load_status", """
select table_name, max(case when status = 'success' then watermark_to end) as high_watermark,
       arg_max(status, batch_id) as last_load,
       (select rows_inserted from load_audit b where b.batch_id = max(a.batch_id)) as rows_inserted
from load_audit a group by table_name""")
def load_status_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_status(load_audit(Shop(spark, sf_dir)))


# --- loads into a store --------------------------------------------------------------------------


def _store(spark: SparkSession) -> RawStore:
    return RawStore(spark, scratch_path(spark, "store"))


@catalog.add("load_all", "\nunion all by name\n".join(
    f"select * from ({two_loads_sql(s.name, i, i + len(TABLES))}) t{i}" for i, s in enumerate(TABLES, start=1)))
def load_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables, first as of the cutoffs and then as of now."""
    shop, store = Shop(spark, sf_dir), _store(spark)
    first = load_all(store, {s.name: log_then(shop, s.name) for s in TABLES}, "first")
    second = load_all(store, {s.name: log_now(shop, s.name) for s in TABLES}, "second")
    return results_frame(spark, first + second)


@catalog.add("atomic_commit", f"""
with two as ({two_loads_sql('orders', 1, 3)})
select batch_id, table_name, 'success' as status, rows_extracted, rows_inserted, watermark_from, watermark_to,
       cast(sum(rows_inserted) over (order by batch_id) as bigint) as visible_rows
from two
union all by name
select cast(2 as bigint) as batch_id, 'orders' as table_name, 'failed' as status, rows_inserted as visible_rows
from two where batch_id = 1""")
def atomic_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, one whose source breaks half-way, and the retry; with the rows readers saw after each."""
    shop, store = Shop(spark, sf_dir), _store(spark)
    seen = []

    def load(source: LogSource) -> None:
        load_table(store, ORDERS, source, "hourly")

    def look() -> None:
        seen.append(store.read_raw(ORDERS).count())

    now = log_now(shop, "orders")
    newest = wall_clock(now.log.agg(F.max("updated_at")).first()[0])
    lost = F.when(F.col("updated_at") == newest, F.raise_error(F.lit("connection lost")).cast("string"))
    load(log_then(shop, "orders"))
    look()
    try:
        load(now.changed(lambda df: df.withColumn("status", F.coalesce(lost, "status"))))
    except Exception as exc:  # noqa: BLE001 - the failure is the point; anything else must surface
        if "connection lost" not in str(exc):
            raise
    look()
    load(now)
    look()
    visible = F.element_at(F.array(*[F.lit(n).cast("long") for n in seen]), F.col("batch_id").cast("int"))
    return store.audit().select(
        "batch_id", "table_name", "status", "rows_extracted", "rows_inserted", "watermark_from", "watermark_to",
        visible.alias("visible_rows"),
    )


@catalog.add("full_refresh_load", """
select 'first' as run_label, count(*) as rows_extracted, count(*) as rows_inserted, max(updated_at) as watermark_to
from src_order_items
union all
select 'full', count(*), cast(0 as bigint), max(updated_at) from src_order_items""")
def full_refresh_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading everything again adds nothing."""
    shop, store = Shop(spark, sf_dir), _store(spark)
    source = log_now(shop, "order_items")
    load_table(store, ORDER_ITEMS, source, "first")
    load_table(store, ORDER_ITEMS, source, "full", full=True)
    return store.audit().select("run_label", "rows_extracted", "rows_inserted", "watermark_to")


# Every fourth session happens a month later than the one before it, so that the log covers four months and more.
_SPREAD = {
    f"spread_{name}": f"""
select event_id, session_id, customer_id, event_ts + (session_id % 4) * interval 31 day as event_ts, event_type, device,
       ingested_at + (session_id % 4) * interval 31 day as ingested_at from {name}_web_events"""
    for name in ("then", "src")
}
VIEWS |= _SPREAD
_KNOWN_MONTHS = (datetime(2024, 1, 1), datetime(2024, 2, 1))


def _spread(events: DataFrame) -> DataFrame:
    later = F.make_dt_interval(days=(F.col("session_id") % 4 * 31).cast("int"))
    return events.withColumns({c: F.col(c) + later for c in ("event_ts", "ingested_at")})


def _two_spread_loads(shop: Shop, store: RawStore) -> None:
    then, now = log_then(shop, "web_events"), log_now(shop, "web_events")
    load_table(store, WEB_EVENTS, LogSource(_spread(then.log), then.pick), "first")
    load_table(store, WEB_EVENTS, LogSource(_spread(now.log), now.pick), "second", full=True)


@catalog.add("month_partitions", """
with batches as (
    select 1 as _batch_id, event_ts from spread_then
    union all select 2, event_ts from spread_src where (event_id, event_ts) not in (select (event_id, event_ts) from spread_then)
)
select cast(_batch_id as bigint) as _batch_id, strftime(event_ts, '%Y-%m') as event_month, count(*) as events,
       min(event_ts) as first_event, max(event_ts) as last_event
from batches group by 1, 2""")
def month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events per batch and month folder; the months of each batch are registered before it is written."""
    shop, store = Shop(spark, sf_dir), _store(spark)
    _two_spread_loads(shop, store)
    return store.read_raw(WEB_EVENTS).groupBy("_batch_id", "event_month").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_ts").alias("first_event"), F.max("event_ts").alias("last_event")
    )


_STORED_SQL = "select event_ts from spread_src union all select event_ts from spread_then where (event_id, event_ts) not in (select (event_id, event_ts) from spread_src)"


@catalog.add("default_partition_empty", f"""
with stored as ({_STORED_SQL}),
counted as (
    select count(*) as n, count(*) filter (where event_ts >= timestamp '2024-03-01') as stray,
           count(distinct strftime(event_ts, '%Y-%m')) as months,
           count(distinct strftime(event_ts, '%Y-%m')) filter (where event_ts >= timestamp '2024-03-01') as unknown
    from stored
)
select 'before' as moment, 'default_partition_empty' as check_name, 'web_events' as table_name, 'fail' as status, '0' as expected,
       cast(stray as varchar) as actual, 'unregistered_months=' || unknown as details, n as visible_rows,
       months - unknown + 1 as folders from counted
union all
select 'after', 'default_partition_empty', 'web_events', 'pass', '0', '0', '', n, months from counted""")
def default_partition_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with only two months registered, and the same raw once all months are: the strays have moved out."""
    shop = Shop(spark, sf_dir)
    store = RawStore(spark, scratch_path(spark, "store"), months_on_demand=False)
    store.register_months(WEB_EVENTS, *_KNOWN_MONTHS)
    _two_spread_loads(shop, store)

    def look(moment: str) -> DataFrame:
        raw = store.read_raw(WEB_EVENTS)
        counts = raw.agg(F.count(F.lit(1)).alias("visible_rows"), F.count_distinct("event_month").alias("folders"))
        return reconcile.default_partition_empty(raw).join(counts).withColumn("moment", F.lit(moment))

    before = look("before")
    ends = store.read_raw(WEB_EVENTS).agg(F.min("event_ts"), F.max("event_ts")).first()
    store.register_months(WEB_EVENTS, *ends)
    return before.unionByName(look("after"))


# --- materializations ----------------------------------------------------------------------------

_DAILY = """
select order_date, channel, orders, cast(net_revenue as double) as net_revenue,
       cast(gross_margin as double) as gross_margin from mart_daily_channel"""


@catalog.add("view_materialization", "select status, channel, count(*) as orders from stg_orders group by status, channel")
def view_materialization(spark: SparkSession, sf_dir: str) -> DataFrame:
    Shop(spark, sf_dir).orders.createOrReplaceTempView("stg_orders")
    return spark.sql("SELECT status, channel, count(*) AS orders FROM stg_orders GROUP BY status, channel")


@catalog.add("table_materialization", _DAILY)
def table_materialization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuilt table: the second snapshot replaces the first."""
    shop, table = Shop(spark, sf_dir), SnapshotTable(spark, scratch_path(spark, "table"))
    table.write(shop.daily_channel.filter(F.col("channel") == "email"))
    return with_doubles(table.write(shop.daily_channel))


# The order fact as it stood a month before the end of the data, brought up to date in its bucketed table.
VIEWS |= {f"late_{t}": f"select * from raw_{t} where updated_at <= timestamp '{MERGE_CUTOFF}'" for t in ("orders", "order_items")}
VIEWS["late_stg_orders"] = _STG_ORDERS.format(raw="late_orders")
VIEWS["late_stg_order_items"] = _STG_ORDER_ITEMS.format(raw="late_order_items")
VIEWS["late_fct_orders"] = _FCT_ORDERS.format(orders="late_stg_orders", items="late_stg_order_items")
VIEWS["late_fct_delta"] = "select * from fct_orders where order_updated_at > (select max(order_updated_at) from late_fct_orders)"
VIEWS["late_fct_merged"] = """
select f.* from late_fct_orders f anti join late_fct_delta d using (order_id) union all by name select * from late_fct_delta"""


def merged_orders_table(shop: Shop, buckets: int = BUCKETS) -> BucketedTable:
    """The fact built as of the cutoff, then merged bucket to bucket with what changed since."""
    table = orders_table(shop.spark, scratch_path(shop.spark, "orders"), buckets)
    then = {t: at_cutoff(shop.raw(t), "updated_at", MERGE_CUTOFF) for t in ("orders", "order_items")}
    history = stored(shop.history, "history")
    before = marts.fct_orders(staging.stg_orders(then["orders"]), staging.stg_order_items(then["order_items"]), shop.product_costs, history)
    table.overwrite(before, then["orders"].count())
    since = table.read().agg(F.max("order_updated_at")).first()[0]
    delta = marts.fct_orders_delta(shop.raw("orders"), shop.raw("order_items"), shop.product_costs, history, wall_clock(since))
    table.merge(delta, ["order_id"])
    return table


@catalog.add("incremental_merge_bucketed", _FCT_OUT.format("late_fct_merged"))
def incremental_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_doubles(merged_orders_table(Shop(spark, sf_dir)).read())


_MODELS = (
    "dim_customers", "dim_products", "dim_customers_history", "fct_orders", "fct_order_items", "mart_daily_channel",
    "mart_funnel_daily", "mart_cohort_retention", "mart_customer_rfm",
)


@catalog.add("build_all", "\nunion all\n".join(f"select '{m}' as model, count(*) as row_count from {m}" for m in _MODELS))
def build_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored marts, built from raw as of the cutoff, then brought up to date; refreshed funnel."""
    shop = Shop(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "marts"), BUCKETS)
    then = {s.name: at_cutoff(shop.raw(s.name), s.cursor, STATE_CUTOFFS[s.name]) for s in TABLES}
    warehouse.build(then)
    models = warehouse.build({s.name: shop.raw(s.name) for s in TABLES})
    counts = [
        models[m].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(m).alias("model"), "row_count") for m in _MODELS
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _tests_sql() -> str:
    def listed(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    cases = [
        (f"unique {t}.{c}", f"select {c} from {t} where {c} is not null group by {c} having count(*) > 1")
        for t, c in UNIQUE
    ]
    cases += [(f"not_null {t}.{c}", f"select 1 from {t} where {c} is null") for t, c in NOT_NULL]
    cases += [
        (f"accepted_values {t}.{c}", f"select 1 from {t} where {c} is not null and {c} not in ({listed(v)})")
        for t, c, v in ACCEPTED_VALUES
    ]
    cases += [
        (f"relationships {t}.{c}", f"select 1 from {t} where {c} is not null and {c} not in (select {pc} from {p})")
        for t, c, p, pc in RELATIONSHIPS
    ]
    cases += [
        ("no_negative_amounts", "select 1 from stg_order_items where unit_price < 0 or quantity <= 0"),
        ("order_totals_reconcile", TOTALS_OFF.format(fact="fct_orders")),
        ("daily_channel_matches_orders", DAYS_OFF.format(fact="fct_orders")),
        ("funnel_matches_events", SESSIONS_OFF.format(funnel="mart_funnel_daily")),
        ("fct_orders_is_complete", "select order_id from stg_orders except select order_id from fct_orders"),
        ("scd2_is_contiguous", PERIODS_OFF.format(history="dim_customers_history")),
        ("retention_is_a_rate", "select 1 from mart_cohort_retention where retention_rate < 0 or retention_rate > 1"),
    ]
    counted = "\nunion all\n".join(f"select '{label}' as test, (select count(*) from ({q}) v) as violations" for label, q in cases)
    return f"""
select test, 'error' as severity, violations, case when violations = 0 then 'pass' else 'fail' end as verdict
from ({counted}) t"""


@catalog.add("run_tests", _tests_sql())
def run_tests_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole declared suite over freshly built marts; row tests of stored models were counted while those were written."""
    shop = Shop(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "marts"), BUCKETS)
    models = warehouse.build({s.name: shop.raw(s.name) for s in TABLES})
    return warehouse.run_tests(models)


# --- drift ---------------------------------------------------------------------------------------

_DRIFTED = " union all ".join(
    f"select '{s.name}' as table_name, 'column_added' as kind, 'coupon_code' as column_name, 'warn' as severity" for s in TABLES
) + " union all select 'orders', 'type_changed', 'customer_id', 'error'"


def _drifted_store(spark: SparkSession, sf_dir: str) -> RawStore:
    """Five tables loaded side by side, each with a column raw does not know; then orders with a column of another type."""
    shop, store = Shop(spark, sf_dir), _store(spark)
    wider = {s.name: log_now(shop, s.name).changed(lambda df: df.withColumn("coupon_code", F.lit("X"))) for s in TABLES}
    load_all(store, wider, "wider", now=RUN_AT)
    retyped = source_now(shop, "orders").withColumn("customer_id", F.col("customer_id").cast("string"))
    with suppress(SchemaDriftError):
        load_table(store, ORDERS, retyped, "retyped", now=RUN_AT)
    return store


@catalog.add("schema_drift", f"""
select d.*, (select count(*) from ({" union all ".join(f"select '{s.name}' as t from src_{s.name}" for s in TABLES)}) r
             where r.t = d.table_name) as rows_loaded
from ({_DRIFTED}) d""")
def schema_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loads found, and that the tables with warnings were loaded all the same."""
    store = _drifted_store(spark, sf_dir)
    loaded = store.audit().filter("status = 'success'").select("table_name", F.col("rows_inserted").alias("rows_loaded"))
    return store.drift().select("table_name", "kind", "column_name", "severity").join(loaded, "table_name")


@catalog.add("metric_drift_events", f"""
select table_name, kind, count(*) as drift_events from ({_DRIFTED}) d group by table_name, kind""")
def metric_drift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_query(_drifted_store(spark, sf_dir).drift(), "drift", ["drift_events"], ["table_name", "kind"])


@catalog.add("drift_log", f"""
select timestamp '{RUN_AT}' as detected_at, * from ({_DRIFTED}) d""")
def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.drift_log(_drifted_store(spark, sf_dir).drift()).drop("detail")


@catalog.add("empty_source_load", """
select 'orders' as table_name, 'success' as status, cast(0 as bigint) as rows_extracted, cast(0 as bigint) as rows_inserted,
       (select count(*) from src_orders) as visible_rows""")
def empty_source_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that is empty after a full load: the load succeeds, and neither rows nor watermark change."""
    source, store = source_now(Shop(spark, sf_dir), "orders"), _store(spark)
    load_table(store, ORDERS, source, "full")
    before = store.watermark(ORDERS)
    load_table(store, ORDERS, source.limit(0), "empty")
    visible = store.read_raw(ORDERS).agg(F.count(F.lit(1)).alias("n")).scalar()
    last = store.audit().filter("run_label = 'empty'").select("table_name", "status", "rows_extracted", "rows_inserted")
    return last.filter(F.lit(store.watermark(ORDERS) == before)).withColumn("visible_rows", visible)


# --- streams -------------------------------------------------------------------------------------

def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = stream_files(spark, sf_dir, shop_source.SCHEMAS["events"], names="events.parquet")
    return landed.selectExpr(*shop_source.WEB_EVENT_COLUMNS)


@catalog.add("stream_load", "select event_id, session_id, customer_id, event_ts, event_type, device, ingested_at from raw_web_events")
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, at = _store(spark), scratch_path(spark, "stream")
    jobs.stream_load(event_stream(spark, sf_dir), store, WEB_EVENTS, at, "events").awaitTermination()
    return store.read_raw(WEB_EVENTS).select(*WEB_EVENTS.columns)


@catalog.add("dedupe_stream", "select event_id, session_id, event_ts, event_type from raw_web_events")
def dedupe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice."""
    twice = event_stream(spark, sf_dir).union(event_stream(spark, sf_dir))
    narrow = twice.select("event_id", "session_id", "event_ts", "event_type", "ingested_at")
    unique = jobs.dedupe_events(narrow, "10 days").drop("ingested_at")
    out = scratch_path(spark, "events")
    jobs.append_files(unique, out, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.schema(unique.schema).parquet(out)


@catalog.add("funnel_stream", "select *, cast(0 as bigint) as late_sessions from mart_funnel_daily")
def funnel_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one micro-batch, of which none is late."""
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
    jobs.run_funnel(event_stream(spark, sf_dir), tables, scratch_path(spark, "stream"))
    late = tables.late().agg(F.coalesce(F.sum("late_sessions"), F.lit(0)).alias("late_sessions")).scalar()
    return tables.funnel.read().withColumn("late_sessions", late)


# Every seventh session is delivered last, after two files that bring the watermark to the end.
_HELD_BACK, _LAST_DAYS = "session_id % 7 = 0", f"event_ts >= timestamp '{EVENT_CUTOFF}'"


@catalog.add("funnel_stream_late", f"""
with reach as (
    select max(event_ts) - interval 3 day as watermark from raw_web_events where not ({_HELD_BACK}) and not ({_LAST_DAYS})
), held as (
    select distinct session_id, cast(event_ts as date) as day from raw_web_events where {_HELD_BACK}
), cut as (
    select session_id, day, day + interval 1 day <= watermark as late from held, reach
)
select (select date_trunc('millisecond', max(event_ts)) - interval 3 day from raw_web_events where not ({_HELD_BACK})) as watermark,
       count(*) filter (where late) as late_sessions,
       (select count(distinct session_id) from (
            select session_id from cut where not late union all select session_id from raw_web_events where not ({_HELD_BACK})) s
       ) as sessions
from cut""")
def funnel_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files, the last of which is mostly later than the lookback: what was dropped, and the sessions that count.

    The third micro-batch is cut by the watermark of the first and reports that of the second.
    """
    events = Shop(spark, sf_dir).raw("web_events").select(*WEB_EVENTS.columns)
    folder = scratch_path(spark, "landed")
    held, last = F.expr(_HELD_BACK), F.expr(f"event_ts >= timestamp_ntz'{EVENT_CUTOFF}'")
    for part in (~held & ~last, ~held & last, held):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
    tables = jobs.FunnelTables(spark, scratch_path(spark, "funnel"))
    jobs.run_funnel(stream_files(spark, folder, WEB_EVENTS.schema, max_files=1), tables, scratch_path(spark, "stream"))
    late = tables.late().agg(
        F.max(F.col("watermark").cast("timestamp_ntz")).alias("watermark"), F.coalesce(F.sum("late_sessions"), F.lit(0)).alias("late_sessions")
    )
    counted = tables.sessions.read().agg(F.count_distinct("session_id").alias("sessions")).scalar()
    return late.withColumn("sessions", counted)
