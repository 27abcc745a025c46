"""Source states, recorded loads and recorded check runs that the registered queries work on."""

from __future__ import annotations

from contextlib import suppress
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.inputs import Shop
from tidemark.catalog.model_queries import EVENT_CUTOFF, ORDER_CUTOFF, at_cutoff
from tidemark.catalog.oracle_views import VIEWS
from tidemark.operators.drift import SchemaDriftError
from tidemark.operators.versions import latest_version
from tidemark.plans import reconcile
from tidemark.plans.load import LogSource, load_all, load_table
from tidemark.session import scratch_path
from tidemark.sources.raw_store import RawStore
from tidemark.specs import ORDERS, TABLES, TABLES_BY_NAME

# --- reconciliation states -----------------------------------------------------------------------

ALL_READ = datetime(2030, 1, 1)
CUTOFFS = {"orders": ORDER_CUTOFF, "web_events": EVENT_CUTOFF}
SQL_NEWEST = {
    "customers": "updated_at desc, _batch_id desc",
    "products": "updated_at desc",
    "orders": "updated_at desc, _batch_id desc",
    "order_items": "updated_at desc, product_id desc, quantity desc, unit_price desc",
    "web_events": "ingested_at desc",
}
for _spec in TABLES:
    VIEWS[f"src_{_spec.name}"] = f"""
select * from (select *, row_number() over (partition by {_spec.pk[0]} order by {SQL_NEWEST[_spec.name]}) as rn
               from raw_{_spec.name}) t where rn = 1"""
# Raw after a load that lost one day of order items.
LOST_DAY = "1996-03-13"
VIEWS["lossy_order_items"] = f"select * from raw_order_items where cast(updated_at as date) <> date '{LOST_DAY}'"


def source_of(shop: Shop, name: str) -> DataFrame:
    """The source table behind a raw log: one row per key, the newest."""
    spec = TABLES_BY_NAME[name]
    extra = ["product_id", "quantity", "unit_price"] if name == "order_items" else ["_batch_id"]
    return latest_version(shop.raw(name), spec.pk, [spec.cursor, *extra])


STATE_CUTOFFS = {s.name: EVENT_CUTOFF if s.name == "web_events" else ORDER_CUTOFF for s in TABLES}


for _s in TABLES:
    VIEWS[f"then_{_s.name}"] = f"""
select * from (select *, row_number() over (partition by {_s.pk[0]} order by {SQL_NEWEST[_s.name]}) as rn
               from raw_{_s.name} where {_s.cursor} <= timestamp '{STATE_CUTOFFS[_s.name]}') t where rn = 1"""


def _log_source(name: str, log: DataFrame) -> LogSource:
    """What else raw has follows from these columns, so it is not shuffled to pick the newest."""
    spec = TABLES_BY_NAME[name]
    extra = ["product_id", "quantity", "unit_price"] if name == "order_items" else ["_batch_id"]
    needed = list(dict.fromkeys([*spec.columns, *extra]))
    return LogSource(log, lambda df: latest_version(df.select(*needed), spec.pk, [spec.cursor, *extra]).select(*spec.columns), spec.pk)


def log_then(shop: Shop, name: str) -> LogSource:
    """The source table as it was at the cutoff."""
    return _log_source(name, at_cutoff(shop.raw(name), TABLES_BY_NAME[name].cursor, STATE_CUTOFFS[name]))


def log_now(shop: Shop, name: str) -> LogSource:
    return _log_source(name, shop.raw(name))


def source_then(shop: Shop, name: str) -> DataFrame:
    return log_then(shop, name).rows


def source_now(shop: Shop, name: str) -> DataFrame:
    return log_now(shop, name).rows


# --- recorded loads ------------------------------------------------------------------------------

def two_loads_sql(name: str, first: int, second: int) -> str:
    s = TABLES_BY_NAME[name]
    c, (k, v) = s.cursor, s.raw_key
    return f"""
select cast({first} as bigint) as batch_id, '{name}' as table_name, count(*) as rows_extracted, count(*) as rows_inserted,
       cast(null as timestamp) as watermark_from, max({c}) as watermark_to from then_{name}
union all by name
select cast({second} as bigint) as batch_id, '{name}' as table_name, count(*) as rows_extracted,
       count(*) filter (where ({k}, {v}) not in (select ({k}, {v}) from then_{name})) as rows_inserted,
       (select max({c}) from then_{name}) as watermark_from, max({c}) as watermark_to
from src_{name} where {c} > (select max({c}) from then_{name}) - interval '3600' second"""


# Three runs into one store: as of the cutoffs, as of now, and one whose source lost a column.
AUDIT_RUNS = (datetime(2024, 2, 1, 6), datetime(2024, 2, 2, 6), datetime(2024, 2, 3, 6))
AUDIT_SECONDS = (95, 40, 5)
_LOST_COLUMN = "orders.channel column_missing: raw has this column, the source does not (renamed?)"
VIEWS["load_audit"] = f"""
with attempts as (
    select batch_id, table_name, if(batch_id <= {len(TABLES)}, 1, 2) as run, 'success' as status, watermark_to, rows_extracted, rows_inserted,
           cast(null as varchar) as error
    from ({" union all by name ".join(f"select * from ({two_loads_sql(s.name, i, i + len(TABLES))}) l{i}" for i, s in enumerate(TABLES, start=1))}) loads
    union all by name
    select cast({2 * len(TABLES) + 1} as bigint) as batch_id, 'orders' as table_name, 3 as run, 'failed' as status, '{_LOST_COLUMN}' as error
), times(run, started_at, took) as (
    values {", ".join(f"({i}, timestamp '{at}', {took})" for i, (at, took) in enumerate(zip(AUDIT_RUNS, AUDIT_SECONDS), start=1))}
)
select attempts.* exclude (run), started_at, started_at + to_seconds(took) as finished_at from attempts join times using (run)"""
_audits: dict[tuple[str, str], RawStore] = {}


def load_audit(shop: Shop) -> DataFrame:
    """The audit of three real runs over the given tables; one store per session and folder."""
    key = (shop.spark.sparkContext.applicationId, shop.sf_dir)
    ends = [at + timedelta(seconds=took) for at, took in zip(AUDIT_RUNS, AUDIT_SECONDS)]
    if key not in _audits:
        store = RawStore(shop.spark, scratch_path(shop.spark, "audited"))
        load_all(store, {s.name: log_then(shop, s.name) for s in TABLES}, "first", now=AUDIT_RUNS[0], finished=ends[0])
        load_all(store, {s.name: log_now(shop, s.name) for s in TABLES}, "second", now=AUDIT_RUNS[1], finished=ends[1])
        with suppress(SchemaDriftError):
            load_table(store, ORDERS, log_now(shop, "orders").changed(lambda df: df.drop("channel")), "third", now=AUDIT_RUNS[2], finished=ends[2])
        _audits[key] = store
    return _audits[key].audit()


def complete(shop: Shop, name: str) -> reconcile.Loaded:
    return reconcile.Loaded(TABLES_BY_NAME[name], source_of(shop, name), shop.raw(name), ALL_READ)


def behind(shop: Shop, name: str) -> reconcile.Loaded:
    spec, cutoff = TABLES_BY_NAME[name], CUTOFFS[name]
    raw = at_cutoff(shop.raw(name), spec.cursor, cutoff)
    return reconcile.Loaded(spec, source_of(shop, name), raw, datetime.fromisoformat(cutoff))


def lossy_items(shop: Shop) -> reconcile.Loaded:
    t = complete(shop, "order_items")
    raw = t.raw.filter(F.to_date("updated_at") != F.lit(LOST_DAY).cast("date"))
    return reconcile.Loaded(t.spec, t.source, raw, t.watermark)


def parity_sql(table: str, raw: str, watermark: str) -> str:
    spec = TABLES_BY_NAME[table]
    return f"""
select unnest([
  {{check_name: 'watermark_lag', table_name: '{table}', status: case when behind > 0 then 'warn' else 'pass' end,
    expected: '0 rows behind', actual: behind || ' rows behind',
    details: case when behind > 0 then 'source_ahead' else '' end}},
  {{check_name: 'rowcount_parity', table_name: '{table}',
    status: case when behind > 0 then 'skipped' when sn = rn and ss = rs then 'pass' else 'fail' end,
    expected: case when behind = 0 then sn || ' keys, checksum ' || ss end,
    actual: case when behind = 0 then rn || ' keys, checksum ' || rs end,
    details: case when behind > 0 then 'source_ahead' else '' end}}
], recursive := true)
from (select count(*) filter (where {spec.cursor} > timestamp '{watermark}') as behind, count(*) as sn,
             coalesce(sum({spec.pk[0]}), 0) as ss from src_{table}) s,
     (select count(*) as rn, coalesce(sum(k), 0) as rs from (select distinct {spec.pk[0]} as k from {raw}) d) r"""


def amount_sql(raw: str) -> str:
    return f"""
select 'amount_parity' as check_name, 'order_items' as table_name,
       case when want = have then 'pass' else 'fail' end as status, cast(want as varchar) as expected,
       cast(have as varchar) as actual, '' as details
from (select (select sum(quantity * unit_price) from src_order_items) as want,
             (select sum(quantity * unit_price) from (
                select distinct on (order_item_id) quantity, unit_price from {raw}
                order by order_item_id, updated_at desc, product_id desc, quantity desc, unit_price desc) n) as have) t"""


STRAY_SQL = """
select 'default_partition_empty' as check_name, 'web_events' as table_name,
       if(n = 0, 'pass', 'fail') as status, '0' as expected, n::varchar as actual,
       if(n = 0, '', 'unregistered_months=' || m) as details
from (select count(*) as n, count(distinct strftime(event_ts, '%Y-%m')) as m from {raw}
      where strftime(event_ts, '%Y-%m') not between '{first}' and '{last}') t"""

NULL_RATE_SQL = """
select 'null_rate_channel' as check_name, 'orders' as table_name, if(blank > 0.01 * n, 'fail', 'pass') as status,
       '<= 1.0%' as expected, format('{{:.1f}}% ({{}} of {{}})', blank * 100.0 / n, blank, n) as actual, '' as details
from (select count(*) as n, count(*) - count(newest.via) as blank
      from (select arg_max({{'placed': order_ts, 'via': channel}}, {{'u': updated_at, 'b': _batch_id}}) as newest
            from {raw} group by order_id)
      where newest.placed >= (select max(order_ts) from {raw}) - to_days(7))"""

VOLUME_SQL = """
select 'daily_volume' as check_name, 'web_events' as table_name,
       case when abs(x - mean) <= 0.5 * mean then 'pass' else 'fail' end as status,
       cast(round(mean) as bigint) || ' +/- 50%' as expected, x || ' on ' || d as actual, '' as details
from (select max(n) filter (where rk = 2) as x, max(d) filter (where rk = 2) as d, avg(n) filter (where rk > 2) as mean
      from (select cast(event_ts as date) as d, count(*) as n, row_number() over (order by cast(event_ts as date) desc) as rk
            from {raw} group by 1) days where rk <= 9) t"""


def all_checks_sql(orders: str, orders_wm: str, events: str, events_wm: str) -> str:
    read = ALL_READ.isoformat(sep=" ")
    parts = [
        parity_sql("customers", "raw_customers", read),
        parity_sql("products", "raw_products", read),
        parity_sql("orders", orders, orders_wm),
        parity_sql("order_items", "raw_order_items", read),
        parity_sql("web_events", events, events_wm),
        amount_sql("raw_order_items"),
        STRAY_SQL.format(first="2024-01", last="2024-01", raw=events),
        NULL_RATE_SQL.format(raw=orders),
        VOLUME_SQL.format(raw=events),
    ]
    return "\nunion all by name\n".join(f"select * from ({p}) u" for p in parts)


def all_checks(shop: Shop, partial: bool) -> DataFrame:
    tables = {s.name: complete(shop, s.name) for s in TABLES}
    if partial:
        tables |= {name: behind(shop, name) for name in CUTOFFS}
    return reconcile.run_checks(tables, "2024-01", "2024-01")


# Two recorded runs: one while orders and events were behind, one after everything was read.
RUNS = (("first", "2024-01-25 01:00:00", True), ("second", "2024-02-09 01:00:00", False))
_READ = ALL_READ.isoformat(sep=" ")
VIEWS["dq_results"] = f"""
select 'first' as run_label, timestamp '{RUNS[0][1]}' as checked_at, *
from ({all_checks_sql('old_orders', ORDER_CUTOFF, 'old_events', EVENT_CUTOFF)}) a
union all by name
select 'second' as run_label, timestamp '{RUNS[1][1]}' as checked_at, *
from ({all_checks_sql('raw_orders', _READ, 'raw_web_events', _READ)}) b"""


def dq_results(shop: Shop) -> DataFrame:
    runs = [
        all_checks(shop, partial).select(
            F.lit(label).alias("run_label"), F.lit(at).cast("timestamp_ntz").alias("checked_at"), *reconcile.COLUMNS
        )
        for label, at, partial in RUNS
    ]
    return reduce(DataFrame.unionByName, runs)
