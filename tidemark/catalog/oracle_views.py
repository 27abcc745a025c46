"""Oracle SQL for the models, as common table expressions over the given parquet tables.

Each states its model by another method than the DataFrame code: as-of joins for windows, lists and unnest for case and
range joins, one aggregate for several.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["raw_customers"] = """
select b.customer_id, case when v.n = 2 then b.full_name || ' II' else b.full_name end as full_name, b.email,
       case when v.n >= 3 then n2.n_name else b.country end as country,
       case when v.n < 4 then b.segment when b.segment = 'BUILDING' then 'MACHINERY' else 'BUILDING' end as segment,
       b.acquisition_channel, b.signup_date, cast(b.signup_date as timestamp) as created_at,
       cast(case v.n when 1 then '1994-01-01 00:00:00' when 2 then '1996-01-01 00:00:00'
            when 3 then '1998-01-01 12:00:00' else '1999-06-01 13:00:00' end as timestamp) as updated_at,
       cast(v.n as bigint) as _batch_id
from (
  select c_custkey as customer_id, c_name as full_name, c_name || '@Example.com' as email, n_name as country,
         c_mktsegment as segment, c_nationkey,
         case c_custkey % 5 when 0 then 'organic' when 1 then 'paid_search' when 2 then 'email'
              when 3 then 'social' else 'affiliate' end as acquisition_channel,
         cast(case c_custkey % 4 when 0 then '1994-06-15' when 1 then '1995-03-01'
              when 2 then '1996-01-31' else '1996-12-31' end as date) as signup_date
  from customer join nation on c_nationkey = n_nationkey) b
join nation n2 on n2.n_nationkey = (b.c_nationkey + 1) % 25
cross join (values (1), (2), (3), (4)) as v(n)
where v.n = 1 or (v.n = 2 and b.customer_id % 7 = 0) or (v.n = 3 and b.customer_id % 10 = 0)
   or (v.n = 4 and b.customer_id % 30 = 0)"""

VIEWS["raw_products"] = """
select p_partkey as product_id, p_name as product_name, p_type as category,
       cast(p_retailprice as decimal(10,2)) as unit_price,
       cast(cast(p_retailprice as decimal(10,2)) * cast('0.60' as decimal(4,2)) as decimal(10,2)) as unit_cost,
       cast('1994-01-01 00:00:00' as timestamp) as created_at,
       cast('1994-01-01 00:00:00' as timestamp) as updated_at, cast(1 as bigint) as _batch_id
from part"""

VIEWS["raw_orders"] = """
select order_id, customer_id, order_ts, case when v.n = 1 then 'pending' else final_status end as status, channel,
       discount_pct, order_ts as created_at,
       case when v.n = 1 then order_ts else order_ts + interval '1' hour * cast(order_id % 120 + 1 as int) end as updated_at,
       cast(v.n as bigint) as _batch_id
from (
  select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as timestamp) as order_ts,
         case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'pending'
              when o_orderkey % 2 = 0 then 'refunded' else 'cancelled' end as final_status,
         case when o_orderkey % 97 = 0 then null when o_orderpriority = '1-URGENT' then 'paid_search'
              when o_orderpriority = '2-HIGH' then 'email' when o_orderpriority = '3-MEDIUM' then 'organic'
              when o_orderpriority = '4-NOT SPECIFIED' then 'social' else 'affiliate' end as channel,
         cast(case when o_orderkey % 10 < 7 then '0.00' when o_orderkey % 10 < 9 then '0.10' else '0.30' end
              as decimal(4,2)) as discount_pct
  from orders) b
cross join (values (1), (2)) as v(n)
where v.n = 1 or final_status <> 'pending'"""

VIEWS["raw_order_items"] = """
select l_orderkey * 10 + l_linenumber as order_item_id, l_orderkey as order_id, l_partkey as product_id,
       cast(l_quantity as int) as quantity, cast(l_extendedprice as decimal(10,2)) as unit_price,
       cast(l_shipdate as timestamp) as created_at, cast(l_shipdate as timestamp) as updated_at,
       cast(1 as bigint) as _batch_id
from lineitem"""

VIEWS["raw_web_events"] = """
select event_id, user_id * 100 + extract(day from ts) as session_id,
       case when event_id % 3 = 0 then user_id end as customer_id, cast(ts as timestamp) as event_ts,
       case event_type when 'view' then 'page_view' when 'click' then 'product_view' when 'signup' then 'add_to_cart'
            when 'error' then 'begin_checkout' else 'purchase' end as event_type,
       case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end as device,
       case when event_id % 50 = 0 then cast(ts as timestamp) + interval '1' day * cast(div_50 % 8 + 1 as int)
            else cast(ts as timestamp) + interval '5' minute end as ingested_at
from (select *, cast(floor(event_id / 50.0) as int) as div_50 from events) e"""

VIEWS["stg_customers"] = """
select customer_id, full_name, md5(lower(email)) as email_hash, country, segment, acquisition_channel, signup_date,
       created_at, updated_at
from (select *, row_number() over (partition by customer_id order by updated_at desc, _batch_id desc) as rn
      from raw_customers) t where rn = 1"""

VIEWS["stg_products"] = """
select product_id, product_name, category, unit_price, unit_cost, updated_at
from (select *, row_number() over (partition by product_id order by updated_at desc) as rn from raw_products) t
where rn = 1"""

_STG_ORDER_ITEMS = """
select order_item_id, order_id, product_id, quantity, unit_price, updated_at from (
  select *, row_number() over (partition by order_item_id
            order by updated_at desc, product_id desc, quantity desc, unit_price desc) as rn from {raw}) t
where rn = 1"""
_STG_ORDERS = """
select order_id, customer_id, order_ts, cast(order_ts as date) as order_date, status, channel, discount_pct, updated_at
from (select *, row_number() over (partition by order_id order by updated_at desc, _batch_id desc) as rn from {raw}) t
where rn = 1"""
VIEWS["stg_order_items"] = _STG_ORDER_ITEMS.format(raw="raw_order_items")
VIEWS["stg_orders"] = _STG_ORDERS.format(raw="raw_orders")

# The version before each version, by an as-of join; rows whose state differs from it begin a period.
VIEWS["customer_changes"] = """
select v.customer_id, v.country, v.segment, v.updated_at as since, p.customer_id is null as opening
from raw_customers v
asof left join raw_customers p on v.customer_id = p.customer_id and v.updated_at > p.updated_at
where p.customer_id is null or v.country is distinct from p.country or v.segment is distinct from p.segment"""
VIEWS["dim_customers_history"] = """
select c.customer_id, c.country, c.segment, if(c.opening, timestamp '1970-01-01 00:00:00', c.since) as valid_from,
       ifnull(n.since, timestamp '9999-12-31 00:00:00') as valid_to, n.since is null as is_current,
       (select count(*) from customer_changes b where b.customer_id = c.customer_id and b.since <= c.since) as version_number
from customer_changes c
asof left join customer_changes n on c.customer_id = n.customer_id and c.since < n.since"""

# One pass over the lines gives totals and newest change; a line without a product counts for the change only. The place of residence
# is the last period that began before the order, if it still runs.
_FCT_ORDERS = """
select order_id, customer_id, order_ts, order_date, status, channel, discount_pct, country, segment, items_count, units,
       gross_revenue, round(gross_revenue * discount_pct, 2) as discount_amount,
       round(gross_revenue * (1 - discount_pct), 2) as net_revenue, cogs,
       round(gross_revenue * (1 - discount_pct) - cogs, 2) as gross_margin,
       status = 'completed' as is_completed, greatest(updated_at, touched) as order_updated_at
from (
  select head.*, if(head.order_ts < home.valid_to, home.country, null) as country,
         if(head.order_ts < home.valid_to, home.segment, null) as segment,
         ifnull(lines.known, 0) as items_count, ifnull(lines.pieces, 0) as units,
         ifnull(lines.sold, cast(0 as decimal(20,2))) as gross_revenue, ifnull(lines.spent, cast(0 as decimal(20,2))) as cogs, lines.touched
  from {orders} head
  left join (
    select order_id, count(unit_cost) as known, sum(if(unit_cost is null, null, quantity)) as pieces,
           cast(sum(if(unit_cost is null, null, quantity * paid)) as decimal(20,2)) as sold,
           cast(sum(quantity * unit_cost) as decimal(20,2)) as spent, max(touched) as touched
    from (select order_id, quantity, line.unit_price as paid, unit_cost, line.updated_at as touched
          from {items} line left join raw_products using (product_id))
    group by order_id) lines using (order_id)
  asof left join dim_customers_history home on head.customer_id = home.customer_id and head.order_ts >= home.valid_from)"""
VIEWS["fct_orders"] = _FCT_ORDERS.format(orders="stg_orders", items="stg_order_items")

VIEWS["fct_order_items"] = """
select oi.order_item_id, oi.order_id, o.order_date, o.status, o.channel, o.country, p.product_id, p.product_name,
       p.category, oi.quantity, oi.quantity * oi.unit_price as line_revenue, oi.quantity * p.unit_cost as line_cost
from stg_order_items oi join fct_orders o on oi.order_id = o.order_id join stg_products p on oi.product_id = p.product_id"""

VIEWS["mart_daily_channel"] = """
select order_date, coalesce(channel, 'unknown') as channel, count(*) as orders,
       sum(net_revenue) as net_revenue, sum(gross_margin) as gross_margin
from fct_orders where is_completed group by 1, 2"""

_EVENT_ORDER = "['page_view', 'product_view', 'add_to_cart', 'begin_checkout', 'purchase']"
_STAGE_NAMES = "['Page view', 'Product view', 'Add to cart', 'Begin checkout', 'Purchase']"
_SESSIONS = f"""
select session_id, cast(min(event_ts) as date) as event_date, min(device) as device,
       max(list_position({_EVENT_ORDER}, event_type)) as furthest_stage
from {{events}} group by session_id"""
_FUNNEL = f"""
select md5(concat_ws('|', strftime(event_date, '%Y-%m-%d'), device, stage)) as funnel_key, event_date, device, stage, stage_order, sessions
from (select event_date, device, {_STAGE_NAMES}[reached] as stage, cast(reached as int) as stage_order, count(*) as sessions
      from (select event_date, device, unnest(range(1, furthest_stage + 1)) as reached from {{sessions}})
      group by event_date, device, reached)"""
VIEWS["sessions"] = _SESSIONS.format(events="raw_web_events")
VIEWS["mart_funnel_daily"] = _FUNNEL.format(sessions="sessions")

# Each customer once per month of activity, so counting rows counts customers.
VIEWS["mart_cohort_retention"] = """
select cohort_month, months_since_signup, cohort_size, count(*) as active_customers,
       round(count(*) / cast(cohort_size as double), 4) as retention_rate
from (
  select distinct cohort_month, cohort_size, customer_id, cast(date_diff('month', cohort_month, order_date) as int) as months_since_signup
  from fct_orders
  join (select customer_id, cast(date_trunc('month', signup_date) as date) as cohort_month,
               count(*) over (partition by date_trunc('month', signup_date)) as cohort_size from stg_customers) using (customer_id)
  where is_completed)
where months_since_signup >= 0 group by cohort_month, months_since_signup, cohort_size"""


def _fifth(order: str) -> str:
    """The fifth of the table a row is in, by arithmetic on its place; the first ones take what does not divide."""
    place, n = f"(row_number() over (order by {order}) - 1)", "count(*) over ()"
    small, more = f"({n} // 5)", f"({n} % 5)"
    return f"if({place} < {more} * ({small} + 1), {place} // ({small} + 1), {more} + ({place} - {more} * ({small} + 1)) // greatest({small}, 1)) + 1"


VIEWS["mart_customer_rfm"] = f"""
select customer_id, recency_days, frequency, monetary, cast(r as int) as r_score, cast(f as int) as f_score, cast(m as int) as m_score,
       case when r < 3 then if(f < 3, 'Needs attention', 'At risk') when f >= 4 and r >= 4 then 'Champions'
            when f >= 3 then 'Loyal' when r >= 4 then 'Recent' else 'Needs attention' end as rfm_segment
from (
  select *, {_fifth("recency_days desc, customer_id")} as r, {_fifth("frequency, customer_id")} as f, {_fifth("monetary, customer_id")} as m
  from (
    select customer_id, cast(date_diff('day', max(order_date), max(max(order_date)) over ()) as int) as recency_days,
           count(*) as frequency, sum(net_revenue) as monetary
    from fct_orders where is_completed group by customer_id))"""


VIEWS["stg_web_events"] = """
select event_id, session_id, customer_id, event_ts, cast(event_ts as date) as event_date, event_type, device, ingested_at
from raw_web_events"""
VIEWS["stg_customer_versions"] = "select customer_id, country, segment, updated_at from raw_customers"
VIEWS["dim_customers"] = """
select customer_id, full_name, email_hash, country, segment, acquisition_channel, signup_date, updated_at
from stg_customers"""
VIEWS["dim_products"] = "select product_id, product_name, category, unit_price, unit_cost from stg_products"


def with_views(sql: str) -> str:
    """Prefix a statement with the views it needs, directly or through other views, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed)
    body = sql.strip()
    if body.startswith("with "):
        return f"with {ctes},\n{body.removeprefix('with ')}"
    return f"with {ctes}\n{body}"
