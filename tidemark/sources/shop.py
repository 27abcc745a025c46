"""The shop's change log, derived from the star-schema parquet tables of one scale-factor folder.

Repeated line numbers become versions of one order item, finished orders get a second version when they
complete, and some customers move country or segment, so every job has real versions to work on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.readers import read_files

# Seen by the hourly poll that follows the change.
LOADED = "updated_at + INTERVAL 1 HOUR AS _loaded_at"


# Declared, so that planning a query needs no job that looks into file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_type string, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_files(spark, f"{sf_dir}/{name}.parquet", schema=SCHEMAS[name])


def _versions(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return _read(spark, sf_dir, name).selectExpr(*columns)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    here = nation.selectExpr("n_nationkey AS c_nationkey", "n_name AS country_1")
    there = nation.selectExpr("n_nationkey AS next_nationkey", "n_name AS country_2")
    versions = (
        "explode(array_compact(array(1, IF(c_custkey % 7 = 0, 2, NULL), IF(c_custkey % 10 = 0, 3, NULL), "
        "IF(c_custkey % 30 = 0, 4, NULL)))) AS n"
    )
    base = (
        _read(spark, sf_dir, "customer")
        .join(here, "c_nationkey")
        .withColumn("next_nationkey", F.expr("(c_nationkey + 1) % 25"))
        .join(there, "next_nationkey")
    )
    return base.select("*", F.expr(versions)).selectExpr(
        "c_custkey AS customer_id",
        "IF(n = 2, c_name || ' II', c_name) AS full_name",
        "c_name || '@Example.com' AS email",
        "IF(n >= 3, country_2, country_1) AS country",
        "CASE WHEN n < 4 THEN c_mktsegment WHEN c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE 'BUILDING' END AS segment",
        "elt(CAST(c_custkey % 5 AS INT) + 1, 'organic', 'paid_search', 'email', 'social', 'affiliate')"
        " AS acquisition_channel",
        "CAST(elt(CAST(c_custkey % 4 AS INT) + 1, '1994-06-15', '1995-03-01', '1996-01-31', '1996-12-31') AS DATE)"
        " AS signup_date",
        "CAST(elt(n, '1994-01-01 00:00:00', '1996-01-01 00:00:00', '1998-01-01 12:00:00', '1999-06-01 13:00:00')"
        " AS TIMESTAMP_NTZ) AS updated_at",
        "CAST(n AS BIGINT) AS _batch_id",
    ).selectExpr(
        "customer_id", "full_name", "email", "country", "segment", "acquisition_channel", "signup_date",
        "CAST(signup_date AS TIMESTAMP_NTZ) AS created_at", "updated_at", "_batch_id", LOADED,
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(
        spark, sf_dir, "part",
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price",
        "CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST('0.60' AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS unit_cost",
        "TIMESTAMP_NTZ'1994-01-01 00:00:00' AS created_at",
        "TIMESTAMP_NTZ'1994-01-01 00:00:00' AS updated_at",
        "1L AS _batch_id",
    ).selectExpr("*", LOADED)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _versions(
        spark, sf_dir, "orders",
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderdate AS order_ts",
        "CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending'"
        " WHEN o_orderkey % 2 = 0 THEN 'refunded' ELSE 'cancelled' END AS final_status",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'paid_search'"
        " WHEN o_orderpriority = '2-HIGH' THEN 'email' WHEN o_orderpriority = '3-MEDIUM' THEN 'organic'"
        " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'social' ELSE 'affiliate' END AS channel",
        "CAST(CASE WHEN o_orderkey % 10 < 7 THEN '0.00' WHEN o_orderkey % 10 < 9 THEN '0.10' ELSE '0.30' END"
        " AS DECIMAL(4,2)) AS discount_pct",
    )
    versions = heads.selectExpr("*", "explode(IF(final_status = 'pending', array(1), array(1, 2))) AS n")
    return versions.selectExpr(
        "order_id",
        "customer_id",
        "order_ts",
        "IF(n = 1, 'pending', final_status) AS status",
        "channel",
        "discount_pct",
        "order_ts AS created_at",
        "IF(n = 1, order_ts, order_ts + make_dt_interval(0, CAST(order_id % 120 AS INT) + 1)) AS updated_at",
        "CAST(n AS BIGINT) AS _batch_id",
    ).selectExpr("*", LOADED)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(
        spark, sf_dir, "lineitem",
        "l_orderkey * 10 + l_linenumber AS order_item_id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price",
        "l_shipdate AS created_at",
        "l_shipdate AS updated_at",
        "1L AS _batch_id",
    ).selectExpr("*", LOADED)


# One session per user and day; every 50th event is ingested one to eight days late.
WEB_EVENT_COLUMNS = (
    "event_id",
    "user_id * 100 + day(ts) AS session_id",
    "IF(event_id % 3 = 0, user_id, NULL) AS customer_id",
    "ts AS event_ts",
    "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart'"
    " WHEN 'error' THEN 'begin_checkout' ELSE 'purchase' END AS event_type",
    "elt(CAST(event_id % 3 AS INT) + 1, 'mobile', 'desktop', 'tablet') AS device",
    "IF(event_id % 50 = 0, ts + make_dt_interval(CAST(floor(event_id / 50) % 8 AS INT) + 1),"
    " ts + INTERVAL 5 MINUTES) AS ingested_at",
)


def raw_web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir, "events", *WEB_EVENT_COLUMNS, "1L AS _batch_id").selectExpr(
        "*", "ingested_at + INTERVAL 1 HOUR AS _loaded_at"
    )


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "web_events": raw_web_events,
}
