from datetime import date

from conftest import rows

from tidemark.operators.metrics import DATASETS, metric_query, with_share
from tidemark.plans import dashboards, exercises


def orders(spark):
    data = [
        (date(2024, 1, 1), 1, "FR", "A", "email", "completed", True, "10.00", "4.00"),
        (date(2024, 1, 3), 1, "FR", "A", None, "completed", True, "30.00", "6.00"),
        (date(2024, 1, 8), 2, "DE", "B", "email", "refunded", False, "99.00", "9.00"),
        (date(2024, 1, 9), 3, "DE", "B", "social", "completed", True, "20.00", "-1.00"),
    ]
    df = spark.createDataFrame(
        data,
        "order_date date, customer_id long, country string, segment string, channel string, status string, "
        "is_completed boolean, net_revenue string, gross_margin string",
    )
    return df.withColumns(
        {c: df[c].cast("decimal(20,2)") for c in ("net_revenue", "gross_margin")}
    )


def test_order_kpis(spark):
    row = dashboards.kpi_overview(orders(spark)).first()
    assert (float(row.revenue), row.orders, row.aov, row.active_customers, row.refund_rate) == (60.0, 3, 20.0, 2, 0.25)
    assert row.gross_margin_pct == 0.15


def test_no_completed_orders_give_null_ratios(spark):
    row = dashboards.kpi_overview(orders(spark).filter("NOT is_completed")).first()
    assert (float(row.revenue), row.orders, row.aov, row.gross_margin_pct) == (0.0, 0, None, None)


def test_grain_range_and_filters(spark):
    weekly = metric_query(orders(spark), "orders", ["orders"], ["country"], grain="P1W")
    assert rows(weekly) == [
        (date(2024, 1, 1), "FR", 2), (date(2024, 1, 8), "DE", 1),
    ]
    ranged = metric_query(orders(spark), "orders", ["orders"], time_range=("2024-01-03", "2024-01-09"))
    assert rows(ranged) == [(1,)]
    picked = metric_query(orders(spark), "orders", ["orders"], filters={"channel": ["email", "social"]})
    assert rows(picked) == [(2,)]


def test_limit_keeps_the_top_rows_in_a_total_order(spark):
    top = metric_query(orders(spark), "orders", ["revenue"], ["country"], order_desc="revenue", row_limit=1)
    assert [(r.country, float(r.revenue)) for r in top.collect()] == [("FR", 40.0)]


def test_every_metric_has_a_result(spark):
    frames = {
        "orders": orders(spark),
        "daily": spark.createDataFrame([(date(2024, 1, 1), 5)], "order_date date, net_revenue long"),
        "funnel": spark.createDataFrame([(date(2024, 1, 1), 5)], "event_date date, sessions long"),
        "retention": spark.sql("SELECT CAST(0.5 AS DECIMAL(10,4)) AS retention_rate"),
        "rfm": spark.range(4),
        "loads": spark.sql("SELECT 3L AS rows_inserted, 'failed' AS status, CAST(1.5 AS DECIMAL(18,6)) AS duration_seconds"),
        "dq": spark.sql("SELECT 'fail' AS status"),
        "drift": spark.range(2),
    }
    got = {}
    for name, dataset in DATASETS.items():
        got |= metric_query(frames[name], name, list(dataset.metrics)).first().asDict()
    assert len(got) == sum(len(d.metrics) for d in DATASETS.values()) == 16
    assert got["drift_events"] == 2 and got["failed_loads"] == 1 and got["avg_retention"] == 0.5
    nothing = metric_query(frames["loads"].filter("false"), "loads", ["rows_loaded", "avg_seconds"]).first()
    assert tuple(nothing) == (0, None)


def test_share_and_margin_order(spark):
    shared = with_share(metric_query(orders(spark), "rfm", ["customers"], ["country"]), "customers", "share")
    assert rows(shared) == [("DE", 2, 0.5), ("FR", 2, 0.5)]
    # A channel without revenue has no margin and comes first in descending order.
    zero = spark.createDataFrame([("x", True, 0, 1), ("y", True, 2, 1)], "channel string, is_completed boolean, net_revenue long, gross_margin long")
    assert [tuple(r) for r in exercises.channel_margin(zero).collect()] == [("x", None), ("y", 0.5)]


def test_drift_log_is_newest_first(spark):
    log = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01' AS detected_at, 'r' AS run_label, 'orders' AS table_name, 'column_added' AS kind, "
        "'a' AS column_name, '' AS detail, 'warn' AS severity UNION ALL "
        "SELECT TIMESTAMP_NTZ'2024-02-01', 'r', 'orders', 'column_added', 'b', '', 'warn'"
    )
    assert [r.column_name for r in dashboards.drift_log(log).collect()] == ["b", "a"]
