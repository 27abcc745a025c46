from datetime import datetime

import pytest
from conftest import rows

from tidemark.plans.load import load_table
from tidemark.session import scratch_path
from tidemark.sources.raw_store import RawStore
from tidemark.sources.readers import read_files, utc_wall_clock
from tidemark.specs import ORDERS

AT = datetime(2024, 7, 1, 12)


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_file_formats_round_trip(spark, fmt):
    path = scratch_path(spark, fmt)
    spark.createDataFrame([(1, 2, AT, "pending", None, None, AT, AT)], ORDERS.schema).write.format(fmt).save(path)
    df = read_files(spark, path, fmt, ORDERS.schema)
    assert rows(df, "order_id", "order_ts", "status", "channel") == [(1, AT, "pending", None)]


def test_text_formats_need_a_schema(spark):
    with pytest.raises(ValueError, match="schema"):
        read_files(spark, "/nowhere", "csv")
    with pytest.raises(ValueError, match="format"):
        read_files(spark, "/nowhere", "avro")


def test_zoned_timestamps_become_utc_wall_clock(spark, new_york):
    zoned = spark.sql("SELECT TIMESTAMP'2024-07-01T12:00:00Z' AS t, 1 AS n")
    df = utc_wall_clock(zoned)
    assert dict(df.dtypes)["t"] == "timestamp_ntz"
    assert rows(df) == [(AT, 1)]


def test_loads_do_not_depend_on_the_session_time_zone(spark, new_york):
    store = RawStore(spark, scratch_path(spark, "store"))
    source = spark.createDataFrame([(1, 2, AT, "pending", None, None, AT, AT)], ORDERS.schema)
    first = load_table(store, ORDERS, source, now=AT)
    assert (first.rows_inserted, first.watermark_to) == (1, AT)
    assert rows(store.read_raw(ORDERS), "updated_at", "_loaded_at") == [(AT, AT)]
    again = load_table(store, ORDERS, source)
    assert (again.rows_extracted, again.rows_inserted) == (1, 0)
