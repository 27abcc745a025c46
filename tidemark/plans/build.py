"""Build the stored marts from raw, and run the whole cycle: load, reconcile, build, test."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import wall_clock
from tidemark.operators.assertions import RowCounts, run_tests
from tidemark.operators.drift import enforce_contract
from tidemark.plans import marts, reconcile, staging
from tidemark.plans.load import LoadResult, load_all, utc_now
from tidemark.plans.suite import declared_tests, row_conditions
from tidemark.session import run_parallel, scratch_path, shuffle_files_deleted
from tidemark.sources.raw_store import RawStore
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.tables import SnapshotTable, delete_path, write_parts
from tidemark.specs import FCT_ORDERS_CONTRACT, TABLES


BUILD_THREADS = 4
#: Buckets a month at least; a table of many orders gets more, so that a bucket of the fact fits the memory of a task.
ORDER_BUCKETS = 16


class DataTestError(RuntimeError):
    """At least one declared data test of severity error found rows."""


def orders_table(spark: SparkSession, path: str, buckets: int = ORDER_BUCKETS) -> BucketedTable:
    """The order fact by month of the order, which never changes, and bucketed by order."""
    return BucketedTable(spark, path, F.date_format("order_ts", "yyyy-MM"), FCT_ORDERS_CONTRACT, "order_id", buckets)


class Warehouse:
    """The stored marts below one root folder."""

    def __init__(self, spark: SparkSession, root: str, order_buckets: int = ORDER_BUCKETS, part_rows: int = marts.PART_ROWS):
        self.spark, self.root, self.order_buckets, self.part_rows = spark, root.rstrip("/"), order_buckets, part_rows
        #: Violations of row tests by label, counted while the models of the last build were written.
        self.observed: dict[str, int] = {}

    def snapshot(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}")

    @property
    def fct_orders(self) -> BucketedTable:
        return orders_table(self.spark, f"{self.root}/fct_orders", self.order_buckets)

    def build(self, raw: Mapping[str, DataFrame], full_refresh: bool = False) -> dict[str, DataFrame]:
        """Build every model; staging stays lazy, marts are written once and read back by their consumers.

        The order fact and the funnel are incremental unless they are missing, empty or refreshed. Each step is written, so its
        shuffle files go with it; those of a whole build would take many times the disk of the models.
        """
        place = scratch_path(self.spark, "current-items")
        with shuffle_files_deleted(self.spark):
            try:
                return self._build(raw, full_refresh, self._parts(raw["order_items"]), place)
            finally:
                delete_path(self.spark, place)

    def _parts(self, items: DataFrame) -> int:
        return max(1, -(-items.count() // self.part_rows))

    def _build(self, raw: Mapping[str, DataFrame], full_refresh: bool, parts: int, place: str) -> dict[str, DataFrame]:
        m = {
            "stg_customers": staging.stg_customers(raw["customers"]),
            "stg_products": staging.stg_products(raw["products"]),
            "stg_orders": staging.stg_orders(raw["orders"]),
            "stg_order_items": staging.stg_order_items(raw["order_items"]),
            "stg_web_events": staging.stg_web_events(raw["web_events"]),
            "stg_customer_versions": staging.stg_customer_versions(raw["customers"]),
        }

        def build(*jobs: tuple[str, Callable[[], DataFrame]]) -> None:
            results = run_parallel(self.spark, [make for _, make in jobs], BUILD_THREADS)
            m.update((name, df) for (name, _), df in zip(jobs, results))

        self.observed, conditions = {}, row_conditions()

        def write(name: str, *frames: DataFrame) -> DataFrame:
            if name not in conditions:
                return self.snapshot(name).write(*frames)
            counts = [RowCounts(conditions[name]) for _ in frames]
            written = self.snapshot(name).write(*[c.attach(df) for c, df in zip(counts, frames)])
            found = [c.get() for c in counts]
            self.observed.update((label, sum(f[label] for f in found)) for label in conditions[name] if all(label in f for f in found))
            return written

        def table(name: str, make: Callable[[], DataFrame]) -> tuple[str, Callable[[], DataFrame]]:
            return name, lambda: write(name, make())

        def lines(i: int) -> DataFrame:
            own = marts.in_part("order_id", parts, i)
            return marts.fct_order_items(items.filter(own), m["fct_orders"].filter(own), m["dim_products"])

        build(
            table("dim_customers", lambda: marts.dim_customers(m["stg_customers"])),
            table("dim_products", lambda: marts.dim_products(m["stg_products"])),
            table("dim_customers_history", lambda: marts.dim_customers_history(m["stg_customer_versions"])),
            ("mart_funnel_daily", lambda: self._build_funnel(m, full_refresh)),
        )
        # The newest versions of the items are picked once, for both facts.
        items = write_parts(place, (m["stg_order_items"].filter(marts.in_part("order_item_id", parts, i)) for i in range(parts)))
        build(("fct_orders", lambda: self._build_fct_orders(m, raw, items, full_refresh, parts)))
        build(
            ("fct_order_items", lambda: write("fct_order_items", *[lines(i) for i in range(parts)])),
            table("mart_daily_channel", lambda: marts.mart_daily_channel(m["fct_orders"])),
            table(
                "mart_cohort_retention",
                lambda: marts.mart_cohort_retention(m["dim_customers"], m["fct_orders"]),
            ),
            table("mart_customer_rfm", lambda: marts.mart_customer_rfm(m["fct_orders"])),
        )
        return m

    def _build_fct_orders(self, m, raw, items, full_refresh, parts) -> DataFrame:
        table, history, products = self.fct_orders, m["dim_customers_history"], m["dim_products"]
        current = table.read() if table.exists() and not full_refresh else None
        since = current.agg(F.max("order_updated_at")).first()[0] if current is not None else None
        place = scratch_path(self.spark, "order-fact")
        if since is None:
            full = marts.write_fct_orders(place, m["stg_orders"], items, products, history, parts)
            enforce_contract(FCT_ORDERS_CONTRACT, full.schema, "fct_orders")
            table.overwrite(full, raw["orders"].count())
        else:
            changed = marts.changed_orders(raw["orders"], raw["order_items"], wall_clock(since))
            orders = staging.stg_orders(raw["orders"].join(changed, "order_id", "left_semi"))
            known = items.join(changed, "order_id", "left_semi")
            delta = marts.write_fct_orders(place, orders, known, products, history, parts)
            enforce_contract(FCT_ORDERS_CONTRACT, delta.schema, "fct_orders")
            table.merge(delta, ["order_id"], at_rest=True)
        delete_path(self.spark, place)
        return table.read()

    def _build_funnel(self, m, full_refresh) -> DataFrame:
        table, events = self.snapshot("mart_funnel_daily"), m["stg_web_events"]
        newest = None
        if table.exists() and not full_refresh:
            newest = table.read().agg(F.max("event_date")).first()[0]
        if newest is None:
            return table.write(marts.mart_funnel_daily(events))
        return table.write(marts.funnel_incremental(table.read(), events))

    def run_tests(self, models: Mapping[str, DataFrame]) -> DataFrame:
        """The declared tests of models that :meth:`build` returned. Those that several tests would pick anew are stored meanwhile."""
        place = scratch_path(self.spark, "tested")

        def kept(name: str, key: str, parts: int) -> DataFrame:
            return write_parts(f"{place}/{name}", (models[name].filter(marts.in_part(key, parts, i)) for i in range(parts)))

        try:
            with shuffle_files_deleted(self.spark):
                parts = self._parts(models["fct_order_items"])
                stored = {name: kept(name, key, parts) for name, key in (("stg_orders", "order_id"), ("stg_order_items", "order_item_id"))}
                return run_tests(declared_tests({**models, **stored}, self.observed))
        finally:
            delete_path(self.spark, place)


def run_cycle(
    store: RawStore,
    warehouse: Warehouse,
    sources: Mapping[str, DataFrame],
    months: tuple[str, str] | None = None,
    run_label: str = "",
    full_refresh: bool = False,
    now: datetime | None = None,
) -> tuple[list[LoadResult], dict[str, DataFrame], DataFrame]:
    """Load, reconcile, and only if nothing failed build and test. Check results are kept either way.

    ``months`` are the first and last one events may have; without them it is what raw has registered.
    """
    at = now or utc_now()
    loads = load_all(store, sources, run_label, now=now)
    raw = {s.name: store.read_raw(s) for s in TABLES}
    loaded = {s.name: reconcile.Loaded(s, sources[s.name], raw[s.name], store.watermark(s)) for s in TABLES}
    store.record_checks(reconcile.run_checks(loaded, *(months or ())), run_label, at)
    this_run = (F.col("run_label") == run_label) & (F.col("checked_at") == wall_clock(at))
    recorded = store.dq_results().filter(this_run)
    reconcile.raise_on_fail(recorded)
    models = warehouse.build(raw, full_refresh)
    return loads, models, warehouse.run_tests(models)


def raise_on_failed_tests(results: DataFrame) -> None:
    failed = results.filter(F.col("verdict") == "fail").collect()  # at most one row per declared test
    if failed:
        raise DataTestError("; ".join(f"{r.test}: {r.violations} rows" for r in failed))
