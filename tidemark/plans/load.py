"""Incremental, idempotent and atomic loads from mutable sources into the raw layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import astuple, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import wall_clock
from tidemark.operators import drift
from tidemark.operators.merge import extract_range, new_rows
from tidemark.session import run_parallel
from tidemark.sources.raw_store import DEFAULT_MONTH, FAILED, MONTH, RUNNING, SUCCESS, RawStore
from tidemark.sources.tables import delete_path
from tidemark.specs import DEFAULT_OVERLAP_SECONDS, TABLES, TableSpec

PARALLEL_LOADS = 5


@dataclass(frozen=True)
class LoadResult:
    table_name: str
    batch_id: int
    rows_extracted: int
    rows_inserted: int
    watermark_from: datetime | None
    watermark_to: datetime | None

    @property
    def rows_ignored(self) -> int:
        return self.rows_extracted - self.rows_inserted


RESULT_SCHEMA = (
    "table_name string, batch_id long, rows_extracted long, rows_inserted long, "
    "watermark_from timestamp_ntz, watermark_to timestamp_ntz"
)


@dataclass(frozen=True)
class LogSource:
    """A source whose rows are picked from a log: per key a version with the greatest cursor.

    So its newest cursor is that of the log, and versions at or before a bound can go before the pick: of a key whose newest version
    is after the bound that version stays, and any other key has no row in range. Only versions in range are shuffled, once.
    When ``key`` says by which columns they are picked, no copies are looked for among them.
    """

    log: DataFrame
    pick: Callable[[DataFrame], DataFrame]
    key: Sequence[str] = ()

    @property
    def rows(self) -> DataFrame:
        return self.pick(self.log)

    def changed(self, change: Callable[[DataFrame], DataFrame]) -> LogSource:
        """The source with ``change`` made to its rows, which must keep the cursor and the key."""
        return LogSource(self.log, lambda log: change(self.pick(log)), self.key)

    def distinct_by(self, key: Sequence[str]) -> bool:
        return bool(self.key) and set(self.key) <= set(key)

    def extract(self, cursor: str, upper, watermark=None, overlap_seconds: int = 0) -> DataFrame:
        return extract_range(self.pick(extract_range(self.log, cursor, None, watermark, overlap_seconds)), cursor, upper)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_table(
    store: RawStore,
    spec: TableSpec,
    source: DataFrame | LogSource,
    run_label: str = "",
    *,
    full: bool = False,
    overlap_seconds: int = DEFAULT_OVERLAP_SECONDS,
    now: datetime | None = None,
    batch_id: int | None = None,
    finished: datetime | None = None,
) -> LoadResult:
    """Load what changed since the watermark. Any error leaves a ``failed`` audit row and nothing else.

    ``now`` and ``finished`` are what the audit records as start and end, for replays; by default the clock is read.
    """

    def extract(batch_id: int) -> LoadResult:
        watermark = None if full else store.watermark(spec)
        upper = (source.log if logged else source).agg(F.max(spec.cursor)).first()[0]
        if upper is None:
            return LoadResult(spec.name, batch_id, 0, 0, None, None)
        columns = drift.raw_projection(spec.raw_schema)
        bounds = (spec.cursor, upper, watermark, overlap_seconds)
        rows = source.extract(*bounds) if logged else extract_range(source, *bounds)
        distinct = logged and source.distinct_by(spec.raw_key)
        return _insert(store, spec, rows.select(*columns), batch_id, watermark, upper, started, distinct)

    logged, started = isinstance(source, LogSource), now or utc_now()
    return _attempt(store, spec, source.rows if logged else source, run_label, started, extract, batch_id, finished)


def load_batch(
    store: RawStore, spec: TableSpec, rows: DataFrame, run_label: str, now: datetime | None = None
) -> LoadResult | None:
    """Load rows that were delivered rather than extracted, once per ``run_label``."""
    if store.has_run(spec, run_label):
        return None

    def insert(batch_id: int) -> LoadResult:
        columns = drift.raw_projection(spec.raw_schema)
        return _insert(store, spec, rows.select(*columns), batch_id, store.watermark(spec), None, started)

    started = now or utc_now()
    return _attempt(store, spec, rows, run_label, started, insert)


def _attempt(store, spec, source, run_label, started, work, batch_id=None, finished=None) -> LoadResult:
    batch_id = batch_id or store.next_batch_id()
    opened = {"run_label": run_label, "started_at": started}
    store.publish(spec, batch_id, RUNNING, **opened)
    try:
        found = drift.detect(spec, source.schema, spec.raw_schema)
        store.record_drift(found, batch_id, run_label, started)
        drift.raise_on_error(found)
        result = work(batch_id)
    except Exception as exc:
        store.publish(spec, batch_id, FAILED, finished_at=finished or utc_now(), error=str(exc), **opened)
        raise
    store.publish(
        spec,
        batch_id,
        SUCCESS,
        finished_at=finished or utc_now(),
        watermark_from=result.watermark_from,
        watermark_to=result.watermark_to,
        rows_extracted=result.rows_extracted,
        rows_inserted=result.rows_inserted,
        **opened,
    )
    store.compact_if_due(spec)
    return result


def _insert(store, spec, rows, batch_id, watermark, upper, loaded_at, distinct=False) -> LoadResult:
    # The source may change while we read it, so it is read once: later steps, and tasks that run again
    # after an executor is lost, see the staged copy.
    stage = store.stage_path(spec, batch_id)
    try:
        rows.write.parquet(stage)
        staged = store.spark.read.schema(rows.schema).parquet(stage)
        version, cursor = spec.version_column, spec.cursor
        extracted, low, high, newest = staged.agg(
            F.count(F.lit(1)), F.min(version), F.max(version), F.max(cursor)
        ).first()
        if not extracted:  # no batch to see, and nothing newer than the watermark
            return LoadResult(spec.name, batch_id, 0, 0, watermark, None)
        # A conflict has the same version value, so only raw rows in the batch's range can conflict.
        if spec.partition_column and store.months_on_demand:
            store.register_months(spec, low, high, batch_id)
        existing = known = None
        if store.visible(spec):
            existing = store.read_raw(spec, low if version == cursor else None)
            existing = existing.filter(F.col(version).between(wall_clock(low), wall_clock(high)))
            if spec.partition_column == version:
                in_range = F.col(MONTH).between(f"{low:%Y-%m}", f"{high:%Y-%m}") | (F.col(MONTH) == DEFAULT_MONTH)
                existing = existing.filter(in_range)
            # Of what a later load overlaps with there is little; counting it reads the version column and spares the batch a shuffle.
            known = existing.count() if distinct else None
        fresh = new_rows(staged, existing, spec.raw_key, extracted, existing_rows=known, distinct=distinct)
        store.write_batch(spec, fresh.withColumn("_loaded_at", wall_clock(loaded_at)), batch_id)
        inserted = store.read_batch(spec, batch_id).count()
        return LoadResult(spec.name, batch_id, extracted, inserted, watermark, upper or newest)
    finally:
        delete_path(store.spark, stage)


def load_all(
    store: RawStore,
    sources: Mapping[str, DataFrame | LogSource],
    run_label: str = "",
    *,
    tables: Sequence[TableSpec] = TABLES,
    full: bool = False,
    overlap_seconds: int = DEFAULT_OVERLAP_SECONDS,
    now: datetime | None = None,
    finished: datetime | None = None,
) -> list[LoadResult]:
    """Load the tables side by side, under batch ids in their order. A table that fails stops no other;
    its error is raised when all have ended."""
    first = store.next_batch_id()

    def job(spec: TableSpec, batch_id: int):
        return lambda: load_table(
            store, spec, sources[spec.name], run_label,
            full=full, overlap_seconds=overlap_seconds, now=now, batch_id=batch_id, finished=finished,
        )

    return run_parallel(store.spark, [job(s, first + i) for i, s in enumerate(tables)], PARALLEL_LOADS)


def results_frame(spark: SparkSession, results: Sequence[LoadResult]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in results], RESULT_SCHEMA)
