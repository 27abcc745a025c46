"""The raw layer and its bookkeeping on a shared file system.

A batch is written below ``raw/<table>/_batch_id=<n>`` first. It becomes visible when one audit row with
status ``success`` is published. Readers take only batches with such a row, and the watermark is the
greatest ``watermark_to`` of those rows, so data, watermark and audit appear in one step.

After every ``compact_every`` attempts the audit rows of a table go into one snapshot and its batches into merged folders; one small
state file, published by a rename, names both. Whoever reads takes the newest state and the attempts after it, so the files
listed and read do not grow with the number of loads, and a reader sees the table before or after a compaction. Merged folders
are merged again when as many of one size have come together, so a row is rewritten a logarithmic number of times.

Tables split by month have a registry of months. Rows of other months go to a default folder until their month is registered.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import seconds_between, wall_clock
from tidemark.operators.drift import Drift
from tidemark.operators.versions import latest_version
from tidemark.sources.tables import delete_path, list_names, publish_text, read_text
from tidemark.specs import TableSpec

_TS = T.TimestampNTZType()
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_label", T.StringType()),
        T.StructField("started_at", _TS),
        T.StructField("finished_at", _TS),
        T.StructField("watermark_from", _TS),
        T.StructField("watermark_to", _TS),
        T.StructField("rows_extracted", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)
DRIFT_SCHEMA = (
    "detected_at timestamp_ntz, run_label string, table_name string, kind string, column_name string, "
    "detail string, severity string"
)
DQ_SCHEMA = (
    "run_label string, checked_at timestamp_ntz, check_name string, table_name string, status string, "
    "expected string, actual string, details string"
)
RUNNING, SUCCESS, FAILED = "running", "success", "failed"
MONTH, DEFAULT_MONTH = "event_month", "default"
COMPACT_EVERY, MERGE_FOLDERS = 50, 8


@dataclass(frozen=True)
class Folder:
    """A folder of visible rows: a batch (level 0), or batches merged ``level`` times."""

    name: str
    level: int
    reached: datetime

    def to_json(self) -> dict:
        return asdict(self) | {"reached": self.reached.isoformat(sep=" ")}

    @classmethod
    def from_json(cls, values: dict) -> Folder:
        return cls(values["name"], values["level"], datetime.fromisoformat(values["reached"]))


@dataclass(frozen=True)
class State:
    """What a compaction left: the merged folders, and the audit up to and including one batch id."""

    number: int = 0
    upto: int = 0
    folders: tuple[Folder, ...] = ()


def _id_of(path: str, key: str) -> int:
    return int(path.split(f"{key}=", 1)[1].split("/", 1)[0])


def months_between(first: datetime, last: datetime) -> list[str]:
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    at = first.year * 12 + first.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(at, at + count)]


class RawStore:
    """``months_on_demand`` registers the months of a batch before it is written; without it someone has to."""

    def __init__(self, spark: SparkSession, root: str, compact_every: int = COMPACT_EVERY, months_on_demand: bool = True):
        self.spark, self.root = spark, root.rstrip("/")
        self.compact_every, self.months_on_demand = compact_every, months_on_demand

    # --- raw ---

    def _raw(self, spec: TableSpec, folder: str) -> str:
        return f"{self.root}/raw/{spec.name}/{folder}"

    def batch_path(self, spec: TableSpec, batch_id: int) -> str:
        return self._raw(spec, f"_batch_id={batch_id}")

    def stage_path(self, spec: TableSpec, batch_id: int) -> str:
        return f"{self.root}/stage/{spec.name}/batch={batch_id}"

    def write_batch(self, spec: TableSpec, rows: DataFrame, batch_id: int) -> None:
        if spec.partition_column:
            rows = self._by_month(spec, rows)
        self._write(spec, rows, self.batch_path(spec, batch_id))

    def _by_month(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        month = F.date_format(spec.partition_column, "yyyy-MM")
        place = F.when(month.isin(self.months(spec)), month).otherwise(DEFAULT_MONTH)
        return rows.withColumn(MONTH, place).hint("rebalance", MONTH)

    def _write(self, spec: TableSpec, rows: DataFrame, path: str) -> None:
        writer = rows.write.mode("overwrite")
        if spec.partition_column:
            writer = writer.partitionBy(MONTH)
        writer.parquet(path)

    def _merge(self, spec: TableSpec, folders: list[Folder], name: str) -> Folder:
        """The rows of the folders in a new one, sorted so that a range of the cursor reads few row groups."""
        rows = self._read(spec, [f.name for f in folders])
        rows = self._by_month(spec, rows) if spec.partition_column else rows.hint("rebalance")
        order = [MONTH, spec.cursor] if spec.partition_column else [spec.cursor]
        self._write(spec, rows.sortWithinPartitions(*order), self._raw(spec, name))
        return Folder(name, max(f.level for f in folders) + 1, max(f.reached for f in folders))

    def read_batch(self, spec: TableSpec, batch_id: int) -> DataFrame:
        return self._read(spec, [f"_batch_id={batch_id}"])

    def read_raw(self, spec: TableSpec, seen_since: datetime | None = None) -> DataFrame:
        """All visible rows. ``seen_since`` skips folders that ended before that cursor value."""
        return self._read(spec, [f.name for f in self.visible(spec) if seen_since is None or f.reached >= seen_since])

    def _read(self, spec: TableSpec, folders: list[str]) -> DataFrame:
        fields = spec.schema.fields + [T.StructField("_loaded_at", _TS)]
        fields += [T.StructField(MONTH, T.StringType())] if spec.partition_column else []
        schema = T.StructType(fields + [T.StructField("_batch_id", T.LongType())])
        batches = [self._raw(spec, f) for f in folders if f.startswith("_batch_id=")]
        merged = [self._raw(spec, f) for f in folders if not f.startswith("_batch_id=")]
        parts = []
        if batches:
            parts.append(self.spark.read.schema(schema).option("basePath", f"{self.root}/raw/{spec.name}").parquet(*batches))
        if merged:
            parts.append(self.spark.read.schema(schema).parquet(*merged).select(*schema.names))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # --- months ---

    def months(self, spec: TableSpec) -> list[str]:
        """The registered months, as yyyy-MM."""
        found = list_names(self.spark, f"{self.root}/ops/months/table_name={spec.name}/month=*")
        return [p.rsplit("=", 1)[1] for p in found]

    def register_months(self, spec: TableSpec, first: datetime, last: datetime, before: int | None = None) -> list[str]:
        """Register every month from ``first`` to ``last``; returns the new ones.

        Visible rows of a new month leave the default folder: the folders that have one are merged anew, and the
        state that names the result replaces them in one step. ``before`` is the running load's batch id.
        """
        new = sorted(set(months_between(first, last)) - set(self.months(spec)))
        for month in new:
            publish_text(self.spark, f"{self.root}/ops/months/table_name={spec.name}/month={month}/row.json", "{}")
        held = self._with_default(spec, self.visible(spec))
        if held:  # also what a writer left there that died after registering
            stray = self._read(spec, [f.name for f in held]).filter(F.col(MONTH) == DEFAULT_MONTH)
            if not stray.filter(F.date_format(spec.partition_column, "yyyy-MM").isin(self.months(spec))).isEmpty():
                self.compact(spec, before)
        return new

    def _with_default(self, spec: TableSpec, folders: list[Folder]) -> list[Folder]:
        found = {p.rsplit("/", 1)[0] for depth in ("*", "*/*") for p in list_names(self.spark, self._raw(spec, f"{depth}/{MONTH}={DEFAULT_MONTH}"))}
        return [f for f in folders if any(p.endswith(f"/raw/{spec.name}/{f.name}") for p in found)]

    # --- audit ---

    def _audit(self, table: str) -> str:
        return f"{self.root}/ops/load_audit/table_name={table}"

    def _log(self, table: str) -> str:
        return f"{self.root}/ops/load_log/table_name={table}"

    def next_batch_id(self) -> int:
        taken = [_id_of(p, "batch_id") for p in list_names(self.spark, f"{self._audit('*')}/batch_id=*")]
        taken += [_id_of(p, "upto") for p in list_names(self.spark, f"{self._log('*')}/state=*/upto=*")]
        return max(taken, default=0) + 1

    def publish(self, spec: TableSpec, batch_id: int, status: str, **fields) -> None:
        """Publish one audit row; a single file that appears by one rename."""
        values = {k: v.isoformat(sep=" ") if isinstance(v, datetime) else v for k, v in fields.items()}
        path = f"{self._audit(spec.name)}/batch_id={batch_id}/status={status}"
        publish_text(self.spark, f"{path}/row.json", json.dumps(values))

    def state(self, table: str) -> State:
        """The newest state that a compaction published."""
        found = list_names(self.spark, f"{self._log(table)}/state=*/upto=*/state.json")
        if not found:
            return State()
        newest = max(found, key=lambda p: _id_of(p, "state"))
        folders = tuple(Folder.from_json(f) for f in json.loads(read_text(self.spark, newest)))
        return State(_id_of(newest, "state"), _id_of(newest, "upto"), folders)

    def _snapshot(self, table: str, state: State) -> str:
        return f"{self._log(table)}/audit/state={state.number}"

    def _tail(self, table: str, state: State, before: int | None = None) -> DataFrame | None:
        """Audit rows of the attempts after the state."""
        found = list_names(self.spark, f"{self._audit(table)}/batch_id=*/status=*/*.json")
        fresh = [p for p in found if state.upto < _id_of(p, "batch_id") and (before is None or _id_of(p, "batch_id") < before)]
        if not fresh:
            return None
        reader = self.spark.read.schema(AUDIT_SCHEMA).option("basePath", f"{self.root}/ops/load_audit")
        return reader.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").json(fresh)

    def _attempts(self, table: str, state: State, before: int | None = None) -> DataFrame:
        """One row per load attempt in its latest state: the snapshot and the tail."""
        parts = []
        if state.number:
            parts.append(self.spark.read.schema(AUDIT_SCHEMA).parquet(self._snapshot(table, state)))
        tail = self._tail(table, state, before)
        if tail is not None:
            ended = tail.withColumn("_ended", F.col("status").isin(SUCCESS, FAILED))
            parts.append(latest_version(ended, ["table_name", "batch_id"], ["_ended"]).select(*AUDIT_SCHEMA.names))
        if not parts:
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def audit(self) -> DataFrame:
        """One row per load attempt in its latest state."""
        places = list_names(self.spark, self._audit("*")) + list_names(self.spark, self._log("*"))
        attempts = self.spark.createDataFrame([], AUDIT_SCHEMA)
        for table in sorted({p.rsplit("=", 1)[1] for p in places}):  # a handful of tables
            attempts = attempts.unionByName(self._attempts(table, self.state(table)))
        return attempts.select(
            "batch_id", "table_name", "run_label", "started_at", "finished_at", "status", "watermark_from",
            "watermark_to", "rows_extracted", "rows_inserted",
            seconds_between(F.col("started_at"), F.col("finished_at")).alias("duration_seconds"), "error",
        )

    def _fresh(self, spec: TableSpec, state: State, before: int | None = None) -> list[Folder]:
        """The visible batches after the state that hold rows; at most a few times ``compact_every``."""
        tail = self._tail(spec.name, state, before)
        if tail is None:
            return []
        done = tail.filter((F.col("status") == SUCCESS) & F.col("watermark_to").isNotNull()).select("batch_id", "watermark_to")
        return [Folder(f"_batch_id={r.batch_id}", 0, r.watermark_to) for r in sorted(done.collect())]

    def visible(self, spec: TableSpec) -> list[Folder]:
        """The folders whose rows count."""
        state = self.state(spec.name)
        return [*state.folders, *self._fresh(spec, state)]

    def has_run(self, spec: TableSpec, run_label: str) -> bool:
        """Whether a load under this label has succeeded and held rows."""
        attempts = self._attempts(spec.name, self.state(spec.name))
        done = (F.col("status") == SUCCESS) & F.col("watermark_to").isNotNull() & (F.col("run_label") == run_label)
        return not attempts.filter(done).isEmpty()

    def watermark(self, spec: TableSpec) -> datetime | None:
        """How far the table was read. A maximum over what was committed, so it never moves back."""
        return max((f.reached for f in self.visible(spec)), default=None)

    # --- compaction ---

    def compact_if_due(self, spec: TableSpec) -> None:
        state = self.state(spec.name)
        attempts = list_names(self.spark, f"{self._audit(spec.name)}/batch_id=*")
        if sum(_id_of(p, "batch_id") > state.upto for p in attempts) >= self.compact_every:
            self.compact(spec)

    def compact(self, spec: TableSpec, before: int | None = None) -> State:
        """Merge the batches so far and take their audit rows into the snapshot; only the table's one writer calls this.

        Attempts that never ended belong to writers that died. What the state before this one named is kept until the
        next compaction, for readers that still hold it; what was superseded earlier is deleted.
        """
        old = self.state(spec.name)
        attempts = self._attempts(spec.name, old, before)
        upto = attempts.agg(F.max("batch_id")).first()[0] or old.upto
        number = old.number + 1
        fresh = self._fresh(spec, old, before)
        moved = fresh + self._with_default(spec, list(old.folders))
        folders = [f for f in old.folders if f not in moved]
        while moved:
            merged = self._merge(spec, moved, f"merged/{number}-{len(moved)}-{moved[0].level}")
            folders.append(merged)
            moved = [f for f in folders if f.level == merged.level]
            if len(moved) < MERGE_FOLDERS:
                break
            folders = [f for f in folders if f.level != merged.level]
        new = State(number, max(upto, old.upto), tuple(folders))
        attempts.coalesce(1).write.mode("overwrite").parquet(self._snapshot(spec.name, new))
        text = json.dumps([f.to_json() for f in folders])
        publish_text(self.spark, f"{self._log(spec.name)}/state={number}/upto={new.upto}/state.json", text)
        self._clear(spec, old, new)
        return new

    def _clear(self, spec: TableSpec, old: State, new: State) -> None:
        """Delete what neither of the two newest states names."""
        kept = {f.name for s in (old, new) for f in s.folders}
        gone = [p for p in list_names(self.spark, self._raw(spec, "merged/*")) if f"merged/{p.rsplit('/', 1)[1]}" not in kept]
        for pattern in (self._raw(spec, "_batch_id=*"), f"{self._audit(spec.name)}/batch_id=*"):
            gone += [p for p in list_names(self.spark, pattern) if _id_of(p, "batch_id") <= old.upto]
        for pattern in (f"{self._log(spec.name)}/state=*", f"{self._log(spec.name)}/audit/state=*"):
            gone += [p for p in list_names(self.spark, pattern) if _id_of(p, "state") < old.number]
        for path in gone:
            delete_path(self.spark, path)

    # --- logs ---

    # Every attempt writes a folder of its own: writers of one folder would delete each other's unfinished files.

    def _append(self, name: str, attempt: str, df: DataFrame) -> None:
        df.coalesce(1).write.parquet(f"{self.root}/ops/{name}/attempt={attempt}")

    def _read_log(self, name: str, schema: str) -> DataFrame:
        if not list_names(self.spark, f"{self.root}/ops/{name}/attempt=*/*.parquet"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, attempt string").parquet(f"{self.root}/ops/{name}").drop("attempt")

    def record_drift(self, found: list[Drift], batch_id: int, run_label: str, now: datetime) -> None:
        if found:
            rows = [
                (now, run_label, d.table_name, d.kind, d.column_name, d.detail, d.severity) for d in found
            ]
            self._append("schema_drift", f"{found[0].table_name}-{batch_id}", self.spark.createDataFrame(rows, DRIFT_SCHEMA))

    def drift(self) -> DataFrame:
        return self._read_log("schema_drift", DRIFT_SCHEMA)

    def record_checks(self, results: DataFrame, run_label: str, now: datetime) -> None:
        stamped = results.select(
            F.lit(run_label).alias("run_label"), wall_clock(now).alias("checked_at"), "*"
        )
        self._append("dq_results", uuid.uuid4().hex, stamped)

    def dq_results(self) -> DataFrame:
        return self._read_log("dq_results", DQ_SCHEMA)


def watermarks(audit: DataFrame) -> DataFrame:
    """How far each table was read. A maximum, so it never moves back."""
    done = audit.filter((F.col("status") == SUCCESS) & F.col("watermark_to").isNotNull())
    return done.groupBy("table_name").agg(F.max("watermark_to").alias("high_watermark"))


def load_status(audit: DataFrame) -> DataFrame:
    """Per loaded table: watermark, and state and row count of its latest attempt."""
    reached = F.max(F.when(F.col("status") == SUCCESS, F.col("watermark_to")))
    latest = F.max_by(F.struct("status", "rows_inserted"), "batch_id")
    per_table = audit.groupBy("table_name").agg(reached.alias("high_watermark"), latest.alias("_last"))
    return per_table.filter(F.col("high_watermark").isNotNull()).select(
        "table_name", "high_watermark", F.col("_last.status").alias("last_load"), F.col("_last.rows_inserted").alias("rows_inserted")
    )


