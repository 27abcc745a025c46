"""The hourly poll, event de-duplication and the funnel as Structured Streaming jobs.

All of them can be stopped and started: progress is in the query's checkpoint, and what a micro-batch
writes is the same when it runs twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import funnel_stage, utc_instant
from tidemark.plans.load import load_batch
from tidemark.plans.marts import funnel_of_sessions
from tidemark.session import checkpointed
from tidemark.sources.raw_store import RawStore
from tidemark.sources.tables import PartitionedTable, SnapshotTable, list_names, publish_text
from tidemark.specs import FUNNEL_LOOKBACK_DAYS, FUNNEL_SCHEMA, SESSION_SCHEMA, TableSpec


def _start(df: DataFrame, checkpoint: str, write_batch, mode: str) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(write_batch).start()


def stream_load(stream: DataFrame, store: RawStore, spec: TableSpec, checkpoint: str, name: str) -> StreamingQuery:
    """Load landed rows into raw; each micro-batch is one audited batch, committed once."""

    def load(rows: DataFrame, epoch: int) -> None:
        load_batch(store, spec, rows, f"{name}-{epoch}")

    return _start(stream, checkpoint, load, "append")


def dedupe_events(stream: DataFrame, delay: str) -> DataFrame:
    """Drop events delivered again within ``delay`` after their first arrival; state older than that is forgotten.

    The watermark is on the arrival time, so an event that happened long ago but arrives now is never dropped as late.
    """
    timed = stream.withColumn("_arrival", utc_instant(F.col("ingested_at")))
    unique = timed.withWatermark("_arrival", delay).dropDuplicatesWithinWatermark(["event_id", "event_ts"])
    return unique.drop("_arrival")


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append to Parquet files."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def _one_row_per_session(rows: DataFrame) -> DataFrame:
    """A session that crosses midnight, or is known from earlier, is dated by its first event."""
    return rows.groupBy("session_id").agg(
        F.min("event_date").alias("event_date"), F.min("device").alias("device"), F.max("furthest_stage").alias("furthest_stage")
    )


LATE_SCHEMA = "query_id string, batch_id long, watermark timestamp, late_sessions long"


class FunnelTables:
    """Where the streaming funnel keeps its sessions and its daily counts, both split by day, and what it dropped as late.

    Days to recount are noted before the sessions change and cleared after the counts did, so a crash between the two
    leaves no day uncounted when the micro-batch runs again.
    """

    def __init__(self, spark, root: str):
        day = F.col("event_date")
        self.sessions = PartitionedTable(spark, f"{root}/sessions", day, SESSION_SCHEMA)
        self.funnel = PartitionedTable(spark, f"{root}/funnel", day, FUNNEL_SCHEMA)
        self.pending = SnapshotTable(spark, f"{root}/pending")
        self.spark, self.late_path = spark, f"{root}/late"

    def record_late(self, query: StreamingQuery) -> None:
        """Keep what the query reports to have dropped by its watermark, a file per micro-batch that dropped something.

        Events are grouped before they meet the watermark, so the count is of sessions and days, not of single events. Noting a
        micro-batch again changes nothing. What a query dropped in a micro-batch whose driver died before noting it is lost.
        """
        for p in query.recentProgress:
            dropped = sum(operator.numRowsDroppedByWatermark for operator in p.stateOperators)
            path = f"{self.late_path}/query_id={p.id}/batch_id={p.batchId}"
            if dropped and not list_names(self.spark, f"{path}/row.json"):
                publish_text(self.spark, f"{path}/row.json", json.dumps({"watermark": p.eventTime["watermark"], "late_sessions": dropped}))

    def late(self) -> DataFrame:
        """One row per micro-batch that dropped late sessions, with the query's watermark then; the cut is the one before it."""
        if not list_names(self.spark, f"{self.late_path}/query_id=*/batch_id=*/row.json"):
            return self.spark.createDataFrame([], LATE_SCHEMA)
        found = self.spark.read.schema(LATE_SCHEMA).json(self.late_path)
        return found.select("query_id", "batch_id", "watermark", "late_sessions")

    def upsert(self, delta: DataFrame) -> None:
        """Merge the given sessions, then recount the days they were or are on."""
        delta = checkpointed(_one_row_per_session(delta))  # the micro-batch runs once
        if delta.isEmpty():
            return
        days = delta.select("event_date")
        if self.sessions.exists():
            known = self.sessions.read().join(delta.select("session_id"), "session_id", "left_semi")
            days = days.unionByName(known.select("event_date"))
            delta = checkpointed(_one_row_per_session(known.unionByName(delta)))
        if self.pending.exists():
            days = days.unionByName(self.pending.read())
        self.pending.write(checkpointed(days.distinct()))
        self.sessions.merge(delta, ["session_id"])
        touched = [str(r[0]) for r in self.pending.read().collect()]  # days inside the lookback
        if self.funnel.exists():
            self.funnel.replace(touched, funnel_of_sessions(self.sessions.read(touched)))
        else:
            # Also after a crash between the two first writes: every day counts as touched then.
            self.funnel.overwrite(funnel_of_sessions(self.sessions.read()))
        self.pending.write(days.limit(0))


def stream_sessions(stream: DataFrame, lookback_days: int = FUNNEL_LOOKBACK_DAYS) -> DataFrame:
    """Running state of each session; events of days older than the lookback are dropped.

    A day's window ends at midnight after it, so it is closed once the newest event lies more than
    ``lookback_days`` days later. A session that crosses midnight has a row per day here; see :class:`FunnelTables`.
    """
    timed = stream.withColumn("_event_time", utc_instant(F.col("event_ts")))
    return (
        timed.withWatermark("_event_time", f"{lookback_days} days")
        .groupBy("session_id", F.window("_event_time", "1 day"))
        .agg(
            F.to_date(F.min("event_ts")).alias("event_date"),
            F.min("device").alias("device"),
            F.max(funnel_stage(F.col("event_type"))).alias("furthest_stage"),
        )
        .drop("window")
    )


def stream_funnel(
    stream: DataFrame, tables: FunnelTables, checkpoint: str, lookback_days: int = FUNNEL_LOOKBACK_DAYS
) -> StreamingQuery:
    """Start the funnel; call ``tables.record_late`` with the query once it has ended, as :func:`run_funnel` does."""
    sessions, started = stream_sessions(stream, lookback_days), []

    def upsert(delta: DataFrame, epoch: int) -> None:
        for query in started:  # a query remembers its last hundred micro-batches only, so note them on the way
            tables.record_late(query)
        tables.upsert(delta)

    started.append(_start(sessions, checkpoint, upsert, "update"))
    return started[0]


def run_funnel(
    stream: DataFrame, tables: FunnelTables, checkpoint: str, lookback_days: int = FUNNEL_LOOKBACK_DAYS
) -> None:
    """Work off what has landed and note what came too late."""
    query = stream_funnel(stream, tables, checkpoint, lookback_days)
    try:
        query.awaitTermination()
    finally:
        tables.record_late(query)
