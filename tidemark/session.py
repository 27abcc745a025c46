"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; a cluster's own submit settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot key's join partition even when an aggregation on the same key follows.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # The planner broadcasts on its size estimate, AQE on the measured size; both up to this bound.
        .config("spark.sql.autoBroadcastJoinThreshold", "32m")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own, below the warehouse.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-scratch/{uuid.uuid4().hex}"
    sc.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage on reliable storage, so a lost executor re-reads files and not the whole plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write as Parquet to the shared folder and read back: as :func:`checkpointed`, and the planner knows the size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark then deletes a query's shuffle files when it ends; without it they stay until the driver happens to collect garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; for those whose result is written and that are not run again."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def run_parallel(spark: SparkSession, work: Sequence[Callable], threads: int) -> list:
    """Submit independent Spark jobs together, so one's small stages fill the gaps of another's.

    All of them run to their end; then the first error in order, if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in work]
    return [f.result() for f in futures]
