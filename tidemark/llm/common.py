"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, shuffle_files_deleted
from tidemark.sources.tables import delete_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks can import it wherever they run.

    The archive is made on the driver and handed to Spark, which copies it to every executor.
    """
    app, package = spark.sparkContext.applicationId, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _shipped or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def stored(df: DataFrame, label: str, *partition_by: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: the lineage is cut, and a lost executor costs a file read only.

    ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.options(compression="zstd", **(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables that the steps of a job hand on, as :func:`stored` ones, but no shuffle files stay and a table can be dropped after its last use."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root = spark, scratch_path(spark, label)

    def _write(self, df: DataFrame, place: str, partition_by: tuple[str, ...]) -> None:
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffle_files_deleted(self.spark):
            writer.parquet(f"{self.root}/{place}")

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        self._write(df, name, partition_by)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def write_part(self, df: DataFrame, name: str, key: str, value: int, *partition_by: str) -> None:
        self._write(df, f"{name}/{key}={value}", partition_by)

    def read_parts(self, name: str, schema: str, keys: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, {keys}").parquet(f"{self.root}/{name}")

    def drop(self, *places: str) -> None:
        for place in places:
            delete_path(self.spark, f"{self.root}/{place}")


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id, as decimal text, has the given remainder. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def keep_documents(docs: DataFrame, decisions: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the decisions keep, with all their columns.

    ``decisions`` has one row per row of ``docs``: the id and a boolean ``kept``. Rows with a null id cannot be told apart and
    all stay. When an id is repeated and only some of its rows are kept, one row of that id stays. Only ids with something to
    drop are joined, so the planner can broadcast them while they are few; otherwise it shuffles.
    """
    key = "_decided_id"
    by_id = stored(
        decisions.filter(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias(key))
        .agg(F.count_if("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
        .filter("_kept < _rows"),
        "decided",
    )
    gone = docs.join(by_id.filter("_kept = 0").select(key), docs[doc_id] == F.col(key), "left_anti")
    repeated = by_id.filter("_kept > 0").select(key)
    if repeated.isEmpty():
        return gone
    once = gone.join(repeated, gone[doc_id] == F.col(key), "left_semi").dropDuplicates([doc_id])
    return gone.join(repeated, gone[doc_id] == F.col(key), "left_anti").unionByName(once)
