"""Stored tables that change all at once: whole snapshots, and partitions swapped by a manifest.

Every write goes to a new ``v=<n>`` folder. A version counts once Spark has left its ``_SUCCESS`` marker,
so a reader sees the old state or the new one, and a crashed write is just a folder nobody reads. One
writer per table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.merge import incremental_merge
from tidemark.session import checkpointed


def list_names(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths matching a glob, on whatever file system the path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in (fs.globStatus(path) or []))


def publish_text(spark: SparkSession, target: str, text: str) -> None:
    """Write a small file so that it appears complete: to a temporary name first, then one rename."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(target)
    temporary = hadoop.Path(path.getParent(), f".{path.getName()}.tmp")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(temporary, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(temporary, path):
        raise OSError(f"could not publish {target}")


def read_text(spark: SparkSession, target: str) -> str:
    """A small file that :func:`publish_text` wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    source = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


def delete_path(spark: SparkSession, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_parts(path: str, parts: Iterable[DataFrame]) -> DataFrame:
    """Write frames of one schema to one folder, each after the one before, and read them back as a table.

    The folder gets its ``_SUCCESS`` marker when all are written. Inside ``shuffle_files_deleted`` only one frame's shuffle files lie on disk.
    """
    for df in parts:
        writer = df.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        writer.option("compression", "zstd").parquet(path)
    publish_text(df.sparkSession, f"{path}/_SUCCESS", "")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _versions(paths: list[str], depth: int) -> list[int]:
    return sorted(int(p.rstrip("/").split("/")[-depth].rsplit("=", 1)[1]) for p in paths)


class SnapshotTable:
    """A table rewritten as a whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int | None:
        done = _versions(list_names(self.spark, f"{self.path}/v=*/_SUCCESS"), 2)
        return done[-1] if done else None

    def next_version(self) -> int:
        started = _versions(list_names(self.spark, f"{self.path}/v=*"), 1)
        return started[-1] + 1 if started else 1

    def exists(self) -> bool:
        return self.version() is not None

    def read(self) -> DataFrame:
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"no committed version of {self.path}")
        return self.spark.read.parquet(f"{self.path}/v={version}")

    def write(self, *parts: DataFrame) -> DataFrame:
        """A new version, of one frame or of several that are written one after the other."""
        return write_parts(f"{self.path}/v={self.next_version()}", parts)

    def merge(self, delta: DataFrame, key: Sequence[str]) -> DataFrame:
        return self.write(incremental_merge(self.read(), delta, key))


class PartitionedTable:
    """A table of which a merge rewrites only the partitions it touches.

    ``parts/`` is a snapshot with one row per partition: the version its files live in. Writing that
    snapshot is the commit.
    """

    PART, VERSION = "_part", "_version"

    def __init__(self, spark: SparkSession, path: str, part: Column, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._part = F.coalesce(part.cast("string"), F.lit("none")).alias(self.PART)
        self._parts = SnapshotTable(spark, f"{self.path}/parts")

    def _data(self, version: int | str) -> str:
        return f"{self.path}/data/{self.VERSION}={version}"

    def exists(self) -> bool:
        """An empty table counts as missing, so the next write is a first build."""
        return bool(self.partitions())

    def partitions(self) -> dict[str, int]:
        if not self._parts.exists():
            return {}
        return {r.part: r.version for r in self._parts.read().collect()}

    def read(self, only: Sequence[str] | None = None) -> DataFrame:
        return self._read(self.partitions(), only).drop(self.PART)

    def _read(self, parts: dict[str, int], only: Sequence[str] | None = None) -> DataFrame:
        chosen = parts if only is None else {p: v for p, v in parts.items() if p in set(only)}
        schema = T.StructType(
            [*self.schema.fields, T.StructField(self.VERSION, T.IntegerType()), T.StructField(self.PART, T.StringType())]
        )
        if not chosen:
            return self.spark.createDataFrame([], schema).drop(self.VERSION)
        paths = [f"{self._data(v)}/{self.PART}={p}" for p, v in sorted(chosen.items())]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).drop(self.VERSION)

    def _write(self, df: DataFrame, path: str) -> None:
        df.write.option("compression", "zstd").partitionBy(self.PART).parquet(path)

    def _spread(self, df: DataFrame) -> DataFrame:
        # Rows of one partition meet in few tasks, so each leaves few files; AQE splits the large ones.
        return df.hint("rebalance", self.PART)

    def _publish(self, df: DataFrame, keep: dict[str, int], spread: bool = True) -> None:
        started = _versions(list_names(self.spark, self._data("*")), 1)
        version = started[-1] + 1 if started else 1
        placed = df.withColumn(self.PART, self._part)
        self._write(self._spread(placed) if spread else placed, self._data(version))
        written = list_names(self.spark, f"{self._data(version)}/{self.PART}=*")
        parts = keep | {p.rsplit("=", 1)[1]: version for p in written}
        self._parts.write(self._manifest(parts).coalesce(1))

    def _manifest(self, parts: dict[str, int]) -> DataFrame:
        return self.spark.createDataFrame(sorted(parts.items()), "part string, version int")

    def overwrite(self, df: DataFrame) -> None:
        self._publish(df, {})

    def replace(self, touched: Sequence[str], df: DataFrame) -> None:
        """Swap the listed partitions for ``df``, which must hold rows of those partitions only."""
        keep = {p: v for p, v in self.partitions().items() if p not in set(touched)}
        self._publish(df, keep)

    def merge(self, delta: DataFrame, key: Sequence[str]) -> list[str]:
        """Swap in ``delta`` by key; returns the partitions that changed (where a row was or now is)."""
        stored = checkpointed(delta)
        if not self.exists():
            self.overwrite(stored)
            return sorted(self.partitions())
        parts = self.partitions()
        current = self._read(parts)
        was = current.join(stored.select(*key), list(key), "left_semi").select(self.PART)
        touched = [r[0] for r in was.union(stored.select(self._part)).distinct().collect()]
        if touched:
            before = self._read(parts, touched).drop(self.PART)
            self.replace(touched, incremental_merge(before, stored, key))
        return sorted(touched)
