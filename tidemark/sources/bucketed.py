"""A partitioned table whose partitions are bucketed and sorted by the key, so a merge joins bucket to bucket.

The files lie as in :class:`PartitionedTable`, and its snapshot of partitions is the commit. Spark knows buckets only from its catalog, so
reading registers an external table for the committed state, with a location per partition. Dropping that entry touches no file.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.merge import check_same_columns, incremental_merge
from tidemark.session import scratch_path
from tidemark.sources.tables import PartitionedTable, delete_path


#: A bucket is one task of a merge or of a join by the key; so many rows of a table are some hundred megabytes there.
BUCKET_ROWS = 500_000


class BucketedTable(PartitionedTable):
    """For tables in which a key never changes its partition, so the partitions of a delta are all that its merge touches.

    A merge has as many tasks as there are buckets, and a partition as many files. So the number of buckets follows the rows: at least
    ``buckets``, one for every ``bucket_rows`` that a first build expects, and the table is bucketed anew when a merge leaves more than
    twice as many rows in each. All partitions of a state have the number that its manifest names.
    """

    def __init__(
        self, spark: SparkSession, path: str, part: Column, schema: T.StructType, key: str, buckets: int = 16, bucket_rows: int = BUCKET_ROWS
    ):
        super().__init__(spark, path, part, schema)
        #: The number of buckets of the state last looked at, or being written.
        self.key, self.buckets, self.least, self.bucket_rows = key, buckets, buckets, bucket_rows
        self._entry = f"tidemark_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    def partitions(self) -> dict[str, int]:
        listed = self._parts.read().collect() if self._parts.exists() else []
        for r in listed[:1]:
            self.buckets = r.asDict().get("buckets", self.least)
        return {r.part: r.version for r in listed}

    def _manifest(self, parts: dict[str, int]) -> DataFrame:
        return super()._manifest(parts).withColumn("buckets", F.lit(self.buckets))

    def _fit(self, rows: int) -> int:
        return max(self.least, -(-rows // self.bucket_rows))

    def overwrite(self, df: DataFrame, expected_rows: int = 0) -> None:
        self.buckets = self._fit(expected_rows)
        super().overwrite(df)

    def _write(self, df: DataFrame, path: str) -> None:
        entry = f"{self._entry}_write_{uuid.uuid4().hex}"
        bucketed = df.write.option("compression", "zstd").partitionBy(self.PART).bucketBy(self.buckets, self.key).sortBy(self.key)
        try:
            bucketed.option("path", path).saveAsTable(entry)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {entry}")

    def _spread(self, df: DataFrame) -> DataFrame:
        # A task per partition and bucket, so a full build has as many tasks as the session likes and still one file each.
        return df.repartition(F.col(self.PART), F.pmod(F.hash(self.key), F.lit(self.buckets)))

    def _register(self, parts: dict[str, int]) -> str:
        state = self._parts.version()
        entry = f"{self._entry}_{state}"
        if not self.spark.catalog.tableExists(entry):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {entry} ({columns}, {self.PART} string) USING parquet PARTITIONED BY ({self.PART}) "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/data'"
            )
            places = " ".join(f"PARTITION ({self.PART}='{p}') LOCATION '{self._data(v)}/{self.PART}={p}'" for p, v in sorted(parts.items()))
            self.spark.sql(f"ALTER TABLE {entry} ADD {places}")
        for old in self.spark.catalog.listTables(pattern=f"{self._entry}_*"):
            number = old.name.rsplit("_", 1)[1]
            if number.isdigit() and int(number) < state - 1:  # whoever still reads the state before this one can go on
                self.spark.sql(f"DROP TABLE IF EXISTS {old.name}")
        return entry

    def _read(self, parts: dict[str, int], only: Sequence[str] | None = None) -> DataFrame:
        if not parts:
            return super()._read(parts)
        table = self.spark.table(self._register(parts))
        return table if only is None else table.filter(F.col(self.PART).isin(list(only)))

    def merge_plan(self, delta: DataFrame, touched: Sequence[str]) -> DataFrame:
        """The touched partitions with the delta swapped in by key: one join, in which only the delta is exchanged."""
        before = self.read(touched)
        check_same_columns(before, delta)
        old = before.select(F.col(self.key).alias("_was"), F.struct(*before.columns).alias("_old"))
        new = delta.select(F.col(self.key).alias("_is"), F.struct(*delta.columns).alias("_new"))
        joined = old.join(new, F.col("_was") == F.col("_is"), "full_outer")
        return joined.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")

    def merge(self, delta: DataFrame, key: Sequence[str], at_rest: bool = False) -> list[str]:
        """Swap in ``delta`` by key; returns the partitions it touches. One that is ``at_rest`` is a stored table and is not stored again."""
        if list(key) != [self.key]:
            raise ValueError(f"bucketed by {self.key}, not by {list(key)}")
        if at_rest:
            return self._merge(delta)
        place = scratch_path(self.spark, "merge-delta")
        delta.write.option("compression", "zstd").parquet(place)
        try:
            return self._merge(self.spark.read.schema(delta.schema).parquet(place))
        finally:
            delete_path(self.spark, place)

    def _merge(self, stored: DataFrame) -> list[str]:
        if not self.exists():
            self.overwrite(stored, stored.count())
            return sorted(self.partitions())
        parts = self.partitions()
        touched = sorted(r[0] for r in stored.select(self._part).distinct().collect())  # partitions, not rows
        rows = self._read(parts).count() + stored.count()  # of files' footers
        if touched and rows > 2 * self.bucket_rows * self.buckets:
            self.overwrite(incremental_merge(self._read(parts).drop(self.PART), stored, [self.key]), rows)
        elif touched:
            known = [p for p in touched if p in parts]
            merged = self.merge_plan(stored, known) if known else stored
            self._publish(merged, {p: v for p, v in parts.items() if p not in set(touched)}, spread=not known)
        return touched
