"""Reading source tables by declared schema; no inference, so a wrong file fails early."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.specs import TableSpec

FILE_FORMATS = ("parquet", "csv", "json", "orc")


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """A file source. Without a schema, Parquet and ORC show their own, which is what a drift check needs."""
    if fmt not in FILE_FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FILE_FORMATS}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json"):
        raise ValueError(f"{fmt} needs a declared schema")
    return reader.load(path)


def read_jdbc(
    spark: SparkSession, spec: TableSpec, url: str, dbtable: str, bounds: tuple[int, int] | None = None,
    partitions: int = 1, **options,
) -> DataFrame:
    """A database table; cursor filters push down, and ``bounds`` on the key split the read."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=dbtable, **options)
    if bounds is not None:
        reader = reader.options(
            partitionColumn=spec.pk[0], lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    names: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files landing in a folder as a stream; ``names`` is a glob on the file name."""
    reader = spark.readStream.format(fmt).schema(schema)
    if names is not None:
        reader = reader.option("pathGlobFilter", names)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def utc_wall_clock(df: DataFrame) -> DataFrame:
    """Zoned timestamps, as JDBC and CSV readers return them, as UTC wall-clock ``timestamp_ntz``."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns(
        {
            c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
            for c in zoned
        }
    )
