"""Exact ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import checkpointed

Order = Sequence[tuple[str, bool]]  # (column, ascending)

# monotonically_increasing_id() keeps the partition number above this bit and the row number below it.
_ROW_BITS = 33


def global_rank(df: DataFrame, order: Order, alias: str) -> tuple[DataFrame, int]:
    """Add the 0-based position of every row in the order; also returns the row count.

    A global sort range-partitions the rows, so each task numbers its own slice. The slices are frozen
    by a checkpoint (a sort that runs again may cut them elsewhere), counted, and each row's number is
    shifted by the size of the slices before its own. Only one count per slice reaches the driver.
    Ties are broken arbitrarily unless ``order`` ends in a unique column.
    """
    sort = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_first() for c, up in order]
    frozen = checkpointed(df.orderBy(*sort).withColumn("_id", F.monotonically_increasing_id()))
    piece = F.shiftright("_id", _ROW_BITS).cast("int")
    sizes = dict(frozen.groupBy(piece.alias("piece")).count().collect())
    starts, rows = [], 0
    for i in range(max(sizes, default=-1) + 1):
        starts.append(rows)
        rows += sizes.get(i, 0)
    start = F.lit(0) if not starts else F.element_at(F.lit(starts).cast("array<long>"), piece + 1)
    inside = F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    return frozen.withColumn(alias, (start + inside).cast("long")).drop("_id"), rows


def tile_of(rank: Column, rows: int, n: int) -> Column:
    """ntile number of a 0-based rank: the first ``rows mod n`` tiles hold one row more."""
    size, extra = divmod(rows, n)
    big = F.floor(rank / F.lit(size + 1)) + 1
    if size == 0:
        return big.cast("int")
    border = extra * (size + 1)
    small = F.floor((rank - border) / F.lit(size)) + extra + 1
    return F.when(rank < border, big).otherwise(small).cast("int")


def global_ntile(df: DataFrame, order: Order, n: int, alias: str) -> DataFrame:
    """``ntile(n)`` over the whole table; same result as an un-partitioned window."""
    ranked, rows = global_rank(df, order, "_rank")
    return ranked.withColumn(alias, tile_of(F.col("_rank"), rows, n)).drop("_rank")
