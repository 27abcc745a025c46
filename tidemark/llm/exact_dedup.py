"""Exact dedup with a heavy-hitter split (native: DataFrame functions only).

Texts are reduced to SHA-256 digests in one pass, and the narrow digest table is stored. A Misra-Gries style frequent-items
sketch, merged from every task, names at most ``top`` digests; any digest with more than ``1/top`` of all rows is among them.
Their exact counts and winners come from an aggregate with map-side combine, are verified (a count of at least two), and are
broadcast: at most ``top`` rows. Rows with such a digest are decided on the map side and never shuffled. All other digests go
through an ordinary shuffle, where no group is larger than the sketch's bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep_documents, stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 without white space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "").cast("binary"), 256))


def frequent(values: DataFrame, column: str, top: int, tracked: int, lanes: int = 64) -> DataFrame:
    """Candidates for the most frequent values of a long column, as rows of column ``item``: at most ``top`` of them.

    Sketches of many tasks are merged in ``lanes`` groups first, so no task reads a sketch of every task. The last merge groups by a
    constant, because the combining aggregate fails on partitions without rows when nothing is grouped.
    """
    lane = values.select(F.col(column), (F.spark_partition_id() % lanes).alias("_lane"))
    sketches = lane.groupBy("_lane").agg(F.expr(f"approx_top_k_accumulate({column}, {tracked})").alias("s"))
    return sketches.groupBy(F.lit(1)).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {top})").alias("t")).select(
        F.explode("t.item").alias("item")
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", top: int = 1000, tracked: int = 10_000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id, null ids last. Null and empty texts are equal
    to each other and to texts of white space alone. Repeated rows are decided like any others: exactly one row of a group has
    ``kept``. An empty table gives an empty result. Other columns of the input are ignored.
    """
    prints = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("n"),
            digest(F.col(text)).alias("digest"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    ).withColumn("h", F.xxhash64("digest"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.isnull("doc_id").alias("no_id"), "doc_id", "row"))
    heavy = stored(frequent(prints, "h", top, tracked), "frequent")
    winners = stored(
        prints.join(F.broadcast(heavy), F.col("h") == F.col("item"), "left_semi")
        .groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1"),
        "winners",
    )
    tagged = prints.join(F.broadcast(winners), "digest", "left")
    group = Window.partitionBy("digest")
    rest = (
        tagged.filter("size is null")
        .select("doc_id", "digest", "row", "n")
        .select("doc_id", "digest", "row", best.over(group).alias("best"), F.count(F.lit(1)).over(group).alias("size"))
    )
    every = tagged.filter("size is not null").select("doc_id", "digest", "row", "best", "size").unionByName(rest)
    return every.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without exact copies, all columns kept. See ``keep_documents`` for repeated and null ids."""
    return keep_documents(docs, exact_dedup(docs, doc_id, text), doc_id)
