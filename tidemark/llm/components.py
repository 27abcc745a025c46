"""Connected components of a link table, by alternating large-star and small-star steps on spanning stars.

Every round begins with a map-side combine: each task replaces its links, a bounded number at a time, by stars with the same components, so
links that lie together need no round; what a task holds is bounded, how many tasks there are follows the size of the links. A step is then a map-side combined minimum per node and one join. The minima are stored first, so
the join has an exchange of its own on both sides and the planner can split the links of a node that has a third of them; they also tell whether the
links are stars already, which ends the job: then they are the result. Nothing is collected but one flag per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored

_LINKS = "a long, b long"


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest node of the component, node) for every other node of the links."""
    nodes, codes = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = np.split(codes, 2)
    root = np.arange(len(nodes))
    while True:
        left, right = root[left], root[right]
        apart = left != right
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        while (higher := root[root] != root).any():
            root[higher] = root[root[higher]]
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[own]], nodes[own]


def _combine(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def combined() -> pa.RecordBatch:
            found = stars(*(np.concatenate([x.column(c).to_numpy() for x in held]) for c in "ab"))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= most:
                yield combined()
        if held:
            yield combined()

    return run


def _combined(links: DataFrame, label: str, most: int) -> DataFrame:
    return stored(links.mapInArrow(_combine(most), _LINKS), label)


def _least(links: DataFrame) -> DataFrame:
    """Per node its smallest neighbour or itself, and whether the node has two smaller neighbours, or smaller and greater ones."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lower = F.when(F.col("b") < F.col("a"), F.col("b"))
    found = both.groupBy(F.col("a").alias("u")).agg(F.min(lower).alias("low"), F.max(lower).alias("next"), F.max("b").alias("high"))
    unsettled = F.coalesce((F.col("low") < F.col("next")) | (F.col("high") > F.col("u")), F.lit(False)) & F.col("low").isNotNull()
    return stored(found.select("u", F.coalesce("low", "u").alias("m"), unsettled.alias("unsettled")), "least")


def _large_star(links: DataFrame, least: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = stored(links.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), "least")
    joined = links.join(least, F.col("b") == F.col("u"))
    moved = joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).filter("a < b").distinct()


def components(links: DataFrame, a: str, b: str, label: str = "component", most: int = 1_000_000) -> DataFrame:
    """(node, component) for every linked node that is not its component's smallest; the smallest node names the component.

    Nodes without a row are their own component. Links may repeat and may join a node with itself. A task combines about ``most`` links at a time.
    """
    ship(links.sparkSession)
    label = f"{label}-links"
    now = links.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b")).filter("a < b")
    now = _combined(now, label, most)
    while True:
        for _ in range(2):  # small files lie together once written, so a second pass meets more of the links
            now = _combined(now, label, most)
        least = _least(now)
        if least.filter("unsettled").isEmpty():
            break
        now = stored(_small_star(stored(_large_star(now, least), label)), label)
    return least.filter("m < u").select(F.col("u").alias("node"), F.col("m").alias("component"))
