"""MinHash near-dedup by a multi-index Hamming join.

Every document's set of word shingles gets a signature of ``chunks * width`` minimum hashes of 32 bits. The signature distance of two documents is
the number of positions in which they differ. Signatures are split into ``chunks`` pieces; two signatures at a distance
of at most ``chunks * (errors + 1) - 1`` agree in some piece up to ``errors`` positions (pigeonhole). With one error per piece
the allowed errors are enumerated by masking each position in turn, so all such pairs meet on an equal key. With the default
13 x 5 positions the guaranteed distance is 25 of 65; a pair with a Jaccard similarity of 0.85 exceeds it with a probability
below 1e-6, and more similar pairs less often.

Documents that meet on a key form candidate clusters. Clusters are cut into blocks of bounded size by hash, and a block of
pivots is compared with every block of its cluster per round, on the full shingle sets. Copies with equal sets are
one class from the start. A cluster ends as soon as its remaining documents are all in one component, so a hot group of near
copies takes a round or two. Only spanning links leave a task, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keep_documents, ship, stored
from tidemark.llm.components import components
from tidemark.llm.words import WHITE, mix, rows_of_words, text_chunks

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text. Fewer words than a shingle make one shingle; no word makes none."""
    factors = np.concatenate([_FACTORS * np.uint64(2 * i + 1) for i in range(-(-size // len(_FACTORS)))])
    for first, last, raw, offsets in text_chunks(column):
        words, starts = rows_of_words(raw, offsets, WHITE)
        for i in range(last - first):
            own = words[starts[i] : starts[i + 1]]
            n = min(size, len(own))
            if not n:
                yield own
                continue
            sums = np.zeros(len(own) - n + 1, np.uint64)
            for k in range(n):
                sums += own[k : k + len(sums)] * factors[k]
            yield np.unique(mix(sums + np.uint64(n)))


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The minimum of every seeded hash over the set, 32 bits each; memory does not grow with the set."""
    least = np.full(len(seeds), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 2048):
        hashed = (shingles[at : at + 2048, None] * seeds[None, :]) >> np.uint64(32)
        least = np.minimum(least, hashed.min(axis=0).astype(np.uint32))
    return least


def index_keys(sig: np.ndarray, chunks: int, width: int, errors: int) -> np.ndarray:
    """Keys of every chunk: the chunk itself, or with one allowed error the chunk with each position masked."""
    parts = sig.astype(np.uint64).reshape(chunks, width)
    place = np.arange(width, dtype=np.uint64)
    terms = mix(parts * np.uint64(2 * width + 1) + place + np.uint64(1))
    whole = terms.sum(axis=1, dtype=np.uint64)
    chunk = mix(np.arange(1, chunks + 1, dtype=np.uint64))
    if not errors:
        return mix(whole + chunk)
    masked = whole[:, None] - terms + mix(place + np.uint64(77))[None, :]
    return mix(masked + chunk[:, None]).ravel()


_NARROW = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"


def _narrow(doc_id: str, chunks: int, width: int, errors: int, size: int):
    seeds = np.random.default_rng(8).integers(1 << 32, 1 << 63, chunks * width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, set_a, set_b, keys = [], [], [], []
            for shingles in shingle_sets(batch.column("text"), size):
                counts.append(len(shingles))
                mixed = mix(shingles)
                set_a.append(mixed.sum(dtype=np.uint64))
                set_b.append(mix(mixed).sum(dtype=np.uint64))
                keys.append(index_keys(signature(shingles, seeds), chunks, width, errors) if len(shingles) else shingles)
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(np.array(set_a, np.uint64).view(np.int64)),
                    pa.array(np.array(set_b, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "keys"],
            )

    return run


def _shingles_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), size))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            names = ["doc_id", "cluster", "block"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [*names, "shingles"]
            )

    return run


def spanning_links(ids: np.ndarray, pivot: np.ndarray, values: np.ndarray, ends: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs (pivot, any) of at least ``percent`` per cent Jaccard connect.

    Sets are rows ``ends[i]:ends[i+1]`` of ``values``. A pair already connected is not compared.
    """
    _, codes = np.unique(values, return_inverse=True)
    sizes, root, out = np.diff(ends), np.arange(len(ids)), []
    flags = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    for i in np.flatnonzero(pivot):
        near = (root != root[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        others = np.flatnonzero(near)
        if not len(others):
            continue
        own = codes[ends[i] : ends[i + 1]]
        flags[own] = True
        picked = np.repeat(ends[others] - np.concatenate(([0], np.cumsum(sizes[others])[:-1])), sizes[others]) + np.arange(sizes[others].sum())
        shared = np.add.reduceat(flags[codes[picked]].astype(np.int64), np.concatenate(([0], np.cumsum(sizes[others])[:-1])))
        flags[own] = False
        for j in others[100 * shared >= percent * (sizes[others] + sizes[i] - shared)]:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                out.append((int(ids[i]), int(ids[j])))
    return out


def _compare(percent: int):
    def run(group: pa.Table) -> pa.Table:
        lists = group.column("shingles").combine_chunks()
        links = spanning_links(
            group.column("doc_id").to_numpy(),
            group.column("pivot").to_numpy(zero_copy_only=False),
            lists.flatten().to_numpy(),
            np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int64),
            percent,
        )
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 85,
    size: int = 5,
    chunks: int = 13,
    width: int = 5,
    errors: int = 1,
    block_shingles: int = 1_000_000,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked when the Jaccard similarity of their shingle sets is at least ``percent`` per cent. ``component_id`` is the smallest
    id that links reach. Documents without words link with nothing. A row with a null id links with nothing, has
    a null component and is kept. Rows that repeat an id are one document; each of them gets its component.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    narrow = stored(plain.mapInArrow(_narrow(doc_id, chunks, width, errors, size), _NARROW), "shingle-sets")
    filled = narrow.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(
        filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")),
        "classes",
    )
    keyed = classes.select("class_id", F.explode("keys").alias("key"))
    least = F.min("class_id").over(Window.partitionBy("key"))
    meets = keyed.select("class_id", least.alias("least")).filter("least < class_id")
    found = components(meets, "least", "class_id", "candidates")
    clusters = stored(found.unionByName(found.select(F.col("component").alias("node"), "component").distinct()), "clusters")
    sizes = (
        clusters.join(classes.select(F.col("class_id").alias("node"), "n_shingles"), "node")
        .groupBy("component")
        .agg(F.sum("n_shingles").alias("total"))
        .select("component", F.ceil(F.col("total") / block_shingles).cast("long").alias("blocks"))
    )
    members = clusters.join(sizes, "component").select(
        "node", F.col("component").alias("cluster"), F.pmod(F.xxhash64("node"), "blocks").alias("block"), "blocks"
    )
    members = stored(members, "members")
    sets = plain.join(members, F.col("doc_id") == F.col("node")).select("doc_id", "cluster", "block", "text")
    sets = stored(sets.mapInArrow(_shingles_of(size), "doc_id long, cluster long, block long, shingles array<long>"), "member-sets")
    rounds = members.agg(F.max("blocks")).first()[0] or 0
    links = [_round_links(sets, members, 0, percent)]
    for at in range(1, rounds):
        members = _unfinished(members, _all(links), at)
        if members is None:
            break
        links.append(_round_links(sets, members, at, percent))
    linked = components(_all(links), "a", "b", "near")
    own = F.col("class_id")
    named = stored(classes.select("set_a", "set_b", "class_id").join(linked, own == F.col("node"), "left").select(
        F.col("set_a").alias("sa"), F.col("set_b").alias("sb"), F.coalesce("component", own).alias("component")), "named")
    joined = narrow.join(
        named, (F.col("set_a") == F.col("sa")) & (F.col("set_b") == F.col("sb")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left"
    )
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _all(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _round_links(sets: DataFrame, members: DataFrame, at: int, percent: int) -> DataFrame:
    """Links of the pivots (block ``at`` of every cluster) with the blocks from ``at`` on."""
    if at:
        sets = sets.join(members.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    blocks = members.filter(F.col("block") >= at).select("cluster", F.col("block").alias("against")).distinct()
    pivots = sets.filter(F.col("block") == at).join(blocks, "cluster").select("doc_id", "cluster", "against", F.lit(True).alias("pivot"), "shingles")
    others = sets.filter(F.col("block") > at).select("doc_id", "cluster", F.col("block").alias("against"), F.lit(False).alias("pivot"), "shingles")
    groups = pivots.unionByName(others).groupBy("cluster", "against")
    return stored(groups.applyInArrow(_compare(percent), "a long, b long"), "near-links")


def _unfinished(members: DataFrame, links: DataFrame, at: int) -> DataFrame | None:
    """Members of the clusters whose blocks from ``at`` on are still in more than one component; None when there are none."""
    linked = components(links, "a", "b", "round")
    left = members.filter(F.col("block") >= at)
    labelled = left.join(linked, "node", "left").select("cluster", F.coalesce("component", "node").alias("component"))
    open_ones = labelled.groupBy("cluster").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("cluster")
    left = stored(left.join(open_ones, "cluster", "left_semi"), "members")
    return None if left.isEmpty() else left


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without near copies, all columns kept: the smallest id of every component stays."""
    decided = near_duplicates(docs, doc_id, text, **options).select(F.col("doc_id").alias(doc_id), "kept")
    return keep_documents(docs, decided, doc_id)
