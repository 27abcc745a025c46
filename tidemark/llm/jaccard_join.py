"""N-gram Jaccard join over a token-group matrix.

Documents with equal shingle sets are one class. Shingles have one global order, rare ones first. Two sets at the threshold share at least
``least_shared`` of the first shingles of each, their prefixes. Tasks send the prefixes packed, by slices of the hash space; what comes back
are the shingles that several sets have in their prefix. Only classes with enough of those go on. They are sorted by
minimum hashes, so that similar ones lie side by side, and cut into groups of a bounded number of classes and shingles.

The matrix holds a row for every 64 members of a group: the union of their shingles and, for every shingle of it, the members that have it as 64 bits. A
query first counts its shingles in the union, an upper bound of its overlap with every member. Only when the bound reaches the threshold is the row opened:
the bits give the exact overlap with all members at once.

Queries meet groups with which they share enough prefix shingles, in three rounds. Members are queries of their own group, which cuts it into cells
of linked classes. Then one class per cell asks the first group of each of its shingles, which joins what large groups of near copies have in common.
Last, every class asks the groups that hold a class of a larger component than its own. A pair that is left out
is already connected, so components are exact, and the work on a hot group of near copies is not quadratic in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored
from tidemark.llm.components import components
from tidemark.llm.near_dedup import shingle_sets
from tidemark.llm.words import mix

_BUCKET_BITS = 20
_SLICES = 64
_MEMBERS = 64
_BIG = 1 << 16
#: Up to so many groups (16 bytes a class) are broadcast to pick the texts of their members; beyond, texts are shuffled.
_BROADCAST_CLASSES = 1_000_000


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)


def _tally(size: int):
    """Shingle occurrences of the task by bucket, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _BUCKET_BITS, np.int64)
        waiting, held = [], 0

        def flush() -> None:
            if waiting:
                np.add.at(counts, _bucket(np.concatenate(waiting)), 1)
                waiting.clear()

        for batch in batches:
            for shingles in shingle_sets(batch.column("text"), size):
                waiting.append(shingles)
                held += len(shingles)
                if held > _BIG:
                    flush()
                    held = 0
        flush()
        rows = counts.astype("<u4").reshape(_SLICES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], ["slice", "counts"])

    return run


def _sum_slices(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, "<u4").astype(np.int64) for c in group.column("counts").to_pylist())
    level = np.minimum(4 * np.log2(1 + total), 255).astype(np.uint8)
    return pa.table({"slice": group.column("slice").slice(0, 1), "levels": pa.array([level.tobytes()], pa.binary())})


def frequency_levels(plain: DataFrame, size: int) -> np.ndarray:
    """How frequent the shingles of each of 2**20 hash buckets are, on a scale of 0 to 255; counted over all documents.

    It only orders shingles, so a collision costs time and loses no link.
    """
    parts = plain.mapInArrow(_tally(size), "slice int, counts binary").groupBy("slice").applyInArrow(_sum_slices, "slice int, levels binary")
    rows = sorted(parts.collect(), key=lambda r: r["slice"])  # a megabyte whatever the input
    return np.frombuffer(b"".join(r["levels"] for r in rows), np.uint8) if rows else np.zeros(1 << _BUCKET_BITS, np.uint8)


def shared_first(n: int) -> int:
    """How many prefix shingles a set of n asks for: a twentieth, which costs few shingles and excludes sets that share a passage only."""
    return max(1, n // 20)


def prefix_length(n: int, percent: int) -> int:
    """So many of the first shingles of two sets at the threshold have ``shared_first`` of the smaller set in common."""
    return min(n, n - -(-percent * n // 100) + shared_first(n))


def _least_shared(n: Column, percent: int) -> Column:
    """What a set of n shingles shares at least with the prefix of any set at the threshold."""
    smallest = F.ceil(percent * n / F.lit(100))
    return F.greatest(F.lit(1), F.floor(smallest / 20)).cast("long")


_NARROW = "doc_id long, n_shingles long, set_a long, set_b long, near_a long, near_b long"


def _narrow(size: int):
    seeds = np.random.default_rng(11).integers(1 << 32, 1 << 63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for shingles in shingle_sets(batch.column("text"), size):
                n, mixed = len(shingles), mix(shingles)
                least = [int(((mixed * s) >> np.uint64(32)).min()) if n else 0 for s in seeds]
                rows.append((n, mixed.sum(dtype=np.uint64), mix(mixed).sum(dtype=np.uint64), least[0] << 32 | least[1], least[2] << 32 | least[3]))
            numbers = np.array(rows, np.uint64).reshape(-1, 5).view(np.int64)
            columns = [batch.column("doc_id"), *(pa.array(numbers[:, i]) for i in range(5))]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _NARROW.split(", ")])

    return run


_PACKED = "slice int, sets binary, counts binary, codes binary"


def _prefixes(levels, hot_level: int, bits: int, percent: int, size: int):
    """The prefixes of the task's sets in ``2**bits`` slices: 32 bits of each shingle, after its set and how many it has there.

    A set that a megabyte of text repeats is sent once. Shingles of hot buckets go with the task instead of with the slice.
    """

    def pack(key: int, sets: np.ndarray, row: np.ndarray, codes: np.ndarray, kind: str) -> tuple:
        own, counts = np.unique(row, return_counts=True)
        return key, sets[own].tobytes(), counts.astype("<u4").tobytes(), codes.astype(kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        level, task = levels.value, TaskContext.get().partitionId()
        names = [f.split()[0] for f in _PACKED.split(", ")]
        for batch in batches:
            for some in _runs(shingle_sets(batch.column("text"), size)):
                sets, parts, heat = [], [], []
                for key, shingles in {int(mix(s).sum(dtype=np.uint64)): s for s in some if len(s)}.items():
                    own = level[_bucket(shingles)]
                    first = np.argsort(own, kind="stable")[: prefix_length(len(shingles), percent)]
                    sets.append(key)
                    parts.append(shingles[first])
                    heat.append(own[first] >= hot_level)
                if not sets:
                    continue
                keys, row = np.array(sets, np.uint64), np.repeat(np.arange(len(sets)), [len(p) for p in parts])
                code, hot = np.concatenate(parts) >> np.uint64(32 - bits), np.concatenate(heat)
                where = (code >> np.uint64(32)).astype(np.int64)
                order = np.argsort(np.where(hot, -1, where), kind="stable")
                order = order[np.count_nonzero(hot) :]
                ends = np.searchsorted(where[order], np.arange((1 << bits) + 1))
                out = [pack(-1 - task, keys, row[hot], code[hot], "<u8")] if hot.any() else []
                out += [
                    pack(i, keys, row[order[x:y]], code[order[x:y]] & np.uint64(0xFFFFFFFF), "<u4")
                    for i, (x, y) in enumerate(zip(ends, ends[1:])) if y > x
                ]
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def _runs(sets: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Sets in lists of a bounded number of shingles, or of one set."""
    some, held = [], 0
    for s in sets:
        some.append(s)
        held += len(s)
        if held > 1 << 18:
            yield some
            some, held = [], 0
    if some:
        yield some


def _met(group: pa.Table) -> pa.Table:
    """(token, set) of the shingles that at least two sets of the slice have; of a task's hot ones, all."""
    slice_ = group.column("slice")[0].as_py()
    sets, counts, codes = (b"".join(group.column(c).to_pylist()) for c in ("sets", "counts", "codes"))
    owner = np.repeat(np.frombuffer(sets, np.int64), np.frombuffer(counts, "<u4"))
    code = np.frombuffer(codes, "<u8" if slice_ < 0 else "<u4").astype(np.int64)
    order = np.lexsort((owner, code))
    code, owner = code[order], owner[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    code, owner = code[fresh], owner[fresh]
    if slice_ >= 0:
        same = code[1:] == code[:-1]
        several = np.append(same, False) | np.append(False, same)[: len(code)]
        code, owner = code[several] | (slice_ << 32), owner[several]
    return pa.table({"token": pa.array(code, pa.int64()), "set_a": pa.array(owner, pa.int64())})


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a sorted partition, and sum the shingles before each."""
    from pyspark import TaskContext

    part, rows, held = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        n = batch.column("n_shingles").to_numpy()
        columns = [np.full(len(n), part), np.arange(rows, rows + len(n)), held + np.cumsum(n) - n]
        rows, held = rows + len(n), held + int(n.sum())
        yield pa.RecordBatch.from_arrays([batch.column("class_id"), batch.column("n_shingles"), *map(pa.array, columns)], ["class_id", "n_shingles", "part", "place", "before"])


def _cut(ranged: DataFrame, most_classes: int, most_shingles: int) -> DataFrame:
    """(class_id, grp): the rows in their order, cut whenever so many classes or shingles are full. Groups cross partitions."""
    placed = stored(ranged.mapInArrow(_places, "class_id long, n_shingles long, part long, place long, before long"), "places")
    ends = placed.groupBy(F.col("part").alias("of")).agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles"))
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = ends.select("of", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("rows", "shingles")))
    by_rows, by_size = F.floor((F.col("rows") + F.col("place")) / most_classes), F.floor((F.col("shingles") + F.col("before")) / most_shingles)
    # Both only grow along the order, so their sum changes wherever one of them does.
    return placed.join(starts, F.col("part") == F.col("of")).select("class_id", (by_rows + by_size).cast("long").alias("grp"))


def _sets_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), size))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("class_id"), batch.column("grp"), lists], ["class_id", "grp", "shingles"])

    return run


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    ends = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
    flat = column.flatten().to_numpy()
    return [flat[x:y] for x, y in zip(ends, ends[1:])]


def shared(bits: np.ndarray) -> np.ndarray:
    """How many of the given rows each of 64 members has."""
    total = np.zeros(_MEMBERS, np.int64)
    for at in range(0, len(bits), _BIG):
        rows = np.ascontiguousarray(bits[at : at + _BIG]).view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


class Group:
    """A row of the matrix: the sorted union of up to 64 sets and who has each shingle."""

    def __init__(self, union: np.ndarray, bits: np.ndarray, sizes: np.ndarray) -> None:
        self.union, self.bits, self.sizes = union, bits, sizes

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Group:
        union, code = np.unique(np.concatenate(sets), return_inverse=True)
        bits = np.zeros(len(union), np.uint64)
        sizes = np.array([len(s) for s in sets], np.int64)
        np.bitwise_or.at(bits, code, np.uint64(1) << np.repeat(np.arange(len(sets), dtype=np.uint64), sizes))
        return cls(union, bits, sizes)

    def links(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Positions of the members at the threshold; the group is opened only if the union leaves room for one."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        inside = at[self.union[at] == query]
        if 100 * len(inside) < percent * len(query):
            return np.empty(0, np.int64)
        both = shared(self.bits[inside])[: len(self.sizes)]
        return np.flatnonzero(100 * both >= percent * (len(query) + self.sizes - both))


_MATRIX = "grp long, ids array<long>, sizes array<long>, cells array<long>, shingles array<long>, bits array<long>"


def _matrix(percent: int):
    def run(group: pa.Table) -> pa.Table:
        ids, sets = group.column("class_id").to_numpy(), _lists(group.column("shingles"))
        out = {name: [] for name in ("grp", "ids", "sizes", "cells", "shingles", "bits")}
        starts = range(0, len(ids), _MEMBERS)
        made, cell = [Group.of(sets[at : at + _MEMBERS]) for at in starts], np.arange(len(ids))
        for i, query in enumerate(sets):
            for at, chunk in zip(starts[i // _MEMBERS :], made[i // _MEMBERS :]):  # earlier ones have asked this one
                for j in chunk.links(query, percent):
                    cell[cell == cell[at + j]] = cell[i]
        least = np.array([ids[cell == c].min() for c in cell])
        for at, chunk in zip(starts, made):
            own = slice(at, at + _MEMBERS)
            values = (group.column("grp")[0].as_py(), ids[own], chunk.sizes, least[own], chunk.union, chunk.bits.view(np.int64))
            for name, value in zip(out, values):
                out[name].append(value)
        kinds = {name: pa.int64() if name == "grp" else pa.list_(pa.int64()) for name in out}
        return pa.table({name: pa.array(values, kinds[name]) for name, values in out.items()})

    return run


def _answer(percent: int):
    def run(queries: pa.Table, matrix: pa.Table) -> pa.Table:
        asked, sets, found = queries.column("class_id").to_pylist(), _lists(queries.column("shingles")), []
        columns = [_lists(matrix.column(c)) for c in ("ids", "sizes", "cells", "shingles", "bits")]
        for ids, sizes, cells, union, bits in zip(*columns):
            group = Group(union, bits.view(np.uint64), sizes)
            for own, query in zip(asked, sets):
                linked = group.links(query, percent)
                _, first = np.unique(cells[linked], return_index=True)
                found += [(own, other) for other in ids[linked[first]].tolist() if other != own]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _ask(queries: DataFrame, sets: DataFrame, matrix: DataFrame, percent: int, most_shingles: int) -> DataFrame:
    """Links of the queries (class_id, grp) with the groups they ask, one per cell. A group that many ask answers in several tasks."""
    queries = stored(queries, "queries")
    asked = queries.join(sets.select("class_id", "shingles"), "class_id")
    load = queries.join(sets.select("class_id", F.size("shingles").alias("n")), "class_id").groupBy("grp").agg(F.sum("n").alias("load"))
    parts = stored(load.select(F.col("grp").alias("of"), F.ceil(F.col("load") / most_shingles).cast("int").alias("parts")), "query-parts")
    dealt = asked.join(parts, F.col("grp") == F.col("of")).select(
        "grp", F.pmod(F.xxhash64("class_id"), "parts").cast("int").alias("part"), "class_id", "shingles"
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    copies = matrix.join(parts, F.col("grp") == F.col("of")).select(*matrix.columns, every)
    both = dealt.groupBy("grp", "part").cogroup(copies.groupBy("grp", "part"))
    return stored(both.applyInArrow(_answer(percent), "a long, b long"), "group-links")


def _shared_prefixes(plain, classes, narrow, percent: int, size: int, slice_shingles: int, hot_rows: int) -> DataFrame:
    """(token, class_id, n_shingles) of the prefix shingles of classes that share enough of theirs with other classes."""
    spark = plain.sparkSession
    total = narrow.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, total * (105 - percent) / 100 / slice_shingles))))
    hot_level = 4 * math.log2(1 + max(hot_rows, 16 * total / (1 << _BUCKET_BITS)))
    levels = spark.sparkContext.broadcast(frequency_levels(plain, size))
    packed = plain.mapInArrow(_prefixes(levels, math.ceil(hot_level), min(bits, 31), percent, size), _PACKED)
    met = packed.groupBy("slice").applyInArrow(_met, "token long, set_a long").distinct()
    keys = classes.select(F.col("set_a").alias("of"), "class_id", "n_shingles")
    opened = stored(met.join(keys, F.col("set_a") == F.col("of")).select("token", "class_id", "n_shingles"), "shared-prefixes")
    for _ in range(2):  # what is held by one class only, once others are out, counts no more
        enough = opened.groupBy("class_id", "n_shingles").agg(F.count(F.lit(1)).alias("held"))
        enough = enough.filter(F.col("held") >= _least_shared(F.col("n_shingles"), percent)).select(F.col("class_id").alias("of"))
        left = opened.join(enough.distinct(), F.col("class_id") == F.col("of"), "left_semi")
        several = left.groupBy(F.col("token").alias("by")).agg(F.min("class_id").alias("x"), F.max("class_id").alias("y")).filter("x < y")
        opened = stored(left.join(several.select("by"), F.col("token") == F.col("by"), "left_semi"), "shared-prefixes")
    return opened


def jaccard_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 85,
    size: int = 4,
    group_classes: int = 512,
    group_shingles: int = 1_000_000,
    query_shingles: int = 2_000_000,
    slice_shingles: int = 4_000_000,
    hot_rows: int = 200_000,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Documents are linked when the Jaccard similarity of their sets of ``size``-word shingles is at least ``percent`` per cent; ``component_id`` is
    the smallest id that links reach. Fewer words make one shingle. A text that is null, empty or without words has an empty set and links with
    nothing. A row with a null id links with nothing and has a null component. Rows that repeat an id are one document with several
    texts. Very long texts are read whole; a set beyond ``group_shingles`` is a group of its own. An empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    narrow = stored(plain.mapInArrow(_narrow(size), _NARROW), "shingle-sets")
    filled = narrow.filter("n_shingles > 0 and doc_id is not null")
    first = [F.first(c).alias(c) for c in ("n_shingles", "near_a", "near_b")]
    classes = stored(filled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("class_id"), *first), "classes")
    opened = _shared_prefixes(plain.filter("doc_id is not null"), classes, narrow, percent, size, slice_shingles, hot_rows)

    active = opened.select("class_id").distinct()
    order = ["near_a", "near_b", "class_id"]
    ranged = classes.join(active, "class_id", "left_semi").groupBy("class_id").agg(*(F.max(c).alias(c) for c in ("near_a", "near_b", "n_shingles")))
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order).select("class_id", "n_shingles")
    groups = stored(_cut(ranged, group_classes, group_shingles), "groups")
    if groups.count() <= _BROADCAST_CLASSES:
        groups = F.broadcast(groups)
    texts = plain.join(groups, F.col("doc_id") == F.col("class_id")).select("class_id", "grp", "text")
    sets = texts.mapInArrow(_sets_of(size), "class_id long, grp long, shingles array<long>").filter(F.size("shingles") > 0)
    sets = stored(sets, "member-sets")
    matrix = stored(sets.groupBy("grp").applyInArrow(_matrix(percent), _MATRIX), "matrix")

    members = matrix.select("grp", F.explode(F.arrays_zip("ids", "cells")).alias("own")).select("grp", "own.ids", "own.cells")
    cells = stored(members.groupBy(F.col("ids").alias("class_id")).agg(F.min("cells").alias("cell"), F.min("grp").alias("grp")), "cells")
    links = members.select(F.col("ids").alias("a"), F.col("cells").alias("b"))

    placed = opened.join(cells, "class_id")
    hubs = placed.groupBy(F.col("token").alias("of")).agg(F.min("grp").alias("hub"), F.min("cell").alias("x"), F.max("cell").alias("y")).filter("x < y")
    asking = placed.select("token", "cell", "grp").distinct().join(hubs, (F.col("token") == F.col("of")) & (F.col("grp") != F.col("hub")))
    asking = asking.select(F.col("cell").alias("class_id"), F.col("hub").alias("grp")).distinct()
    links = links.unionByName(_ask(asking, sets, matrix, percent, query_shingles))

    found = components(links, "a", "b", "joined")
    own = stored(cells.join(found, F.col("class_id") == F.col("node"), "left").select("class_id", "grp", F.coalesce("component", "class_id").alias("component")), "parts")
    weight = own.groupBy(F.col("component").alias("of")).agg(F.count(F.lit(1)).alias("weight"))
    ranks = own.join(weight, F.col("component") == F.col("of")).select("class_id", "grp", F.struct("weight", "component").alias("rank"))
    open_again = opened.join(ranks, "class_id")
    still = open_again.groupBy(F.col("token").alias("of")).agg(F.min("rank").alias("x"), F.max("rank").alias("y")).filter("x < y").select("of")
    open_again = stored(open_again.join(still, F.col("token") == F.col("of")).select("token", "class_id", "n_shingles", "grp", "rank"), "open-prefixes")
    held = open_again.groupBy(F.col("token").alias("by"), F.col("grp").alias("asked")).agg(
        F.max("rank").alias("top"), F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high")
    )
    fits = (100 * F.col("high") >= percent * F.col("n_shingles")) & (percent * F.col("low") <= 100 * F.col("n_shingles"))
    meets = open_again.join(held, (F.col("token") == F.col("by")) & (F.col("grp") != F.col("asked")) & (F.col("rank") < F.col("top")) & fits)
    meets = meets.groupBy("class_id", "n_shingles", "asked").agg(F.count(F.lit(1)).alias("common"))
    meets = meets.filter(F.col("common") >= _least_shared(F.col("n_shingles"), percent))
    last = _ask(meets.select("class_id", F.col("asked").alias("grp")).distinct(), sets, matrix, percent, query_shingles)

    sides = [F.min("set_a").alias("a"), F.max("set_a").alias("b"), F.min("set_b").alias("c"), F.max("set_b").alias("d")]
    several = filled.groupBy(F.col("doc_id").alias("of")).agg(*sides).filter("a < b or c < d").select("of")
    keys = classes.select(F.col("set_a").alias("sa"), F.col("set_b").alias("sb"), "class_id")
    split = filled.join(several, F.col("doc_id") == F.col("of")).join(keys, (F.col("set_a") == F.col("sa")) & (F.col("set_b") == F.col("sb")))
    split = split.select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    linked = components(own.select(F.col("component").alias("a"), F.col("class_id").alias("b")).unionByName(last).unionByName(split), "a", "b", "linked")

    final = stored(
        classes.select("set_a", "set_b", "class_id")
        .join(linked, F.col("class_id") == F.col("node"), "left")
        .select(F.col("set_a").alias("sa"), F.col("set_b").alias("sb"), F.coalesce("component", "class_id").alias("component")),
        "named",
    )
    same = (F.col("set_a") == F.col("sa")) & (F.col("set_b") == F.col("sb")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return narrow.join(final, same, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
