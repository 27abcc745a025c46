"""Benchmark decontamination over a distributed positional inverted index.

The index is document-partitioned: each row of the stored table is a segment, the sorted postings (term, place) of some
documents for the terms of the benchmark, next to the documents' ids and word counts. Places are global in a segment, with a gap
between documents, so one list serves many documents. Document frequencies come from the stored segments. A window of
benchmark words is looked up from its rarest term on: the places of that term, less its offset in the window, are the candidate starts, and
the offset-adjusted lists of the other terms, rarest first, are intersected with them. With a slop of zero the survivors are
exact phrases; with a positive slop every term must occur that close to its own place (proximity). Postings never
leave the task that made them, so no term or document can become a hot shuffle key.

The benchmark is worked off in blocks of at most ``block_words`` words, so what is sent to tasks is bounded for any benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_documents, ship, stored
from tidemark.llm.words import NOT_ALNUM, rows_of_words, text_chunks

_SEGMENT = "segment string, doc_ids array<long>, starts array<long>, n_words array<long>, terms array<long>, places array<long>"
_HITS = "segment string, ord int, doc_id long, n_words long, ranges array<struct<first:long,last:long>>, items array<string>, near array<string>"


def benchmark_windows(benchmark: DataFrame, length: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows of every item: (item_id string, n int, hashes array<long>); a short item is one window.

    Items without words or with a null id give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = [], []
            for first, last, raw, offsets in text_chunks(batch.column("text")):
                h, starts = rows_of_words(raw, offsets, NOT_ALNUM)
                h = h.view(np.int64)
                for i in range(last - first):
                    own = h[starts[i] : starts[i + 1]]
                    for at in range(max(1, len(own) - length + 1) if len(own) else 0):
                        ids.append(batch.column("item_id")[first + i].as_py())
                        hashes.append(own[at : at + length])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(hashes, pa.list_(pa.int64()))], ["item_id", "hashes"])

    items = benchmark.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    return items.mapInArrow(run, "item_id string, hashes array<long>").distinct()


def _segments(terms: np.ndarray, gap: int, segment_bytes: int):
    """Build segments: documents are cut off at ``segment_bytes`` of text, or hold one document."""
    sieve = np.zeros(1 << 16, bool)
    sieve[terms.view(np.uint64) >> np.uint64(48)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch.column("text"), segment_bytes):
                h, starts = rows_of_words(raw, offsets, NOT_ALNUM)
                n = np.diff(starts)
                begin = starts[:-1] + gap * np.arange(1, len(n) + 1)  # places of first words
                picked = np.flatnonzero(sieve[h >> np.uint64(48)])
                h = h[picked].view(np.int64)
                at = np.minimum(np.searchsorted(terms, h), len(terms) - 1) if len(terms) else np.zeros(0, np.int64)
                known = terms[at] == h if len(terms) else np.zeros(0, bool)
                at, place = at[known], picked[known]
                place = place + gap * np.searchsorted(starts[1:], place, "right") + gap
                order = np.argsort(at, kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{task}-{made}"]),
                        pa.array([batch.column("doc_id").slice(first, last - first).to_pylist()], pa.list_(pa.int64())),
                        pa.array([begin], pa.list_(pa.int64())),
                        pa.array([n], pa.list_(pa.int64())),
                        pa.array([at[order]], pa.list_(pa.int64())),
                        pa.array([place[order]], pa.list_(pa.int64())),
                    ],
                    ["segment", "doc_ids", "starts", "n_words", "terms", "places"],
                )
                made += 1

    return run


def _list(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy()


def phrase_starts(
    terms: np.ndarray, places: np.ndarray, grid: np.ndarray, order: np.ndarray, lengths: np.ndarray, slop: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every match in a segment.

    ``terms``/``places`` are postings sorted by both. ``grid`` has the term codes of every window, -1 beyond its length, and ``order``
    their offsets from the rarest term on.
    """
    if not len(terms) or not len(grid):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    span = int(places.max()) + grid.shape[1] + slop + 2
    key = terms * span + places
    present = np.zeros(int(max(grid.max(), terms.max())) + 2, bool)
    present[terms] = True
    present[-1] = True  # beyond a window's length
    window = np.flatnonzero(present[grid].all(axis=1))
    rarest = grid[window, order[window, 0]]
    low, high = np.searchsorted(terms, rarest), np.searchsorted(terms, rarest, "right")
    part = np.cumsum(high - low) // 1_000_000  # candidates at a time, so memory is bounded for very common windows
    found = []
    for own in np.split(np.arange(len(window)), np.flatnonzero(np.diff(part)) + 1):
        count = high[own] - low[own]
        source = np.repeat(low[own] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        win = np.repeat(window[own], count)
        start = places[source] - order[win, 0]
        for k in range(1, grid.shape[1]):
            offset = order[win, k]
            code = grid[win, offset]
            wanted = code * span + np.maximum(start + offset - slop, 0)
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            met = (lengths[win] <= k) | ((key[at] >= wanted) & (key[at] <= code * span + start + offset + slop))
            win, start = win[met], start[met]
        found.append((win, start))
    return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def _lookup(names: list[str], grid: np.ndarray, order: np.ndarray, lengths: np.ndarray, slop: int):
    names = np.array(names, object)

    def per_document(window, start, starts, width):
        ord_ = np.searchsorted(starts, start + width, "right") - 1
        return window, start, ord_

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                starts, n = _list(batch, "starts", row), _list(batch, "n_words", row)
                terms, places = _list(batch, "terms", row), _list(batch, "places", row)
                ranges, items, near = {}, {}, {}
                window, start, ord_ = per_document(*phrase_starts(terms, places, grid, order, lengths), starts, 0)
                for at in np.lexsort((start, ord_)):
                    d, first = int(ord_[at]), int(start[at] - starts[ord_[at]])
                    last = first + int(lengths[window[at]])
                    own = ranges.setdefault(d, [])
                    if own and first <= own[-1]["last"]:
                        own[-1]["last"] = max(last, own[-1]["last"])
                    else:
                        own.append({"first": first, "last": last})
                    items.setdefault(d, set()).add(names[window[at]])
                if slop:  # the start may lie before the first word, by the slop at most
                    window, start, ord_ = per_document(*phrase_starts(terms, places, grid, order, lengths, slop), starts, slop)
                    for at in range(len(window)):
                        near.setdefault(int(ord_[at]), set()).add(names[window[at]])
                docs = range(len(n))
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": [batch.column("segment")[row].as_py()] * len(n),
                        "ord": pa.array(docs, pa.int32()),
                        "doc_id": batch.column("doc_ids")[row].values,
                        "n_words": pa.array(n),
                        "ranges": pa.array([ranges.get(d, []) for d in docs], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                        "items": pa.array([sorted(items.get(d, ())) for d in docs], pa.list_(pa.string())),
                        "near": pa.array([sorted(near.get(d, ())) for d in docs], pa.list_(pa.string())),
                    }
                )

    return run


def _blocks(windows: DataFrame, block_words: int) -> list[tuple[list[str], list[np.ndarray]]]:
    """Windows in blocks whose words together stay below the limit; a block at a time is on the driver."""
    total = windows.agg(F.sum(F.size("hashes"))).first()[0] or 0
    count = max(1, -(-2 * total // block_words) if total > block_words else 1)
    block = windows.withColumn("block", F.pmod(F.xxhash64("item_id", "hashes"), F.lit(count)))
    for i in range(count):
        rows = block.filter(F.col("block") == i).select("item_id", "hashes").toArrow()
        yield rows.column("item_id").to_pylist(), [np.array(x, np.int64) for x in rows.column("hashes").to_pylist()]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 10,
    slop: int = 3,
    block_words: int = 4_000_000,
    segment_bytes: int = 1 << 20,
) -> DataFrame:
    """One row per document: doc_id, n_words, ranges (merged [first, last) word places), items, near (item ids with all words of a
    window within ``slop`` of their places).

    Null and empty texts have no words. Repeated rows and null ids are rows like others. An empty benchmark finds nothing.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    windows = stored(benchmark_windows(benchmark, length), "windows")
    found = []
    for names, hashes in _blocks(windows, block_words):
        terms = np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.int64)
        index = stored(plain.mapInArrow(_segments(terms, length + 2 * slop + 2, segment_bytes), _SEGMENT), "postings")
        used = np.zeros(len(terms), np.int64)
        counts = index.select(F.explode("terms").alias("term")).groupBy("term").count() if len(terms) else None
        for row in counts.collect() if counts is not None else ():  # at most one row per term of the block
            used[row["term"]] = row["count"]
        lengths = np.array([len(x) for x in hashes], np.int64)
        grid = np.full((len(hashes), length), -1, np.int64)
        order = np.tile(np.arange(length), (len(hashes), 1))
        for i, x in enumerate(hashes):
            grid[i, : len(x)] = np.searchsorted(terms, x)
            order[i, : len(x)] = np.argsort(used[grid[i, : len(x)]], kind="stable")
        found.append(index.mapInArrow(_lookup(names, grid, order, lengths, slop), _HITS))
    if len(found) == 1:
        return found[0].drop("segment", "ord")
    return _merged([stored(f, "hits") for f in found])


def _merged(found: list[DataFrame]) -> DataFrame:
    """Results of several blocks put together by document."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more.filter((F.size("ranges") > 0) | (F.size("near") > 0)))
    ranges = F.array_sort(F.flatten(F.collect_list("ranges")))
    start = F.struct(F.lit(-1).cast("long").alias("first"), F.lit(-1).cast("long").alias("last"))

    def add(acc, r):
        tail = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(tail["first"].alias("first"), F.greatest(tail["last"], r["last"]).alias("last"))))
        return F.when((F.size(acc) > 0) & (r["first"] <= tail["last"]), joined).otherwise(F.concat(acc, F.array(r)))

    both = every.groupBy("segment", "ord").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), ranges.alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    empty = F.filter(F.array(start), lambda x: x["last"] >= 0)
    return both.select("doc_id", "n_words", F.aggregate("ranges", empty, add).alias("ranges"), "items", "near")


def report(hits: DataFrame) -> DataFrame:
    """Digest columns of ``contamination``: n_hit, n_items, items_sha256, contaminated, n_near_items."""
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near_items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, all columns kept."""
    hits = contamination(docs, benchmark, doc_id, text, slop=0, **options)
    return keep_documents(docs, hits.select(F.col("doc_id").alias(doc_id), (F.size("ranges") == 0).alias("kept")), doc_id)
