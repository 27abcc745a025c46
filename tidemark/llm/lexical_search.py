"""Ranked lexical search by an Aho-Corasick scan of the documents.

The distinct terms of all items, each between two guard blanks, form one automaton that is broadcast. Texts are lower-cased and every
run of separators becomes guards too, so the automaton finds exactly the whole words that are item terms, and one pass over a text
gives its term frequencies; documents are never indexed. The scan stores a row per document: its length and the counts of
the item terms in it. Document frequencies are sums of those rows; then each task scores its documents, maps automaton outputs to items
and keeps the best of every item, and the few rows left are ranked.

Items are worked on in blocks of about ``block_terms`` (item, term) rows, so neither the automaton nor a task's memory
grows with the number of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored
from tidemark.llm.words import text_chunks

#: Terms are the maximal runs of what is neither of these.
SEPARATORS = ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_PATTERN = "[^" + "".join(f"\\x{low:02X}-\\x{high:02X}" for low, high in SEPARATORS) + "]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = 0x20
_SLICE = 1 << 20


def _folding() -> np.ndarray:
    """What every byte becomes: a guard for a separator, a small letter for a capital one, else itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for low, high in SEPARATORS:
        table[low : high + 1] = _GUARD
    return table


_FOLDED = _folding()


def automaton_of(terms: list[str]):
    """An automaton over the guarded bytes of the terms; its outputs are their positions in the list."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for code, term in enumerate(terms):
        automaton.add_word((b" " + term.encode() + b" ").decode("latin-1"), code)
    if terms:
        automaton.make_automaton()
    return automaton


def _slices(low: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of slices that begin and end with a guard; neighbours share it. A word longer than a slice makes a longer one."""
    at = 0
    while at < len(low) - 1:
        end = min(at + _SLICE, len(low) - 1)
        back = np.flatnonzero(low[at + 1 : end + 1] == _GUARD)
        if len(back):
            end = at + 1 + int(back[-1])
        else:
            while low[end] != _GUARD:
                end += 1
        yield at, end + 1
        at = end


def scan(automaton, n_terms: int, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text of a run, and (row, term code, count) of the automaton's terms, by row."""
    n = len(offsets) - 1
    spaced = np.full(len(raw) + n + 1, _GUARD, np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(offsets)) + 1] = raw
    low = _FOLDED[spaced]
    bounds = offsets + np.arange(n + 1)  # where the guard before each text lies
    guard = low == _GUARD
    lengths = np.diff(np.searchsorted(np.flatnonzero(guard[:-1] & ~guard[1:]), bounds))
    keys = []
    if n_terms:
        for first, last in _slices(low):
            found = np.fromiter(chain.from_iterable(automaton.iter(low[first:last].tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
            row = np.searchsorted(bounds, found[:, 0] + first, "left") - 1
            keys.append(np.stack(np.unique(row * n_terms + found[:, 1], return_counts=True)))
    if not keys:
        empty = np.empty(0, np.int64)
        return lengths, empty, empty, empty
    both = np.concatenate(keys, axis=1)
    key, at = np.unique(both[0], return_inverse=True)
    counts = np.zeros(len(key), np.int64)
    np.add.at(counts, at, both[1])
    return lengths, key // n_terms, key % n_terms, counts


_COUNTS = "doc_id long, n long, codes array<int>, tfs array<long>"


def _count(shared, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for first, last, raw, offsets in text_chunks(batch.column("text")):
                lengths, rows, codes, tfs = scan(automaton, n_terms, raw, offsets)
                ends = pa.array(np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(codes, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                    ],
                    ["doc_id", "n", "codes", "tfs"],
                )

    return run


def _holders(n_terms: int):
    """Documents of the task that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(batch.column("codes").flatten().to_numpy(), minlength=n_terms)
        codes = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(held[codes], pa.int64())], ["code", "held"])

    return run


class Best:
    """The highest-scoring documents of every item so far; equal scores by id, rows without one last."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.least = top, np.zeros(items, np.int64)
        self.kept = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores[document, item]`` of more documents."""
        if len(scores) > self.top:
            place = len(scores) - self.top
            self.least = np.maximum(self.least, np.partition(scores, place, axis=0)[place])
        row, item = np.nonzero((scores > 0) & (scores >= self.least))
        fresh = [item, scores[row, item], ids[row], no_id[row]]
        item, score, doc, empty = (np.concatenate(pair) for pair in zip(self.kept, fresh))
        order = np.lexsort((doc, empty, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, place, item = order[place < self.top], place[place < self.top], item[place < self.top]
        self.kept = [item, score[order], doc[order], empty[order]]
        full = place == self.top - 1
        self.least[item[full]] = self.kept[1][full]


def _score(shared, total_docs: int, total_terms: int, items: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, starts, item_of, repeats = shared.value
        best, step = Best(items, top), max(1, (1 << 22) // items)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                lists = batch.column("codes")
                codes, tfs = lists.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
                rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                scale = 100 - 25 + (25 * batch.column("n").to_numpy() * total_docs) // max(total_terms, 1)
                gain = weights[codes] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * scale[rows]))
                uses = starts[codes + 1] - starts[codes]
                place = np.repeat(starts[codes] - np.cumsum(uses) + uses, uses) + np.arange(uses.sum())
                scores = np.zeros(batch.num_rows * items, np.int64)
                np.add.at(scores, np.repeat(rows, uses) * items + item_of[place], np.repeat(gain, uses) * repeats[place])
                ids = batch.column("doc_id")
                best.add(scores.reshape(-1, items), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        item, score, doc, empty = best.kept
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=empty), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return run


def _block_best(plain: DataFrame, block: DataFrame, top: int, label: str) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each task for the items of one block."""
    spark = plain.sparkSession
    rows = block.toArrow()  # about ``block_terms`` rows
    named, numbered = (rows[c].combine_chunks().dictionary_encode(null_encoding="encode") for c in ("item_id", "term"))
    ids, terms = named.dictionary, numbered.dictionary.to_pylist()
    code, item, repeats = numbered.indices.to_numpy(), named.indices.to_numpy().astype(np.int64), rows["repeats"].to_numpy()
    by_code = np.argsort(code, kind="stable")
    starts = np.searchsorted(code[by_code], np.arange(len(terms) + 1))
    automaton = spark.sparkContext.broadcast(automaton_of(terms))
    counts = stored(plain.mapInArrow(_count(automaton, len(terms)), _COUNTS), f"{label}-counts")
    total_docs, total_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counts.select("codes").mapInArrow(_holders(len(terms)), "code int, held long").groupBy("code").agg(F.sum("held").alias("held"))
    df = np.zeros(len(terms), np.int64)
    for code, n in held.collect():  # a row per term of the block
        df[code] = n
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    maps = spark.sparkContext.broadcast((weights, starts, item[by_code], repeats[by_code]))
    found = counts.mapInArrow(_score(maps, total_docs, total_terms, len(ids), top), "item int, doc_id long, score long")
    names = spark.createDataFrame(pa.table({"own": pa.array(np.arange(len(ids)), pa.int32()), "item_id": ids}))
    return found.join(names, F.col("item") == F.col("own")).select("item_id", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = 20,
    block_terms: int = 100_000,
) -> DataFrame:
    """The ``top`` highest-scoring documents of every item with a score above 0: item_id, rank, doc_id, score.

    A term's weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))`` and a document's score for an item sums, over the item's terms with
    repeats, weight times ``10**9 tf div (1000 tf + 12 m)``, where ``m = 75 + 25 n N div L``. Equal scores go by ascending id.
    Documents and items whose text is null, empty or without a term have no row. Every row of the documents is a document, also if
    it repeats an id; rows without an id come last among equals. Rows that repeat an item_id are one item, and so are those without
    one. Very long texts are scanned whole, in slices. Empty tables give an empty result; other columns are not read.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    words = F.regexp_extract_all(F.translate(F.col(item_text), _UPPER, _LOWER), F.lit(_PATTERN), F.lit(0))
    terms = items.select(F.col(item_id).alias("item_id"), F.explode(words).alias("term"))
    terms = terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats"))
    terms = stored(terms, "item-terms")
    blocks = max(1, math.ceil(terms.count() / block_terms))
    parts = [terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == at) for at in range(blocks)]
    found = terms.select("item_id", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    for at, part in enumerate(parts):
        if not part.isEmpty():
            found = found.unionByName(_block_best(plain, part, top, f"block-{at}"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score").filter(F.col("rank") <= top)
