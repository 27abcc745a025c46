"""Alignment of two tokenizers' tokens of the same texts by byte offsets.

Texts are encoded by both tokenizers in blocks of about a megabyte. The tokens of a block are two pandas frames with document and first byte, and ``merge_asof``, keyed
by document, finds for each token's start the token of the other side that covers it. Two tokens overlap exactly when the later of
their starts lies in the other one, so the union of both directions is every overlap once the pairs with equal starts are counted once.
Offsets where tokens of both sides end cut the tokens into groups.

What a block learns is stored as one row: a row's worth of numbers per document, the block's distinct pairs of ids with the
documents that hold them, and the links as positions in that list. Corpus-wide counts then need only the distinct pairs of the blocks, not
those of the documents, and come back as a row per pair of a block. The tables are joined by pair and grouped by block, so no vocabulary is
assumed to be small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored
from tidemark.llm.words import text_chunks


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE of the tokenizers library; the text is encoded with a blank before it."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = _bytes_of_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(map(letters.__getitem__, token)) if all(map(letters.__contains__, token)) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts the blank there itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.pieces.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


# Bytes beside a blank at which a text is not cut: control characters, and the first bytes of all characters that count as blank somewhere.
_UNSURE = np.zeros(256, bool)
_UNSURE[:0x21] = _UNSURE[0x7F] = True
_UNSURE[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_CUT = 0xFF  # in no UTF-8 text


def stretches(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The texts cut at single blanks between visible characters, and how many stretches each has.

    Tokenizers of both kinds begin a token at such a blank and look at no character before it, so stretches can be encoded apart, each after a blank.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    low = np.frombuffer(bytes([_CUT]).join(texts) + bytes([_CUT]), np.uint8).copy()
    ends = np.cumsum(lengths + 1) - 1
    at = np.flatnonzero(low == 0x20)
    at = at[(at >= 3) & (low[np.minimum(at + 1, len(low) - 1)] != _CUT)]
    before = _UNSURE[low[at - 1]] | (low[at - 1] == _CUT)
    for back in (2, 3):  # where the character before begins, if it has several bytes
        before |= (low[at - 1] >= 0x80) & _UNSURE[low[at - back]] & (low[at - back] >= 0x80)
    low[at[~before & ~_UNSURE[low[at + 1]]]] = _CUT
    per = np.diff(np.searchsorted(np.flatnonzero(low == _CUT), ends, "right"), prepend=0)
    return low.tobytes().split(bytes([_CUT]))[:-1], per


class Sides:
    """Both tokenizers, with the byte lengths of their ids, and the ids of the stretches seen lately."""

    def __init__(self, a: ByteLevel, b: Pieces, most: int = 400_000) -> None:
        self.tokenizers, self.most = (a, b), most
        self.lengths = [np.array([len(p) for p in t.pieces], np.int64) for t in self.tokenizers]
        # Ids in decimal before a comma, and before what ends a group on that side.
        self.written = [
            np.array([f"{i}{mark}" for i in range(len(t.pieces)) for mark in (",", end)], object) for t, end in zip(self.tokenizers, "|;")
        ]
        # A piece with a blank behind another character could join two stretches.
        self.cuts = not any(b" " in p.lstrip(b" ") for p in b.pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.spelt = np.empty(0, bool)
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]

    def learn(self, some: list[bytes]) -> np.ndarray:
        """Numbers of the stretches; their ids are kept, and whether both sides spell a blank and the stretch byte by byte."""
        got = np.fromiter(map(self.known.get, some, repeat(-1)), np.int64, len(some))
        fresh = list(dict.fromkeys([some[i] for i in np.flatnonzero(got < 0)]))
        if fresh:
            texts, spelt = [x.decode() for x in fresh], np.ones(len(fresh), bool)
            for side, tokenizer in enumerate(self.tokenizers):
                ids, pieces = tokenizer.encode(texts), tokenizer.pieces
                spelt &= [b"".join([pieces[i] for i in own]) == b" " + x for own, x in zip(ids, fresh)]
                self.ids[side] = np.append(self.ids[side], np.fromiter(chain.from_iterable(ids), np.int32))
                ends = self.starts[side][-1] + np.cumsum([len(own) for own in ids])
                self.starts[side] = np.append(self.starts[side], ends)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.spelt = np.append(self.spelt, spelt)
            got = np.fromiter(map(self.known.__getitem__, some), np.int64, len(some))
        return got

    def encode(self, texts: list[bytes]) -> list[pd.DataFrame]:
        """The tokens of both sides; those of a text that a side does not spell are left out."""
        if len(self.known) > self.most or len(self.ids[0]) > 8 * self.most:
            self.forget()
        some, per = stretches(texts) if self.cuts else (texts, np.ones(len(texts), np.int64))
        number, doc = self.learn(some), np.repeat(np.arange(len(texts)), per)
        wrong = np.unique(doc[~self.spelt[number]])
        if len(wrong):  # the whole text decides
            whole = self.learn([texts[i] for i in wrong])
            left = ~np.isin(doc, wrong)
            number, doc = np.append(number[left], whole[self.spelt[whole]]), np.append(doc[left], wrong[self.spelt[whole]])
            order = np.argsort(doc, kind="stable")
            number, doc = number[order], doc[order]
        filled = np.array([len(t) > 0 for t in texts], bool)[doc]
        number, doc = number[filled], doc[filled]
        bases = np.cumsum([0] + [len(t) + 1 for t in texts])
        return [self._frame(side, number, doc, bases) for side in (0, 1)]

    def _frame(self, side: int, number: np.ndarray, doc: np.ndarray, bases: np.ndarray) -> pd.DataFrame:
        """Document, first byte, end and id of the tokens; ``bases`` says where each document's bytes begin in the block."""
        first = self.starts[side][number]
        count = self.starts[side][number + 1] - first
        ids = self.ids[side][np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())].astype(np.int64)
        doc, lengths = np.repeat(doc, count), self.lengths[side][ids]
        ends = np.cumsum(lengths)
        here = np.searchsorted(doc, np.arange(len(bases) - 1))  # where each document's tokens begin
        ends += (bases[:-1] - np.concatenate(([0], ends))[here])[doc]
        return pd.DataFrame({"doc": doc, "start": ends - lengths, "end": ends, "id": ids, "place": np.arange(len(ids))})


_sides: dict[tuple[str, str], Sides] = {}


def _both(byte_level: str, pieces: str) -> Sides:
    """The tokenizers of this Python worker, which Spark uses for many tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (byte_level, pieces) not in _sides:
        _sides[byte_level, pieces] = Sides(ByteLevel(byte_level), Pieces(pieces))
    return _sides[byte_level, pieces]


def covering(tokens: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """The place of the other side's token that covers each token's start."""
    return pd.merge_asof(tokens[["doc", "start"]], others[["doc", "start", "place"]], on="start", by="doc")["place"].to_numpy(np.int64)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens that share a byte."""
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    over_a, over_b = covering(a, b), covering(b, a)
    later = a["start"].to_numpy()[over_b] != b["start"].to_numpy()  # equal starts are found in both directions
    places = np.arange(len(b))[later]
    return np.concatenate((np.arange(len(a)), over_b[later])), np.concatenate((over_a, places))


def aligned(a: pd.DataFrame, b: pd.DataFrame, written: list[np.ndarray], docs: int) -> tuple[np.ndarray, list[str]]:
    """Groups per document, and the SHA-256 of their written form."""
    end_a, end_b = a["end"].to_numpy(), b["end"].to_numpy()
    place = np.minimum(np.searchsorted(end_b, end_a), max(len(end_b) - 1, 0))
    last_a = end_b[place] == end_a if len(end_b) else np.empty(0, bool)
    last_b = np.zeros(len(end_b), bool)
    last_b[place[last_a]] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    until_a, until_b = np.flatnonzero(last_a) + 1, np.concatenate(([0], np.flatnonzero(last_b) + 1))
    parts = np.empty(len(a) + len(b), object)
    parts[np.arange(len(a)) + until_b[group_a]] = written[0][2 * a["id"].to_numpy() + last_a]
    parts[np.arange(len(b)) + until_a[group_b]] = written[1][2 * b["id"].to_numpy() + last_b]
    edges = np.arange(docs + 1)
    starts = np.searchsorted(a["doc"].to_numpy(), edges) + np.searchsorted(b["doc"].to_numpy(), edges)
    parts = parts.tolist()
    texts = ("".join(parts[first:last])[:-1] for first, last in zip(starts, starts[1:]))
    groups = np.bincount(a["doc"].to_numpy()[last_a], minlength=docs)
    return groups, [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]


_BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
    "pairs array<long>, holders array<long>, link_doc array<int>, link_pair array<int>, link_n array<int>"
)


def align_block(texts: list[bytes], sides: Sides) -> dict[str, np.ndarray | list[str]]:
    """What a block of texts contributes; a text that one side does not spell byte by byte has no tokens."""
    a, b = sides.encode(texts)
    groups, digests = aligned(a, b, sides.written, len(texts))
    place_a, place_b = overlaps(a, b)
    pairs, code = np.unique((a["id"].to_numpy()[place_a] << 32) | b["id"].to_numpy()[place_b], return_inverse=True)
    links, repeats = np.unique(a["doc"].to_numpy()[place_a] * max(len(pairs), 1) + code, return_counts=True)
    link_pair = links % max(len(pairs), 1)
    return {
        "n_a": np.bincount(a["doc"], minlength=len(texts)),
        "n_b": np.bincount(b["doc"], minlength=len(texts)),
        "n_groups": groups,
        "groups_sha256": digests,
        "pairs": pairs,
        "holders": np.bincount(link_pair, minlength=len(pairs)),
        "link_doc": links // max(len(pairs), 1),
        "link_pair": link_pair,
        "link_n": repeats,
    }


#: A reader takes a row group's rows at once, and a block is a row of a megabyte or more; so a group of the file holds a few of them, however many a task makes.
_FEW_BLOCKS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1"}

_KINDS = {"groups_sha256": pa.string(), "link_doc": pa.int32(), "link_pair": pa.int32(), "link_n": pa.int32()}


def _blocks(byte_level: str, pieces: str, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides, block = _both(byte_level, pieces), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, raw, offsets in text_chunks(batch.column("text"), most_bytes):
                data = raw.tobytes()
                out = align_block([data[x:y] for x, y in zip(offsets, offsets[1:])], sides)
                columns = {"block": pa.array([block], pa.int64()), "doc_id": ids.slice(first, last - first)}
                columns |= {k: pa.array(v, _KINDS.get(k, pa.int64())) for k, v in out.items()}
                arrays = [v if k == "block" else pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in columns.items()]
                yield pa.RecordBatch.from_arrays(arrays, list(columns))
                block += 1

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows per document from one block and the (count, is best) of its pairs, by their place in the block's list."""
    row = {name: blocks[name][0].values for name in blocks.column_names if name != "block"}
    docs, n, pair = len(row["doc_id"]), row["link_n"].to_numpy().astype(np.int64), row["link_pair"].to_numpy()
    place, (count, best) = answers["place"].to_numpy(), np.zeros((2, answers.num_rows), np.int64)
    count[place], best[place] = answers["count"].to_numpy(), answers["best"].to_numpy()
    own = {}
    for name, sums in (("n_links", n), ("n_best", n * best[pair]), ("count_sum", n * count[pair])):
        total = np.zeros(docs, np.int64)
        np.add.at(total, row["link_doc"].to_numpy(), sums)
        own[name] = pa.array(total)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.table([own[x] if x in own else row[x] for x in names], names)


def token_alignment(
    docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = 1 << 20
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_level`` is a vocabulary of the tokenizers library (side A) and ``pieces`` a sentencepiece model (side B); both are paths that all executors
    have. Special tokens in a text are plain text. ``n_links`` counts overlapping pairs of token occurrences, ``n_best`` those whose
    pair of ids is held linked by as many documents as any pair of that A id, ties included, ``count_sum`` sums the
    documents that hold each link's pair.

    A null or empty text, and one that a side does not give back byte by byte, has zeros and an empty digest. Every row is a document of its own, also
    when it repeats an id or has none. A text longer than a block is a block of its own and is encoded whole. An empty table gives an empty
    result; other columns are not read.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = stored(plain.mapInArrow(_blocks(byte_level, pieces, block_bytes), _BLOCK), "token-blocks", options=_FEW_BLOCKS)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "own"))
    listed = listed.select("block", "place", "own.pairs", "own.holders").withColumnsRenamed({"pairs": "pair", "holders": "held"})
    counts = listed.groupBy("pair").agg(F.sum("held").alias("count"))
    counts = stored(counts.withColumn("id", F.shiftright("pair", 32)), "pair-counts")
    highest = counts.groupBy(F.col("id").alias("of")).agg(F.max("count").alias("highest"))
    ranked = counts.join(highest, F.col("id") == F.col("of")).select(F.col("pair").alias("known"), "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = listed.select("block", "place", "pair").join(ranked, F.col("pair") == F.col("known"))
    answers = answers.select(F.col("block").alias("of"), "place", "count", "best")
    told = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "link_doc", "link_pair", "link_n")
    return told.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_finish, _RESULT)
