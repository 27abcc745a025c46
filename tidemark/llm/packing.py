"""Best-fit packing of token sequences after a dominance reduction.

Tokenized documents are cut into pieces of at most ``capacity`` tokens; the pieces are stored. What is packed is the histogram of piece
lengths, at most ``capacity`` numbers whatever the corpus size, so the plan is made on the driver: a Martello-Toth reduction
fixes small sets that dominate all alternatives (a piece nothing fits beside, two pieces that fill a sequence, a pair no
other set can beat), and the rest is packed best-fit in order of decreasing length. The plan is a list of runs: "the pieces of
length L with ranks from A to B go into the sequences from S on, M in each, from offset O". Pieces get their rank within a length from the task
that made them and the counts of the tasks before it, so neither a frequent length nor a large source lands in one task.
"""

from __future__ import annotations

import bisect
import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, stored

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Words(dict):
    """Ids by stretch of text, as bytes; one that is missing is tokenized when it is asked for. Emptied at ``most`` stretches."""

    def __init__(self, tokenizer, most: int) -> None:
        super().__init__()
        self.tokenizer, self.model, self.most, self.letters = tokenizer, tokenizer.model, most, _byte_letters()

    def __missing__(self, s: str) -> bytes:
        core = s.rstrip(".,")
        if core != s and core[-1:].lower()[-1:].isalpha():
            ids = self[core] + self[s[len(core) :]]
        elif not s.isalpha():
            ids = self.whole(s)
        elif s.isascii():
            lower = s.lower()
            ids = self.merged(s) if lower == s else self[lower]
        elif s.islower() and max(s) < "\u0250" and s.lower() == s and unicodedata.is_normalized("NFC", s):
            ids = self.merged("".join(map(self.letters.get, s.encode())))
        else:
            ids = self.whole(s)
        if len(s) <= 64:
            if len(self) > self.most:
                self.clear()
            self[s] = ids
        return ids

    def merged(self, letters: str) -> bytes:
        return _as_bytes([t.id for t in self.model.tokenize(letters)])

    def whole(self, text: str) -> bytes:
        return _as_bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)


def _as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordCache:
    """Token ids of texts, with a bounded memory of words.

    For a lower-casing word-end vocabulary, whose tokens never span white space, text is split at blanks, tabs and line ends, and the ids
    of each distinct stretch are remembered as bytes. A full stop or comma after a letter is a token run of its own, so it is taken off first, and a
    lower-case Latin word goes to the merges at once, since the rules before them leave it as it is; one of A-Z and a-z counts as its lower-case form.
    Everything else, and every text of another kind of tokenizer, goes through the whole tokenizer.
    """

    def __init__(self, path: str, most: int = 700_000) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.known = _Words(tokenizer, most)
        rules = json.loads(tokenizer.to_str())
        kinds = [[r["type"] for r in (rules[k] or {}).get(v, ())] for k, v in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.by_word = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and rules["pre_tokenizer"]["pretokenizers"][0]["invert"]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.by_word:
            return self.known.whole(text)
        stretches = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.known.__getitem__, stretches))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return list(map(self.known.whole, texts))


_caches: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    """The cache of this Python worker, which Spark uses for many tasks."""
    if path not in _caches:
        _caches[path] = WordCache(path)
    return _caches[path]


def _pieces(tokenizer: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, part = _cache(tokenizer), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = cache.ids(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, int(ranks[n])))
                    ranks[n] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


class Plan:
    """Runs of a packing: (length, first_rank, last_rank, first_bin, per_bin, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.left = {n: c for n, c in counts.items() if c}
        self.sizes = sorted(self.left)
        self.given = dict.fromkeys(self.left, 0)
        self.capacity, self.bins, self.runs = capacity, 0, []

    def place(self, length: int, bins: int, per_bin: int, first_bin: int, offset: int) -> None:
        rank, n = self.given[length], bins * per_bin
        self.runs.append((length, rank, rank + n, first_bin, per_bin, offset))
        self.given[length] = rank + n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length], self.sizes[bisect.bisect_left(self.sizes, length)]

    def fix(self, *lengths: int, bins: int) -> None:
        """Close ``bins`` new sequences that hold these lengths each."""
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            per = lengths.count(n)
            self.place(n, bins, per, self.bins, offset)
            offset += n * per
        self.bins += bins

    def reduce(self) -> None:
        """Fix sets that dominate all others, from the longest piece down, until none does."""
        changed = True
        while changed:
            changed = False
            for longest in sorted(self.left, reverse=True):
                while longest in self.left and self._fix_one(longest):
                    changed = True

    def _fix_one(self, n: int) -> bool:
        """Fix sequences around pieces of length n if one set of them dominates.

        The same set is fixed as often as its pieces last: fewer other pieces only make fewer rivals.
        """
        room, have = self.capacity - n, self.left[n]
        small = self._smallest(n, 3)
        if not small or small[0] > room:  # nothing fits beside it
            self.fix(n, bins=have)
            return True
        at = bisect.bisect_right(self.sizes, room) - 1
        if self.sizes[at] == n and have == 1:
            at -= 1
        partner = self.sizes[at]
        # Two pieces that fill a sequence; or no two fit beside n; or two at most do, and none two weigh more than the partner.
        if not (
            partner == room
            or sum(small[:2]) > room
            or len(small) == 1
            or ((len(small) == 2 or sum(small) > room) and partner >= self._best_pair(n, at, room))
        ):
            return False
        self.fix(n, partner, bins=have // 2 if n == partner else min(have, self.left[partner]))
        return True

    def _smallest(self, n: int, most: int) -> list[int]:
        """The smallest pieces, one of length n left out."""
        out: list[int] = []
        for m in self.sizes[: most + 1]:
            out += [m] * min(most, self.left[m] - (m == n))
        return out[:most]

    def _best_pair(self, n: int, high: int, room: int) -> int:
        best, low = 0, 0
        while low <= high:
            a, b = self.sizes[low], self.sizes[high]
            if a + b > room:
                high -= 1
            else:
                if self.left[a] - (a == n) > (a == b) and self.left[b] - (b == n):
                    best = max(best, a + b)
                low += 1
        return best

    def best_fit(self) -> None:
        """Pack what is left, longest first, each piece where the least room remains."""
        open_bins: dict[int, list[tuple[int, int]]] = {}  # by room: (first bin, bins)
        rooms: list[int] = []

        def add(room: int, first: int, bins: int) -> None:
            if room and bins:
                if room not in open_bins:
                    bisect.insort(rooms, room)
                open_bins.setdefault(room, []).append((first, bins))

        for n in sorted(self.left, reverse=True):
            while n in self.left:
                at = bisect.bisect_left(rooms, n)
                if at < len(rooms):
                    room = rooms[at]
                    first, bins = open_bins[room].pop()
                    if not open_bins[room]:
                        del open_bins[room], rooms[at]
                else:
                    room, first, bins = self.capacity, self.bins, -(-self.left[n] // (self.capacity // n))
                    self.bins += bins
                per, offset = room // n, self.capacity - room
                whole = min(bins, self.left[n] // per)
                if whole:
                    self.place(n, whole, per, first, offset)
                    add(room - per * n, first, whole)
                if whole < bins and n in self.left:  # one sequence gets the last few
                    rest = self.left[n]
                    self.place(n, 1, rest, first + whole, offset)
                    add(room - rest * n, first + whole, 1)
                    whole += 1
                add(room, first + whole, bins - whole)


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs that place ``counts[length]`` pieces of every length. Lengths are from 1 to the capacity."""
    plan = Plan(counts, capacity)
    plan.reduce()
    plan.best_fit()
    return plan.runs


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; null counts as empty, so every row has a piece. Documents longer than the capacity
    are cut. Repeated rows and null ids are packed like any others. ``tokenizer`` is a path that all executors have.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(plain.mapInArrow(_pieces(tokenizer, end_id, capacity), _PIECES), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    runs = spark.createDataFrame(
        packing_plan(histogram, capacity), "length long, first_rank long, last_rank long, first_bin long, per_bin long, offset long"
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).withColumnRenamed("length", "own")
    placed = (
        spans.join(runs, (F.col("own") == F.col("length")) & (F.col("first_rank") < F.col("base") + F.col("n")) & (F.col("last_rank") > F.col("base")))
        .select(F.col("part").alias("p"), F.col("own").alias("l"), "base", "first_rank", "last_rank", "first_bin", "per_bin", F.col("offset").alias("from"))
    )
    rank = F.col("base") + F.col("rank")
    joined = pieces.join(
        placed, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")) & (rank >= F.col("first_rank")) & (rank < F.col("last_rank"))
    )
    step = rank - F.col("first_rank")
    return joined.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_bin") + F.floor(step / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("from") + F.col("length") * (step % F.col("per_bin"))).cast("long").alias("offset"),
    )
