"""Katz back-off language model of any order, with Good-Turing discounts by order and exactly normalised weights.

    P(w)     = (c(w) + 1) / (N + V + 1), one share of it for all unknown words
    P(w | h) = d(c) * c(h, w) / c(h)   when c = c(h, w) > 0, with the Good-Turing discount d(c) of the order for c <= ``cutoff``
             = alpha(h) * P(w | h')    otherwise, where h' is h without its first word
    alpha(h) = (1 - sum of d * c / c(h) over seen w) / (1 - sum of P(w | h') over seen w)

The recursion is folded from the unigrams up: a block that knows P(w | h') of its n-grams asks for the next order. The words before
a document are start marks.

A history whose counts are all undiscounted divides by c(h) + 1 instead, which leaves mass to back off with; an unknown history has alpha 1.

Documents are read once, in blocks of a few MB that hold the distinct words of the block, their training counts and the documents as indices
into these words. What a block needs from the corpus it asks for by hash buckets: its distinct words, then its distinct word pairs. So the
exchanges carry a row per block and bucket and grow with the distinct words and pairs of blocks, not with documents times buckets. Pairs of
a history with a large share of all tokens are spread over several sub-buckets. Counts are kept in tables partitioned by kind: words (with
answers per block), pairs (the model), longer n-grams (a table for every order) and back-off weights. Arrays travel as compressed bytes.

Disk is what limits the job, so little lies there at a time. Blocks meet their answers slice by slice, and n-grams are counted pass by pass, each
over a share of the buckets of histories; every step is written before the next, its shuffle files go when it ends, and tables go after their last use.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Steps, held_out, ship
from tidemark.llm.words import WHITE, mix, rows_of_words, text_chunks

START, END = np.uint64(2), np.uint64(1)  # not the hash of a word but for a chance of 2**-63
_BLOCK = "block string, doc_ids array<long>, held array<boolean>, ends array<long>, words binary, counts binary, stream binary"
_CHAIN = np.uint64(0xD6E8FEB86659FD93)
_ASK = "bucket int, sub int, block string, a binary, b binary, c binary, d binary"
_NAMES = [x.split()[0] for x in _ASK.split(", ")]
_STATE = "block string, doc_ids array<long>, held array<boolean>, ends array<long>, words binary, stream binary, answers array<binary>"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_SLICES, _PASSES = 4, 2  # shares in which blocks meet their answers, and in which n-grams are counted


_CODEC = pa.Codec("zstd", compression_level=3)
_KINDS = {b"u": np.uint32, b"U": np.uint64, b"i": np.int32, b"I": np.int64, b"d": np.float64, b"b": np.uint8}
_CODES = {np.dtype(t): c for c, t in _KINDS.items()}


def pack(values: np.ndarray) -> bytes:
    """Integers or floats as compressed bytes: a byte for the type, the size, and the values with their first bytes together, then the second ones."""
    if values.dtype.kind in "iu" and values.dtype.itemsize > 4 and (not len(values) or int(values.max()) < 1 << 32):
        values = values.astype(np.uint32)
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T)
    return _CODES[values.dtype] + planes.size.to_bytes(8, "little") + _CODEC.compress(planes.ravel(), asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    kind, size = np.dtype(_KINDS[data[:1]]), int.from_bytes(data[1:9], "little")
    if not size:
        return np.empty(0, kind)
    planes = np.frombuffer(_CODEC.decompress(data[9:], size, asbytes=True), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending integers of 64 bits, by their differences."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).astype(np.uint64), dtype=np.uint64)


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


_ASK_KINDS = [pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 4]


def _asks(rows: list[tuple]) -> pa.RecordBatch:
    return _table(rows, _NAMES, _ASK_KINDS)


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket that grows with the hash, so sorted words lie in runs of buckets."""
    return ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place, whichever, of every distinct key in ascending order, and per place the number of its key. Faster than np.unique, which looks for first places.

    Where a key and its place fit into 63 bits they are sorted as one number, which takes a fraction of an argsort.
    """
    bits = len(keys).bit_length()
    if len(keys) and keys.dtype == np.int64 and int(keys.min()) >= 0 and int(keys.max()) >> (63 - bits) == 0:
        ordered = np.sort(keys << bits | np.arange(len(keys)))
        order = ordered & ((1 << bits) - 1)
        ordered >>= bits
    else:
        order = np.argsort(keys)
        ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    ids = np.empty(len(keys), np.int64)
    ids[order] = np.cumsum(new) - 1
    return order[new], ids


def _by_part(bucket: np.ndarray, sub: np.ndarray) -> np.ndarray:
    """The stable order by bucket and sub-bucket of rows in ascending order of buckets; only buckets that hold a spread history are sorted."""
    order = np.arange(len(bucket))
    if sub.any():
        spread = np.zeros(int(bucket[-1]) + 1, bool)
        spread[bucket[sub > 0]] = True
        places = np.flatnonzero(spread[bucket])
        order[places] = places[np.lexsort((sub[places], bucket[places]))]
    return order


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for first, last, raw, offsets in text_chunks(batch.column("text"), block_bytes):
                h, starts = rows_of_words(raw, offsets, WHITE)
                tokens = np.insert(h, starts[1:], END)  # an end after every document
                ends = starts[1:] + np.arange(1, len(starts))
                words, stream = np.unique(np.append(tokens, START), return_inverse=True)
                stream = stream[:-1]
                own = np.repeat(~held[first:last], np.diff(ends, prepend=0))
                counts = np.bincount(stream[own], minlength=len(words))
                counts[np.searchsorted(words, START)] = (~held[first:last]).sum()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{task}-{made}"]),
                        pa.array([batch.column("doc_id").slice(first, last - first).to_pylist()], pa.list_(pa.int64())),
                        pa.array([held[first:last]], pa.list_(pa.bool_())),
                        pa.array([ends], pa.list_(pa.int64())),
                        *(pa.array([pack(x)], pa.binary()) for x in (words, counts, stream)),
                    ],
                    ["block", "doc_ids", "held", "ends", "words", "counts", "stream"],
                )
                made += 1

    return run


def _ask_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "counts"))):
                words, counts = unpack(words), unpack(counts)
                bucket = word_bucket(words, buckets)
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(words)]))
                yield _asks([(int(bucket[i]), 0, block, pack(words[i:j]), pack(counts[i:j]), None, None) for i, j in zip(cuts, cuts[1:]) if j > i])

    return run


def _count_words(group: pa.Table) -> pa.Table:
    """Per block the bucket's ids and totals of its words; and one row without a block: tokens and distinct words in training."""
    lists = [unpack(x) for x in group.column("a").to_pylist()]
    counts = np.concatenate([unpack(x) for x in group.column("b").to_pylist()])
    words, ids = np.unique(np.concatenate(lists), return_inverse=True)
    totals = np.bincount(ids, counts, len(words)).astype(np.int64)
    bucket, out, at = group.column("bucket")[0].as_py(), [], 0
    for block, own in zip(group.column("block").to_pylist(), lists):
        mine = ids[at : at + len(own)]
        at += len(own)
        out.append((bucket, 0, block, pack(mine), pack(totals[mine]), None, None))
    real = totals[words != START]
    out.append((bucket, 0, None, None, None, pack(np.array([real.sum()])), pack(np.array([(real > 0).sum()]))))
    return pa.Table.from_batches([_asks(out)])


def _by_bucket(answers: list[dict], kind: str) -> list[dict]:
    rows = [r for r in answers if r["kind"] == kind]
    return sorted(rows, key=lambda r: (r["bucket"], r["sub"]))


def _joined(rows: list[dict], column: str) -> np.ndarray:
    return np.concatenate([unpack(r[column]) for r in rows]) if rows else np.empty(0, np.int64)


def _seen_log(count: np.ndarray, history: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """log10 of the probability of n-grams that occur in training."""
    return np.log10(np.maximum(factors[np.where(count < len(factors), count, 0)] * count, 1e-300) / history)


class Block:
    """A block's words with their corpus counts, and its distinct pairs in the order in which they are asked for."""

    def __init__(self, row: dict, ids: np.ndarray, counts: np.ndarray, buckets: int, tokens: int) -> None:
        self.words, self.stream = unpack(row["words"]), unpack(row["stream"]).astype(np.int64)
        self.ids, self.counts = ids.astype(np.int64), counts.astype(np.int64)
        self.held, self.ends = np.array(row["held"], bool), np.array(row["ends"], np.int64)
        self.doc_ids = row["doc_ids"]
        before = np.empty_like(self.stream)
        before[1:] = self.stream[:-1]
        before[np.concatenate(([0], self.ends[:-1]))] = np.searchsorted(self.words, START)
        n = len(self.words)
        first, place = _distinct(before * n + self.stream)
        left, right = before[first], self.stream[first]
        self.before, self.bucket = before, word_bucket(self.words, buckets)
        # A history with more than half a bucket's share of the tokens is spread by its successors.
        spread = np.minimum(self.counts * buckets * 2 // max(tokens, 1), 1 << 16)[left]
        sub = np.zeros(len(left), np.int64)
        hot = np.flatnonzero(spread)
        sub[hot] = 1 + (self.words[right[hot]] % spread[hot].astype(np.uint64)).astype(np.int64)
        order = _by_part(self.bucket[left], sub)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        self.left, self.right, self.sub, self.pair = left[order], right[order], sub[order], back[place]

    def asks(self, name: str) -> pa.RecordBatch:
        own = np.repeat(~self.held, np.diff(self.ends, prepend=0))
        counts = np.bincount(self.pair[own], minlength=len(self.left))
        bucket = self.bucket[self.left]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket) | np.diff(self.sub)) + 1, [len(bucket)]))
        gid = self.bucket << 32 | self.ids
        rows = []
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                left, right = self.left[i:j], self.right[i:j]
                rows.append((int(bucket[i]), int(self.sub[i]), name, *map(pack, (self.ids[left], gid[right], counts[i:j], self.counts[right]))))
        return _asks(rows)

    def by_pair(self, alpha: np.ndarray, more: np.ndarray, pair: np.ndarray, whole: int, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct pair: its training count, what a seen one is divided by, and log10 of its probability."""
        pair = pair.astype(np.int64)
        history = np.maximum(self.counts + more, 1)[self.left]
        single = np.log10((self.counts + 1) / whole)
        return pair, history, np.where(pair > 0, _seen_log(pair, history, factors), alpha[self.left] + single[self.right])


class Grams:
    """A block's distinct n-grams of one order whose history occurs in training, in the order in which they are asked for.

    ``count``, ``history`` and ``log`` are the training count, what it is divided by and the log10 probability of the n-gram one shorter that ends
    at each position. With ``turn`` only the buckets of this pass count.
    """

    def __init__(
        self, block: Block, order: int, count: np.ndarray, history: np.ndarray, log: np.ndarray, buckets: int, tokens: int, turn: int | None = None
    ) -> None:
        starts, at_start = np.concatenate(([0], block.ends[:-1])), START
        words = block.words[block.stream]
        hist, number, start = block.words[block.before], block.before, np.searchsorted(block.words, START)
        with np.errstate(over="ignore"):
            for _ in range(order - 2):
                earlier = np.roll(hist, 1)
                earlier[starts] = at_start
                before = np.roll(number, 1)
                before[starts] = start
                known, number = _distinct(before * len(block.words) + block.before)
                start = len(known)
                hist = mix(earlier * _CHAIN + block.words[block.before])
                at_start = mix(np.array([at_start]) * _CHAIN + START)[0]
        places = np.arange(len(hist)) if turn is None else np.flatnonzero(word_bucket(hist, buckets) % _PASSES == turn)
        # Histories are numbered in ascending order of their hashes, so sorted n-grams lie in runs of histories and of buckets.
        ranks = np.empty(len(known), np.int64)
        ranks[np.argsort(hist[known])] = np.arange(len(known))
        number = ranks[number]
        first, self.place = _distinct(number[places] * len(block.words) + block.stream[places])
        first = places[first]
        # A history is the n-gram one shorter that ends before the word; before the first word it is that of every document.
        seen = np.roll(count, 1)
        seen[starts] = block.counts[np.searchsorted(block.words, START)]
        seen, hist, words = seen[first], hist[first], words[first]
        own = np.repeat(~block.held, np.diff(block.ends, prepend=0))[places]
        counts = np.bincount(self.place[own], minlength=len(first))
        self.lower, self.below, self.divisor = log[first], count[first], history[first]
        bucket = word_bucket(hist, buckets)
        spread = np.minimum(seen * buckets * 2 // max(tokens, 1), 1 << 16)
        sub = np.zeros(len(first), np.int64)
        hot = np.flatnonzero(spread)
        sub[hot] = 1 + (words[hot] % spread[hot].astype(np.uint64)).astype(np.int64)
        asked = _by_part(bucket, sub)
        self.asked = asked = asked[seen[asked] > 0]  # an unknown history has no n-grams
        gid = block.bucket << 32 | block.ids
        self.bucket, self.sub, self.hist, self.seen = bucket[asked], sub[asked], hist[asked], seen[asked]
        self.right, self.counts = gid[block.stream[first]][asked], counts[asked]

    def asks(self, name: str) -> pa.RecordBatch:
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(self.bucket) | np.diff(self.sub)) + 1, [len(self.bucket)]))
        rows, below, divisor = [], self.below[self.asked], self.divisor[self.asked]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                learned = self.counts[i:j] > 0  # so the n-gram one shorter occurs too; what its probability is made of travels as integers
                of_lower = pack(np.concatenate((below[i:j][learned], divisor[i:j][learned])))
                rows.append((int(self.bucket[i]), int(self.sub[i]), name, pack_sorted(self.hist[i:j]), *map(pack, (self.right[i:j], self.counts[i:j])), of_lower))
        return _asks(rows)

    def answered(
        self, total: np.ndarray, more: np.ndarray, alpha_weighed: np.ndarray, more_weighed: np.ndarray, factors: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per position, of the n-gram that ends there: the training count, what it is divided by, and log10 of the probability."""
        total, more = total.astype(np.int64), more.astype(np.int64)
        weighed = (self.sub > 0) | (total == 0)
        alpha = np.zeros(len(total))
        alpha[weighed], more[weighed] = alpha_weighed, more_weighed
        count, history, log = np.zeros(len(self.lower), np.int64), np.ones(len(self.lower), np.int64), self.lower.copy()
        count[self.asked], history[self.asked] = total, self.seen + more
        log[self.asked] = np.where(total > 0, _seen_log(total, self.seen + more, factors), alpha + self.lower[self.asked])
        return count[self.place], history[self.place], log[self.place]


#: The answers that a block keeps, by order: kinds and their columns. Kinds of longer n-grams end in the order.
_PAIR_ANSWERS = [("word", "a"), ("word", "b"), ("weight", "a"), ("weight", "b"), ("pair", "a")]


def _kinds(order: int) -> list[tuple[str, str]]:
    return _PAIR_ANSWERS if order == 2 else [(f"{kind}{order}", column) for kind in ("gram", "weight") for column in "ab"]


def _gathered_rows(left: pa.Table, right: pa.Table, order: int) -> list[dict]:
    """The block with the answers of this order after those that it has."""
    answers = right.to_pylist()
    own = [pack(_joined(_by_bucket(answers, kind), column)) for kind, column in _kinds(order)]
    return [row | {"answers": [*(row["answers"] or []), *own]} for row in left.to_pylist()]


def _gathered(order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.binary())]
        names = ["block", "doc_ids", "held", "ends", "words", "stream", "answers"]
        return pa.Table.from_batches([_table([tuple(r[n] for n in names) for r in _gathered_rows(left, right, order)], names, kinds)])

    return run


def _folded(row: dict, factors: list[np.ndarray], buckets: int, tokens: int, whole: int) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
    """The block; and by position counts, what they are divided by and log10 probabilities, of the highest order that ``factors`` (from order 2 on) has."""
    ids, counts, *answers = map(unpack, row["answers"])
    block = Block(row, ids, counts, buckets, tokens)
    count, history, log = (x[block.pair] for x in block.by_pair(*answers[:3], whole, factors[0]))
    for order, own in enumerate(factors[1:], 3):
        at = 3 + 4 * (order - 3)
        count, history, log = Grams(block, order, count, history, log, buckets, tokens).answered(*answers[at : at + 4], own)
    return block, count, history, log


def _ask_grams(buckets: int, tokens: int, whole: int, factors: list[np.ndarray], turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, *lower = _folded(row, factors, buckets, tokens, whole)
                yield Grams(block, len(factors) + 2, *lower, buckets, tokens, turn).asks(row["block"])

    return run


def _count_grams(cutoff: int, factors: np.ndarray):
    """Per block the totals of its n-grams, whether their history divides by one more, and the histories whose weight it needs (kind gram);
    and the counts of counts, with the n-grams of these histories: history, probability one order below, count (kind model).

    A history that is spread over groups needs its weight everywhere. ``factors`` are those of the order below.
    """

    def run(group: pa.Table) -> pa.Table:
        lists = [[read(x) for x in group.column(c).to_pylist()] for c, read in zip("abc", (unpack_sorted, unpack, unpack))]
        sizes = [len(x) for x in lists[0]]
        hist, right, counts = map(np.concatenate, lists)
        parts = [unpack(x).astype(np.int64) for x in group.column("d").to_pylist()]
        lower = _seen_log(*(np.concatenate(x) for x in zip(*(np.split(p, 2) for p in parts))), factors)
        del lists, parts
        counts = counts.astype(np.int64)
        with np.errstate(over="ignore"):
            first, ids = _distinct(mix(hist * _CHAIN + right.astype(np.uint64)))
        totals = np.bincount(ids, counts, len(first)).astype(np.int64)
        below = np.zeros(len(first))
        below[ids[counts > 0]] = lower
        names, of = np.unique(hist[first], return_inverse=True)
        seen = totals > 0
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, of[seen], totals[seen])
        bucket, sub = group.column("bucket")[0].as_py(), group.column("sub")[0].as_py()
        weighed = ~seen | (sub > 0)
        wanted = np.zeros(len(names), bool)
        wanted[of[weighed]] = True
        out, at = [], 0
        for block, n in zip(group.column("block").to_pylist(), sizes):
            mine = ids[at : at + n]
            at += n
            needs = names[of[mine[weighed[mine]]]]
            out.append((bucket, sub, block, *map(pack, (totals[mine], (least[of[mine]] > cutoff).astype(np.uint8))), pack_sorted(needs), None))
        kept = seen & wanted[of]
        low = np.bincount(totals[totals <= cutoff + 1], minlength=cutoff + 2)
        out.append((bucket, sub, None, *map(pack, (names[of[kept]], below[kept], totals[kept], low))))
        return pa.Table.from_batches([_asks(out)])

    return run


def _gram_weights(factors: np.ndarray):
    def run(model: pa.Table, answers: pa.Table) -> pa.Table:
        """Per block and weighed n-gram: log10 of the back-off weight of its history, and whether the history divides by one more."""
        hist, below, totals = ([unpack(x) for x in model.column(c).to_pylist()] for c in "abc")
        none = [np.empty(0, np.int64)]
        names, of = np.unique(np.concatenate([*(x.astype(np.uint64) for x in hist), np.empty(0, np.uint64)]), return_inverse=True)
        totals = np.concatenate([*none, *totals]).astype(np.int64)
        count = np.bincount(of, totals, len(names))
        kept = np.bincount(of, factors[np.where(totals < len(factors), totals, 0)] * totals, len(names))
        seen = np.bincount(of, 10 ** np.concatenate([*none, *below]), len(names))
        more = kept > count - 1e-9
        alpha = np.log10((1 - kept / np.maximum(count + more, 1)) / (1 - seen))
        out = []
        for row in answers.select(["bucket", "sub", "block", "c"]).to_pylist():
            at = np.searchsorted(names, unpack_sorted(row["c"]))
            out.append((row["bucket"], row["sub"], row["block"], pack(alpha[at]), pack(more[at].astype(np.uint8)), None, None))
        return pa.Table.from_batches([_asks(out)])

    return run


def _ask_pairs(buckets: int, tokens: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words = _by_bucket(right.to_pylist(), "word")
        ids, counts = _joined(words, "a"), _joined(words, "b")
        return pa.Table.from_batches([Block(r, ids, counts, buckets, tokens).asks(r["block"]) for r in left.to_pylist()] or [_asks([])])

    return run


def _count_pairs(group: pa.Table) -> pa.Table:
    """Per block the totals of its pairs (kind pair); and the pairs of the training text (kind model): history, word, count, count of the word."""
    left, right, counts, of_right = ([unpack(x) for x in group.column(c).to_pylist()] for c in "abcd")
    sizes = [len(x) for x in left]
    left, right, counts, of_right = (np.concatenate(x).astype(np.int64) for x in (left, right, counts, of_right))
    names, code = np.unique(right, return_inverse=True)
    first, ids = _distinct(left * len(names) + code)
    totals = np.bincount(ids, counts, len(first)).astype(np.int64)
    bucket, sub = group.column("bucket")[0].as_py(), group.column("sub")[0].as_py()
    out, at = [], 0
    for block, n in zip(group.column("block").to_pylist(), sizes):
        out.append((bucket, sub, block, pack(totals[ids[at : at + n]]), None, None, None))
        at += n
    seen = totals > 0
    first = first[seen]
    out.append((bucket, sub, None, *map(pack, (left[first], right[first], totals[seen], of_right[first]))))
    return pa.Table.from_batches([_asks(out)])


def _counts_of_counts(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(most + 1, np.int64)
        for batch in batches:
            for data in batch.column("c").to_pylist():
                counts = unpack(data)
                sums += np.bincount(counts[counts <= most].astype(np.int64), minlength=most + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, most + 1)), pa.array(sums[1:])], ["r", "n"])

    return run


def good_turing(n: dict[int, int], cutoff: int) -> np.ndarray:
    """Discount factors by count, index 0 unused. Where the counts of counts give none between 0 and 1, half a count is taken off."""
    factors = np.ones(cutoff + 1)
    common = (cutoff + 1) * n.get(cutoff + 1, 0) / n[1] if n.get(1) else 0.0
    for r in range(1, cutoff + 1):
        if n.get(r) and n.get(1) and common < 1:
            factor = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - common) / (1 - common)
        else:
            factor = -1.0
        factors[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return factors


def _mass(factors: np.ndarray, whole: float):
    """Per model row and history: the discounted count and the unigram probability of its seen words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bucket, *data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "a", "c", "d"))):
                left, counts, of_right = (unpack(x).astype(np.int64) for x in data)
                ids, place = np.unique(left, return_inverse=True)
                kept = factors[np.where(counts < len(factors), counts, 0)] * counts
                rows.append((bucket, 0, None, pack(ids), pack(np.bincount(place, kept, len(ids))), pack(np.bincount(place, (of_right + 1) / whole, len(ids))), None))
            yield _asks(rows)

    return run


def _weights(mass: pa.Table, answers: pa.Table) -> pa.Table:
    """Per block and word of the bucket: log10 of the back-off weight, and whether the history divides by one more."""
    out, most = [], 0
    ids = [unpack(x).astype(np.int64) for x in answers.column("a").to_pylist()]
    for x in ids:
        most = max(most, int(x.max()) + 1)
    kept, seen = np.zeros(most), np.zeros(most)
    for row in mass.to_pylist():
        at = unpack(row["a"]).astype(np.int64)
        np.add.at(kept, at, unpack(row["b"]))
        np.add.at(seen, at, unpack(row["c"]))
    for row, own in zip(answers.select(["bucket", "block", "b"]).to_pylist(), ids):
        count = unpack(row["b"]).astype(np.int64)
        more = (kept[own] > count - 1e-9) & (count > 0)
        alpha = np.where(count > 0, (1 - kept[own] / np.maximum(count + more, 1)) / (1 - seen[own]), 1.0)
        out.append((row["bucket"], 0, row["block"], pack(np.log10(alpha)), pack(more.astype(np.uint8)), None, None))
    return pa.Table.from_batches([_asks(out)])


def _score(buckets: int, tokens: int, whole: int, factors: list[np.ndarray]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in _gathered_rows(left, right, len(factors) + 1):
            block, _, _, log = _folded(row, factors, buckets, tokens, whole)
            single = np.log10((block.counts + 1) / whole)
            starts = np.concatenate(([0], block.ends[:-1])).astype(np.int64)
            add = lambda x: np.add.reduceat(x, starts)
            known = add((block.counts[block.stream] > 0).astype(np.int64))
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.doc_ids, pa.int64()), pa.array(block.held), pa.array(np.diff(block.ends, prepend=0)), pa.array(known),
                        pa.array(add(single[block.stream])), pa.array(add(log)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )
            )
        return pa.Table.from_batches(out)

    return run


def katz_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 7, part: int = 2, cutoff: int = 5, block_bytes: int = 8 << 20,
    order: int = 2,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    ``order`` is the length of the longest n-grams, 2 at least. The model learns from documents whose crc32 of the id modulo ``parts`` is not ``part``. Null and empty texts are the end token alone.
    Repeated rows and null ids (never held out) count like any other row. Without training documents every probability is that of an unknown word.
    """
    if order < 2:
        raise ValueError("order must be 2 at least")
    spark = docs.sparkSession
    ship(spark)
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id, parts, part).alias("held"), F.col(text).alias("text"))
    steps = Steps(spark, "lm")
    share = F.pmod(F.hash("block"), F.lit(_SLICES))
    sliced = plain.mapInArrow(_blocks(block_bytes), _BLOCK).withColumn("slice", share)
    blocks = steps.write(sliced, "blocks", "slice")
    asked = blocks.select("block", "words", "counts").mapInArrow(_ask_words(buckets), _ASK)
    words = steps.write(asked.groupBy("bucket").applyInArrow(_count_words, _ASK), "words")
    tokens = distinct = 0
    totals = words.filter("block is null").select("c", "d").toArrow()  # one row per bucket
    for c, d in zip(totals.column("c").to_pylist(), totals.column("d").to_pylist()):
        tokens, distinct = tokens + int(unpack(c)[0]), distinct + int(unpack(d)[0])
    words, whole = words.filter("block is not null"), tokens + distinct + 1
    to_blocks = lambda df, kind: df.select(F.lit(kind).alias("kind"), "bucket", "sub", "block", "a", "b")
    asked = blocks.select("block", "ends", "held", "doc_ids", "words", "stream").groupBy("block").cogroup(to_blocks(words, "word").groupBy("block"))
    pairs = asked.applyInArrow(_ask_pairs(buckets, tokens), _ASK).groupBy("bucket", "sub").applyInArrow(_count_pairs, _ASK)
    pairs = steps.write(pairs.withColumn("kind", F.when(F.col("block").isNull(), "model").otherwise("pair")), "pairs", "kind")
    model = pairs.filter("kind = 'model'")
    rows = model.select("c").mapInArrow(_counts_of_counts(cutoff + 1), "r long, n long").groupBy("r").agg(F.sum("n").alias("n")).collect()
    factors = good_turing({r["r"]: r["n"] for r in rows}, cutoff)
    factors[0] = 1.0  # counts above the cutoff look here
    mass = model.select("bucket", "a", "c", "d").mapInArrow(_mass(factors, float(whole)), _ASK)
    weights = steps.write(mass.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(_weights, _ASK), "weights")
    steps.drop("pairs/kind=model")
    answers = to_blocks(words, "word").unionByName(to_blocks(weights, "weight")).unionByName(to_blocks(pairs.filter("kind = 'pair'"), "pair"))
    state = blocks.select("block", "doc_ids", "held", "ends", "words", "stream", F.lit(None).cast("array<binary>").alias("answers"), "slice")
    every, used = [factors], ["blocks", "words", "pairs", "weights"]

    def by_slice(n: int, label: str, work, schema: str) -> DataFrame:
        """Blocks with their answers of order ``n``, a slice after the other."""
        for i in range(_SLICES):
            left, right = state.filter(F.col("slice") == i).drop("slice"), answers.filter(share == i)
            steps.write_part(left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(work, schema), label, "slice", i)
        return steps.read_parts(label, schema, "slice int")

    for n in range(3, order + 1):
        state = by_slice(n - 1, f"state-{n}", _gathered(n - 1), _STATE)
        steps.drop(*used)
        for turn in range(_PASSES):
            asked = state.drop("slice").mapInArrow(_ask_grams(buckets, tokens, whole, every, turn), _ASK)
            grams = asked.groupBy("bucket", "sub").applyInArrow(_count_grams(cutoff, every[-1]), _ASK)
            steps.write_part(grams.withColumn("kind", F.when(F.col("block").isNull(), "model").otherwise("gram")), f"grams-{n}", "turn", turn, "kind")
        grams = steps.read_parts(f"grams-{n}", _ASK, "turn int, kind string")
        model, own = grams.filter("kind = 'model'"), grams.filter("kind = 'gram'")
        sums = np.zeros(cutoff + 2, np.int64)
        for d in model.select("d").toArrow().column("d").to_pylist():  # one row per bucket and part of a spread history
            sums += unpack(d).astype(np.int64)
        every = [*every, good_turing(dict(enumerate(sums.tolist())), cutoff)]
        every[-1][0] = 1.0
        needs = own.select("bucket", "sub", "block", "c")
        weights = model.select("bucket", "a", "b", "c").groupBy("bucket").cogroup(needs.groupBy("bucket")).applyInArrow(_gram_weights(every[-1]), _ASK)
        weights = steps.write(weights, f"weights-{n}")
        for turn in range(_PASSES):
            steps.drop(f"grams-{n}/turn={turn}/kind=model")
        answers = to_blocks(own, f"gram{n}").unionByName(to_blocks(weights, f"weight{n}"))
        used = [f"state-{n}", f"grams-{n}", f"weights-{n}"]
    scored = by_slice(order, "scores", _score(buckets, tokens, whole, every), _SCORES)
    steps.drop(*used)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
