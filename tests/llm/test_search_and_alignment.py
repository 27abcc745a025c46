import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import rows
from odd_docs import make_docs, odd  # noqa: F401

from tidemark.llm.common import stored
from tidemark.llm.lexical_search import automaton_of, ranked_search, scan
from tidemark.llm.token_alignment import ByteLevel, Pieces, Sides, stretches, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, top=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, bag, bag.total()) for d, bag in bags if bag]
    held = Counter(t for _, bag, _ in bags for t in bag)
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, bag in asked.items():
        scored = []
        for doc, own, n in bags:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 12 * m))
                for t, r in bag.items() if own[t]
            )
            if score:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if empty else doc, -score) for rank, (score, empty, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


@pytest.fixture()
def corpus(odd):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve", "x1", "x", "1"]
    texts = [(100 + i, rng.choice((" ", "-", "\n", "_"))  .join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(150)]
    return [*odd, *texts, (900, "x1x x1 1x x"), (901, "X1,X;x"), (902, "Über über")]


ITEMS = [("a", "w1 w2 W2 w3"), ("b", "x1 x 1"), ("c", "Über über one"), ("d", None), ("e", " .,;"), ("f", "nowhere"), ("a", "word w4"), (None, "two three")]


def test_search_equals_plain(spark, make_docs, corpus):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id string, text string, code int")
    want = plain_search(corpus, ITEMS)
    assert {r[0] for r in want} == {"a", "b", "c", None} and max(r[1] for r in want) == 20
    got = ranked_search(make_docs(corpus), items)
    assert rows(got, "item_id", "rank", "doc_id", "score") == want
    # Several blocks of items, and fewer places than ties.
    assert rows(ranked_search(make_docs(corpus), items, block_terms=3), "item_id", "rank", "doc_id", "score") == want
    assert rows(ranked_search(make_docs(corpus), items, top=3), "item_id", "rank", "doc_id", "score") == plain_search(corpus, ITEMS, 3)


def test_search_of_empty_tables(spark, make_docs, corpus):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert ranked_search(make_docs(corpus).limit(0), items).count() == 0
    assert ranked_search(make_docs(corpus), items.limit(0)).count() == 0
    assert ranked_search(make_docs([(1, None), (2, "...")]), items).count() == 0


def test_scan_of_a_text_longer_than_its_slices():
    rng = random.Random(2)
    words = ["alpha", "be", "c", "delta" * 10]
    text = " ".join(rng.choices(words, k=300_000)) + " " + "y" * 2_500_000 + " alpha"
    raw = np.frombuffer(text.encode(), np.uint8)
    lengths, row, code, tf = scan(automaton_of(["alpha", "c", "none"]), 3, raw, np.array([0, len(raw)]))
    want = Counter(text.split())
    assert lengths.tolist() == [300_002] and dict(zip(code.tolist(), tf.tolist())) == {0: want["alpha"], 1: want["c"]}
    assert row.tolist() == [0, 0]


def plain_alignment(pairs):
    a, b = ByteLevel(A), Pieces(B)
    docs, held = [], Counter()
    for doc, text in pairs:
        whole = (" " + (text or "")).encode()
        ids = (a.encode([text])[0], b.encode([text])[0]) if text else ([], [])
        if any(b"".join(s.pieces[i] for i in own) != whole for s, own in zip((a, b), ids)):
            ids = ([], [])
        spans = []
        for side, own in zip((a, b), ids):
            at, out = 0, []
            for i in own:
                out.append((at, at + len(side.pieces[i]), i))
                at = out[-1][1]
            spans.append(out)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]] if len(whole) < 5000 else None
        groups, left = [], [list(s) for s in spans]
        for cut in sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]}):
            own = [[s[2] for s in side if s[1] <= cut] for side in left]
            left = [[s for s in side if s[1] > cut] for side in left]
            groups.append("|".join(",".join(map(str, o)) for o in own))
        docs.append((doc, spans, links, groups))
        held.update(set(links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return sorted(
        (
            (
                doc, len(spans[0]), len(spans[1]), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                sum(held[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc, spans, links, groups in docs
        ),
        key=repr,
    )


STRANGE = [
    "plain words, and more words.", "<|endoftext|> and <s> </s> <unk> <0x0A>", "tabs\tand\n\nlines  of   blanks", " leading", "trailing ",
    "naïve Übermut 東京 \U0001f600\U0001f468‍\U0001f469", "a▁b", "é ﬁ  ", "\u0000 nul", "12345678901234567890", "don't I'll we've",
]


def test_alignment_equals_plain(spark, make_docs, odd):
    rng = random.Random(7)
    words = "the of data table Stream über shuffle 2024 I'm re-read antidisestablishmentarianism x_y".split()
    pairs = [p if len(p[1] or "") < 1000 else (p[0], "word " * 500) for p in odd]
    pairs += list(enumerate(STRANGE, 20)) + [(50 + i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(60)]
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = plain_alignment(pairs)
    assert any(r[1] == 0 and r[0] == 26 for r in want) and any(r[3] < min(r[1], r[2]) for r in want)
    assert rows(token_alignment(make_docs(pairs), A, B), *columns) == want
    assert rows(token_alignment(make_docs(pairs), A, B, block_bytes=64), *columns) == want  # many blocks
    assert token_alignment(make_docs(pairs).limit(0), A, B).count() == 0


def test_stretches_encode_as_the_whole_text():
    a, b = ByteLevel(A), Pieces(B)
    sides = Sides(a, b, most=50)
    rng = random.Random(1)
    signs = ["word", "don't", "x,", "é", "東", "\u00a0", "\u3000", "\u2003", "\u200b", "\n", "\t", "", "", "\x00", "\x85", "\x7f", "▁", "ǅ.", "\U0001f600", "\ufeff"]
    for _ in range(60):
        texts = [" ".join(rng.choices(signs, k=rng.randrange(1, 12))) for _ in range(rng.randrange(1, 6))]
        some, per = stretches([t.encode() for t in texts])
        assert sum(per) == len(some)
        for side, frame in zip((a, b), sides.encode([t.encode() for t in texts])):
            for i, t in enumerate(texts):
                got = frame[frame.doc == i]
                ids = [side.encode([t])[0] for side in (a, b)] if t else [[], []]
                whole = (" " + t).encode()
                same = all(b"".join(s.pieces[x] for x in own) == whole for s, own in zip((a, b), ids))
                assert got["id"].tolist() == (side.encode([t])[0] if t and same else [])
                base = sum(len(x.encode()) + 1 for x in texts[:i])
                assert not len(got) or (got["start"].iloc[0] == base and got["end"].iloc[-1] == base + len(whole))
    assert len(stretches([b"one two", b"", b"a  b c"])[0]) == 5 and stretches([b"one two", b"", b"a  b c"])[1].tolist() == [2, 1, 2]


def test_alignment_of_a_long_text(make_docs):
    text = "A longer text, with words und Wörter. " * 40_000
    got = token_alignment(make_docs([(1, text), (2, None), (3, text)]), A, B).orderBy("doc_id").collect()
    assert got[0].n_a > 300_000 and got[0].n_links >= max(got[0].n_a, got[0].n_b) and got[0][1:] == got[2][1:]
    assert got[1][1:] == (0, 0, 0, 0, 0, 0, "")
    assert got[0].count_sum == 2 * got[0].n_links


def test_blocks_lie_in_small_row_groups(spark, make_docs, monkeypatch):
    """A reader takes the rows of a group at once, so a group must not grow with the blocks that a task makes."""
    links = "transform(sequence(1, 100000), x -> xxhash64(x, id)) AS link_pair"  # nearly a megabyte each
    large, groups = spark.range(24).coalesce(1).selectExpr("id AS block", links), []

    def kept(df, label, *args, **more):
        if label == "token-blocks":
            for f in stored(large, label, *args, **more).inputFiles():
                meta = pq.ParquetFile(f.removeprefix("file:")).metadata
                groups.extend(meta.row_group(i) for i in range(meta.num_row_groups))
        return stored(df, label, *args, **more)

    monkeypatch.setattr("tidemark.llm.token_alignment.stored", kept)
    result = token_alignment(make_docs([(1, "a few words"), (2, "a few more")]), A, B)
    assert sum(g.num_rows for g in groups) == 24 and max(g.total_byte_size for g in groups) < 8 << 20
    assert "collect_list" not in result._jdf.queryExecution().toString()  # nor are the answers of a block gathered on the heap
