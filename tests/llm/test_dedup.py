import hashlib
import random
import re

import numpy as np
from conftest import rows
from odd_docs import make_docs, odd  # noqa: F401

from tidemark.llm import components as link_steps
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import drop_exact_copies, exact_dedup
from tidemark.llm.near_dedup import drop_near_copies, index_keys, near_duplicates


def plain_exact(pairs):
    groups = {}
    for i, (doc_id, text) in enumerate(pairs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for key, own in groups.items():
        best = min(own)
        for _, no_id, doc_id, i in own:
            out.append((pairs[i][0], pairs[best[3]][0], len(own), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_equals_plain(make_docs, odd):
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    for top, tracked in ((1, 10), (1000, 10_000)):
        got = exact_dedup(make_docs(odd), top=top, tracked=tracked)
        assert rows(got, *columns) == plain_exact(odd)
        kept = [r.text_sha256 for r in got.filter("kept").collect()]
        assert len(kept) == len(set(kept)) == len({r[3] for r in plain_exact(odd)})


def test_heavy_copies_and_empty_table(make_docs):
    pairs = [(i, "same text here" if i % 3 else f"text {i}") for i in range(900)]
    got = exact_dedup(make_docs(pairs))
    assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == plain_exact(pairs)
    assert got.filter("kept").count() == 301
    assert exact_dedup(make_docs(pairs).limit(0)).count() == 0
    assert near_duplicates(make_docs(pairs).limit(0)).count() == 0


def test_dropped_copies_keep_columns(make_docs, odd):
    docs = make_docs(odd)
    for drop in (drop_exact_copies, drop_near_copies):
        out = drop(docs)
        assert out.dtypes == docs.dtypes
        ids = [r.doc_id for r in out.collect()]
        assert ids.count(5) <= 1 and 7 in ids and 6 in ids and ids.count(None) == 2


def test_repeated_row_stays_once(make_docs):
    docs = make_docs([(1, "a b c d e f"), (1, "a b c d e f"), (2, "q")])
    assert sorted(r.doc_id for r in drop_exact_copies(docs).collect()) == [1, 2]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(pairs, percent=85):
    sets, root = [shingles(t) for _, t in pairs], list(range(len(pairs)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(pairs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = pairs[i][0] == pairs[j][0] is not None
            if pairs[i][0] is None or pairs[j][0] is None or not a or not b:
                continue
            if same or 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(pairs):
        ids = [pairs[j][0] for j in range(len(pairs)) if find(j) == find(i)]
        out.append((doc_id, len(sets[i]), None if doc_id is None else min(ids)))
    return sorted(out, key=repr)


def test_near_duplicates_equal_plain(make_docs, odd):
    rng = random.Random(3)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    pairs = list(odd)
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        pairs.append((100 + i, " ".join(words)))
    pairs += [(300 + i, " ".join(f"u{rng.randrange(5000)}" for _ in range(60))) for i in range(60)]
    got = near_duplicates(make_docs(pairs))
    assert rows(got, "doc_id", "n_shingles", "component_id") == plain_near(pairs)
    # Clusters cut into many blocks take several rounds and give the same classes.
    cut = near_duplicates(make_docs(pairs), block_shingles=1500)
    assert rows(cut, "doc_id", "component_id") == rows(got, "doc_id", "component_id")
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got.collect())


def test_keys_meet_within_the_guaranteed_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << 32, 65, dtype=np.uint32)
        b = a.copy()
        b[rng.choice(65, 25, replace=False)] ^= 1
        assert set(index_keys(a, 13, 5, 1)) & set(index_keys(b, 13, 5, 1))
        c = rng.integers(0, 1 << 32, 65, dtype=np.uint32)
        assert not set(index_keys(a, 13, 5, 1)) & set(index_keys(c, 13, 5, 1))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(100, 101), (7, 7)]
    got = dict((r.node, r.component) for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_components_write_little(spark, monkeypatch):
    """Links that lie together need no round, and stars end without one; apart, or a few at a time, they need rounds and come to the same."""
    written = []
    monkeypatch.setattr(link_steps, "stored", lambda df, label, f=link_steps.stored: written.append(label) or f(df, label))
    chance = random.Random(5)
    links = [(chance.randrange(4000), chance.randrange(4000)) for _ in range(2400)] + [(5000 + i, 5001 + i) for i in range(300)] + [(9, 9), (None, 3)]
    root = list(range(5301))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in links:
        if x is not None and top(x) != top(y):
            root[max(top(x), top(y))] = min(top(x), top(y))
    expected = sorted((i, top(i)) for i in range(len(root)) if top(i) != i)
    table = spark.createDataFrame(links, "x long, y long")
    assert rows(components(table.coalesce(1), "x", "y")) == sorted(expected, key=repr)
    assert len(written) == 4
    for most in (7, 1000):
        assert rows(components(table.repartition(16), "x", "y", most=most)) == sorted(expected, key=repr)
