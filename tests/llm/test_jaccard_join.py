import random
import re

import numpy as np
from conftest import rows
from odd_docs import make_docs, odd  # noqa: F401

from tidemark.llm.jaccard_join import Group, jaccard_join, prefix_length, shared_first


def sets_of(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_join(pairs, percent=85):
    sets, root = [sets_of(t) for _, t in pairs], list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if pairs[i][0] is None or pairs[j][0] is None or not a or not b:
                continue
            if pairs[i][0] == pairs[j][0] or 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        least[find(i)] = min(least.get(find(i), doc), doc) if doc is not None else None
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(pairs)), key=repr)


def changed(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
    return " ".join(words)


def test_join_equals_plain(make_docs, odd):
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    passages = [[f"p{k}_{i}" for i in range(60)] for k in range(3)]
    pairs = list(odd)
    pairs += [(100 + i, changed(rng, base, rng.choice([0, 1, 1, 2, 3, 4, 6]))) for i in range(200)]
    pairs += [(400 + i, " ".join(f"u{rng.randrange(5000)}" for _ in range(60))) for i in range(60)]
    # Passages that many documents share, alone and with much or little around them.
    for i in range(120):
        around = [f"a{rng.randrange(9000)}" for _ in range(rng.choice([0, 1, 4, 10, 60]))]
        pairs.append((600 + i, " ".join(around + rng.choice(passages) + rng.choice([[], passages[0]]))))
    pairs += [(900, changed(rng, base, 1)), (900, "quite another text here"), (901, "quite another text here"), (902, None), (902, changed(rng, base, 1))]
    want = plain_join(pairs)
    columns = ("doc_id", "n_shingles", "component_id")
    assert len({r[2] for r in want}) < len(want) - 150
    assert rows(jaccard_join(make_docs(pairs)), *columns) == want
    # Small groups, hot groups that answer in many parts.
    assert rows(jaccard_join(make_docs(pairs), group_classes=5, group_shingles=2000, query_shingles=300), *columns) == want
    # Many slices, and buckets that count as hot.
    assert rows(jaccard_join(make_docs(pairs), slice_shingles=100, hot_rows=20), *columns) == want


def test_thresholds_and_sizes(make_docs):
    words = [f"w{i}" for i in range(103)]
    texts = [" ".join(words), " ".join(words[:88]), " ".join(words[:87]), "a b c", "A b  C", "a b"]
    got = rows(jaccard_join(make_docs(texts)), "doc_id", "n_shingles", "component_id")
    assert got == plain_join(list(enumerate(texts))) == [(0, 100, 0), (1, 85, 0), (2, 84, 0), (3, 1, 3), (4, 1, 3), (5, 1, 5)]
    assert rows(jaccard_join(make_docs(texts), percent=50), "component_id")[:3] == [(0,), (0,), (0,)]
    assert jaccard_join(make_docs(texts).limit(0)).count() == 0


def test_prefixes_of_linked_sets_share_enough():
    rng, linked = np.random.default_rng(3), 0
    for _ in range(400):
        n = int(rng.integers(2, 200))
        a = np.sort(rng.choice(2000, n, replace=False))
        b = np.unique(np.concatenate((rng.choice(a, n - n // 12, replace=False), rng.choice(2000, n // 12))))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            linked += 1
            common = set(a[: prefix_length(len(a), 85)]) & set(b[: prefix_length(len(b), 85)])
            assert len(common) >= min(shared_first(len(a)), shared_first(len(b))) >= shared_first(-(-85 * len(a) // 100))
    assert linked > 100


def test_group_answers_as_set_intersection():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.choice(200, k).astype(np.int64)) for k in rng.integers(1, 200, 64)]
    group = Group.of(sets)
    for query in sets:
        near = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, query)) >= 60 * len(np.union1d(s, query))]
        assert group.links(query, 60).tolist() == near
    assert not len(group.links(np.arange(500, 700), 60))
