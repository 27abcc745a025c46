import math
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from odd_docs import make_docs, odd  # noqa: F401

from tidemark.llm.katz import _by_part, _distinct, good_turing, katz_scores, pack, pack_sorted, unpack, unpack_sorted
from tidemark.llm.quality import drop_poor, fit_ordinal, quality_scores
from tidemark.llm.text_features import SLICE, ngrams, slices
from tidemark.llm.toxicity import BITS as TOXIC_BITS
from tidemark.llm.toxicity import SIZES, present, toxicity_scores
from tidemark.session import shared_dir


def corpus(n=400):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(10, 200))]
        kind = rng.choice(["good", "good", "toxic", "poor"])
        if kind == "toxic":
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vileword", "nastything"])
        text = " ".join(w.upper() + "!!" for w in words) if kind == "poor" else " ".join(words)
        docs.append((i, text))
        labels.append((i, int(kind != "poor"), int(kind == "toxic"), "x"))
    return docs, labels


def held(doc_id, parts, part):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == part


def test_toxicity_on_held_out_labels(spark, make_docs, odd):  # noqa: F811
    docs, labels = corpus()
    table = spark.createDataFrame([*labels, (None, 1, 1, "x"), (999_999, 1, None, "x")], "doc_id long, quality int, toxic int, text string")
    got = toxicity_scores(make_docs(docs + [(i and i + 1000, t) for i, t in odd]), table).collect()
    truth = {i: t for i, _, t, _ in labels}
    own = [r for r in got if r.doc_id is not None and r.doc_id < 1000]
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == held(r.doc_id, 3, 1) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in own if r.held_out]) > 0.97
    # Labels of held-out rows are not read.
    turned = spark.createDataFrame([(i, q, 1 - t if held(i, 3, 1) else t, x) for i, q, t, x in labels], "doc_id long, quality int, toxic int, text string")
    again = {r.doc_id: r.score for r in toxicity_scores(make_docs(docs), turned).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-9) for r in own)
    none = toxicity_scores(make_docs(odd), table.limit(0)).collect()
    assert len(none) == len(odd) and {r.score for r in none} == {0.5}
    assert toxicity_scores(make_docs(odd).limit(0), table).count() == 0


def test_quality_grades(spark, make_docs, odd):  # noqa: F811
    docs, labels = corpus()
    grade = {i: q * (2 - t) for i, q, t, _ in labels}
    ratings = spark.createDataFrame([*((i, g, "x") for i, g in grade.items() if i % 2), (7, 9, "x"), (8, None, "x"), (None, 1, "x")], "doc_id long, grade int, text string")
    table = make_docs(docs + [(i and i + 1000, t) for i, t in odd])
    got = quality_scores(table, ratings).collect()
    assert len(got) == len(docs) + len(odd)
    for r in got:
        assert 1 >= r.tail[0] >= r.tail[1] >= 0 and r.expected_grade == pytest.approx(sum(r.tail)) and r.selected == (r.tail[0] >= 0.5)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and r.doc_id % 2 == 0]
    assert np.mean([r.selected == (grade[r.doc_id] > 0) for r in unseen]) > 0.97
    mean = [np.mean([r.expected_grade for r in unseen if grade[r.doc_id] == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    out = drop_poor(table, ratings)
    assert out.dtypes == table.dtypes and out.count() == sum(r.selected or r.doc_id is None for r in got)
    assert quality_scores(table, ratings.limit(0)).count() == len(got)
    assert quality_scores(table.limit(0), ratings).count() == 0


def test_no_ngram_is_lost_or_counted_twice_at_a_border():
    rng = np.random.default_rng(6)
    for length in (0, 1, 5, SLICE - 1, SLICE, SLICE + 1, SLICE + 3, 2 * SLICE + 7):
        raw = rng.integers(97, 123, length).astype(np.uint8)
        for sizes in ((3,), (2, 3), (1, 2, 3, 4, 5)):
            got = Counter()
            for part in slices(raw, max(sizes)):
                got.update(ngrams(part, sizes, 20).tolist())
            want = Counter()
            for n in sizes:  # each n-gram by itself
                for at in {*range(0, min(9, length - n + 1)), *range(max(0, SLICE - 9), min(SLICE + 9, length - n + 1)), *range(max(0, length - n - 8), length - n + 1)}:
                    want[int(ngrams(raw[at : at + n], (n,), 20)[0])] += 1
            assert sum(got.values()) == sum(max(0, length - n + 1) for n in sizes) and all(got[k] >= v for k, v in want.items())
    raw = np.full(600_000, 46, np.uint8)
    raw[SLICE - 2 : SLICE + 2] = np.frombuffer(b"xyzw", np.uint8)
    marks = np.zeros(1 << TOXIC_BITS, bool)
    found = set(present(raw, marks).tolist())
    assert {int(x) for x in ngrams(np.frombuffer(b"xyzw", np.uint8), SIZES, TOXIC_BITS)} <= found


def test_ordinal_thresholds_stay_ordered():
    rng = np.random.default_rng(1)
    x = rng.random(600)
    grade = (x * 4).astype(int)
    model = fit_ordinal(np.arange(600), np.zeros(600, np.int32), x.astype(np.float32), grade, 4, l2=0)
    assert (np.diff(model.thresholds) > 0).all() and model.weights[0] > 0
    guess = [int((model.tails(np.array([0]), np.array([v], np.float32)) > 0.5).sum()) for v in x]
    assert np.mean(np.abs(np.array(guess) - grade) <= 1) > 0.99


def plain_katz(pairs):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    docs = [(i, [w for w in low(t).replace("\x0b", " ").replace("\x0c", " ").translate({9: " ", 10: " ", 13: " "}).split(" ") if w] + [None]) for i, t in pairs]
    c1, c2, ch = Counter(), Counter(), Counter()
    for i, w in docs:
        if not held(i, 7, 2):
            c1.update(w)
            c2.update(zip([0, *w[:-1]], w))
            ch.update([0, *w[:-1]])
    total, distinct = sum(c1.values()), len(c1)
    f = good_turing(dict(Counter(c2.values())), 5)
    keep = lambda c: (f[c] if c <= 5 else 1.0) * c
    p1 = lambda w: (c1[w] + 1) / (total + distinct + 1)
    kept, seen = Counter(), Counter()
    for (h, w), c in c2.items():
        kept[h] += keep(c)
        seen[h] += p1(w)

    def p(h, w):
        if not ch[h]:
            return p1(w)
        den = ch[h] + (kept[h] > ch[h] - 1e-9)
        c = c2[h, w]
        return keep(c) / den if c else (1 - kept[h] / den) / (1 - seen[h]) * p1(w)

    out = [
        (i, len(w), sum(c1[x] > 0 for x in w), total, sum(math.log10(p1(x)) for x in w), sum(math.log10(p(h, x)) for h, x in zip([0, *w[:-1]], w)))
        for i, w in docs
    ]
    return out, p, c1, ch


@pytest.mark.parametrize("block_bytes", [300, 8 << 20])
def test_katz_equals_plain_and_sums_to_one(make_docs, odd, block_bytes):  # noqa: F811
    rng = random.Random(6)
    pairs = list(odd) + [(20 + i, " ".join(rng.choice("the a of X y z w v u".split()) + rng.choice(["", "", "1", "2"]) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    expected, p, c1, ch = plain_katz(pairs)
    key = lambda r: (str(r[0]), r[1], round(r[4], 6))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz_scores(make_docs(pairs), block_bytes=block_bytes).collect()), key=key)
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:])
    for h in [0, "no such word", *list(ch)[:30]]:
        assert sum(p(h, w) for w in c1) + p(h, "no such word") == pytest.approx(1)


def plain_katz_of_order(pairs, order):
    docs = [(i, [w for w in (t or "").split(" ") if w] + [None]) for i, t in pairs]
    grams = [Counter() for _ in range(order + 1)]
    for i, words in docs:
        if not held(i, 7, 2):
            for n in range(1, order + 1):
                padded = [0] * (n - 1) + words
                grams[n].update(tuple(padded[k : k + n]) for k in range(len(words)))
    total, distinct = sum(grams[1].values()), len(grams[1])
    factors = [good_turing(dict(Counter(g.values())), 5) for g in grams]
    after = [{} for _ in grams]
    for n in range(2, order + 1):
        for g, c in grams[n].items():
            after[n].setdefault(g[:-1], {})[g[-1]] = c

    def p(h, w):
        if not h:
            return (grams[1][w,] + 1) / (total + distinct + 1)
        n = len(h) + 1
        seen = after[n].get(h)
        if not seen:
            return p(h[1:], w)
        kept = {x: (factors[n][c] if c <= 5 else 1.0) * c for x, c in seen.items()}
        den = sum(seen.values())
        den += sum(kept.values()) > den - 1e-9
        return kept[w] / den if w in kept else (1 - sum(kept.values()) / den) / (1 - sum(p(h[1:], x) for x in seen)) * p(h[1:], w)

    padded = [(i, [0] * (order - 1) + w) for i, w in docs]
    return {i: sum(math.log10(p(tuple(w[k - order + 1 : k]), w[k])) for k in range(order - 1, len(w))) for i, w in padded}, p, after, grams


def test_katz_sorts_keys_with_their_places():
    """Numbers and parts of n-grams are those of np.unique and np.lexsort, whether or not a key and its place fit into one number."""
    chance = np.random.default_rng(3)
    for keys in (chance.integers(0, 50, 400), chance.integers(0, 1 << 62, 300), chance.integers(-9, 9, 100), np.array([1 << 62, 0, 1 << 62]), np.zeros(0, np.int64)):
        for of in (keys, keys.astype(np.uint64)):
            first, ids = _distinct(of)
            names, expected = np.unique(of, return_inverse=True)
            assert np.array_equal(of[first], names) and np.array_equal(ids, expected)
    bucket = np.sort(chance.integers(0, 9, 500))
    for sub in (np.zeros(500, np.int64), np.where(bucket % 3 == 1, chance.integers(0, 4, 500), 0)):
        assert np.array_equal(_by_part(bucket, sub), np.lexsort((sub, bucket)))


@pytest.mark.parametrize("order", [3, 4])
def test_katz_of_higher_order_equals_plain(make_docs, order):
    rng = random.Random(9)
    words = [*"abcdef", *(f"w{i}" for i in range(30))]
    pairs = [(i, " ".join(rng.choice([rng.choice(words), "a b a"]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    expected, p, after, grams = plain_katz_of_order(pairs, order)
    got = {r.doc_id: r.score for r in katz_scores(make_docs(pairs), block_bytes=900, order=order).collect()}
    assert got == pytest.approx(expected)
    for h in list(after[order])[:20]:
        assert sum(p(h, w) for (w,) in grams[1]) + p(h, "no such word") == pytest.approx(1)


def test_katz_reads_more_than_the_word_before(make_docs):
    texts = ["x b c", "y b d"] * 20
    score = {r.doc_id: r.score for r in katz_scores(make_docs([*enumerate(texts), (100, "x b c"), (101, "x b d")]), order=3).collect()}
    assert score[100] > score[101] + 1


def test_katz_without_rows_or_training(make_docs):  # noqa: F811
    assert katz_scores(make_docs([(1, "a")]).limit(0)).count() == 0
    only = next(i for i in range(100) if held(i, 7, 2))
    row = katz_scores(make_docs([(only, "a b")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_arrays_survive_packing():
    for x in (np.arange(5), np.array([1 << 40]), np.array([], np.int64), np.array([0.5, -1]), np.array([2**64 - 1], np.uint64), np.array([3], np.uint8)):
        assert unpack(pack(x)).tolist() == x.tolist()


def test_sorted_arrays_survive_packing():
    for x in ([], [7], [0, 0, 5], [1, 2**63, 2**64 - 1]):
        assert unpack_sorted(pack_sorted(np.array(x, np.uint64))).tolist() == x


def test_katz_leaves_only_its_scores_on_disk(make_docs):
    """Neither the tables between its steps nor shuffle files of steps that have ended stay, which is what ran out of disk."""
    docs = make_docs([(i, f"a b c {i} d") for i in range(40)])
    spark = docs.sparkSession
    scratch = Path(shared_dir(spark).removeprefix("file:")) / "tidemark"
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*.data")}
    tables, before = set(scratch.glob("lm*")), shuffled()
    scores = katz_scores(docs, block_bytes=100, order=3)
    made = set(scratch.glob("lm*")) - tables
    assert [t.name for m in made for t in m.iterdir()] == ["scores"]
    deadline = time.time() + 20  # Spark deletes them in the background
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert scores.count() == 40
