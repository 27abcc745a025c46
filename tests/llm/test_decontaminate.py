import hashlib
import random
import re

from conftest import rows
from odd_docs import make_docs, odd  # noqa: F401

from tidemark.llm.decontaminate import contamination, drop_contaminated, report

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(pairs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - 9) if w and item is not None else 0):
            windows.setdefault(tuple(w[at : at + 10]), set()).add(str(item))
    out = []
    for doc_id, text in pairs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def make_items(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string").repartition(2)


def sample():
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "of", "a"]) if rng.random() < 0.5 else f"t{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(2, 30)]
    items += [(1, None), (100, ""), (None, "lost item of ten words that has no id at all"), (9, "!!"), (10, "the the the the the the the the the the the")]
    pairs = []
    for i in range(80):
        text = " ".join(word() for _ in range(rng.randint(0, 120)))
        if i % 3 == 0:
            text += ", " + (rng.choice(items)[1] or "").upper() + "! " + text[:40]
        pairs.append((i + 200, text))
    return pairs, items


def test_contamination_equals_plain(spark, make_docs, odd):  # noqa: F811
    pairs, items = sample()
    pairs += odd + [(900, "The-the the the the the, the the the the the the the")]
    docs, bench = make_docs(pairs), make_items(spark, items)
    assert rows(report(contamination(docs, bench)), *COLUMNS) == plain(pairs, items)
    # A benchmark in many blocks, documents in many segments.
    cut = report(contamination(docs, bench, block_words=300, segment_bytes=500))
    assert rows(cut, *COLUMNS) == plain(pairs, items)


def test_proximity_allows_words_out_of_place(spark, make_docs):  # noqa: F811
    items = [(1, "q0 q1 q2 q3 q4 q5 q6 q7 q8 q9")]
    pairs = [(1, "q0 q1 q2 q3 x q4 q5 q6 q7 q8 q9"), (2, "q9 x x x x q0 q1 q2 q3 q4 q5 q6 q7 q8"), (3, "q1 q0 q2 q3 q4 q5 q6 q7 q9 q8")]
    got = {r.doc_id: (r.contaminated, r.n_near_items) for r in report(contamination(make_docs(pairs), make_items(spark, items))).collect()}
    assert got == {1: (False, 1), 2: (False, 0), 3: (False, 1)}


def test_empty_tables_and_filter(spark, make_docs, odd):  # noqa: F811
    docs, bench = make_docs(odd), make_items(spark, [(1, "one two three four five six")])
    assert rows(report(contamination(docs, bench.limit(0))), *COLUMNS) == plain(odd, [])
    assert report(contamination(docs.limit(0), bench)).count() == 0
    out = drop_contaminated(docs, bench)
    assert out.dtypes == docs.dtypes
    # Rows without an id cannot be named and stay.
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 2, 3, 6, 7, None, None]
