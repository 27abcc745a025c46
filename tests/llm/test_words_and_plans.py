import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.packing import packing_plan
from tidemark.llm.words import NOT_ALNUM, WHITE, rows_of_words, text_chunks, word_hashes

TEXTS = ["", None, "One two  two", "\x1f a\x0bB\x0c", "Été-9 É_x", "a" * 3_000_000 + " b", "x", " ", "end"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.mark.parametrize("table, pattern", [(WHITE, r"[^\x20\x09-\x0D]+"), (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_hashes_stand_for_words(table, pattern, most):
    named = {}
    seen = 0
    for first, last, raw, offsets in text_chunks(pa.array(TEXTS), most):
        hashes, starts = rows_of_words(raw, offsets, table)
        for i in range(first, last):
            words = re.findall(pattern, (TEXTS[i] or "").translate(LOWER))
            own = hashes[starts[i - first] : starts[i - first + 1]]
            assert len(own) == len(words)
            for w, h in zip(words, own.tolist()):
                assert named.setdefault(w, h) == h
            seen += 1
    assert seen == len(TEXTS) and len(set(named.values())) == len(named)


def test_slices_of_long_input_end_at_separators():
    text = " ".join(f"w{i}" for i in range(400_000)).encode()
    hashes, starts = word_hashes(np.frombuffer(text, np.uint8))
    assert len(hashes) == 400_000 and len(set(hashes.tolist())) == 400_000
    assert text[starts[-1] :] == b"w399999"


def _bins(runs, counts, capacity):
    bins, seen = {}, set()
    for length, low, high, first, per, offset in runs:
        for x in range(low, high):
            assert (length, x) not in seen and x < counts[length]
            seen.add((length, x))
            bins.setdefault(first + (x - low) // per, []).append((offset + length * ((x - low) % per), length))
    assert len(seen) == sum(counts.values())
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def _fewest(sizes, capacity):
    best = len(sizes)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i]:
                put(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        put(i + 1, [*rooms, capacity - sizes[i]])

    put(0, [])
    return best


def test_plan_places_every_piece_once_and_packs_well():
    rng = random.Random(1)
    worse = 0
    for _ in range(300):
        capacity, counts = rng.choice([5, 10, 20]), {}
        for _ in range(rng.randint(0, 8)):
            n = rng.randint(1, capacity)
            counts[n] = counts.get(n, 0) + 1
        used = _bins(packing_plan(counts, capacity), counts, capacity)
        fewest = _fewest(sorted((n for n, c in counts.items() for _ in range(c)), reverse=True), capacity)
        assert used >= fewest
        worse += used > fewest
    assert worse <= 3


def test_plan_of_many_pieces_is_near_the_bound():
    rng, counts = random.Random(2), {}
    for _ in range(100_000):
        n = min(4096, int(rng.lognormvariate(6.3, 1)) + 1)
        counts[n] = counts.get(n, 0) + 1
    runs = packing_plan(counts, 4096)
    bins = max(first + (high - low) // per for _, low, high, first, per, _ in runs)
    assert bins <= 1.002 * math.ceil(sum(n * c for n, c in counts.items()) / 4096) + 1
    assert packing_plan({}, 4096) == []
