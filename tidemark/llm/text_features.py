"""Hashed features of whole texts for linear models, made with numpy in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mix, text_chunks, word_hashes

#: Bytes as classes: capital A, small letter or byte beyond ASCII a, digit 0, others themselves.
CLASSES = np.arange(256, dtype=np.uint8)
CLASSES[65:91] = 65
CLASSES[97:123] = CLASSES[128:] = 97
CLASSES[48:58] = 48
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Starts of n-grams in a slice of a long text.
SLICE = 1 << 18


def ngrams(raw: np.ndarray, sizes: tuple[int, ...], bits: int, table: np.ndarray = LOWER, salt: int = 0) -> np.ndarray:
    """Hashed bucket of every byte n-gram of a slice as the table maps it, all sizes one after the other; those that start beyond it are left out."""
    mapped = table[raw].astype(np.uint64)
    out, rolling = [], np.zeros(len(mapped), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(mapped) < n:
            break
        rolling = rolling[: len(mapped) - n + 1] * np.uint64(0x100000001B3) + mapped[n - 1 :] + np.uint64(1)
        if n in sizes:
            out.append((mix(rolling + np.uint64(n * 1000 + salt)) >> np.uint64(64 - bits)).astype(np.int32)[:SLICE])
    return np.concatenate(out) if out else np.empty(0, np.int32)


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of every text; null counts as empty."""
    for first, last, raw, offsets in text_chunks(column):
        for i in range(last - first):
            yield raw[offsets[i] : offsets[i + 1]]


def slices(raw: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """A long text in slices, so that the memory for its features is bounded too.

    Every slice goes on into the next one as far as an n-gram of ``longest`` bytes may reach, so none is lost at a border.
    """
    for at in range(0, max(1, len(raw)), SLICE):
        yield raw[at : at + SLICE + longest - 1]


def repeats(raw: np.ndarray) -> tuple[int, int]:
    """How many words equal the word before them, and how many words there are."""
    h, _ = word_hashes(raw)
    return int((h[1:] == h[:-1]).sum()), len(h)


def sample_by_hash(labels: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of a table of labels, those with the smallest hash of the id; the same rows on every run."""
    return labels.filter(F.col(key).isNotNull()).orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(most)
