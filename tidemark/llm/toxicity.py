"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams. The log-count ratio of an n-gram compares how many toxic and how many other training texts have it.
The classifier is a logistic regression on features that are that ratio where the n-gram is present. Both are fitted on at most ``sample``
labelled documents, those with the smallest hash of their id; only the ``kept`` n-grams with the most evidence get a weight. Scores see nothing
but the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, ship
from tidemark.llm.text_features import ngrams, sample_by_hash, slices, texts

SIZES = (3, 4, 5)
BITS = 18


def present(raw: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The n-gram buckets that occur in the text; ``marks`` is a cleared table that is left cleared."""
    for part in slices(raw, max(SIZES)):
        marks[ngrams(part, SIZES, BITS)] = True
    found = np.flatnonzero(marks)
    marks[found] = False
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks, counts = np.zeros(1 << BITS, bool), np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for label, raw in zip(batch.column("label").to_pylist(), texts(batch.column("text"))):
            counts[label][present(raw, marks)] += 1
    used = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], ["bucket", "other", "toxic"])


def _vectors(slot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << BITS, bool)
        for batch in batches:
            found = []
            for raw in texts(batch.column("text")):
                own = slot[present(raw, marks)]
                found.append(own[own >= 0])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["label", "index"])

    return run


def fit_logistic(rows: np.ndarray, index: np.ndarray, label: np.ndarray, scale: np.ndarray, steps: int = 150, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of the unscaled features and the bias, by full-batch adaptive gradient steps."""
    n, values = len(label), scale[index]
    weights, seen = np.zeros(len(scale)), np.zeros(len(scale))
    rate = (label.sum() + 1) / (n + 2)
    bias, seen_bias = float(np.log(rate / (1 - rate))), 0.0
    if n and 0 < label.sum() < n:
        for _ in range(steps):
            score = np.bincount(rows, weights[index] * values, n) + bias
            pull = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - label) / n
            slope = np.bincount(index, pull[rows] * values, len(scale)) + l2 * weights
            seen += slope**2
            weights -= 0.05 * slope / (np.sqrt(seen) + 1e-12)
            seen_bias += pull.sum() ** 2
            bias -= 0.3 * pull.sum() / (np.sqrt(seen_bias) + 1e-12)
    return weights * scale, bias


def train_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int, kept: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(slot by bucket or -1, weight by slot, bias) from a bounded sample of labelled documents."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("labelled_id"), F.col(label).cast("int").alias("label"))
    known = F.broadcast(sample_by_hash(known, "labelled_id", sample))  # at most ``sample`` rows
    picked = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(known, F.col("id") == F.col("labelled_id")).select("label", "text")
    counted = picked.mapInArrow(_counts, "bucket long, other long, toxic long").groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    table = counted.toArrow()  # at most one row per bucket
    bucket, other, toxic = (table.column(c).to_numpy() for c in ("bucket", "other", "toxic"))
    ratio = np.log((toxic + 1.0) / (toxic + 1.0).sum()) - np.log((other + 1.0) / (other + 1.0).sum()) if len(bucket) else np.empty(0)
    evidence = np.abs(ratio) * np.sqrt(toxic + other)
    best = np.lexsort((bucket, -evidence))[:kept]
    slot = np.full(1 << BITS, -1, np.int32)
    slot[bucket[best]] = np.arange(len(best))
    got = picked.mapInArrow(_vectors(slot), "label int, index array<int>").limit(sample).toArrow()
    lists = got.column("index").combine_chunks()
    rows = np.repeat(np.arange(got.num_rows), lists.value_lengths().to_numpy()) if got.num_rows else np.empty(0, np.int64)
    weights, bias = fit_logistic(rows, lists.flatten().to_numpy(), got.column("label").to_numpy(), ratio[best])
    return slot, weights, bias


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = 0.7,
    sample: int = 8000,
    kept: int = 30_000,
    parts: int = 3,
    part: int = 1,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels of held-out ids (crc32 of the id modulo ``parts`` equals ``part``) are never read. Null and empty texts get the bias alone. Repeated
    rows and null ids are scored like others. Without labels of both kinds every score is the smoothed base rate.
    """
    ship(docs.sparkSession)
    slot, weights, bias = train_toxicity(docs, labels.filter(~held_out(doc_id, parts, part)), doc_id, text, label, sample, kept)
    by_bucket = np.zeros(1 << BITS)
    by_bucket[slot >= 0] = weights[slot[slot >= 0]] if len(weights) else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(1 << BITS, bool)
        for batch in batches:
            score = np.array([by_bucket[present(raw, marks)].sum() for raw in texts(batch.column("text"))], np.float64) + bias
            score = 1 / (1 + np.exp(-np.clip(score, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = plain.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out("doc_id", parts, part).alias("held_out"), "score", "predicted")
