"""Ordinal quality regression: a cumulative-link (proportional odds) model on hashed text features.

P(grade >= k) is the logistic of w.x - t_k with one weight vector for all grades and ordered thresholds t_1 < t_2 < ... Features are frequencies of
lower-cased byte n-grams, of n-grams over byte classes (capitals, digits, symbols), and the share of words that repeat the word before
them. Square roots of frequencies make a text's length irrelevant. The model is fitted on at most ``sample`` rated documents, those with the
smallest hash of their id; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_documents, ship
from tidemark.llm.text_features import CLASSES, LOWER, ngrams, repeats, sample_by_hash, slices, texts

BITS = 15
_REPEAT = 2 << BITS  # the bucket after the two n-gram groups
FEATURES = _REPEAT + 1


def features(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices and values of one text; an empty text has none."""
    counts = np.zeros(2 << BITS, np.int64)
    for part in slices(raw, 3):
        counts[: 1 << BITS] += np.bincount(ngrams(part, (3,), BITS, LOWER), minlength=1 << BITS)
        counts[1 << BITS :] += np.bincount(ngrams(part, (2, 3), BITS, CLASSES, 500), minlength=1 << BITS)
    index = np.flatnonzero(counts)
    half = np.searchsorted(index, 1 << BITS)
    value = counts[index].astype(np.float64)
    value[:half] /= max(1.0, value[:half].sum())
    value[half:] /= max(1.0, value[half:].sum())
    same, n = repeats(raw)
    if same:
        index, value = np.append(index, _REPEAT), np.append(value, same / n)
    return index.astype(np.int32), np.sqrt(value).astype(np.float32)


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(self.thresholds - float(self.weights[index] @ value)))


def fit_ordinal(rows: np.ndarray, index: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int, steps: int = 200, l2: float = 2e-5) -> OrdinalModel:
    """Fit by full-batch adaptive gradient steps; ``rows``, ``index`` and ``value`` are the features in sorted row order.

    With no rated rows, or ratings of one grade only, the weights stay at zero and the thresholds follow the smoothed frequencies.
    """
    n = len(grade)
    tail = np.array([((grade >= k).sum() + 1) / (n + 2) for k in range(1, grades)])
    first = np.minimum.accumulate(tail - 1e-4 * np.arange(grades - 1))
    # Thresholds as a first value and positive gaps, so their order always holds.
    base = -np.log(first / (1 - first))
    params = np.concatenate((base[:1], np.log(np.maximum(np.diff(base), 1e-3))))
    weights, seen_w, seen_p = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(len(params))
    if n and len(np.unique(grade)) > 1:
        for _ in range(steps):
            t = np.cumsum(np.concatenate((params[:1], np.exp(params[1:]))))
            score = np.bincount(rows, weights[index] * value, n)
            edges = np.concatenate((np.ones((n, 1)), 1 / (1 + np.exp(t[None, :] - score[:, None])), np.zeros((n, 1))), axis=1)
            high, low = edges[np.arange(n), grade], edges[np.arange(n), grade + 1]
            chance = np.maximum(high - low, 1e-12)
            up, down = high * (1 - high) / chance, low * (1 - low) / chance
            pull = (down - up) / n  # of the loss by the score
            slope_w = np.bincount(index, pull[rows] * value, FEATURES) + l2 * weights
            by_t = np.array([(up * (grade == k)).sum() - (down * (grade == k - 1)).sum() for k in range(1, grades)]) / n
            slope_p = np.cumsum(by_t[::-1])[::-1] * np.concatenate(([1.0], np.exp(params[1:])))
            seen_w += slope_w**2
            seen_p += slope_p**2
            weights -= 0.5 * slope_w / (np.sqrt(seen_w) + 1e-9)
            params -= 0.2 * slope_p / (np.sqrt(seen_p) + 1e-9)
    return OrdinalModel(weights, np.cumsum(np.concatenate((params[:1], np.exp(params[1:])))))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(x) for x in texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
            ["grade", "index", "value"],
        )


def train_quality(docs: DataFrame, ratings: DataFrame, doc_id: str, text: str, grade: str, grades: int, sample: int) -> OrdinalModel:
    """Fit on a bounded sample of rated documents. Ratings outside 0 .. grades-1 and null ratings are ignored."""
    rated = ratings.filter(F.col(grade).between(0, grades - 1)).select(F.col(doc_id).alias("rated_id"), F.col(grade).cast("int").alias("grade"))
    rated = F.broadcast(sample_by_hash(rated, "rated_id", sample))  # at most ``sample`` rows
    picked = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(rated, F.col("id") == F.col("rated_id")).select("grade", "text")
    got = picked.mapInArrow(_vectors, "grade int, index array<int>, value array<float>").limit(sample).toArrow()
    lists = got.column("index").combine_chunks()
    rows = np.repeat(np.arange(got.num_rows), lists.value_lengths().to_numpy()) if got.num_rows else np.empty(0, np.int64)
    values = got.column("value").combine_chunks().flatten().to_numpy()
    return fit_ordinal(rows, lists.flatten().to_numpy(), values, got.column("grade").to_numpy(), grades)


def quality_scores(
    docs: DataFrame,
    ratings: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    grade: str = "grade",
    grades: int = 3,
    accept: int = 1,
    threshold: float = 0.5,
    sample: int = 6000,
) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail (probabilities of grade >= 1, 2, ...), selected.

    ``selected`` says P(grade >= accept) >= threshold. Null and empty texts have no features and get the thresholds' own
    probabilities. Repeated rows and null ids are scored like others; without ratings every probability is one half or the prior.
    """
    ship(docs.sparkSession)
    model = train_quality(docs, ratings, doc_id, text, grade, grades, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = np.array([model.tails(*features(x)) for x in texts(batch.column("text"))]).reshape(-1, grades - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(tails.sum(axis=1), pa.float64()),
                    pa.array(list(tails), pa.list_(pa.float64())),
                    pa.array(tails[:, accept - 1] >= threshold, pa.bool_()),
                ],
                ["doc_id", "expected_grade", "tail", "selected"],
            )

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(run, "doc_id long, expected_grade double, tail array<double>, selected boolean")


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 poor, 1 fair but toxic, 2 good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2).alias("grade"))


def drop_poor(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that the model selects, all columns kept."""
    scores = quality_scores(docs, ratings, doc_id, text, **options)
    return keep_documents(docs, scores.select(F.col("doc_id").alias(doc_id), F.col("selected").alias("kept")), doc_id)
