"""Data tests. A test is a DataFrame of violations; it passes when the DataFrame is empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.session import shuffle_files_deleted


def not_unique(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_null(column))


def is_not_accepted(column: str, values: Sequence[str]) -> Column:
    """Outside the list; null is not a violation."""
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def not_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(is_not_accepted(column, values))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows with a non-null key no parent has."""
    keys = parent.select(F.col(parent_column).alias("_parent_key"))
    present = child.filter(F.col(column).isNotNull())
    return present.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


@dataclass(frozen=True)
class DataTest:
    """``violations`` hold the broken rows. A test of single rows also names its model and condition.

    ``observed`` is the number of them, if it was counted while the model was written.
    """

    label: str
    violations: DataFrame
    severity: str = "error"
    model: DataFrame | None = None
    broken: Column | None = None
    observed: int | None = None


def row_test(label: str, model: DataFrame, broken: Column, severity: str = "error", observed: int | None = None) -> DataTest:
    return DataTest(label, model.filter(broken), severity, model, broken, observed)


class RowCounts:
    """Violations of row tests, counted while their model is written, so that the tests need no scan of their own.

    The metrics sit above everything else in the plan of a write without a further exchange, so they belong to its last stage, and a task
    that runs again counts once.
    """

    def __init__(self, tests: Mapping[str, Column]):
        self.tests, self._seen = tests, Observation()

    def attach(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(broken).alias(f"n{i}") for i, broken in enumerate(self.tests.values())]
        return df.observe(self._seen, *counts)

    def get(self) -> dict[str, int]:
        """Violations by label, once the write is done; none where the optimizer saw that there are no rows to count."""
        found = self._seen.get
        return {label: found[f"n{i}"] for i, label in enumerate(self.tests) if f"n{i}" in found}


def _counts(tests: Sequence[DataTest]) -> DataFrame:
    """Violation counts of row tests on one model, from one pass over it."""
    counts = tests[0].model.agg(
        *[F.count(F.when(t.broken, 1)).alias(f"n{i}") for i, t in enumerate(tests)]
    )
    listed = [
        F.struct(F.lit(t.label).alias("test"), F.lit(t.severity).alias("severity"), F.col(f"n{i}").alias("violations"))
        for i, t in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*listed)))


def run_tests(tests: Sequence[DataTest]) -> DataFrame:
    """One row per test: label, severity, violation count and verdict.

    Row tests of one model share a scan, or none if they were observed while it was written. Every other count is aggregated where the rows are. The
    counts are taken one after the other when this is called, so that the shuffle files of one test are gone before the next one runs.
    """
    spark = tests[0].violations.sparkSession
    by_model: dict[int, list[DataTest]] = {}
    counted = [(t.label, t.severity, t.observed) for t in tests if t.observed is not None]
    with shuffle_files_deleted(spark):
        for t in tests:
            if t.observed is not None:
                continue
            if t.broken is not None:
                by_model.setdefault(id(t.model), []).append(t)
            else:
                counted.append((t.label, t.severity, t.violations.count()))
        for group in by_model.values():
            counted += [tuple(r) for r in _counts(group).collect()]  # a row per declared test
    rows = spark.createDataFrame(counted, "test string, severity string, violations long")
    verdict = F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "warn", "warn")
    return rows.withColumn("verdict", verdict.otherwise("fail"))


def summarise(results: DataFrame) -> DataFrame:
    """One row: how many tests passed, warned and failed."""
    def of(verdict: str):
        return F.count(F.when(F.col("verdict") == verdict, 1))

    return results.agg(of("pass").alias("passed"), of("warn").alias("warned"), of("fail").alias("failed"))
