"""A training corpus from raw documents: reject poor text, drop exact and near copies, drop benchmark leaks, pack into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import stored, table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.near_dedup import drop_near_copies
from tidemark.llm.packing import pack
from tidemark.llm.quality import drop_poor, grades_of_labels
from tidemark.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_poor(docs, grades_of_labels(table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: The regression, the tokenizer and the packing plan cannot be said in SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
