"""From raw documents to packed training sequences: five stages, each one operator of ``ratewright.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of documents, with the documents' own values: a
column that is named like one that a stage adds is neither read nor replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratewright.llm import decontamination, jaccard, packing, quality, toxicity
from ratewright.llm.common import checked
from ratewright.llm.queries import table, tokenizer_file


def named_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc_id`` and ``text`` as they are and the other columns under names that no stage uses."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"_own_{k}" for k, c in enumerate(docs.columns)])


def judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], kept: str) -> DataFrame:
    """The documents of which ``kept`` holds after ``judge`` has added its columns."""
    apart = named_apart(docs)
    return judge(apart).where(kept).select(apart.columns).toDF(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score is under the cut."""
    ranking = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged(docs, lambda apart: quality.score(apart, ranking), f"score >= {quality.CUT}")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are toxic as written or behind their spelling."""
    marks = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged(docs, lambda apart: toxicity.score(apart, marks), f"score < {toxicity.CUT}")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    benchmark = table(spark, sf_dir, "benchmark")
    return judged(docs, lambda apart: decontamination.find_passages(apart, benchmark), "size(hits) = 0")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token of the documents goes."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: Fitted models and the tokenizer are not SQL; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checked(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
