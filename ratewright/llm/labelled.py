"""Bounded samples of labelled rows for the classifiers.

Classifiers are fitted on at most ``bound`` labelled rows: those whose ids have the smallest hashes, so a sample
does not depend on how tables are divided. Only ids and labels are ranked; texts are read for the chosen rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import crc_remainder

#: Labelled rows that a classifier is fitted on at most.
BOUND = 20_000


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, modulus: int, left_out: int, bound: int = BOUND) -> DataFrame:
    """``text, label`` (0.0 or 1.0) of labelled rows whose id's remainder is not ``left_out``.

    Labels other than 0 and 1 and null ids are no labels; of several labels of an id the largest holds.
    """
    marked = (
        labels.select("doc_id", F.col(label).cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0))
        .where(crc_remainder("doc_id", modulus) != left_out)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("rank", F.xxhash64("doc_id"))
    )
    # Ranks are spread evenly: all but about the first ``bound`` go before rows are put in order.
    last = int(-(2**63) + 2**64 * min(1.0, 1.05 * bound / max(1, marked.count()))) - 1
    chosen = marked.where(F.col("rank") <= last).orderBy("rank", "doc_id").limit(bound).select("doc_id", "label")
    # ``bound`` ids of 8 bytes and labels: the broadcast's size is known.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
