"""Loading whatever has newly landed in a folder, each document once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.operators.joins import not_done
from ratewright.plans.rates import load_files
from ratewright.sources import rate_files, writers

LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def landed_files(spark: SparkSession, landing: str, files: int = 1000, size: str = "1t") -> DataFrame:
    """Stream of the files in a folder, so many files or bytes at once; their contents are pruned from the scan."""
    reader = spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", True)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader.option("maxBytesPerTrigger", size)
    return reader.load(landing).select("path", "length")


def load_incremental(
    spark: SparkSession,
    landing: str,
    root: str,
    ledger: str,
    work: str,
    lineage: Mapping[str, str],
    files_per_load: int = 1000,
    **options,
) -> None:
    """Load all documents that landed since the last call, and try failed ones again, then stop.

    The file source's checkpoint below ``work`` remembers what was seen, and a load writes
    under its own batch number, so a batch that is repeated after a failure replaces itself.
    A failed document is seen already, so a batch of its own takes it up from the ledger, before
    new ones; it replaces nothing of other loads.  ``options`` go to :func:`ratewright.plans.rates.extract_rates`.
    """
    failed = retries(spark, ledger)
    if not failed.isEmpty():
        number = writers.read_ledger(spark, ledger).where("status = 'failed'").count()
        again = rate_files.list_documents(spark, landing).join(failed, F.col("path") == F.col("source"), "left_semi")
        load_files(spark, again, root, ledger, work, lineage, f"retry-{number}", **options)

    def load(batch: DataFrame, batch_id: int) -> None:
        load_files(batch.sparkSession, batch, root, ledger, work, lineage, f"stream-{batch_id}", **options)

    query = (
        landed_files(spark, landing, files_per_load)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def retries(spark: SparkSession, ledger: str) -> DataFrame:
    """Sources that failed and were not done since."""
    facts = writers.read_ledger(spark, ledger)
    failed = facts.where("status = 'failed'").select("source").distinct()
    return not_done(failed, facts.where("status = 'done'"), "source")
