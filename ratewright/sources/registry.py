"""Reading the provider registry and its taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions import scalars as S

# Column titles of the registry and taxonomy files.
REGISTRY_COLUMNS = {
    "npi": "NPI",
    "entity_type_code": "Entity Type Code",
    "org_name": "Provider Organization Name (Legal Business Name)",
    "last_name": "Provider Last Name (Legal Name)",
    "first_name": "Provider First Name",
    "practice_state": "Provider Business Practice Location Address State Name",
    "mailing_state": "Provider Business Mailing Address State Name",
    "deactivation_date": "NPI Deactivation Date",
}
SLOT_CODE = "Healthcare Provider Taxonomy Code_{}"
SLOT_SWITCH = "Healthcare Provider Primary Taxonomy Switch_{}"
SLOTS = 15
TAXONOMY_COLUMNS = {
    "taxonomy_code": "Code",
    "taxonomy_grouping": "Grouping",
    "taxonomy_classification": "Classification",
    "taxonomy_specialization": "Specialization",
    "display_name": "Display Name",
}


def _read_csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=multi_line, escape='"', quote='"', encoding="UTF-8")


def _text(df: DataFrame, title: str):
    """A column by title, '' when null or when the file lacks it."""
    return S.blank(F.col(f"`{title}`")) if title in df.columns else F.lit("")


def read_provider_registry(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Registry rows with plain names and ``slots``, an array of (code, switch).

    Quoted line breaks need ``multi_line``, which makes each file one task; a file known to
    have none can be read with ``multi_line=False`` and splits.
    """
    df = _read_csv(spark, path, multi_line)
    slots = F.array(
        *[
            F.struct(
                _text(df, SLOT_CODE.format(n)).alias("code"), _text(df, SLOT_SWITCH.format(n)).alias("switch")
            )
            for n in range(1, SLOTS + 1)
        ]
    )
    return df.select(
        *[_text(df, title).alias(name) for name, title in REGISTRY_COLUMNS.items()], slots.alias("slots")
    )


def read_taxonomy(spark: SparkSession, path: str | None) -> DataFrame:
    """Taxonomy codes with their texts; no path gives an empty crosswalk.

    Rows without a code are skipped, and of a repeated code the last row counts.
    """
    if path is None:
        return spark.createDataFrame([], ", ".join(f"{name} string" for name in TAXONOMY_COLUMNS))
    df = _read_csv(spark, path, multi_line=True)
    rows = df.select(
        *[S.strip(_text(df, title)).alias(name) for name, title in TAXONOMY_COLUMNS.items()]
    ).withColumn("_line", F.monotonically_increasing_id())
    texts = [name for name in TAXONOMY_COLUMNS if name != "taxonomy_code"]
    last = (
        rows.where(F.col("taxonomy_code") != "")
        .groupBy("taxonomy_code")
        .agg(F.max_by(F.struct(*texts), "_line").alias("row"))
    )
    return last.select("taxonomy_code", *[F.col(f"row.{name}").alias(name) for name in texts])
