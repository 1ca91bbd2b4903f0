"""Provider registry: filters, taxonomy choice and enrichment.

Registry frames carry the columns that :func:`ratewright.sources.registry.read_provider_registry`
gives: text columns and ``slots``, an array of fifteen (code, switch) pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright import schemas
from ratewright.functions import scalars as S
from ratewright.operators.joins import small_side

TAXONOMY_FIELDS = (
    "taxonomy_grouping",
    "taxonomy_classification",
    "taxonomy_specialization",
    "display_name",
)


def _upper(col: str) -> Column:
    return F.upper(S.strip(S.blank(col)))


def active_only(df: DataFrame) -> DataFrame:
    """Providers without a deactivation date."""
    return df.where(S.strip(S.blank("deactivation_date")) == "")


def in_states(df: DataFrame, states: Sequence[str]) -> DataFrame:
    """Practice state, or mailing state when that is blank, in the list; no list keeps all."""
    if not states:
        return df
    wanted = [s.strip().upper() for s in states]
    state = F.coalesce(F.nullif(_upper("practice_state"), F.lit("")), _upper("mailing_state"))
    return df.where(state.isin(*wanted))


def primary_taxonomy(slots: Column) -> Column:
    """Code of the first slot flagged Y or X that has one, else the code of the first slot."""
    flagged = F.filter(
        slots,
        lambda s: S.strip(s["switch"]).isin("Y", "X") & (S.strip(S.blank(s["code"])) != ""),
    )
    return S.strip(
        S.blank(F.coalesce(F.get(flagged, F.lit(0))["code"], F.get(slots, F.lit(0))["code"]))
    )


def with_taxonomy(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Look up the four taxonomy texts by ``taxonomy_code``; '' where the code is unknown."""
    joined = df.join(small_side(taxonomy), "taxonomy_code", "left")
    return joined.withColumns({name: S.blank(name) for name in TAXONOMY_FIELDS})


def has_specialty(df: DataFrame, words: Sequence[str]) -> DataFrame:
    """Some word occurs in the taxonomy texts, in any case; no words keep all."""
    if not words:
        return df
    text = F.lower(F.concat_ws(" | ", *[S.blank(name) for name in TAXONOMY_FIELDS]))
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word.lower())
    return df.where(hit)


def provider_record(df: DataFrame) -> DataFrame:
    """The twelve registry columns from a frame with taxonomy code and texts."""
    individual = S.strip(S.blank("entity_type_code")) == "1"
    rows = df.withColumns(
        {
            "entity_type": F.when(individual, F.lit("Individual")).otherwise(F.lit("Organization")),
            "practice_state": _upper("practice_state"),
            "mailing_state": _upper("mailing_state"),
            **{
                name: S.strip(S.blank(name))
                for name in ("npi", "org_name", "last_name", "first_name")
            },
        }
    )
    return schemas.conform(rows, "nppes_provider")


def providers(
    registry: DataFrame,
    taxonomy: DataFrame,
    states: Sequence[str] = (),
    specialties: Sequence[str] = (),
) -> DataFrame:
    """Registry table: active providers of the states and specialties asked for."""
    kept = in_states(active_only(registry), states)
    coded = kept.withColumn("taxonomy_code", primary_taxonomy(F.col("slots"))).drop("slots")
    return provider_record(has_specialty(with_taxonomy(coded, taxonomy), specialties))
