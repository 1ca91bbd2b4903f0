"""Joins and set operations, with broadcasts only behind a measured bound."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.functions import scalars as S

BROADCAST_ROWS = 4_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
#: Bits that tell the keys of ``among``, as rows of 64.
AMONG_BITS = 1 << 27


def _row_bytes(df: DataFrame) -> Column:
    width = F.lit(16)
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(df[field.name]), F.lit(0)) + 8
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(df[field.name]))), F.lit(0))
        else:
            width = width + 8
    return width


def small_side(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark ``df`` for broadcast when it was measured to be small, else return it unmarked.

    The measurement is one distributed aggregate, taken only of what is read straight from
    storage; anything else would be computed twice.  Unmarked sides are left to adaptive
    execution, which broadcasts small ones and splits the hot keys of others.
    """
    if not is_stored(df):
        return df
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df).cast("bigint"))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


def among(rows: DataFrame, by: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Rows whose ``by`` is in the stored table ``wanted``, and a few more: a join that follows moves only these.

    Three bits of a word tell a key, in at most ``AMONG_BITS`` bits that go to all tasks.  Where the keys are so many that
    this would tell little, all rows stay.
    """
    count = wanted.count()
    bits = min(AMONG_BITS, 1 << max(12, (16 * count).bit_length()))
    if 8 * count > bits:
        return rows
    hashed = F.xxhash64(*by)
    word = F.pmod(hashed, F.lit(bits // 64))
    one = lambda shift: F.expr(f"shiftleft(1L, cast(shiftright(_hash, {shift}) & 63 as int))")
    mask = one(40).bitwiseOR(one(46)).bitwiseOR(one(52))
    marked = wanted.select(hashed.alias("_hash"), word.alias("_word"))
    bitmap = marked.groupBy("_word").agg(F.bit_or(mask).alias("_bits"))
    told = rows.withColumns({"_hash": hashed, "_word": word}).join(F.broadcast(bitmap), "_word")
    return told.where(F.col("_bits").bitwiseAND(mask) == mask).select(*rows.columns)


def is_stored(df: DataFrame) -> bool:
    """Is the frame a stored table, at most filtered, projected or made distinct?"""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter", "Aggregate"):
        node = node.children().apply(0)
    return node.children().isEmpty()


def target_set(df: DataFrame, column: str = "npi") -> DataFrame:
    """Distinct, trimmed, filled identifiers as one column ``npi``."""
    npi = S.strip(F.col(column).cast("string"))
    return df.select(npi.alias("npi")).where(F.col("npi") != "").distinct()


def semi_npi(df: DataFrame, targets: DataFrame, column: str = "npi", trimmed: bool = False) -> DataFrame:
    """Rows whose identifier, trimmed unless it already is, is a target."""
    targets = small_side(target_set(targets)).withColumnRenamed("npi", "_target")
    npi = df[column] if trimmed else S.strip(df[column])
    return df.join(targets, npi == F.col("_target"), "left_semi")


def not_done(df: DataFrame, done: DataFrame, column: str, done_column: str | None = None) -> DataFrame:
    """Candidates that the ledger, or an earlier output, does not hold."""
    done = done.select(F.col(done_column or column).alias("_done"))
    return df.join(small_side(done), df[column] == F.col("_done"), "left_anti")


def target_npis(df: DataFrame, explicit: DataFrame | Iterable[str]) -> DataFrame:
    """Registry identifiers together with an explicit list, each once."""
    if not isinstance(explicit, DataFrame):
        explicit = df.sparkSession.createDataFrame([(x,) for x in explicit], "npi string")
    return target_set(df.select("npi").unionByName(explicit.select("npi")))


def price_with_provider(prices: DataFrame, providers: DataFrame) -> DataFrame:
    """Price rows with the provider rows of the groups they refer to, within one file.

    A price that names a group twice meets it once.  The key always holds the file: a
    group id means nothing outside it.  Hot (file, group) keys are split by the adaptive
    skew join, which this shuffle join leaves room for.
    """
    ids = F.array_distinct(S.safe_ints(F.split("provider_references", r"\|")))
    exploded = prices.withColumn("provider_group_id", F.explode(ids)).where("provider_group_id IS NOT NULL")
    right = providers.select(
        "source_pricing_file",
        "provider_group_id",
        *[
            F.col(c)
            for c in ("network_name", "tin_type", "tin_value", "npi", "business_name")
            if c in providers.columns
        ],
    )
    return exploded.join(right, ["source_pricing_file", "provider_group_id"])


def unify_payers(manifests: dict[str, DataFrame]) -> DataFrame:
    """Tag each payer's manifest with its code and append them; duplicates stay."""
    result = None
    for payer, manifest in manifests.items():
        tagged = manifest.withColumn("payer_code", F.lit(payer))
        result = tagged if result is None else result.unionByName(tagged, allowMissingColumns=True)
    if result is None:
        raise ValueError("no payer manifests given")
    return result
