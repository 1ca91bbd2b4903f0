"""Flatteners: nested sections of disclosure files to flat tables.

Every flattener takes an *items* frame with one row per section element:

``source_pricing_file, <header fields>, ordinal, item``

``(source_pricing_file, ordinal)`` identifies an element.  Group ids are valid within one
file only, so the file is part of every key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright import schemas
from ratewright.functions import predicates as P
from ratewright.functions import scalars as S
from ratewright.operators.joins import among, is_stored, semi_npi, small_side

KEY = ("source_pricing_file", "ordinal")


def _field(dtype: T.DataType, *path: str) -> T.DataType:
    """Type of a nested field; arrays on the way are entered."""
    for name in path:
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        dtype = dtype[name].dataType
    return dtype


def _joined(df: DataFrame, value: Column, *path: str) -> Column:
    return S.joined(value, _field(df.schema["item"].dataType, *path))


def _unnest(df: DataFrame, array: str, name: str, explode=F.explode) -> DataFrame:
    """Explode an array column, which is then gone.

    What else is needed of the level above is projected before: were the enclosing struct
    carried along, each of its elements would hold a copy of all of them.
    """
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, explode(array).alias(name))


def header_fields(df: DataFrame) -> DataFrame:
    """Document-level scalars, null as ''."""
    return df.withColumns({name: S.blank(F.col(name)) for name in schemas.HEADER_FIELDS})


def with_lineage(df: DataFrame, context: Mapping[str, str]) -> DataFrame:
    """Stamp the six lineage constants.

    A blank ``source_version`` is filled from the document's ``version`` column.
    """
    version = S.blank("version") if "version" in df.columns else F.lit("")
    stamps = {name: F.lit(context.get(name) or "") for name in schemas.LINEAGE_FIELDS}
    if not context.get("source_version"):
        stamps["source_version"] = version
    return df.withColumns(stamps)


# ---------------------------------------------------------------- provider references


def provider_rows(items: DataFrame, outer: bool = True) -> DataFrame:
    """One row per (item, group, npi); null and empty identifiers do not count.

    ``outer`` keeps a blank row for an item without groups and for a group without
    identifiers.
    """
    explode = F.explode_outer if outer else F.explode
    network = _joined(items, F.col("item.network_name"), "network_name")
    references = items.select(
        *KEY,
        "version",
        S.safe_int("item.provider_group_id").alias("provider_group_id"),
        network.alias("network_name"),
        F.col("item.provider_groups").alias("_groups"),
    )
    groups = _unnest(references, "_groups", "g", explode)
    npis = F.array_remove("g.npi", "")
    # The greatest entry is null when there is none but nulls; such a group explodes as null.
    some = F.array_max(npis).isNotNull()
    members = groups.select(
        *KEY,
        "version",
        "provider_group_id",
        "network_name",
        S.blank("g.tin.type").alias("tin_type"),
        S.blank("g.tin.value").alias("tin_value"),
        S.blank("g.tin.business_name").alias("business_name"),
        (~some).alias("_none"),
        F.when(some, npis).alias("_npis"),
    )
    rows = _unnest(members, "_npis", "npi", explode)
    kept = rows.where(F.col("_none") | F.col("npi").isNotNull()).drop("_none")
    return kept.withColumn("npi", S.strip(S.blank("npi")))


def flatten_provider_references(
    items: DataFrame,
    lineage: Mapping[str, str],
    targets: DataFrame | None = None,
    keep_full: bool = False,
) -> DataFrame:
    """Provider table.

    Without ``targets``: everything, blank rows included.  With them: only rows of target
    identifiers or, with ``keep_full``, every identifier of an item that has a target.
    """
    if targets is None:
        rows = provider_rows(items)
    elif not keep_full:
        rows = semi_npi(provider_rows(items, outer=False), targets, trimmed=True)
    else:
        # Items are matched as items, and only those that match are unnested with all their columns.
        hits = semi_npi(provider_rows(items, outer=False).select(*KEY, "npi"), targets, trimmed=True)
        rows = provider_rows(items.join(hits.select(*KEY), list(KEY), "left_semi"), outer=False)
    return schemas.conform(with_lineage(rows, lineage), "tic_provider_reference")


def matched_groups(items: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct (file, group id) that hold a target identifier."""
    rows = provider_rows(items, outer=False).where(F.col("provider_group_id").isNotNull())
    return semi_npi(rows, targets, trimmed=True).select("source_pricing_file", "provider_group_id").distinct()


def groups_of(providers: DataFrame) -> DataFrame:
    """Matched groups of a filtered provider table: whatever it holds has a target (or, kept full, its item has)."""
    rows = providers.where(F.col("provider_group_id").isNotNull())
    return rows.select("source_pricing_file", "provider_group_id").distinct()


# ---------------------------------------------------------------- negotiated prices


RATE_KEY = (*KEY, "rate_no")
ITEM_FIELDS = (*schemas.CODE_FIELDS, "negotiation_arrangement", "severity_of_illness")


def _item_rows(items: DataFrame) -> DataFrame:
    """Item-level columns, with the rates as an array of their own."""
    return items.select(
        *KEY,
        *schemas.HEADER_FIELDS,
        *[S.blank(F.col(f"item.{name}")).alias(name) for name in ITEM_FIELDS],
        F.col("item.negotiated_rates").alias("_rates"),
    )


def matching_rates(items: DataFrame, groups: DataFrame) -> DataFrame:
    """Keys of the rates that refer to a matched group of their file, each once.

    Only keys and references are read and moved.  The references of a rate meet in one task,
    so those that match are reduced to one row before the shuffle.
    """
    rates = items.select(*KEY, F.posexplode("item.negotiated_rates.provider_references").alias("rate_no", "refs"))
    refs = _unnest(rates, "refs", "ref")
    refs = refs.select(*RATE_KEY, S.safe_int("ref").alias("provider_group_id"))
    by = ["source_pricing_file", "provider_group_id"]
    groups = groups.select(*by)
    refs, few = refs.where(F.col("provider_group_id").isNotNull()), small_side(groups)
    if few is groups and is_stored(groups):
        # Too many groups to go to all tasks: references that cannot match are left out before the shuffle.
        refs = among(refs, by, groups)
    return refs.join(few, by, "left_semi").select(*RATE_KEY).distinct()


def matched_rates(
    items: DataFrame,
    groups: DataFrame,
    work: str | None = None,
    key_items: DataFrame | None = None,
    only: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rates of :func:`matching_rates` with their prices.

    ``key_items`` may hold the same items read with codes and references only.  With ``only`` and a ``work`` folder, the items
    are what ``only`` gives for the keys found: those of these files and ordinals at least, so that others need not be parsed.

    With a ``work`` folder the keys are written there first and measured.  A selective filter
    leaves few of them; they are then broadcast and the nested prices are not shuffled at all.
    """
    keys = matching_rates(items if key_items is None else key_items, groups)
    if work is not None:
        keys.write.mode("overwrite").parquet(work)
        stored = items.sparkSession.read.schema(keys.schema).parquet(work)
        keys = small_side(stored)
        items = items if only is None else only(stored.select(*KEY))
    rows = _item_rows(items)
    kept = [c for c in rows.columns if c != "_rates"]
    numbered = rows.select(*kept, F.posexplode("_rates").alias("rate_no", "rate"))
    return numbered.join(keys, list(RATE_KEY), "left_semi").drop("rate_no")


def _price_columns(df: DataFrame) -> dict[str, Column]:
    at = ("negotiated_rates", "negotiated_prices")
    price = F.col("price")
    columns = {name: S.blank(price[name]) for name in schemas.PRICE_FIELDS}
    for name in ("service_code", "billing_code_modifier"):
        columns[name] = _joined(df, price[name], *at, name)
    for name in ("negotiated_rate", "estimated_amount"):
        columns[name] = S.safe_float(price[name])
    return columns


def flatten_in_network(
    items: DataFrame,
    lineage: Mapping[str, str],
    groups: DataFrame | None = None,
    prefixes: Sequence[str] = (),
    work: str | None = None,
    key_items: DataFrame | None = None,
    only: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Price table: one row per (item, rate, price).

    Without ``groups``: everything, with a blank row for an item without rates and for a
    rate without prices.  With ``groups`` (see :func:`matched_groups`): only rates that
    refer to a matched group of the same file and, with ``prefixes``, only items whose
    code starts with one of them; ``work``, ``key_items`` and ``only`` are for :func:`matched_rates`.
    """
    if groups is None:
        rates = _unnest(_item_rows(items), "_rates", "rate", F.explode_outer)
    else:
        wanted = P.code_matches(F.col("item.billing_code"), prefixes)
        items = items.where(wanted)
        if key_items is not None:
            key_items = key_items.where(wanted)
        rates = matched_rates(items, groups, work, key_items, only)
    priced = rates.select(
        "source_pricing_file",
        *schemas.HEADER_FIELDS,
        *ITEM_FIELDS,
        S.list_join("rate.provider_references").alias("provider_references"),
        F.col("rate.negotiated_prices").alias("_prices"),
    )
    prices = _unnest(priced, "_prices", "price", F.explode_outer)
    rows = header_fields(prices.withColumns(_price_columns(items)).drop("price"))
    return schemas.conform(with_lineage(rows, lineage), "tic_price")


# ---------------------------------------------------------------- out of network


def flatten_out_of_network(items: DataFrame) -> DataFrame:
    """Out-of-network table: item, its allowed amounts (inner), payments and providers (outer)."""
    at = ("allowed_amounts",)
    coded = items.select(
        "source_pricing_file",
        *schemas.HEADER_FIELDS,
        *[S.blank(F.col(f"item.{name}")).alias(name) for name in schemas.CODE_FIELDS],
        F.col("item.allowed_amounts").alias("_allowed"),
    )
    allowed = _unnest(coded, "_allowed", "allowed")
    billed = allowed.withColumns(
        {
            "tin_type": S.blank("allowed.tin.type"),
            "tin_value": S.blank("allowed.tin.value"),
            "service_code": _joined(items, F.col("allowed.service_code"), *at, "service_code"),
            "billing_class": S.blank("allowed.billing_class"),
            "_payments": F.col("allowed.payments"),
        }
    ).drop("allowed")
    payments = _unnest(billed, "_payments", "payment", F.explode_outer)
    paid = payments.withColumns(
        {
            "allowed_amount": S.safe_float("payment.allowed_amount"),
            "_providers": F.col("payment.providers"),
        }
    ).drop("payment")
    providers = _unnest(paid, "_providers", "provider", F.explode_outer)
    rows = providers.withColumns(
        {
            "billed_charge": S.safe_float("provider.billed_charge"),
            "npi": _joined(items, F.col("provider.npi"), *at, "payments", "providers", "npi"),
        }
    )
    return schemas.conform(header_fields(rows), "tic_out_of_network_allowed")


# ---------------------------------------------------------------- index files

PAIR_BLOCK = 128


def flatten_index(docs: DataFrame, lineage: Mapping[str, str], block: int = PAIR_BLOCK) -> DataFrame:
    """Plan-to-file bridge of whole index documents, see :func:`flatten_structures`."""
    structures = docs.select("source_index_file", *schemas.HEADER_FIELDS, F.posexplode("reporting_structure").alias("structure_no", "s"))
    return flatten_structures(structures, lineage, block)


def flatten_structures(structures: DataFrame, lineage: Mapping[str, str], block: int = PAIR_BLOCK) -> DataFrame:
    """Plan-to-file bridge: within each structure (``s``, ``structure_no``), every plan with every located file.

    That product is the result itself, and one structure may hold most of it.  Structures
    larger than one block are therefore cut into blocks of at most ``block`` plans by
    ``block`` files, and the blocks, not the structures, are spread over the tasks.  The
    number of tasks is fixed, since a block is small before it is expanded and adaptive
    execution would merge too many.
    """
    tasks = int(structures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    located = F.filter("s.in_network_files", lambda f: P.has_location(f["location"]))
    sides = structures.select(
        "source_index_file",
        *schemas.HEADER_FIELDS,
        "structure_no",
        F.col("s.reporting_plans").alias("plans"),
        located.alias("files"),
    )

    def chunks(name: str) -> Column:
        """The array in pieces of at most ``block`` entries."""
        starts = F.sequence(F.lit(0), F.ceil(F.size(name) / block).cast("int") - 1)
        return F.transform(starts, lambda n: F.slice(name, n * block + 1, F.lit(block)))

    # Each side is cut into rows of its pieces, and the whole array goes no further than its own cut.
    common = [c for c in sides.columns if c not in ("plans", "files")]
    blocks = (
        sides.where((F.size("plans") > 0) & (F.size("files") > 0))
        .select(*common, "files", F.posexplode(chunks("plans")).alias("plan_block", "plans"))
        .repartition(tasks, "source_index_file", "structure_no", "plan_block")
        .select(*common, "plan_block", "plans", F.posexplode(chunks("files")).alias("file_block", "files"))
        .repartition(tasks, "source_index_file", "structure_no", "plan_block", "file_block")
    )
    pairs = _unnest(_unnest(blocks, "plans", "plan"), "files", "file")
    plan_fields = ("plan_name", "plan_id", "plan_id_type", "plan_market_type", "issuer_name")
    rows = pairs.select(
        "source_index_file",
        "reporting_entity_name",
        "reporting_entity_type",
        S.blank("last_updated_on").alias("last_updated_on"),
        "version",
        *[F.col(f"plan.{name}").alias(name) for name in plan_fields],
        S.sponsor_name(F.col("plan")).alias("plan_sponser_name"),
        F.col("file.description").alias("description"),
        F.col("file.location").alias("location"),
    )
    return schemas.conform(with_lineage(rows, lineage), "plan_pricing_bridge")
