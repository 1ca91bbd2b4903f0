"""Queries that exercise the flatteners and the joins around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewright import schemas
from ratewright.functions import scalars as S
from ratewright.operators import audit, flatten, joins, selection
from ratewright.plans import views
from ratewright.plans.catalog import query
from ratewright.session import fresh_folder, saved
from ratewright.sources import lists, rate_files, writers
from ratewright.streaming.incremental import load_incremental

PREFIXES = ("1", " 25 ")

# ---------------------------------------------------------------- shared SQL

_LINEAGE_SQL = """'PAYER' AS payer_code, '2026-01' AS file_month, 'TX' AS state, {version} AS source_version,
       'run-1' AS etl_run_id, '2026-01-05T08:00:00-06:00' AS ingested_at"""


def _file_sql(date: str) -> str:
    return f"'https://rates.example.com/' || strftime({date}, '%Y-%m') || '/in-network.json.gz'"


def _version_sql(date: str) -> str:
    return f"CASE WHEN year({date}) >= 1998 THEN '2.0' ELSE '' END"


def _header_sql(date: str) -> str:
    return f"""'Entity ' || strftime({date}, '%Y') AS reporting_entity_name, '' AS reporting_entity_type,
       strftime({date}, '%Y-%m') || '-01' AS last_updated_on, {_version_sql(date)} AS version"""


# Every (order, identifier) pair of the provider view; ``npi`` is NULL where the group is empty
# and ``grp`` is NULL where the item has no groups.
_PROVIDER_SQL = f"""
base AS (
  SELECT {_file_sql("o_orderdate")} AS source_pricing_file, {_version_sql("o_orderdate")} AS version,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey // 4 AS BIGINT) END AS provider_group_id,
         o_orderpriority || CASE WHEN o_orderstatus = 'O' THEN '|O' ELSE '' END AS network_name,
         o_orderkey, o_custkey, o_orderstatus, (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS no_groups
  FROM orders),
pairs AS (
  SELECT *, 'ein' AS tin_type, CAST(o_custkey AS VARCHAR) AS tin_value, '' AS business_name,
         CAST(o_custkey AS VARCHAR) AS npi FROM base WHERE NOT no_groups
  UNION ALL
  SELECT *, 'npi', CAST(o_orderkey AS VARCHAR), 'Order ' || o_orderkey,
         CASE WHEN o_orderstatus <> 'F' THEN 'O' || o_orderkey END FROM base WHERE NOT no_groups
  UNION ALL
  SELECT *, '', '', '', NULL FROM base WHERE no_groups),
targets AS (SELECT CAST(c_custkey AS VARCHAR) AS npi FROM customer WHERE c_mktsegment = 'BUILDING'),
matched AS (
  SELECT DISTINCT source_pricing_file, provider_group_id FROM pairs
  WHERE provider_group_id IS NOT NULL AND npi IN (SELECT npi FROM targets))"""

_PROVIDER_COLUMNS = f"""source_pricing_file, provider_group_id, network_name, tin_type, tin_value,
       coalesce(npi, '') AS npi, business_name, {_LINEAGE_SQL.format(version="version")}"""

# Every price of the price view; ``refs`` is NULL for an item without rates.
_PRICE_SQL = f"""
lines AS (
  SELECT *, {_file_sql("l_shipdate")} AS source_pricing_file, {_header_sql("l_shipdate")},
         CAST(l_partkey AS VARCHAR) AS billing_code,
         CASE l_returnflag WHEN 'A' THEN 'CPT' WHEN 'R' THEN 'HCPCS' ELSE '' END AS billing_code_type,
         CAST(l_orderkey // 4 AS BIGINT) AS grp,
         NOT (l_returnflag = 'N' AND l_tax = 0) AS has_rates
  FROM lineitem),
prices AS (
  SELECT *, grp || '|' || l_suppkey || '|' || grp || '.5|' || grp AS refs, grp AS ref1, l_suppkey AS ref2,
         'negotiated' AS negotiated_type, l_extendedprice AS negotiated_rate, '9999-12-31' AS expiration_date,
         l_returnflag AS billing_class, l_linestatus || '|' || l_returnflag AS service_code,
         '' AS billing_code_modifier, '' AS additional_information, CAST(NULL AS DOUBLE) AS estimated_amount,
         CAST(l_linenumber AS VARCHAR) AS setting
  FROM lines WHERE has_rates AND l_discount > 0
  UNION ALL
  SELECT *, grp || '|' || l_suppkey || '|' || grp || '.5|' || grp, grp, l_suppkey,
         'derived', l_extendedprice * l_discount, '', '', '', l_linestatus, 'discounted', l_tax, ''
  FROM lines WHERE has_rates AND l_discount > 0
  UNION ALL
  SELECT *, grp || '|' || l_suppkey || '|' || grp || '.5|' || grp, grp, l_suppkey,
         '', NULL, '', '', '', '', '', NULL, ''
  FROM lines WHERE has_rates AND NOT (l_discount > 0)
  UNION ALL
  SELECT *, CAST(l_suppkey AS VARCHAR), l_suppkey, l_suppkey, 'percentage', l_tax, '', '', '', '', '', NULL, ''
  FROM lines WHERE has_rates AND l_quantity > 25
  UNION ALL
  SELECT *, NULL, NULL, NULL, '', NULL, '', '', '', '', '', NULL, ''
  FROM lines WHERE NOT has_rates)"""

_PRICE_COLUMNS = f"""source_pricing_file, reporting_entity_name, reporting_entity_type, last_updated_on, version,
       billing_code, billing_code_type, '' AS billing_code_type_version, 'Part ' || l_partkey AS name,
       '' AS description, 'ffs' AS negotiation_arrangement, '' AS severity_of_illness,
       coalesce(refs, '') AS provider_references, negotiated_type, negotiated_rate, expiration_date, billing_class,
       service_code, billing_code_modifier, additional_information, estimated_amount, setting,
       {_LINEAGE_SQL.format(version="version")}"""

_REF_MATCH = """EXISTS (SELECT 1 FROM matched m WHERE m.source_pricing_file = p.source_pricing_file
         AND m.provider_group_id IN (p.ref1, p.ref2))"""

_CODE_MATCH = "(starts_with(billing_code, '1') OR starts_with(billing_code, '25'))"


# ---------------------------------------------------------------- providers


@query("provider_flatten_full", f"WITH {_PROVIDER_SQL} SELECT {_PROVIDER_COLUMNS} FROM pairs")
def provider_flatten_full(spark, folder):
    return flatten.flatten_provider_references(views.provider_items(spark, folder), views.LINEAGE)


@query(
    "provider_flatten_filtered",
    f"WITH {_PROVIDER_SQL} SELECT {_PROVIDER_COLUMNS} FROM pairs WHERE npi IN (SELECT npi FROM targets)",
)
def provider_flatten_filtered(spark, folder):
    items, targets = views.provider_items(spark, folder), views.targets(spark, folder)
    return flatten.flatten_provider_references(items, views.LINEAGE, targets)


@query(
    "provider_keep_full",
    f"""WITH {_PROVIDER_SQL} SELECT {_PROVIDER_COLUMNS} FROM pairs WHERE npi IS NOT NULL
    AND CAST(o_custkey AS VARCHAR) IN (SELECT npi FROM targets)""",
)
def provider_keep_full(spark, folder):
    items, targets = views.provider_items(spark, folder), views.targets(spark, folder)
    return flatten.flatten_provider_references(items, views.LINEAGE, targets, keep_full=True)


@query("matched_groups", f"WITH {_PROVIDER_SQL} SELECT * FROM matched")
def matched_groups(spark, folder):
    return flatten.matched_groups(views.provider_items(spark, folder), views.targets(spark, folder))


@query(
    "semi_npi",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS npi FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_npi(spark, folder):
    orders = views.table(spark, folder, "orders")
    rows = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("npi"))
    return joins.semi_npi(rows, views.targets(spark, folder))


# ---------------------------------------------------------------- prices


def saved_groups(spark, folder):
    """Matched groups, computed once and kept as a table for the price side to read."""
    groups = flatten.matched_groups(views.provider_items(spark, folder), views.targets(spark, folder))
    return writers.save_matched_groups(groups, fresh_folder(spark, "matched-groups"))


def _filtered_prices(spark, folder, prefixes=()):
    items, groups = views.price_items(spark, folder), saved_groups(spark, folder)
    return flatten.flatten_in_network(
        items, views.LINEAGE, groups, prefixes, fresh_folder(spark, "matched-rates")
    )


def _provider_table(spark, folder):
    """The filtered provider table, written once as an extraction writes it, and the groups it holds."""
    rows = flatten.flatten_provider_references(
        views.provider_items(spark, folder), views.LINEAGE, views.targets(spark, folder)
    )
    providers = saved(rows, "providers")
    return providers, writers.save_matched_groups(flatten.groups_of(providers), fresh_folder(spark, "matched-groups"))


def _prices_of(spark, folder, groups):
    work = fresh_folder(spark, "matched-rates")
    return flatten.flatten_in_network(views.price_items(spark, folder), views.LINEAGE, groups, work=work)


@query("price_flatten_full", f"WITH {_PRICE_SQL} SELECT {_PRICE_COLUMNS} FROM prices")
def price_flatten_full(spark, folder):
    return flatten.flatten_in_network(views.price_items(spark, folder), views.LINEAGE)


@query(
    "price_flatten_filtered",
    f"WITH {_PROVIDER_SQL}, {_PRICE_SQL} SELECT {_PRICE_COLUMNS} FROM prices p WHERE {_REF_MATCH}",
)
def price_flatten_filtered(spark, folder):
    return _filtered_prices(spark, folder)


@query(
    "code_prefix",
    f"WITH {_PROVIDER_SQL}, {_PRICE_SQL} SELECT {_PRICE_COLUMNS} FROM prices p WHERE {_REF_MATCH} AND {_CODE_MATCH}",
)
def code_prefix(spark, folder):
    return _filtered_prices(spark, folder, PREFIXES)


_PROVIDER_TABLE_SQL = """SELECT source_pricing_file, provider_group_id, count(*) AS provider_rows,
       count(DISTINCT npi) AS npis FROM pairs WHERE npi IN (SELECT npi FROM targets)
       AND provider_group_id IS NOT NULL GROUP BY ALL"""


@query(
    "price_provider_join",
    f"""WITH {_PROVIDER_SQL}, {_PRICE_SQL},
    numbered AS MATERIALIZED (SELECT row_number() OVER () AS price_no, * FROM prices),
    refs AS (SELECT DISTINCT price_no, source_pricing_file, billing_code, negotiated_rate, ref FROM (
      SELECT *, ref1 AS ref FROM numbered UNION ALL SELECT *, ref2 FROM numbered))
    SELECT refs.source_pricing_file, billing_code, provider_group_id, pairs.npi, count(*) AS prices,
           round(max(negotiated_rate), 2) AS top_rate
    FROM refs JOIN pairs ON pairs.source_pricing_file = refs.source_pricing_file AND provider_group_id = ref
    WHERE pairs.npi IN (SELECT npi FROM targets)
    GROUP BY ALL""",
)
def price_provider_join(spark, folder):
    providers, groups = _provider_table(spark, folder)
    # Prices of other groups would meet no provider.
    prices = _prices_of(spark, folder, groups)
    pairs = joins.price_with_provider(prices, providers)
    return pairs.groupBy("source_pricing_file", "billing_code", "provider_group_id", "npi").agg(
        F.count(F.lit(1)).alias("prices"), F.round(F.max("negotiated_rate"), 2).alias("top_rate")
    )


def rates_by_code(spark, folder):
    """Average negotiated rate per billing code over the prices of groups with a target.

    Providers are counted per (file, group) before they meet the prices, so the join adds
    no rows beyond one per reference.
    """
    providers, groups = _provider_table(spark, folder)
    grouped = providers.groupBy("source_pricing_file", "provider_group_id").agg(
        F.count_distinct("npi").alias("npis")
    )
    prices = _prices_of(spark, folder, groups)
    ids = F.array_distinct(S.safe_ints(F.split("provider_references", r"\|")))
    refs = prices.select(
        "source_pricing_file", "billing_code", "negotiated_rate", F.explode(ids).alias("provider_group_id")
    )
    return (
        refs.join(grouped, ["source_pricing_file", "provider_group_id"])
        .groupBy("billing_code")
        .agg(
            F.count("negotiated_rate").alias("rates"),
            F.round(F.avg("negotiated_rate"), 4).alias("average_rate"),
            F.sum("npis").alias("provider_links"),
        )
    )


query(
    "rates_by_code",
    f"""WITH {_PROVIDER_SQL}, {_PRICE_SQL}, providers AS ({_PROVIDER_TABLE_SQL}),
    numbered AS MATERIALIZED (SELECT row_number() OVER () AS price_no, * FROM prices),
    refs AS (SELECT DISTINCT price_no, source_pricing_file, billing_code, negotiated_rate, ref FROM (
      SELECT *, ref1 AS ref FROM numbered UNION ALL SELECT *, ref2 FROM numbered))
    SELECT billing_code, count(negotiated_rate) AS rates, round(avg(negotiated_rate), 4) AS average_rate,
           CAST(sum(npis) AS BIGINT) AS provider_links
    FROM refs JOIN providers ON providers.source_pricing_file = refs.source_pricing_file
      AND provider_group_id = ref
    GROUP BY billing_code""",
)(rates_by_code)


# ---------------------------------------------------------------- out of network and index


@query(
    "oon_flatten",
    f"""SELECT {_file_sql("l_shipdate")} AS source_pricing_file, {_header_sql("l_shipdate")},
       CAST(l_partkey AS VARCHAR) AS billing_code, 'CPT' AS billing_code_type, '' AS billing_code_type_version,
       '' AS name, '' AS description, 'ein' AS tin_type, CAST(l_suppkey AS VARCHAR) AS tin_value,
       l_linestatus AS service_code, l_returnflag AS billing_class,
       CASE WHEN l_discount > 0 THEN l_quantity END AS allowed_amount,
       CASE WHEN copy = 1 AND l_discount > 0 AND l_tax > 0 THEN l_extendedprice END AS billed_charge,
       CASE WHEN copy = 1 AND l_discount > 0 AND l_tax > 0 THEN l_suppkey || '|' || l_partkey ELSE '' END AS npi
    FROM lineitem JOIN (SELECT unnest([1, 2]) AS copy) c ON copy = 1 OR (l_discount > 0 AND l_tax > 0)
    WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O')""",
)
def oon_flatten(spark, folder):
    return flatten.flatten_out_of_network(views.out_of_network_items(spark, folder))


_PLACE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'ppo_TX_' WHEN '2-HIGH' THEN 'ppo-al-'
    WHEN '3-MEDIUM' THEN 'Texas_choice' WHEN '4-NOT SPECIFIED' THEN 'alabama_texas_dental' ELSE 'arkansas-hmo' END"""

BRIDGE_SQL = f"""
plans AS (
  SELECT o_orderkey, 'Group|' || o_orderpriority AS plan_name, CAST(o_custkey AS VARCHAR) AS plan_id,
         'EIN' AS plan_id_type, 'group' AS plan_market_type, 'Sponsor ' || o_custkey AS plan_sponser_name,
         NULL AS issuer_name FROM orders
  UNION ALL
  SELECT o_orderkey, NULL, CAST(o_orderkey AS VARCHAR), 'HIOS', o_orderstatus, 'Main', 'Issuer'
  FROM orders WHERE o_orderstatus <> 'P'),
files AS (
  SELECT o_orderkey, 'in-network' AS description,
         'https://cdn.example.com/' || strftime(o_orderdate, '%Y-%m') || '/' || {_PLACE_SQL}
         || CAST(floor(o_custkey / 10) AS BIGINT) || '.json.gz' AS location FROM orders
  UNION ALL
  SELECT o_orderkey, NULL, 'https://cdn.example.com/shared/national-ppo.json.gz'
  FROM orders WHERE o_orderstatus = 'O'),
bridge AS (
  SELECT 'Entity|' || o_orderstatus AS reporting_entity_name, CAST(NULL AS VARCHAR) AS reporting_entity_type,
         strftime(o_orderdate, '%Y-%m') || '-01' AS last_updated_on, plan_name, plan_id, plan_id_type,
         plan_market_type, plan_sponser_name, issuer_name, description, location,
         'index_' || o.o_orderkey || '.json' AS source_index_file, {_LINEAGE_SQL.format(version="'1.3'")}
  FROM orders o JOIN plans USING (o_orderkey) JOIN files USING (o_orderkey))"""


@query("bridge_cross", f"WITH {BRIDGE_SQL} SELECT * FROM bridge")
def bridge_cross(spark, folder):
    return flatten.flatten_index(views.index_documents(spark, folder), views.LINEAGE)


# ---------------------------------------------------------------- header, lineage, lists


@query(
    "header_project",
    f"SELECT {_file_sql('o_orderdate')} AS source_pricing_file, {_header_sql('o_orderdate')} FROM orders",
)
def header_project(spark, folder):
    items = views.provider_items(spark, folder)
    return flatten.header_fields(items.drop("item", "ordinal"))


@query(
    "lineage_stamp",
    f"SELECT o_orderkey, {_version_sql('o_orderdate')} AS version, "
    f"{_LINEAGE_SQL.format(version=_version_sql('o_orderdate'))} FROM orders",
)
def lineage_stamp(spark, folder):
    orders = views.table(spark, folder, "orders")
    version = F.when(F.year("o_orderdate") >= 1998, F.lit("2.0")).otherwise("")
    return flatten.with_lineage(orders.select("o_orderkey", version.alias("version")), views.LINEAGE)


@query(
    "list_join",
    """SELECT o_orderkey, o_orderpriority || CASE WHEN o_orderstatus = 'O' THEN '|O' ELSE '' END AS joined
    FROM orders""",
)
def list_join(spark, folder):
    orders = views.table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    parts = F.array("o_orderpriority", F.when(status == "F", F.lit("")).when(status == "O", status))
    return orders.select("o_orderkey", S.list_join(parts).alias("joined"))


@query(
    "poly_list",
    """SELECT event_id, CASE event_type WHEN 'click' THEN event_type || '|' || user_id WHEN 'view' THEN ''
    ELSE event_type END AS joined, CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN -1 ELSE 1 END AS entries
    FROM events""",
)
def poly_list(spark, folder):
    """Scalars, lists and nulls in one text column, as the JSON reader hands them over."""
    events = views.table(spark, folder, "events")
    kind = F.col("event_type")
    listed = F.to_json(
        F.array(kind, F.col("user_id").cast("string"), F.lit(None).cast("string")), {"ignoreNullFields": "false"}
    )
    text = F.when(kind == "click", listed).when(kind != "view", kind)
    parsed = S.poly_list(text)
    return events.select(
        "event_id",
        S.list_join(parsed).alias("joined"),
        F.when(parsed.isNull(), F.lit(-1)).otherwise(F.size(parsed)).alias("entries"),
    )


@query(
    "safe_cast",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k_int,
       CASE event_type WHEN 'error' THEN NULL ELSE value END AS value_float,
       CAST(NULL AS BIGINT) AS value_int FROM events""",
)
def safe_cast(spark, folder):
    events = views.table(spark, folder, "events")
    text = F.col("value").cast("string")
    shown = F.when(F.col("event_type") == "error", F.concat(text, F.lit("f"))).otherwise(
        F.concat(F.lit(" "), text)
    )
    return events.select(
        "event_id",
        S.safe_int(F.get_json_object("props", "$.k")).alias("k_int"),
        S.safe_float(shown).alias("value_float"),
        S.safe_int(F.concat(text, F.lit("x"))).alias("value_int"),
    )


@query(
    "coalesce_blank",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Fallback ' || o_custkey
       WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS sponsor FROM orders""",
)
def coalesce_blank(spark, folder):
    orders = views.table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    plan = F.struct(
        F.when(status == "F", F.lit("")).when(status == "O", F.col("o_orderpriority")).alias("plan_sponsor_name"),
        F.when(status != "P", F.concat(F.lit("Fallback "), F.col("o_custkey").cast("string"))).alias(
            "plan_sponser_name"
        ),
    )
    named = orders.select("o_orderkey", plan.alias("plan"))
    return named.select("o_orderkey", S.sponsor_name(F.col("plan")).alias("sponsor"))


# ---------------------------------------------------------------- through element text


def _as_elements(items, section):
    """Element rows as a document scan gives them: JSON text, and one header row per file."""
    fields = ("source_pricing_file", "section", "ordinal", "element_json")
    # The header of a file is on each of its rows, so the distinct rows are one per file.
    header = items.select("source_pricing_file", *schemas.HEADER_FIELDS).distinct()
    header = header.withColumns(
        {
            "section": F.lit("header"),
            "ordinal": F.lit(0).cast("bigint"),
            "element_json": F.to_json(F.struct(*schemas.HEADER_FIELDS)),
        }
    )
    body = items.withColumns(
        {"section": F.lit(section), "ordinal": F.xxhash64("ordinal"), "element_json": F.to_json("item")}
    )
    return header.select(*fields).unionByName(body.select(*fields))


@query("provider_from_elements", f"WITH {_PROVIDER_SQL} SELECT {_PROVIDER_COLUMNS} FROM pairs")
def provider_from_elements(spark, folder):
    elements = _as_elements(views.provider_items(spark, folder), "provider_references")
    items = rate_files.items_from_elements(elements, "provider_references")
    return flatten.flatten_provider_references(items, views.LINEAGE)


@query("price_from_elements", f"WITH {_PRICE_SQL} SELECT {_PRICE_COLUMNS} FROM prices")
def price_from_elements(spark, folder):
    elements = _as_elements(views.price_items(spark, folder), "in_network")
    items = rate_files.items_from_elements(elements, "in_network")
    return flatten.flatten_in_network(items, views.LINEAGE)


# ---------------------------------------------------------------- through whole documents

#: Elements of a landed document; the number of documents follows the input.
DOCUMENT_ELEMENTS = 20_000


def land_documents(items, section, path):
    """Write items as whole rate documents, one JSON object per file.

    Elements are hashed to documents, and each document is written as its opening line, one
    line per element, and its closing line; no document is ever held as one value.
    """
    spark = items.sparkSession
    documents = items.count() // DOCUMENT_ELEMENTS + 2
    body = items.select(
        F.pmod(F.xxhash64("ordinal"), F.lit(documents)).alias("document"),
        F.lit(1).alias("part"),
        F.concat(F.lit(","), F.to_json("item")).alias("value"),
    )
    ids = spark.range(documents).select(F.col("id").alias("document"))
    opening = '{"reporting_entity_name": "Entity", "%s": [null' % section
    first = ids.select("document", F.lit(0).alias("part"), F.lit(opening).alias("value"))
    last = ids.select("document", F.lit(2).alias("part"), F.lit('], "version": "2.0"}').alias("value"))
    lines = first.unionByName(body).unionByName(last)
    ordered = lines.repartition(documents, "document").sortWithinPartitions("document", "part")
    ordered.drop("part").write.mode("append").partitionBy("document").text(path)


_LANDED_SQL = f"""provider_group_id, network_name, tin_type, tin_value, coalesce(npi, '') AS npi,
    business_name, {_LINEAGE_SQL.format(version="'2.0'")}"""


@query("incremental_load", f"WITH {_PROVIDER_SQL} SELECT {_LANDED_SQL} FROM pairs")
def incremental_load(spark, folder):
    """Documents land in two batches and are loaded three times; each row arrives once."""
    base = fresh_folder(spark, "incremental")
    items = views.provider_items(spark, folder)
    late = F.col("version").isNull()
    for batch in (items.where(late), items.where(~late), None):
        if batch is not None:
            land_documents(batch, "provider_references", f"{base}/landing")
        load_incremental(
            spark, f"{base}/landing", f"{base}/tables", f"{base}/ledger", f"{base}/work", views.LINEAGE
        )
    written = lists.read_table(spark, f"{base}/tables/tic_provider_reference", "tic_provider_reference")
    return written.drop("source_pricing_file")


@query(
    "section_scan",
    """SELECT 'provider_references' AS section, count(*) AS elements,
       count(*) AS distinct_places FROM orders""",
)
def section_scan(spark, folder):
    """Elements found in whole documents; no two are at the same place."""
    path = fresh_folder(spark, "documents")
    land_documents(views.provider_items(spark, folder), "provider_references", path)
    files = rate_files.list_documents(spark, path)
    elements = rate_files.explode_rate_sections(files)
    data = elements.where(F.col("section") != "header")
    return data.groupBy("section").agg(
        F.count(F.lit(1)).alias("elements"),
        F.count_distinct("source_pricing_file", "ordinal").alias("distinct_places"),
    )


@query("long_items", f"WITH {_PROVIDER_SQL} SELECT {_LANDED_SQL} FROM pairs")
def long_items(spark, folder):
    """Whole documents whose items are longer than allowed, so that each is told in pieces of its groups."""
    path = fresh_folder(spark, "long-items")
    land_documents(views.provider_items(spark, folder), "provider_references", path)
    elements = rate_files.explode_rate_sections(rate_files.list_documents(spark, path), item_bytes=64)
    items = rate_files.items_from_elements(elements, "provider_references")
    return flatten.flatten_provider_references(items, views.LINEAGE).drop("source_pricing_file")


# ---------------------------------------------------------------- signals and counters

_SIGNALS_SQL = f"""{_PROVIDER_SQL}, {_PRICE_SQL},
signals AS (
  SELECT source_pricing_file, bool_or(npi_hit) AS npi_hit, bool_or(code_hit) AS code_hit FROM (
    SELECT source_pricing_file, coalesce(npi IN (SELECT npi FROM targets), FALSE) AS npi_hit, FALSE AS code_hit
    FROM pairs
    UNION ALL SELECT source_pricing_file, FALSE, starts_with(billing_code, '199') FROM lines)
  GROUP BY 1)"""


def _signals(spark, folder):
    return selection.file_signals(
        views.provider_items(spark, folder),
        views.price_items(spark, folder),
        views.targets(spark, folder),
        ("199",),
    )


@query("file_signals", f"WITH {_SIGNALS_SQL} SELECT * FROM signals")
def file_signals(spark, folder):
    return _signals(spark, folder)


_CANDIDATES_SQL = f"""candidates AS (
  SELECT {_file_sql("o_orderdate")} AS location, CAST(floor(sum(o_totalprice) / 1000) AS BIGINT) AS size_bytes
  FROM orders GROUP BY 1
  UNION ALL
  SELECT 'https://elsewhere.example.com/' || o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN NULL
         ELSE 5 END FROM orders GROUP BY o_orderpriority)"""


def _candidates(spark, folder):
    """Files of the view with sizes, and some that nothing is known of."""
    orders = views.table(spark, folder, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    own = orders.groupBy(
        F.concat(F.lit("https://rates.example.com/"), month, F.lit("/in-network.json.gz")).alias("location")
    ).agg(F.floor(F.sum("o_totalprice") / 1000).cast("bigint").alias("size_bytes"))
    priority = F.col("o_orderpriority")
    other = orders.select(
        F.concat(F.lit("https://elsewhere.example.com/"), priority).alias("location"),
        F.when(priority != "1-URGENT", F.lit(5)).cast("bigint").alias("size_bytes"),
    ).distinct()
    return own.unionByName(other)


def _select_sql(mode: str, matched: str, signal: str) -> str:
    return f"""SELECT '{mode}' AS mode, location, c.size_bytes,
      size_bytes IS NOT NULL AND size_bytes <= 45000 AND ({matched}) AS matched,
      CASE WHEN size_bytes IS NULL THEN 'no size'
           WHEN size_bytes > 45000 THEN 'too large (' || format('{{:,}}', size_bytes) || ' bytes)'
           ELSE {signal} END AS signal FROM flags c"""


@query(
    "select_signal",
    f"""WITH {_SIGNALS_SQL}, {_CANDIDATES_SQL}, flags AS (
      SELECT location, size_bytes, coalesce(npi_hit, FALSE) AS n, coalesce(code_hit, FALSE) AS k
      FROM candidates LEFT JOIN signals ON source_pricing_file = location)
    {_select_sql("any", "n OR k", "CASE WHEN n THEN 'NPI+code' WHEN k THEN 'code' ELSE 'no match' END")}
    UNION ALL {_select_sql("npi_only", "n", "CASE WHEN n THEN 'NPI' ELSE 'no NPI match' END")}
    UNION ALL {_select_sql("code_only", "k", "CASE WHEN k THEN 'code' ELSE 'no code match' END")}
    UNION ALL {
        _select_sql(
            "require_both",
            "n AND k",
            "CASE WHEN NOT n THEN 'no NPI match' WHEN k THEN 'NPI+code' ELSE 'NPI=yes, code=no' END",
        )
    }""",
)
def select_signal(spark, folder):
    candidates = saved(_candidates(spark, folder), "candidates")
    signals = saved(_signals(spark, folder), "signals")
    parts = None
    for mode in selection.MODES:
        part = selection.select_files(candidates, signals, mode, max_bytes=45_000)
        part = part.withColumn("mode", F.lit(mode))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    "run_counters",
    f"""WITH {_PROVIDER_SQL}, {_PRICE_SQL}, counted AS (
      SELECT source_pricing_file, 'refs' AS what, count(*) AS n FROM base GROUP BY 1
      UNION ALL SELECT source_pricing_file, 'rows', count(*) FROM pairs WHERE npi IN (SELECT npi FROM targets) GROUP BY 1
      UNION ALL SELECT source_pricing_file, 'groups', count(*) FROM matched GROUP BY 1
      UNION ALL SELECT source_pricing_file, 'items', count(*) FROM lines GROUP BY 1
      UNION ALL SELECT source_pricing_file, 'prices', count(*) FROM prices p WHERE {_REF_MATCH} GROUP BY 1)
    SELECT source_pricing_file,
      CAST(coalesce(sum(n) FILTER (what = 'refs'), 0) AS BIGINT) AS refs_scanned,
      CAST(coalesce(sum(n) FILTER (what = 'rows'), 0) AS BIGINT) AS provider_rows,
      CAST(coalesce(sum(n) FILTER (what = 'groups'), 0) AS BIGINT) AS matched_groups,
      CAST(coalesce(sum(n) FILTER (what = 'items'), 0) AS BIGINT) AS items_scanned,
      CAST(coalesce(sum(n) FILTER (what = 'prices'), 0) AS BIGINT) AS price_rows
    FROM counted GROUP BY 1""",
)
def run_counters(spark, folder):
    providers, groups = _provider_table(spark, folder)
    return audit.run_counters(
        views.provider_items(spark, folder),
        views.price_items(spark, folder),
        providers,
        groups,
        _prices_of(spark, folder, groups),
    )
