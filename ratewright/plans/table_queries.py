"""Queries for URLs, lists, manifests, shards, the registry and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewright.functions import predicates as P
from ratewright.functions import scalars as S
from ratewright.operators import discovery, flatten, joins, registry, selection, shards
from ratewright.plans import views
from ratewright.plans.catalog import query
from ratewright.plans.flatten_queries import BRIDGE_SQL
from ratewright.session import saved
from ratewright.sources import lists, writers

# ---------------------------------------------------------------- URLs

_PAGE_SQL = """pages_damaged AS (SELECT page_id, CASE
    WHEN contains(url, '/fr/') AND starts_with(url, 'https:') THEN 'TPS' || substr(url, 6)
    WHEN contains(url, '/de/') THEN 'ttp' || regexp_replace(url, '^https?', '') ELSE url END AS url FROM pages)"""

_FILE_SQL = """parts AS (SELECT *, CASE lang WHEN 'en' THEN 'Main-Index-' WHEN 'de' THEN 'in-network-'
      WHEN 'fr' THEN 'Allowed%5Famount-' ELSE 'other+' END AS kind,
    CASE WHEN n_chars > 1000 THEN '.JSON.gz' WHEN n_chars > 300 THEN '.json' ELSE '.csv' END AS suffix
    FROM documents),
  files AS (SELECT *, 'https://Files.example.com:8443/tic/' || source || '/' || kind || doc_id || suffix
    || '?sv=1&sig=a%2Bb+c&n=' || n_chars AS url FROM parts)"""


@query(
    "url_repair",
    f"""WITH {_PAGE_SQL} SELECT page_id, CASE WHEN starts_with(url, 'TPS:') THEN 'ht' || url
    WHEN starts_with(url, 'ttp:') THEN 'h' || url ELSE url END AS url FROM pages_damaged""",
)
def url_repair(spark, folder):
    return views.page_urls(spark, folder).select("page_id", S.repair_url("url").alias("url"))


@query(
    "supported_source",
    f"WITH {_PAGE_SQL} SELECT page_id, NOT regexp_matches(url, '^(TPS|ttp):') AS supported FROM pages_damaged",
)
def supported_source(spark, folder):
    return views.page_urls(spark, folder).select("page_id", P.is_supported(S.strip("url")).alias("supported"))


@query(
    "url_filename",
    f"WITH {_FILE_SQL} SELECT doc_id, replace(kind, '%5F', '_') || doc_id || suffix AS filename FROM files",
)
def url_filename(spark, folder):
    return views.file_urls(spark, folder).select("doc_id", S.url_filename("url").alias("filename"))


@query(
    "source_name",
    f"""WITH {_FILE_SQL} SELECT doc_id, 'Files_example_com_8443__' || replace(replace(kind, '%', '_'), '+', '_')
    || doc_id || CASE suffix WHEN '.csv' THEN '_csv' ELSE '' END AS source_name FROM files""",
)
def source_name(spark, folder):
    return views.file_urls(spark, folder).select("doc_id", S.source_name("url").alias("source_name"))


@query("file_key", f"WITH {_FILE_SQL} SELECT doc_id, substr(sha256(url), 1, 24) AS file_key FROM files")
def file_key(spark, folder):
    return views.file_urls(spark, folder).select("doc_id", S.file_key("url").alias("file_key"))


@query("is_index", f"WITH {_FILE_SQL} SELECT doc_id, url FROM files WHERE kind = 'Main-Index-' AND suffix <> '.csv'")
def is_index(spark, folder):
    return views.file_urls(spark, folder).where(P.is_index("url"))


@query("not_pricing_name", f"WITH {_FILE_SQL} SELECT doc_id, url FROM files WHERE lang NOT IN ('de', 'fr')")
def not_pricing_name(spark, folder):
    return views.file_urls(spark, folder).where(P.not_pricing_name("url"))


@query(
    "seed_parse",
    f"""WITH {_FILE_SQL} SELECT doc_id, 'https://Files.example.com:8443' AS base_url, 'tic' AS container,
    source || '/' AS prefix, 'sv=1;sig=a+b c;n=' || n_chars AS params FROM files""",
)
def seed_parse(spark, folder):
    seeds = views.file_urls(spark, folder).select("doc_id", S.parse_seed_url("url").alias("seed"))
    pairs = F.transform("seed.params", lambda p: F.concat(p["key"], F.lit("="), p["value"]))
    return seeds.select(
        "doc_id", "seed.base_url", "seed.container", "seed.prefix", F.array_join(pairs, ";").alias("params")
    )


@query(
    "url_build",
    f"""WITH {_FILE_SQL} SELECT doc_id, 'https://Files.example.com:8443/tic/' || source || '/my%20file~%2A%28'
    || doc_id || '%29.json?sv=1&sig=a%2Bb+c&n=' || n_chars AS url FROM files""",
)
def url_build(spark, folder):
    seeds = views.file_urls(spark, folder).select("doc_id", S.parse_seed_url("url").alias("seed"))
    name = F.concat(F.col("seed.prefix"), F.lit("my file~*("), F.col("doc_id").cast("string"), F.lit(").json"))
    url = S.blob_url(F.col("seed.base_url"), F.col("seed.container"), name, F.col("seed.params"))
    return seeds.select("doc_id", url.alias("url"))


@query("url_contains", "SELECT page_id, url FROM pages WHERE url ILIKE '%BLOG.%' OR url ILIKE '%pills%'")
def url_contains(spark, folder):
    pages = views.table(spark, folder, "pages").select("page_id", "url")
    return pages.where(P.url_contains("url", ("BLOG.", "pills")))


@query("url_skip", "SELECT page_id, url FROM pages WHERE NOT (url ILIKE '%/EN/%' OR url ILIKE '%spam_farm%')")
def url_skip(spark, folder):
    pages = views.table(spark, folder, "pages").select("page_id", "url")
    return pages.where(P.url_skip("url", ("/EN/", "spam_farm")))


SKIPPED, TARGETED = ("Alabama", "Kansas", "Zanzibar"), ("Texas",)

_STATE_SQL = """NOT ((location ILIKE '%alabama%' OR regexp_matches(location, '[-_]AL[-_]', 'i')
      OR location ILIKE '%kansas%' OR regexp_matches(location, '[-_]KS[-_]', 'i')
      OR location ILIKE '%zanzibar%' OR regexp_matches(location, '[-_]ZA[-_]', 'i'))
    AND NOT (location ILIKE '%texas%' OR regexp_matches(location, '[-_]TX[-_]', 'i')))"""


def _bridge(spark, folder):
    return flatten.flatten_index(views.index_documents(spark, folder), views.LINEAGE)


@query(
    "url_state_rule",
    f"WITH {BRIDGE_SQL} SELECT source_index_file, plan_id, location FROM bridge WHERE {_STATE_SQL}",
)
def url_state_rule(spark, folder):
    rows = _bridge(spark, folder).select("source_index_file", "plan_id", "location")
    return rows.where(P.state_rule("location", SKIPPED, TARGETED))


LAYERS = selection.UrlFilter(
    contains=("CDN.example",),
    must_contain=("ppo", "choice", "dental"),
    skip=("dental1",),
    skip_states=SKIPPED,
    target_states=TARGETED,
)

_PREFILTER_SQL = f"""{BRIDGE_SQL}, urls AS (
  SELECT location, coalesce(replace(min(plan_name), '|', ' '), '') AS plan_name,
         coalesce(replace(min(reporting_entity_name), '|', ' '), '') AS reporting_entity_name
  FROM bridge WHERE location <> '' AND location ILIKE '%cdn.example%' AND location NOT ILIKE '%dental1%'
    AND (location ILIKE '%ppo%' OR location ILIKE '%choice%' OR location ILIKE '%dental%') AND {_STATE_SQL}
  GROUP BY location)"""


@query("url_prefilter", f"WITH {_PREFILTER_SQL} SELECT * FROM urls")
def url_prefilter(spark, folder):
    return selection.prefilter_urls(_bridge(spark, folder), LAYERS)


@query("scan_limit", f"WITH {_PREFILTER_SQL} SELECT * FROM urls ORDER BY location LIMIT 100")
def scan_limit(spark, folder):
    return selection.scan_limit(selection.prefilter_urls(_bridge(spark, folder), LAYERS, ordered=False), 100)


# ---------------------------------------------------------------- manifests and shards

_MANIFEST_SQL = """manifest AS (SELECT 'https://host.example.com/' || o_orderkey || '.json.gz' AS url,
    CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS size_bytes,
    o_orderstatus AS signal, replace(o_orderpriority, '-', '|') AS reporting_entity_name FROM orders)"""

_SHARD_SQL = f"""{_MANIFEST_SQL}, ranked AS (SELECT *,
      row_number() OVER (ORDER BY size_bytes DESC, substr(sha256(url), 1, 24), url) - 1 AS r FROM manifest),
    sharded AS (SELECT url, size_bytes, CAST(CASE WHEN (r // 10) % 2 = 1 THEN 10 - r % 10 ELSE r % 10 + 1 END AS INTEGER)
      AS shard FROM ranked)"""


@query("size_limit", f"WITH {_MANIFEST_SQL} SELECT * FROM manifest WHERE size_bytes <= 200000")
def size_limit(spark, folder):
    return views.manifest(spark, folder).where(P.within_size("size_bytes", max_bytes=1, max_gb=0.0002))


@query("shard_serpentine", f"WITH {_SHARD_SQL} SELECT * FROM sharded")
def shard_serpentine(spark, folder):
    manifest = views.manifest(spark, folder).select("url", "size_bytes")
    return shards.assign_shards(manifest, 10)


@query(
    "shard_load",
    f"WITH {_SHARD_SQL} SELECT shard, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM sharded GROUP BY 1",
)
def shard_load(spark, folder):
    manifest = views.manifest(spark, folder).select("url", "size_bytes")
    return shards.shard_load(shards.assign_shards(manifest, 10))


@query(
    "manifest_lines",
    f"""WITH {_MANIFEST_SQL} SELECT url, size_bytes, signal,
    replace(reporting_entity_name, '|', ' ') AS reporting_entity_name, 'UHC' AS payer_code,
    url || '|' || size_bytes || '|' || signal || '|' || replace(reporting_entity_name, '|', ' ') || '|UHC' AS raw_line
    FROM manifest""",
)
def manifest_lines(spark, folder):
    """Manifest rows to lines and back."""
    manifest = views.manifest(spark, folder).withColumn("payer_code", F.lit("UHC"))
    return lists.parse_manifest(manifest.select(writers.manifest_line(manifest).alias("value")))


@query(
    "payer_union",
    f"""WITH {_MANIFEST_SQL} SELECT *, CASE signal WHEN 'O' THEN 'UHC' WHEN 'F' THEN 'CIGNA' ELSE 'AETNA' END
    AS payer_code FROM manifest""",
)
def payer_union(spark, folder):
    manifest = views.manifest(spark, folder)
    codes = {"UHC": "O", "CIGNA": "F", "AETNA": "P"}
    return joins.unify_payers({code: manifest.where(F.col("signal") == s) for code, s in codes.items()})


# ---------------------------------------------------------------- sets and anti-joins


@query(
    "target_union",
    """SELECT CAST(c_custkey AS VARCHAR) AS npi FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'""",
)
def target_union(spark, folder):
    orders = views.table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    explicit = orders.select(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit("\t")).alias("npi"))
    return joins.target_npis(views.targets(spark, folder), explicit)


@query("distinct_npi", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS npi FROM orders WHERE o_orderstatus = 'O'")
def distinct_npi(spark, folder):
    orders = views.table(spark, folder, "orders")
    status, key = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    npi = F.when(status == "O", F.concat(F.lit(" "), key)).when(status == "F", F.lit("  "))
    return selection.distinct_npis(orders.select(npi.alias("npi")), ordered=True)


@query(
    "resume_anti",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def resume_anti(spark, folder):
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.not_done(orders, views.table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey")


# ---------------------------------------------------------------- discovery


@query(
    "catalog_select",
    """SELECT 'https://mrf.example.com/cat/' || path AS url, min(o_orderkey) AS ordinal FROM (
      SELECT o_orderkey, o_orderdate, o_orderpriority,
        CASE WHEN o_orderstatus = 'F' THEN '1998-0' || (1 + o_custkey // 1000) ELSE 'idx' END || '/' || o_custkey || '.json'
        AS path FROM orders WHERE o_orderstatus <> 'P')
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND (strftime(o_orderdate, '%Y-%m') = '1998-01' OR starts_with(path, '1998-01'))
    GROUP BY 1""",
)
def catalog_select(spark, folder):
    """Catalogue entries from the orders; paths repeat, some are blank."""
    orders = views.table(spark, folder, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    month = F.concat(F.lit("1998-0"), (F.floor(F.col("o_custkey") / 1000) + 1).cast("string"))
    directory = F.when(status == "F", month).otherwise(F.lit("/idx"))
    path = F.concat(directory, F.lit("/"), F.col("o_custkey").cast("string"), F.lit(".json"))
    entries = orders.select(
        F.when(priority == "1-URGENT", F.lit("Table_of_Contents"))
        .when(priority == "2-HIGH", F.lit("TABLE_OF_CONTENTS"))
        .when(priority == "3-MEDIUM", F.lit("IN_NETWORK_RATES"))
        .alias("fileSchema"),
        F.when(status != "P", path).otherwise(F.lit("")).alias("filePath"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastUpdatedOn"),
        F.col("o_orderkey").alias("ordinal"),
    )
    return discovery.catalog_select(entries, "https://mrf.example.com/cat", month="1998-01")


@query(
    "listing_select",
    """SELECT strftime(o_orderdate, '%Y-%m') || '-01/Index ' || o_orderkey || '.json' AS name,
    CAST(floor(o_totalprice) AS BIGINT) AS size_bytes FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') = '1998-03' AND o_orderstatus = 'O'""",
)
def listing_select(spark, folder):
    orders = views.table(spark, folder, "orders")
    kind = F.when(F.col("o_orderstatus") == "O", F.lit("Index ")).otherwise(F.lit("rates "))
    name = F.concat(
        S.month_prefix(F.date_format("o_orderdate", "yyyy-MM")), kind, F.col("o_orderkey").cast("string"), F.lit(".json")
    )
    listing = orders.select(name.alias("name"), F.floor("o_totalprice").cast("bigint").alias("size_bytes"))
    return discovery.listing_select(listing, "1998-03")


@query(
    "size_from_headers",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice) AS BIGINT)
      WHEN o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderpriority = '2-HIGH' THEN 0
      ELSE o_orderkey END AS size_bytes FROM orders""",
)
def size_from_headers(spark, folder):
    orders = views.table(spark, folder, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    length = (
        F.when(status == "O", F.floor("o_totalprice").cast("bigint").cast("string"))
        .when(priority == "1-URGENT", F.lit("many"))
        .when(status == "F", F.lit(""))
    )
    tail = F.when(priority == "2-HIGH", F.lit("zz")).otherwise(F.lower(F.hex("o_orderkey")))
    etag = F.concat(F.lit('W/"0x8DC-'), tail, F.lit('"'))
    headers = orders.select("o_orderkey", length.alias("content_length"), etag.alias("etag"))
    return headers.select("o_orderkey", S.size_from_headers("content_length", "etag").alias("size_bytes"))


# ---------------------------------------------------------------- registry

_REGISTRY_SQL = """reg AS (SELECT *, CASE WHEN c_acctbal > 1000 THEN n_name ELSE '' END AS practice,
    CASE WHEN c_acctbal > 3000 AND NOT c_acctbal > 6000 THEN 'T' || n_nationkey
         WHEN c_acctbal > 7000 THEN 'T' || n_nationkey ELSE 'S-' || c_mktsegment END AS taxonomy_code
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
  tax AS (SELECT 'T' || n_nationkey AS code, r_name, n_name AS t_name FROM nation
    JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'),
  coded AS (SELECT reg.*, coalesce(r_name, '') AS taxonomy_grouping, coalesce(t_name, '') AS taxonomy_classification,
    '' AS taxonomy_specialization, coalesce('Practice in ' || t_name, '') AS display_name
    FROM reg LEFT JOIN tax ON code = taxonomy_code)"""

_RECORD_SQL = """CAST(c_custkey AS VARCHAR) AS npi,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Individual' ELSE 'Organization' END AS entity_type, c_name AS org_name,
    'L ' || c_mktsegment AS last_name, '' AS first_name, practice AS practice_state, n_name AS mailing_state,
    taxonomy_code, taxonomy_grouping, taxonomy_classification, taxonomy_specialization, display_name"""


def _coded(spark, folder):
    rows = views.registry(spark, folder)
    return rows.withColumn("taxonomy_code", registry.primary_taxonomy(F.col("slots"))).drop("slots")


@query("primary_slot", f"WITH {_REGISTRY_SQL} SELECT CAST(c_custkey AS VARCHAR) AS npi, taxonomy_code FROM reg")
def primary_slot(spark, folder):
    return _coded(spark, folder).select(S.strip("npi").alias("npi"), "taxonomy_code")


@query("active_only", "SELECT CAST(c_custkey AS VARCHAR) AS npi FROM customer WHERE NOT c_acctbal < 0")
def active_only(spark, folder):
    return registry.active_only(views.registry(spark, folder)).select(S.strip("npi").alias("npi"))


@query(
    "state_filter",
    "SELECT CAST(c_custkey AS VARCHAR) AS npi FROM customer WHERE c_nationkey IN (3, 7, 24)",
)
def state_filter(spark, folder):
    rows = registry.in_states(views.registry(spark, folder), ("nation_3", " NATION_7", "Nation_24"))
    return rows.select(S.strip("npi").alias("npi"))


@query(
    "taxonomy_join",
    f"""WITH {_REGISTRY_SQL} SELECT CAST(c_custkey AS VARCHAR) AS npi, taxonomy_code, taxonomy_grouping,
    taxonomy_classification, taxonomy_specialization, display_name FROM coded""",
)
def taxonomy_join(spark, folder):
    rows = registry.with_taxonomy(_coded(spark, folder), views.taxonomy(spark, folder))
    return rows.select(S.strip("npi").alias("npi"), "taxonomy_code", *registry.TAXONOMY_FIELDS)


@query(
    "specialty_filter",
    f"""WITH {_REGISTRY_SQL} SELECT CAST(c_custkey AS VARCHAR) AS npi FROM coded
    WHERE taxonomy_grouping = 'EUROPE' OR display_name LIKE 'Practice in NATION_1%'""",
)
def specialty_filter(spark, folder):
    rows = registry.with_taxonomy(_coded(spark, folder), views.taxonomy(spark, folder))
    return registry.has_specialty(rows, ("europe", "IN NATION_1")).select(S.strip("npi").alias("npi"))


@query("provider_project", f"WITH {_REGISTRY_SQL} SELECT {_RECORD_SQL} FROM coded")
def provider_project(spark, folder):
    return registry.provider_record(
        registry.with_taxonomy(_coded(spark, folder), views.taxonomy(spark, folder))
    )


@query(
    "providers",
    f"""WITH {_REGISTRY_SQL} SELECT {_RECORD_SQL} FROM coded WHERE NOT c_acctbal < 0
    AND n_name IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_10') AND taxonomy_grouping <> ''
    AND (taxonomy_grouping = 'AMERICA' OR display_name LIKE '%NATION_3%' OR display_name LIKE '%NATION_10%')""",
)
def providers(spark, folder):
    states = [f"NATION_{n}" for n in (1, 2, 3, 4, 10)]
    return registry.providers(
        views.registry(spark, folder),
        views.taxonomy(spark, folder),
        states,
        ("america", "nation_3", "nation_10"),
    )


# ---------------------------------------------------------------- text


@query(
    "text_pregate",
    """WITH runs AS (SELECT DISTINCT regexp_extract(text, '[0-9]{10}') AS npi FROM documents
      WHERE lang <> 'de' AND regexp_matches(text, '[0-9]{10}'))
    SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM runs WHERE contains(d.text, runs.npi))""",
)
def text_pregate(spark, folder):
    """Documents whose text holds a target; targets come from the texts that are not German."""
    documents = views.placed(spark, folder, "documents")
    run = F.regexp_extract("text", "[0-9]{10}", 0)
    targets = saved(documents.where(F.col("lang") != "de").select(run.alias("npi")).distinct(), "targets")
    return selection.text_pregate(documents, targets, "doc_id")
