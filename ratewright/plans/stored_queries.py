"""Queries that land the given tables as files and read them back through the sources, writers and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewright import schemas
from ratewright.functions import scalars as S
from ratewright.operators import audit, flatten, joins
from ratewright.plans import refresh, views
from ratewright.plans.catalog import query
from ratewright.plans.flatten_queries import (
    BRIDGE_SQL,
    _CANDIDATES_SQL,
    _PRICE_SQL,
    _PROVIDER_COLUMNS,
    _PROVIDER_SQL,
    _REF_MATCH,
    _SIGNALS_SQL,
    _as_elements,
    _candidates,
    land_documents,
)
from ratewright.plans.table_queries import _MANIFEST_SQL, _RECORD_SQL, _REGISTRY_SQL, _SHARD_SQL
from ratewright.session import fresh_folder, saved
from ratewright.sources import lists, rate_files, writers
from ratewright.sources import registry as registry_files
from ratewright.streaming.incremental import load_incremental

_BRIDGE_ROWS_SQL = f"WITH {BRIDGE_SQL} SELECT * EXCLUDE (source_index_file) FROM bridge"

#: Documents in a landed file; the number of files follows the input.
FILE_DOCUMENTS = 10_000


def land_arrays(documents, path, begin="[", between=",", end="]", compression=None):
    """Documents are text; so many of them are a file, by default one JSON array."""
    files = documents.count() // FILE_DOCUMENTS + 2
    file = F.pmod(F.xxhash64("value"), F.lit(files)).alias("file")
    grouped = documents.select(file, "value").groupBy("file").agg(F.collect_list("value").alias("values"))
    lines = grouped.select("file", F.concat(F.lit(begin), F.array_join("values", between), F.lit(end)).alias("value"))
    lines.write.partitionBy("file").text(path, compression=compression)
    return path


# ---------------------------------------------------------------- documents


@query(
    "rate_files_read",
    f"""WITH {_PROVIDER_SQL} SELECT {_PROVIDER_COLUMNS.replace("source_pricing_file,", "", 1)} FROM pairs""",
)
def rate_files_read(spark, folder):
    """Provider rows of small documents, through the JSON reader."""
    items = views.provider_items(spark, folder)
    document = F.struct(*schemas.HEADER_FIELDS, F.array(F.lit(None), F.col("item")).alias("provider_references"))
    # Rate files are published as gzip streams. Of plain files the JSON reader fetches each list that is read as text by a read of its own.
    path = land_arrays(items.select(F.to_json(document).alias("value")), fresh_folder(spark, "rate-files"), compression="gzip")
    docs = rate_files.read_rate_files(spark, path, ("provider_references",))
    rows = flatten.flatten_provider_references(rate_files.items_of(docs, "provider_references"), views.LINEAGE)
    return rows.drop("source_pricing_file")


def _landed_indexes(spark, folder):
    documents = views.index_documents(spark, folder).drop("source_index_file")
    return land_arrays(documents.select(F.to_json(F.struct("*")).alias("value")), fresh_folder(spark, "indexes"))


@query("index_files", _BRIDGE_ROWS_SQL)
def index_files(spark, folder):
    """The bridge from landed index documents."""
    docs = rate_files.read_index_files(spark, _landed_indexes(spark, folder))
    return flatten.flatten_index(docs, views.LINEAGE).drop("source_index_file")


@query("bridge_of_discovered", _BRIDGE_ROWS_SQL)
def bridge_of_discovered(spark, folder):
    """The bridge of those landed index documents that discovery names, in two runs by a done set."""
    path = fresh_folder(spark, "indexes")
    _land_objects(_index_objects(views.index_documents(spark, folder)), path)
    urls = _index_urls(rate_files.list_documents(spark, path))
    first = saved(urls.where(F.pmod(F.xxhash64("url"), F.lit(2)) == 0), "first-urls")
    early = saved(refresh.index_documents(spark, path, first), "early")
    late = joins.not_done(refresh.index_documents(spark, path, urls), early, "path")
    whole = None
    for documents in (early, late):
        structures = saved(rate_files.explode_index_structures(documents), "structures")
        part = flatten.flatten_structures(rate_files.structures_from_elements(structures), views.LINEAGE)
        whole = part if whole is None else whole.unionByName(part)
    return whole.drop("source_index_file")


def _index_objects(documents):
    """Index documents of one header as one document of all their structures, or several where they are many."""
    part = F.pmod(F.xxhash64("source_index_file"), F.lit(documents.count() // (100 * FILE_DOCUMENTS) + 1)).alias("part")
    structures = F.flatten(F.collect_list("reporting_structure")).alias("reporting_structure")
    merged = documents.groupBy(*schemas.HEADER_FIELDS, part).agg(structures)
    return merged.select(F.to_json(F.struct(*schemas.HEADER_FIELDS, "reporting_structure")).alias("value"))


def _land_objects(documents, path):
    """Each document is a file of its own, in a folder named by its digest."""
    documents.select(F.sha1("value").alias("file"), "value").write.partitionBy("file").text(path)


def _index_urls(landed):
    """URLs that end with the landed documents' folder and name."""
    return saved(landed.select(F.concat(F.lit("https://host.example.com/"), F.regexp_extract("path", "([^/]+/[^/]+)$", 1)).alias("url")), "index-urls")


@query(
    "split_section_scan",
    f"""WITH {_PROVIDER_SQL} SELECT {_PROVIDER_COLUMNS.replace("source_pricing_file,", "", 1).replace("version AS source_version", "'2.0' AS source_version")}
    FROM pairs""",
)
def split_section_scan(spark, folder):
    """Provider rows of documents that are scanned in small blocks."""
    path = fresh_folder(spark, "documents")
    land_documents(views.provider_items(spark, folder), "provider_references", path)
    files = rate_files.list_documents(spark, path)
    elements = rate_files.explode_rate_sections(files, split_bytes=0, block_bytes=1 << 16)
    items = rate_files.items_from_elements(saved(elements, "elements"), "provider_references")
    return flatten.flatten_provider_references(items, views.LINEAGE).drop("source_pricing_file")


@query("load_ledger", "SELECT 'done' AS status, CAST(count(*) AS BIGINT) AS elements FROM orders")
def load_ledger(spark, folder):
    """Elements that the ledger records after documents landed and were loaded twice."""
    base = fresh_folder(spark, "ledger")
    land_documents(views.provider_items(spark, folder), "provider_references", f"{base}/landing")
    for _ in range(2):
        load_incremental(spark, f"{base}/landing", f"{base}/tables", f"{base}/ledger", f"{base}/work", views.LINEAGE)
    facts = writers.read_ledger(spark, f"{base}/ledger").where("status <> 'started'")
    return facts.groupBy("status").agg(F.sum("row_count").alias("elements"))


@query(
    "reload_replaces",
    f"""WITH {_PROVIDER_SQL} SELECT provider_group_id, tin_value, coalesce(npi, '') AS npi FROM pairs
    WHERE npi IN (SELECT npi FROM targets)""",
)
def reload_replaces(spark, folder):
    """A load of all rows, repeated with a filter that keeps few, leaves those few."""
    base = fresh_folder(spark, "reload")
    items = views.provider_items(spark, folder)
    place = {name: views.LINEAGE[name] for name in writers.PARTITIONS}
    for targets in (None, views.targets(spark, folder)):
        rows = flatten.flatten_provider_references(items, views.LINEAGE, targets)
        writers.write_dataset(rows, base, "tic_provider_reference", place, "again")
    written = lists.read_table(spark, f"{base}/tic_provider_reference", "tic_provider_reference")
    return written.select("provider_group_id", "tin_value", "npi")


# ---------------------------------------------------------------- registry, lists, manifests


@query(
    "providers_from_csv",
    f"""WITH {_REGISTRY_SQL} SELECT {_RECORD_SQL.replace("c_name AS org_name", "c_name || chr(10) || '\"x\", y' AS org_name")}
    FROM coded WHERE NOT c_acctbal < 0 AND n_name IN ('NATION_1', 'NATION_3', 'NATION_10')""",
)
def providers_from_csv(spark, folder):
    """The registry table from CSV files with quotes and line breaks in a field."""
    base = fresh_folder(spark, "registry")
    rows = views.registry(spark, folder).withColumn("org_name", F.concat("org_name", F.lit('\n"x", y')))
    named = [F.col(name).alias(title) for name, title in registry_files.REGISTRY_COLUMNS.items()]
    slots = []
    for n in range(3):
        slot = F.get("slots", F.lit(n))
        slots += [
            slot["code"].alias(registry_files.SLOT_CODE.format(n + 1)),
            slot["switch"].alias(registry_files.SLOT_SWITCH.format(n + 1)),
        ]
    rows.select(*named, *slots).write.csv(f"{base}/registry", header=True, quote='"', escape='"')
    titles = [F.col(name).alias(title) for name, title in registry_files.TAXONOMY_COLUMNS.items()]
    views.taxonomy(spark, folder).select(*titles).write.csv(f"{base}/taxonomy", header=True, quote='"', escape='"')
    return refresh.build_providers(spark, f"{base}/registry", f"{base}/taxonomy", ["NATION_1", "NATION_3", "NATION_10"])


@query("url_list_file", "SELECT url FROM pages")
def url_list_file(spark, folder):
    """A list of URLs written and read again."""
    path = fresh_folder(spark, "urls")
    writers.write_url_list(views.table(spark, folder, "pages"), path)
    return lists.read_url_list(spark, path)


@query(
    "blob_listing_file",
    """SELECT 'a/' || o_orderkey || ' & <b>.json' AS name, CASE WHEN o_orderstatus = 'P' THEN 0
      ELSE CAST(floor(o_totalprice) AS BIGINT) END AS size_bytes FROM orders""",
)
def blob_listing_file(spark, folder):
    """Pages of a store's listing, saved as XML."""
    orders = views.table(spark, folder, "orders")
    size = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.format_string("<Content-Length>%d</Content-Length>", F.floor("o_totalprice").cast("bigint"))
    )
    name = F.format_string("<Blob><Name>a/%d &amp; &lt;b&gt;.json</Name><Properties>", F.col("o_orderkey"))
    blobs = orders.select(F.concat(name, size, F.lit("</Properties></Blob>")).alias("value"))
    begin, end = "<EnumerationResults><Blobs>", "</Blobs></EnumerationResults>"
    return lists.read_blob_listing(spark, land_arrays(blobs, fresh_folder(spark, "listing"), begin, "", end))


@query(
    "catalog_file",
    """SELECT o_orderpriority AS "fileSchema", 'p/' || o_orderkey AS "filePath",
      CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS "lastUpdatedOn" FROM orders""",
)
def catalog_file(spark, folder):
    """Saved catalogue documents."""
    orders = views.table(spark, folder, "orders")
    entry = F.struct(
        F.col("o_orderpriority").alias("fileSchema"),
        F.concat(F.lit("p/"), F.col("o_orderkey").cast("string")).alias("filePath"),
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("lastUpdatedOn"),
    )
    documents = orders.select(F.to_json(F.struct(F.array(entry).alias("files"))).alias("value"))
    path = land_arrays(documents, fresh_folder(spark, "catalog"))
    return lists.read_catalog(spark, path).drop("ordinal")


@query(
    "manifest_file",
    f"""WITH {_MANIFEST_SQL} SELECT url, size_bytes, signal, replace(reporting_entity_name, '|', ' ') AS reporting_entity_name,
      'P' AS payer_code FROM manifest""",
)
def manifest_file(spark, folder):
    """A manifest written and read again."""
    path = fresh_folder(spark, "manifest")
    writers.write_manifest(joins.unify_payers({"P": views.manifest(spark, folder)}), path)
    return lists.read_manifest(spark, path).drop("raw_line")


@query(
    "shards_written",
    f"""WITH {_SHARD_SQL} SELECT shard, m.url || '|' || m.size_bytes || '|' || signal || '|'
      || replace(reporting_entity_name, '|', ' ') || '|P' AS line FROM sharded s JOIN manifest m ON m.url = s.url""",
)
def shards_written(spark, folder):
    """The lines of each shard's folder."""
    path = fresh_folder(spark, "shards")
    writers.write_shards(refresh.plan_shards({"P": views.manifest(spark, folder)}, 10), path)
    return spark.read.text(path).select(F.col("shard").cast("int").alias("shard"), F.col("value").alias("line"))


@query(
    "index_urls",
    """SELECT 'https://host.example.com/' || o_orderkey || '_index.json' AS url,
      CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END AS size_bytes
      FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
def index_urls(spark, folder):
    """Discovery from a list file and captured response headers."""
    base = fresh_folder(spark, "discovery")
    orders = views.table(spark, folder, "orders")
    url = F.concat(
        F.lit("https://host.example.com/"), F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("_rates.json")).otherwise(F.lit("_index.json")),
    )
    writers.write_url_list(orders.select(url.alias("url")), f"{base}/urls")
    headers = orders.where("o_orderstatus = 'F'").select(
        url.alias("url"), F.floor("o_totalprice").cast("bigint").cast("string").alias("content_length"), F.lit(None).cast("string").alias("etag")
    )
    headers.write.parquet(f"{base}/headers")
    source = refresh.Discovery(url_list=f"{base}/urls", headers=f"{base}/headers")
    return refresh.discover_index_urls(spark, source, "2026-01")


# ---------------------------------------------------------------- audit and whole jobs


@query(
    "audit_counts",
    f"""WITH {_PROVIDER_SQL}, expected AS (SELECT DISTINCT source_pricing_file AS source FROM base
        UNION ALL SELECT DISTINCT 'https://nowhere.example.com/' || o_orderpriority FROM orders)
    SELECT source, 'tic_provider_reference' AS dataset, count(source_pricing_file) AS row_count,
      count(source_pricing_file) = 0 AS missing
    FROM expected LEFT JOIN pairs ON source_pricing_file = source GROUP BY source""",
)
def audit_counts(spark, folder):
    """Rows of a written table per source, and sources of which nothing was written."""
    base = fresh_folder(spark, "audit")
    items = views.provider_items(spark, folder)
    writers.write_dataset(flatten.flatten_provider_references(items, views.LINEAGE), base, "tic_provider_reference")
    written = lists.read_table(spark, f"{base}/tic_provider_reference", "tic_provider_reference")
    nowhere = views.table(spark, folder, "orders").select(
        F.concat(F.lit("https://nowhere.example.com/"), "o_orderpriority").alias("source")
    )
    sources = items.select(F.col("source_pricing_file").alias("source")).union(nowhere).distinct()
    expected = sources.withColumn("dataset", F.lit("tic_provider_reference"))
    return audit.audit_outputs({"tic_provider_reference": written}, expected)


@query(
    "select_manifest",
    f"""WITH {_SIGNALS_SQL}, {_CANDIDATES_SQL}
    SELECT location AS url, c.size_bytes, CASE WHEN npi_hit THEN 'NPI+code' ELSE 'code' END AS signal,
      'Entity ' || substr(location, 9, 5) AS reporting_entity_name
    FROM candidates c JOIN signals ON source_pricing_file = location
    WHERE size_bytes <= 45000 AND (npi_hit OR code_hit)""",
)
def select_manifest(spark, folder):
    """The selection of price files from staged elements and a bridge."""
    elements = _as_elements(views.provider_items(spark, folder), "provider_references").unionByName(
        _as_elements(views.price_items(spark, folder), "in_network").where("section <> 'header'")
    )
    staged = saved(elements, "elements")
    heads = staged.where("section = 'header'").groupBy("source_pricing_file").agg(F.min("element_json").alias("element_json"))
    price_heads = views.price_items(spark, folder).select("source_pricing_file").distinct()
    lone = price_heads.join(heads, "source_pricing_file", "left_anti").withColumn("element_json", F.lit("{}"))
    heads = heads.unionByName(lone).select("source_pricing_file", F.lit("header").alias("section"), F.lit(0).cast("bigint").alias("ordinal"), "element_json")
    # Only the headers are written anew, not the elements beside them.
    staged = staged.where("section <> 'header'").unionByName(saved(heads, "heads"))
    candidates = saved(_candidates(spark, folder), "candidates")
    bridge = candidates.select(
        "location", F.lit("Plan").alias("plan_name"), F.concat(F.lit("Entity "), F.substring("location", 9, 5)).alias("reporting_entity_name")
    )
    sizes = candidates.select(F.col("location").alias("url"), "size_bytes")
    return refresh.select_pricing_files(
        bridge, staged, views.targets(spark, folder), mode="any", prefixes=("199",), sizes=sizes, max_bytes=45_000
    )


@query(
    "monthly_tables",
    f"""WITH {_PROVIDER_SQL}, {_PRICE_SQL},
    kept AS (SELECT source_pricing_file FROM base GROUP BY 1
      HAVING bool_or(CAST(o_custkey AS VARCHAR) IN (SELECT npi FROM targets) AND NOT no_groups)),
    rows AS (
      SELECT source_pricing_file, 'tic_provider_reference' AS dataset, 0.0 AS rate FROM pairs
      WHERE npi IN (SELECT npi FROM targets)
      UNION ALL SELECT source_pricing_file, 'tic_price', coalesce(negotiated_rate, 0) FROM prices p WHERE {_REF_MATCH})
    SELECT payer_code, source_pricing_file, dataset, count(*) AS rows, round(sum(rate), 2) AS rates
    FROM rows, (VALUES ('EARLY'), ('LATE')) AS payers(payer_code)
    WHERE source_pricing_file IN (SELECT source_pricing_file FROM kept) GROUP BY ALL""",
)
def monthly_tables(spark, folder):
    """The monthly job over landed index and rate documents, run twice.

    A second payer, whose indexes name the same files, comes with the second run, which adds nothing for the first. One index is cut
    off and one price file is broken: they are failures in the ledger and take nothing with them.
    """
    base = fresh_folder(spark, "month")
    file = "source_pricing_file"
    references = views.provider_items(spark, folder).select(file, F.lit(1).alias("part"), F.to_json("item").alias("value"))
    items = views.price_items(spark, folder).select(file, F.lit(3).alias("part"), F.to_json("item").alias("value"))
    names = references.select(file).union(items.select(file)).distinct()
    marks = [(0, '{"version": "2.0", "provider_references": [null'), (2, '], "in_network": [null'), (4, "]}")]
    lines = references.unionByName(items).withColumn("value", F.concat(F.lit(","), "value"))
    for part, text in marks:
        lines = lines.unionByName(names.select(file, F.lit(part).alias("part"), F.lit(text).alias("value")))
    month = F.regexp_extract(file, "/([0-9-]+)/", 1)
    lines = lines.withColumn("month", month).repartition("month").sortWithinPartitions("month", "part")
    # The documents are gzip streams, as their names say.
    lines.select("month", "value").write.partitionBy("month").text(f"{base}/rates", compression="gzip")
    found = rate_files.list_documents(spark, f"{base}/rates")
    place = F.concat(F.lit("https://rates.example.com/"), F.regexp_extract("path", "month=([0-9-]+)/", 1), F.lit("/in-network.json.gz"))
    landed = saved(found.select(place.alias("url"), "path", F.col("length").alias("size_bytes")), "landed")
    spark.range(1).select(F.lit('{"version": "2.0", "in_network": [{"a"').alias("value")).coalesce(1).write.text(f"{base}/broken")
    broken = rate_files.list_documents(spark, f"{base}/broken").where("path like '%.txt'").limit(1)
    broken = broken.select(F.lit("https://rates.example.com/broken/in-network.json").alias("url"), "path", F.col("length").alias("size_bytes"))
    landed = saved(landed.unionByName(broken), "landed")

    entry = F.struct(F.lit("prices").alias("description"), F.col("url").alias("location"))
    plan = F.struct(F.lit("Plan").alias("plan_name"))
    structure = F.struct(F.array(plan).alias("reporting_plans"), F.array(entry).alias("in_network_files"))
    index = landed.select(F.to_json(F.struct(F.array(structure).alias("reporting_structure"))).alias("value"))
    # Each index is one object; one more is cut off.
    _land_objects(index, f"{base}/indexes")
    cut = index.limit(1).select(F.expr("substring(value, 1, length(value) - 2)").alias("value"))
    cut.coalesce(1).write.text(f"{base}/indexes/file=cut")
    # The list names the landed documents; they are called after their writer, so index names are not asked for.
    writers.write_url_list(_index_urls(rate_files.list_documents(spark, f"{base}/indexes")), f"{base}/urls")
    registered = views.targets(spark, folder).select(
        F.col("npi").alias("NPI"), F.lit("TX").alias(registry_files.REGISTRY_COLUMNS["practice_state"])
    )
    registered.write.csv(f"{base}/registry", header=True)

    payers = [
        refresh.Payer(code, refresh.Discovery(url_list=f"{base}/urls", keep_names=True), f"{base}/indexes") for code in ("EARLY", "LATE")
    ]
    for run, known in (("first", payers[:1]), ("second", payers)):
        refresh.monthly_refresh(
            spark, "2026-01", known, landed, f"{base}/registry", None, f"{base}/tables", f"{base}/work", "TX", run, "now",
            refresh.Options(states=("TX",), shard_count=3, multi_line=False),
        )
    parts = None
    for dataset, rate in (("tic_provider_reference", F.lit(0.0)), ("tic_price", F.coalesce("negotiated_rate", F.lit(0.0)))):
        part = lists.read_table(spark, f"{base}/tables/{dataset}", dataset).select("payer_code", file, F.lit(dataset).alias("dataset"), rate.alias("rate"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("payer_code", file, "dataset").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("rate"), 2).alias("rates"))
