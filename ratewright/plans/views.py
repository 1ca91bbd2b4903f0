"""Disclosure-shaped views over the given tables.

Each view turns every row of a table into one nested element with row-level expressions, so
building one shuffles nothing and keeps the partitioning of the scan.  Which elements are
blank, malformed or repeated follows from the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE = {
    "payer_code": "PAYER",
    "file_month": "2026-01",
    "state": "TX",
    "source_version": "",
    "etl_run_id": "run-1",
    "ingested_at": "2026-01-05T08:00:00-06:00",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def month_of(date: str) -> Column:
    """Month as ``YYYY-MM``, in generated code."""
    return F.concat(_text(F.year(date)), F.lit("-"), F.lpad(_text(F.month(date)), 2, "0"))


def placed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with the place of each row in its files, spread over the cores.

    A table of one small file is read by one task, and the views multiply its rows.  A
    table that already has a task per core is left as it is scanned.
    """
    place = F.concat(F.col("_metadata.file_name"), F.lit(":"), F.col("_metadata.row_index"))
    df = table(spark, folder, name).select("*", place.alias("ordinal"))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, "ordinal") if df.rdd.getNumPartitions() < cores else df


def _document(date: str) -> dict[str, Column]:
    """File and header of an element: one rate file per month."""
    month = month_of(date)
    return {
        "source_pricing_file": F.concat(F.lit("https://rates.example.com/"), month, F.lit("/in-network.json.gz")),
        "reporting_entity_name": F.concat(F.lit("Entity "), _text(F.year(date))),
        "reporting_entity_type": F.lit(None).cast("string"),
        "last_updated_on": F.concat(month, F.lit("-01")),
        "version": F.when(F.year(date) >= 1998, F.lit("2.0")),
    }


def _items(df: DataFrame, date: str, item: Column) -> DataFrame:
    """Items frame; an element is identified by the place of its row in the table's files."""
    columns = [c.alias(n) for n, c in _document(date).items()]
    return df.select(*columns, "ordinal", item.alias("item"))


def provider_items(spark: SparkSession, folder: str) -> DataFrame:
    """One provider reference per order; group ids repeat within and across files."""
    orders = placed(spark, folder, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    group_id = F.when(priority == "5-LOW", F.lit("n/a")).otherwise(
        _text(F.floor(F.col("o_orderkey") / 4).cast("bigint"))
    )
    network = F.array(priority, F.when(status == "F", F.lit("")).when(status == "O", status))
    customer = F.struct(
        F.struct(
            F.lit("ein").alias("type"),
            _text("o_custkey").alias("value"),
            F.lit(None).cast("string").alias("business_name"),
        ).alias("tin"),
        F.array(F.concat(F.lit(" "), _text("o_custkey"), F.lit(" "))).alias("npi"),
    )
    order_npis = F.when(
        status != "F",
        F.array(F.lit(None).cast("string"), F.concat(F.lit("O"), _text("o_orderkey")), F.lit("")),
    ).otherwise(F.array().cast("array<string>"))
    order = F.struct(
        F.struct(
            F.lit("npi").alias("type"),
            _text("o_orderkey").alias("value"),
            F.concat(F.lit("Order "), _text("o_orderkey")).alias("business_name"),
        ).alias("tin"),
        order_npis.alias("npi"),
    )
    groups = F.when(~((status == "P") & (priority == "1-URGENT")), F.array(customer, order))
    item = F.struct(
        group_id.alias("provider_group_id"), network.alias("network_name"), groups.alias("provider_groups")
    )
    return _items(orders, "o_orderdate", item)


def targets(spark: SparkSession, folder: str) -> DataFrame:
    """Target identifiers: customers of one market segment."""
    customer = table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return customer.select(_text("c_custkey").alias("npi"))


def _price(**values: Column) -> Column:
    none = F.lit(None).cast("string")
    fields = (
        "negotiated_type",
        "negotiated_rate",
        "expiration_date",
        "billing_class",
        "service_code",
        "billing_code_modifier",
        "additional_information",
        "estimated_amount",
        "setting",
    )
    empty = {"service_code": F.array().cast("array<string>")}
    return F.struct(*[values.get(f, empty.get(f, none)).alias(f) for f in fields])


def price_items(spark: SparkSession, folder: str) -> DataFrame:
    """One in-network item per order line, with up to two rates of up to two prices."""
    line = placed(spark, folder, "lineitem")
    group = _text(F.floor(F.col("l_orderkey") / 4).cast("bigint"))
    supplier = _text("l_suppkey")
    negotiated = _price(
        negotiated_type=F.lit("negotiated"),
        negotiated_rate=_text("l_extendedprice"),
        expiration_date=F.lit("9999-12-31"),
        billing_class=F.col("l_returnflag"),
        service_code=F.array("l_linestatus", F.lit(None).cast("string"), "l_returnflag"),
        estimated_amount=F.lit("n/a"),
        setting=_text("l_linenumber"),
    )
    derived = _price(
        negotiated_type=F.lit("derived"),
        negotiated_rate=_text(F.col("l_extendedprice") * F.col("l_discount")),
        billing_code_modifier=F.col("l_linestatus"),
        estimated_amount=_text("l_tax"),
        additional_information=F.lit("discounted"),
    )
    share = _price(negotiated_type=F.lit("percentage"), negotiated_rate=_text("l_tax"))
    first = F.struct(
        F.array(group, supplier, F.concat(group, F.lit(".5")), group).alias("provider_references"),
        F.when(F.col("l_discount") > 0, F.array(negotiated, derived)).alias("negotiated_prices"),
    )
    second = F.struct(
        F.array(supplier).alias("provider_references"), F.array(share).alias("negotiated_prices")
    )
    rates = F.when(
        ~((F.col("l_returnflag") == "N") & (F.col("l_tax") == 0)),
        F.when(F.col("l_quantity") > 25, F.array(first, second)).otherwise(F.array(first)),
    )
    code_type = F.when(F.col("l_returnflag") == "A", F.lit("CPT")).when(
        F.col("l_returnflag") == "R", F.lit("HCPCS")
    )
    none = F.lit(None).cast("string")
    item = F.struct(
        _text("l_partkey").alias("billing_code"),
        code_type.alias("billing_code_type"),
        none.alias("billing_code_type_version"),
        F.concat(F.lit("Part "), _text("l_partkey")).alias("name"),
        none.alias("description"),
        F.lit("ffs").alias("negotiation_arrangement"),
        none.alias("severity_of_illness"),
        rates.alias("negotiated_rates"),
    )
    return _items(line, "l_shipdate", item)


def out_of_network_items(spark: SparkSession, folder: str) -> DataFrame:
    """One out-of-network item per order line."""
    line = placed(spark, folder, "lineitem")
    charged = F.struct(
        _text("l_extendedprice").alias("billed_charge"),
        F.array(_text("l_suppkey"), F.lit(None).cast("string"), _text("l_partkey")).alias("npi"),
    )
    uncharged = F.struct(
        F.lit("unknown").alias("billed_charge"), F.lit(None).cast("array<string>").alias("npi")
    )
    providers = F.when(F.col("l_tax") > 0, F.array(charged, uncharged))
    paid = F.struct(_text("l_quantity").alias("allowed_amount"), providers.alias("providers"))
    amount = F.struct(
        F.struct(F.lit("ein").alias("type"), _text("l_suppkey").alias("value")).alias("tin"),
        F.array("l_linestatus", F.lit("")).alias("service_code"),
        F.col("l_returnflag").alias("billing_class"),
        F.when(F.col("l_discount") > 0, F.array(paid)).alias("payments"),
    )
    amounts = F.when(~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")), F.array(amount))
    none = F.lit(None).cast("string")
    item = F.struct(
        _text("l_partkey").alias("billing_code"),
        F.lit("CPT").alias("billing_code_type"),
        none.alias("billing_code_type_version"),
        none.alias("name"),
        none.alias("description"),
        amounts.alias("allowed_amounts"),
    )
    return _items(line, "l_shipdate", item)


def index_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One index document per order: one or two plans, two or three files, one of them without place."""
    orders = placed(spark, folder, "orders")
    none = F.lit(None).cast("string")
    month = month_of("o_orderdate")
    bucket = _text(F.floor(F.col("o_custkey") / 10).cast("bigint"))
    place = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("ppo_TX_"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("ppo-al-"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Texas_choice"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("alabama_texas_dental"))
        .otherwise(F.lit("arkansas-hmo"))
    )

    def plan(name, key, kind, market, right, wrong, issuer):
        values = (name, key, kind, market, right, wrong, issuer)
        names = (
            "plan_name",
            "plan_id",
            "plan_id_type",
            "plan_market_type",
            "plan_sponsor_name",
            "plan_sponser_name",
            "issuer_name",
        )
        return F.struct(*[v.alias(n) for v, n in zip(values, names, strict=True)])

    sponsor = F.concat(F.lit("Sponsor "), _text("o_custkey"))
    status = F.col("o_orderstatus")
    group = plan(F.concat(F.lit("Group|"), F.col("o_orderpriority")), _text("o_custkey"), F.lit("EIN"),
                 F.lit("group"), F.lit(""), sponsor, none)
    single = plan(none, _text("o_orderkey"), F.lit("HIOS"), status, F.lit("Main"), sponsor, F.lit("Issuer"))
    plans = F.when(status == "P", F.array(group)).otherwise(F.array(group, single))

    def entry(description, location):
        return F.struct(description.alias("description"), location.alias("location"))

    own = entry(
        F.lit("in-network"),
        F.concat(F.lit("https://cdn.example.com/"), month, F.lit("/"), place, bucket, F.lit(".json.gz")),
    )
    nowhere = entry(F.lit("nowhere"), F.when(status == "F", F.lit("")))
    shared = entry(none, F.lit("https://cdn.example.com/shared/national-ppo.json.gz"))
    files = F.when(status == "O", F.array(own, nowhere, shared)).otherwise(F.array(own, nowhere))
    structure = F.struct(plans.alias("reporting_plans"), files.alias("in_network_files"))
    return orders.select(
        F.concat(F.lit("index_"), _text("o_orderkey"), F.lit(".json")).alias("source_index_file"),
        F.concat(F.lit("Entity|"), F.col("o_orderstatus")).alias("reporting_entity_name"),
        none.alias("reporting_entity_type"),
        F.concat(month, F.lit("-01")).alias("last_updated_on"),
        F.lit("1.3").alias("version"),
        F.array(structure).alias("reporting_structure"),
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One registry row per customer; its nation stands for states and for a taxonomy code."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    code = F.concat(F.lit("T"), _text("n_nationkey"))

    def slot(value: Column, switch: Column) -> Column:
        return F.struct(value.alias("code"), switch.alias("switch"))

    slots = F.array(
        slot(F.concat(F.lit("S-"), segment), F.when(balance > 8000, F.lit("N")).otherwise(F.lit(""))),
        slot(F.when(balance > 6000, F.lit(" ")).otherwise(code), F.when(balance > 3000, F.lit("Y")).otherwise("N")),
        slot(code, F.when(balance > 7000, F.lit(" X ")).otherwise(F.lit(None).cast("string"))),
    )
    return rows.select(
        F.concat(F.lit(" "), _text("c_custkey")).alias("npi"),
        F.when(segment == "BUILDING", F.lit("1")).otherwise(F.lit("2")).alias("entity_type_code"),
        F.col("c_name").alias("org_name"),
        F.concat(F.lit("L "), segment).alias("last_name"),
        F.lit(None).cast("string").alias("first_name"),
        F.when(balance > 1000, F.lower("n_name")).otherwise(F.lit(" ")).alias("practice_state"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("mailing_state"),
        F.when(balance < 0, F.lit("01/02/2020")).alias("deactivation_date"),
        slots.alias("slots"),
    )


def taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """Taxonomy codes from the nations; those of one region are missing."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region").where(F.col("r_name") != "ASIA")
    rows = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return rows.select(
        F.concat(F.lit("T"), _text("n_nationkey")).alias("taxonomy_code"),
        F.col("r_name").alias("taxonomy_grouping"),
        F.col("n_name").alias("taxonomy_classification"),
        F.lit(None).cast("string").alias("taxonomy_specialization"),
        F.concat(F.lit("Practice in "), F.col("n_name")).alias("display_name"),
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest row per order; a third of them share the size 0."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.concat(F.lit("https://host.example.com/"), _text("o_orderkey"), F.lit(".json.gz")).alias("url"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0))
        .otherwise(F.floor("o_totalprice"))
        .cast("bigint")
        .alias("size_bytes"),
        F.col("o_orderstatus").alias("signal"),
        F.translate("o_orderpriority", "-", "|").alias("reporting_entity_name"),
    )


def file_urls(spark: SparkSession, folder: str) -> DataFrame:
    """One file URL per document, some of them index files, some price files."""
    documents = table(spark, folder, "documents")
    kind = (
        F.when(F.col("lang") == "en", F.lit("Main-Index-"))
        .when(F.col("lang") == "de", F.lit("in-network-"))
        .when(F.col("lang") == "fr", F.lit("Allowed%5Famount-"))
        .otherwise(F.lit("other+"))
    )
    suffix = F.when(F.col("n_chars") > 1000, F.lit(".JSON.gz")).when(
        F.col("n_chars") > 300, F.lit(".json")
    ).otherwise(F.lit(".csv"))
    return documents.select(
        "doc_id",
        F.concat(
            F.lit("https://Files.example.com:8443/tic/"), F.col("source"), F.lit("/"), kind, _text("doc_id"),
            suffix, F.lit("?sv=1&sig=a%2Bb+c&n="), _text("n_chars"),
        ).alias("url"),
    )


def page_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs, the French and German ones with damaged schemes, all with blanks around."""
    pages = table(spark, folder, "pages")
    url = F.col("url")
    damaged = (
        F.when(url.contains("/fr/") & url.startswith("https:"), F.concat(F.lit("TPS"), F.substr(url, F.lit(6))))
        .when(url.contains("/de/"), F.concat(F.lit("ttp"), F.regexp_replace(url, "^https?", "")))
        .otherwise(url)
    )
    return pages.select("page_id", F.concat(F.lit("\t "), damaged, F.lit(" \n")).alias("url"))
