"""What keeps the large runs small: documents landed, headers that meet elements, what staged text takes."""

import pytest
from pyspark.sql import functions as F

from ratewright import schemas
from ratewright.llm import language_model
from ratewright.operators import flatten, joins
from ratewright.plans import flatten_queries, stored_queries, views
from ratewright.sources import rate_files


def files_below(path, suffix):
    return sorted(p for p in path.rglob("part-*") if p.name.endswith(suffix))


def test_indexes_of_one_header_land_as_one_document(spark, small):
    documents = views.index_documents(spark, small)
    landed = stored_queries._index_objects(documents)
    heads = documents.select(*schemas.HEADER_FIELDS).distinct().count()
    assert landed.count() == heads < documents.count()
    read = landed.select(F.from_json("value", schemas.INDEX_DOCUMENT).alias("d")).select("d.*").drop(schemas.CORRUPT)
    each = lambda d: d.select(*schemas.HEADER_FIELDS, F.explode("reporting_structure").alias("s"))
    rows = lambda d: sorted(map(str, d.select(F.to_json(F.struct("*"))).collect()))
    assert rows(each(read)) == rows(each(documents.select(*read.columns)))


def test_headers_meet_elements_without_a_shuffle(spark):
    elements = spark.range(100).select(
        F.concat(F.lit("f"), (F.col("id") % 1).cast("string")).alias("source_pricing_file"), F.when(F.col("id") == 0, "header").otherwise("in_network").alias("section"),
        F.col("id").alias("ordinal"), F.lit('{"billing_code": "1", "version": "2.0"}').alias("element_json"),
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = rate_files.items_from_elements(elements, "in_network")
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert items.where("version = '2.0'").count() == 99
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_staged_elements_are_packed_tightly(spark, tmp_path):
    row = spark.createDataFrame([("f", "header", 0, "{}")], schemas.ELEMENT)
    rate_files.stage_rate_elements(row, str(tmp_path / "staged"))
    assert files_below(tmp_path, ".zstd.parquet")


def test_documents_hold_many_elements(spark, small, tmp_path):
    items = views.provider_items(spark, small)
    many = items.crossJoin(spark.range(4)).withColumn("ordinal", F.concat("ordinal", F.col("id").cast("string"))).drop("id")
    flatten_queries.land_documents(many, "provider_references", str(tmp_path / "documents"))
    assert len(list((tmp_path / "documents").glob("document=*"))) <= many.count() // 20_000 + 2


def test_arrays_can_land_as_gzip(spark, tmp_path):
    texts = spark.range(1200).select(F.format_string('{"version": "%d"}', "id").alias("value"))
    path = stored_queries.land_arrays(texts, str(tmp_path / "arrays"), compression="gzip")
    assert len(files_below(tmp_path, ".txt.gz")) <= 2
    assert rate_files.read_rate_files(spark, path, ()).select("version").distinct().count() == 1200


def test_rounds_take_every_training_text():
    assert language_model.ROUNDS >= language_model.PORTION


def test_items_without_a_found_rate_are_not_parsed(spark, tmp_path, monkeypatch):
    """The prices of a filtered run are parsed for the items whose references match, and the rows are those of a run that parses all."""
    text = '{"billing_code": "%d", "negotiated_rates": [{"provider_references": [%d], "negotiated_prices": [{"negotiated_rate": 1.5}]}]}'
    item = spark.range(3000).select(
        F.lit("f").alias("source_pricing_file"), F.lit("in_network").alias("section"), F.col("id").alias("ordinal"), F.format_string(text, "id", "id").alias("element_json")
    )
    header = spark.createDataFrame([("f", "header", 0, "{}")], schemas.ELEMENT)
    elements = rate_files.stage_rate_elements(item.unionByName(header), str(tmp_path / "elements"))
    spark.createDataFrame([("f", k) for k in (5, 70, 2999)], "source_pricing_file string, provider_group_id long").write.parquet(str(tmp_path / "groups"))
    groups = spark.read.parquet(str(tmp_path / "groups"))
    parsed = []

    def only(places):
        parsed.append(rate_files.items_from_elements(elements, "in_network", only=places))
        return parsed[0]

    items = rate_files.items_from_elements(elements, "in_network")
    keys = rate_files.items_from_elements(elements, "in_network", schemas.IN_NETWORK_KEYS)
    found = flatten.flatten_in_network(items, views.LINEAGE, groups, (), str(tmp_path / "work"), keys, only)
    assert sorted(r.billing_code for r in found.collect()) == ["2999", "5", "70"]
    assert 3 <= parsed[0].count() < 100
    plain = flatten.flatten_in_network(items, views.LINEAGE, groups)
    assert sorted(map(str, plain.collect())) == sorted(map(str, found.collect()))


@pytest.mark.parametrize("bits", [1 << 27, 1 << 4])
def test_among_keeps_what_is_wanted(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(joins, "AMONG_BITS", bits)
    rows = spark.range(20_000).select((F.col("id") % 7).cast("string").alias("file"), F.col("id").alias("n"), F.lit(None).cast("string").alias("x"))
    rows.where("n % 100 = 3").select("file", "n").write.parquet(str(tmp_path / "wanted"))
    wanted = spark.read.parquet(str(tmp_path / "wanted"))
    kept = joins.among(rows, ["file", "n"], wanted)
    assert kept.columns == rows.columns
    assert kept.join(wanted, ["file", "n"], "left_semi").count() == 200
    assert kept.count() == 20_000 if bits == 16 else kept.count() < 1000


def test_references_are_told_apart_before_a_shuffle(spark, tmp_path, monkeypatch):
    """Where the groups are too many to go to all tasks, references that match none are left out before they are moved."""
    monkeypatch.setattr(joins.small_side, "__defaults__", (0, 0))
    spark.range(50).select(F.lit("f").alias("source_pricing_file"), (F.col("id") * 40).alias("provider_group_id")).write.parquet(str(tmp_path / "groups"))
    rate = F.struct(F.array(F.col("id").cast("string")).alias("provider_references"))
    items = spark.range(2000).select(F.lit("f").alias("source_pricing_file"), F.col("id").alias("ordinal"), F.struct(F.array(rate).alias("negotiated_rates")).alias("item"))
    found = flatten.matching_rates(items, spark.read.parquet(str(tmp_path / "groups")))
    assert "_bits" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.ordinal for r in found.collect()) == list(range(0, 2000, 40))
