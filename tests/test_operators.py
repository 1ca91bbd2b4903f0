"""Registry, selection, shards, discovery, audit and the small joins."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright import schemas
from ratewright.operators import audit, discovery, flatten, joins, registry, selection, shards
from ratewright.plans import views
from ratewright.sources import lists, writers
from ratewright.sources.registry import REGISTRY_COLUMNS, SLOT_CODE, SLOT_SWITCH, read_provider_registry, read_taxonomy

# ---------------------------------------------------------------- registry


def registry_csv(tmp_path, rows):
    titles = list(REGISTRY_COLUMNS.values()) + [t.format(n) for n in range(1, 16) for t in (SLOT_CODE, SLOT_SWITCH)]
    lines = [",".join(f'"{t}"' for t in titles)]
    for row in rows:
        cells = {REGISTRY_COLUMNS[k]: v for k, v in row.items() if k in REGISTRY_COLUMNS}
        for n, (code, switch) in row.get("slots", {}).items():
            cells[SLOT_CODE.format(n)], cells[SLOT_SWITCH.format(n)] = code, switch
        lines.append(",".join('"' + cells.get(t, "").replace('"', '""') + '"' for t in titles))
    path = tmp_path / "registry.csv"
    path.write_bytes(b"\xef\xbb\xbf" + "\n".join(lines).encode())
    return str(path)


def test_registry_from_csv(spark, tmp_path):
    path = registry_csv(
        tmp_path,
        [
            {"npi": " 1 ", "entity_type_code": "1", "last_name": 'O"Hara\nJr', "practice_state": " tx ",
             "slots": {1: ("A", "N"), 3: ("B", "X"), 4: ("C", "Y")}},
            {"npi": "2", "org_name": "Clinic, Inc", "mailing_state": "TX", "slots": {1: ("A", "N"), 2: (" ", "Y")}},
            {"npi": "3", "practice_state": "OK", "mailing_state": "TX", "slots": {1: ("B", "Y")}},
            {"npi": "4", "practice_state": "TX", "deactivation_date": "01/01/2020", "slots": {1: ("B", "Y")}},
        ],
    )
    codes = tmp_path / "codes.csv"
    codes.write_text(
        "Code,Grouping,Classification,Specialization,Display Name\n"
        'A,G,Old,,x\n ,skip,,,\nB,Surgery,"Neuro, Spine",S,Spine Doctor\nA,G,Family,,Generalist\n',
        encoding="utf-8-sig",
    )
    frame, taxonomy = read_provider_registry(spark, path), read_taxonomy(spark, str(codes))
    got = registry.providers(frame, taxonomy, ["tx"]).orderBy("npi").collect()
    assert [(r.npi, r.entity_type, r.last_name, r.org_name, r.practice_state, r.taxonomy_code) for r in got] == [
        ("1", "Individual", 'O"Hara\nJr', "", "TX", "B"),
        ("2", "Organization", "", "Clinic, Inc", "", "A"),
    ]
    assert got[1].taxonomy_classification == "Family" and got[0].taxonomy_classification == "Neuro, Spine"
    assert [r.npi for r in registry.providers(frame, taxonomy, [], ["SPINE D"]).orderBy("npi").collect()] == ["1", "3"]
    blank = registry.providers(frame, read_taxonomy(spark, None)).where(F.col("npi") == "1").first()
    assert (blank.taxonomy_code, blank.display_name) == ("B", "")
    assert registry.providers(frame, read_taxonomy(spark, None), [], ["spine"]).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_taxonomy(spark, str(tmp_path / "absent.csv")).count()


# ---------------------------------------------------------------- selection

FILES = [("both", 10, True, True), ("npi", 10, True, False), ("code", 10, False, True), ("none", 10, False, False),
         ("big", 1234567, True, True), ("sizeless", None, True, True)]

EXPECTED = {
    "npi_only": {"both": "NPI", "npi": "NPI", "code": None, "none": None, "unread": None},
    "code_only": {"both": "code", "npi": None, "code": "code", "none": None, "unread": None},
    "require_both": {"both": "NPI+code", "npi": None, "code": None, "none": None, "unread": None},
    "any": {"both": "NPI+code", "npi": "NPI+code", "code": "code", "none": None, "unread": None},
}


@pytest.mark.parametrize("mode", selection.MODES)
def test_selection_table(spark, mode):
    candidates = spark.createDataFrame([(f[0], f[1]) for f in FILES] + [("unread", 10)], "location string, size_bytes bigint")
    signals = spark.createDataFrame(
        [(f[0], f[2], f[3]) for f in FILES], "source_pricing_file string, npi_hit boolean, code_hit boolean"
    )
    got = {r.location: r for r in selection.select_files(candidates, signals, mode, max_bytes=1000).collect()}
    assert {k: r.signal if r.matched else None for k, r in got.items() if k in EXPECTED[mode]} == EXPECTED[mode]
    assert (got["big"].matched, got["big"].signal) == (False, "too large (1,234,567 bytes)")
    assert (got["sizeless"].matched, got["sizeless"].signal) == (False, "no size")
    if mode == "require_both":
        assert got["npi"].signal == "NPI=yes, code=no" and got["code"].signal == "no NPI match"
    unlimited = selection.select_files(candidates, signals, mode, has_prefixes=False)
    everything = {r.location for r in unlimited.where("matched").collect()}
    hits = {f[0] for f in FILES if f[2]}
    assert everything == (hits if mode in ("npi_only", "require_both") else hits | {"code", "none", "unread"})


def test_invalid_modes():
    with pytest.raises(ValueError):
        selection.check_mode("all")
    with pytest.raises(ValueError):
        selection.check_mode("code_only", require_both=True)


def test_only_state(spark):
    urls = ["h/uhc_OK_1", "h/uhc-tx-ok_1", "h/UHC/Texas-Oklahoma", "h/uhc", "h/umr_TX_", "h/other"]
    frame = spark.createDataFrame([(u,) for u in urls], "location string")
    layers = selection.only_state("Texas", ("uhc", "umr"))
    assert [r.location for r in frame.where(layers.condition("location")).collect()] == urls[1:5]


def test_prefilter_leaves_out_done(spark):
    bridge = spark.createDataFrame(
        [("u1", "b|c", None), ("u1", "a|b", "E"), ("u2", None, None), ("", "x", "y"), (None, "x", "y")],
        "location string, plan_name string, reporting_entity_name string",
    )
    done = spark.createDataFrame([("u2",)], "location string")
    assert [tuple(r) for r in selection.prefilter_urls(bridge).collect()] == [("u1", "a b", "E"), ("u2", "", "")]
    assert [r.location for r in selection.prefilter_urls(bridge, done=done).collect()] == ["u1"]
    assert [r.location for r in selection.scan_limit(bridge.where("location > ''").select("location"), 2).collect()] == ["u1", "u1"]


def test_text_pregate_by_brute_force(spark):
    texts = ["x12345678901y", "1234567890", "ab 7", "", None, "é-ab-12", "9" * 40, "123 456 7890"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for targets in (["2345678901"], ["1234567890", "ab-", "7"], ["9" * 11, "nope"], ["12345678901234"]):
        wanted = {k for k, t in enumerate(texts) if t and any(x in t for x in targets)}
        got = selection.text_pregate(frame, spark.createDataFrame([(t,) for t in targets], "npi string"), "k")
        assert {r.k for r in got.collect()} == wanted
    nobody = spark.createDataFrame([], "npi string")
    assert selection.text_pregate(frame, nobody, "k").count() == len(texts)


# ---------------------------------------------------------------- joins


def test_small_side_measures(spark):
    frame = spark.range(100).select(F.col("id").cast("string").alias("npi"))

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(joins.small_side(frame))
    assert not hinted(joins.small_side(frame, max_rows=99))
    assert not hinted(joins.small_side(frame, max_bytes=100))


def test_target_union(spark):
    frame = spark.createDataFrame([(" 1 ",), ("2",), (None,), ("",)], "npi string")
    assert sorted(r.npi for r in joins.target_npis(frame, ["2", " 3"]).collect()) == ["1", "2", "3"]


def test_price_provider_join_keeps_file_and_counts_once(spark):
    prices = spark.createDataFrame(
        [("f", "1|1|2|x|3.0", 5.0), ("g", "1", 6.0)],
        "source_pricing_file string, provider_references string, negotiated_rate double",
    )
    providers = spark.createDataFrame(
        [("f", 1, "a"), ("f", 1, "b"), ("f", 2, "c"), ("h", 1, "d"), ("f", None, "e")],
        "source_pricing_file string, provider_group_id bigint, npi string",
    )
    got = joins.price_with_provider(prices, providers)
    assert sorted((r.source_pricing_file, r.npi) for r in got.collect()) == [("f", "a"), ("f", "b"), ("f", "c")]


# ---------------------------------------------------------------- shards and manifests


def manifest(spark, sizes):
    return spark.createDataFrame([(f"u{n}", s) for n, s in enumerate(sizes)], "url string, size_bytes bigint")


@pytest.mark.parametrize("count", [1, 3, 10])
@pytest.mark.parametrize(
    "sizes", [[], [5], [0] * 500, [7] * 300 + list(range(200)), [2**40] + [1] * 50, list(range(1000))]
)
def test_shards_hold_each_row_once_and_balance(spark, sizes, count):
    rows = shards.assign_shards(manifest(spark, sizes), count).collect()
    assert sorted(r.url for r in rows) == sorted(f"u{n}" for n in range(len(sizes)))
    loads = [sum(r.size_bytes for r in rows if r.shard == s) for s in range(1, count + 1)]
    assert all(1 <= r.shard <= count for r in rows)
    assert max(loads) - min(loads) <= max(sizes, default=0)


def test_size_ranks_are_a_permutation(spark):
    sizes = [3] * 400 + [9] * 10 + list(range(300))
    rows = shards.ranked_by_size(manifest(spark, sizes), ranges=8).orderBy("size_rank").collect()
    assert [r.size_rank for r in rows] == list(range(len(sizes)))
    assert [r.size_bytes for r in rows] == sorted(sizes, reverse=True)


def test_shard_count_must_be_positive(spark):
    with pytest.raises(ValueError):
        shards.assign_shards(manifest(spark, [1]), 0)


def test_manifest_lines(spark, tmp_path):
    path = tmp_path / "m.txt"
    path.write_text("u1|5|NPI|A\n\nu2||code|B|UHC\nu3| 7 |x|C| \n")
    rows = lists.read_manifest(spark, str(path)).orderBy("url").collect()
    assert [(r.url, r.size_bytes, r.payer_code) for r in rows] == [("u1", 5, None), ("u2", 0, "UHC"), ("u3", 7, None)]
    path.write_text("u1|5|NPI|A\nu2\nu3|x|s|n\n")
    with pytest.raises(Exception, match="manifest line has"):
        lists.read_manifest(spark, str(path)).collect()
    marked = lists.read_manifest(spark, str(path), "quarantine").orderBy("url").collect()
    assert [r.problem is None for r in marked] == [True, False, False]


def test_writers_round_trip(spark, tmp_path):
    urls = spark.createDataFrame([("b",), ("a",), ("c",)], "url string")
    writers.write_url_list(urls, str(tmp_path / "urls"))
    files = sorted((tmp_path / "urls").glob("part-*.txt"))
    assert "".join(f.read_text() for f in files).split() == ["a", "b", "c"]
    assert sorted(r.url for r in lists.read_url_list(spark, str(tmp_path / "urls")).collect()) == ["a", "b", "c"]
    rows = spark.createDataFrame(
        [("u1", None, "NPI", "A|B", "UHC"), ("u2", 5, "code", None, None)],
        "url string, size_bytes bigint, signal string, reporting_entity_name string, payer_code string",
    )
    writers.write_manifest(rows, str(tmp_path / "m"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "m")).collect())
    assert lines == ["u1||NPI|A B|UHC", "u2|5|code|"]
    back = lists.read_manifest(spark, str(tmp_path / "m"))
    writers.write_shards(shards.assign_shards(back, 2), str(tmp_path / "s"))
    kept = sorted(r.value for r in spark.read.text(str(tmp_path / "s")).collect())
    assert kept == lines and len(list((tmp_path / "s").glob("shard=*"))) == 2


# ---------------------------------------------------------------- discovery


def test_listing_pages(spark, tmp_path):
    (tmp_path / "page1.xml").write_text(
        "<EnumerationResults><Blobs>"
        "<Blob><Name>2026-01-01/a_index.json</Name><Properties><Content-Length>12</Content-Length></Properties></Blob>"
        "<Blob><Name>2026-01-01/rates.json</Name><Properties></Properties></Blob>"
        "<Blob><Name>2025-12-01/b_index.json</Name></Blob><Blob><Properties/></Blob>"
        "</Blobs></EnumerationResults>"
    )
    (tmp_path / "page2.xml").write_text(
        "<EnumerationResults><Blobs><Blob><Name>2026-01-01/z Index.json.gz</Name></Blob></Blobs></EnumerationResults>"
    )
    listing = lists.read_blob_listing(spark, str(tmp_path))
    assert listing.count() == 4
    urls = discovery.listing_urls(discovery.listing_select(listing, "2026-01"), "https://h/box/2026-01-01/x.json?s=1")
    assert sorted(tuple(r) for r in urls.collect()) == [
        ("https://h/box/2026-01-01/a_index.json?s=1", 12),
        ("https://h/box/2026-01-01/z%20Index.json.gz?s=1", 0),
    ]


def test_catalogue(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"files":[{"fileSchema":"table_of_contents","filePath":"/2026-01/a.json","lastUpdatedOn":"2025"},'
        '{"fileSchema":"TABLE_OF_CONTENTS","filePath":"2026-01/a.json","lastUpdatedOn":"2026-01-09"},'
        '{"fileSchema":"TABLE_OF_CONTENTS","filePath":"b.json","lastUpdatedOn":"2026-01-02"},'
        '{"fileSchema":"TABLE_OF_CONTENTS","lastUpdatedOn":"2026-01-02"},{"fileSchema":"RATES","filePath":"2026-01/c"}]}'
    )
    rows = discovery.catalog_select(lists.read_catalog(spark, str(tmp_path / "c.json")), "https://h/x", month="2026-01")
    assert sorted(tuple(r) for r in rows.collect()) == [("https://h/x/2026-01/a.json", 1), ("https://h/x/b.json", 2)]


def test_direct_list(spark):
    urls = spark.createDataFrame([(" https://h/index.json ",), ("https://h/rates.json",), ("",)], "url string")
    headers = spark.createDataFrame([("https://h/index.json", None, '"a-10"')], "url string, content_length string, etag string")
    assert [tuple(r) for r in discovery.direct_select(urls, headers).collect()] == [("https://h/index.json", 16)]
    assert discovery.direct_select(urls, keep_non_index=True).count() == 2


def test_computed_sides_are_not_measured(spark):
    """A join starts no job for a side that would have to be computed."""
    lazy = spark.range(9).selectExpr("cast(id % 3 as string) as npi").join(spark.range(3).selectExpr("cast(id as string) as npi"), "npi")
    assert joins.small_side(lazy) is lazy
    assert not joins.is_stored(lazy) and joins.is_stored(spark.range(3).where("id > 1").distinct())


def test_large_structures_are_cut_on_both_sides(spark):
    plans = [{"plan_name": str(n)} for n in range(1000)]
    files = [{"location": f"u{n}"} for n in range(300)] + [{"location": ""}]
    row = {"source_index_file": "i", "reporting_structure": [{"reporting_plans": plans, "in_network_files": files}]}
    fields = [f for f in schemas.INDEX_DOCUMENT.fields if f.name != schemas.CORRUPT]
    docs = spark.createDataFrame([row], T.StructType([T.StructField("source_index_file", T.StringType()), *fields]))
    bridge = flatten.flatten_index(docs, views.LINEAGE)
    assert bridge.select("plan_name", "location").distinct().count() == bridge.count() == 300_000
    # Below the generator of a side's pieces, only that side is read whole.
    plan = bridge._jdf.queryExecution().optimizedPlan().toString()
    generators = [line for line in plan.splitlines() if "Generate posexplode(transform(" in line]
    assert len(generators) == 2


# ---------------------------------------------------------------- audit


def test_audit_finds_missing_datasets(spark):
    table = spark.createDataFrame([("f",), ("f",)], "source_pricing_file string")
    expected = spark.createDataFrame([("f", "tic_price"), ("g", "tic_price")], "source string, dataset string")
    got = {r.source: (r.row_count, r.missing) for r in audit.audit_outputs({"tic_price": table}, expected).collect()}
    assert got == {"f": (2, False), "g": (0, True)}
    with pytest.raises(Exception, match="nothing written for tic_price of g"):
        audit.audit_outputs({"tic_price": table}, expected, strict=True).collect()
