"""Scalars and predicates on hand-written values."""

import pytest
from pyspark.sql import functions as F

from ratewright.functions import predicates as P
from ratewright.functions import scalars as S


def values(spark, make, inputs, schema="x string"):
    rows = [(n, *(i if isinstance(i, tuple) else (i,))) for n, i in enumerate(inputs)]
    df = spark.createDataFrame(rows, "n int, " + schema)
    return [r[0] for r in df.orderBy("n").select(make().alias("y")).collect()]


def test_numbers(spark):
    texts = ["1.5", " 2 ", "", None, "x", "1.0f", "2D", "0x10", "1e3", "NaN1"]
    assert values(spark, lambda: S.safe_float("x"), texts) == [1.5, 2.0, None, None, None, None, None, None, 1000.0, None]
    texts = ["7", " 12 ", "12.7", "12.0", "", None, "x", "-3", "9223372036854775808"]
    assert values(spark, lambda: S.safe_int("x"), texts) == [7, 12, None, None, None, None, None, -3, None]


def test_lists(spark):
    texts = ["a", '["a",null,"","b"]', "[broken", "[]", None, "", '[1,"2"]']
    assert values(spark, lambda: S.list_join(S.poly_list("x")), texts) == ["a", "a|b", "[broken", "", "", "", "1|2"]
    string = spark.createDataFrame([], "x string").schema["x"].dataType
    assert values(spark, lambda: S.joined(F.col("x"), string), texts) == ["a", "a|b", "[broken", "", "", "", "1|2"]


def test_blank_and_escape(spark):
    assert values(spark, lambda: S.pipe_escape("x"), ["a|b", None]) == ["a b", ""]
    assert values(spark, lambda: S.strip("x"), ["\t a b \n", None]) == ["a b", None]


def test_source_names(spark):
    urls = [
        "https://Host.example.com:443/a/b/file-1.json.gz?x=/y.json",
        "plain/file.JSON",
        "https://h/",
        "https://h/dir/",
        "https://h/é ü.json",
        "/only/path.json.zip",
    ]
    assert values(spark, lambda: S.source_name("x"), urls) == [
        "Host_example_com_443__file-1",
        "local__file",
        "h__unknown",
        "h__dir",
        "h__é_ü",
        "local__path_json_zip",
    ]


def test_url_repair(spark):
    urls = [" TPS://a/B ", "ttp://a", "http://a", "https://tps://"]
    assert values(spark, lambda: S.repair_url("x"), urls) == ["htTPS://a/B", "http://a", "http://a", "https://tps://"]


def test_url_filename(spark):
    urls = ["https://h/a/b%20c%2Fd+e.json?q=1#f", "https://h/a/", "x/100%.json", "h", "https://h"]
    assert values(spark, lambda: S.url_filename("x"), urls) == ["d+e.json", "a", "100%.json", "h", ""]


def test_seed_url(spark):
    url = "https://CDN.example.net/box/2026-01-01/x/y.json?sv=1&a=b%20c+d&empty=&sv=2"
    aliases = {"cdn.example.net": "store.example.com"}
    seed = values(spark, lambda: S.parse_seed_url("x", aliases), [url])[0]
    assert (seed.base_url, seed.container, seed.prefix) == (
        "https://store.example.com",
        "box",
        "2026-01-01/x/",
    )
    assert [(p.key, p.value) for p in seed.params] == [("sv", "2"), ("a", "b c d"), ("empty", "")]
    direct = values(spark, lambda: S.parse_seed_url("x"), ["https://h/box/y.json"])[0]
    assert (direct.base_url, direct.prefix, direct.params) == ("https://h", "", [])
    assert values(spark, lambda: S.parse_seed_url("x", strict=False), ["https://h/box"]) == [None]
    with pytest.raises(Exception, match="container"):
        values(spark, lambda: S.parse_seed_url("x"), ["https://h/box"])


def test_blob_url(spark):
    def make():
        params = F.array(
            F.struct(F.lit("a b").alias("key"), F.lit("c/d*~").alias("value")),
            F.struct(F.lit("e").alias("key"), F.lit("").alias("value")),
        )
        return S.blob_url(F.lit("https://h"), F.lit("box"), F.col("x"), params)

    assert values(spark, make, ["a b/c*~+.json"]) == ["https://h/box/a%20b/c%2A~%2B.json?a+b=c%2Fd%2A~&e="]


def test_sizes(spark):
    pairs = [("12", '"x-ff"'), ("", 'W/"0x8-1F"'), (None, '"x-zz"'), ("bad", '"x-ff"'), (None, None), (None, "abc")]
    got = values(spark, lambda: S.size_from_headers("x", "y"), pairs, "x string, y string")
    assert got == [12, 31, 0, 0, 0, 0]


def test_codes(spark):
    codes = ["610", " 611", None, "", "99"]
    assert values(spark, lambda: P.code_matches("x", ("61", " 62 ", "")), codes) == [True, True, False, False, False]
    assert values(spark, lambda: P.code_matches("x", (" ",)), codes) == [True] * 5


def test_states(spark):
    urls = ["a_KS_b", "arkansas", "a_ks-TX_", "plain", "Kansas-Texas", "xKSx", "a-Za_"]
    got = values(spark, lambda: P.state_rule("x", ("Kansas", "Zanzibar"), ("Texas",)), urls)
    assert got == [False, False, True, True, True, True, False]
    assert values(spark, lambda: P.state_rule("x", ("Kansas",)), urls[:3]) == [False, False, False]
    assert values(spark, lambda: P.state_rule("x", (), ("Texas",)), urls[:2]) == [True, True]


def test_words(spark):
    urls = ["A-PPO", "x_y", "xzy", None, "100%"]
    assert values(spark, lambda: P.url_contains("x", ("ppo", "x_y")), urls) == [True, True, True, None, False]
    assert values(spark, lambda: P.url_skip("x", ("ppo",)), urls[:2]) == [False, True]
    assert values(spark, lambda: P.url_contains("x", ()), urls) == [True] * 5


def test_index_names(spark):
    urls = ["https://h/a_INDEX.JSON", "https://h/index/a.json", "h/my-index.json.gz", "https://h/index.xml", "https://h/x.json?index"]
    assert values(spark, lambda: P.is_index("x"), urls) == [True, False, True, False, False]
    urls = ["https://h/in%2Dnetwork.json", "https://h/in-network/index.json", "Allowed_Amount.json"]
    assert values(spark, lambda: P.not_pricing_name("x"), urls) == [False, True, False]


def test_supported(spark):
    urls = ["HTTPS://h", "http://h", "ftp://h", "/data/a.json", "file:///a", "", "tps://h"]
    assert values(spark, lambda: P.is_supported("x"), urls) == [True, True, False, True, True, False, False]


def test_size_limit(spark):
    assert values(spark, lambda: P.within_size("x", 5), [5, 6, None], "x bigint") == [True, False, False]
    assert P.size_cap(1, 0.5) == 500_000_000
    assert values(spark, lambda: P.within_size("x"), [None], "x bigint") == [True]
