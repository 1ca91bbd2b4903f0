import zlib

import numpy as np

import corpus_pipeline as C
from test_decontamination import brute as passages
from test_jaccard import brute as groups
from ratewright.llm import packing, queries


def test_stages(spark, small):
    """Each stage against plain Python on its own input; packing covers every token of the last documents."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in C.STAGES[:-1]:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = C.checked(stage(spark, docs, small), "stage")
        assert docs.columns == columns
        after = sorted(r.doc_id for r in docs.select("doc_id").collect())
        kept[name] = len(after)
        if name == "near duplicates":
            assert after == sorted({d for d, _, c in groups(before, 5, 80) if d == c})
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
            assert after == sorted(r[0] for r in passages(before, items) if not r[5])
    assert 60 < kept["decontamination"] <= kept["near duplicates"] <= kept["toxicity"] <= kept["quality"] < 200
    rows = C.run(spark, small).collect()
    encode = packing.Encoder(queries.tokenizer_file()).whole
    texts = {r.doc_id: encode(r.text) + bytes(4) for r in docs.select("doc_id", "text").collect()}
    total = {}
    for r in rows:
        data = texts[r.doc_id]
        assert r.doc_tokens == len(data) // 4
        assert r.ids_crc32 == zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)])
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {d: len(t) // 4 for d, t in texts.items()}
    assert np.mean([r.length for r in rows]) > 100


def test_empty_documents(spark, tmp_path, small):
    empty = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        out = stage(spark, empty, small)
        assert out.count() == 0


def test_clashing_and_missing_values(spark, small):
    rows = [(1, "Plain words of a text that is fine and long enough to be kept here.", "x", 0.1, None), (2, None, "y", 0.2, [1]), (None, "", None, None, None), (1, "again", None, 0.5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, worth double, hits array<int>")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.schema.names == docs.schema.names
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        left = out.collect()
        assert len(left) <= 4 and all(tuple(r) in rows for r in left), name
