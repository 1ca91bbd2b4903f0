import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from ratewright.llm import packing, queries

TEXTS = [
    None, "", "a", "Hello, world", "two  spaces and\ttabs", "line\none\n\ntwo \n three", " lead", "trail ", "\n", "  ",
    "it's we're can'tx 'quoted' don't.", "x<|endoftext|>y", "naïve café Ωmega 北京", "a b c d", "word### $$$ && a1b2 3.14,",
    "a.b.c", "don't'", "'s", "x 's y", "éa ́b", "\u0085 x\u0085y", "\u001cz a\u001cb", "Ünïcode\rreturn", "long" * 700,
]


def whole(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_encoder_equals_tokenizer(small):
    path = queries.tokenizer_file()
    texts = [t or "" for t in TEXTS] + pq.read_table(f"{small}/documents.parquet")["text"].to_pylist()
    from tokenizers import Tokenizer

    plain, fast = Tokenizer.from_file(path), packing.Encoder(path)
    for text in texts:
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]


def test_encoder_forgets(small):
    path = queries.tokenizer_file()
    fast = packing.Encoder(path)
    fast.remembered = 5
    for text in ("one two three four five six seven", "seven six five one two three. four!"):
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == whole(path, text)


@pytest.mark.parametrize("lengths", [[], [1], [1024], [1025], [5000], [3] * 1000, [700, 700, 700], list(range(1, 300))])
def test_assignment_fills_all(lengths):
    pieces, cost = packing.assign(lengths)
    rooms = packing.capacities(sum(lengths), 1024)
    assert len(cost) == len(rooms)
    filled = [0] * len(rooms)
    by_doc = {}
    for doc, start, n, seq, offset in pieces:
        assert n > 0 and offset == filled[seq]
        filled[seq] += n
        by_doc.setdefault(doc, []).append((start, n))
    assert filled == rooms
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(by_doc[doc]):
            assert start == at
            at += n
        assert at == length


def test_short_documents_are_balanced():
    # Long and short documents: a sequence with one long piece gets fewer of the others' costs.
    _, cost = packing.assign([600] * 10 + [100] * 42 + [40])
    full = [c for c in cost if c > 500]
    assert max(full) / min(full) < 1.6


def test_rows(spark):
    path = queries.tokenizer_file()
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)] + [(None, "no id", 7), (3, "Hello, world", 7)], "doc_id long, text string, start int")
    rows = packing.pack(docs.coalesce(1), path, block_tokens=900).collect()
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.doc_tokens), {})[(r.start, r.sequence_id, r.offset)] = r
    for i, text in enumerate(TEXTS):
        ids = whole(path, text or "") + [0]
        parts = sorted(got[(i, len(ids))].values(), key=lambda r: (r.start, r.sequence_id))
        times = 2 if i == 3 else 1
        assert sum(p.length for p in parts) == times * len(ids)
        for p in parts:
            piece = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(piece)
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == 1024 or at & (at - 1) == 0
    assert packing.pack(docs.limit(0), path).count() == 0
