import random
import re

import numpy as np
import pytest

from ratewright.llm import jaccard as J
from ratewright.llm.common import hashed_words, words_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, words):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(found) < words:
        return {tuple(found)}
    return {tuple(found[k : k + words]) for k in range(len(found) - words + 1)}


def brute(docs, words, percent):
    """(doc, set size, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t, words) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return sorted(((d, len(sets[k]), least.get(find(k), d)) for k, (d, _) in enumerate(docs)), key=str)


def texts(seed, groups, copies, length, edits, vocabulary=400):
    pick = random.Random(seed)
    found = []
    for _ in range(groups):
        base = [f"w{pick.randrange(vocabulary)}" for _ in range(pick.randint(1, length))]
        for _ in range(pick.randint(1, copies)):
            own = list(base)
            for _ in range(pick.randint(0, edits)):
                at = pick.randrange(len(own))
                own[at : at + 1] = pick.choice([[], [f"w{pick.randrange(vocabulary)}"], [own[at], "Ä"]]) or ["x"]
            found.append(pick.choice([" ", "\n", "\t"]).join(own))
    pick.shuffle(found)
    return found


def compare(spark, docs, words, percent):
    frame = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, node int").repartition(3)
    got = sorted(map(tuple, J.join_texts(frame, words, percent).collect()), key=str)
    assert got == brute(docs, words, percent)


def test_word_hashes():
    data = [b"A b\tc\x0b d", b"", b" x ", "É é q".encode(), b"b"]
    hashes, counts = hashed_words(data)
    assert counts.tolist() == [4, 0, 1, 2, 1]
    words = [w for t in data for w in words_of(t)]
    assert len(set(words)) == len(set(hashes.tolist())) and hashes[1] == hashes[-1]


def test_words_hash_alike_across_cuts(monkeypatch):
    from ratewright.llm import common

    data = [b"one two three " * 20, b"four" * 30 + b" one"]
    whole = hashed_words(data)
    monkeypatch.setattr(common, "_HASHED", 7)
    cut = hashed_words(data)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


@pytest.mark.parametrize("percent", [85, 80, 50])
def test_equal_part_for_every_link(percent):
    pick = np.random.default_rng(1)
    for _ in range(400):
        size = int(pick.integers(1, 120))
        one = np.unique(pick.integers(0, 1 << 62, size).astype(np.uint64))
        other = np.unique(np.concatenate([one[pick.random(len(one)) > 0.1], pick.integers(0, 1 << 62, int(pick.integers(0, 12))).astype(np.uint64)]))
        if len(other) and J.linked(J.common(one, other), len(one), len(other), percent):
            assert set(J.parts_of(one, percent)) & set(J.parts_of(other, percent))
            fronts = [s[: J.looked_at(len(s), percent)] for s in (one, other)]
            assert len(set(fronts[0]) & set(fronts[1])) >= max(J.needed(len(s), percent) for s in (one, other))


def test_random_texts(spark):
    docs = list(enumerate(texts(1, 40, 5, 60, 4)))
    docs += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (5, docs[7][1]), (None, docs[3][1]), (None, "alone here")]
    compare(spark, docs, 4, 85)


def test_large_regions_by_pivots(spark, monkeypatch):
    monkeypatch.setattr(J, "REGION_SETS", 6)
    monkeypatch.setattr(J, "PIVOTS", 2)
    docs = list(enumerate(texts(2, 3, 40, 50, 7)))
    compare(spark, docs, 3, 70)


def test_blocks_cover_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(J, "REGION_SETS", 8)
    rows = [(1, k, 3, bytes(8)) for k in range(30)]
    large = spark.createDataFrame(rows, "region long, node long, size int, members binary")
    blocks = J._blocks(large, J._sizes(large)).select("region", "node").collect()
    by_region = {}
    for r in blocks:
        by_region.setdefault(r.region, set()).add(r.node)
    pairs = {(a, b) for nodes in by_region.values() for a in nodes for b in nodes if a < b}
    assert len(pairs) == 30 * 29 // 2


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.join_texts(empty).count() == 0


def test_tables_are_deleted_once_read(spark, monkeypatch):
    """Tables of n-grams, sets and parts are gone when the join returns, and the rows are whole without them."""
    import os

    stored = {}
    checked = J.checked
    monkeypatch.setattr(J, "checked", lambda df, label: stored.setdefault(label, checked(df, label)))
    docs = list(enumerate(texts(3, 20, 4, 50, 3)))
    found = J.join_texts(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85)
    left = [label for label, table in stored.items() if any(os.path.exists(f.removeprefix("file:").replace("//", "/")) for f in table.inputFiles())]
    gone = {"jaccard-fronts", "jaccard-repeated", "jaccard-kept", "jaccard-parts", "jaccard-centres", "jaccard-places", "jaccard-near"}
    assert gone <= set(stored) and not gone & set(left)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, 4, 85)


def test_regions_and_trees_are_told_by_different_stages(spark):
    """A task runs one Python function: workers are reused, so a second one in a task would stay with tables of its own."""
    rows = [(1, k, 2, np.array([5, 6], np.uint64).tobytes()) for k in range(4)]
    regions = spark.createDataFrame(rows, "region long, node long, size int, members binary")
    plan = J.region_links(regions, 80)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan


def test_a_common_passage_keeps_no_region_whole(spark, monkeypatch):
    """Sets that share a passage and nothing else are told apart before pairs are compared, and links among them are found."""
    monkeypatch.setattr(J, "REGION_SETS", 8)

    def blocks(*_):
        raise AssertionError("all pairs of a region are compared")

    monkeypatch.setattr(J, "_blocks", blocks)
    passage = np.arange(20)
    sets = [np.union1d(passage, 1000 * (k + 1) + np.arange(30)) for k in range(40)]
    sets += [np.union1d(sets[k][:-2], [900_000 + k]) for k in range(0, 40, 4)]
    sets += [passage, np.union1d(passage, [7777])]
    rows = [(1, k, len(s), s.astype(np.uint64).tobytes()) for k, s in enumerate(sets)]
    regions = spark.createDataFrame(rows, "region long, node long, size int, members binary")
    found = {tuple(sorted(r)) for r in J.region_links(regions, 80).collect()}
    pairs = [(a, b) for b in range(len(sets)) for a in range(b)]
    assert found == {(a, b) for a, b in pairs if J.linked(J.common(sets[a], sets[b]), len(sets[a]), len(sets[b]), 80)}
    assert len(found) == 11
