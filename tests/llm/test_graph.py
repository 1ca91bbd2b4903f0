import numpy as np
import pytest

from ratewright.llm import graph


def brute(links):
    root = {v: v for link in links for v in link}
    while True:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def some(seed, vertices, count):
    rng = np.random.default_rng(seed)
    return [tuple(p) for p in rng.integers(-vertices, vertices, (count, 2)).tolist()]


CHAIN = [(k, k + 1) for k in range(300)]
STAR = [(7, k) for k in range(500, 900)]


@pytest.mark.parametrize("links", [some(1, 20, 15), some(2, 500, 300), some(3, 500, 2000), CHAIN[::-1], STAR, [(1, 1)], []])
def test_trees(links):
    data = np.array(links, np.int64).reshape(-1, 2)
    found = dict(zip(*(x.tolist() for x in graph.trees(data[:, 0], data[:, 1])), strict=True))
    assert found == {v: r for v, r in brute(links).items() if v != r}


@pytest.mark.parametrize("chunk", [graph.CHUNK, 50])
def test_components_by_one_chunk_and_by_stars(spark, chunk):
    """A chain, a star, random links, repeated ones, loops and nulls, in one task or through steps of stars."""
    links = [*CHAIN, *[(b + 1000, a + 1000) for a, b in STAR], *((a + 10**15, b + 10**15) for a, b in some(4, 300, 250)), (1, 0), (-5, -5)]
    frame = spark.createDataFrame([*links, (None, 3), (3, None), (None, None)], "a long, b long").repartition(5)
    rows = graph.components(frame, chunk=chunk).collect()
    found = {r.node: r.root for r in rows}
    assert len(found) == len(rows)
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert found == {v: r for v, r in brute(links).items() if v in linked}
    assert graph.components(frame.limit(0), chunk=chunk).count() == 0
