import math

import numpy as np
import pytest

from ratewright.llm import embeddings as M


def brute(rows, cosine=0.9):
    """(id, links, smallest id reachable) by comparing all pairs; unusable vectors link with nothing."""
    ok = [
        k for k, (i, v) in enumerate(rows)
        if i is not None and v is not None and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    data = np.array([rows[k][1] for k in ok], float)
    data = data / np.abs(data).max(axis=1, keepdims=True)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    links = data @ data.T >= cosine
    np.fill_diagonal(links, False)
    root = np.array([rows[k][0] for k in ok])
    while True:
        new = np.array([min([root[k], *root[links[k]]]) for k in range(len(ok))])
        if (new == root).all():
            break
        root = new
    found = {k: (rows[k][0], int(links[n].sum()), int(root[n])) for n, k in enumerate(ok)}
    return sorted((found.get(k, (i, 0, i)) for k, (i, _) in enumerate(rows)), key=str)


def near(pick, vector, cosine):
    aside = pick.normal(size=len(vector))
    aside -= (aside @ vector) * vector
    return cosine * vector + math.sqrt(1 - cosine * cosine) * aside / np.linalg.norm(aside)


def table(seed=1, groups=60):
    pick = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = pick.normal(size=16)
        centre /= np.linalg.norm(centre)
        rows.append(centre)
        rows += [near(pick, centre, c) for c in pick.uniform(0.88, 0.999, pick.integers(0, 6))]
    rows += [rows[0]] * 5 + [2 * rows[1]]
    rows = [(k, r.astype(np.float32).astype(float).tolist()) for k, r in enumerate(rows)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], [1.0] * 8, [float("inf")] * 16]
    rows += [(9000 + k, v) for k, v in enumerate(bad)]
    return rows + [(None, rows[0][1]), (3, rows[0][1]), (9100, (np.array(rows[4][1]) * 1e-200).tolist())]


def test_links(spark):
    rows = table()
    frame = spark.createDataFrame([(i, v, 4) for i, v in rows], "vec_id long, embedding array<double>, node int").repartition(3)
    got = [tuple(r) for r in M.link_vectors(frame).collect()]
    assert sorted(((i, n, c) for i, n, c, _ in got), key=str) == brute(rows)
    assert all(kept == (i == c) if i is not None else kept is None for i, _, c, kept in got)


def test_hot_cells_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(M, "FILED", 7)
    monkeypatch.setattr(M, "ASKED", 5)
    pick = np.random.default_rng(2)
    centre = np.ones(16) / 4
    rows = [(k, near(pick, centre, 0.97).tolist()) for k in range(120)] + table(3, 20)[:40]
    rows = [(k, v) for k, (_, v) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r)[:3] for r in M.link_vectors(frame).collect()), key=str)
    assert got == brute(rows)


def test_visited_cells_are_the_nearest():
    pick = np.random.default_rng(4)
    index = M.MultiIndex(pick.normal(size=(9, 8)), pick.normal(size=(7, 8)), 20)
    asked = pick.normal(size=(50, 16))
    one, two = index._distances(asked)
    for k, cells in enumerate(index.visited(asked)):
        sums = (one[k][:, None] + two[k][None, :]).ravel()
        assert set(cells) == set(np.argsort(sums, kind="stable")[:20])
    ranks = index.ranks(asked, np.full(50, 3))
    for k in range(50):
        sums = (one[k][:, None] + two[k][None, :]).ravel()
        assert ranks[k] == (sums < sums[3]).sum()


def test_recall_at_the_threshold():
    """Pairs just at the threshold are found in nearly all cases."""
    pick = np.random.default_rng(6)
    sample = M.unit(pick.normal(size=(4000, 64)))
    index = M.fit_index(sample, 50_000, 0.9, 0.99)
    other = np.array([near(pick, v, 0.9) for v in sample[2000:3000]])
    found = [c in set(v) for c, v in zip(index.cells(other), index.visited(sample[2000:3000]), strict=True)]
    assert np.mean(found) >= 0.95


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0])], [(1, None)]])
def test_few(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [tuple(r) for r in M.link_vectors(frame).collect()] == [(i, 0, i, True) for i, _ in rows]


def test_no_table_holds_a_vector_once_for_each_cell(spark, monkeypatch):
    """What is written of the vectors does not grow with the number of cells that a query visits."""
    import os

    written = {}
    checked = M.checked

    def measured(df, label):
        table = checked(df, label)
        written[label] = sum(os.path.getsize(f.removeprefix("file:").replace("//", "/")) for f in table.inputFiles())
        return table

    monkeypatch.setattr(M, "checked", measured)
    vectors = np.random.default_rng(8).normal(size=(2000, 32)).astype(np.float32)
    rows = [(k, v.astype(float).tolist()) for k, v in enumerate(vectors)]
    M.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count()
    assert len(written) > 4 and max(written.values()) <= 2 * vectors.nbytes


def test_reach_is_the_sum_of_the_last_visited_cell():
    pick = np.random.default_rng(5)
    index = M.MultiIndex(pick.normal(size=(9, 8)), pick.normal(size=(7, 8)), 20)
    asked = M.unit(pick.normal(size=(50, 16)))
    one, two = index.whole_distances(asked)
    cells, reaches = index.filed(asked)
    sums = (one[:, :, None] + two[:, None, :]).reshape(50, -1)
    assert cells.tolist() == index.cells(asked).tolist()
    assert ((sums <= reaches[:, None]).sum(axis=1) == 20).all()
    assert [set(np.flatnonzero(s <= r)) for s, r in zip(sums, reaches, strict=True)] == [set(v) for v in index.visited(asked).tolist()]


def test_first_codewords_are_placed_in_packs():
    places = M.placed_routes({3: 5, 0: 4, 1: 2, 2: 25, 7: 10, 8: 1}, 10)
    assert places == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 7: (5, 1), 8: (6, 1)}
