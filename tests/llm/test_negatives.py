import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.llm import negatives as M

SCHEMA = "vec_id long, label int, embedding array<double>, mark string, rank string"


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (33, 64, 70), (65, 33, 129), (40, 0, 40), (0, 40, 40), (130, 131, 40)])
def test_strassen(shape):
    pick = np.random.default_rng(sum(shape))
    one, other = pick.integers(-(2**27), 2**27, shape[:2]), pick.integers(-(2**27), 2**27, shape[1:])
    for leaf in (1, 4, 32):
        assert (M.strassen(one, other, leaf) == one @ other).all()


def brute(rows, every=10, positives=5, negatives=10):
    length = max((len(v) for _, _, v in rows if v is not None), default=0)
    most = M.largest_component(length) // 256
    ok = set()
    for i, label, v in rows:
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) and abs(x) < most for x in v):
            ok.add((i, label, tuple(math.floor(256 * x) for x in v), tuple(v)))
    ok = sorted(ok, key=lambda r: (r[0], r[1], r[3]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in ok:
        if a[0] % every:
            continue
        near = sorted((-dot(a[2], r[2]), r[0]) for r in ok if r[1] == a[1] and r is not a)[:positives]
        for s, p in near:
            ps = -s
            far = sorted((-dot(a[2], r[2]), r[0]) for r in ok if r[1] != a[1])
            far = [(-n, i) for n, i in far if 30 * ps <= -100 * n <= 90 * ps][:negatives]
            out += [(a[0], p, k + 1, i, ps, n) for k, (n, i) in enumerate(far)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "m", "r") for r in rows], SCHEMA)


def run(spark, rows, **options):
    found = M.mine(table(spark, rows), F.col("vec_id") % 10 == 0, **options)
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    return sorted(tuple(r) for r in found.collect())


def test_against_brute_force(spark):
    pick = np.random.default_rng(3)
    rows = []
    centres = pick.normal(size=(4, 9))
    for k in range(300):
        v = (centres[pick.integers(4)] + pick.normal(size=9) * 0.8).round(2)
        rows.append((k, int(pick.integers(3)) if k % 3 else 0, v.tolist()))
    # Many equal vectors, shorter and longer ones, rows without a part, repeated rows and ids.
    rows += [(1000 + k, k % 3, rows[10][2]) for k in range(60)]
    rows += [(2000, 0, rows[20][2][:4]), (2010, 1, rows[30][2] + [0.5]), (2020, 2, [])]
    rows += [(3000, None, rows[0][2]), (None, 1, rows[0][2]), (3010, 1, None), (3020, 1, [math.nan] * 9), (3030, 1, [math.inf] * 9), (3040, 1, [None] * 9), (3050, 1, [1e300] * 9)]
    rows += [rows[0], rows[0], rows[5], (10, 1, rows[40][2]), (7, 0, rows[50][2])]
    wanted = brute(rows)
    assert len(wanted) > 500
    assert run(spark, rows) == wanted
    assert run(spark, rows, tile=400, block=60) == wanted


def test_few_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, 0, [1.0])]) == []
    assert run(spark, [(0, 0, [1.0]), (1, 0, [1.0]), (2, 1, [0.5])]) == [(0, 1, 1, 2, 65536, 32768)]
    # A positive of negative score has no window; one of score 0 has 0 alone.
    assert run(spark, [(0, 0, [1.0]), (1, 0, [-1.0]), (2, 1, [0.5])]) == []
    assert run(spark, [(0, 0, [1.0]), (1, 0, [0.0]), (2, 1, [0.0]), (3, 1, [0.1])]) == [(0, 1, 1, 2, 0, 0)]


def test_heaps_merge():
    pick = np.random.default_rng(5)
    scores, ids = pick.integers(0, 20, 500), pick.permutation(500)
    heap = None
    for at in range(0, 500, 37):
        heap = M.merged(heap, scores[at : at + 37], ids[at : at + 37], 10)
    assert list(zip(*map(list, heap), strict=True)) == [(s, i) for s, i in sorted(zip(scores, ids, strict=True), key=lambda r: (-r[0], r[1]))[:10]]
