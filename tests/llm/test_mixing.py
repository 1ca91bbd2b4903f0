import math
import random
import re

import pytest

from ratewright.llm import mixing as M
from ratewright.llm import queries

SCHEMA = "doc_id long, source string, text string, size string, target int, rank string"


def fill(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Targets by handing the excess out again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        held = sum(weight[s] for s in names if s not in full)
        goal = {s: most * sizes[s] if s in full else left * weight[s] / held for s in names}
        above = {s for s in names if s not in full and goal[s] >= most * sizes[s]}
        if not above:
            return goal
        full |= above


def collect(spark, rows, partitions, **options):
    docs = spark.createDataFrame([(i, s, t, "x", 7, None) for i, s, t in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in M.mix(docs, **options).select("doc_id", "source", "size", "source_size", "target", "copies", "part", "taken").collect()), key=str)


@pytest.mark.parametrize("share", [1.5, 0.4, 1.999])
def test_targets_are_met(spark, share):
    pick = random.Random(int(share * 10))
    rows = []
    for k, source in enumerate(["b", "a", "é", "Z", None, "tiny", "hot"]):
        for n in range(400 if source == "hot" else 25):
            rows.append((None if n % 11 == 5 else 1000 * k + n, source, pick.choice([" ", "\n", "\t "]).join(["w"] * int(pick.paretovariate(1.1)))))
    rows += [(9000 + k, "empty", t) for k, t in enumerate([None, "", " \n"])]
    rows += [(9100, "one", "a " * 77), (9101, "Z", "word " * 30_000)] + [(9200, "hot", "same words here")] * 40
    found = collect(spark, rows, 7, share=share)
    assert found == collect(spark, rows, 1, share=share)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(str((r[0], r[1], r[2])) for r in found) == sorted(str((i, s, words(t))) for i, s, t in rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    goal = fill(sizes, share)
    for source, size in sizes.items():
        mine = [r for r in found if r[1] == source]
        assert all(r[3] == size and math.isclose(r[4], goal[source], rel_tol=1e-9, abs_tol=1e-9) for r in mine)
        assert sum(r[7] for r in mine) == math.floor(goal[source] + 0.5)
        assert sum(r[6] > 0 for r in mine) <= 1
        copies = math.floor(goal[source] / size) if size else 0
        for r in mine:
            assert copies <= r[5] <= copies + 1 or not r[2]
            assert r[7] == r[5] * r[2] + r[6] <= 2 * r[2] and 0 <= r[6] < max(1, r[2])


def test_inclusion_follows_size(spark):
    """Of documents of 1 and 3 words the latter are drawn about three times as often."""
    rows = [(k, "s", "a" if k % 2 else "a b c") for k in range(8000)]
    found = collect(spark, rows, 3, share=0.2)
    short, long = (sum(r[7] > 0 for r in found if r[2] == n) for n in (1, 3))
    assert 2.6 < long / short < 3.4
    assert sum(r[7] for r in found) == 3200


def test_mix_of_texts(spark):
    rows = [(k, "ab"[k % 2], f"text {k} " * (k % 5)) for k in range(60)] + [(3, "b", "twice"), (3, "b", "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = M.mix(docs)
    taken = {}
    for r in M.texts(docs, mixed).collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    assert taken == {r.source: r.n for r in mixed.groupBy("source").agg({"taken": "sum"}).toDF("source", "n").collect()}


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert M.mix(docs).count() == 0
    nothing = spark.createDataFrame([(1, "s", None, "", 1, ""), (2, None, " ", "", 1, "")], SCHEMA)
    assert [(r.taken, r.target) for r in M.mix(nothing).collect()] == [(0, 0.0), (0, 0.0)]


def test_no_python_in_plan(spark, small):
    """Also in the tables that the operator writes on its way."""
    plans, kept = [], M.checked
    try:
        M.checked = lambda df, label: plans.append(df) or kept(df, label)
        plans.append(queries.op11_mix_sources(spark, small))
    finally:
        M.checked = kept
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert len(plans) > 5
