"""Hard negatives of anchors by exact integer scores, multiplied tile by tile with Strassen's recursion.

A component x becomes ``floor(256 * x)``; a score is the inner product of two integer vectors. Higher scores come
first, ties go by smaller id. An anchor's positives are its first rows of the same label, its negatives for a positive are the
first rows of other labels whose score lies within a window around a share of the positive's score.

* Anchors are dealt to blocks and all rows to tiles, both of bounded size, by hash; every block meets every tile in a group of
  its own. The anchors are a stated part of the rows, and this is the stated query set against all rows.
* Within a group the scores of a label's anchors with the rows of one label (positives) or of the other labels (negatives) are one
  product of integer matrices. It is split into quarters recursively, seven products for eight, with zeros added where a
  side is odd; all sums are of 64-bit integers and exact.
* What a group finds are heaps of bounded size: the best rows of an anchor, or of an anchor and positive within its window.
  Heaps merge, within a group piece by piece and between groups by a ranking that keeps as many rows for each task.

The first pass finds positives, the second takes the windows from them.

Rows: without label, vector or id, with a null or non-finite component, or with components so large that scores might leave 64
bits (``length * largest ** 2``, in all of the rows' length), a row takes no part. Rows equal in id, label and vector count once;
rows of one id that differ are rows of their own. Vectors of fewer components than others have zeros after them. No vector, no anchor:
no rows. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.common import checked
from ratewright.session import ship_package

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: The window of negatives, in hundredths of the positive's score.
LOW, HIGH = 30, 90
#: Vector components in a tile of rows and in a block of anchors.
TILE, BLOCK = 1 << 19, 1 << 18
#: Rows and anchors whose scores are multiplied at once, and the side at which the recursion ends.
ROWS, ANCHORS, LEAF = 2048, 512, 32


# ---------------------------------------------------------------- products


def _even(side: int) -> int:
    return side + side % 2


def strassen(one: np.ndarray, other: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``one @ other`` of 64-bit integers, by Strassen's seven products of quarters."""
    (rows, inner), columns = one.shape, other.shape[1]
    if min(rows, inner, columns) <= leaf:
        return one @ other
    if rows % 2 or inner % 2 or columns % 2:
        a = np.zeros((_even(rows), _even(inner)), np.int64)
        b = np.zeros((_even(inner), _even(columns)), np.int64)
        a[:rows, :inner], b[:inner, :columns] = one, other
    else:
        a, b = one, other
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


# ---------------------------------------------------------------- heaps


def best(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size`` of scores and ids: higher scores first, then smaller ids."""
    if len(scores) > size:
        least = np.partition(scores, len(scores) - size)[len(scores) - size]
        above = scores >= least
        scores, ids = scores[above], ids[above]
    order = np.lexsort((ids, -scores))[:size]
    return scores[order], ids[order]


def merged(heap, scores: np.ndarray, ids: np.ndarray, size: int):
    """A heap of ``size`` with more scores and ids; None is an empty heap."""
    if not len(scores):
        return heap
    if heap is None:
        return best(scores, ids, size)
    if len(heap[0]) == size:
        more = scores >= heap[0][-1]
        scores, ids = scores[more], ids[more]
        if not len(scores):
            return heap
    return best(np.concatenate([heap[0], scores]), np.concatenate([heap[1], ids]), size)


# ---------------------------------------------------------------- rows


def largest_component(length: int) -> int:
    """The largest whole number of which ``length`` squares add up to less than 2**63."""
    return int(np.sqrt((2**63 - 1) // max(1, length)) * (1 - 1e-9))


def usable(vectors: DataFrame, length: int) -> Column:
    """Do a row's label, id and components take part, if the longest vector has ``length``?"""
    bound = F.lit(float(largest_component(length) // SCALE))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (x >= -bound) & (x < bound))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound


def _matrix(column: pa.ChunkedArray, length: int) -> np.ndarray:
    """The integer vectors, with zeros after the shorter ones."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    found = np.zeros((len(sizes), length), np.int64)
    found[np.arange(length)[None, :] < sizes[:, None]] = values
    return found


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64)


def _sorted_tile(table: pa.Table, length: int):
    """Label, id, mark and vector of the rows of a tile, by label and id."""
    labels, ids, marks = (_numbers(table, n) for n in ("label", "vec_id", "mark"))
    order = np.lexsort((marks, ids, labels))
    return labels[order], ids[order], marks[order], _matrix(table["embedding"], length)[order]


def _products(anchors: pa.Table, tile: pa.Table, length: int, same: bool) -> Iterator[tuple]:
    """``anchor row, scores, ids, marks`` of the anchors with the tile's rows of their label, or of the other labels."""
    labels, ids, marks, rows = _sorted_tile(tile, length)
    asked, queries = _numbers(anchors, "label"), _matrix(anchors["embedding"], length)
    for label in np.unique(asked):
        first, last = np.searchsorted(labels, label), np.searchsorted(labels, label, side="right")
        wanted = np.flatnonzero(asked == label)
        for low, high in [(first, last)] if same else [(0, first), (last, len(labels))]:
            for at in range(low, high, ROWS):
                piece = slice(at, min(at + ROWS, high))
                held = np.ascontiguousarray(rows[piece].T)
                for begin in range(0, len(wanted), ANCHORS):
                    some = wanted[begin : begin + ANCHORS]
                    scores = strassen(queries[some], held)
                    for number, row in enumerate(some.tolist()):
                        yield row, scores[number], ids[piece], marks[piece]


def _positives(length: int, size: int):
    def run(anchors: pa.Table, tile: pa.Table) -> pa.Table:
        own, mark = _numbers(anchors, "vec_id"), _numbers(anchors, "mark")
        heaps: dict[int, tuple] = {}
        for row, scores, ids, marks in _products(anchors, tile, length, True):
            others = (ids != own[row]) | (marks != mark[row])
            heaps[row] = merged(heaps.get(row), scores[others], ids[others], size)
        found = [(own[r], mark[r], int(i), int(s)) for r, heap in heaps.items() if heap for s, i in zip(*heap, strict=True)]
        return _table(found, ("anchor_id", "mark", "positive_id", "positive_score"))

    return run


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The lowest and highest whole score with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


def _negatives(length: int, size: int, low: int, high: int):
    def run(anchors: pa.Table, tile: pa.Table) -> pa.Table:
        own, mark = _numbers(anchors, "vec_id"), _numbers(anchors, "mark")
        positives = anchors["positives"].to_pylist()
        heaps: dict[tuple[int, int], tuple] = {}
        for row, scores, ids, _ in _products(anchors, tile, length, False):
            for place, positive in enumerate(positives[row]):
                least, most = window(positive["positive_score"], low, high)
                if least <= most:
                    near = np.flatnonzero((scores >= least) & (scores <= most))
                    heaps[row, place] = merged(heaps.get((row, place)), scores[near], ids[near], size)
        found = [
            (own[r], mark[r], place, positives[r][place]["positive_id"], positives[r][place]["positive_score"], int(i), int(s))
            for (r, place), heap in heaps.items() if heap for s, i in zip(*heap, strict=True)
        ]
        return _table(found, _FOUND)

    return run


_FOUND = ("anchor_id", "mark", "place", "positive_id", "positive_score", "negative_id", "negative_score")


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=list(names))


def _schema(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} long" for n in names)


# ---------------------------------------------------------------- the job


def _meet(anchors: DataFrame, rows: DataFrame, tiles: int, blocks: int, function, names: tuple[str, ...]) -> DataFrame:
    """Each block of anchors with each tile of rows, as a group."""
    spread = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    key = lambda seed, number: F.pmod(F.xxhash64("vec_id", "mark", F.lit(seed)), F.lit(number)).cast("int")
    asked = anchors.withColumn("block", key(5, blocks)).withColumn("tile", spread(tiles))
    held = rows.withColumn("tile", key(6, tiles)).withColumn("block", spread(blocks))
    return asked.groupBy("block", "tile").cogroup(held.groupBy("block", "tile")).applyInArrow(function, _schema(names))


def _first(found: DataFrame, keys: tuple[str, ...], score: str, row: str, size: int) -> DataFrame:
    """Merge heaps: the first ``size`` by key, numbered by ``rank``. A task passes on no more than ``size`` for each key."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    tile: int = TILE,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``is_anchor`` names.

    ``vectors`` has ``vec_id`` and ``label`` (whole numbers) and ``embedding`` (an array of floats or doubles).
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding", is_anchor.alias("asks"))
    length = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    mark = F.xxhash64("label", "embedding")
    rows = rows.where(usable(rows, length)).dropDuplicates(["vec_id", "label", "embedding"]).withColumn("mark", mark)
    rows = checked(rows, "negatives-rows")
    number, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    width = max(1, length)
    tiles, blocks = max(1, -(-number * width // tile)), max(1, -(-asking * width // block))
    held = rows.select("vec_id", "label", "mark", "embedding")
    anchors = rows.where("asks").select("vec_id", "label", "mark", "embedding")

    names = ("anchor_id", "mark", "positive_id", "positive_score")
    found = _meet(anchors, held, tiles, blocks, _positives(length, positives), names)
    heaps = _first(found, ("anchor_id", "mark"), "positive_score", "positive_id", positives)
    chosen = heaps.groupBy("anchor_id", F.col("mark").alias("_mark")).agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    own = (F.col("vec_id") == F.col("anchor_id")) & (F.col("mark") == F.col("_mark"))
    ready = anchors.join(chosen, own).select("vec_id", "label", "mark", "embedding", "positives")
    ready = checked(ready, "negatives-anchors")

    found = _meet(ready, held, tiles, blocks, _negatives(length, negatives, low, high), _FOUND)
    ranked = _first(found, ("anchor_id", "mark", "place"), "negative_score", "negative_id", negatives)
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
