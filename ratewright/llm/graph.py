"""Connected components of links: trees within tasks, then alternating large and small stars.

Each task first replaces the links it reads, ``CHUNK`` at a time, by trees that connect the same vertices, without moving anything. What
is left is counted. Up to ``CHUNK`` links are one more chunk, which is the whole answer. More go through steps of stars, each a join and an
aggregation by vertex, so no vertex or component has to fit into a task; a vertex with very many links is split by the
adaptive join. Both ways give the same roots. Edge tables of the steps lie in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import checked, map_arrow

#: Links that a task holds at once.
CHUNK = 1 << 18


def trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices that are not the smallest of their component, and the smallest of it."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        apart = root[one] != root[other]
        if not apart.any():
            break
        one, other = one[apart], other[apart]
        np.minimum.at(root, np.maximum(root[one], root[other]), np.minimum(root[one], root[other]))
        while (root[root] != root).any():
            root = root[root]
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _trees_of(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            found = trees(*(np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

        held, rows = [], 0
        for batch in batches:
            for part in (batch.slice(at, chunk) for at in range(0, batch.num_rows, chunk)):
                if rows + part.num_rows > chunk:
                    yield told()
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield told()

    return run


def components(edges: DataFrame, label: str = "components", chunk: int = CHUNK) -> DataFrame:
    """``node, root`` for each vertex of ``edges`` (a, b): the smallest vertex it is connected with.

    Vertices that only have links with themselves are left out; nulls are no vertices.
    """
    links = edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = checked(map_arrow(links, _trees_of(chunk), "a long, b long"), label)
    state = None
    while True:
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        if found[0] <= chunk:
            edges = checked(map_arrow(edges.coalesce(1), _trees_of(chunk), "a long, b long"), label)
            break
        state = found
        edges = checked(_small(_large(edges)), label)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest vertex around it."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
