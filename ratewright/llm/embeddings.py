"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the unit vectors, form a grid of cells; a vector is filed in the cell of its
nearest codewords. A query walks through the cells in ascending order of the sum of both squared distances (the
multi-sequence order) and stops after as many cells as reach the target recall. That number is measured when the index is
fitted: for vectors of a bounded sample and vectors turned from them by just the angle of the threshold, the hardest case,
it is the quantile ``recall`` of the rank of the turned vector's cell. Pairs in visited cells are verified by cosine in double precision.

Equal vectors are one class of the index and link with each other. Codebooks are fitted on at most ``SAMPLE`` classes; all
are indexed and all are queries. A query keeps the sum of the last cell it visits, its reach, instead of a list of cells: a cell is
visited if its sum is no larger. Queries lie in packs and filed vectors in packs of neighbouring cells, a hot cell in several, and each
pack of queries meets each pack of filed vectors where they lie, so no vector is written once for each cell that it visits.
Sums of whole numbers (``STEPS``) are the same in all packs. Links are counted where they are found and kept as trees, never listed as pairs.

A vector that is null, empty, zero, or holds null or non-finite numbers links with nothing; so does one whose length is not the
most frequent one (ties: the smallest), and one without id. Repeated rows count as other vectors. Empty tables give no rows. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import checked, column, discard, map_arrow, mix
from ratewright.llm.graph import components, trees

COSINE = 0.9
RECALL = 0.999
SAMPLE = 16_384
#: Classes for each cell that the size of the codebooks aims at, and the largest codebook.
PER_CELL, LARGEST = 12, 512
#: Vectors of a pack of filed vectors and of one of queries, at most, and packs of each that a small table is cut into.
FILED, ASKED = 16_384, 8192
PACKS = 24
#: Bytes of a pack's vectors in double precision.
PACK_BYTES = 16 << 20
#: A component of a unit vector in whole steps.
STEPS = 1 << 20
#: Products of a cell that are held at once.
HELD = 1 << 21


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = max(1, vectors.shape[1] // 2)
    return vectors[:, :middle], vectors[:, middle:]


def _squared(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (points * points).sum(axis=1)[:, None] - 2 * points @ words.T + (words * words).sum(axis=1)


def codewords(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """k-means from the first points."""
    words = points[:count].copy()
    for _ in range(rounds):
        nearest = _squared(points, words).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        words[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0][:, None]
    return words


@dataclass
class MultiIndex:
    """Codebooks of both halves and the number of cells a query visits."""

    first: np.ndarray
    second: np.ndarray
    visits: int

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell a vector is filed in."""
        one, two = self._distances(vectors)
        return one.argmin(axis=1) * len(self.second) + two.argmin(axis=1)

    def _distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = _halves(vectors)
        return _squared(one, self.first), _squared(two, self.second)

    def whole_distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances in whole steps, the same whichever vectors are computed together."""
        one, two = _halves(np.rint(vectors * STEPS))
        return _squared(one, np.rint(self.first * STEPS)), _squared(two, np.rint(self.second * STEPS))

    def filed(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell a vector is filed in, and its reach: the sum of the last cell that it visits."""
        one, two = self.whole_distances(vectors)
        cells = one.argmin(axis=1) * len(self.second) + two.argmin(axis=1)
        one.sort(axis=1)
        two.sort(axis=1)
        a, b = self._places().T
        sums = one[:, a] + two[:, b]
        count = min(self.visits, len(a))
        return cells, np.partition(sums, count - 1, axis=1)[:, count - 1]

    def _places(self) -> np.ndarray:
        """Places of the two sorted lists that may be among the first ``visits``."""
        one, two = len(self.first), len(self.second)
        return np.array([(a, b) for a in range(min(self.visits, one)) for b in range(min(self.visits // (a + 1), two))])

    def ranks(self, queries: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells come before the given one in each query's order."""
        one, two = self._distances(queries)
        row = np.arange(len(queries))
        own = one[row, cells // len(self.second)] + two[row, cells % len(self.second)]
        before = np.zeros(len(queries), np.int64)
        for k in range(one.shape[1]):
            before += (one[:, k, None] + two < own[:, None]).sum(axis=1)
        return before

    def visited(self, vectors: np.ndarray) -> np.ndarray:
        """The first ``visits`` cells of each vector's order, ascending by number.

        The cell at place (a, b) of the two sorted lists has (a + 1)(b + 1) - 1 cells before it that are no farther, so only
        places with (a + 1)(b + 1) <= visits can be among the first.
        """
        one, two = self._distances(vectors)
        order_one, order_two = np.argsort(one, axis=1, kind="stable"), np.argsort(two, axis=1, kind="stable")
        one, two = np.take_along_axis(one, order_one, 1), np.take_along_axis(two, order_two, 1)
        a, b = self._places().T
        sums = one[:, a] + two[:, b]
        count = min(self.visits, len(a))
        nearest = np.argpartition(sums, count - 1, axis=1)[:, :count]
        return np.sort(np.take_along_axis(order_one, a[nearest], 1) * len(self.second) + np.take_along_axis(order_two, b[nearest], 1), axis=1)


def fit_index(sample: np.ndarray, classes: int, cosine: float, recall: float, seed: int = 5) -> MultiIndex:
    """Codebooks from unit vectors; ``classes`` is the number of all."""
    count = max(1, min(LARGEST, len(sample), 2 ** round(math.log2(max(1.0, math.sqrt(classes / PER_CELL))))))
    one, two = _halves(sample)
    index = MultiIndex(codewords(one, count), codewords(two, count), 1)
    asked = sample[:2000]
    pick = np.random.default_rng(seed)
    if sample.shape[1] > 1:
        aside = pick.normal(size=asked.shape)
        aside -= (aside * asked).sum(axis=1, keepdims=True) * asked
        turned = cosine * asked + math.sqrt(1 - cosine * cosine) * unit(aside)
        index.visits = 1 + int(np.quantile(index.ranks(asked, index.cells(turned)), recall, method="higher"))
    return index


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's class (a hash of the numbers), and the numbers where they can link."""
    for batch in batches:
        keys, found, sizes = [], [], []
        for row in column(batch, "embedding"):
            numbers = None if row is None or any(x is None for x in row) else np.array(row, float)
            if numbers is None or not len(numbers) or not np.isfinite(numbers).all() or not numbers.any():
                keys.append(None)
                found.append(None)
                sizes.append(None)
                continue
            data = (numbers + 0.0).tobytes()
            keys.append(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True))
            short = numbers.astype(np.float32)
            found.append(short.tobytes() if (short == numbers).all() else data)
            sizes.append(len(numbers))
        ids = batch.column(batch.schema.get_field_index("vec_id"))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(keys, pa.int64()), pa.array(found, pa.binary()), pa.array(sizes, pa.int32())], names=["vec_id", "node", "vector", "size"]
        )


def _numbers(data: list[bytes], size: int) -> np.ndarray:
    """Unit vectors from stored ones, which are single precision where that says the same."""
    kinds = {True: np.float32, False: np.float64}
    return unit(np.array([np.frombuffer(d, kinds[len(d) == 4 * size]) for d in data], float).reshape(-1, size))


_PACK = "nodes binary, copies binary, cells binary, reaches binary, vectors binary"


@dataclass
class Pack:
    """Vectors side by side, as rows of arrays."""

    nodes: np.ndarray
    copies: np.ndarray
    cells: np.ndarray
    reaches: np.ndarray
    vectors: np.ndarray

    @classmethod
    def read(cls, row: dict, size: int, prefix: str = "") -> Pack:
        nodes, copies, cells, reaches = (
            np.frombuffer(row[prefix + n], k) for n, k in (("nodes", np.int64), ("copies", np.int64), ("cells", np.int64), ("reaches", np.float64))
        )
        kind = np.float32 if len(row[prefix + "vectors"]) == 4 * size * len(nodes) else np.float64
        return cls(nodes, copies, cells, reaches, np.frombuffer(row[prefix + "vectors"], kind).reshape(-1, size))


def _stored(nodes, copies, cells, reaches, vectors: list[bytes], size: int) -> pa.RecordBatch:
    """A pack as a row; its vectors are single precision if all of them are stored so."""
    if any(len(v) != 4 * size for v in vectors):
        vectors = [np.frombuffer(v, np.float32).astype(float).tobytes() if len(v) == 4 * size else v for v in vectors]
    arrays = [np.asarray(nodes, np.int64), np.asarray(copies, np.int64), np.asarray(cells, np.int64), np.asarray(reaches, np.float64)]
    return pa.record_batch([pa.array([x], pa.binary()) for x in (*(a.tobytes() for a in arrays), b"".join(vectors))], names=[c.split()[0] for c in _PACK.split(", ")])


def _asked(shared, size: int, limit: int):
    """Packs of queries: vectors as they are read, with their cells and reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        held: tuple[list, ...] = ([], [], [], [], [])
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                batch = whole.slice(at, min(500, limit - len(held[0])))
                at += batch.num_rows
                data = column(batch, "vector")
                cells, reaches = index.filed(_numbers(data, size))
                for kept, new in zip(held, (column(batch, "node"), column(batch, "copies"), cells.tolist(), reaches.tolist(), data), strict=True):
                    kept += new
                if len(held[0]) >= limit:
                    yield _stored(*held, size)
                    held = ([], [], [], [], [])
        if held[0]:
            yield _stored(*held, size)

    return run


def _routes(wide: int):
    """How many vectors of a pack have each first codeword."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in column(batch, "cells"):
                routes, counts = np.unique(np.frombuffer(cells, np.int64) // wide, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(routes, pa.int64()), pa.array(counts, pa.int64())], names=["route", "vectors"])

    return run


def placed_routes(counts: dict[int, int], limit: int) -> dict[int, tuple[int, int]]:
    """The first pack of each first codeword and how many packs it has; neighbours share a pack while it has room."""
    places, last, room = {}, -1, 0
    for route, count in sorted(counts.items()):
        if count > limit:
            number = -(-count // limit)
            places[route], last, room = (last + 1, number), last + number, 0
            continue
        if count > room:
            last, room = last + 1, limit
        places[route], room = (last, 1), room - count
    return places


_UNPACKED = "pack long, node long, copies long, cell long, reach double, vector binary"


def _unpacked(places: dict[int, tuple[int, int]], wide: int, size: int):
    """A row for each vector, with the pack it is filed in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack.read(row, size)
                first, number = np.array([places[r] for r in (pack.cells // wide).tolist()], np.int64).T
                own = first + (mix(pack.nodes.view(np.uint64)) % number.astype(np.uint64)).astype(np.int64)
                data = [v.tobytes() for v in pack.vectors]
                arrays = [pa.array(x) for x in (own, pack.nodes, pack.copies, pack.cells, pack.reaches)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(data, pa.binary())], names=[c.split()[0] for c in _UNPACKED.split(", ")])

    return run


def _filed(size: int):
    """A pack of filed vectors, ascending by cell."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cell")
        return pa.Table.from_batches([_stored(*(table[n].to_numpy() for n in ("node", "copies", "cell", "reach")), table["vector"].to_pylist(), size)])

    return run


_FOUND = "node long, links long, peer long"


def _verified(shared, size: int, cosine: float):
    """Links between filed vectors and the queries that visit their cells: counts by node, and trees of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        last: list = [None, None]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                # One side stays for many rows.
                if last[0] != row["nodes"]:
                    asked = Pack.read(row, size)
                    q = unit(asked.vectors.astype(float))
                    last[0], one, two = row["nodes"], *(np.ascontiguousarray(d.T) for d in index.whole_distances(q))
                if last[1] != row["x_nodes"]:
                    filed = Pack.read(row, size, "x_")
                    last[1], x = row["x_nodes"], unit(filed.vectors.astype(float))
                yield _links(index, asked, q, one, two, filed, x, cosine)

    return run


def _links(index: MultiIndex, asked: Pack, q: np.ndarray, one: np.ndarray, two: np.ndarray, filed: Pack, x: np.ndarray, cosine: float) -> pa.RecordBatch:
    """What a pack of queries, with their distances by codeword, finds in a pack of filed vectors."""
    wide = len(index.second)
    q_links, x_links, tree = np.zeros(len(q), np.int64), np.zeros(len(x), np.int64), []
    cells, begins = np.unique(filed.cells, return_index=True)
    ends = np.append(begins[1:], len(x))
    least = two.min(axis=0)
    for route in np.unique(cells // wide).tolist():
        left = asked.reaches - one[route]
        may = np.flatnonzero(least <= left)
        if not len(may):
            continue
        own = np.flatnonzero(cells // wide == route)
        which, who = np.nonzero(two[np.ix_(cells[own] % wide, may)] <= left[may])
        edges = np.searchsorted(which, np.arange(len(own) + 1))
        for n, cell in enumerate(own.tolist()):
            come = may[who[edges[n] : edges[n + 1]]]
            if not len(come):
                continue
            step = max(1, HELD // len(come))
            for at in range(int(begins[cell]), int(ends[cell]), step):
                here = slice(at, min(at + step, int(ends[cell])))
                links = q[come] @ x[here].T >= cosine
                if not links.any():
                    continue
                links &= asked.nodes[come][:, None] != filed.nodes[here][None, :]
                some = np.flatnonzero(links.any(axis=1))
                if not len(some):
                    continue
                rows, links = come[some], links[some]
                q_links[rows] += links @ filed.copies[here]
                # Queries whose cell the filed vector does not visit itself: it would not find these links.
                back_one, back_two = index.whole_distances(x[here])
                seen = back_one[:, asked.cells[rows] // wide] + back_two[:, asked.cells[rows] % wide] <= filed.reaches[here][:, None]
                x_links[here] += (links.T & ~seen) @ asked.copies[rows]
                tree += _tree(links, asked.nodes[rows], filed.nodes[here])
    pairs = np.array(tree, np.int64).reshape(-1, 2)
    below, root = trees(pairs[:, 0], pairs[:, 1]) if tree else (np.zeros(0, np.int64),) * 2
    q_some, x_some = np.flatnonzero(q_links), np.flatnonzero(x_links)
    counted = len(q_some) + len(x_some)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([asked.nodes[q_some], filed.nodes[x_some], below])),
            pa.array(np.concatenate([q_links[q_some], x_links[x_some], np.zeros(len(below), np.int64)])),
            pa.concat_arrays([pa.nulls(counted, pa.int64()), pa.array(root, pa.int64())]),
        ],
        names=["node", "links", "peer"],
    )


def _tree(links: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all of a block's links connect."""
    free_row, free_column, found = links.any(axis=1), np.ones(links.shape[1], bool), []
    for root in np.flatnonzero(free_row).tolist():
        if not free_row[root]:
            continue
        free_row[root] = False
        front = [(True, root)]
        while front:
            is_row, at = front.pop()
            near = np.flatnonzero(links[at] & free_column) if is_row else np.flatnonzero(links[:, at] & free_row)
            (free_column if is_row else free_row)[near] = False
            for k in near.tolist():
                found.append((int(rows[at]), int(columns[k])) if is_row else (int(rows[k]), int(columns[at])))
                front.append((not is_row, k))
    return found


def link_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    read = checked(map_arrow(rows, _classes, "vec_id long, node long, vector binary, size int"), "vectors")
    lengths = read.where("size is not null and vec_id is not null").groupBy("size").count()
    most = lengths.agg(F.max_by("size", F.struct("count", -F.col("size")))).first()[0]
    able = read.where((F.col("size") == F.lit(most)) & F.col("vec_id").isNotNull()) if most else read.where(F.lit(False))
    whole = checked(
        able.groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")), "vector-classes"
    )
    # Each table of vectors is deleted once the next one is made of it.
    ids = checked(read.select("vec_id", "node"), "vector-ids")
    discard(read)
    classes = checked(whole.select("node", "copies", "least"), "vector-copies")
    number = classes.count()
    links = spark.createDataFrame([], _FOUND)
    if number > 1:
        last = int(-(2**63) + 2**64 * min(1.0, 0.95 * sample / number)) - 1
        rank = F.xxhash64("node", F.lit(3))
        drawn = whole.where(rank <= last).orderBy(rank).limit(sample).select("vector").toArrow()["vector"].to_pylist()
        index = fit_index(_numbers(drawn, most), number, cosine, recall)
        shared = spark.sparkContext.broadcast(index)
        wide = len(index.second)
        asks, files = (max(1, min(limit, PACK_BYTES // (8 * most), max(512, -(-number // PACKS)))) for limit in (ASKED, FILED))
        asked = checked(map_arrow(whole.select("node", "copies", "vector"), _asked(shared, most, asks), _PACK), "vector-asked")
        # A row for each first codeword: at most LARGEST.
        counts = map_arrow(asked.select("cells"), _routes(wide), "route long, vectors long").groupBy("route").agg(F.sum("vectors").alias("vectors"))
        places = placed_routes({r["route"]: r["vectors"] for r in counts.collect()}, files)
        filed = map_arrow(asked, _unpacked(places, wide, most), _UNPACKED).groupBy("pack").applyInArrow(_filed(most), _PACK)
        filed = checked(filed, "vector-filed")
        # Packs meet where they are read: nothing is shuffled, and a task holds one of each side.
        met = asked.crossJoin(filed.toDF(*[f"x_{c}" for c in filed.columns]).hint("shuffle_replicate_nl"))
        links = checked(map_arrow(met, _verified(shared, most, cosine), _FOUND), "vector-links")
        discard(asked, filed)
    discard(whole)
    roots = components(links.where("peer is not null").select(F.col("node").alias("a"), F.col("peer").alias("b")), "vector-roots")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(roots, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(smallest, "root").select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component")
    linkable = F.col("vec_id").isNotNull()
    return (
        ids.select("vec_id", F.when(linkable, F.col("node")).alias("node"))
        .join(found, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            (F.col("vec_id") == F.coalesce("component", "vec_id")).alias("kept"),
        )
    )
