"""Exact self-join of texts by the Jaccard similarity of their word n-grams, as a join in a metric space.

``d = 1 - similarity`` is a metric on sets; texts link where ``100 * both >= percent * either``, so within
``reach = 1 - percent / 100``. Texts of one set are one vertex.

1. *Who can link at all.* Of a set of n n-grams, in one order of all n-grams, the first ``n - ceil(percent * n / 100) + k``
   share at least k members with those of any partner. An n-gram that stands in one set only cannot be shared, so
   sets with too few shared members there have no partner and go.
2. *Far regions.* What is left is cut into parts by hash. Linked sets differ in at most D members, so of more than D parts
   one is equal. Sets with an equal part are chained into regions; no link leaves a region. A common passage chains many sets,
   so a region that is too large for a task is chained again, by those members of each set that are rarest in the region.
3. *Pivots.* A region that this leaves nearly whole and too large gets pivots. Every set's distance from them is exact, which links sets
   to pivots; the nearest pivot gives the set's Voronoi cell, and since ``d(x, q) - d(x, p) <= 2 * reach`` holds
   for a partner in the cell of q, sets inside that window are copied to q's cell too. Sets that are linked with
   the pivots need no test among each other; of these only those stay whose distances lie within ``reach`` of the range of the others'.
   Cells are regions again. A region that pivots cannot make smaller is cut into shells by size, the distance from the empty set,
   and shells that are still too large into blocks, each pair of blocks a region.
4. *Small regions* are compared within a task, all sets with all.

Nothing is capped: step 3 goes on until all regions are small. Links are kept as trees (they connect what is connected).

N-grams and sets are told apart by 64-bit hashes. Null texts and texts without words have no n-grams and link with nothing;
texts of fewer words than an n-gram have one, all their words. A null id counts for no component's
smallest id. Repeated rows belong to the same vertex. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import checked, column, discard, give_back, hashed_words, map_arrow, mix, most_frequent, slices, texts_of
from ratewright.llm.graph import components
from ratewright.operators.joins import small_side

WORDS, PERCENT = 5, 80
#: Sets, and members of all sets together, that a task compares at once.
REGION_SETS, REGION_MEMBERS = 1024, 2_000_000
PIVOTS = 8
#: Slots of the bitmaps that are sent to all tasks, and the share of them that may be filled.
SLOTS, FILLED = 1 << 25, 0.25
#: Text bytes whose n-grams a task holds at once.
READ_BYTES = 4 << 20
#: N-grams that may be last in the order of all; the others go by hash. Any order gives the same links.
LATE = 1 << 17
_ALL = (1 << 64) - 1
_ODD = [np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & _ALL) for k in range(1, 65)]


# ---------------------------------------------------------------- sets


def ngram_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    hashes, counts = hashed_words(texts)
    n = len(hashes)
    joined = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        joined += mix(hashes[k : n - words + 1 + k] * _ODD[k]) if len(joined) else 0
    joined = mix(joined)
    found, at = [], 0
    for count in counts.tolist():
        if count >= words:
            found.append(np.unique(joined[at : at + count - words + 1]))
        elif count:
            whole = sum(int(mix(hashes[at + k : at + k + 1] * _ODD[k])[0]) for k in range(count)) + 0xABCD * count
            found.append(mix(np.array([whole & _ALL], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
        at += count
    return found


def fingerprint(members: np.ndarray) -> int:
    """A hash of the set, as a signed 64-bit number."""
    total = int(mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)) + len(members) * int(_ODD[0])
    return int(mix(np.array([total & _ALL], np.uint64)).view(np.int64)[0])


def least_common(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def looked_at(size: int, percent: int) -> int:
    """Members at the front of a set's order that are looked at."""
    return size - least_common(size, percent) + 1 + size // 16


def needed(size: int, percent: int) -> int:
    """Shared members among these that a set with a partner has; the partner may be smaller."""
    return 1 + least_common(size, percent) // 16


def _fingerprints(words: int):
    """A row per text; and n-grams that are frequent where they were read, as the order's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=READ_BYTES):
                sets = ngram_sets(texts_of(part), words)
                prints = [fingerprint(s) for s in sets]
                distinct = {p: s for p, s in zip(prints, sets, strict=True)}
                members, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *distinct.values()]), return_counts=True)
                often = np.flatnonzero(times >= 4)
                often = often[np.argsort(-times[often], kind="stable")][:4096]
                rows = part.num_rows
                yield pa.record_batch(
                    [
                        pa.concat_arrays([_column(part, "doc_id"), pa.nulls(len(often), pa.int64())]),
                        pa.array([len(s) for s in sets] + [-1] * len(often), pa.int64()),
                        pa.array(prints + members[often].view(np.int64).tolist(), pa.int64()),
                        pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(times[often], pa.int64())]),
                    ],
                    names=["doc_id", "size", "node", "times"],
                )

    return run


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _fronts(words: int, percent: int, shared):
    """The members that are looked at, of each set once where it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, order = shared.value
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, limit=READ_BYTES):
                keys, nodes, sizes = [], [], []
                for members in ngram_sets(texts_of(part), words):
                    node = fingerprint(members)
                    if not len(members) or node in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(node)
                    if len(often):
                        place = np.minimum(np.searchsorted(often, members), len(often) - 1)
                        late = np.where(often[place] == members, order[place], 0)
                        if late.any():
                            members = members[np.lexsort((members, late))]
                    front = members[: looked_at(len(members), percent)]
                    keys.append(front)
                    nodes.append(np.full(len(front), node, np.int64))
                    sizes.append(np.full(len(front), len(members), np.int32))
                if keys:
                    yield pa.record_batch(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))],
                        names=["key", "node", "size"],
                    )

    return run


# ---------------------------------------------------------------- bitmaps


def restricted(rows: DataFrame, by: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``by`` is in ``wanted`` (a table of that one column), or a few more: a bitmap of bounded
    size where it does not get too full, else a join."""
    if wanted.count() > FILLED * SLOTS:
        return rows.join(wanted, by, "left_semi")
    slot = F.pmod(F.xxhash64(by), F.lit(SLOTS))
    bits = wanted.select(F.shiftright(slot, 6).alias("_word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{by}`), 64) as int))").alias("bit"))
    bitmap = bits.groupBy("_word").agg(F.bit_or("bit").alias("_bits"))
    # At most SLOTS / 64 rows of 16 bytes.
    kept = rows.withColumn("_word", F.shiftright(slot, 6)).join(F.broadcast(bitmap), "_word")
    return kept.where(F.expr(f"(_bits & shiftleft(1L, cast(pmod(xxhash64(`{by}`), 64) as int))) <> 0")).drop("_word", "_bits")


# ---------------------------------------------------------------- regions


def level_of(size: int, percent: int) -> int:
    return int(math.log(size) / math.log(100 / percent) + 1e-9)


def parts_of(members: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the set's parts, for its own size level and the levels of smaller partners."""
    size = len(members)
    keys = []
    for level in range(level_of(least_common(size, percent), percent), level_of(size, percent) + 1):
        top = max(1, math.ceil((100 / percent) ** (level + 1) * (1 + 1e-9)))
        differ = top * (100 - percent) // percent
        spare = 0
        if differ:
            spare = 3 + int(2 * (differ + 4) * math.exp(-max(1.0, top * percent / 100 / (differ + 4))))
        count = differ + 1 + spare
        part = (mix(members + np.uint64(77)) % np.uint64(count)).astype(np.int64)
        sums = np.zeros(count, np.uint64)
        np.add.at(sums, part, mix(members ^ np.uint64(0x5DEECE66D)))
        filled = np.bincount(part, minlength=count)
        # Where so many parts are empty that the equal ones could all be, empty parts count as equal too.
        used = np.arange(count) if (filled == 0).sum() >= count - differ else np.flatnonzero(filled)
        own = mix(sums[used] + filled[used].astype(np.uint64) * _ODD[3])
        keys.append(mix(own + used.astype(np.uint64) * _ODD[1] + np.uint64((level + 1) * int(_ODD[2]) & _ALL)))
    return np.concatenate(keys)


def _kept_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            for part in slices(batch, limit=READ_BYTES):
                rows = []
                for doc, members in zip(column(part, "doc_id"), ngram_sets(texts_of(part), words), strict=True):
                    node = fingerprint(members)
                    if len(members) and (doc, node) not in seen:
                        if len(seen) >= 1_000_000:
                            seen.clear()
                        seen.add((doc, node))
                        rows.append((doc, node, len(members), members.tobytes()))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.record_batch(columns, names=["doc_id", "node", "size", "members"])

    return run


def _parts(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, members in zip(column(batch, "node"), column(batch, "members"), strict=True):
                keys = parts_of(np.frombuffer(members, np.uint64), percent).view(np.int64)
                yield pa.record_batch([pa.array(keys), pa.array(np.full(len(keys), node, np.int64))], names=["key", "node"])

    return run


def common(one: np.ndarray, other: np.ndarray) -> int:
    """Members of both of two sorted sets."""
    if len(one) > len(other):
        one, other = other, one
    place = np.minimum(np.searchsorted(other, one), len(other) - 1)
    return int((other[place] == one).sum())


def linked(both, one, other, percent: int):
    return 100 * both >= percent * (one + other - both)


def _shared_members(sets: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of two sets or more, as ascending numbers from 0, and the sets that hold them; others add nothing to what two sets share."""
    member = np.concatenate(sets)
    order = np.argsort(member, kind="stable").astype(np.int32 if len(member) < 1 << 31 else np.int64)
    member = member[order]
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order]
    del order
    same = member[1:] == member[:-1]
    none = np.zeros(1, bool)
    before, after = np.concatenate([none, same]), np.concatenate([same, none])
    kept = before | after
    return np.cumsum(~before[kept], dtype=np.int64) - 1, owner[kept]


def tree_of(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever all links among these sets connect."""
    sizes = np.array([len(s) for s in sets], np.int64)
    member, owner = _shared_members(sets, sizes)
    both = np.zeros((len(sets), len(sets)), np.float32)
    last = int(member[-1]) + 1 if len(member) else 0
    for low in range(0, last, 2048):
        some = slice(*np.searchsorted(member, [low, low + 2048]))
        block = np.zeros((len(sets), min(2048, last - low)), np.float32)
        block[owner[some], member[some] - low] = 1
        both += block @ block.T
    links = linked(both.astype(np.int64), sizes[:, None], sizes[None, :], percent)
    free, found = np.ones(len(sets), bool), []
    for root in range(len(sets)):
        if not free[root]:
            continue
        free[root] = False
        front = [root]
        while front:
            at = front.pop()
            for near in np.flatnonzero(links[at] & free).tolist():
                free[near] = False
                found.append((nodes[at], nodes[near]))
                front.append(near)
    return found


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each member of each set; members are told apart by region."""
    for whole in batches:
        for batch in slices(whole, "members", READ_BYTES):
            sets = [np.frombuffer(m, np.uint64) for m in column(batch, "members")]
            place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            region = mix(_column(batch, "region").to_numpy().view(np.uint64) + _ODD[5])[place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(np.concatenate(sets) ^ region).view(np.int64)), *(_column(batch, n).take(pa.array(place)) for n in ("vertex", "size"))],
                names=["key", "vertex", "size"],
            )


def _rare_chains(large: DataFrame, percent: int) -> DataFrame:
    """``region, before, node, size, members``: regions of sets that are chained by members which few sets of their region have.

    With the members of a region's sets in one order, of a set of n the first ``n - ceil(percent * n / 100) + 1`` hold one that is
    among the first of any partner. The order is from rare to frequent within the region, so that a passage which many sets have comes
    last. Members of one set only are its first; a set whose first ones are all of this kind has no partner and goes.
    """
    placed = checked(large.withColumn("vertex", F.xxhash64("region", "node")), "jaccard-placed")
    rows = checked(map_arrow(placed.select("region", "vertex", "size", "members"), _members, "key long, vertex long, size int"), "jaccard-members")
    times = checked(rows.groupBy("key").agg(F.count("*").alias("times")).where("times > 1"), "jaccard-times")
    shared = restricted(rows, "key", times.select("key")).join(times, "key")
    ordered = shared.groupBy("vertex", "size").agg(F.array_sort(F.collect_list(F.struct("times", "key"))).alias("shared"))
    size = F.col("size")
    first = F.size("shared") - F.ceil(F.lit(percent) * size / 100) + 1
    front = ordered.withColumn("first", first.cast("int")).where("first > 0")
    front = checked(front.select("vertex", F.explode(F.slice("shared.key", F.lit(1), F.col("first"))).alias("key")), "jaccard-rare")
    discard(rows, times)
    centres = front.groupBy("key").agg(F.min("vertex").alias("a"), F.max("vertex").alias("last")).where("a < last").select("key", "a")
    links = front.join(centres, "key").select("a", F.col("vertex").alias("b")).where("a <> b").distinct()
    roots = checked(components(links, "jaccard-chains"), "jaccard-chained")
    discard(front)
    found = placed.join(small_side(roots), placed["vertex"] == roots["node"]).select(
        F.xxhash64("region", "root").alias("region"), F.col("region").alias("before"), placed["node"], "size", "members"
    )
    found = checked(found, "jaccard-divided")
    discard(placed)
    return found


def _small_regions(percent: int):
    def run(table: pa.Table) -> pa.Table:
        first = dict(zip(table["node"].to_pylist(), table["members"].to_pylist(), strict=True))
        found = tree_of(list(first), [np.frombuffer(m, np.uint64) for m in first.values()], percent)
        if table.nbytes > READ_BYTES:
            del first
            give_back()
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


_DISTANCES = "region long, node long, size int, pivots array<long>, distances array<double>, links array<long>"


def _distances(percent: int):
    """Each set's distances from its region's pivots, and the pivots it links with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row comes with the sets of its pivots, so few rows are held as Python objects.
        for batch in (b.slice(at, 200) for b in batches for at in range(0, b.num_rows, 200)):
            distances, links, pivots = [], [], []
            for members, given in zip(column(batch, "members"), column(batch, "given"), strict=True):
                own = np.frombuffer(members, np.uint64)
                row, near, ids = [], [], []
                for pivot in given:
                    other = np.frombuffer(pivot["members"], np.uint64)
                    both = common(own, other)
                    row.append(1 - both / (len(own) + len(other) - both))
                    ids.append(pivot["node"])
                    if linked(both, len(own), len(other), percent):
                        near.append(pivot["node"])
                distances.append(row)
                links.append(near)
                pivots.append(ids)
            names = ["region", "node", "size"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(_column(batch, n) for n in names),
                    pa.array(pivots, pa.list_(pa.int64())),
                    pa.array(distances, pa.list_(pa.float64())),
                    pa.array(links, pa.list_(pa.int64())),
                ],
                names=[*names, "pivots", "distances", "links"],
            )

    return run


def _sizes(regions: DataFrame) -> DataFrame:
    return regions.groupBy("region").agg(F.count("*").alias("sets"), F.sum("size").alias("total"))


def _is_small():
    """Two sets are compared whatever their size."""
    return (F.col("sets") <= 2) | ((F.col("sets") <= REGION_SETS) & (F.col("total") <= REGION_MEMBERS))


def _pivot_round(large: DataFrame, percent: int, number: int) -> tuple[DataFrame, DataFrame]:
    """Links of sets with pivots, and the cells that are left to compare, without their members."""
    reach = 1 - percent / 100
    chosen = large.groupBy("region").agg(
        F.array_distinct(F.array(*(F.min_by("node", F.xxhash64("node", F.lit(number * PIVOTS + k))) for k in range(PIVOTS)))).alias("pivots")
    )
    chosen = checked(chosen.select("region", F.explode("pivots").alias("node")), "jaccard-pivots")
    given = large.select("region", "node", "members").join(small_side(chosen), ["region", "node"], "left_semi")
    given = checked(given.groupBy("region").agg(F.array_sort(F.collect_set(F.struct("node", "members"))).alias("given")), "jaccard-given")
    measured = checked(map_arrow(large.join(small_side(given), "region"), _distances(percent), _DISTANCES), "jaccard-distances")
    links = measured.select(F.col("node").alias("a"), F.explode("links").alias("b")).where("a <> b")
    roots = components(links, "jaccard-roots")
    named = measured.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The range of distances, by pivot, of sets that are not in the largest root's class of the region.
    main = named.groupBy("region", "root").count().groupBy("region").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    others = (
        named.join(main, "region")
        .where("root <> main")
        .select("region", F.posexplode("distances").alias("k", "d"))
        .groupBy("region", "k")
        .agg(F.min("d").alias("low"), F.max("d").alias("high"))
        .groupBy("region")
        .agg(F.array_sort(F.collect_list(F.struct("k", "low", "high"))).alias("ranges"))
    )
    kept = (
        named.join(main, "region")
        .join(others, "region")  # a region of one class has no others and is done
        .where(~F.array_contains("pivots", F.col("node")))  # all links of pivots are known
        .where(
            (F.col("root") != F.col("main"))
            | F.forall(
                F.arrays_zip("distances", "ranges"),
                lambda z: (z["distances"] >= z["ranges"]["low"] - reach - 1e-9) & (z["distances"] <= z["ranges"]["high"] + reach + 1e-9),
            )
        )
    )
    nearest = F.array_min("distances")
    cells = kept.select(
        "region",
        "node",
        "size",
        F.explode(
            F.filter(
                F.arrays_zip("pivots", "distances"), lambda z: z["distances"] <= nearest + 2 * reach + 1e-9
            )
        ).alias("cell"),
    ).select(F.xxhash64("region", F.col("cell.pivots"), F.lit(number)).alias("region"), F.col("region").alias("before"), "node", "size")
    return links, checked(cells, "jaccard-cells")


def _shells(large: DataFrame, percent: int) -> DataFrame:
    """Regions by distance from the empty set, which is a set's size: linked sets are in one shell or in neighbours.

    A set is in its own shell and, for larger partners, in the next; shells grow by the ratio that linked sizes may have.
    """
    level = F.log("size") / F.lit(math.log(100 / percent))
    shells = F.sequence(F.floor(level), F.floor(level + 1 + 1e-6))
    cells = large.select("region", F.explode(shells).alias("shell"), "node", "size", "members")
    return cells.select(F.xxhash64("region", "shell", F.lit(-1)).alias("region"), "node", "size", "members")


def _blocks(large: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each pair of blocks of a region as a region."""
    blocks = sizes.select(
        "region",
        F.ceil(F.greatest(F.col("sets") * 2.2 / REGION_SETS, F.col("total") * 2.2 / REGION_MEMBERS)).cast("long").alias("blocks"),
    )
    own = large.join(small_side(checked(blocks, "jaccard-blocks")), "region").withColumn("block", F.pmod(F.xxhash64("node", F.lit(91)), F.col("blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.xxhash64("region", F.least(k, F.col("block")), F.greatest(k, F.col("block"))),
    )
    return own.select(F.explode(pairs).alias("region"), "node", "size", "members")


def region_links(regions: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect each region (region, node, size, members) as all its links would."""
    found, number = [], 0
    while True:
        sizes = checked(_sizes(regions), "jaccard-sizes")
        small = regions.join(sizes.where(_is_small() & (F.col("sets") > 1)).select("region"), "region", "left_semi")
        found.append(small.groupBy("region").applyInArrow(_small_regions(percent), "a long, b long"))
        if not sizes.where(~_is_small()).head(1):
            break
        # So few regions that their ids, once measured, go to all tasks, and no set is moved.
        over = small_side(sizes.where(~_is_small()).select("region"))
        large = regions.join(over, "region", "left_semi")
        divided = _rare_chains(large, percent)
        # A region that is left nearly whole: its sets share more than passages.
        had = sizes.select(F.col("region").alias("before"), F.col("sets").alias("had"))
        after = _sizes(divided).join(divided.select("region", "before").distinct(), "region").join(had, "before")
        dense = checked(after.where(~_is_small() & (F.col("sets") > 0.8 * F.col("had"))).select("region", "sets"), "jaccard-dense")
        divided = divided.drop("before")
        if not dense.head(1):
            regions = divided
            number += 1
            continue
        over = small_side(dense.select("region"))
        large = checked(divided.join(over, "region", "left_semi"), "jaccard-large")
        apart = divided.join(over, "region", "left_anti")
        links, cells = _pivot_round(large, percent, number)
        found.append(links)
        # A cell nearly as large as its region: pivots do not tell its sets apart.
        had = dense.select(F.col("region").alias("before"), F.col("sets").alias("had"))
        after = _sizes(cells).join(cells.select("region", "before").distinct(), "region").join(had, "before")
        stuck = after.where(~_is_small() & (F.col("sets") > 0.8 * F.col("had"))).select("before").distinct()
        stuck = checked(stuck, "jaccard-stuck")
        again = cells.join(small_side(stuck), "before", "left_anti").select("region", F.col("before").alias("_before"), "node", "size")
        held = large.select(F.col("region").alias("_before"), "node", "members")
        again = again.join(held, ["_before", "node"]).select("region", "node", "size", "members")
        if stuck.head(1):
            whole = large.join(small_side(stuck.select(F.col("before").alias("region"))), "region", "left_semi")
            shells = checked(_shells(whole, percent), "jaccard-shells")
            again = again.unionByName(_blocks(shells, _sizes(shells)))
        regions = checked(again.unionByName(apart), "jaccard-regions")
        number += 1
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    # Stored, so that no task holds a Python worker for its regions and one more for what follows: workers stay, and keep tables of their own.
    return checked(links, "jaccard-region-links")


# ---------------------------------------------------------------- the join


def join_texts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = checked(map_arrow(texts, _fingerprints(words), "doc_id long, size long, node long, times long"), "jaccard-sets")
    sets = read.where("size >= 0").select("doc_id", "size", "node")
    often = checked(read.where("size < 0").groupBy("node").agg(F.sum("times").alias("times")), "jaccard-often")
    often = most_frequent(often, "times", LATE).toArrow()
    late, times = often["node"].to_numpy().view(np.uint64), often["times"].to_numpy()
    order = np.argsort(late)
    shared = spark.sparkContext.broadcast((late[order], np.log2(times[order] + 1).astype(np.int64) + 1))

    fronts = checked(map_arrow(texts.select("text"), _fronts(words, percent, shared), "key long, node long, size int"), "jaccard-fronts")
    repeated = checked(fronts.groupBy("key").count().where("count > 1").select("key"), "jaccard-repeated")
    enough = F.col("count") >= 1 + F.floor(F.ceil(F.lit(percent) * F.col("size") / 100) / 16)
    able = checked(restricted(fronts, "key", repeated).groupBy("node", "size").count().where(enough).select("node"), "jaccard-able")
    discard(fronts, repeated)

    # The members of a set come from one document; what else gets through the bitmap is left out at the next join.
    named = sets.where("doc_id is not null").join(able, "node", "left_semi")
    holders = checked(named.groupBy("node").agg(F.min("doc_id").alias("holder")), "jaccard-holders")
    rows = restricted(texts, "doc_id", holders.select(F.col("holder").alias("doc_id")).distinct())
    kept = map_arrow(rows.union(texts.where("doc_id is null")), _kept_sets(words), "doc_id long, node long, size int, members binary")
    kept = checked(kept, "jaccard-kept")

    parts = map_arrow(kept.select("node", "members"), _parts(percent), "key long, node long")
    parts = checked(parts, "jaccard-parts")
    centres = parts.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("key", "a")
    centres = checked(centres, "jaccard-centres")
    # Most parts are in one set only; they are left out before the join moves anything.
    equal = restricted(parts, "key", centres.select("key"))
    # Copies share most of their parts: each link is told once, not once by each task that reads some of its parts.
    alike = equal.join(centres, "key").select("a", F.col("node").alias("b")).where("a <> b").distinct()
    regions = components(alike, "jaccard-regions")
    discard(parts, centres)
    places = checked(regions.join(holders, "node", "left").select("node", F.col("root").alias("region"), "holder"), "jaccard-places")
    members = restricted(kept, "node", places.select("node"))
    held = places.where("holder is not null").join(members.withColumnRenamed("doc_id", "holder"), ["node", "holder"])
    lone = places.where("holder is null").drop("holder").join(members.where("doc_id is null"), "node")
    wanted = ("node", "region", "size", "members")
    near = checked(held.select(*wanted).union(lone.select(*wanted)), "jaccard-near")
    discard(kept, places, holders, able)
    links = region_links(near, percent)
    discard(near)
    roots = components(links, "jaccard-links")

    by_node = sets.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = by_node.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component"))
    named = classes.join(smallest, "root").select("node", "component")
    found = sets.where("size > 0").join(named, "node").select("doc_id", "size", "component")
    found = found.union(sets.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component")))
    return found.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without near duplicates: of each component the document with the smallest id stays.

    Rows of one id and text stay once, and so do rows of one text without id.
    """
    found = join_texts(docs.select("doc_id", "text"), words, percent)
    staying = found.where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(staying, docs["doc_id"].cast("long") == F.col("_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null").dropDuplicates(["text"]))
