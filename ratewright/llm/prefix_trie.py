"""The trie of conversation prefixes, by bursting containers of suffixes.

A turn's id is a digest of its role and text. A node of the trie is a distinct sequence of first turns. Conversations that
are equal as a whole are one *sequence* with several members; a sequence's ids, one after another, are one binary value.

1. *Containers.* All sequences begin in the container of the root. A container that holds more sequences or turns than its bound
   bursts: its sequences go to containers of their own by the next turn id (twice as many ids with each round from the third on,
   so that a path which many sequences share takes few rounds); a sequence that ends on the way has a container of its own.
   What a container's sequences have in common is the path to its *head*.
2. *Shards.* Containers are dealt to tasks by hash and sorted by suffix. One pass over sorted suffixes keeps the nodes of the
   current one open, and closes those that the next does not share; a closed node's counts go to its parent.
3. *Heads.* Nodes on the paths to heads are aggregated by path digest from what the containers below them sum up to.

No node's members meet in one task: members are counted; for the digest of ids that end at a node the ids are sorted by
ranges, joined to pieces of text in many tasks, and only the pieces of one node are hashed one after another (as such a
digest must be), held one piece at a time.

Rows: turns go by turn, null first, then role, then text; null role or text is empty. Repeated rows are turns of their own. Rows without
``conv_id`` belong to no conversation and are left out. A conversation's ids (not its texts) are one row, 24 bytes a turn. An empty
table gives no rows. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.common import checked, map_arrow
from ratewright.operators.joins import small_side

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn id.
ID = 16
#: Sequences and turns of a container that does not burst.
SEQUENCES, TURNS = 1024, 1 << 17
#: Members whose ids are one piece of text.
PIECE = 4096
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_EMPTY = hashlib.sha256(b"").hexdigest()


def _digest(value):
    return F.substring(F.unhex(F.sha2(value, 256)), 1, ID)


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of id and words) of rows (conv_id, turn, role, text), turns in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length of the role says where the text begins.
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        _digest(said).alias("id"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    placed = turns.select("conv_id", place.alias("place"), "id", "words")
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "words"))).alias("turns"))
    return gathered.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def with_shared_heads(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first ``crc32(c) % most`` turns taken from conversation ``c - c % every``."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = checked(convs.withColumn("head", head.cast("int")), "trie-turns")
    lenders = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_lender"), F.slice("turns", 1, most - 1).alias("lent")
    )
    joined = convs.join(lenders, F.col("conv_id") - F.col("conv_id") % every == F.col("_lender"), "left")
    nothing = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("lent", F.lit(1), F.col("head")), nothing), own).alias("turns"))


# ---------------------------------------------------------------- sequences and their members


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of members of one sequence, as they come sorted, joined to pieces."""
    key, ids = None, []
    out: list[tuple] = []

    def close():
        if ids:
            out.append((key, ids[0], len(ids), ",".join(map(str, ids))))

    for batch in batches:
        for sequence, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if sequence != key or len(ids) >= PIECE:
                close()
                key, ids = sequence, []
            ids.append(member)
        # Single members give a short piece each, long pieces are few.
        if out:
            yield _arrow(out, _PIECES)
            out = []
    close()
    if out:
        yield _arrow(out, _PIECES)


_PIECES = pa.schema([("sequence", pa.binary()), ("first", pa.int64()), ("members", pa.int64()), ("piece", pa.string())])
_MEMBERS = pa.schema([("sequence", pa.binary()), ("conv_id", pa.int64()), ("members", pa.int64()), ("ends", pa.string())])


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each sequence's pieces, which come in order."""
    key, first, number, digest = None, None, 0, None
    out: list[tuple] = []
    for batch in batches:
        for sequence, start, members, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sequence != key:
                if key is not None:
                    out.append((key, first, number, digest.hexdigest()))
                key, first, number, digest = sequence, start, 0, hashlib.sha256()
            elif number:
                digest.update(b",")
            digest.update(piece.encode())
            number += members
        if out:
            yield _arrow(out, _MEMBERS)
            out = []
    if key is not None:
        yield _arrow([*out, (key, first, number, digest.hexdigest())], _MEMBERS)


def sequences(convs: DataFrame) -> DataFrame:
    """Distinct sequences of turns: ``conv_id`` (the smallest member), ``members, ends`` (digest of the members' ids), ``ids, words``."""
    whole = F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")
    read = convs.select(
        "conv_id", F.unhex(whole).alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"), _digest(whole.cast("binary")).alias("sequence")
    )
    read = checked(read, "trie-conversations")
    # Ranges of (sequence, id): a sequence that very many conversations have is spread over tasks.
    members = read.select("sequence", "conv_id").repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    pieces = checked(map_arrow(members, _pieces, "sequence binary, first long, members long, piece string"), "trie-pieces")
    ordered = pieces.repartition("sequence").sortWithinPartitions("sequence", "first")
    hashed = checked(map_arrow(ordered, _hashed, "sequence binary, conv_id long, members long, ends string"), "trie-members")
    return hashed.select("conv_id", "members", "ends").join(read.select("conv_id", "ids", "words"), "conv_id")


# ---------------------------------------------------------------- containers


def _prefix(depth):
    return F.substr(F.col("ids"), F.lit(1), depth * ID)


def _length():
    return F.floor(F.length("ids") / ID).cast("int")


def containers(found: DataFrame, most: int = SEQUENCES, turns: int = TURNS) -> DataFrame:
    """The sequences with ``head`` (digest of the path to their container's head) and ``depth`` (its length)."""
    opened = checked(found.withColumn("depth", F.lit(0)).withColumn("head", _digest(F.lit("").cast("binary"))), "trie-open")
    done, step, rounds = None, 1, 0
    while True:
        sizes = opened.groupBy("head", "depth").agg(F.count(F.lit(1)).alias("held"), F.sum(_length() - F.col("depth")).alias("turns"))
        large = sizes.where((F.col("held") > 1) & ((F.col("held") > most) | (F.col("turns") > turns)))
        large = checked(large.select(F.col("head").alias("_head"), F.col("depth").alias("_depth")), "trie-large")
        same = (F.col("head") == F.col("_head")) & (F.col("depth") == F.col("_depth"))
        large = small_side(large)
        small = opened.join(large, same, "left_anti")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            return done
        next_depth = F.least(F.col("depth") + step, _length())
        burst = opened.join(large, same, "left_semi").withColumn("depth", next_depth)
        opened = checked(burst.withColumn("head", _digest(_prefix(F.col("depth")))), "trie-open")
        rounds += 1
        step = 1 if rounds < 2 else 2 * step


# ---------------------------------------------------------------- sweeping

_OUT = pa.schema(
    [
        ("head", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ]
)
_OUT_DDL = f"head binary, {NODE}"


class _Node:
    """An open node; ``closed`` are its children, which wait for its smallest member."""

    __slots__ = ("depth", "words", "members", "least", "ends", "children", "leaves", "saved", "closed")

    def __init__(self, depth: int, words: int):
        self.depth, self.words = depth, words
        self.members = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.closed = None, _EMPTY, []


def _close(open_nodes: list[_Node], depth: int, out: list[tuple]) -> None:
    """Close the nodes below ``depth`` (counted from the container's head)."""
    while len(open_nodes) > depth + 1:
        node, parent = open_nodes.pop(), open_nodes[-1]
        node.leaves = node.leaves or 1
        node.saved += (node.members - 1) * node.words
        out.extend(child[:3] + (node.least,) + child[4:] for child in node.closed)
        parent.closed.append((None, node.least, node.depth, None, node.members, node.children, node.leaves, node.saved, node.ends))
        parent.members += node.members
        parent.least = node.least if parent.least is None else min(parent.least, node.least)
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved


def _finish(head: bytes, open_nodes: list[_Node], out: list[tuple]) -> None:
    """Close a container; its head's row carries ``head``, and in place of the whole subtree's values those below it."""
    _close(open_nodes, 0, out)
    top = open_nodes[0]
    out.extend(child[:3] + (top.least,) + child[4:] for child in top.closed)
    out.append((head, top.least, top.depth, None, top.members, top.children, top.leaves, top.saved, top.ends))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes below the heads of containers whose suffixes come sorted."""
    current, before, open_nodes = None, b"", []
    out: list[tuple] = []
    for batch in batches:
        for head, depth, least, members, ends, suffix, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if head != current:
                if current is not None:
                    _finish(current, open_nodes, out)
                current, before, open_nodes = head, b"", [_Node(depth, 0)]
            shared, most = 0, min(len(before), len(suffix))
            while shared < most and before[shared : shared + ID] == suffix[shared : shared + ID]:
                shared += ID
            _close(open_nodes, shared // ID, out)
            for count in words[shared // ID :]:
                open_nodes.append(_Node(depth + len(open_nodes), count))
            last = open_nodes[-1]
            last.members += members
            last.least = least if last.least is None else min(last.least, least)
            last.ends = ends
            before = suffix
            if len(out) >= 8192:
                yield _arrow(out, _OUT)
                out = []
    if current is not None:
        _finish(current, open_nodes, out)
    if out:
        yield _arrow(out, _OUT)


# ---------------------------------------------------------------- heads


def _head_nodes(tops: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes on the paths to heads, the heads among them, from the rows of heads and one path for each."""
    held = tops.join(paths, "head").select(
        "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "ids", "words"
    )
    steps = held.select("*", F.explode(F.sequence(F.lit(0), F.col("depth").cast("int"))).alias("at"))
    key = _digest(_prefix(F.col("at")))
    above = F.when(F.col("at") > 0, _digest(_prefix(F.col("at") - 1)))
    at_head = F.col("at") == F.col("depth")
    nodes = steps.select(
        key.alias("key"), above.alias("above"), "at", "conv_id", "n_convs", "n_leaves", "saved_tokens", "ids",
        F.coalesce(F.get("words", F.col("at") - 1), F.lit(0)).alias("count"),
        F.when(at_head, F.col("n_children")).otherwise(0).alias("n_children"),
        F.when(at_head, F.col("ends_sha256")).otherwise(F.lit(_EMPTY)).alias("ends"),
    ).groupBy("key").agg(
        F.first("above").alias("above"), F.first("at").alias("at"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_leaves").alias("leaves_below"), F.sum("saved_tokens").alias("saved_below"), F.first("count").alias("count"),
        F.sum("n_children").alias("n_children"), F.max(F.when(F.col("ends") != _EMPTY, F.col("ends"))).alias("ends"),
        F.first(_prefix(F.col("at"))).alias("path"),
    )
    nodes = checked(nodes, "trie-heads")
    of_parent = nodes.where("above is not null").groupBy(F.col("above").alias("key")).agg(F.count(F.lit(1)).alias("head_children"))
    nodes = checked(
        nodes.join(of_parent, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("head_children", F.lit(0))), "trie-heads"
    )
    # What a node itself adds goes to all nodes on its path.
    own = nodes.select(
        F.explode(F.transform(F.sequence(F.lit(0), "at"), lambda d: F.substring(F.unhex(F.sha2(F.substr("path", F.lit(1), d * ID), 256)), 1, ID))).alias("key"),
        ((F.col("n_convs") - 1) * F.col("count")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    ).groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    parents = nodes.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(own, "key").join(parents, "above", "left").select(
        "conv_id", F.col("at").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves_below") + F.col("leaves")).alias("n_leaves"),
        (F.col("saved_below") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def trie(convs: DataFrame, most: int = SEQUENCES, turns: int = TURNS) -> DataFrame:
    """One row (``NODE``) per node of the trie of conversations (conv_id, turns), see :func:`conversations`.

    A node goes by its smallest member and its depth. ``most`` sequences or ``turns`` turns are a container's bound.
    """
    placed = checked(containers(sequences(convs), most, turns), "trie-containers")
    suffix = F.substr(F.col("ids"), F.col("depth") * ID + 1, F.length("ids"))
    rest = F.slice("words", F.col("depth") + 1, F.greatest(F.size("words") - F.col("depth"), F.lit(0)))
    rows = placed.select("head", F.col("depth").cast("long").alias("depth"), "conv_id", "members", "ends", suffix.alias("suffix"), rest.alias("words"))
    swept = checked(map_arrow(rows.repartition("head").sortWithinPartitions("head", "suffix"), _sweep, _OUT_DDL), "trie-nodes")
    path = F.struct(_prefix(F.col("depth")).alias("ids"), F.slice("words", F.lit(1), F.col("depth")).alias("words"))
    paths = placed.groupBy("head").agg(F.min_by(path, "conv_id").alias("path")).select("head", "path.*")
    below = swept.where("head is null").drop("head")
    return below.unionByName(_head_nodes(swept.where("head is not null"), paths))
