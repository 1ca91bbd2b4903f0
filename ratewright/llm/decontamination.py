"""Benchmark passages in training texts, found with a positional inverted index.

The index is divided by documents: each task lists, for the documents it reads, the positions of every
benchmark term (term -> ascending positions in the joined token stream, documents apart). A phrase is
looked up from its rarest term there: the term's positions less its offset in the phrase are possible
starts, and the lists of the next rarer terms, less their offsets, are intersected with them until all
terms are used. All windows of all items go through each step together.

Items are sent to the tasks in blocks of at most ``block_bytes``; each block is a pass of its own over the
same rows inside the same stage, so a benchmark of any size works and no broadcast is larger than a block.

Null and empty texts have no words: no windows, no hits. An item shorter than a window is one window.
Repeated items count each by its id; repeated documents give a row each. Empty tables give no rows, or rows
without hits. Other columns of ``docs`` are kept as they are unless they have the name of a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.llm.common import kept, map_arrow, slices, texts_of

WINDOW = 10
BLOCK_BYTES = 16 << 20
#: Candidate starts that are tested at once.
_STEP = 1 << 21
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))
SPAN = "struct<item_id: bigint, start: bigint, length: bigint>"


def terms_of(text: bytes) -> list[bytes]:
    """ASCII letters, digits and bytes above ASCII, in runs, A-Z in lower case."""
    return text.translate(_TABLE).split()


class Phrases:
    """The windows of a block of items, by length."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, list[int]]] = {}
        self.item_ids = [i for i, _ in items]
        for place, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms_of(text)]
            n = min(window, len(ids))
            for start in range(len(ids) - n + 1 if n else 0):
                owners = by_length.setdefault(n, {}).setdefault(tuple(ids[start : start + n]), [])
                if not owners or owners[-1] != place:
                    owners.append(place)
        self.groups = [(np.array(list(w), np.int32).reshape(len(w), -1), list(w.values())) for w in by_length.values()]


class Index:
    """Positions of the phrases' terms in some documents."""

    def __init__(self, texts: list[bytes], phrases: Phrases, window: int):
        get, gap = phrases.vocabulary.get, [-1] * window
        stream: list[int] = list(gap)
        self.starts, self.lengths = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            found = [get(t, -1) for t in terms_of(text)]
            self.starts[row], self.lengths[row] = len(stream), len(found)
            stream += found
            stream += gap
        self.stream = np.array(stream, np.int32)
        known = np.flatnonzero(self.stream >= 0)
        order = np.argsort(self.stream[known], kind="stable")
        self.positions = known[order]
        self.counts = np.bincount(self.stream[known], minlength=len(phrases.vocabulary)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def exact(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of window number and start in the stream."""
        counts = self.counts[windows]
        rarest = np.argsort(counts, axis=1, kind="stable")
        live = np.flatnonzero(counts.min(axis=1) > 0)
        anchor = windows[live, rarest[live, 0]]
        sizes = self.counts[anchor]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(live):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _STEP, side="right")))
            some, n = live[at:upto], sizes[at:upto]
            number = np.repeat(some, n)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = self.positions[np.repeat(self.first[anchor[at:upto]], n) + within] - rarest[number, 0]
            for step in range(1, windows.shape[1]):
                offset = rarest[number, step]
                held = self.stream[start + offset] == windows[number, offset]
                number, start = number[held], start[held]
            yield number, start
            at = upto

    def near(self, windows: np.ndarray, terms: int, span: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows whose ``terms`` rarest terms stand in some ``span`` words around the rarest one, in any order."""
        counts = self.counts[windows]
        rarest = np.argsort(counts, axis=1, kind="stable")
        for number in np.flatnonzero(counts.min(axis=1) > 0):
            picked = windows[number, rarest[number, :terms]]
            here = self.positions[self.first[picked[0]] : self.first[picked[0] + 1]]
            for term in picked[1:]:
                listed = self.positions[self.first[term] : self.first[term + 1]]
                nearest = np.searchsorted(listed, here - span)
                here = here[(nearest < len(listed)) & (listed[np.minimum(nearest, len(listed) - 1)] <= here + span)]
            row = np.searchsorted(self.starts, here, side="right") - 1
            yield np.full(len(here), number), row


def _spans(texts: list[bytes], phrases: Phrases, window: int) -> tuple[np.ndarray, list[list[tuple]]]:
    """Words of each text, and its hits: (item, first word, words), overlapping windows of an item joined."""
    index = Index(texts, phrases, window)
    hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for windows, owners in phrases.groups:
        size = windows.shape[1]
        for numbers, starts in index.exact(windows):
            rows = np.searchsorted(index.starts, starts, side="right") - 1
            for number, row, start in zip(numbers.tolist(), rows.tolist(), (starts - index.starts[rows]).tolist(), strict=True):
                for owner in owners[number]:
                    hits.setdefault((row, owner), []).append((start, start + size))
    found: list[list[tuple]] = [[] for _ in texts]
    for (row, owner), pairs in sorted(hits.items()):
        pairs.sort()
        low, high = pairs[0]
        for start, end in pairs[1:]:
            if start > high:
                found[row].append((phrases.item_ids[owner], low, high - low))
                low = start
            high = max(high, end)
        found[row].append((phrases.item_ids[owner], low, high - low))
    return index.lengths, found


def _phrases(shared, token: int, window: int) -> Phrases:
    """Built once for each worker process, until a task of another operator comes."""
    return kept(__name__, (token, window), lambda: Phrases(shared.value, window))


def _search(shared, token: int, window: int, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _phrases(shared, token, window)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                lengths, found = _spans(texts_of(part), phrases, window)
                names, columns = list(part.schema.names), list(part.columns)
                if not first:
                    at = names.index("hits")
                    earlier = columns[at].to_pylist()
                    found = [[tuple(h.values()) for h in e] + f for e, f in zip(earlier, found, strict=True)]
                    at_words = names.index("n_words")
                    for k in sorted((at, at_words), reverse=True):
                        del names[k], columns[k]
                columns += [
                    pa.array(lengths, pa.int64()),
                    pa.array([[dict(zip(("item_id", "start", "length"), h, strict=True)) for h in f] for f in found], kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "hits"])

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words`` and ``hits``: the spans of words that repeat a window of an item, by item."""
    spark = docs.sparkSession
    found = docs.drop("n_words", "hits")
    schema = T.StructType([*found.schema.fields, *T.StructType.fromDDL(f"n_words bigint, hits array<{SPAN}>").fields])
    first, block, held, token = True, [], 0, np.random.SeedSequence().entropy

    def search(frame: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)
        return map_arrow(frame, _search(shared, token, window, first), schema)

    for row in benchmark.select("item_id", F.encode("text", "UTF-8").alias("text")).orderBy("item_id").toLocalIterator():
        text = bytes(row["text"] or b"")
        if block and held + len(text) > block_bytes:
            found, first, token, block, held = search(found), False, token + 1, [], 0
        block.append((row["item_id"], text))
        held += len(text)
    return search(found)


def near_passages(docs: DataFrame, benchmark: DataFrame, terms: int = 4, span: int = 20, window: int = WINDOW) -> DataFrame:
    """Proximity matches, ``(doc_id, item_id)`` once each: the rarest ``terms`` of a window close together."""
    items = [(r["item_id"], (r["text"] or "").encode()) for r in benchmark.select("item_id", "text").toLocalIterator()]
    if sum(len(t) for _, t in items) > BLOCK_BYTES:
        raise ValueError("proximity takes a benchmark of one block")
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(shared.value, window)
        for batch in batches:
            for part in slices(batch):
                keys = part.column(part.schema.get_field_index("doc_id")).to_pylist()
                index, pairs = Index(texts_of(part), phrases, max(window, span + 1)), set()
                for windows, owners in phrases.groups:
                    for numbers, rows in index.near(windows, terms, span):
                        pairs.update((keys[r], phrases.item_ids[o]) for n, r in zip(numbers, rows, strict=True) for o in owners[n])
                rows = sorted(pairs, key=str)
                yield pa.record_batch(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                    names=["doc_id", "item_id"],
                )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, item_id long").distinct()


def digests(found: DataFrame) -> DataFrame:
    """Per document: words, hit words (each once), items and the digest of their ids."""
    spans = F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("low"), (h["start"] + h["length"]).alias("high"))))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["high"] - F.greatest(a["end"], s["low"]))).alias("n"),
            F.greatest(a["end"], s["high"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"].cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def digest_of(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
