"""Cost-balanced packing of token sequences.

A sequence of pieces costs ``linear * n + quadratic * n * n`` for each piece of n tokens (attention
stays within a piece). Pieces are taken longest first, and each goes to the sequence of the lowest
cost so far that still has room for it; a piece is cut only where no sequence has room for all of it.

Documents are packed where they are read: a block of rows of one input partition is encoded, cut and
packed by itself, so no token is shuffled and memory is bounded by the block. The capacities of a block
add up to exactly its tokens: full sequences, then one sequence for each binary digit of the rest, so
that nothing is padded.

Rows: null and empty texts are one closing token. Repeated rows and equal ids are packed as they come.
A text longer than a block is a block of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ratewright.llm.common import column, crc, kept, map_arrow

SEQUENCE = 1024
BLOCK_TOKENS = 1 << 22
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """Token ids of a byte-level BPE file of the ``tokenizers`` library, words remembered.

    Such a tokenizer cuts before every space that a non-space follows, around a single line break between
    non-spaces, and between letters and ASCII marks; what lies between two cuts is encoded once and kept.
    After ``remembered`` entries a new table is begun, and of the one before stays what is met again. Texts in which the cuts are not that simple, and
    texts with special tokens, are given to the tokenizer whole.
    """

    remembered = 700_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = dict(zip(shown, map(chr, shown))) | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.spaced: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}
        self.earlier: tuple[dict, dict] = ({}, {})

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _one(self, piece: str) -> bytes:
        """Ids of one piece that the tokenizer does not cut any further."""
        shown = piece.encode().decode("latin-1").translate(self.alphabet)
        return self._bytes([t.id for t in self.tokenizer.model.tokenize(shown)])

    def _part(self, word: str, space: str) -> bytes:
        known = self.spaced if space else self.plain
        ids = known.get(word) or self.earlier[not space].get(word)
        if ids is not None:
            known[word] = ids
            return ids
        core = word.rstrip(_PUNCTUATION)
        rest = word[len(core) :]
        if not core:
            ids = self._one(space + word)
        elif not core.isalpha():
            ids = self.whole(space + word)
        elif rest:
            ids = self._part(core, space) + self._part(rest, "")
        else:
            ids = self._one(space + word)
        if len(word) <= 64:
            if len(self.spaced) + len(self.plain) >= self.remembered:
                self.earlier = (self.spaced, self.plain)
                self.spaced, self.plain = {}, {}
                known = self.spaced if space else self.plain
            known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        out, space = [], ""
        for word in text.split(" "):
            ids = self.spaced.get(word) if space else self.plain.get(word)
            if ids is None:
                lines = word.split("\n")
                if any(not line or (line.split() != [line]) for line in lines):
                    return self.whole(text)
                ids = self._part(lines[0], space)
                if len(lines) > 1:
                    ids += b"".join(self._part("\n", "") + self._part(line, "") for line in lines[1:])
            out.append(ids)
            space = " "
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """One for each worker process, until a task of another operator comes."""
    return kept(__name__, path, lambda: Encoder(path))


def capacities(total: int, size: int) -> list[int]:
    """Full sequences, then powers of two for what is left."""
    rest = total % size
    return [size] * (total // size) + [1 << b for b in range(size.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], size: int = SEQUENCE, linear: float = 1.0, quadratic: float = 1 / SEQUENCE):
    """Pieces ``(document, start, length, sequence, offset)`` and the cost of each sequence.

    ``size`` is a power of two. Ties go to the longest remaining room, then to the lowest sequence number;
    documents of one length keep their order.
    """
    room = capacities(sum(lengths), size)
    cost, used = [0.0] * len(room), [0] * len(room)
    heaps: list[list] = [[] for _ in range(size + 1)]
    best = np.full(size + 1, np.inf)
    for number, free in enumerate(room):
        heaps[free].append((0.0, number))
    for free, heap in enumerate(heaps):
        if heap:
            best[free] = 0.0
    pieces = []

    def place(document: int, start: int, length: int, free: int) -> None:
        total, number = heapq.heappop(heaps[free])
        best[free] = heaps[free][0][0] if heaps[free] else np.inf
        pieces.append((document, start, length, number, used[number]))
        used[number] += length
        cost[number] = total = total + linear * length + quadratic * length * length
        if left := free - length:
            heapq.heappush(heaps[left], (total, number))
            best[left] = heaps[left][0][0]

    order = sorted(range(len(lengths)), key=lambda d: -lengths[d])
    rests = []
    for document in order:
        start = 0
        while lengths[document] - start >= size and heaps[size]:
            place(document, start, size, size)
            start += size
        if start < lengths[document]:
            rests.append((lengths[document] - start, document, start))
    rests.sort(key=lambda r: -r[0])
    for length, document, start in rests:
        while length:
            reach = best[length:][::-1] if length <= size else best[:0]
            if len(reach) and reach.min() < np.inf:
                place(document, start, length, size - int(reach.argmin()))
                break
            free = size - int(best[1:][::-1].argmin())
            place(document, start, free, free)
            start, length = start + free, length - free
    return pieces, cost


def _packed(path: str, closing: int, size: int, block_tokens: int, linear: float, quadratic: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        end = np.array([closing], "<u4").tobytes()
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 40

        def flush(keys, encoded):
            nonlocal base
            pieces, cost = assign([len(e) // 4 for e in encoded], size, linear, quadratic)
            rows = [
                (keys[d], s, n, crc(encoded[d][4 * s : 4 * (s + n)]), len(encoded[d]) // 4, base + q, o, cost[q])
                for d, s, n, q, o in pieces
            ]
            base += len(cost)
            return _batch(rows)

        keys, encoded, held = [], [], 0
        for batch in batches:
            for key, text in zip(column(batch, "doc_id"), column(batch, "text"), strict=True):
                ids = encode(text or "") + end
                if keys and held + len(ids) // 4 > block_tokens:
                    yield flush(keys, encoded)
                    keys, encoded, held = [], [], 0
                keys.append(key)
                encoded.append(ids)
                held += len(ids) // 4
        if keys:
            yield flush(keys, encoded)

    return run


_FIELDS = pa.schema(
    [(n, pa.float64() if t == "double" else pa.int64()) for n, t in (f.split() for f in PIECES.split(", "))]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _FIELDS]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS)


def pack(
    docs: DataFrame,
    tokenizer: str,
    closing: int = 0,
    size: int = SEQUENCE,
    block_tokens: int = BLOCK_TOKENS,
    linear: float = 1.0,
    quadratic: float = 1 / SEQUENCE,
) -> DataFrame:
    """Where each token of ``docs`` (doc_id, text) goes; ``tokenizer`` is a file every executor has.

    ``sequence_id`` is unique, not dense: it starts with the number of the input partition.
    """
    run = _packed(tokenizer, closing, size, block_tokens, linear, quadratic)
    return map_arrow(docs.select("doc_id", "text"), run, PIECES)
