"""Helpers of the text operators: batches of bounded size, ASCII words, hashes, classes of equal keys."""

from __future__ import annotations

import ctypes
import gc
import weakref
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.session import fresh_folder, ship_package

#: Text bytes that one numpy pass takes at once; a longer single text is taken alone.
SLICE_BYTES = 4 << 20
#: Bytes of an Arrow batch between Spark and a Python worker; both sides hold some of them.
BATCH_BYTES = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package on the executors, and batches of ``BATCH_BYTES`` unless the session says otherwise."""
    ship_package(df.sparkSession)
    if df.sparkSession.conf.get(_BATCH, None) is None:
        df.sparkSession.conf.set(_BATCH, str(BATCH_BYTES))

    owner = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(owner)
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


_kept: dict[tuple, object] = {}


def kept(owner: str, key, make: Callable, limit: int = 4):
    """What ``make()`` gave the first time in this worker process, for tasks of the module ``owner``; ``limit`` of them at most."""
    if (owner, key) not in _kept:
        if len(_kept) >= limit:
            _kept.clear()
        _kept[owner, key] = make()
    return _kept[owner, key]


def keep_only(owner: str) -> None:
    """Drop what tasks of other modules kept in this worker process."""
    for name in [name for name in _kept if name[0] != owner]:
        del _kept[name]


def give_back() -> None:
    """Return freed memory to the system: a worker process outlives its task, and others need the memory then."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts have about ``limit`` bytes together (one row at least)."""
    sizes = np.fromiter((0 if not x.is_valid else len(x.as_buffer()) for x in _bytes(batch, column)), np.int64, batch.num_rows)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _bytes(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each row's text, empty for null."""
    return [x or b"" for x in _bytes(batch, name).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than 0x20 and 0x09-0x0D, A-Z in lower case (nothing else changes case)."""
    return text.lower().split()


def crc_remainder(key: str, modulus: int):
    """``crc32(key as text) mod modulus``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit values that spreads near values apart."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def checked(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, read again with its own schema."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``checked`` once all that is made of them is stored."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that are hashed at once; cuts fall on white space.
_HASHED = 1 << 19
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_powers[0]) < size:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:size], _powers[1][:size]


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of ``data`` (which ends with white space), and where the words begin."""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    begin = ~space
    begin[1:] &= space[:-1]
    starts = np.flatnonzero(begin)
    end = space.copy()
    end[0] = False
    end[1:] &= ~space[:-1]
    ends = np.flatnonzero(end)
    power, inverse = _powers_to(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * power, out=total[1:])
    value = (total[ends] - total[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (``words_of``) of all texts in order, and the number of words of each text."""
    data = b" ".join(texts).lower() + b" "
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[: len(texts)]
    found, begun, at = [], [], 0
    while at < len(data):
        cut = min(at + _HASHED, len(data))
        while cut < len(data) and not _SPACE[data[cut - 1]]:
            cut += 1
        hashes, starts = _hashed(data[at:cut])
        found.append(hashes)
        begun.append(starts + at)
        at = cut
    hashes, starts = np.concatenate(found), np.concatenate(begun)
    edges = np.searchsorted(starts, firsts)
    return hashes, np.diff(np.concatenate([edges, [len(starts)]]))


def most_frequent(counts: DataFrame, by: str, limit: int) -> DataFrame:
    """The rows of highest ``by`` (1 or more), ``limit`` at most, without ranking rows one by one.

    Values are grouped by 64 bins for each doubling; the highest bins that have no more rows together are taken.
    """
    binned = F.floor(F.log2(F.col(by)) * 64)
    bins = sorted(counts.groupBy(binned.alias("bin")).count().collect(), key=lambda r: -r["bin"])
    total, lowest = 0, None
    for row in bins:
        total += row["count"]
        if total > limit:
            break
        lowest = row["bin"]
    return counts.where(F.lit(False) if lowest is None else binned >= lowest)


def with_columns(docs: DataFrame, source: str, added: str, begin: Callable) -> DataFrame:
    """``docs`` with columns computed from batches of them; ``begin()`` gives the function, once for each task."""
    names = [part.split()[0] for part in added.split(", ")]
    docs = docs.drop(*names)
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = begin()
        for batch in batches:
            for part in slices(batch, source):
                yield pa.RecordBatch.from_arrays([*part.columns, *found(part)], names=[*part.schema.names, *names])

    return map_arrow(docs, run, schema)
