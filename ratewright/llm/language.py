"""Language by error-correcting output codes.

Each language has a codeword; a binary classifier over byte trigrams predicts each bit: the log odds of a trigram
in the texts of the languages with that bit against the others. Counts come from all training texts. A text's
margins are compared with each codeword by logistic loss; the codeword of the least loss wins, and a small lead
over the second marks the text as ambiguous.

Texts are taken whole, in lower case, everything but letters as one space. ``und``: null texts, texts without a letter, and
every text where no language was learned. Ties go to the language first by name. Repeated rows are scored each;
an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import column, crc_remainder, map_arrow, slices, texts_of

BUCKETS = 1 << 15
#: Bits of the longest code; up to four languages have all distinct splits (seven bits).
LONGEST = 31
#: Lead (as a share of the total weight) under which a text is ambiguous.
AMBIGUOUS = 0.6
UNKNOWN = "und"
_SPACES = bytes(b if b >= 0x80 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))


def codebook(languages: int, seed: int = 11) -> np.ndarray:
    """Rows of -1 and 1: one for each language. All splits where they are few, else random rows kept far apart."""
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 4:
        bits = 2 ** (languages - 1) - 1
        splits = np.arange(1, bits + 1)
        rows = [np.ones(bits)] + [np.where(splits >> (languages - 1 - k) & 1, -1.0, 1.0) for k in range(1, languages)]
        return np.array(rows)
    pick, best, reached = np.random.default_rng(seed), None, -1.0
    bits = max(LONGEST, 4 * int(np.ceil(np.log2(languages))))
    for _ in range(200):
        book = pick.choice([-1.0, 1.0], (languages, bits))
        apart = (bits - np.max(book @ book.T - 2 * bits * np.eye(languages))) / 2
        if best is None or apart > reached and np.abs(book.sum(axis=0)).max() < languages:
            best, reached = book, apart
    return best


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of all texts, and where each text's trigrams begin (with the end as last)."""
    cleaned = [b" " + b" ".join(t.translate(_SPACES).split()) + b" " for t in texts]
    starts = np.concatenate([[0], np.cumsum([max(0, len(c) - 2) for c in cleaned])])
    data = np.frombuffer(b"".join(cleaned), np.uint8).astype(np.int32)
    if len(data) < 3:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    value = ((data[:-2] * 1021 + data[1:-1]) * 251 + data[2:]) * 40503
    value = (value ^ value >> 13) & (BUCKETS - 1)
    ends = np.cumsum([len(c) for c in cleaned])[:-1]
    crossing = np.concatenate([ends - 2, ends - 1])
    keep = np.ones(len(value), bool)
    keep[crossing[(crossing >= 0) & (crossing < len(value))]] = False
    return value[keep], starts


def _lower(text: bytes) -> bytes:
    return text.decode().lower().encode()


@dataclass
class Codes:
    languages: list[str]
    book: np.ndarray
    weights: np.ndarray  # bits x buckets
    prior: np.ndarray

    def margins(self, texts: list[bytes]) -> np.ndarray:
        values, starts = grams(texts)
        n = np.diff(starts)
        sums = np.zeros((len(texts), len(self.weights)))
        full = np.flatnonzero(n > 0)
        if len(full):
            for bit, weights in enumerate(self.weights):
                sums[full, bit] = np.add.reduceat(weights[values], starts[:-1][full])
        return sums / (n[:, None] + 5.0) * 12.0 + self.prior / (1.0 + n[:, None])

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, its share of belief, and whether it is ambiguous."""
        loss = np.stack([np.logaddexp(0, -margins * word).sum(axis=1) for word in self.book], axis=1)
        least = loss.argmin(axis=1)
        belief = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share = 1 / belief.sum(axis=1)
        return least, share, share < AMBIGUOUS


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a task's texts by language, with the number of texts as last entry."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, limit=4 << 20):
            values, starts = grams([_lower(t) for t in texts_of(part)])
            for row, lang in enumerate(column(part, "lang")):
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS + 1)
                np.add.at(held[lang], values[starts[row] : starts[row + 1]], 1)
                held[lang][BUCKETS] += 1
    for lang, counts in held.items():
        full = np.flatnonzero(counts)
        yield pa.record_batch([pa.array([lang] * len(full)), pa.array(full), pa.array(counts[full])], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, modulus: int = 4, left_out: int = 2) -> Codes:
    """Counts of all training texts, added up by language and bucket; a model of bounded size comes to the driver."""
    train = docs.where(F.col("lang").isNotNull() & (crc_remainder("doc_id", modulus) != left_out)).select(
        F.coalesce("text", F.lit("")).alias("text"), "lang"
    )
    found = map_arrow(train, _counts, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    counts = np.zeros((len(names), BUCKETS + 1))
    place = {name: k for k, name in enumerate(names)}
    np.add.at(counts, ([place[x] for x in found["lang"].to_pylist()], found["bucket"].to_numpy()), found["n"].to_numpy())
    book, texts = codebook(len(names)), counts[:, BUCKETS]
    shares = counts[:, :BUCKETS] + 0.1
    shares /= shares.sum(axis=1, keepdims=True)
    weights, prior = [], []
    for bit in book.T:
        high, low = bit > 0, bit < 0
        if not high.any() or not low.any():
            weights.append(np.zeros(BUCKETS))
            prior.append(0.0)
            continue
        weights.append(np.log(shares[high].mean(axis=0) / shares[low].mean(axis=0)))
        prior.append(float(np.log((texts[high].sum() + 1) / (texts[low].sum() + 1))))
    return Codes(names, book, np.array(weights, np.float32).reshape(-1, BUCKETS), np.array(prior))


def predict(docs: DataFrame, codes: Codes) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, limit=2 << 20):
                texts = [_lower(t) for t in texts_of(part)]
                if own.languages:
                    least, share, unsure = own.decode(own.margins(texts))
                    known = [any(map(str.isalpha, t.decode())) for t in texts]
                    names = [own.languages[k] if ok else UNKNOWN for k, ok in zip(least, known, strict=True)]
                    share = np.where(known, share, 0.0)
                    unsure = unsure | ~np.array(known, bool)
                else:
                    names, share, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                keys = part.column(part.schema.get_field_index("doc_id"))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(names, pa.string()), pa.array(share, pa.float64()), pa.array(unsure, pa.bool_())],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double, ambiguous boolean"
    )


def decisions(found: DataFrame, modulus: int = 4, left_out: int = 2) -> DataFrame:
    return found.select(
        "doc_id", (crc_remainder("doc_id", modulus) == left_out).alias("held_out"), "lang_pred", "score", "ambiguous"
    )
