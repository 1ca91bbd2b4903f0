"""Quality by pairwise ranking (Bradley-Terry).

A document's worth is a weighted sum of surface features; the probability that one document is better than
another is the logistic function of the difference. Weights are fitted to preference pairs (a document labelled 1
over one labelled 0) by logistic loss on feature differences. The cut is a quantile of the fitted documents'
worths, the one that agrees best with the labels, and the worth's distance from the cut gives the score.

Features see the whole text. Null texts count as empty, and empty texts have a score as others do. Without labels
of both kinds no preference is known: every score is 0.5. Repeated rows are scored each; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import column, crc_remainder, map_arrow, slices, texts_of, with_columns
from ratewright.llm.labelled import BOUND, labelled_texts

#: The score at the cut; from it on a document is kept.
CUT = 0.3
#: Preference pairs that are drawn from the labelled rows.
PAIRS = 200_000
#: Words at which a text's features count half.
STEADY = 8
_FIRST, _LAST = 32, 127
_EXTRA = 12
FEATURES = _LAST - _FIRST + _EXTRA


def features(text: bytes) -> np.ndarray:
    """Shares of the printable ASCII characters (as roots), and figures of words and lines."""
    row = np.zeros(FEATURES)
    if not text:
        return row
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total = len(text)
    row[: _LAST - _FIRST] = np.sqrt(counts[_FIRST:_LAST] / total)
    words = text.lower().split()
    n = max(1, len(words))
    lines = text.split(b"\n")
    upper, lower, wide = counts[65:91].sum(), counts[97:123].sum(), counts[128:].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    row[_LAST - _FIRST :] = (
        np.log1p(n),
        upper / max(1, upper + lower),
        (upper + lower + wide) / total,
        marks / total,
        counts[48:58].sum() / total,
        wide / total,
        (counts[9:14].sum() + counts[32]) / total,
        len(set(words)) / n,
        len(set(words)) / np.sqrt(n),
        total / n,
        len(set(lines)) / len(lines),
        n / len(lines) / 100,
    )
    return row


@dataclass
class Ranking:
    """Fitted weights; ``scale`` and ``middle`` standardise features, ``cut`` and ``slope`` turn worth into score."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def standard(self, rows: np.ndarray) -> np.ndarray:
        """Features against their middle; those of short texts count less, as a few words say little."""
        words = np.expm1(rows[:, [_LAST - _FIRST]])
        return np.clip((rows - self.middle) / self.scale, -8, 8) * (words / (words + STEADY))

    def worth(self, rows: np.ndarray) -> np.ndarray:
        return self.standard(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.full(len(rows), 0.5)
        z = self.slope * (self.worth(rows) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_ranking(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranking:
    good, bad = rows[labels == 1], rows[labels == 0]
    middle = rows.mean(axis=0) if len(rows) else np.zeros(FEATURES)
    scale = rows.std(axis=0) + 1e-6 if len(rows) else np.ones(FEATURES)
    ranking = Ranking(middle, scale, np.zeros(FEATURES), 0.0, 0.0)
    if not len(good) or not len(bad):
        return ranking
    pick = np.random.default_rng(seed)
    good, bad = ranking.standard(good), ranking.standard(bad)
    weights, seen = ranking.weights, np.full(FEATURES, 1e-3)
    size = 500
    for _ in range(max(1, pairs // size)):
        difference = good[pick.integers(0, len(good), size)] - bad[pick.integers(0, len(bad), size)]
        wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -40, 40)))
        slope = -(wrong[:, None] * difference).mean(axis=0) + 1e-4 * weights
        seen += slope * slope
        weights -= 0.05 * slope / np.sqrt(seen)
    up, down = good @ weights, bad @ weights
    ranking.cut = best_quantile(up, down)
    spread = np.median(np.abs(np.concatenate([up, down]) - ranking.cut))
    ranking.slope = 4.0 / max(spread, 1e-6)
    return ranking


def best_quantile(up: np.ndarray, down: np.ndarray) -> float:
    """The cut between two neighbours in rank that keeps most of ``up`` and rejects most of ``down`` (as shares);
    of equally good cuts, the middle of the widest gap."""
    worths = np.concatenate([up, down])
    order = np.argsort(worths, kind="stable")
    value = np.concatenate([np.full(len(up), -1 / len(up)), np.full(len(down), 1 / len(down))])[order]
    gain = np.cumsum(value)[:-1]
    ordered = worths[order]
    gaps = np.diff(ordered)
    near = np.flatnonzero(gain >= gain.max() - 1e-9) if len(gain) else np.array([], int)
    if not len(near):
        return float(worths.mean())
    at = near[np.argmax(gaps[near])]
    return float((ordered[at] + ordered[at + 1]) / 2)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for part in slices(batch) for t in texts_of(part)]
        yield pa.record_batch([pa.array(rows, pa.list_(pa.float64())), pa.array(column(batch, "label"), pa.float64())], names=["features", "label"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, left_out: int = 0, bound: int = BOUND) -> Ranking:
    """Weights from at most ``bound`` labelled documents; only their features come to the driver."""
    texts = labelled_texts(docs, labels, label, modulus, left_out, bound)
    found = map_arrow(texts, _features_of, "features array<double>, label double").toArrow()
    rows = np.array(found["features"].to_pylist(), float).reshape(-1, FEATURES)
    marks = found["label"].to_numpy()
    order = np.lexsort([*rows.T[:3], rows[:, -1], marks])  # rows come in any order
    return fit_ranking(rows[order], marks[order])


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with ``score`` and ``worth``, which replace columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(ranking)

    def found(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = np.array([features(t) for t in texts_of(batch)]).reshape(-1, FEATURES)
        return [pa.array(shared.value.score(rows)), pa.array(shared.value.worth(rows))]

    return with_columns(docs, "text", "score double, worth double", lambda: found)


def decisions(scored: DataFrame, modulus: int = 5, left_out: int = 0) -> DataFrame:
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", modulus) == left_out).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
