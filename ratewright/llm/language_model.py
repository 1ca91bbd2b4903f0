"""A gated recurrent language model over words, trained and applied with numpy inside Spark tasks.

Tokens are words (``common.words_of``), then one end of the text. The output is factored by classes:

* the ``FRONT`` most frequent words lie in classes of equal size; class and word within the class depend on the state,
* the other ``HEAD`` words lie in classes by powers of two of their rank, with their counts as share within the class,
* all others are the tail: known ones by their counts, unknown ones share ``rho`` evenly among the number of unseen words
  that the counts suggest (Chao's estimate). Words that training saw once count as tail, so the model learns how often
  the tail comes.

Counts (of every word of all training texts) are added up by hash in Spark. The network is trained by truncated
backpropagation: in each of ``ROUNDS`` rounds, tasks start from the same weights, go through their own share of the training
texts, and the results are averaged by tokens. A round takes 1/``PORTION`` of the training texts, or more where that is under
``LEAST`` tokens; ``PORTION`` is ``ROUNDS``, so the rounds together take every training text.

Scoring carries the state across windows from the first token of a text to its end. Head words' shares are known to
every task (a table of bounded size); the tail's are found by one shuffle of each text's distinct tail words.
Words are told apart by 64-bit hashes. Null texts count as empty: one end. Repeated rows are scored each; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.common import checked, column, crc_remainder, hashed_words, map_arrow, most_frequent, slices, texts_of

FRONT, GROUP = 1024, 32
HEAD = 1 << 17
HIDDEN = 32
ROUNDS, PORTION, LEAST = 4, 4, 1_000_000
#: Averages meet in groups of so many, again and again.
FAN = 32
END = np.uint64(0x454E44)
_TOPS = FRONT // GROUP
_BANDS = int(math.log2(HEAD // FRONT))
CLASSES = _TOPS + _BANDS + 1
TAIL = CLASSES - 1
#: Input symbols: front words, then classes of the others, then the beginning of a text.
SYMBOLS = FRONT + _BANDS + 2
_BEGIN = SYMBOLS - 1
#: Leading bits of a hash by which head words are looked up.
_BITS = 18
#: Rows whose class shares are worked out at once, so that they stay in the cache.
_ROWS = 4000


# ---------------------------------------------------------------- counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by word hash, added up within the task as far as a bounded table goes."""
    words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch):
            hashes, n = hashed_words(texts_of(part))
            fresh, times = np.unique(np.concatenate([hashes, np.full(len(n), END)]), return_counts=True)
            if len(words) + len(fresh) > 4_000_000:
                yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])
                words, counts = fresh, times
                continue
            both, place = np.unique(np.concatenate([words, fresh]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times]), len(both)).astype(np.int64)
            words = both
    if len(words):
        yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])


@dataclass
class Lexicon:
    """Head words by hash with their ranks and counts, and the figures of all training tokens."""

    words: np.ndarray  # sorted hashes
    ranks: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    tail_weight: float  # sum of c + 1 over tail words
    rho: float
    unseen: float

    def classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By rank: class, place within a front class (-1 beyond), log10 of the share within a band (0 in front)."""
        rank = np.arange(len(self.words))
        front = rank < FRONT
        band = np.floor(np.log2(np.maximum(rank, FRONT) / FRONT)).astype(np.int64)
        # Ranks are dealt to the front classes in turn, so their totals are alike.
        own = np.where(front, rank % _TOPS, _TOPS + np.minimum(band, _BANDS - 1))
        within = np.where(front, rank // _TOPS, -1)
        weight = np.zeros(len(rank))
        weight[self.ranks] = self.counts + 1.0
        totals = np.bincount(own, weight, CLASSES)
        return own, within, np.where(front, 0.0, np.log10(np.maximum(weight, 1) / np.maximum(totals[own], 1)))


def lexicon(train: DataFrame, head: int = HEAD) -> Lexicon:
    counts = checked(map_arrow(train.select("text"), _count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    top = most_frequent(counts.where("n > 1"), "n", head).toArrow()
    words, n = top["word"].to_numpy().astype(np.int64).view(np.uint64), top["n"].to_numpy().astype(np.int64)
    ranks = np.lexsort((words, -n)).argsort()
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count("*").alias("distinct"),
        F.sum((F.col("n") == 1).cast("long")).alias("once"),
        F.sum((F.col("n") == 2).cast("long")).alias("twice"),
    ).first()
    once, twice = total["once"] or 0, total["twice"] or 0
    tail_words, tail_tokens = total["distinct"] - len(words), total["tokens"] - int(n.sum())
    order = np.argsort(words)
    return Lexicon(
        words[order],
        ranks[order],
        n[order],
        total["tokens"],
        total["distinct"],
        float(max(1, tail_tokens + tail_words)),
        (once + 1) / (tail_tokens + once + 2),
        max(1.0, once * once / (2.0 * twice) if twice else float(max(1, once))),
    )


class Reader:
    """Texts as ranks of head words (-1: tail), each text closed by its end."""

    def __init__(self, lex: Lexicon):
        self.lex = lex
        self.own, self.within, self.share = lex.classes()
        self.words = np.append(lex.words, ~np.uint64(0))
        self.begins = np.searchsorted(lex.words, np.arange(1 << _BITS, dtype=np.uint64) << np.uint64(64 - _BITS))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """``np.searchsorted`` among the words; hashes are spread evenly, so their first bits say nearly where they stand."""
        place = self.begins[hashes >> np.uint64(64 - _BITS)]
        short = np.flatnonzero(self.words[place] < hashes)
        while len(short):
            place[short] += 1
            short = short[self.words[place[short]] < hashes[short]]
        return place

    def ranks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes and ranks of the tokens of all texts, and the number of tokens of each."""
        hashes, n = hashed_words(texts)
        ends = np.cumsum(n)
        hashes = np.insert(hashes, ends, END)
        if not len(self.lex.words):
            return hashes, np.full(len(hashes), -1), n + 1
        place = np.minimum(self.places(hashes), len(self.lex.words) - 1)
        return hashes, np.where(self.lex.words[place] == hashes, self.lex.ranks[place], -1), n + 1

    def targets(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, place within a front class, and the symbol that a token is as input."""
        if not len(self.own):
            return np.full(len(ranks), TAIL), np.full(len(ranks), -1), np.full(len(ranks), FRONT + _BANDS)
        own = np.where(ranks >= 0, self.own[ranks], TAIL)
        within = np.where(ranks >= 0, self.within[ranks], -1)
        return own, within, np.where(within >= 0, ranks, FRONT + own - _TOPS)


# ---------------------------------------------------------------- network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Sums of each column of a multiple of 8 rows, added in the order that numpy takes along a row: eight running sums, then pairs."""
    sums = x.reshape(-1, 8, x.shape[1]).sum(axis=0)
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    return sums[0]


def _log_softmax_columns(x: np.ndarray) -> np.ndarray:
    """In place; a few operations on long rows cost much less than many on short ones."""
    x -= x.max(axis=0)
    x -= np.log(_column_sums(np.exp(x)))
    return x


def _log_softmax(x: np.ndarray) -> np.ndarray:
    """Of each row."""
    return _log_softmax_columns(np.array(x.T, order="C")).T


def _sums_by_symbol(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``np.add.reduceat(rows, starts, axis=0)``; the many short groups are added up together by size, in the same order."""
    found = np.empty((len(starts), rows.shape[1]), rows.dtype)
    sizes = np.diff(starts, append=len(rows))
    for size in range(1, 9):
        which = np.flatnonzero(sizes == size)
        if len(which):
            at = starts[which]
            rest = rows[at + 1] if size > 1 else None
            for k in range(2, size):
                rest += rows[at + k]
            found[which] = rows[at] if rest is None else rows[at] + rest
    which = np.flatnonzero(sizes > 8)
    if len(which):
        bounds = np.stack([starts[which], starts[which] + sizes[which]], axis=1).ravel()
        found[which] = np.add.reduceat(rows, bounds[:-1] if bounds[-1] == len(rows) else bounds, axis=0)[::2]
    return found


class Network:
    """Embedding, one gated recurrent layer, class and word outputs; all weights in one vector."""

    shapes = {
        "embed": (SYMBOLS, HIDDEN), "into": (HIDDEN, 3 * HIDDEN), "bias": (3 * HIDDEN,), "again": (HIDDEN, 3 * HIDDEN),
        "by_class": (HIDDEN, CLASSES), "class_bias": (CLASSES,), "by_word": (_TOPS, HIDDEN, GROUP), "word_bias": (_TOPS, GROUP),
    }
    size = sum(int(np.prod(s)) for s in shapes.values())

    def __init__(self, vector: np.ndarray):
        self.vector = vector
        for name, part in self.views(vector).items():
            setattr(self, name, part)

    @classmethod
    def views(cls, vector: np.ndarray) -> dict[str, np.ndarray]:
        parts, at = {}, 0
        for name, shape in cls.shapes.items():
            n = int(np.prod(shape))
            parts[name] = vector[at : at + n].reshape(shape)
            at += n
        return parts

    @classmethod
    def begin(cls, lex: Lexicon, seed: int = 3) -> Network:
        """Small random weights; output biases are the logarithms of the training shares."""
        pick = np.random.default_rng(seed)
        net = cls(np.zeros(cls.size, np.float32))
        for name in ("embed", "into", "again", "by_class", "by_word"):
            part = getattr(net, name)
            part[...] = pick.normal(0, 0.1 if name == "embed" else 0.5 / math.sqrt(HIDDEN), part.shape)
        own, within, _ = lex.classes()
        by_rank = np.zeros(len(own))
        by_rank[lex.ranks] = lex.counts
        totals = np.bincount(own, by_rank, CLASSES)
        totals[TAIL] += lex.tokens - by_rank.sum()
        net.class_bias[...] = np.log((totals + 0.5) / (totals.sum() + CLASSES))
        front = within >= 0
        net.word_bias[own[front], within[front]] = np.log(by_rank[front] + 1)
        filled = np.zeros((_TOPS, GROUP), bool)
        filled[own[front], within[front]] = True
        net.word_bias[~filled] = -30.0
        return net

    def inputs(self) -> np.ndarray:
        return self.embed @ self.into + self.bias

    @staticmethod
    def by_gate(x: np.ndarray) -> np.ndarray:
        """The columns of each gate by themselves: gate x row x unit."""
        return np.array(x.reshape(len(x), 3, HIDDEN).transpose(1, 0, 2), order="C")

    def step(self, given: np.ndarray, state: np.ndarray):
        """The state after one token of each lane, and what slopes need of the gates; ``given`` are rows of ``inputs()``."""
        return self.advance(self.by_gate(given), state, self.by_gate(self.again))

    def advance(self, given: np.ndarray, state: np.ndarray, again: np.ndarray):
        """``step`` with ``given`` and ``again`` by gate; works in ``given``."""
        back = state @ again
        both, new = given[:2], given[2]
        both += back[:2]
        keep, reset = _sigmoid(both)
        new += reset * back[2]
        np.tanh(new, out=new)
        after = state - new
        after *= keep
        after += new
        return after, (keep, reset, back[2], new)

    def word_logits(self, rows: np.ndarray, edges: list[int]) -> np.ndarray:
        """Word x row; ``rows`` are states by front class, class k's from ``edges[k]`` on."""
        logits = np.empty((GROUP, len(rows)), rows.dtype)
        for k in range(_TOPS):
            if edges[k] < edges[k + 1]:
                some = logits[:, edges[k] : edges[k + 1]]
                np.matmul(self.by_word[k].T, rows[edges[k] : edges[k + 1]].T, out=some)
                some += self.word_bias[k][:, None]
        return logits

    def log_shares(self, states: np.ndarray, own: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Natural log of class share times, for front classes, the word's share."""
        by_row, found = states @ self.by_class, np.empty(len(own), states.dtype)
        for at in range(0, len(own), _ROWS):
            some = slice(at, at + _ROWS)
            logits = np.array(by_row[some].T, order="C")
            logits += self.class_bias[:, None]
            top = logits.max(axis=0)
            found[some] = logits[own[some], np.arange(logits.shape[1])] - top
            logits -= top
            found[some] -= np.log(_column_sums(np.exp(logits, out=logits)))
        order, edges = _by_class(own, within)
        if len(order):
            words = _log_softmax_columns(self.word_logits(states[order], edges))
            found[order] += words[within[order], np.arange(len(order))]
        return found

    def slopes(self, symbols, first, own, within, state) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean loss over one window (steps x lanes), and the state after it."""
        steps, lanes = symbols.shape
        grad = np.zeros(self.size, np.float32)
        g = self.views(grad)
        given, again = np.take(self.by_gate(self.inputs()), symbols, axis=1), self.by_gate(self.again)
        kind = given.dtype
        states = np.empty((steps, lanes, HIDDEN), kind)
        past, saved = np.empty((steps, lanes, HIDDEN), kind), []
        begun = [np.flatnonzero(row) for row in first]
        for t in range(steps):
            past[t] = state
            past[t][begun[t]] = 0
            state, parts = self.advance(given[:, t], past[t], again)
            saved.append(parts)
            states[t] = state
        flat, own, within = states.reshape(-1, HIDDEN), own.ravel(), within.ravel()
        n = len(flat)
        wrong = np.array((flat @ self.by_class).T, order="C")
        wrong += self.class_bias[:, None]
        wrong = np.exp(_log_softmax_columns(wrong), out=wrong)
        wrong[own, np.arange(n)] -= 1
        wrong /= n
        wrong = np.ascontiguousarray(wrong.T)
        g["by_class"][...] = flat.T @ wrong
        g["class_bias"][...] = wrong.sum(axis=0)
        down = wrong @ self.by_class.T
        order, edges = _by_class(own, within)
        if len(order):
            rows = flat[order]
            words = self.word_logits(rows, edges)
            words = np.exp(_log_softmax_columns(words), out=words)
            words[within[order], np.arange(len(order))] -= 1
            words /= n
            words = np.ascontiguousarray(words.T)
            more = np.empty_like(rows)
            for k in range(_TOPS):
                if edges[k] < edges[k + 1]:
                    some = slice(edges[k], edges[k + 1])
                    g["by_word"][k] = rows[some].T @ words[some]
                    g["word_bias"][k] = words[some].sum(axis=0)
                    np.matmul(words[some], self.by_word[k].T, out=more[some])
            down[order] += more
        down = down.reshape(steps, lanes, HIDDEN)
        to_given = np.empty((steps, lanes, 3 * HIDDEN), kind)
        gates = np.empty((lanes, 3 * HIDDEN), kind)
        from_gates, later = np.ascontiguousarray(self.again.T), np.zeros((lanes, HIDDEN), kind)
        rest = np.empty((lanes, HIDDEN), kind)
        for t in range(steps - 1, -1, -1):
            keep, reset, back, new = saved[t]
            d = down[t]
            d += later
            not_keep = 1 - keep
            to_keep, to_reset, to_new = (to_given[t][:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
            # d_new = d * (1 - keep) * (1 - new * new)
            d_new = d * not_keep
            np.multiply(new, new, out=rest)
            np.subtract(1, rest, out=rest)
            d_new *= rest
            to_new[...] = d_new
            # d_keep = d * (past - new) * keep * (1 - keep)
            np.subtract(past[t], new, out=rest)
            rest *= d
            rest *= keep
            np.multiply(rest, not_keep, out=to_keep)
            # d_reset = d_new * back * reset * (1 - reset)
            np.multiply(d_new, back, out=rest)
            rest *= reset
            np.subtract(1, reset, out=not_keep)
            np.multiply(rest, not_keep, out=to_reset)
            gates[...] = to_given[t]
            np.multiply(d_new, reset, out=gates[:, 2 * HIDDEN :])
            g["again"][...] += past[t].T @ gates
            np.multiply(d, keep, out=later)
            later += gates @ from_gates
            later[begun[t]] = 0
        flat_given, flat_symbols = to_given.reshape(-1, 3 * HIDDEN), symbols.ravel()
        order = np.argsort(flat_symbols.astype(np.uint16), kind="stable")
        edges = np.flatnonzero(np.diff(flat_symbols[order], prepend=-1))
        rows = flat_symbols[order][edges]
        by_symbol = _sums_by_symbol(flat_given[order], edges)
        g["bias"][...] = flat_given.sum(axis=0)
        g["into"][...] = self.embed[rows].T @ by_symbol
        g["embed"][rows] = by_symbol @ self.into.T
        return grad, state


def _by_class(own: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The tokens of front classes by class, and where each class begins among them."""
    front = np.flatnonzero(within >= 0)
    order = front[np.argsort(own[front].astype(np.uint8), kind="stable")]
    return order, np.concatenate([[0], np.cumsum(np.bincount(own[front], minlength=_TOPS)[:_TOPS])]).tolist()


# ---------------------------------------------------------------- training


def train_on(net: Network, reader: Reader, texts: Iterator[list[bytes]], rate: float, lanes: int = 64, window: int = 20, widest: int = 256) -> int:
    """Adam steps over windows of ``lanes`` parallel streams, more for long groups, so that a token costs less; returns the tokens used."""
    mean, square, work, done, used = *np.zeros((2, net.size), np.float32), np.empty(net.size, np.float32), 0, 0
    for group in texts:
        _, ranks, n = reader.ranks(group)
        own, within, symbols = reader.targets(ranks)
        first = np.zeros(len(ranks), bool)
        first[np.concatenate([[0], np.cumsum(n)[:-1]])] = True
        before = np.concatenate([[_BEGIN], symbols[:-1]])
        before[first] = _BEGIN
        wide = min(max(lanes, min(widest, len(ranks) // (100 * window))), max(1, len(ranks) // window))
        length = len(ranks) // wide
        shape = lambda x: x[: wide * length].reshape(wide, length).T  # noqa: B023, E731
        before, first, own, within = shape(before), shape(first), shape(own), shape(within)
        state = np.zeros((wide, HIDDEN), np.float32)
        for at in range(0, length, window):
            part = slice(at, at + window)
            grad, state = net.slopes(before[part], first[part], own[part], within[part], state)
            np.multiply(grad, grad, out=work)
            size = float(np.sqrt(work.sum()))
            grad *= min(1.0, 1.0 / (size + 1e-9))
            done += 1
            # mean += 0.1 * (grad - mean), square += 0.01 * (grad * grad - square)
            np.multiply(grad, grad, out=work)
            work -= square
            work *= 0.01
            square += work
            grad -= mean
            grad *= 0.1
            mean += grad
            # vector -= rate * (mean / (1 - 0.9**done)) / (sqrt(square / (1 - 0.99**done)) + 1e-8)
            np.divide(square, 1 - 0.99**done, out=work)
            np.sqrt(work, out=work)
            work += 1e-8
            np.divide(mean, 1 - 0.9**done, out=grad)
            grad *= rate
            grad /= work
            net.vector -= grad
        used += wide * length
    return used


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in batches:
        for n, vector in zip(column(batch, "n"), column(batch, "vector"), strict=True):
            own = n * np.frombuffer(vector, np.float32).astype(float)
            total, weight = own if total is None else total + own, weight + n
    if total is not None:
        yield _weights(weight, total / weight)


def _weights(n: float, vector: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([float(n)]), pa.array([vector.astype(np.float32).tobytes()], pa.binary())], names=["n", "vector"])


def train(docs: DataFrame, lex: Lexicon, rounds: int = ROUNDS, portion: int = PORTION, least: int = LEAST) -> Network:
    """The network after ``rounds`` of training in parallel; ``docs`` are the training texts."""
    net = Network.begin(lex)
    if not lex.tokens:
        return net
    spark = docs.sparkSession
    share = min(1.0, max(1 / portion, least / lex.tokens))
    place = F.crc32(F.concat(F.lit("lm "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")) / 2.0**32
    for number in range(rounds):
        begin = (number * share) % 1.0
        chosen = docs.where((place - begin + 1.0) % 1.0 < share).select("text")
        shared = spark.sparkContext.broadcast((lex, net.vector))
        rate = 0.01 * (1 - number / (rounds + 1))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate) -> Iterator[pa.RecordBatch]:
            own, vector = shared.value
            local = Network(vector.copy())
            groups = (texts_of(part) for batch in batches for part in slices(batch, limit=4 << 20))
            if used := train_on(local, Reader(own), (g for g in groups if g), rate):
                yield _weights(used, local.vector)

        trained = map_arrow(chosen, run, "n double, vector binary")
        parts = trained.rdd.getNumPartitions()
        while parts > FAN:
            parts = math.ceil(parts / FAN)
            trained = map_arrow(trained.repartition(parts), _averaged, "n double, vector binary")
        found = trained.collect()
        if found:
            weights = np.array([r["n"] for r in found])
            vectors = np.array([np.frombuffer(r["vector"], np.float32) for r in found], float)
            net = Network((weights @ vectors / weights.sum()).astype(np.float32))
        shared.unpersist()
    return net


# ---------------------------------------------------------------- scoring


def log_likelihoods(net: Network, reader: Reader, ranks: np.ndarray, n: np.ndarray, lanes: int = 512, window: int = 32) -> np.ndarray:
    """Natural log of the model's share of each text's tokens, apart from shares within bands and tail.

    Texts stand one after the other in ``lanes`` streams of like length; the state begins anew with each text.
    """
    own, within, symbols = reader.targets(ranks)
    starts = np.cumsum(n) - n
    before = np.empty(len(ranks), np.int64)
    before[1:] = symbols[:-1]
    before[starts] = _BEGIN
    lanes = min(lanes, len(n))
    load, held = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    heap = [(0, k) for k in range(lanes)]
    for text in np.argsort(-n, kind="stable").tolist():
        total, k = heapq.heappop(heap)
        held[k].append(text)
        heapq.heappush(heap, (total + int(n[text]), k))
        load[k] = total + n[text]
    order = np.argsort(-load, kind="stable")
    load, held = load[order], [held[k] for k in order]
    length = int(load[0])
    tokens = np.full((length, lanes), -1, np.int64)
    for k, texts in enumerate(held):
        at = 0
        for text in texts:
            tokens[at : at + n[text], k] = np.arange(starts[text], starts[text] + n[text])
            at += n[text]
    is_first = np.zeros(len(ranks), bool)
    is_first[starts] = True
    found = np.zeros(len(ranks), np.float32)
    given, again, state = net.by_gate(net.inputs()), net.by_gate(net.again), np.zeros((lanes, HIDDEN), np.float32)
    longer = np.searchsorted(-load, -np.arange(length)).tolist()  # lanes longer than t
    for at in range(0, length, window):
        part = tokens[at : at + window, : longer[at]]
        inputs, states = before[part], []
        fresh = [np.flatnonzero(row) for row in is_first[part]]
        for t in range(len(part)):
            active = longer[at + t]
            state = state[:active]
            if len(fresh[t]):
                state = state.copy()
                state[fresh[t][: np.searchsorted(fresh[t], active)]] = 0
            state, _ = net.advance(np.take(given, inputs[t, :active], axis=1), state, again)
            states.append(state)
        row = part[part >= 0]
        found[row] = net.log_shares(np.concatenate(states), own[row], within[row])
    return np.add.reduceat(found.astype(float), starts)


_SCORED = (
    "uid long, doc_id long, held_out boolean, n_tokens long, head_known long, tail_tokens long, base_part double, score_part double, "
    "tail array<long>, times array<int>"
)


def score(docs: DataFrame, lex: Lexicon, net: Network, modulus: int = 7, left_out: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``lex`` is that of the rows of ``docs`` that are not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast((lex, net.vector))
    floor = math.log10(lex.tokens + lex.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vector = shared.value
        reader, local, uid = Reader(own), Network(vector), TaskContext.get().partitionId() << 40
        by_rank = np.zeros(len(own.words))
        by_rank[own.ranks] = np.log10(own.counts + 1.0)
        for batch in batches:
            for part in slices(batch, limit=6 << 20):
                hashes, ranks, n = reader.ranks(texts_of(part))
                starts = np.cumsum(n) - n
                head = ranks >= 0
                shares = log_likelihoods(local, reader, ranks, n) / math.log(10)
                known = np.where(head, by_rank[ranks], 0.0) if len(by_rank) else np.zeros(len(ranks))
                bands = np.where(head, reader.share[ranks], 0.0) if len(by_rank) else np.zeros(len(ranks))
                tails, times = [], []
                for start, size in zip(starts.tolist(), n.tolist(), strict=True):
                    words, counts = np.unique(hashes[start : start + size][~head[start : start + size]], return_counts=True)
                    tails.append(words.view(np.int64))
                    times.append(counts.astype(np.int32))
                rows = part.num_rows
                head_known = np.add.reduceat(head.astype(np.int64), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(uid, uid + rows)),
                        part.column(part.schema.get_field_index("doc_id")),
                        part.column(part.schema.get_field_index("held_out")),
                        pa.array(n),
                        pa.array(head_known),
                        pa.array(n - head_known),
                        pa.array(np.add.reduceat(known, starts) - n * floor),
                        pa.array(shares + np.add.reduceat(bands, starts)),
                        pa.array(tails, pa.list_(pa.int64())),
                        pa.array(times, pa.list_(pa.int32())),
                    ],
                    names=[c.split()[0] for c in _SCORED.split(", ")],
                )
                uid += rows

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_remainder("doc_id", modulus) == left_out).alias("held_out"), "text")
    texts = checked(map_arrow(rows, run, _SCORED), "lm-scored")
    # A tail word is no more frequent than the last head word, so no group is large.
    words = texts.select("uid", "held_out", F.explode(F.arrays_zip("tail", "times")).alias("w")).select(
        "uid", F.col("w.tail").alias("word"), F.col("w.times").alias("n"), F.when(F.col("held_out"), 0).otherwise(F.col("w.times")).alias("trained")
    )
    counted = words.withColumn("c", F.sum("trained").over(Window.partitionBy("word")))
    seen = F.col("c") > 0
    tails = counted.groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("seen")
    )
    logs, seen = F.coalesce("logs", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return texts.drop("tail", "times").join(tails, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + seen).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + logs).alias("base_score"),
        (
            F.col("score_part")
            + logs
            + seen * math.log10((1 - lex.rho) / lex.tail_weight)
            + (F.col("tail_tokens") - seen) * math.log10(lex.rho / lex.unseen)
        ).alias("score"),
    )


def training_rows(docs: DataFrame, modulus: int = 7, left_out: int = 2) -> DataFrame:
    return docs.where(crc_remainder("doc_id", modulus) != left_out).select("doc_id", "text")
