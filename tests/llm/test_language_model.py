import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.llm import language_model as L
from ratewright.llm import queries
from ratewright.llm.common import most_frequent

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def unigram(docs):
    """doc -> (held out, tokens, known, training tokens, base score) by plain counting."""
    counts = Counter()
    for doc, text in docs:
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            counts.update(tokens(text))
    total, floor = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    found = {}
    for doc, text in docs:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / floor) for t in own)
        found[doc] = (zlib.crc32(str(doc).encode()) % 7 == 2, len(own), sum(counts[t] > 0 for t in own), total, base)
    return found


def test_base_and_gain(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op2_score_language_model(spark, small).collect()
    expected = unigram(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:4]
        assert r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def lexicon_of(counts):
    """A lexicon of word numbers, as the Spark job makes it."""
    words = np.arange(100, 100 + len(counts), dtype=np.uint64)
    return L.Lexicon(words, np.argsort(np.argsort(-counts, kind="stable")), counts, int(counts.sum()) + 50, len(counts) + 40, 90.0, 0.4, 30.0)


def test_shares_sum_to_one():
    """Over the whole vocabulary, with the unseen words as one, the shares after any beginning are a distribution."""
    counts = np.sort(np.random.default_rng(0).integers(2, 5000, 3000))[::-1].copy()
    lex = lexicon_of(counts)
    reader = L.Reader(lex)
    net = L.Network.begin(lex)
    net.vector += np.random.default_rng(1).normal(0, 0.1, net.size).astype(np.float32)
    state = np.random.default_rng(2).normal(0, 0.5, (1, L.HIDDEN)).astype(np.float32)
    ranks = np.arange(-1, len(counts))
    own, within, _ = reader.targets(ranks)
    logs = net.log_shares(np.repeat(state, len(ranks), 0), own, within)
    shares = np.exp(logs) * 10 ** np.concatenate([[0.0], reader.share])
    # Words in a class share all of it, so the tail's class and the bands count once.
    front = within >= 0
    bands = {k: np.exp(logs[(own == k) & ~front][0]) for k in set(own[~front].tolist())}
    empty = set(range(L._TOPS, L.CLASSES)) - set(bands)
    every = np.exp(L._log_softmax(state @ net.by_class + net.class_bias))[0]
    assert shares[front].sum() + sum(bands.values()) + every[list(empty)].sum() == pytest.approx(1, abs=1e-3)
    for k in set(own[~front].tolist()) - {L.TAIL}:
        weight = reader.share[(reader.own == k)]
        assert (10**weight).sum() <= 1 + 1e-9


def test_slopes_are_those_of_the_loss():
    counts = np.sort(np.random.default_rng(3).integers(2, 90, 1500))[::-1].copy()
    lex = lexicon_of(counts)
    net = L.Network.begin(lex)
    net.vector = net.vector.astype(np.float64)
    for name, part in net.views(net.vector).items():
        setattr(net, name, part)
    pick = np.random.default_rng(4)
    ranks = pick.integers(-1, 1500, (5, 3))
    own, within, symbols = L.Reader(lex).targets(ranks.ravel())
    own, within, symbols = own.reshape(5, 3), within.reshape(5, 3), symbols.reshape(5, 3)
    first = pick.random((5, 3)) < 0.3
    start = pick.normal(0, 0.3, (3, L.HIDDEN))

    def loss():
        state, logs = start, []
        given = net.inputs()[symbols]
        for t in range(5):
            state, _ = net.step(given[t], np.where(first[t][:, None], 0, state))
            logs.append(net.log_shares(state, own[t], within[t]))
        return -np.mean(logs)

    grad, _ = net.slopes(symbols, first, own, within, start)
    strong = np.argsort(-np.abs(grad))[:: len(grad) // 400][:60]
    for k in strong:
        kept = net.vector[k]
        net.vector[k] = kept + 1e-4
        up = loss()
        net.vector[k] = kept - 1e-4
        down = loss()
        net.vector[k] = kept
        assert grad[k] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-5)


def test_state_goes_through_the_whole_text():
    """Scores in parallel streams and windows equal one pass from the first token to the last."""
    counts = np.sort(np.random.default_rng(5).integers(2, 90, 1500))[::-1].copy()
    lex = lexicon_of(counts)
    reader, net = L.Reader(lex), L.Network.begin(lex)
    pick = np.random.default_rng(6)
    n = np.array([1, 200, 7, 33, 64, 1, 90])
    ranks = pick.integers(-1, 1500, n.sum())
    got = L.log_likelihoods(net, reader, ranks, n, lanes=3, window=16)
    own, within, symbols = reader.targets(ranks)
    at = 0
    for k, size in enumerate(n):
        state, total, before = np.zeros((1, L.HIDDEN), np.float32), 0.0, L._BEGIN
        for t in range(at, at + size):
            state, _ = net.step(net.inputs()[[before]], state)
            total += net.log_shares(state, own[[t]], within[[t]])[0]
            before = symbols[t]
        at += size
        assert got[k] == pytest.approx(total, rel=1e-4)


def test_rows(spark):
    rows = [(1, "a b a"), (2, None), (3, ""), (None, "a c"), (1, "a b a"), (7, "A\tB\x0bzz " * 400)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    train = L.training_rows(docs)
    lex = L.lexicon(train)
    found = L.score(docs, lex, L.train(train, lex)).collect()
    assert sorted(r.n_tokens for r in found) == [1, 1, 3, 4, 4, 1201]
    assert len({(r.base_score, round(r.score, 5)) for r in found if r.doc_id == 1}) == 1
    empty = docs.limit(0)
    lex = L.lexicon(empty)
    assert L.score(empty, lex, L.train(empty, lex)).count() == 0
    held = docs.withColumn("doc_id", F.lit(1))
    fold = zlib.crc32(b"1") % 7
    unlearned = L.score(held, lex, L.train(empty, lex), left_out=fold).collect()
    assert all(r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in unlearned)


def test_most_frequent(spark):
    counts = spark.createDataFrame([(k, n) for k, n in enumerate([9, 8, 8, 8, 5, 2, 1, 1])], "k long, n long")
    assert sorted(r.n for r in most_frequent(counts, "n", 4).collect()) == [8, 8, 8, 9]
    assert sorted(r.n for r in most_frequent(counts, "n", 3).collect()) == [9]
    assert most_frequent(counts, "n", 100).count() == 8 and most_frequent(counts.limit(0), "n", 5).count() == 0


def plain_log_softmax(x):
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def plain_step(net, given, state):
    gates = state @ net.again
    both = 0.5 * (np.tanh(0.5 * (given[:, : 2 * L.HIDDEN] + gates[:, : 2 * L.HIDDEN])) + 1)
    keep, reset, back = both[:, : L.HIDDEN], both[:, L.HIDDEN :], gates[:, 2 * L.HIDDEN :]
    new = np.tanh(given[:, 2 * L.HIDDEN :] + reset * back)
    return new + keep * (state - new), (keep, reset, back, new)


def plain_slopes(net, symbols, first, own, within, state):
    """The formulas of ``slopes`` row by row."""
    steps, lanes = symbols.shape
    grad = np.zeros(net.size, np.float32)
    g, given, states, past, saved = net.views(grad), net.inputs()[symbols], [], [], []
    for t in range(steps):
        past.append(np.where(first[t][:, None], np.float32(0), state))
        state, parts = plain_step(net, given[t], past[t])
        saved.append(parts)
        states.append(state)
    flat, own, within = np.concatenate(states), own.ravel(), within.ravel()
    wrong = np.exp(plain_log_softmax(flat @ net.by_class + net.class_bias))
    wrong[np.arange(len(flat)), own] -= 1
    wrong /= len(flat)
    g["by_class"][...], g["class_bias"][...] = flat.T @ wrong, wrong.sum(axis=0)
    down = wrong @ net.by_class.T
    for k in range(L._TOPS):
        some = np.flatnonzero((within >= 0) & (own == k))
        if len(some):
            words = np.exp(plain_log_softmax(flat[some] @ net.by_word[k] + net.word_bias[k]))
            words[np.arange(len(some)), within[some]] -= 1
            words /= len(flat)
            g["by_word"][k], g["word_bias"][k] = flat[some].T @ words, words.sum(axis=0)
            down[some] += words @ net.by_word[k].T
    down, to_given, later = down.reshape(steps, lanes, -1), np.empty((steps, lanes, 3 * L.HIDDEN), np.float32), np.zeros_like(state)
    for t in range(steps - 1, -1, -1):
        keep, reset, back, new = saved[t]
        d = down[t] + later
        d_new = d * (1 - keep) * (1 - new * new)
        d_keep, d_reset = d * (past[t] - new) * keep * (1 - keep), d_new * back * reset * (1 - reset)
        to_given[t] = np.concatenate([d_keep, d_reset, d_new], axis=1)
        gates = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
        g["again"][...] += past[t].T @ gates
        later = np.where(first[t][:, None], np.float32(0), d * keep + gates @ net.again.T)
    flat_given, flat_symbols = to_given.reshape(-1, 3 * L.HIDDEN), symbols.ravel()
    order = np.argsort(flat_symbols, kind="stable")
    edges = np.flatnonzero(np.diff(flat_symbols[order], prepend=-1))
    rows = flat_symbols[order][edges]
    by_symbol = np.add.reduceat(flat_given[order], edges, axis=0)
    g["bias"][...], g["into"][...], g["embed"][rows] = flat_given.sum(axis=0), net.embed[rows].T @ by_symbol, by_symbol @ net.into.T
    return grad, state


def least_seconds(call, times=7):
    found = []
    for _ in range(times):
        begin = time.process_time()
        call()
        found.append(time.process_time() - begin)
    return min(found)


def test_slopes_and_shares_cost_less_than_row_by_row():
    """The numbers are those of the plain formulas, for less CPU time."""
    counts = np.sort(np.random.default_rng(8).integers(2, 90, 1500))[::-1].copy()
    lex = lexicon_of(counts)
    net, pick = L.Network.begin(lex), np.random.default_rng(9)
    ranks = np.minimum(pick.zipf(1.2, (20, 256)) - 2, 1499)
    own, within, symbols = (x.reshape(20, 256) for x in L.Reader(lex).targets(ranks.ravel()))
    first, start = pick.random((20, 256)) < 0.01, pick.normal(0, 0.3, (256, L.HIDDEN)).astype(np.float32)
    given = symbols, first, own, within, start
    grad, state = net.slopes(*given)
    plain_grad, plain_state = plain_slopes(net, *given)
    np.testing.assert_allclose(grad, plain_grad, rtol=1e-4, atol=1e-8)
    np.testing.assert_allclose(state, plain_state, rtol=1e-5, atol=1e-7)
    assert least_seconds(lambda: net.slopes(*given)) < 0.88 * least_seconds(lambda: plain_slopes(net, *given))

    states = pick.normal(0, 0.3, (20 * 256, L.HIDDEN)).astype(np.float32)
    own, within = own.ravel(), within.ravel()
    front = np.flatnonzero(within >= 0)
    plain = plain_log_softmax(states @ net.by_class + net.class_bias)[np.arange(len(own)), own]
    for at in front:
        words = plain_log_softmax(states[at : at + 1] @ net.by_word[own[at]] + net.word_bias[own[at]])
        plain[at] += words[0, within[at]]
    np.testing.assert_allclose(net.log_shares(states, own, within), plain, rtol=1e-5, atol=1e-6)


def test_sums_by_symbol():
    pick = np.random.default_rng(10)
    for sizes in ([1], [9], [1, 2, 3, 300, 8, 9, 1], [20, 1, 40, 41], pick.integers(1, 12, 200).tolist()):
        rows = pick.normal(0, 1, (sum(sizes), 5)).astype(np.float32)
        starts = np.cumsum([0, *sizes[:-1]])
        assert np.array_equal(L._sums_by_symbol(rows, starts), np.add.reduceat(rows, starts, axis=0))


def test_places_of_hashes():
    """Words near one another and at both ends of the range."""
    pick = np.random.default_rng(11)
    edge = np.array([0, 1, 2, 0x454E44, 2**64 - 2, 2**64 - 1], np.uint64)
    for words in (np.unique(np.concatenate([pick.integers(0, 2**64, 5000, np.uint64), edge])), edge[:1], edge[-1:], edge[1:4]):
        reader = L.Reader(L.Lexicon(words, np.arange(len(words)), np.full(len(words), 2), 9, len(words), 1.0, 0.5, 1.0))
        asked = np.concatenate([words, edge, pick.integers(0, 2**64, 1000, np.uint64)])
        assert np.array_equal(reader.places(asked), np.searchsorted(words, asked))
