"""Toxicity behind obfuscated spelling: a noisy channel, decoded, then scored.

The channel writes a letter as itself, as a look-alike (``0`` for o, ``@`` for a), several times over, or with marks
or spaces put in between. Such writing is a lattice: at each place the letters it may stand for, a space, or nothing.
Viterbi search takes the path that the channel and a character language model (trigrams of all texts, mixed with the
words that labels mark) find likeliest. A token of plain letters that differ from their neighbours has one path and
stands for itself. Of the others, of any length, those are searched that have a path through a marked word (a walk along
the beginnings of marked words tells, exactly); answers are remembered.

Tokens that follow each other are walked along the same beginnings, so a marked word is seen across any white space and
marks between its letters or pieces; the search then says whether the space was meant.

Words of the restored text are looked up in a list of marked words, whose weights a logistic model learned together
from labelled documents. Whole texts are read. Null texts count as empty and have a score as others do. Without labels
of both kinds every score is the share of label 1 (0 where there are none). Repeated rows are scored each; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.common import column, crc_remainder, map_arrow, slices, texts_of, with_columns
from ratewright.llm.labelled import BOUND, labelled_texts

CUT = 0.3
#: Words that may be marked: a bound of the model, by strength.
LEXICON = 2_000
#: Look-alikes and the letters they may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "!": "i", "|": "il",
    "@": "a", "$": "s", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Marks that may be put between letters.
FILLERS = "-_.*~'​­^=#:,;/\\"
_SAME, _ALIKE, _REPEAT, _FILLED, _APART, _DROPPED = -0.05, -1.0, -0.7, -0.4, -1.2, -4.0
#: Spaces next to pieces of more than one letter are mostly meant.
_SPLIT = -6.0
_DOUBLE = re.compile(r"([^\W\d_])\1")
_STRIPPED = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’…"
_BEGINNINGS = range(4, 9)
#: Places after which the search settles what all its paths share.
_SETTLED = 1024
_ALPHABET = 28  # a-z, word border, any other letter


def _code(char: str) -> int:
    return ord(char) - 97 if "a" <= char <= "z" else 26 if char == " " else 27


@dataclass
class CharacterModel:
    """Trigram log probabilities, and those of longer contexts within marked words."""

    corpus: np.ndarray
    begun: dict[str, dict[str, float]] = field(default_factory=dict)
    share: float = 0.5
    known: dict[tuple[str, str], float] = field(default_factory=dict)

    @classmethod
    def build(cls, counts: np.ndarray, words: dict[str, float]) -> CharacterModel:
        shape = (_ALPHABET,) * 3
        trigrams = counts.reshape(shape).astype(float)
        pairs, singles = trigrams.sum(axis=0), trigrams.sum(axis=(0, 1))
        single = (singles + 1) / (singles.sum() + _ALPHABET)
        pair = (pairs + 8 * single) / (pairs.sum(axis=1, keepdims=True) + 8)
        model = cls((trigrams + 8 * pair[None]) / (trigrams.sum(axis=2, keepdims=True) + 8))
        after: dict[str, Counter] = {}
        for word, weight in words.items():
            for k, char in enumerate(word + " "):
                after.setdefault(word[:k], Counter())[char] += weight
        for begun, nexts in after.items():
            total = sum(nexts.values())
            model.begun[begun] = {char: n / total for char, n in nexts.items()}
        return model

    def state(self, text: str) -> str:
        """All that later letters depend on: the word begun, if a marked word begins so, else its last two letters."""
        word = text.rpartition(" ")[2]
        return word if word in self.begun else " " + word[-2:]

    def after(self, state: str, char: str) -> str:
        """The state that ``char`` leads to."""
        return self.state("" if char == " " else state + char)

    def log(self, text: str, char: str) -> float:
        """Log probability of ``char`` (a space ends the word) after ``text`` or its state."""
        key = (self.state(text), char)
        if key not in self.known:
            word = key[0]
            before = ("  " + word)[-2:]
            plain = self.corpus[_code(before[0]), _code(before[1]), _code(char)]
            marked = self.begun[word].get(char, 0.0) if word in self.begun else 0.0
            self.known[key] = float(np.log((1 - self.share) * plain + self.share * marked))
        return self.known[key]


@lru_cache(4096)
def _options(char: str, run: int) -> list[tuple[str, float]]:
    if char in FILLERS:
        return [("", _FILLED * run), (" ", _APART)]
    if char in LOOKALIKES:
        options = [("", _DROPPED)]
        for letter in LOOKALIKES[char]:
            options += [(letter, _ALIKE + _REPEAT * (run > 1)), (letter * 2, _ALIKE + _REPEAT * (run != 2))] if run > 1 else [(letter, _ALIKE)]
        return options
    if char.isalpha():
        return [(char, _SAME + _REPEAT * (run > 1))] + ([(char * 2, _SAME + _REPEAT * (run != 2))] if run > 1 else [])
    return [("", _DROPPED)]


_BETWEEN_SINGLES, _BETWEEN_PIECES = [("", _FILLED), (" ", _APART)], [("", _SPLIT), (" ", _SAME)]
_BETWEEN_WORDS = [("", _APART), (" ", _FILLED)]
_GAP = re.compile(f"([ {re.escape(FILLERS)}]+)")


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """At each place what the writing may stand for, with the channel's log probability; a run of one character is one place."""
    places = []
    parts = _GAP.split(token)
    single = [len(set(part)) < 2 for part in parts]
    for k, part in enumerate(parts):
        if k % 2 and " " in part:
            places.append(_BETWEEN_SINGLES if single[k - 1] and single[k + 1] else _BETWEEN_PIECES)
            part = part.replace(" ", "")
            places.extend(_options(char, 1)[:1] for char in dict.fromkeys(part))
        elif k % 2 and not single[k - 1] and not single[k + 1]:
            places.append(_BETWEEN_WORDS)
        else:
            at = 0
            while at < len(part):
                char, end = part[at], at + 1
                while end < len(part) and part[end] == char:
                    end += 1
                places.append(_options(char, min(end - at, 3)))
                at = end
    return places


def _text(path: tuple | None) -> str:
    parts = []
    while path is not None:
        parts.append(path[1])
        path = path[0]
    return "".join(reversed(parts))


def restore(token: str, model: CharacterModel) -> str:
    """The likeliest word or words: Viterbi search with the best path to each state of the character model.

    A path is a chain of what its places stand for; time and memory grow with the token, not with its square.
    """
    paths, settled = {model.state(""): (0.0, None)}, []
    for at, options in enumerate(lattice(token), 1):
        reached: dict[str, tuple[float, tuple | None]] = {}
        for state, (score, path) in paths.items():
            for letters, cost in options:
                total, key = score + cost, state
                for letter in letters:
                    total += model.log(key, letter)
                    key = model.after(key, letter)
                if key not in reached or total > reached[key][0]:
                    reached[key] = (total, (path, letters) if letters else path)
        paths = reached
        if at % _SETTLED == 0:
            texts = {state: _text(path) for state, (_, path) in paths.items()}
            shared = commonprefix(list(texts.values()))
            settled.append(shared)
            paths = {state: (score, (None, texts[state][len(shared) :])) for state, (score, _) in paths.items()}
    _, best = max(((score + model.log(state, " "), _text(path)) for state, (score, path) in paths.items()))
    return "".join(settled) + best


def _core(token: str) -> str:
    return token if token.isalpha() else _edges(token)


def _certain(core: str) -> bool:
    """Whether a token stands for itself: letters without a double, or no letters at all."""
    return not _DOUBLE.search(core) if core.isalpha() else not any(map(str.isalpha, core))


def plain_words(token: str, model: CharacterModel) -> list[str]:
    """What a token (no white space, lower case) says: itself without marks around it, or decoded."""
    core = _core(token)
    return [core] if _certain(core) else restore(core, model).split()


def marks_in(word: str, listed) -> list[str]:
    """The listed marks of a word: the word, and its beginnings of four to eight letters (``begin*``)."""
    found = [word] if word in listed else []
    return found + [b for k in _BEGINNINGS if len(word) > k and (b := word[:k] + "*") in listed]


class Restorer:
    """Marks of restored texts; what a token says is kept up to a bound."""

    def __init__(self, model: CharacterModel, listed, remembered: int = 200_000):
        self.model, self.listed, self.remembered = model, listed, remembered
        self.known: dict[str, tuple[tuple[str, ...], frozenset[str]] | None] = {}
        self.words = {w for w in listed if w.isalpha()}
        self.stems = {w[:-1] for w in listed if w.endswith("*") and w[:-1].isalpha()}
        self.begun = {w[:k] for w in self.words | self.stems for k in range(len(w) + 1)}

    def walk(self, places: list[list[tuple[str, float]]], states: set[str] | frozenset[str], anew: bool = False) -> tuple[set[str], bool]:
        """Where ``places`` lead from the beginnings ``states``, and whether on a path through a mark.

        ``anew``: spaces within are taken too; then a word may end and the next one begin there.
        """
        begun, stems, words = self.begun, self.stems, self.words
        found = False
        for options in places:
            reached = set()
            for letters, _ in options:
                if letters == " ":
                    if anew:
                        found = found or not words.isdisjoint(states)
                        reached.add("")
                    continue
                for state in states:
                    for letter in letters:
                        found = found or state in stems
                        state += letter
                        if state not in begun:
                            break
                    else:
                        reached.add(state)
            states = reached
            if not states and not anew:
                break
        return states, found or not words.isdisjoint(states)

    def _token(self, token: str) -> tuple[tuple[str, ...], frozenset[str]] | None:
        """Marks of a token by itself, and the beginnings of marks that it may end with, if any."""
        core = _core(token)
        if core.isalpha() and _certain(core):
            marks, reached = tuple(marks_in(core, self.listed)), {core} & self.begun
        else:
            reached, found = self.walk(lattice(core), {""}, anew=True)
            marks = tuple(marks_in(core, self.listed)) if _certain(core) else self._restored(core) if found else ()
        begun = frozenset(reached - {""})
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[token] = entry = (marks, begun) if marks or begun else None
        return entry

    def _restored(self, run: str) -> tuple[str, ...]:
        return tuple(m for w in restore(run, self.model).split() for m in marks_in(w, self.listed))

    def _goes_on(self, states: set[str] | frozenset[str], token: str) -> tuple[set[str], bool]:
        """``walk`` from the beginnings that the tokens before may end with."""
        core = _core(token)
        if core[0].isalpha():
            states = {s for s in states if s + core[0] in self.begun or s in self.stems}
        return self.walk(lattice(core), states) if states else (set(), False)

    def _across(self, tokens: list[str]) -> tuple[str, ...]:
        """Marks of a run restored. Pieces of more than one letter must give a whole marked word: two plain words may well meet in a beginning."""
        run = " ".join(map(_core, tokens))
        if not any(map(str.isalpha, run)):
            return ()
        if all(len(set(piece)) < 2 for piece in _GAP.split(run)[::2]):
            return self._restored(run)
        return tuple(m for w in restore(run, self.model).split() if w in self.listed for m in marks_in(w, self.listed))

    def marks(self, text: str) -> set[str]:
        """Marks of the tokens, and of each run of tokens along which a marked word may go on, restored as a whole."""
        known, found = self.known, set()
        tokens = text.lower().split()
        states, begin, hit = frozenset(), 0, False
        for at, token in enumerate(tokens):
            entry = known[token] if token in known else self._token(token)
            if states:
                states, whole = self._goes_on(states, token)
                hit = hit or whole
                if hit and not states:
                    found.update(self._across(tokens[begin : at + whole]))
                    hit = False
            if entry is not None:
                found.update(entry[0])
                if entry[1]:
                    if not states:
                        begin = at
                    states = states | entry[1]
        if hit:
            found.update(self._across(tokens[begin:]))
        return found


def _edges(token: str) -> str:
    """A token without marks around it; one look-alike next to a letter stays, as it may be one."""
    core = token.strip(_STRIPPED)
    if not core:
        return token
    begin = token.index(core)
    end = begin + len(core)
    if begin and token[begin - 1] in LOOKALIKES and token[begin - 1] != "|" and token[begin - 2 : begin - 1] != token[begin - 1]:
        begin -= 1
    tail = token[end : end + 2]
    if tail and tail[0] in "$@+" and tail[1:] != tail[0]:
        end += 1
    return token[begin:end]


@dataclass
class Marks:
    """Weights of marked words; ``base`` without any."""

    weights: dict[str, float]
    base: float
    model: CharacterModel

    def scores(self, texts: list[str], restorer: Restorer) -> list[tuple[float, list[str]]]:
        found = []
        for text in texts:
            hits = sorted(restorer.marks(text))
            z = self.base + sum(self.weights[w] for w in hits)
            found.append((float(1 / (1 + np.exp(-np.clip(z, -40, 40)))), hits))
        return found


def _character_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of letters of whole texts, words set apart."""
    fold = bytes(b - 97 if 97 <= b <= 122 else b - 65 if 65 <= b <= 90 else 27 if b >= 0x80 else 26 for b in range(256))
    counts = np.zeros(_ALPHABET**3, np.int64)
    for batch in batches:
        for part in slices(batch, limit=4 << 20):
            data = np.frombuffer(b"\x1a\x1a".join(t.translate(fold) for t in [b"", *texts_of(part), b""]), np.uint8).astype(np.int32)
            if len(data) > 2:
                counts += np.bincount((data[:-2] * _ALPHABET + data[1:-1]) * _ALPHABET + data[2:], minlength=len(counts))
    full = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(full), pa.array(counts[full])], names=["gram", "n"])


def candidates(text: bytes) -> set[str]:
    """Words and their beginnings, as they are written."""
    words = {_edges(t) for t in text.decode().lower().split()}
    return words | {w[:k] + "*" for w in words for k in _BEGINNINGS if len(w) > k}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts with each plain word, by label."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(texts_of(batch), column(batch, "label"), strict=True):
            counts[int(label)].update(candidates(text))
            counts[int(label)][""] += 1
    for label in (0, 1):
        if counts[label]:
            yield pa.record_batch(
                [pa.array(list(counts[label])), pa.array([label] * len(counts[label]), pa.int32()), pa.array(list(counts[label].values()), pa.int64())],
                names=["word", "label", "n"],
            )


def _presence(words: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(candidates(text) & words) for text in texts_of(batch)]
            yield pa.record_batch([pa.array(held, pa.list_(pa.string())), pa.array(column(batch, "label"), pa.float64())], names=["words", "label"])

    return run


def _logistic(rows: list[list[str]], labels: np.ndarray, words: list[str], rounds: int = 300) -> tuple[dict[str, float], float]:
    """Weights of words by full-batch gradient descent with momentum; words can only count towards label 1."""
    place = {w: k for k, w in enumerate(words)}
    at = np.array([k for k, row in enumerate(rows) for _ in row], np.int64)
    which = np.array([place[w] for row in rows for w in row], np.int64)
    share = labels.mean()
    base = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    weights = np.zeros(len(words))
    step_w, step_b, seen_w, seen_b = np.zeros(len(words)), 0.0, np.full(len(words), 1e-8), 1e-8
    for k in range(1, rounds + 1):
        z = base + np.bincount(at, weights[which], minlength=len(labels))
        wrong = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels
        grad_w = np.bincount(which, wrong[at], minlength=len(words)) / len(labels) + 2e-4 * weights
        grad_b = wrong.mean()
        step_w, step_b = 0.9 * step_w + 0.1 * grad_w, 0.9 * step_b + 0.1 * grad_b
        seen_w, seen_b = 0.99 * seen_w + 0.01 * grad_w**2, 0.99 * seen_b + 0.01 * grad_b**2
        weights = np.maximum(0, weights - 0.1 * (step_w / (1 - 0.9**k)) / np.sqrt(seen_w / (1 - 0.99**k) + 1e-12))
        base -= 0.1 * (step_b / (1 - 0.9**k)) / np.sqrt(seen_b / (1 - 0.99**k) + 1e-12)
    return {w: float(x) for w, x in zip(words, weights, strict=True) if x > 0.05}, float(base)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, left_out: int = 2, bound: int = BOUND) -> Marks:
    """Character counts of all texts; marked words and weights of at most ``bound`` labelled ones.

    A word is a candidate where its documents' share of label 1 stands out by over five standard errors; equal texts
    of a label count once, whichever tasks read them, so the marks do not depend on how rows are divided.
    """
    grams = map_arrow(docs.select("text"), _character_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_ALPHABET**3)
    counts[grams["gram"].to_numpy()] = grams["n"].to_numpy()
    texts = labelled_texts(docs, labels, label, modulus, left_out, bound)
    different = texts.withColumn("text", F.coalesce("text", F.lit(""))).dropDuplicates(["text", "label"])
    by_word = (
        map_arrow(different, _word_counts, "word string, label int, n long")
        .groupBy("word")
        .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("up"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("down"))
    )
    totals = by_word.where(F.col("word") == "").collect()
    up, down = (totals[0]["up"], totals[0]["down"]) if totals else (0, 0)
    if not up or not down:
        share = up / (up + down) if up + down else 0.0
        return Marks({}, float(np.log((share + 1e-9) / (1 - share + 1e-9))), CharacterModel.build(counts, {}))
    n = F.col("up") + F.col("down")
    share = up / (up + down)
    strength = (F.col("up") - n * share) / F.sqrt(n * share * (1 - share))
    listed = (
        by_word.where((F.length("word") > 1) & (n >= 3) & (strength > 5))
        .select("word", strength.alias("strength"))
        .orderBy(F.desc("strength"), "word")
        .limit(LEXICON)
        .collect()
    )
    words = sorted(r["word"] for r in listed)
    held = map_arrow(texts, _presence(set(words)), "words array<string>, label double").toArrow()
    # In one order, so that sums are the same to the last digit.
    ordered = sorted(zip(held["words"].to_pylist(), held["label"].to_pylist(), strict=True))
    rows, marks = [row for row, _ in ordered], np.array([mark for _, mark in ordered])
    weights, base = _logistic(rows, marks, words)
    return Marks(weights, base, CharacterModel.build(counts, {w: x for w, x in weights.items() if w.isalpha()}))


def score(docs: DataFrame, marks: Marks) -> DataFrame:
    """``docs`` with ``score`` and ``marked`` (the marks of the restored text), which replace columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def begin():
        own = shared.value
        restorer = Restorer(own.model, own.weights)

        def found(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = own.scores([t.decode() for t in texts_of(batch)], restorer)
            return [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.list_(pa.string()))]

        return found

    return with_columns(docs, "text", "score double, marked array<string>", begin)


def decisions(scored: DataFrame, modulus: int = 4, left_out: int = 2) -> DataFrame:
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", modulus) == left_out).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
