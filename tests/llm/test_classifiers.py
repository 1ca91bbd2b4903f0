import itertools
import random
import zlib

import numpy as np
import pytest

from ratewright.llm import labelled, language, quality, queries, toxicity

CLASHING = "doc_id long, text string, lang string, score string, worth int, marked int"
ROWS = [(1, None, "en", "x", 1, 1), (2, "", None, "x", 1, 1), (None, "some words", "en", None, 1, 1), (4, "12 !! 34", "de", "x", 1, 1), (4, "Ä", "de", "x", 1, 1), (5, "word " * 30_000, "en", "x", 1, 1)]


def auc(rows):
    up, down = [s for s, y in rows if y], [s for s, y in rows if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a, b in itertools.product(up, down)])


def folder(name):
    return f"/root/testdata/{name}"


def marks(spark, where, label):
    return {r.doc_id: r[label] for r in spark.read.parquet(f"{where}/labels.parquet").collect()}


def test_quality_on_held_out_labels(spark):
    where = folder("sf0.01")
    truth = marks(spark, where, "quality")
    rows = queries.op10_rank_quality(spark, where).collect()
    assert len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(held) > 0.97
    assert np.mean([(s >= 0.3) == y for s, y in held]) > 0.93


def test_toxicity_on_held_out_labels(spark):
    where = folder("sf0.1")
    truth = marks(spark, where, "toxic")
    rows = queries.op9_score_toxicity(spark, where).collect()
    assert len(rows) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert auc(held) > 0.9
    assert np.mean([s >= 0.3 for s, y in held if not y]) < 0.02


def test_toxicity_marks_do_not_depend_on_partitions(spark):
    """Copies of a few texts, in one task and in many, give the same words, weights and scores."""
    rng = random.Random(5)
    words = ["about", "text", "gardens", "river", "stone", "bread", "lamp", "glass"]
    plain = [" ".join(rng.choices(words, k=12)) for _ in range(60)]
    rows = [(k, plain[k % 60] + (" vile" if k % 60 < 20 else "")) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 60 < 20)) for k, _ in rows], "doc_id long, toxic int")
    found = []
    for parts in (1, 8, 3):
        marks = toxicity.fit(docs.repartition(parts, "doc_id"), labels)
        found.append((marks.weights, marks.base, sorted(tuple(r) for r in toxicity.score(docs, marks).select("doc_id", "score").collect())))
    assert found[0] == found[1] == found[2]
    assert list(found[0][0]) == ["vile"]


def test_language_on_held_out_rows(spark):
    where = folder("sf0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op8_detect_language(spark, where).collect()
    assert len(rows) == 1000
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, CLASHING)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (4, None, None), (None, 1, 1), (5, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for part in (docs, docs.limit(0)):
        for given in (labels, labels.limit(0)):
            assert quality.score(part, quality.fit(docs, given)).count() == part.count()
            assert toxicity.score(part, toxicity.fit(docs, given)).count() == part.count()
    plain = quality.decisions(quality.score(docs, quality.fit(docs, labels.limit(0)))).collect()
    assert {r.score for r in plain} == {0.5} and {r.predicted for r in plain} == {1}
    found = language.predict(docs, language.fit(docs)).collect()
    unknown = {(r.doc_id, r.score) for r in found if r.lang_pred == "und"}
    assert unknown == {(1, 0.0), (2, 0.0), (4, 0.0)} and len(found) == len(ROWS)
    nothing = language.predict(docs, language.fit(docs.limit(0))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id as string) as text")
    labels = spark.range(3000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    rows = labelled.labelled_texts(docs, labels, "toxic", 4, 2, 200).collect()
    assert 150 <= len(rows) <= 200
    assert all(zlib.crc32(r.text.encode()) % 4 != 2 and r.label == int(r.text) % 2 for r in rows)
    assert sorted(rows) == sorted(labelled.labelled_texts(docs.repartition(5), labels.repartition(3), "toxic", 4, 2, 200).collect())


@pytest.mark.parametrize("languages", [1, 2, 3, 4, 9, 30])
def test_codes_correct_errors(languages):
    book = language.codebook(languages)
    assert book.shape[0] == languages and set(np.unique(book)) <= {-1.0, 1.0}
    if languages < 2:
        return
    apart = min((a != b).sum() for a, b in itertools.combinations(book, 2))
    assert apart >= (2 ** (languages - 2) if languages <= 4 else 5)
    codes = language.Codes([str(k) for k in range(languages)], book, np.zeros((book.shape[1], language.BUCKETS), np.float32), np.zeros(book.shape[1]))
    wrong = (apart - 1) // 2
    for k, word in enumerate(book):
        margins = 4 * word.copy()
        margins[:wrong] *= -1
        assert codes.decode(margins[None])[0][0] == k


def test_ambiguous_texts_are_flagged(spark):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("aaa bbb aab abb", "x"), ("ccc ddd ccd cdd", "y")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language.fit(docs)
    asked = spark.createDataFrame([(1, "aab abb aaa", None), (2, "aaa ccc", None), (3, "ccd cdd ccc", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.ambiguous) for r in language.predict(asked, codes).collect()}
    assert found[1] == ("x", False) and found[3] == ("y", False) and found[2][1]


def test_grams_do_not_cross_texts():
    one, starts = language.grams([b"abc", b"", b"x1y"])
    assert starts.tolist() == [0, 3, 3, 6] if len(one) == 6 else len(one) == starts[-1]
    for k, text in enumerate([b"abc", b"", b"x1y"]):
        assert one[starts[k] : starts[k + 1]].tolist() == language.grams([text])[0].tolist()


def channel(seed=1):
    """A character model of random words with some marked ones."""
    pick = random.Random(seed)
    text = " ".join("".join(pick.choice("aeiou") if k % 2 else pick.choice("bcdlmnrst") for k in range(pick.randint(3, 8))) for _ in range(4000))
    counts = np.zeros(28**3)
    codes = [26, 26] + [toxicity._code(c) for c in text] + [26]
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        counts[(a * 28 + b) * 28 + c] += 1
    return toxicity.CharacterModel.build(counts, {"idiot": 3.0, "moron": 2.0, "scum": 2.0})


def score_of(path, model):
    text, total = "", 0.0
    for letters, cost in path:
        total += cost
        for letter in letters:
            total += model.log(text, letter)
            text += letter
    return total + model.log(text, " "), text


@pytest.mark.parametrize("token", ["1d10t", "m0r0n", "i.d.i.o.t", "$cum", "iiidiot", "b0!l", "s c u m", "l00n", "x1x!|0"])
def test_search_finds_the_best_path(token):
    model = channel()
    best = max(score_of(path, model) for path in itertools.product(*toxicity.lattice(token)))
    got = toxicity.restore(token, model)
    assert score_of_text(token, got, model) == pytest.approx(best[0])


def score_of_text(token, text, model):
    return max(s for s, t in (score_of(p, model) for p in itertools.product(*toxicity.lattice(token))) if t == text)


def test_disguised_words_are_found():
    restorer = toxicity.Restorer(channel(), {"idiot", "scum", "moro*"})
    for text in ("an 1d10t!", "so i.d.i.o.t", "i d i o t", "IDIOOOOT", "!d!ot", "idiot###", "you are s-c-u-m now", "$cum"):
        assert restorer.marks(text) & {"idiot", "scum"}, text
    assert restorer.marks("m0rons") == {"moro*"}
    assert not restorer.marks("a b c plain bold text 1234 24be64439e3e49cf46b2d7c90f3602a3d0b907ff x@y.example.com")


@pytest.mark.parametrize("end", ["", ".", ",", "!", "?", '"', ").", "..."])
@pytest.mark.parametrize("word", ["i d i o t", "i   d   i   o   t", "i\td\ti\to\tt", "i\nd\ni\no\nt", "i \u2013 d - i = o / t", "i , d ~ i : o ; t", "! d 1 0 7", "id iot", "i diot", "1d 10t", "ii d ii o tt"])
def test_words_in_pieces_are_found(word, end):
    restorer = toxicity.Restorer(channel(), {"idiot", "scum", "moro*"})
    for text in ("you are an {}", "{} really", "so: {} and more"):
        assert restorer.marks(text.format(word + end)) == {"idiot"}, text.format(word + end)


def test_pieces_of_other_letters():
    model = channel()
    words = {"bl\u00f6d": 2.0, "loser": 2.0}
    restorer = toxicity.Restorer(toxicity.CharacterModel.build(model.corpus.ravel() * 1e4, words), words)
    assert restorer.marks("so b l \u00f6 d.") == {"bl\u00f6d"}
    assert restorer.marks("a \u00a3 o $ \u20ac r!") == {"loser"}
    assert restorer.marks("mor over ten, a lo service 1 2 3 4 5") == set()
    assert toxicity.Restorer(model, {"moro*"}).marks("some mor over here, moro") == set()
    assert toxicity.Restorer(model, {"moro*"}).marks("m o r o n s!") == {"moro*"}
    assert restorer.marks("1 7 " * 50_000 + "l") == set()


@pytest.mark.parametrize("token", ["iiddiioott", "IIddIIoott", "i" * 12 + "d" * 12 + "i" * 12 + "o" * 12 + "t" * 12, "\u2014".join("idiot") + "\u2014" * 40 + "!", "-" * 30 + "i" + "_" * 30 + "d10t", "now.you.poor.1d10t.must.go.to.bed.long.before.dark", "b1" * 40 + "/idiot"])
def test_long_and_doubled_spellings_are_found(token):
    restorer = toxicity.Restorer(channel(), {"idiot", "scum", "moro*"})
    assert "idiot" in restorer.marks(f"such an {token} said so")


def test_walk_leaves_out_no_token_with_a_mark():
    pick, model, listed = random.Random(3), channel(), {"idiot", "scum", "moro*"}
    restorer = toxicity.Restorer(model, listed)
    for _ in range(400):
        token = "".join(c * pick.choice([1, 1, 2, 5]) + pick.choice(["", "", "-", "."]) for c in pick.choice(["1d10t", "$cum", "m0r0ns", "idiom", "s.cam", "xidiot", "id.moron"]))
        marks = {m for w in toxicity.plain_words(token, model) for m in toxicity.marks_in(w, listed)}
        assert restorer.marks(token) == marks, token


def test_time_grows_with_the_token():
    restorer = toxicity.Restorer(channel(), {"idiot", "scum", "moro*"})
    assert restorer.marks("01" * 100_000 + ".scum") == {"scum"}
