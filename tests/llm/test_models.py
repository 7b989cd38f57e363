from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import LOWER, SCHEMA, SPACED, prose
from pyspark.sql import functions as F

from orderloom.llm import language_id, neural_lm, quality_crf
from orderloom.llm.batches import Texts

EN, ES = ("the", "ing", "er", "on", "st"), ("ción", "la", "os", "que", "ñ")


@pytest.fixture(scope="module")
def bilingual(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(5, 60), EN if i % 3 else ES), "en" if i % 3 else "es", "s", 0) for i in range(600)]
    return spark.createDataFrame(rows, SCHEMA)


def test_language_of_unseen_texts(bilingual):
    model = language_id.fit(bilingual, F.col("doc_id") < 300)
    found = language_id.identify(bilingual.where("doc_id >= 300"), model, ["doc_id", "lang"]).collect()
    assert len(found) == 300
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 297
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["accepted"] for r in found) > 250


def test_language_of_odd_rows(bilingual, odd, odd_rows, empty):
    model = language_id.fit(bilingual, F.lit(True))
    found = {r["doc_id"]: r for r in language_id.identify(odd, model).collect()}
    for doc_id in (1, 2, 3, 9, 12):
        assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
    for doc_id in (4, 5, 6, 7, 8, 10, None):
        assert found[doc_id]["lang_pred"] in ("en", "es")
    assert language_id.identify(odd, model).count() == len(odd_rows)
    assert language_id.identify(empty, model).count() == 0
    untaught = language_id.fit(empty, F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(odd, untaught).collect()} == {"und"}
    assert language_id.identify(odd, language_id.fit(odd, F.lit(True))).count() == len(odd_rows)


def test_letters_beyond_ascii():
    texts = Texts.of(pa.array(["é", "12 ½", "日本", "—", None, "a1"]))
    assert language_id.has_letter(texts).tolist() == [True, False, True, False, False, True]


@pytest.mark.parametrize("lengths", [[1], [1, 4, 2], [5, 1, 1, 3]])
def test_marginals_are_those_of_all_labellings(lengths):
    rng = np.random.default_rng(sum(lengths))
    at = np.concatenate([[0], np.cumsum(lengths)])
    node, links = rng.normal(0, 1.5, at[-1]), rng.normal(0, 1, (2, 2))
    marginal, pairs = quality_crf.forward_backward(node, links, at)
    for a, b in itertools.pairwise(at):
        total, good, both = 0.0, np.zeros(b - a), np.zeros((b - a, 2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            p = math.exp(sum(node[a + i] * v for i, v in enumerate(y)) + sum(links[u, v] for u, v in itertools.pairwise(y)))
            total += p
            good += p * np.array(y)
            for i in range(1, b - a):
                both[i, y[i - 1], y[i]] += p
        np.testing.assert_allclose(marginal[a:b], good / total, atol=1e-9)
        np.testing.assert_allclose(pairs[a:b].reshape(-1, 2, 2), both / total, atol=1e-9)


def test_lines():
    texts = ["a\nbb\n", None, "\n\n", "c", ""]
    found, at = quality_crf.lines(Texts.of(pa.array(texts)))
    lines = [[found.one(i).decode() for i in range(a, b)] for a, b in itertools.pairwise(at.tolist())]
    assert lines == [["a\n", "bb\n", ""], [""], ["\n", "\n", ""], ["c"], [""]]


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        text, good = prose(rng, rng.randint(10, 80)), rng.random() < 0.8
        if not good:
            bad = prose(rng, 60)
            bad = rng.choice((bad.upper() + "!!", " ".join(w + "$$" for w in bad.split()), "again " * 50))
            text = rng.choice((bad, text[:60] + "\n" + bad, bad + "\n" + text[:60]))
        rows.append((i, text, "en", "s", 0))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_of_unseen_texts(graded):
    documents, labels = graded
    model = quality_crf.fit(documents, labels, F.col("doc_id") < 250)
    found = quality_crf.rate(documents.where("doc_id >= 250"), model).join(labels, "doc_id").collect()
    assert len(found) == 250
    assert sum(r["predicted"] == r["quality"] for r in found) >= 243
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)


def test_quality_of_odd_rows(spark, graded, odd, odd_rows, empty):
    model = quality_crf.fit(*graded, F.lit(True))
    found = quality_crf.rate(odd, model).collect()
    assert len(found) == len(odd_rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    twice = [r["score"] for r in found if r["doc_id"] == 4]
    assert twice[0] == twice[1]
    assert quality_crf.rate(empty, model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality_crf.rate(odd, quality_crf.fit(odd, none, F.lit(True))).collect()} == {0.5}
    odd_labels = spark.createDataFrame([(4, 1, None), (4, 0, 1), (None, 1, 0), (6, None, 0), (7, 1, 0), (77, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_crf.rate(odd, quality_crf.fit(odd, odd_labels, F.lit(True))).count() == len(odd_rows)


def tokens(text):
    return [*SPACED.findall((text or "").translate(LOWER)), None]


def check_language_model(rows, learn, found):
    counts = Counter(t for r in rows if learn(r[0]) for t in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (
            str(r[0]),
            len(tokens(r[1])),
            sum(counts[t] > 0 for t in tokens(r[1])),
            total,
            round(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens(r[1])), 6),
        )
        for r in rows
    )
    assert sorted((str(r[0]), r[1], r[2], r[3], round(r[4], 6)) for r in found) == want
    assert all(r[5] < 0 for r in found)


@pytest.fixture()
def short_start(monkeypatch):
    monkeypatch.setattr(neural_lm, "START_STEPS", 20)


def test_language_model_counts_and_base(odd, odd_rows, monkeypatch, short_start):
    found = neural_lm.score(odd, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))).collect()
    check_language_model(odd_rows, lambda i: i is None or i % 3 != 0, found)
    # With a small head most words are joined.
    monkeypatch.setattr(neural_lm, "HEAD_WORDS", 90)
    again = neural_lm.score(odd, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))).collect()
    check_language_model(odd_rows, lambda i: i is None or i % 3 != 0, again)
    a, b = ({str(r[:2]): r[5] for r in sorted(x, key=str)} for x in (found, again))
    assert a == pytest.approx(b)


def test_language_model_without_training_texts(odd, odd_rows, empty, short_start):
    check_language_model(odd_rows, lambda i: False, neural_lm.score(odd, F.lit(False)).collect())
    assert neural_lm.score(empty, F.lit(True)).count() == 0


def test_language_model_is_normalised_and_better_than_the_base(spark, tmp_path):
    rng = random.Random(9)
    # Words follow each other by a rule that single counts cannot see.
    chain = {w: rng.choices([f"w{k}" for k in range(40)], k=3) for w in (f"w{k}" for k in range(40))}
    rows = []
    for i in range(400):
        w, text = "w0", []
        for _ in range(rng.randint(5, 80)):
            w = rng.choice(chain[w]) if rng.random() < 0.95 else f"rare{rng.randrange(500)}"
            text.append(w)
            w = w if w in chain else "w0"
        rows.append((i, " ".join(text), "", "", 0))
    documents = spark.createDataFrame(rows, SCHEMA)
    model, counts = neural_lm.fit(documents, F.col("doc_id") < 300, str(tmp_path))
    # Whatever the two words before, the classes sum up to one.
    for near, far in ((0, 1), (5, neural_lm.CLASSES), (neural_lm.CLASSES, neural_lm.CLASSES), (1030, 7)):
        total = (10.0 ** (model.near[near].astype(float) + model.far[far] - model.total[near, far])).sum()
        assert total == pytest.approx(1, abs=1e-4)
    # A text's score is the sum over its tokens, one by one.
    one = neural_lm.score(documents, F.col("doc_id") < 300).where("doc_id = 301").first()
    n_of = {bytes(r["word"]): (r["n"], r["ending"]) for r in counts.collect()}
    before, want = [neural_lm.CLASSES] * 2, 0.0
    for word in [*rows[301][1].encode().split(), b""]:
        own = model.classes.own.index(word) if word in model.classes.own else None
        kind = neural_lm.OWN + neural_lm.ending(word) if own is None else own
        want += float(model.near[before[1], kind]) + float(model.far[before[0], kind]) - float(model.total[before[1], before[0]])
        if own is None:
            assert word not in n_of or n_of[word][1] == neural_lm.ending(word)
            want += math.log10(n_of.get(word, (0, 0))[0] + 1) - model.shares[kind]
        before = [before[1], kind]
    assert one["score"] == pytest.approx(want, abs=1e-3)
    within = Counter()
    for r in counts.collect():
        if bytes(r["word"]) not in model.classes.own:
            within[neural_lm.OWN + r["ending"]] += r["n"] + 1
    for kind, mass in within.items():
        # The words of a class and one place for all others fill it.
        assert (mass + 1) / 10 ** model.shares[kind] == pytest.approx(1)
    found = neural_lm.score(documents, F.col("doc_id") < 300).where("doc_id >= 300").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.7 * found[1]


def test_language_model_knows_the_order_of_words_beyond_the_classes(spark, tmp_path):
    rng = random.Random(10)
    # 600 words, equally frequent and all of one ending; every word has one that follows it.
    names = [f"{a}{b}{c}end" for a in "bcdfghklmn" for b in "aeiou" for c in "bcdfghklmnpr"]
    rows = []
    for i in range(1500):
        w, text = rng.randrange(600), []
        for _ in range(40):
            text.append(names[w])
            w = (w * 7 + 1) % 600
        rows.append((i, " ".join(text), "", "", 0))
    backwards = [(10_000 + r[0], " ".join(reversed(r[1].split())), "", "", 0) for r in rows[1000:]]
    documents = spark.createDataFrame(rows + backwards, SCHEMA).coalesce(2)
    found = {r["doc_id"]: r for r in neural_lm.score(documents, F.col("doc_id") < 1000).collect()}
    assert all(found[i]["base_score"] == pytest.approx(found[10_000 + i]["base_score"]) for i in range(1000, 1500))
    # In the order of the training texts a text is likelier than backwards, with the same words.
    assert sum(found[i]["score"] > found[10_000 + i]["score"] + 1 for i in range(1000, 1500)) >= 490


def test_all_languages_are_learned_and_rows_of_one_id_are_bounded(spark, monkeypatch):
    """600 labels, most of them with one text; a third of all rows are copies without a doc_id."""
    seen = []
    train = language_id.train
    monkeypatch.setattr(language_id, "train", lambda texts, *rest: (seen.append(len(texts)), train(texts, *rest, epochs=1))[1])
    monkeypatch.setattr(language_id, "SAMPLE", 1200)
    rows = [(i, f"word{i % 600} of language number {i % 600}", f"l{i % 600}", "s", 1) for i in range(700)]
    rows += [(1000 + i, f"often {i}", "l0", "s", 1) for i in range(1500)]
    rows += [(None, "a copy", "l0", "s", 1)] * 1100
    documents = spark.createDataFrame(rows, SCHEMA)
    model = language_id.fit(documents, F.lit(True))
    assert model.languages == sorted({r[2] for r in rows})
    # Two texts of a language at most.
    assert seen == [2 * 100 + 500]
    again = language_id.fit(documents.repartition(7), F.lit(True))
    assert np.array_equal(again.weights, model.weights)
    found = language_id.identify(documents, model).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_quality_reads_one_text_of_an_id_and_long_documents(spark, monkeypatch):
    seen = []
    train = quality_crf.train
    monkeypatch.setattr(quality_crf, "train", lambda x, size, at, *rest: (seen.append(np.diff(at)), train(x, size, at, *rest))[1])
    long = "\n".join(f"line {i} of a long text" for i in range(2000))
    rows = [(1, "one\ntwo\nthree", "en", "s", 1)] * 500 + [(1, None, "en", "s", 1)] * 500
    rows += [(2, long, "en", "s", 1), (3, "#!#!", "en", "s", 1), (None, "no id", "en", "s", 1)]
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (3, 0)], "doc_id bigint, quality int")
    quality_crf.fit(spark.createDataFrame(rows, SCHEMA), labels, F.lit(True))
    assert sorted(seen[0].tolist())[-1] == quality_crf.SAMPLE_LINES
    assert len(seen[0]) == 3
    chosen = quality_crf.sample_lines(2000)
    assert (chosen[0], chosen[-1], len(set(chosen.tolist()))) == (0, 1999, 500)
    assert quality_crf.sample_lines(500).tolist() == list(range(500))


def test_endings_are_taken_once_per_different_word():
    """A word's class does not depend on where, or how often, it occurs."""
    texts = Texts.of(pa.array(["ab abc ab", None, "xabc abc ab q"], pa.large_string())).lower()
    words = texts.words(SPACED)
    found = neural_lm._endings_of_distinct(words)
    assert list(found) == [neural_lm.ending(w) for w in words.distinct]
    rows = np.array([5, 2, 5, 2047, 2], np.int64)
    where, total = neural_lm._summed(rows, np.arange(10, dtype=np.float32).reshape(5, 2))
    assert list(where) == [2, 5, 2047] and total.tolist() == [[10, 12], [4, 6], [6, 7]]
