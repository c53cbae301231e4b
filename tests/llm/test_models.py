"""Language identification and toxicity: their parts against brute force, and held-out
accuracy on the test tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslink.llm import langid, queries, toxicity
from tests.conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def test_automaton_parses_like_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        classes = 6
        train = [rng.randrange(3, classes) for _ in range(rng.randrange(1, 60))]
        automaton = langid.suffix_automaton(train, classes)
        text = [rng.randrange(3, classes) for _ in range(40)]
        grid = np.array(text, np.int32)[:, None]
        held = {tuple(train[i:j]) for i in range(len(train)) for j in range(i + 1, len(train) + 1)}
        phrases, now = 1, ()
        for c in text:
            if now + (c,) in held:
                now += (c,)
            else:
                phrases += 1
                now = (c,) if (c,) in held else ()
        # the parse starts with an empty phrase, so a first miss counts like any other
        assert langid.count_phrases(grid, automaton, classes)[0] == phrases


def test_long_texts_count_like_their_pieces(monkeypatch):
    model = langid.Model({"a": ["abab cdcd " * 30], "b": ["xyxy zwzw " * 30]})
    table = model.table()
    text = "abab zwzw! 12 " * 500
    whole, _ = model.phrases([text, "", "abab"], table)
    monkeypatch.setattr(langid, "LANES", 7)
    again, letters = model.phrases([text, "", "abab"], table)
    assert (whole == again).all() and letters.tolist() == [True, False, True]
    monkeypatch.setattr(langid, "PIECE_CHARS", 100)
    cut, _ = model.phrases([text], table)
    assert abs(cut[0] - whole[0]).max() <= 2 * (len(text) // 100 + len(text) // 256 + 2)


def test_answers_for_odd_rows(spark, docs, none, rows):
    model = langid.train(docs, min_chars=20)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (300, 301, 302, 303, 310):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert all(r.lang_pred in ("en", "fr", "und") and 0 <= r.score <= 1 for r in got)
    assert langid.identify(none, model).count() == 0
    empty = langid.train(none)
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}


def test_held_out_languages(spark):
    got = queries.op5_langid(spark, SF)
    docs = queries.table(spark, SF, "documents").select("doc_id", "lang")
    rows = got.where("held_out").join(docs, "doc_id").where("lang is not null").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def brute_segments(scores):
    """Ruzzo and Tompa's definition by recursion over the best segments."""
    def go(a, b):
        best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(a, b)
                    for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return go(a, i) + [(i, j - 1, best[0])] + go(j, b)

    return go(0, len(scores))


def test_maximal_segments_equal_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 18)
        hits = sorted(rng.sample(range(n), rng.randrange(0, n + 1)))
        weights = [rng.randrange(1, 50) + rng.random() for _ in hits]
        other = -rng.randrange(1, 30) - rng.random()
        scores = [other] * n
        for i, w in zip(hits, weights):
            scores[i] = w
        got = toxicity.maximal_segments(hits, weights, other)
        want = brute_segments(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_rate_solves_its_equation():
    p, w = np.array([0.01, 0.99]), np.array([3.0, -0.1])
    rate = toxicity._rate(p, w)
    assert math.isclose((p * np.exp(rate * w)).sum(), 1, rel_tol=1e-6) and rate > 0.01


def test_odd_rows_and_empty_models(spark, docs, none, rows):
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (5, None), (999, 1), (7, 7)],
        "doc_id long, toxic long")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    more = docs.withColumns({"_y": F.lit(9), "_id": F.lit("x"), "_text": F.lit(1), "a.b": F.lit(2)})
    assert toxicity.train(more, labels).weights == model.weights
    nothing = toxicity.train(docs, labels.where("false"))
    assert max(r.score for r in toxicity.score(docs, nothing).collect()) < 1e-6
    assert toxicity.score(none, model).count() == 0


def test_passages_are_found(spark):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(plain) for _ in range(60)]
        if i % 6 == 0:
            text[30:30] = ["Vile", "rotten,", "w1", "filthy"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels[:300], "doc_id long, toxic int"))
    assert set(model.weights) >= {b"vile", b"rotten", b"filthy"}
    for r in toxicity.score(docs, model).collect():
        assert (r.score >= 0.5) == (r.doc_id % 6 == 0), r
        if r.doc_id % 6 == 0:
            assert any(p.first_word <= 30 and p.last_word >= 33 for p in r.passages)


def test_passages_of_rare_words_are_found(spark):
    """Toxic passages of 6 of 40 words: each word is in few training documents."""
    rng = random.Random(4)
    plain, vile = [f"w{k}" for k in range(300)], [f"vile{k}" for k in range(40)]
    rows = []
    for i in range(600):
        text = [rng.choice(plain) for _ in range(60)]
        if i % 6 == 0:
            text[30:30] = rng.sample(vile, 6)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(
        [(i, int(i % 6 == 0)) for i in range(300)], "doc_id long, toxic int"))
    late = [r for r in toxicity.score(docs, model).collect() if r.doc_id >= 300]
    assert sum(r.score >= 0.5 for r in late if r.doc_id % 6 == 0) >= 45      # of 50
    assert sum(r.score >= 0.5 for r in late if r.doc_id % 6) <= 7            # of 250


def test_held_out_toxicity_by_language(spark):
    path = SF_SMALL.replace("sf0.001", "sf0.1")
    rows = queries.op8_toxicity(spark, path).where("held_out").join(
        queries.table(spark, path, "labels").where("toxic = 1"), "doc_id").join(
        queries.table(spark, path, "documents").select("doc_id", "lang"), "doc_id").collect()
    for lang in ("de", "en", "es", "fr"):
        caught = [r.predicted for r in rows if r.lang == lang]
        assert caught and sum(caught) / len(caught) > 0.5, lang


def test_held_out_toxicity(spark):
    path = SF_SMALL.replace("sf0.001", "sf0.1")
    got = queries.op8_toxicity(spark, path)
    labels = queries.table(spark, path, "labels").where("toxic is not null")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    wrong = [r.predicted for r in rows if r.toxic == 0]
    assert len(caught) > 50 and sum(caught) / len(caught) > 0.8
    assert sum(wrong) / len(wrong) < 0.03


@pytest.mark.parametrize("column", ["score", "held_out", "predicted"])
def test_query_columns(spark, column):
    assert column in queries.op8_toxicity(spark, SF_SMALL).columns
