import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackweave.llm import common, language, queries
from tests.llm import helpers

TEXTS = {"x": ["abra cadabra abra", "barb arab"], "y": ["zozo zuzu zoz", "uzu ozo"]}


def plain_probability(texts, order, history, char):
    """Interpolated Kneser-Ney by its textbook formula, over dictionaries."""
    fold = lambda t: " " * (order - 1) + "".join(c if c.isalpha() else " " for c in t.lower())
    grams = [fold(t)[k - order + 1 : k + 1] for t in texts for k in range(order - 1, len(fold(t)))]
    alphabet = len({c for t in texts for c in fold(t)}) + 1
    levels = {order: Counter(grams)}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def p(n, context, c):
        if n == 0:
            return 1 / alphabet
        counts = levels[n]
        once, twice = (sum(v == k for v in counts.values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once else 0.5
        here = {g: v for g, v in counts.items() if g[:-1] == context}
        if not here:
            return p(n - 1, context[1:], c)
        total = sum(here.values())
        return max(here.get(context + c, 0) - discount, 0) / total + discount * len(here) / total * p(n - 1, context[1:], c)

    return p(order, history, char)


@pytest.mark.parametrize("text", ["abra", "cad zoz", "qq ab"])
def test_entropy_equals_the_textbook_formula(text):
    model = language.fit(TEXTS, 3)
    entropies, letters = model.entropies([text])
    padded = "  " + text
    for k, name in enumerate(model.names):
        want = [math.log(plain_probability(TEXTS[name], 3, padded[i - 2 : i], padded[i])) for i in range(2, len(padded))]
        assert entropies[0][k] == pytest.approx(-np.mean(want), rel=1e-4)
    assert letters[0] == sum(map(str.isalpha, text))


def test_slices_do_not_change_the_entropy(monkeypatch):
    model = language.fit(TEXTS, 4)
    texts = ["abra cadabra", None, "zozo " * 50, ""]
    whole = model.entropies(texts)[0]
    monkeypatch.setattr(language, "_SLICE", 7)
    assert np.allclose(model.entropies(texts)[0], whole)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op10_language(spark, folder).join(common.documents(spark, folder).select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()
    assert found.where("score < 0 or score > 1").count() == 0


def test_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("score", F.lit("mine")).withColumn("letters", F.lit(1))
    judged = language.identify(docs, language.train(docs, fit_rows=100, calibration_rows=100))
    assert judged.count() == len(helpers.ROWS)
    by_id = {row.doc_id: row for row in judged.collect()}
    assert [by_id[k].lang_pred for k in (2, 3, 4, 7)] == ["und"] * 4
    assert by_id[2].score == 0 and by_id[6].lang_pred in ("en", "fr")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r.score for r in kept.collect()} == {"mine"}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 5, 6]


def test_nothing_to_learn_from(spark):
    docs = helpers.empty(spark)
    assert language.keep_identified(docs).count() == 0
    unknown = helpers.awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unknown, language.train(unknown)).collect()} == {"und"}


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("abra cadabra").alias("text"), F.when(common.in_training(F.col("id")), "x").otherwise("held").alias("lang"))
    assert language.train(docs).names == ["x"]


def test_a_small_sample_rejects_too(spark, small):
    """Fewer rows than the quantile needs; letters without words and an unseen language go, the table stays."""
    docs = common.documents(spark, small)
    model = language.train(docs)
    assert np.isfinite(model.limit)
    dice = np.random.default_rng(1)
    rows = [(1, "".join(dice.choice(list("qwxzkjvbpfghty "), 400))), (2, "Быстрая коричневая лиса прыгает через ленивую собаку у реки сегодня утром. " * 3)]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    assert language.identify(odd, model).where("rejected").count() == 2
    assert language.identify(docs, model).where("rejected and letters > 0").count() == 0
