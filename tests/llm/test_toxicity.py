import random

import numpy as np
from pyspark.sql import functions as F

from stackweave.llm import common, queries, toxicity
from tests.llm import helpers


def plain_grams(text):
    """All n-grams of each word with a space at both ends; a word said again at once counts once."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    words = [w for k, w in enumerate(words) if not k or w != words[k - 1]]
    return [sorted(f" {w} "[k : k + n] for n in toxicity.SIZES for k in range(len(w) + 3 - n)) for w in words]


def test_grams_equal_brute_force():
    texts = ["Ab cde, fghij!", None, "", "x", "x x x y", "über-maß 42"]
    gram, word, text_of = toxicity.grams(texts)
    assert np.bincount(text_of, minlength=len(texts)).tolist() == [len(plain_grams(t or "")) for t in texts]
    sizes = np.bincount(word, minlength=len(text_of)).tolist()
    assert sizes == [len(grams) for t in texts for grams in plain_grams(t or "")]
    # Equal n-grams hash alike, wherever they stand.
    names = [g for t in texts for grams in plain_grams(t or "") for g in grams]
    order = np.argsort(word, kind="stable")
    assert len(set(names)) >= len(set(gram[order].tolist()))


def test_windows_end_with_their_text():
    begin, end = toxicity.window_bounds(np.array([0] * 30 + [1] * 5 + [2] * 12))
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(0, 12), (6, 18), (12, 24), (18, 30), (30, 35), (35, 47)]


def corpus(count, seed):
    dice = random.Random(seed)
    plain = ["river", "stone", "window", "garden", "letter", "morning", "paper", "silver", "table", "winter", "copper", "lantern"]
    rows = []
    for k in range(count):
        words = dice.choices(plain, k=dice.randrange(20, 120))
        if k % 4 == 0:
            for _ in range(3):
                words.insert(dice.randrange(len(words)), dice.choice(["grumblefool", "nastyhead", "stinkbrain"]))
        rows.append((" ".join(words), k % 4 == 0))
    return rows


def test_misspelt_words_are_found_by_their_grams():
    rows = corpus(400, 1)
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    toxicity.calibrate(model, *map(list, zip(*corpus(200, 2), strict=True)))
    fresh = corpus(200, 3)
    scores = model.scores([t for t, _ in fresh])
    assert np.mean((scores >= 0.7) == np.array([y for _, y in fresh])) > 0.97
    quiet = "river stone window garden letter morning paper silver table winter copper lantern"
    assert model.scores([quiet])[0] < 0.3 < model.scores([quiet + " grumbelfool nastyhed " + quiet])[0]


def test_held_out_documents(spark):
    """Some labels of this table mark documents without any offending word, which bounds the ranking."""
    folder = "/root/testdata/sf0.1"
    scored = queries.op4_toxicity(spark, folder).join(common.table(spark, folder, "labels"), "doc_id").where("held_out").toPandas()
    y, s = scored["toxic"].to_numpy() > 0, scored["score"].to_numpy()
    rank = np.empty(len(s))
    rank[np.argsort(s)] = np.arange(len(s))
    assert (rank[y].mean() - (y.sum() - 1) / 2) / (~y).sum() > 0.9
    assert (s[~y] >= 0.7).mean() < 0.01
    assert ((s >= 0.7) == (scored["predicted"].to_numpy() == 1)).all() and (s >= 0).all() and (s <= 1).all()


def test_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (6, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(scored) == len(helpers.ROWS)
    assert {r.doc_id: r.score for r in scored if r.doc_id in (2, 3, 4)} == {2: 0.0, 3: 0.0, 4: 0.0}
    none = toxicity.train(docs, labels.limit(0))
    assert none is None and {r.predicted for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(helpers.empty(spark), none).count() == 0


def test_training_sees_every_window():
    words = [f"w{k}x{k * 7919 % 997}" for k in range(1000)]
    bags, owner = toxicity._windows([" ".join(words)])
    begin, _ = toxicity.window_bounds(np.zeros(len(words), np.int64))
    assert len(bags) == len(begin) and set(owner) == {0}
    assert set(np.concatenate(bags).tolist()) == set(toxicity.grams([" ".join(words)])[0].tolist())
