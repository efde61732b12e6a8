from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stackweave.llm import common, queries, scoring
from tests.llm import helpers


def test_counts_equal_brute_force(spark, small):
    docs = common.documents(spark, small)
    known = scoring.vocabulary(docs)
    texts = [r.text for r in docs.collect()]
    words = Counter(w for t in texts for w in scoring._WORDS.findall((t or "").lower()))
    assert list(known) == [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[: scoring.FREQUENT]]
    want = Counter()
    for text in texts:
        ids = [scoring.EDGE, *scoring.tokens(text, known), scoring.EDGE]
        want.update((ids[k - 1] * scoring.VOCABULARY + ids[k]) * scoring.VOCABULARY + ids[k + 1] for k in range(1, len(ids) - 1))
    found = {r.place: r.n for r in scoring.context_counts(docs.repartition(3), known).collect()}
    assert found == dict(want)


def test_the_network_learns_both_sides():
    """The hidden word is decided by its neighbours together; the network must come near the counts."""
    v = scoring.VOCABULARY
    cells = {(1, 5, 2): 90, (1, 6, 2): 10, (3, 6, 2): 100, (1, 7, 4): 100, (3, 5, 4): 80, (3, 8, 4): 20}
    place = np.array([(a * v + b) * v + c for a, b, c in cells])
    net = scoring.fit(place, np.array(list(cells.values())))
    table = np.exp(net.log_probabilities()).reshape(v, v, v)
    assert np.allclose(table.sum(1), 1, atol=1e-4)
    assert table[1, 5, 2] == pytest.approx(0.9, abs=0.05) and table[3, 6, 2] > 0.9 and table[1, 7, 4] > 0.9


def test_slopes_equal_differences():
    dice = np.random.default_rng(0)
    rows, word = dice.normal(size=(50, 3)).astype(np.float32), dice.integers(0, 9, 50)
    out = scoring._by_word(rows, word, np.argsort(word, kind="stable"))
    for k in range(9):
        assert np.allclose(out[k], rows[word == k].sum(0), atol=1e-5)


def test_scores_are_sums_of_conditional_log_probabilities(spark, small):
    docs = common.documents(spark, small)
    known, net = scoring.train(docs)
    table = net.log_probabilities().reshape((scoring.VOCABULARY,) * 3)
    found = {r.doc_id: r for r in scoring.score(docs.select("doc_id", "text"), known, net).collect()}
    for r in docs.collect()[:20]:
        ids = [scoring.EDGE, *scoring.tokens(r.text, known), scoring.EDGE]
        want = sum(float(table[ids[k - 1], ids[k], ids[k + 1]]) for k in range(1, len(ids) - 1))
        assert found[r.doc_id].n_tokens == len(ids) - 2
        assert found[r.doc_id].log_likelihood == pytest.approx(want, rel=1e-4)
    usual, swapped = docs.where("length(text) > 500").first().text, None
    swapped = " ".join(reversed(usual.split()))
    both = spark.createDataFrame([(1, usual), (2, swapped)], "doc_id long, text string")
    scores = {r.doc_id: r.mean_log_likelihood for r in scoring.score(both, known, net).collect()}
    assert scores[1] > -np.log(scoring.VOCABULARY)
    assert queries.op5_scoring(spark, small).count() == docs.count()


def test_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("n_tokens", F.lit("mine"))
    known, net = scoring.train(docs)
    rows = scoring.score(docs, known, net).collect()
    assert len(rows) == len(helpers.ROWS)
    for r in rows:
        if r.doc_id in (2, 3, 4):
            assert (r.n_tokens, r.log_likelihood, r.mean_log_likelihood) == (0, 0.0, None)
    empty = helpers.empty(spark)
    known, net = scoring.train(empty)
    assert known == {} and scoring.score(empty, known, net).count() == 0
    assert np.allclose(net.log_probabilities(), -np.log(scoring.VOCABULARY), atol=1e-5)


def test_words_have_their_own_probability(spark, small):
    """An invented word with the ending of a known one is less likely than that one."""
    docs = common.documents(spark, small)
    known, net, within = scoring.learn(docs)
    words = Counter(w for r in docs.collect() for w in scoring.spelled(r.text) if w not in known)
    sizes = Counter()
    for w, n in words.items():
        sizes[scoring.classes([w], known)[0]] += n
    some = [*words][:500]
    ids = np.array(scoring.classes(some, known))
    assert np.allclose(within.log_shares(some, ids), [np.log(words[w] / (sizes[k] + 1)) for w, k in zip(some, ids, strict=True)], atol=1e-5)
    usual = " ".join(w for w, _ in words.most_common(50))
    invented = " ".join(f"qzxqz{w[-2:]}" for w in usual.split())
    both = spark.createDataFrame([(1, usual), (2, invented)], "doc_id long, text string")
    plain, found = ({r.doc_id: r.log_likelihood for r in scoring.score(both, known, net, *more).collect()} for more in ((), (within,)))
    assert plain[1] == pytest.approx(plain[2]) and found[1] > found[2] + 50
    assert queries.op5_scoring(spark, small).where("n_tokens > 0").agg(F.max("mean_log_likelihood")).first()[0] < 0
