import math
import random
import time

import pytest
from pyspark.sql import functions as F

from stackweave.llm import quality
from tests.llm import helpers

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(k, k + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    dice = random.Random(2)
    texts = [None, "", " \n", "ä#b *c*\nä#b *c*\n\n", "x " * 40, "  a\x0bb"]
    texts += [" ".join(dice.choices("ab", k=dice.randrange(60))) + "\n" * dice.randrange(3) + "z" for _ in range(60)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in quality.features(df).collect()}
    for k, text in enumerate(texts):
        want = plain(text)
        assert tuple(found[k][name] for name in COUNTS) == want, text
        assert found[k].base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


@pytest.mark.parametrize("n", [1, 20, 500, 20_000])
@pytest.mark.parametrize("rate", [0.0125, 0.05, 0.3])
def test_binomial_tail(spark, n, rate):
    ks = sorted({0, 1, int(n * rate * 0.3), int(n * rate * 0.8), max(0, math.ceil(n * rate) - 1)} & set(range(n + 1)))
    df = spark.createDataFrame([(k, n) for k in ks], "k long, n long")
    for r in df.select("k", quality.binomial_tail(F.col("k"), F.col("n"), rate).alias("p")).collect():
        log = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(rate) + (n - j) * math.log1p(-rate)
        want = 1.0 if r.k >= n * rate else math.fsum(math.exp(log(j)) for j in range(r.k + 1))
        assert r.p == pytest.approx(want, rel=1e-8, abs=1e-300)


def test_cutoffs_are_proven_and_separate(spark):
    """Good texts have few symbols, bad ones many; a stratum with few labels gets no cutoff."""
    dice = random.Random(4)
    rows = [("big", True, float(dice.randrange(12))) for _ in range(5000)] + [("big", False, 400.0 + k % 100) for k in range(300)]
    rows += [("small", True, 0.0)] * 100 + [("small", False, 900.0)] * 100
    df = spark.createDataFrame(rows, "stratum string, good boolean, symbols double")
    df = df.withColumns({"capitals": F.lit(0.0), "lines": F.lit(0.0), "repeats": F.lit(0.0)})
    found = {r.stratum: r for r in quality.cutoffs(df).collect()}
    assert set(found) == {"big"}
    assert 12 <= found["big"].symbols_cutoff <= 400
    assert found["big"].capitals_cutoff is None


def test_judgement(spark):
    good = "plain words of an ordinary text that goes on and on until it has more than twenty words in all of them here"
    rows = [(k, f"{good} {k}", "en") for k in range(1500)] + [(k, f"{good} {k} ####### $$$$$$$ %%%%%%%", "en") for k in range(1500, 1800)]
    docs = spark.createDataFrame([*rows, (9000, "too short", "en"), (9001, None, None)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") < 1500).cast("int").alias("quality"))
    judged = quality.judge(quality.features(docs), labels)
    assert {r.doc_id for r in judged.where("kept").collect()} == set(range(1500))
    unlabelled = quality.judge(quality.features(docs), labels.limit(0))
    assert unlabelled.where("kept").count() == 1800


def test_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("kept", F.lit(True)).withColumn("symbols", F.lit("mine"))
    counted = quality.features(docs)
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1)], "doc_id long, quality int")
    judged = quality.judge(counted, labels)
    assert judged.count() == len(helpers.ROWS)
    assert {r.symbols for r in judged.collect()} == {"mine"}
    # The long text consists of two copies of its first half, so the base rule rejects it.
    assert {r.doc_id: r.n_repeat_words for r in judged.collect()}[6] == 118_852 > 0.3 * 120_000
    assert judged.where("kept").count() == 0
    none = quality.features(helpers.empty(spark))
    assert quality.judge(none, labels).count() == 0


def test_a_filter_on_long_texts_stays_linear(spark):
    """Filters are pushed below the counts; that may cost a second count, not one for every window."""
    text = " ".join(f"w{k % 61}x{k}" for k in range(100_000)) + " again " * 40
    docs = spark.createDataFrame([(1, text, "en"), (2, "a b", "en")], "doc_id long, text string, lang string")
    began = time.monotonic()
    assert quality.features(docs).where(~F.col("base_failed")).select("doc_id", "n_repeat_words").collect() == [(1, 40)]
    assert time.monotonic() - began < 60
