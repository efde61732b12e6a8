import random

import pytest
from pyspark.sql import functions as F

from stackweave.llm import common, queries, tiling
from tests.llm import helpers


def plain_tiles(item, text, least):
    """Greedy string tiling by looking at all places, longest runs first."""
    done_item, done_text, out = set(), set(), []
    while True:
        best = []
        size = least - 1
        for p in range(len(item)):
            for t in range(len(text)):
                k = 0
                while p + k < len(item) and t + k < len(text) and item[p + k] == text[t + k] and p + k not in done_item and t + k not in done_text:
                    k += 1
                if k > size:
                    best, size = [], k
                if k == size and k >= least:
                    best.append((p, t))
        if not best:
            return out
        for p, t in best:
            if not (done_item & set(range(p, p + size)) or done_text & set(range(t, t + size))):
                done_item |= set(range(p, p + size))
                done_text |= set(range(t, t + size))
                out.append((p, t, size))


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_brute_force(seed):
    dice = random.Random(seed)
    item = dice.choices("abcdefgh"[: 2 + seed % 7], k=dice.randrange(3, 40))
    text = dice.choices("abcdefgh"[: 2 + seed % 7], k=dice.randrange(60)) + item[10:25] + ["z"] + item[:12]
    assert sum(k for _, _, k in tiling.tiles(item, text, 5)) == sum(k for _, _, k in plain_tiles(item, text, 5))
    for p, t, k in tiling.tiles(item, text, 5):
        assert item[p : p + k] == text[t : t + k] and k >= 5


def test_long_repeats_take_bounded_memory():
    assert sum(k for _, _, k in tiling.tiles(["a"] * 300, ["a"] * 20_000)) == 300


def test_query_equals_brute_force(spark, small):
    items = [(r.item_id, tiling._WORDS.findall(r.text.lower())) for r in common.table(spark, small, "benchmark").collect()]
    want = []
    for r in common.documents(spark, small).collect():
        words = tiling._WORDS.findall((r.text or "").lower())
        seeds = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for item_id, item in items:
            if any(tuple(item[k : k + 5]) in seeds for k in range(len(item) - 4)):
                found = tiling.tiles(item, words)
                share = sum(k for _, _, k in found) / len(item)
                if share >= tiling.COVERAGE:
                    want.append((r.doc_id, item_id, share, len(found)))
    assert want
    assert helpers.rows(queries.op7_tiling(spark, small), "doc_id", "item_id", "coverage", "n_tiles") == sorted(want, key=repr)


def test_reordered_passages_and_clean_texts(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    words = item.split()
    swapped = "start " + " ".join(words[8:]) + " then, again " + " ".join(words[:8]).upper() + "."
    docs = spark.createDataFrame([(1, swapped, "x"), (2, "alpha beta gamma delta epsilon and nothing else", "x"), (3, None, "x"), (None, item, "x")], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "too short an item"), (7, item)], "item_id long, text string")
    found = tiling.contaminated(docs, benchmark)
    assert helpers.rows(found, "doc_id", "item_id", "coverage", "n_tiles") == [(1, 7, 1.0, 2), (None, 7, 1.0, 1)]
    kept = tiling.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted((r.doc_id or -1) for r in kept.collect()) == [2, 3]


def test_awkward_rows(spark):
    benchmark = spark.createDataFrame([(1, helpers.LONG)], "item_id long, text string")
    assert helpers.rows(tiling.contaminated(helpers.awkward(spark), benchmark), "doc_id", "item_id", "coverage") == [(6, 1, 1.0)]
    assert tiling.keep_clean(helpers.empty(spark), benchmark).count() == 0
    none = benchmark.limit(0)
    assert tiling.keep_clean(helpers.awkward(spark).withColumn("_text", F.lit(1)), none).count() == len(helpers.ROWS)


def test_rows_that_share_an_id_or_have_none_are_judged_alone(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    clean = "nothing of the kind stands in this text at all"
    rows = [(1, item), (1, clean), (None, item), (None, clean), (None, None), (2, item), (2, item), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_key": F.lit("mine"), "item_id": F.lit(1)})
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert helpers.rows(tiling.keep_clean(docs, benchmark), "doc_id", "text", "_key") == sorted(
        [(1, clean, "mine"), (None, clean, "mine"), (None, None, "mine"), (3, "", "mine")], key=repr)
    assert helpers.rows(tiling.contaminated(docs, benchmark), "doc_id", "item_id") == [(1, 7), (2, 7), (None, 7)]
