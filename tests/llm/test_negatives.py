"""Hard negatives against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stackweave.llm import common, negatives, queries
from tests.llm import helpers

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("width", [1, 8, 13, 64])
@pytest.mark.parametrize("most", [0, 1, 300, 2**24])
def test_scores_equal_products(width, most):
    dice = np.random.default_rng(width + most)
    a, c = (dice.integers(-most, most + 1, (n, width)) for n in (7, 50))
    pad = lambda m: np.pad(m, ((0, 0), (0, -width % 8)))
    found = negatives.scores(*negatives._tables(pad(a), pad(c)))
    assert (found == c @ a.T).all()


def test_integers_round_down_and_fill_up():
    column = pa.array([[0.5, -0.001], [], [1.0, 2.0, -3.0]], pa.list_(pa.float64()))
    assert negatives._integers(column).tolist() == [[128, -1] + [0] * 6, [0] * 8, [256, 512, -768] + [0] * 5]


def brute(rows):
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = []
    anchors = {}
    for vec_id, label, vector in usable:
        if vec_id % 50 == 0:
            anchors[vec_id] = min(anchors.get(vec_id, (label, vector)), (label, vector))
    for anchor, (label, vector) in anchors.items():
        ranked = sorted((-sum(x * y for x, y in zip(vector, v, strict=False)), i, lab) for i, lab, v in usable if i != anchor)
        for positive, pid, _ in [r for r in ranked if r[2] == label][:5]:
            inside = [r for r in ranked if r[2] != label and 50 * -positive <= 100 * -r[0] <= 95 * -positive]
            out += [(anchor, pid, rank, nid, -positive, -score) for rank, (score, nid, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def planted():
    """Vectors in clusters, a vector that a third of all rows share, ties, and all kinds of broken rows."""
    dice = random.Random(11)
    centres = [[dice.gauss(0, 0.2) for _ in range(16)] for _ in range(6)]
    rows = []
    for k in range(600):
        centre = dice.choice(centres)
        vector = centres[0] if k % 3 == 0 else [x + dice.gauss(0, 0.05) for x in centre]
        rows.append((k, vector, dice.randrange(4)))
    rows += [(50, [0.25] * 16, 1), (51, [1.0] * 3, 2), (52, [], 1), (-50, [0.3] * 20, 1), (700, None, 1), (750, [0.1] * 16, None)]
    rows += [(800, [0.1, None], 1), (850, [float("nan")] * 16, 1), (900, [float("inf")] * 16, 1), (None, [0.1] * 16, 1), (2**40, [0.2] * 16, 3)]
    return rows + rows[:20]


def test_equals_brute_force(spark, monkeypatch):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("mine"), "rank": F.lit(1)}).repartition(5)
    run = lambda: helpers.rows(negatives.mine(negatives.mislabelled(negatives.usable(df))), *NAMES)
    want = sorted(brute(rows), key=repr)
    assert run() == want and len(want) > 50
    # Several rounds and blocks give the same rows.
    monkeypatch.setattr(negatives, "GROUP", 8)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    assert run() == want


def test_registered_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in common.table(spark, small, "embeddings").select("vec_id", "embedding", "label").collect()]
    found = [tuple(r) for r in queries.op12_negatives(spark, small).select(*NAMES).collect()]
    assert sorted(found) == brute(rows)


def test_tables_without_rows_or_partners(spark):
    for rows in ([], [(50, [0.5] * 8, 1)], [(k, [0.5] * 8, 1) for k in (50, 51)], [(50, None, 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert negatives.mine(negatives.usable(df)).count() == 0
