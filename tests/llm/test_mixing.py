import pytest
from pyspark.sql import functions as F

from stackweave.llm import common, mixing
from tests.llm import helpers


def poured(sizes, weights, budget, repeats=2):
    """Water filling by rounds: full sources drop out, the rest share again."""
    target, open_ = {}, set(sizes)
    while open_:
        left = budget - sum(target.values())
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total >= repeats * sizes[s]}
        for s in full or open_:
            target[s] = repeats * sizes[s] if full else left * weights[s] / total
        open_ -= full or open_
    return target


def sized(docs):
    return docs.withColumn("size", common.word_count(F.col("text")))


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 400, None: 90}, {"a": 5}, {"a": 0, "b": 0}, {"a": 100, "b": 100, "c": 100, "d": 1}])
def test_targets_are_poured_by_weight(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(df).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = poured(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    assert found == {s: pytest.approx(t) for s, t in want.items()}


def test_taken_words_meet_the_targets(spark, small):
    docs = sized(common.documents(spark, small)).select("doc_id", "source", "size")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
        by_source.setdefault((r.source, r.target), []).append(r.taken)
    assert all(sum(taken) == round(target) for (_, target), taken in by_source.items())
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_offsets_are_running_sums_in_hash_order(spark):
    import hashlib

    docs = spark.createDataFrame([(k, "s", k % 7) for k in range(500)], "doc_id long, source string, size long")
    found = {r.doc_id: r.offset for r in mixing.mix(docs).collect()}
    at = 0
    for k in sorted(range(500), key=lambda k: hashlib.md5(str(k).encode()).hexdigest()):
        assert found[k] == at
        at += k % 7


@pytest.mark.parametrize("knots", [((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.0), (0.25, 2.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0))])
def test_time_inverts_the_integrated_schedule(spark, knots):
    def demand(t):
        total = 0.0
        for (t0, m0), (t1, m1) in zip(knots, knots[1:], strict=False):
            upto = min(t, t1)
            if upto > t0:
                end = m0 + (m1 - m0) * (upto - t0) / (t1 - t0)
                total += (upto - t0) * (m0 + end) / 2
        return total

    shares = [k / 20 for k in range(21)]
    df = spark.createDataFrame([(s,) for s in shares], "share double")
    for r in df.select("share", mixing.time_of_share(F.col("share"), knots).alias("t")).collect():
        assert demand(r.t) / demand(1.0) == pytest.approx(r.share, abs=1e-9)


def test_training_order(spark):
    docs = helpers.awkward(spark).withColumns({"size": F.lit("mine"), "n": F.lit(1), "weight": F.lit("own"), "offset": F.lit(7)})
    rows = mixing.training_order(docs).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert {"doc_id", "text", "lang", "source", "n", "weight", "offset", "size", "taken", "pass_no", "position"} == set(mixing.training_order(docs).columns)
    assert {(r.weight, r.offset) for r in rows} == {("own", 7)}
    assert all(0 < r.taken <= r.size for r in rows)
    assert mixing.training_order(helpers.empty(spark)).count() == 0
