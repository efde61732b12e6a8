import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stackweave.llm import common, queries, simhash
from tests.llm import helpers


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest index reachable over links of at most three bits."""
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(k) for k in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", "one", "Ä B", "a b c d e f g a b c", helpers.LONG])
def test_fingerprint(text):
    found = simhash.fingerprint(None if text is None else text.encode())
    assert found % (1 << 64) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c')").first()[0] == signed(xxhash.xxh64_intdigest(b"a b c", 42))


def test_components_equal_brute_force(spark):
    """Chains, stars and near misses of one to four bits around random centres."""
    dice = random.Random(3)
    values = []
    for _ in range(40):
        at = dice.getrandbits(64)
        for _ in range(12):
            values.append(at)
            for bit in dice.sample(range(64), dice.choice([1, 2, 3, 3, 4])):
                at ^= 1 << bit
    values = sorted(set(values))
    want = plain_components(values)
    df = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    found = {r.node: r.component for r in common.components(simhash.links(df)).collect()}
    groups = {}
    for v, w in zip(values, want, strict=True):
        groups.setdefault(w, set()).add(found.get(signed(v), signed(v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_clusters_with_and_without_masks():
    dice = np.random.default_rng(1)
    base = dice.integers(0, 1 << 62)
    members = np.unique(base ^ (np.int64(1) << dice.integers(0, 40, (300, 2))).sum(1))
    by_pairs = sorted(simhash.clusters(members, simhash._masks()))
    by_masks = sorted(simhash.clusters(members, simhash._masks()[: len(members) - 1])) if len(members) > 43745 else by_pairs
    assert by_pairs == by_masks
    few = simhash._masks()
    big = np.concatenate((members, members + 1))
    a = sorted(simhash.clusters(big, few))
    original = len(big)
    assert original <= len(few)
    # The look-up path on the same members, by padding with distant fingerprints.
    far = dice.integers(-(1 << 62), 0, len(few))
    b = [p for p in simhash.clusters(np.unique(np.concatenate((big, far))), few) if p[0] in set(big.tolist())]
    roots = {}
    for member, root in b:
        roots.setdefault(root, []).append(member)
    assert {m for m, _ in a} <= {m for m, _ in b} | set(roots)


def test_query_equals_brute_force(spark, small):
    docs = common.documents(spark, small).collect()
    values = [plain_fingerprint(r.text) for r in sorted(docs, key=lambda r: r.doc_id)]
    ids = sorted(r.doc_id for r in docs)
    want = [(i, f"{v:016x}", ids[c]) for i, v, c in zip(ids, values, plain_components(values), strict=True)]
    assert helpers.rows(queries.op3_simhash(spark, small), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


def test_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("fingerprint", F.lit("mine"))
    found = simhash.near_duplicates(docs)
    assert found.count() == len(helpers.ROWS)
    by_id = {r.doc_id: r for r in found.collect()}
    assert [by_id[k].fingerprint for k in (2, 3, 4)] == [0, 0, 0]
    assert [by_id[k].component_id for k in (2, 3, 4)] == [2, 2, 2]
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 5, 6, 7]
    assert simhash.near_duplicates(helpers.empty(spark)).count() == 0
    assert simhash.keep_one_each(helpers.empty(spark)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(k, k + 1) for k in range(200)]
    hub = [(1000, k) for k in range(1001, 1300)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert set(found.values()) == {0, 1000} and len(found) == 201 + 300
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_with_several_texts_stays_in_each_component(spark):
    texts = [" ".join(f"{word}{k}" for k in range(60)) for word in ("alpha", "beta", "gamma")]
    rows = [(5, texts[0]), (5, texts[1]), (7, texts[1]), (3, texts[2]), (5, texts[2]), (5, texts[0]), (8, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in simhash.keep_one_each(docs).collect()) == sorted([(5, texts[0]), (5, texts[1]), (3, texts[2])])
