import random
from datetime import datetime, timedelta

import pytest

from stackweave.operators import context

START = datetime(2024, 1, 1)
CHANGES = "service string, tid long, ts timestamp_ntz, seq long, trace_id string, span_id string"
SAMPLES = "service string, tid long, ts timestamp_ntz, sample_id long"


def at(seconds):
    return START + timedelta(seconds=seconds)


def attached(spark, samples, changes, **options):
    out = context.attach_context(
        spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(changes, CHANGES), **options
    )
    return {r.sample_id: (r.trace_id, r.span_id) for r in out.collect()}


def test_attach_without_span_changes_nothing_and_detach_clears(spark):
    events = spark.createDataFrame(
        [
            ("a", 1, at(0), 1, "attach", "t1", "s1"),
            ("a", 1, at(1), 2, "attach", None, None),
            ("a", 1, at(2), 3, "detach", "t0", "s0"),
            ("a", 1, at(3), 4, "detach", None, None),
        ],
        "service string, tid long, ts timestamp_ntz, seq long, kind string, trace_id string, span_id string",
    )
    changes = [tuple(r) for r in context.context_changes(events).collect()]
    assert [c[3] for c in sorted(changes, key=lambda c: c[3])] == [1, 3, 4]
    samples = [("a", 1, at(s + 0.5), s) for s in range(4)]
    assert attached(spark, samples, changes) == {
        0: ("t1", "s1"), 1: ("t1", "s1"), 2: ("t0", "s0"), 3: (None, None),
    }


def test_change_at_the_instant_of_a_sample_counts_and_seq_breaks_ties(spark):
    changes = [
        ("a", 1, at(5), 2, "late", "x"), ("a", 1, at(5), 1, "early", "y"), ("a", 1, at(5.000001), 3, "after", "z"),
    ]
    assert attached(spark, [("a", 1, at(5), 7)], changes) == {7: ("late", "x")}


def test_threads_and_services_do_not_mix(spark):
    changes = [("a", 1, at(0), 1, "t", "s")]
    samples = [("a", 1, at(1), 1), ("a", 2, at(1), 2), ("b", 1, at(1), 3)]
    assert attached(spark, samples, changes) == {1: ("t", "s"), 2: (None, None), 3: (None, None)}


@pytest.mark.parametrize("slice_seconds", [1, 7, 300, 100_000])
def test_equals_brute_force_whatever_the_slices(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    keys = [("a", 1)] * 6 + [("a", 2), ("b", 1)]
    changes = []
    for seq in range(150):
        service, tid = rng.choice(keys)
        gone = rng.random() < 0.3
        changes.append(
            (service, tid, at(rng.randrange(400)), seq, None if gone else f"t{seq}", None if gone else f"s{seq}")
        )
    samples = [(*rng.choice(keys), at(rng.randrange(400)), i) for i in range(300)]
    rng.shuffle(changes)

    def latest(service, tid, ts):
        past = [c for c in changes if c[:2] == (service, tid) and c[2] <= ts]
        return max(past, key=lambda c: (c[2], c[3]))[4:] if past else (None, None)

    want = {i: latest(service, tid, ts) for service, tid, ts, i in samples}
    assert attached(spark, samples, changes, slice_seconds=slice_seconds) == want


def test_samples_move_once_and_nothing_is_paired(spark):
    out = context.attach_context(
        spark.createDataFrame([("a", 1, at(0), 1)], SAMPLES),
        spark.createDataFrame([("a", 1, at(0), 1, "t", "s")], CHANGES),
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("ENSURE_REQUIREMENTS") == 4


def test_sampler_thread_is_left_out(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 1)], "service string, tid long, sampler_tid long")
    assert [r.tid for r in context.exclude_sampler_thread(rows).collect()] == [2]


def test_instances_of_a_service_do_not_mix(spark):
    """Two processes of one service use the same thread ids."""
    def named(rows, schema):
        return spark.createDataFrame(rows, schema.replace("service string,", "service string, instance string,"))

    changes = named([("a", "i0", 1, at(0), 1, "t0", "s0"), ("a", "i1", 1, at(1), 1, "t1", "s1"), ("a", "i1", 1, at(5), 2, None, None)], CHANGES)
    samples = named([("a", "i0", 1, at(9), 1), ("a", "i1", 1, at(2), 2), ("a", "i1", 1, at(9), 3), ("a", "i2", 1, at(9), 4)], SAMPLES)
    found = {r.sample_id: (r.instance, r.trace_id) for r in context.attach_context(samples, changes).collect()}
    assert found == {1: ("i0", "t0"), 2: ("i1", "t1"), 3: ("i1", None), 4: ("i2", None)}
