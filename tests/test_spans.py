import random
from datetime import datetime, timedelta

import pytest

from stackweave.operators import spans

START = datetime(2024, 1, 1)
SPANS = "service string, trace_id string, span_id string, start_ts timestamp_ntz, end_ts timestamp_ntz"
SAMPLES = "service string, tid long, ts timestamp_ntz, sample_id long, trace_id string, span_id string"


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def test_entry_spans(spark):
    rows = spark.createDataFrame(
        [(1, None, None), (2, "0" * 16, None), (3, "ab", True), (4, "ab", False), (5, "ab", None)],
        "id int, parent_span_id string, parent_is_remote boolean",
    )
    assert sorted(r.id for r in spans.entry_spans(rows).collect()) == [1, 2, 3]


def test_parents_in_other_services_are_remote(spark):
    rows = spark.createDataFrame(
        [("a", "t", "1", None), ("a", "t", "2", "1"), ("b", "t", "3", "2"), ("b", "t", "4", "unknown")],
        "service string, trace_id string, span_id string, parent_span_id string",
    )
    found = {r.span_id: r.parent_is_remote for r in spans.resolve_parents(rows).collect()}
    assert found == {"1": False, "2": False, "3": True, "4": True}


def test_selection_marks_only_highest(spark):
    rows = spark.createDataFrame(
        [("1", None, "highest", {"a": "b"}), ("2", None, "off", {}), ("3", None, None, {}),
         ("4", "ab", "highest", {}), ("5", None, "highest", None)],
        "span_id string, parent_span_id string, volume string, attributes map<string,string>",
    ).selectExpr("*", "false as parent_is_remote")
    found = {r.span_id: r.attributes for r in spans.select_spans(rows).collect()}
    assert found == {"1": {"a": "b", "snapshot.profiling": "true"}, "5": {"snapshot.profiling": "true"}}


def kept(spark, samples, tracked, **options):
    out = spans.keep_tracked(
        spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(tracked, SPANS), **options
    )
    return sorted(r.sample_id for r in out.collect())


def test_only_the_thread_of_a_tracked_trace_is_kept(spark):
    tracked = [("a", "123", "456", at(0), at(10))]
    samples = [
        ("a", 1, at(5), 1, "123", "456"), ("a", 2, at(5), 2, "999", "888"), ("a", 3, at(5), 3, None, None),
        ("b", 1, at(5), 4, "123", "456"), ("a", 1, at(5), 5, "123", "other"),
    ]
    assert kept(spark, samples, tracked) == [1, 5]
    assert kept(spark, samples, [("a", "777", "1", at(0), at(10))]) == []


def test_spans_are_half_open_and_may_never_end(spark):
    samples = [("a", 1, at(s), s, "t", "s") for s in (0, 5, 10, 9000)]
    assert kept(spark, samples, [("a", "t", "1", at(5), at(10))]) == [5]
    assert kept(spark, samples, [("a", "t", "1", at(5), None)]) == [5, 10, 9000]


@pytest.mark.parametrize("slice_seconds", [1, 13, 3600])
def test_snapshot_filter_equals_brute_force(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    traces = ["hot"] * 5 + ["x", "y", None]
    tracked = []
    for i in range(60):
        start = rng.randrange(200)
        end = None if rng.random() < 0.05 else at(start + rng.randrange(30))
        tracked.append((rng.choice("ab"), rng.choice(traces[:-1]), f"s{i}", at(start), end))
    samples = [
        (rng.choice("ab"), 1, at(rng.randrange(260)), i, rng.choice(traces), "s") for i in range(300)
    ]
    want = sorted(
        s[3] for s in samples
        if any(s[0] == t[0] and s[4] == t[1] and t[3] <= s[2] and (t[4] is None or s[2] < t[4]) for t in tracked)
    )
    assert kept(spark, samples, tracked, slice_seconds=slice_seconds) == want


@pytest.mark.parametrize("slice_seconds", [1, 10, 3600])
def test_open_counts(spark, slice_seconds):
    rng = random.Random(3)
    rows = [("a", "t", f"s{i:02}", at(i * 3), at(i * 3 + rng.randrange(12))) for i in range(40)]
    out = spans.open_span_counts(spark.createDataFrame(rows, SPANS), slice_seconds=slice_seconds).collect()
    edges = sorted(
        [(r[3], -1, r[2]) for r in rows] + [(r[4], 1, r[2]) for r in rows]
    )
    count, want = 0, []
    for ts, order, span in edges:
        count -= order
        want.append((ts, span, count))
    got = sorted(((r.ts, -r.delta, r.span_id, r.open) for r in out))
    assert [(ts, span, n) for ts, _, span, n in got] == want
    assert got[-1][3] == 0


def intervals(spark, rows, **options):
    out = spans.active_intervals(spark.createDataFrame(rows, SPANS), **options)
    return sorted(
        ((r.start_ts - START).total_seconds(), (r.end_ts - START).total_seconds()) for r in out.collect()
    )


def test_a_start_during_the_linger_keeps_the_profiler_running(spark):
    rows = [
        ("a", "t", "1", at(0), at(10)), ("a", "t", "2", at(69), at(70)), ("a", "t", "3", at(131), at(132)),
        ("a", "t", "4", at(5), at(6)),
    ]
    assert intervals(spark, rows) == [(0, 130), (131, 192)]


@pytest.mark.parametrize("slice_seconds", [1, 50, 100_000])
def test_intervals_equal_brute_force(spark, slice_seconds):
    rng = random.Random(5)
    rows = []
    for i in range(80):
        start = rng.randrange(8000)
        rows.append(("a", "t", str(i), at(start), at(start + rng.randrange(60))))
    want = []
    for start, end in sorted(((r[3] - START).total_seconds(), (r[4] - START).total_seconds() + 60) for r in rows):
        if want and start <= want[-1][1]:
            want[-1] = (want[-1][0], max(want[-1][1], end))
        else:
            want.append((start, end))
    assert intervals(spark, rows, slice_seconds=slice_seconds) == want


def test_a_parent_exported_twice_counts_once(spark):
    rows = spark.createDataFrame(
        [("a", "t", "1", None), ("a", "t", "1", None), ("b", "t", "2", "1")],
        "service string, trace_id string, span_id string, parent_span_id string",
    )
    assert spans.resolve_parents(rows).filter("span_id = '2'").count() == 1


def test_intervals_with_open_and_odd_spans(spark):
    rows = [("a", "t", "1", at(0), at(10)), ("a", "t", "2", at(500), None), ("a", "t", "3", at(900), at(950)),
            ("b", "t", "4", at(100), at(40)), ("b", "t", "5", at(1000), at(1000))]
    found = spans.active_intervals(spark.createDataFrame(rows, SPANS))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [("a", at(0), at(70)), ("a", at(500), None), ("b", at(100), at(160)), ("b", at(1000), at(1060))], key=repr
    )


def test_a_span_that_ends_in_the_far_future_costs_two_rows(spark):
    far = datetime(9999, 12, 30)
    samples = [("a", 1, at(s), s, "t", "1") for s in (0, 5, 10**7)]
    assert kept(spark, samples, [("a", "t", "1", at(1), far)]) == [5, 10**7]
