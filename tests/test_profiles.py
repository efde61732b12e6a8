import base64
import gzip
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stackweave.functions import ids
from stackweave.operators import callgraph, profiles, quality
from stackweave.sources import profile_log, profile_source

TICK = datetime(2024, 9, 19, 15, 33, 20)
SAMPLES = (
    "service string, tid long, ts timestamp_ntz, sample_id long, trace_id string, span_id string, "
    "frames array<struct<file:string,func:string,line:int>>"
)

# A stack of 30 frames, root first, and what its profile holds.
STACK = """
/myapp/runner.py <module> 75
/site-packages/aaa/config/__init__.py main 175
/site-packages/bbb/_hooks.py __call__ 513
/site-packages/bbb/_manager.py _hookexec 120
/site-packages/bbb/_callers.py _multicall 103
/site-packages/aaa/main.py pytest_cmdline_main 330
/site-packages/aaa/main.py wrap_session 283
/site-packages/aaa/main.py _main 337
/site-packages/bbb/_hooks.py __call__ 513
/site-packages/bbb/_manager.py _hookexec 120
/site-packages/bbb/_callers.py _multicall 103
/site-packages/aaa/main.py pytest_runtestloop 362
/site-packages/bbb/_hooks.py __call__ 513
/site-packages/bbb/_manager.py _hookexec 120
/site-packages/bbb/_callers.py _multicall 103
/site-packages/aaa/runner.py pytest_runtest_protocol 113
/site-packages/aaa/runner.py runtestprotocol 132
/site-packages/aaa/runner.py call_and_report 241
/site-packages/aaa/runner.py from_call 341
/site-packages/aaa/runner.py <lambda> 242
/site-packages/bbb/_hooks.py __call__ 513
/site-packages/bbb/_manager.py _hookexec 120
/site-packages/bbb/_callers.py _multicall 103
/site-packages/aaa/runner.py pytest_runtest_call 174
/site-packages/aaa/unittest.py runtest 351
/python/unittest/case.py __call__ 736
/python/unittest/case.py run 676
/python/unittest/case.py _callTestMethod 633
/worktree/tests/unit/app.py test_profiling_export 193
/worktree/tests/unit/app.py do_work 52
"""
THREAD = 140704486641088
TRACE = "1a7b69a6755c414461f4ec7fcdb41612"
SPAN = "967d91eadf220b83"
STRINGS = [
    "source.event.time", "trace_id", "span_id", "thread.id", "source.event.period", TRACE, SPAN,
    "do_work", "/worktree/tests/unit/app.py", "test_profiling_export", "_callTestMethod",
    "/python/unittest/case.py", "run", "__call__", "runtest", "/site-packages/aaa/unittest.py",
    "pytest_runtest_call", "/site-packages/aaa/runner.py", "_multicall", "/site-packages/bbb/_callers.py",
    "_hookexec", "/site-packages/bbb/_manager.py", "/site-packages/bbb/_hooks.py", "<lambda>", "from_call",
    "call_and_report", "runtestprotocol", "pytest_runtest_protocol", "pytest_runtestloop",
    "/site-packages/aaa/main.py", "_main", "wrap_session", "pytest_cmdline_main", "main",
    "/site-packages/aaa/config/__init__.py", "<module>", "/myapp/runner.py",
]
LOCATIONS = [*range(1, 16), 8, 9, 10, 16, 8, 9, 10, 17, 18, 19, 8, 9, 10, 20, 21]


def frames(text):
    rows = [line.rsplit(" ", 2) for line in text.strip().splitlines()]
    return [(file, func, None if line == "-" else int(line)) for file, func, line in rows]


def numbered(spark, rows, **options):
    df = spark.createDataFrame(rows, SAMPLES)
    return profiles.together(profiles.number_samples(profiles.in_ticks(df), **options))


def in_order(df, number, *columns):
    return [tuple(r[c] for c in columns) for r in sorted(df.collect(), key=lambda r: r[number])]


def test_known_stack(spark):
    base = numbered(spark, [("a", THREAD, TICK, 1, TRACE, SPAN, frames(STACK))])
    seen = profiles.first_seen(base)
    strings = profiles.strings(base, seen)
    assert [t for (t,) in in_order(strings, "string_id", "token")] == STRINGS
    functions = in_order(profiles.functions(seen), "function_id", "func", "file")
    assert len(functions) == 21
    assert functions[:3] == [
        ("do_work", "/worktree/tests/unit/app.py"),
        ("test_profiling_export", "/worktree/tests/unit/app.py"),
        ("_callTestMethod", "/python/unittest/case.py"),
    ]
    lines = in_order(profiles.locations(seen), "location_id", "line")
    assert len(lines) == 21 and lines[:3] == [(52,), (193,), (633,)]
    assert profiles.samples(base).collect()[0].location_ids == LOCATIONS
    labels = profiles.labels(base, strings, 100)
    assert in_order(labels, "ord", "key_id", "string_id", "num") == [
        (0, None, 1726760000000), (4, None, 100), (3, None, THREAD), (1, 5, None), (2, 6, None),
    ]


def message(spark, rows, period=100, **options):
    df = profiles.in_ticks(spark.createDataFrame(rows, SAMPLES), **options)
    record = profile_log.log_records(df, period).collect()[0]
    found = profile_log.profile_message()()
    found.ParseFromString(gzip.decompress(base64.b64decode(record.body)))
    return record, found


def test_known_stack_as_message(spark):
    record, profile = message(spark, [("a", THREAD, TICK, 1, TRACE, SPAN, frames(STACK))])
    assert record.timestamp_ns == 1726760000 * 10**9
    assert record.attributes["profiling.data.total.frame.count"] == "30"
    assert record.attributes["profiling.data.format"] == "pprof-gzip-base64"
    assert record.attributes["profiling.instrumentation.source"] == "continuous"
    assert list(profile.string_table) == STRINGS
    assert [f.id for f in profile.function] == list(range(1, 22))
    first = profile.function[0]
    assert (first.name, first.system_name, first.filename) == (7, 7, 8)
    assert [(p.line[0].function_id, p.line[0].line) for p in profile.location][:3] == [(1, 52), (2, 193), (3, 633)]
    assert list(profile.sample[0].location_id) == LOCATIONS
    assert [(x.key, x.str, x.num) for x in profile.sample[0].label] == [
        (0, 0, 1726760000000), (4, 0, 100), (3, 0, THREAD), (1, 5, 0), (2, 6, 0),
    ]


def test_missing_line_and_line_zero_are_two_locations_that_show_minus_one(spark):
    base = numbered(spark, [("a", 1, TICK, 1, None, None, [("f", "g", None), ("f", "g", 0), ("f", "g", 42)])])
    seen = profiles.first_seen(base)
    assert in_order(profiles.locations(seen), "location_id", "line", "raw_line") == [(42, 42), (-1, 0), (-1, None)]
    assert profiles.functions(seen).count() == 1
    assert profiles.samples(base).collect()[0].location_ids == [1, 2, 3]


def test_names_equal_to_label_keys_keep_their_reserved_number(spark):
    base = numbered(spark, [("a", 1, TICK, 1, None, None, [("span_id", "source.event.time", 1)])])
    strings = profiles.strings(base, profiles.first_seen(base))
    assert in_order(strings, "string_id", "string_id", "token") == list(enumerate(profiles.RESERVED))


def test_names_with_colons_do_not_collide(spark):
    base = numbered(spark, [("a", 1, TICK, 1, None, None, [("a:b", "c", 1), ("a", "b:c", 1)])])
    assert profiles.functions(profiles.first_seen(base)).count() == 2


def several(rng):
    rows = []
    for i in range(40):
        stack = [(rng.choice("fgh"), rng.choice("abcde"), rng.choice([None, 0, 1, 2])) for _ in range(rng.randrange(9))]
        trace = rng.choice([None, f"{rng.getrandbits(100):032x}"])
        ts = TICK + timedelta(milliseconds=rng.randrange(3000))
        rows.append(("a", rng.randrange(5), ts, i, trace, trace and f"{rng.getrandbits(40):016x}", stack))
    return rows


def test_arrival_order_does_not_matter(spark):
    rows = several(random.Random(1))
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    for result in (
        lambda base: profiles.strings(base, profiles.first_seen(base)),
        lambda base: profiles.samples(base),
    ):
        first, second = (
            sorted(map(repr, result(numbered(spark, r)).collect())) for r in (rows, shuffled)
        )
        assert first == second


@pytest.mark.parametrize("part_samples", [1, 3, 1000])
def test_encode_then_decode_gives_the_samples_back(spark, part_samples):
    rows = several(random.Random(4))
    ticked = profiles.in_ticks(spark.createDataFrame(rows, SAMPLES))
    records = profile_log.log_records(ticked, 1000, part_samples)
    got = sorted(
        (r.tid, r.trace_id, r.span_id, [tuple(f) for f in r.frames])
        for r in profile_log.decode(records)
        .withColumns({"trace_id": F.coalesce(ids.trace_hex(F.col("trace_id")), F.lit("")),
                      "span_id": F.coalesce(ids.span_hex(F.col("span_id")), F.lit(""))})
        .collect()
    )
    want = sorted(
        (r[1], r[4] or "", r[5] or "", [(f, g, line or -1) for f, g, line in r[6]]) for r in rows
    )
    assert got == want
    assert sum(r.total_frames for r in records.collect()) == sum(len(r[6]) for r in rows)


def test_location_numbers_resolve(spark):
    base = numbered(spark, several(random.Random(6)))
    known = profiles.locations(profiles.first_seen(base)).groupBy(*profiles.KEY).count()
    used = (
        profiles.stacks(base).select(*profiles.KEY, F.explode("location_ids").alias("id"))
        .groupBy(*profiles.KEY).agg(F.max("id").alias("top"), F.count_distinct("id").alias("used"))
    )
    for row in known.join(used, profiles.KEY).collect():
        assert row["count"] == row["top"] == row["used"]


def test_user_filter_and_empty_ticks(spark):
    rows = [("a", 1, TICK, 1, None, None, [("f", "g", 1)]), ("a", 2, TICK + timedelta(seconds=5), 2, None, None, [("f", "g", 1)])]
    df = spark.createDataFrame(rows, SAMPLES)
    kept = profiles.in_ticks(df, keep=lambda samples: samples.filter("tid = 2"))
    assert [r.samples for r in profiles.records(profiles.number_samples(kept)).collect()] == [1]


def test_quality_finds_planted_faults(spark):
    good = [("a", 1, TICK, 1, TRACE, SPAN, [("f", "g", 1)])]
    records = profile_log.log_records(profiles.in_ticks(spark.createDataFrame(good, SAMPLES)), 1000)
    assert quality.violations(profile_log.decode(records)).count() == 0
    bad = [
        ("a", 1, TICK, 1, "0" * 32, SPAN, [("f", "g", 1)]),
        ("a", 2, TICK, 2, TRACE, None, [("f", "g", 1)]),
        ("a", 3, TICK, 3, TRACE, SPAN, []),
    ]
    records = profile_log.log_records(profiles.in_ticks(spark.createDataFrame(bad, SAMPLES)), 1000)
    broken = records.withColumn("body", F.lit("bm90IGd6aXA=")).withColumn("service", F.lit("b"))
    unknown = records.withColumn("attributes", F.lit(None).cast("map<string,string>")).withColumn("service", F.lit("c"))
    other = records.withColumn("scope", F.lit("something else"))
    found = quality.violations(profile_log.decode(records.unionByName(broken).unionByName(other)))
    assert sorted((r.service, r.sample, r.rule) for r in found.collect() if r.service == "a") == [
        ("a", 1, "missing_trace_id"), ("a", 2, "missing_span_id"), ("a", 3, "empty_stack"),
    ]
    assert [(r.sample, r.rule) for r in found.collect() if r.service == "b"] == [(None, "undecodable")]
    rules = {r.rule for r in quality.violations(profile_log.decode(unknown)).collect()}
    assert "wrong_format" in rules


def test_records_are_written_by_date_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    days = [TICK, TICK + timedelta(days=1), TICK + timedelta(days=2)]
    records = [
        profile_log.log_records(profiles.in_ticks(spark.createDataFrame([("a", 1, ts, k, TRACE, SPAN, [("f", "g", 1)])], SAMPLES)), 1000)
        for k, ts in enumerate(days)
    ]
    profile_log.write(records[0].unionByName(records[1]), path, 0)
    for _ in range(2):
        profile_log.write(records[1].unionByName(records[2]), path, 1)
    assert (tmp_path / "out" / "date=2024-09-20" / "service=a" / "source=continuous" / "batch=1").is_dir()
    assert profile_log.decode(spark.read.parquet(path)).count() == 4
    some = profile_log.read(spark, path, "2024-09-20", "2024-09-21")
    assert profile_log.decode(some).count() == 2
    assert "PartitionFilters: [isnotnull(date" in some._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_the_data_source_opens_only_the_files_that_filters_leave(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("a/b c", 1, TICK + timedelta(days=k), k, TRACE, SPAN, [("f", "g", 1)]) for k in range(4)]
    records = profile_log.log_records(profiles.in_ticks(spark.createDataFrame(rows, SAMPLES)))
    profile_log.write(records, path)
    profile_source.register(spark)
    found = spark.read.format("profile_records").load(path)
    names = ["service", "instance", "source", "part", "sample", "time_ms", "tid", "trace_id", "frames", "error"]
    assert sorted(map(repr, found.select(names).collect())) == sorted(map(repr, profile_log.decode(records).select(names).collect()))
    some = found.where("date >= date'2024-09-20' and date < date'2024-09-22' and service = 'a/b c' and sample = 1")
    assert some.rdd.getNumPartitions() == 2 and some.count() == 2
    assert found.where("service = 'other'").count() == 0 and found.where("batch in (0, 7)").count() == 4
    assert spark.read.format("profile_records").load(str(tmp_path / "nothing")).count() == 0


def test_recursion_counts_once_per_sample(spark):
    stack = [("f", "main", 1), ("f", "rec", 2), ("f", "rec", 2), ("f", "rec", 2)]
    df = spark.createDataFrame([("a", 1, TICK, 1, TRACE, SPAN, stack), ("a", 1, TICK, 2, TRACE, SPAN, stack[:1])], SAMPLES)
    times = {r.func: (r.self_ms, r.total_ms) for r in callgraph.function_times(df, 10).collect()}
    assert times == {"main": (10, 20), "rec": (10, 10)}
    edges = {(r.caller, r.callee): r.samples for r in callgraph.call_edges(df, 10).collect()}
    assert edges == {("main", "rec"): 1, ("rec", "rec"): 1}
    paths = {r.stack: r.samples for r in callgraph.folded_stacks(df, 10).collect()}
    assert paths == {"main": 1, "main;rec;rec;rec": 1}


def test_the_codec_numbers_as_the_tables_do(spark):
    """Strings, functions, locations and stacks of a record are those of the relational tables."""
    rows = several(random.Random(9)) + [("a", 3, TICK, 90 + i, None, None, [("h", "a", i)] * 3) for i in range(5)]
    base = numbered(spark, rows, part_samples=7).cache()
    seen = profiles.first_seen(base)
    strings = {}
    for r in profiles.strings(base, seen).orderBy("string_id").collect():
        strings.setdefault((r.tick_ts, r.part), []).append(r.token)
    places = {}
    for r in profiles.locations(seen).orderBy("location_id").collect():
        places.setdefault((r.tick_ts, r.part), []).append((r.file, r.func, r.line))
    stacks = {(r.tick_ts, r.part, r.sample): r.location_ids for r in profiles.samples(base).collect()}
    records = profile_log.encode(base, 1000).collect()
    assert len(records) == len(strings) > 6
    for record in records:
        profile = profile_log.profile_message()()
        profile.ParseFromString(gzip.decompress(base64.b64decode(record.body)))
        text, key = profile.string_table, (record.tick_ts, record.part)
        assert list(text) == strings[key]
        names = {f.id: (text[f.filename], text[f.name]) for f in profile.function}
        assert [(*names[p.line[0].function_id], p.line[0].line) for p in profile.location] == places[key]
        for number, sample in enumerate(profile.sample, 1):
            assert list(sample.location_id) == stacks[(*key, number)]
    base.unpersist()


def test_a_tick_with_most_samples_is_spread(spark):
    """Nine of ten samples, all of one moment, lie in one tick: its numbers are exact, and the work
    on it is cut into parts that lie in several tasks."""
    n = 9000
    rows = [("a", k % 700, TICK, k, None, None, [("f", str(k % 50), 1)]) for k in range(n)]
    rows += [("b", 1, TICK + timedelta(seconds=k), k, None, None, [("f", "g", 1)]) for k in range(n // 9)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = profiles.number_samples(profiles.in_ticks(spark.createDataFrame(rows, SAMPLES)), 500)
        found = ranged.where("service = 'a'").orderBy("part", "sample").select("part", "sample", "tid", "sample_id").collect()
        want = sorted((k % 700, k) for k in range(n))
        assert [(r.tid, r.sample_id) for r in found] == want
        assert [(r.part, r.sample) for r in found] == [(k // 500, k % 500 + 1) for k in range(n)]
        paths = ranged.inputFiles()
        sizes = spark.read.parquet(*paths).groupBy(F.input_file_name()).count().collect()
        assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 0.6 * len(rows)
        tasks = profiles.together(ranged).groupBy(F.spark_partition_id()).agg(F.count_distinct("part").alias("parts")).collect()
        assert len(tasks) >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
