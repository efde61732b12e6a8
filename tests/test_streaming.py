import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stackweave import session
from stackweave.operators import context as batch_context
from stackweave.operators import profiles
from stackweave.operators import spans as batch_spans
from stackweave.plans import catalog
from stackweave.sources import profile_log
from stackweave.streaming import context, ordered, sinks, windows
from stackweave.streaming import profiles as stream_profiles

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


CHANGES = "service string, tid long, ts timestamp, seq long, trace_id string, span_id string"
SAMPLES = (
    "service string, tid long, ts timestamp, sample_id long, frames array<struct<file:string,func:string,line:int>>"
)


def stream(spark, batches, schema):
    """One file, and so one micro-batch, per list of rows."""
    path = session.new_folder(spark, "test-stream")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_context_follows_event_time_and_carries_frames(spark):
    big = 2**60 + 1
    samples = [("a", 1, at(s), big + s, [("f", "g", None)]) for s in (1, 3, 5)]
    changes = [("a", 1, at(2), 1, "t1", "s1"), ("a", 1, at(3), 2, "t2", "s2"), ("a", 1, at(4), 3, None, None)]
    batch = batch_context.attach_context(
        spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(changes, CHANGES)
    )
    far = ("a", 9, at(10**6), 0, [])
    out = context.attach_context(
        stream(spark, [[samples[2]], [samples[0], samples[1]], [far]], SAMPLES),
        stream(spark, [[changes[2], changes[0]], [changes[1]]], CHANGES),
        "1 hour",
    )
    columns = ["service", "tid", "ts", "sample_id", "trace_id", "span_id", "frames"]
    got = sinks.drain(out, "test-context").select(columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.select(columns).collect()))
    assert {r.sample_id - big: r.trace_id for r in got.collect()} == {1: None, 3: "t2", 5: None}


def test_rows_behind_the_watermark_are_counted(spark):
    path = session.new_folder(spark, "late")
    # Spark leaves rows out by the watermark of the batch before the last one.
    moments = [0, 7200, 7300, 1, 9000]
    rows = [[("a", 1, at(s), s, [])] for s in moments]
    df = windows.ticks(stream(spark, rows, SAMPLES), "continuous", "1 second", "1 minute")
    late = sinks.LateRows()
    spark.streams.addListener(late)
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-c")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    deadline = time.time() + 10
    while late.of(query) == 0 and time.time() < deadline:
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.of(query) == 1
    assert spark.read.parquet(path).count() == 3


def test_stream_resumes_from_its_checkpoint(spark):
    """State of an earlier run decides the samples of a later one."""
    source, out = session.new_folder(spark, "in"), session.new_folder(spark, "out")
    spans = session.new_folder(spark, "spans")
    sample_schema = "service string, tid long, ts timestamp, sample_id long, trace_id string, span_id string"
    span_schema = "service string, trace_id string, span_id string, start_ts timestamp, end_ts timestamp"

    def run(samples, tracked):
        spark.createDataFrame(samples, sample_schema).coalesce(1).write.mode("append").parquet(source)
        spark.createDataFrame(tracked, span_schema).coalesce(1).write.mode("append").parquet(spans)
        kept = context.keep_tracked(
            spark.readStream.schema(sample_schema).parquet(source),
            spark.readStream.schema(span_schema).parquet(spans),
            "10 seconds",
        )
        query = (
            kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(r.sample_id for r in spark.read.parquet(out).collect())

    first = run(
        [("a", 1, at(5), 1, "t", "s"), ("a", 1, at(1000), 2, "t", "s")], [("a", "t", "s", at(0), None)]
    )
    assert first == [1]
    later = run(
        [("a", 1, at(1500), 3, "t", "s"), ("a", 1, at(3000), 4, "t", "s"), ("a", 1, at(9999), 5, "x", "s")],
        [("a", "t", "other", at(1100), at(2000))],
    )
    assert later == [1, 2, 3, 4]


def test_routed_batches_are_idempotent(spark):
    path = session.new_folder(spark, "routed")
    records = stream(spark, [[(1, "deps")], [(2, "app")]], "id int, scope string")
    for run in ("one", "two"):
        sinks.write_routes(records, path, f"{path}-{run}", {"deps": "reports"}).awaitTermination()
    got = sorted((r.id, r.route) for r in spark.read.parquet(path).collect())
    assert got == [(1, "reports"), (2, "default")]
    dated = stream(spark, [[(1, "deps", at(0))], [(2, "deps", at(90_000))]], "id int, scope string, ts timestamp")
    for run in ("one", "two"):
        sinks.write_routes(dated, f"{path}-dated", f"{path}-dated-{run}", {"deps": "reports"}, "ts").awaitTermination()
    found = spark.read.parquet(f"{path}-dated")
    assert [(r.id, str(r.date), r.route) for r in found.where("date > date'2024-01-01'").collect()] == [(2, "2024-01-02", "reports")]
    assert found.count() == 2


def test_replay_keeps_rows_many_years_apart(spark):
    """Whatever comes first: nothing is late, and nothing stays behind."""
    years = [2150, 2021, 2020, 2000, 1975, 2024]
    rows = [("a", 1, datetime(year, 1, 1), year, []) for year in years]
    replayed = sinks.Replay(spark.createDataFrame(rows, SAMPLES), "years", "ts", slices=5)
    assert sinks.delay_of(replayed) == "1 seconds"
    out = windows.ticks(replayed.stream, "continuous", "1 second", sinks.delay_of(replayed))
    got = sinks.drain(out, "years-ticks", replayed)
    assert sorted(r.tick_ts.year for r in got.collect()) == sorted(years)


def test_stream_filter_equals_batch_on_odd_spans(spark):
    """Spans without a length, that end before they start, or that never end."""
    sample_schema = "service string, tid long, ts timestamp, sample_id long, trace_id string, span_id string"
    span_schema = "service string, trace_id string, span_id string, start_ts timestamp, end_ts timestamp"
    tracked = [("a", "t1", "1", at(5), at(5)), ("a", "t2", "2", at(5), at(1)), ("a", "t3", "3", at(5), None), ("a", "t4", "4", at(2), at(8))]
    samples = [("a", 1, at(s), 10 * s + k, f"t{k}", "x") for s in (0, 2, 5, 7, 8, 20) for k in (1, 2, 3, 4)]
    taken, chosen = spark.createDataFrame(samples, sample_schema), spark.createDataFrame(tracked, span_schema)
    both = sinks.Replay(taken, "odd-samples", "ts"), sinks.Replay(chosen, "odd-spans", "start_ts", "end_ts")
    out = context.keep_tracked(both[0].stream, both[1].stream, sinks.delay_of(*both))
    got = sorted(r.sample_id for r in sinks.drain(out, "odd", *both).collect())
    assert got == sorted(r.sample_id for r in batch_spans.keep_tracked(taken, chosen).collect())
    assert got == [24, 53, 54, 73, 74, 83, 203]


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_may_be_a_file_or_a_folder(spark, small, parts):
    folder = session.new_folder(spark, "tables")
    pages = spark.read.parquet(f"{small}/pages.parquet")
    pages.repartition(parts).write.parquet(f"{folder}/pages.parquet")
    assert sinks.drain(catalog.stream_of(spark, folder, "pages"), "pages").count() == pages.count()
    assert sinks.drain(catalog.stream_of(spark, small, "pages"), "pages").count() == pages.count()


def state_rows(query):
    """Rows in state after the last batch that had any state."""
    told = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    return told[-1]


def run(df, label):
    path = session.new_folder(df.sparkSession, label)
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query, df.sparkSession.read.schema(df.schema).parquet(path)


def test_silent_threads_are_forgotten(spark):
    """Buckets that were folded are gone, and with a limit so is the context of a silent thread."""
    samples = [[("a", t, at(60 * t), t, []) for t in range(30)], [("z", 9, at(90_000), 99, [])], [("a", 1, at(90_001), 98, [])], [("z", 9, at(200_000), 97, [])]]
    changes = [[("a", t, at(60 * t - 5), t, f"t{t}", f"s{t}") for t in range(30)], [("z", 9, at(90_000), 1, None, None)], [], [("z", 9, at(200_000), 2, None, None)]]
    kept = {}
    for idle in (None, 3600):
        out = context.attach_context(stream(spark, samples, SAMPLES), stream(spark, [c for c in changes if c], CHANGES), "1 second", 30, idle)
        query, found = run(out.drop("frames"), "idle")
        rows = {r.sample_id: r.trace_id for r in found.collect()}
        assert all(rows[t] == f"t{t}" for t in range(30))
        kept[idle] = (state_rows(query), rows.get(98))
    assert kept[None][1] == "t1" and kept[3600][1] is None
    assert kept[3600][0] < kept[None][0] / 2


def test_spans_without_an_end_are_forgotten(spark):
    sample_schema = "service string, tid long, ts timestamp, sample_id long, trace_id string, span_id string"
    span_schema = "service string, trace_id string, span_id string, start_ts timestamp, end_ts timestamp"
    samples = [[("a", 1, at(s), s, "t", "x") for s in (10, 500, 5000)], [("a", 1, at(9000), 9000, "u", "x")], [("a", 1, at(99_000), 99_000, "v", "x")]]
    spans = [[("a", "t", "s", at(5), None)], [("a", "u", "s", at(9000), None)], [("a", "v", "s", at(99_000), None)]]
    found = {}
    for idle in (None, 1000):
        out = context.keep_tracked(stream(spark, samples, sample_schema), stream(spark, spans, span_schema), "1 second", 60, idle)
        found[idle] = sorted(r.sample_id for r in run(out, "open")[1].collect())
    assert found == {None: [10, 500, 5000, 9000], 1000: [10, 500, 9000]}


def test_late_rows_are_kept_as_data_and_a_repeated_batch_changes_nothing(spark):
    rows = [[(1, at(100)), (2, at(200))], [(3, at(139)), (4, at(140)), (5, None)], [], [(6, at(300)), (7, at(0))]]
    df = stream(spark, [r for r in rows if r], "id int, ts timestamp")
    path = session.new_folder(spark, "late-data")
    for attempt in ("one", "two"):
        sinks.split_late(df, "ts", "1 minute", path, f"{path}-{attempt}").awaitTermination()
        found = {r.id: (r.timing, r.number, r.behind_seconds) for r in spark.read.parquet(f"{path}/rows").collect()}
        assert found == {1: ("timely", 0, 0.0), 2: ("timely", 0, 0.0), 3: ("late", 1, 1.0), 4: ("timely", 1, 0.0), 5: ("timely", 1, 0.0),
                         6: ("timely", 2, 0.0), 7: ("late", 2, 140.0)}


def test_stream_intervals_equal_batch_on_odd_spans(spark):
    """Spans that touch, nest, never end, end as they start, or end before; whatever order they come in."""
    schema = "service string, start_ts timestamp, end_ts timestamp"
    spans = [("a", at(0), at(10)), ("a", at(70), at(70)), ("a", at(130), at(120)), ("a", at(191), at(195)), ("a", at(192), at(900)), ("a", at(300), at(301)),
             ("b", at(0), at(5)), ("b", at(1000), None), ("b", at(5000), at(5001)), ("c", at(7), at(7))]
    dice = random.Random(3)
    spans += [("d", at(s), at(s + dice.randrange(200))) for s in (dice.randrange(20_000) for _ in range(60))]
    dice.shuffle(spans)
    df = spark.createDataFrame(spans, schema)
    replayed = sinks.Replay(df, "odd-intervals", "start_ts")
    out = windows.active_intervals(replayed.stream, delay=sinks.delay_of(replayed, until=windows.NEVER))
    columns = ["service", "start_ts", "end_ts"]
    got = sorted(map(tuple, sinks.drain(out, "odd-active", replayed).select(columns).collect()), key=repr)
    assert got == sorted(map(tuple, batch_spans.active_intervals(df, keys=["service"]).select(columns).collect()), key=repr)


@pytest.mark.parametrize(("parts", "part_samples"), [(1, 1000), (1, 3), (4, 2)])
def test_streamed_records_hold_the_samples_of_batch_records(spark, parts, part_samples):
    dice = random.Random(8)
    rows = [("a", dice.randrange(6), at(dice.randrange(4)), k, dice.choice([None, "ab" * 16]), None, [("f", dice.choice("gh"), dice.choice([None, 0, 3]))] * dice.randrange(3)) for k in range(50)]
    schema = "service string, tid long, ts timestamp, sample_id long, trace_id string, span_id string, frames array<struct<file:string,func:string,line:int>>"
    df = spark.createDataFrame(rows, schema)
    replayed = sinks.Replay(df, "to-records", "ts")
    out = stream_profiles.records(replayed.stream, delay=sinks.delay_of(replayed), parts=parts, part_samples=part_samples)
    records = sinks.drain(out, "streamed-records", replayed)
    batch = profile_log.log_records(profiles.in_ticks(df), part_samples=part_samples)
    facts = ["service", "tick_ts", "time_ms", "period_ms", "tid", "trace_id", "frames", "error"]
    both = [sorted(map(repr, profile_log.decode(r).select(*facts).collect())) for r in (records, batch)]
    assert both[0] == both[1] and len(both[0]) == 50
    assert records.agg(F.max("samples")).first()[0] <= part_samples
    assert records.groupBy(*profiles.KEY).count().where("count > 1").count() == 0
    if parts == 1 and part_samples == 1000:
        assert {r.body for r in records.collect()} == {r.body for r in batch.collect()}


def test_records_are_written_as_a_stream(spark):
    df = spark.createDataFrame([("a", 1, at(k), k, None, None, [("f", "g", 1)]) for k in range(5)], SAMPLES.replace("sample_id long,", "sample_id long, trace_id string, span_id string,"))
    landed, path = session.new_folder(spark, "landed"), session.new_folder(spark, "written")
    records = profile_log.log_records(profiles.in_ticks(df))
    records.write.parquet(landed)
    for attempt in ("one", "two"):
        arriving = spark.readStream.schema(records.schema).parquet(landed)
        profile_log.write_stream(arriving, path, f"{path}-{attempt}").awaitTermination()
    assert profile_log.read(spark, path, "2024-01-01", "2024-01-02").count() == 5


class Handle:
    """State in memory that counts how often it is touched."""

    def __init__(self):
        self.touched, self.timers = 0, set()

    def getMapState(self, *_):
        handle, held = self, {}

        class Map:
            def updateValue(self, key, value):
                handle.touched += 1
                held[key] = value

            def getValue(self, key):
                handle.touched += 1
                return held[key]

            def removeKey(self, key):
                handle.touched += 1
                del held[key]

        return Map()

    def getValueState(self, *_):
        handle, held = self, []

        class Value:
            def exists(self):
                handle.touched += 1
                return bool(held)

            def get(self):
                handle.touched += 1
                return held[0] if held else None

            def update(self, value):
                handle.touched += 1
                held[:] = [value]

            def clear(self):
                handle.touched += 1
                held.clear()

        return Value()

    def registerTimer(self, at):
        self.touched += 1
        self.timers.add(at)


@pytest.mark.parametrize("rows", [40, 5000])
def test_state_is_touched_by_batch_and_not_by_row(rows):
    """Rows far apart, as those of a quiet thread: a few calls a batch, whatever the number of buckets."""
    handle, processor = Handle(), context.CurrentContext(60)
    processor.init(handle)
    order = list(range(rows))
    random.Random(3).shuffle(order)
    found = []
    for half in (order[::2], order[1::2]):
        moves = [(k * 600_000_000, k % 2, 0, k, f"t{k}" if k % 2 == 0 else None, "s", None) for k in half]
        list(processor.handleInputRows(("a", "i", 1), [pd.DataFrame(moves, columns=ordered.ROW_NAMES)], None))
    for passed in (rows * 300_000, rows * 600_000 + 60_000):
        while due := [at for at in handle.timers if at <= passed]:
            handle.timers.remove(min(due))
            clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda self: passed})()
            for out in processor.handleExpiredTimer(("a", "i", 1), clock, None):
                found += list(out[["sample_id", "trace_id"]].itertuples(index=False, name=None))
    assert found == [(k, f"t{k - 1}") for k in range(1, rows, 2)]
    assert handle.touched < 60
