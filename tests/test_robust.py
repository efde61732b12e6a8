"""Rows that exporters send although they should not."""

import base64
import gzip

from pyspark.sql import functions as F

from stackweave.functions import sampling
from stackweave.operators import attributes, callgraph, logs, reports
from stackweave.sources import report_log

FRAMES = "service string, frames array<struct<file:string,func:string,line:int>>"


def test_native_frames_have_no_file(spark):
    stack = [("a.py", "main", 1), (None, "read", None), (None, "write", None), ("", "read", None)]
    df = spark.createDataFrame([("s", stack)], FRAMES).withColumn("trace_id", F.lit("t"))
    times = {(r.file, r.func): (r.self_samples, r.total_samples) for r in callgraph.function_times(df, 10).collect()}
    assert times == {("a.py", "main"): (0, 1), (None, "read"): (0, 1), (None, "write"): (0, 1), ("", "read"): (1, 1)}
    edges = {(r.caller_file, r.caller, r.callee_file, r.callee) for r in callgraph.call_edges(df, 10).collect()}
    assert edges == {("a.py", "main", None, "read"), (None, "read", None, "write"), (None, "write", "", "read")}


def test_paths_whose_names_hold_the_separator_stay_apart(spark):
    rows = [("s", [("f", "a;b", 1)]), ("s", [("f", "a", 1), ("f", "b", 1)]), ("s", [("f", "a", 1), ("f", None, 1)])]
    found = callgraph.folded_stacks(spark.createDataFrame(rows, FRAMES), 10)
    assert sorted((r.stack, r.samples) for r in found.collect()) == [("a;[unknown]", 1), ("a;b", 1), ("a;b", 1)]


def test_a_damaged_body_does_not_end_the_job(spark):
    good = gzip.compress(b'{"id": "x", "fragment_index": 0}', mtime=0)
    damaged = good[:12] + bytes([good[12] ^ 0xFF]) + good[13:]
    bodies = [(base64.b64encode(b).decode(),) for b in (good, damaged, good[:9], b"plain")] + [(None,), ("%%%",)]
    found = report_log.decode(spark.createDataFrame(bodies, "body string"))
    assert sorted(r.id for r in found.collect() if r.id) == ["x"]


def test_fragments_outside_their_report_do_not_complete_it(spark):
    schema = "id string, fragment_index int, max_fragments int, is_done boolean, packages array<struct<name:string,version:string>>"
    rows = [
        ("whole", 0, 2, False, [("a", "1")]), ("whole", 1, 2, True, [("b", None)]),
        ("hole", 0, 2, False, [("c", "1")]), ("hole", 7, 2, True, [("d", "1")]),
        ("never", 0, 1, None, [("e", "1")]),
    ]
    df = spark.createDataFrame(rows, schema)
    assert {r.id: r.complete for r in reports.completeness(df).collect()} == {"whole": True, "hole": False, "never": False}
    assert sorted((r.name, r.version) for r in reports.reassemble(df).collect()) == [("a", "1"), ("b", None)]


def test_missing_items_of_lists(spark):
    rows = [("a", "list", None, "int", ["1", None, "3"]), ("b", "list", None, "string", ["x", None]), ("c", "list", None, "int", None), ("d", None, "v", None, None)]
    df = spark.createDataFrame(rows, "key string, type string, value string, item_type string, items array<string>")
    assert {r.key: r.value for r in attributes.encode(df).collect()} == {"a": "[1,null,3]", "b": '["x",null]'}
    assert sorted(r.key for r in attributes.unsupported(df).collect()) == ["c", "d"]


def test_routes_are_added_to(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",)], "scope string")
    for _ in range(2):
        logs.write_routes(rows, str(tmp_path / "out"), {"a": "first"})
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_the_coin_is_fair_and_repeats(spark):
    df = spark.range(4000)
    chosen = df.select(sampling.random_selected(F.col("id"), 0.25, seed=3).alias("x"))
    heads = chosen.filter("x").count()
    assert 850 < heads < 1150 and chosen.filter("x").count() == heads
    assert df.filter(sampling.random_selected(F.col("id"), 0.0)).count() == 0
    assert df.filter(sampling.random_selected(F.lit(None).cast("string"), 1.0)).count() == 4000
