import json

from stackweave.operators import logs
from stackweave.sources import landed


def test_captures(spark, tmp_path):
    stacks = [{"frames": [["/a.py", "main", 1], ["/b.py", "<lambda>", None]], "tid": 140704486641088}, {"frames": [], "tid": 2}]
    (tmp_path / "in.json").write_text(json.dumps(stacks))
    rows = {r.tid: [tuple(f) for f in r.frames] for r in landed.read_captures(spark, str(tmp_path)).collect()}
    assert rows == {140704486641088: [("/a.py", "main", 1), ("/b.py", "<lambda>", None)], 2: []}


def test_thread_states_keep_every_digit(spark, tmp_path):
    big = 2**128 - 1
    states = {"140704486641088": [35200723245212232826843218619177113106, 10843983915729947523], "2": [big, 1], "3": None}
    (tmp_path / "s.json").write_text(json.dumps(states))
    rows = {r.tid: (r.trace_id, r.span_id) for r in landed.read_thread_states(spark, str(tmp_path)).collect()}
    assert rows == {
        140704486641088: ("1a7b69a6755c414461f4ec7fcdb41612", "967d91eadf220b83"),
        2: ("f" * 32, "0" * 15 + "1"),
        3: (None, None),
    }


def test_nested_log_exports(spark, tmp_path):
    record = {"body": "x", "attributes": {"event.name": "report"}}
    request = {
        "resource_logs": [
            {"resource": {"attributes": {"service.name": "a"}},
             "scope_logs": [{"scope": {"name": "deps"}, "log_records": [record, {"body": "y", "attributes": {}}]},
                            {"scope": {"name": "app"}, "log_records": [record]}]},
            {"resource": {"attributes": {}}, "scope_logs": []},
        ]
    }
    (tmp_path / "r.json").write_text(json.dumps(request))
    flat = logs.flatten_logs(landed.read(spark, "log_exports", str(tmp_path), "json"))
    assert sorted((r.scope, r.position, r.body) for r in flat.collect()) == [("app", 0, "x"), ("deps", 0, "x"), ("deps", 1, "y")]
    assert [r.body for r in logs.in_scope(flat, "deps", "event.name", "report").collect()] == ["x"]


def test_streams_use_the_same_schemas(spark, tmp_path):
    table = spark.createDataFrame([("p", "k", "v")], landed.SCHEMAS["config_entries"])
    table.write.parquet(str(tmp_path / "c"))
    stream = landed.read(spark, "config_entries", str(tmp_path / "c"), stream=True)
    assert stream.isStreaming and stream.schema == table.schema


def test_span_exports(spark, tmp_path):
    from datetime import datetime

    span = {"trace_id": "AB" * 16, "span_id": "cd" * 8, "parent_span_id": "", "name": "n", "start_time_unix_nano": 1_700_000_000_123_456_789,
            "end_time_unix_nano": 0, "attributes": {"k": "v"}}
    request = {"resource_spans": [
        {"resource": {"attributes": {"service.name": "a"}}, "scope_spans": [{"scope": {"name": "s"}, "spans": [span, {}]}, {"spans": []}, {}]},
        {"scope_spans": None},
    ]}
    (tmp_path / "r.json").write_text(json.dumps(request))
    rows = logs.flatten_spans(landed.read(spark, "span_exports", str(tmp_path), "json")).orderBy("position").collect()
    assert len(rows) == 2 and rows[1].trace_id is None and rows[1].start_ts is None
    first = rows[0]
    assert (first.trace_id, first.span_id, first.parent_span_id) == ("ab" * 16, "cd" * 8, None)
    assert (first.start_ns, first.end_ns, first.end_ts) == (1_700_000_000_123_456_789, None, None)
    assert first.start_ts == datetime(2023, 11, 14, 22, 13, 20, 123456) and first.resource == {"service.name": "a"} and first.attributes == {"k": "v"}


def test_metric_exports(spark, tmp_path):
    number = {"time_unix_nano": 5, "attributes": {"k": "v"}}
    listed = [
        {"name": "g", "unit": "s", "gauge": {"data_points": [{**number, "as_double": 1.5}, {**number, "as_int": 2**60 + 1}, number]}},
        {"name": "s", "sum": {"data_points": [{**number, "as_int": 3}], "aggregation_temporality": 2, "is_monotonic": True}},
        {"name": "h", "histogram": {"data_points": [{"time_unix_nano": 6, "count": 3, "sum": 7.5, "bucket_counts": [1, 2], "explicit_bounds": [5.0]}], "aggregation_temporality": 1}},
        {"name": "none"}, {"name": "empty", "gauge": {"data_points": []}}, {"name": "other", "summary": {"data_points": [{}]}},
    ]
    (tmp_path / "m.json").write_text(json.dumps({"resource_metrics": [{"scope_metrics": [{"scope": {"name": "x"}, "metrics": listed}]}]}))
    rows = logs.flatten_metrics(landed.read(spark, "metric_exports", str(tmp_path), "json")).orderBy("metric", "position").collect()
    facts = [(r.metric, r.kind, r.position, r.time_ns, r.value, r.int_value, r["count"], r.total, r.bounds, r.buckets, r.temporality, r.is_monotonic) for r in rows]
    assert facts == [
        ("g", "gauge", 0, 5, 1.5, None, None, None, None, None, None, None),
        ("g", "gauge", 1, 5, float(2**60 + 1), 2**60 + 1, None, None, None, None, None, None),
        ("g", "gauge", 2, 5, None, None, None, None, None, None, None, None),
        ("h", "histogram", 0, 6, None, None, 3, 7.5, [5.0], [1, 2], 1, None),
        ("s", "sum", 0, 5, 3.0, 3, None, None, None, None, 2, True),
    ]
    assert rows[0].attributes == {"k": "v"} and rows[0].unit == "s"


def test_response_headers(spark):
    from stackweave.functions import ids

    df = spark.createDataFrame([("1", "2"), ("0" * 32, "2"), (None, None)], "t string, s string")
    found = [r[0] for r in df.select(ids.response_headers(df.t, df.s)).collect()]
    assert found == [{"Server-Timing": f'traceparent;desc="00-{"1".zfill(32)}-{"2".zfill(16)}-01"', "Access-Control-Expose-Headers": "Server-Timing"}, {}, {}]
