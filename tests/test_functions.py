import gzip

import pytest
from pyspark.sql import functions as F

from stackweave.functions import ids, requirements, sampling
from stackweave.operators import inventory, limits, logs, reports
from stackweave.sources import report_log


def values(spark, rows, column):
    return [r.y for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column.alias("y")).collect()]


def test_ids(spark):
    x = F.col("x")
    assert values(spark, ["00ABcd"], ids.trace_hex(x)) == ["abcd".rjust(32, "0")]
    assert values(spark, ["0" * 32, "f" * 32, "0" * 20 + "1" * 12], ids.trace_label(x)) == [
        "0" * 16, "f" * 32, "0000" + "1" * 12,
    ]
    assert values(spark, ["0" * 16, "000000000abcdef1", "1234567890abcdef"], ids.span_label(x)) == [
        "0" * 8, "0abcdef1".replace("0abcdef1", "abcdef1".rjust(8, "0")), "1234567890abcdef",
    ]
    assert values(spark, [None, "", "000", "01"], ids.is_valid_id(x)) == [False, False, False, True]


def test_server_timing(spark):
    header = ids.server_timing(F.col("x"), F.lit("2"))
    assert values(spark, ["1", "0", None], header) == [
        'traceparent;desc="00-00000000000000000000000000000001-0000000000000002-01"', None, None,
    ]


@pytest.mark.parametrize(("probability", "volume"), [(1.0, "highest"), (0.0, "off")])
def test_volume_is_certain_at_the_ends(spark, probability, volume):
    traces = ["0" * 31 + "1", "f" * 32, "8" * 32]
    assert values(spark, traces, sampling.trace_volume(F.lit(None), F.col("x"), probability)) == [volume] * 3
    assert values(spark, ["0" * 32], sampling.trace_volume(F.lit(None), F.col("x"), probability)) == [volume]


def test_volume_keeps_known_decisions(spark):
    kept = sampling.trace_volume(F.col("x"), F.lit("f" * 32), 0.0)
    assert values(spark, ["highest", "off", "invalid", None], kept) == ["highest", "off", "off", "off"]


def test_volume_is_the_same_for_a_trace_and_near_its_share(spark):
    traces = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("x"))
    chosen = traces.select("x", sampling.ratio_selected(F.col("x"), 0.3).alias("y"))
    assert chosen.subtract(chosen).count() == 0
    share = chosen.agg(F.avg(F.col("y").cast("double"))).first()[0]
    assert abs(share - 0.3) < 0.02
    smaller = traces.filter(sampling.ratio_selected(F.col("x"), 0.1))
    assert smaller.filter(~sampling.ratio_selected(F.col("x"), 0.3)).count() == 0


@pytest.mark.parametrize(
    ("text", "name", "version", "stability"),
    [
        ("core-api==1.2.3", "core-api", "1.2.3", "stable"),
        ("gizmo>=3.1,<5", "gizmo", ">=3.1,<5", "stable"),
        (" a_b.c ~= 1.0 ; python_version < '3.9'", "a_b.c", "~=1.0", "stable"),
        ("pkg[x]==0.62b0", "pkg", "[x]==0.62b0", "experimental"),
        ("pkg==7.3rc1", "pkg", "7.3rc1", "experimental"),
        ("pkg==7.3.DEV", "pkg", "7.3.DEV", "experimental"),
        ("pkg==1.41.0", "pkg", "1.41.0", "stable"),
        ("pkg", "pkg", "", "stable"),
        ("???", None, None, "stable"),
    ],
)
def test_requirements(spark, text, name, version, stability):
    row = inventory.parse_requirements(spark.createDataFrame([(text,)], "requirement string")).first()
    assert (row["name"], row.version, row.stability) == (name, version, stability)


def test_first_source_rule_wins(spark):
    rules = [("exact", "a-b", "1"), ("prefix", "a-", "2/{name}"), ("prefix", "a", "3")]
    assert values(spark, ["a-b", "a-c", "ab", "c"], requirements.source_link(F.col("x"), rules)) == ["1", "2/a-c", "3", None]


def test_instrumentations(spark):
    rows = [
        ("i-flask", "Flask", ["flask >= 1.0"], None, {"flask": "x"}),
        ("i-boto", "Boto", [], ["botocore ~= 1.0", "aiobotocore ~= 2.0"], {"botocore": "x", "aiobotocore": "y"}),
        ("i-own", None, None, None, {"own": "x"}),
        ("i-none", "", ["a"], None, {}),
    ]
    df = spark.createDataFrame(
        rows, "name string, description string, instruments array<string>, instruments_any array<string>, "
        "entry_points map<string,string>",
    )
    got = [(r.keys, r.component, r.supported_versions, r.support) for r in inventory.catalogue(df, ["i-own"]).collect()]
    assert got == [
        ("aiobotocore,botocore", "botocore", "botocore ~= 1.0", "community"),
        ("aiobotocore,botocore", "aiobotocore", "aiobotocore ~= 2.0", "community"),
        ("flask", "flask", "flask >= 1.0", "community"),
        ("own", "i-own", None, "supported"),
    ]


def test_limits(spark):
    df = spark.createDataFrame([(["a", "b", "c"], {"k": "wörld", "n": None})], "l array<string>, m map<string,string>")
    links = [limits.limit_links(F.col("l"), n) for n in (2, "2", "", None, "9")]
    assert [len(v) for v in df.select(*links).first()] == [2, 2, 3, 3, 3]
    assert df.select(limits.limit_values(F.col("m"), 2)).first()[0] == {"k": "wö", "n": None}
    assert df.select(limits.limit_values(F.col("m"), "")).first()[0] == {"k": "wörld", "n": None}


def test_routes_send_every_record_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "deps"), (2, "app"), (3, None)], "id int, scope string")
    logs.write_routes(df, str(tmp_path / "out"), {"deps": "reports"})
    got = {r.id: r.route for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "reports", 2: "default", 3: "default"}


def test_metric_presence(spark):
    df = spark.createDataFrame([("a", "m1"), ("a", "m2"), ("b", "m2")], "service string, metric string")
    got = {(r.service, r.metric): r.present for r in logs.metric_presence(df, ["m1", "m2"]).collect()}
    assert got == {("a", "m1"): True, ("a", "m2"): True, ("b", "m1"): False, ("b", "m2"): True}


FRAGMENTS = (
    "id string, fragment_index int, max_fragments int, is_done boolean, "
    "packages array<struct<name:string,version:string>>"
)


def test_reports(spark):
    rows = [
        ("a", 1, 2, True, [("Y", "1")]), ("a", 0, 2, False, [("X", "1"), ("x", "2")]), ("a", 0, 2, False, [("X", "1"), ("x", "2")]),
        ("b", 0, 2, False, [("Z", "1")]), ("c", 0, 2, False, []), ("c", 1, 2, False, []),
    ]
    df = spark.createDataFrame(rows, FRAGMENTS)
    got = {r.id: (r.fragments, r.packages, r.complete) for r in reports.completeness(df).collect()}
    assert got == {"a": (2, 3, True), "b": (1, 1, False), "c": (2, 0, False)}
    whole = reports.reassemble(df).orderBy("id", "fragment_index", "position").collect()
    assert [(r.id, r["name"]) for r in whole] == [("a", "X"), ("a", "x"), ("a", "Y")]
    assert sorted(r["name"] for r in reports.package_names(df).collect()) == ["x", "y", "z"]


def test_report_bodies(spark):
    rows = [("a", 0, 1, True, [("é", "1")]), ("", 0, 1, True, []), ("d", -1, 1, True, []), ("e", 0, 1, None, [])]
    encoded = report_log.encode(spark.createDataFrame(rows, FRAGMENTS))
    found = report_log.decode(encoded).withColumn("valid", reports.is_valid())
    assert {r.id: r.valid for r in found.collect()} == {"a": True, "": False, "d": False, "e": False}
    assert found.filter("id = 'a'").first().packages[0]["name"] == "é"
    import base64

    odd = [("not base64!",), (base64.b64encode(b"plain").decode(),), (base64.b64encode(gzip.compress(b"{")).decode(),), (None,)]
    broken = report_log.decode(spark.createDataFrame(odd, "body string")).withColumn("valid", reports.is_valid())
    assert [r.valid for r in broken.collect()] == [False] * 4
