import pytest
from pyspark.sql import functions as F

from stackweave.functions import stacks
from stackweave.operators import profiles
from stackweave.plans import catalog

ROWS = [
    (1, [("a/b", 'say "x"\u0000\u0001\u0002', 4), (None, "é\n,[]", None), ("", "", 0)]),
    (2, []), (3, None), (4, [("null", "null", -1)] * 3), (5, [(None, None, None)]),
]


@pytest.mark.parametrize("line", ["int", "bigint"])
def test_packed_stacks_come_back_as_they_were(spark, line):
    kind = f"array<struct<file:string,func:string,line:{line}>>"
    df = spark.createDataFrame(ROWS, f"id int, frames {kind}")
    packed = stacks.packed(df)
    assert packed.schema["frames"].dataType.simpleString() == "string"
    back = stacks.unpacked(packed, kind)
    assert back.schema["frames"].dataType.simpleString() == kind
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert stacks.unpacked(df) is df and stacks.packed(packed) is packed
    assert stacks.packed(df.drop("frames")).columns == ["id"]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stacks_are_text_where_samples_are_put_in_order(spark, small):
    assert catalog.traced(spark, small).schema["frames"].dataType.simpleString() == "string"
    assert "frames" not in plan_of(catalog.traced(spark, small, catalog.deep_samples)).split("Window")[0]
    numbered = catalog.numbered(spark, small)
    assert numbered.schema["frames"].dataType.simpleString() == "string"
    assert spark.read.parquet(*numbered.inputFiles()).count() > 0


def test_dictionaries_are_neither_grouped_nor_sorted_frame_by_frame(spark, small):
    base = profiles.together(catalog.numbered(spark, small))
    seen = profiles.first_seen(base)
    for found in (profiles.strings(base, seen), profiles.functions(seen), profiles.locations(seen), profiles.samples(base)):
        plan = plan_of(found)
        above = plan[: plan.index("MapInArrow")]
        assert "Aggregate" not in above and "Window" not in above and "Sort" not in above
        assert "Aggregate" not in plan and "Window" not in plan


def test_missing_names_are_strings_of_their_own(spark):
    rows = [("a", "", "continuous", 1, 0, 1, 7, None, None, [(None, "", 1), ("", None, None)])]
    schema = f"service string, instance string, source string, tick_ts int, part int, sample int, tid bigint, trace_id string, span_id string, frames {stacks.FRAMES}"
    base = spark.createDataFrame(rows, schema)
    seen = profiles.first_seen(base)
    found = profiles.strings(base, seen).where("not in_labels").orderBy("string_id").select("string_id", "token").collect()
    assert [tuple(r) for r in found] == [(5, None), (6, "")]
    assert [(r.file, r.func) for r in profiles.functions(seen).orderBy("function_id").collect()] == [("", None), (None, "")]


def test_landed_samples_are_compressed(spark, small, monkeypatch, tmp_path):
    monkeypatch.setattr(catalog.session, "new_folder", lambda _, label: str(tmp_path / label))
    monkeypatch.setattr(catalog, "LANDED_SAMPLES", 7)
    count = catalog.QUERIES["landed_frames"](spark, small).count()
    files = [p.name for p in (tmp_path / "landed-samples").glob("part-*")]
    assert count > 0 and len(files) > 3 and all(name.endswith(".json.gz") for name in files)
    lines = spark.read.json(str(tmp_path / "landed-samples"))
    assert lines.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 7


def test_packed_stacks_take_less_than_half_of_their_json(spark):
    words = [(f"source/{k % 3}", f"word{k * 7919 % 1000}", k % 9) for k in range(400)]
    df = spark.createDataFrame([(words,)], f"frames {stacks.FRAMES}")
    packed, told = stacks.packed(df).first()[0], df.select(F.to_json("frames")).first()[0]
    assert len(packed) < len(told) / 6 and packed.isascii()


def test_small_parts_are_numbered_together_and_apart(spark):
    """Many parts of one sample in one walk: each has numbers of its own, from 1."""
    rows = [("a", "", "continuous", tick, 0, 1, 7, None, None, [("f", "g", 1), ("f", f"h{tick % 2}", None)]) for tick in range(600)]
    schema = f"service string, instance string, source string, tick_ts int, part int, sample int, tid bigint, trace_id string, span_id string, frames {stacks.FRAMES}"
    base = stacks.packed(spark.createDataFrame(rows, schema)).coalesce(1)
    seen = profiles.first_seen(base)
    assert {tuple(r) for r in profiles.functions(seen).groupBy("tick_ts").agg(F.min("function_id"), F.max("function_id")).collect()} == {(t, 1, 2) for t in range(600)}
    found = {(r.tick_ts, r.location_id, r.func, r.raw_line) for r in profiles.locations(seen).collect()}
    assert found == {x for t in range(600) for x in ((t, 1, f"h{t % 2}", None), (t, 2, "g", 1))}
    assert {tuple(r.location_ids) for r in profiles.stacks(base).collect()} == {(1, 2)}
    assert {r.string_id for r in profiles.strings(base, seen).where("token = 'f'").collect()} == {6}
