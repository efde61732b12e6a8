"""Stack samples as dictionary-encoded profiles, in relational form.

A profile holds the samples of one process and one tick, in time order. A tick of many samples
is cut into parts of at most `PART_SAMPLES`, each a self-contained profile, so that no record, no
window and no task grows with the tick. Strings, functions and locations are numbered in the
order in which they are first seen, walking the samples of a part in order and each stack from
its leaf. All tables share the key (service, instance, source, tick_ts, part).

Stacks travel as text (`functions.stacks`), and a part's dictionaries are numbered where its samples lie
together (`operators.numbering`), so that frames are never shuffled or grouped one by one.

Numbering has no window over a whole tick. Samples are sorted by range, which splits a tick that
holds most of them over many tasks; every task numbers its own run of samples, and a prefix sum
over the sizes of a tick's runs (one row for each run) gives the number at which a run starts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackweave import session
from stackweave.functions import clock, ids, stacks as stack_text
from stackweave.operators import numbering

TICK = ["service", "instance", "source", "tick_ts"]
KEY = [*TICK, "part"]
PART_SAMPLES = 20_000

# Sample label keys, in the order of their string-table entries 0 to 4.
LABEL_TIME = "source.event.time"
LABEL_TRACE = "trace_id"
LABEL_SPAN = "span_id"
LABEL_THREAD = "thread.id"
LABEL_PERIOD = "source.event.period"
RESERVED = (LABEL_TIME, LABEL_TRACE, LABEL_SPAN, LABEL_THREAD, LABEL_PERIOD)

# Attributes of a profile log record, its scope, and the default periods.
SCOPE = "profiling"
FORMAT = "pprof-gzip-base64"
DATA_TYPE = "cpu"
CONTINUOUS = "continuous"
SNAPSHOT = "snapshot"
PERIOD_MILLIS = {CONTINUOUS: 1000, SNAPSHOT: 10}


def in_ticks(
    samples: DataFrame,
    source: str = CONTINUOUS,
    period: str = "1 second",
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Give every sample the tick, and so the profile, it belongs to.

    `keep` is the caller's own filter over samples with context. Ticks left without samples
    yield no profile.
    """
    kept = samples.transform(keep) if keep else samples
    if "instance" not in kept.columns:
        kept = kept.withColumn("instance", F.lit(""))
    return kept.withColumn("source", F.lit(source)).withColumn("tick_ts", F.window("ts", period).start)


def ticks(ticked: DataFrame) -> DataFrame:
    return ticked.groupBy(*TICK).agg(F.count("*").alias("samples"))


def records(numbered: DataFrame) -> DataFrame:
    """The log record of every profile, without its body, from samples with their frames or `depth`."""
    depth = F.col("depth") if "depth" in numbered.columns else F.size("frames").cast("long")
    counted = numbered.groupBy(*KEY).agg(F.sum(depth).alias("total_frames"), F.count("*").alias("samples"))
    return with_attributes(counted)


def with_attributes(counted: DataFrame) -> DataFrame:
    """What every record says about itself."""
    return (
        counted.withColumn("timestamp_ns", clock.nanos(F.col("tick_ts")))
        .withColumn("scope", F.lit(SCOPE))
        .withColumn(
            "attributes",
            F.create_map(
                F.lit("profiling.data.format"), F.lit(FORMAT),
                F.lit("profiling.data.type"), F.lit(DATA_TYPE),
                F.lit("sourcetype"), F.lit(SCOPE),
                F.lit("profiling.data.total.frame.count"), F.col("total_frames").cast("string"),
                F.lit("profiling.instrumentation.source"), F.col("source"),
            ),
        )
    )


def number_samples(ticked: DataFrame, part_samples: int = PART_SAMPLES) -> DataFrame:
    """Order the samples of a tick, whatever order they arrived in, and cut it into parts.

    Adds `part` and `sample`, the place within the part from 1. The sorted samples are written to
    the shared folder: the ranges are drawn once, and all that follows reads them again. So are the
    starts of the runs, whose size Spark then knows before it joins them: few are broadcast, and the
    samples need no shuffle for them. Frames come out as they go in, as text or as frames.
    """
    order = [*TICK, "ts", "tid", "sample_id"]
    ranged = stack_text.packed(ticked).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the task's number above its 33rd bit and a place in the task below.
    laid = session.written(ranged.withColumn("_at", F.monotonically_increasing_id()), "profile-samples")
    laid = laid.withColumn("_run", F.shiftright("_at", 33))
    runs = laid.groupBy(*TICK, "_run").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    earlier = Window.partitionBy(*TICK).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(*TICK, "_run", (F.col("_first") - F.coalesce(F.sum("_size").over(earlier), F.lit(0))).alias("_start"))
    place = F.col("_at") - F.col("_start")
    numbered = (
        laid.join(session.written(starts, "profile-runs"), [*TICK, "_run"])
        .withColumns({"part": F.floor(place / part_samples).cast("int"), "sample": (place % part_samples + 1).cast("int")})
        .drop("_at", "_run", "_start")
    )
    if "frames" not in ticked.columns or stack_text.is_packed(ticked):
        return numbered
    return stack_text.unpacked(numbered, ticked.schema["frames"].dataType.simpleString())


def together(numbered: DataFrame) -> DataFrame:
    """All samples of a part in one task, so that what is grouped by it needs no further shuffle."""
    return numbered.repartition(*KEY)


def in_parts(numbered: DataFrame, ranged: bool = False) -> DataFrame:
    """Samples part by part and in order, for `numbering`, which reads frames and packed stacks alike.

    With `ranged`, a task holds neighbouring parts, so that what is made of them can be written by
    process and time without another shuffle. A part is whole in either case."""
    spread = numbered.repartitionByRange(*KEY) if ranged else together(numbered)
    return spread.sortWithinPartitions(*KEY, "sample")


def frames(numbered: DataFrame) -> DataFrame:
    """One row per frame, leaf first."""
    return stack_text.unpacked(numbered).select(
        *KEY, "sample", F.posexplode(F.reverse("frames")).alias("pos", "_frame")
    ).select(*KEY, "sample", "pos", "_frame.file", "_frame.func", "_frame.line")


def shown_line(line: Column) -> Column:
    """A missing line number, or zero, is written as -1."""
    return F.when(line.isNull() | (line == 0), F.lit(-1)).otherwise(line).cast("long")


def _types(df: DataFrame, *columns: str) -> str:
    return ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in columns)


def first_seen(numbered: DataFrame, with_strings: bool = True) -> DataFrame:
    """The dictionaries of every profile, one row a part: its distinct functions, locations and strings
    as lists, each in the order in which they are first met. Strings may be left out."""
    labels = [ids.trace_label(F.col("trace_id")).alias("trace"), ids.span_label(F.col("span_id")).alias("span")]
    rows = in_parts(numbered.select(*KEY, "sample", *(labels if with_strings else ()), "frames"))
    line = re.search(r"line:(\w+)", stack_text.kind_of(rows))[1]
    pair = "file:string,func:string"
    schema = (
        f"{_types(rows, *KEY)}, functions array<struct<{pair}>>, locations array<struct<{pair},line:{line}>>, "
        "strings array<struct<token:string,in_labels:boolean>>"
    )
    return rows.mapInArrow(numbering.dictionaries(KEY, RESERVED, with_strings, line), schema)


def _listed(seen: DataFrame, column: str, base: int, number: str) -> DataFrame:
    """The entries of a dictionary as rows, numbered from `base`."""
    listed = seen.select(*KEY, F.posexplode(column).alias("_pos", "_entry"))
    return listed.select(*KEY, (F.col("_pos") + base).cast("long").alias(number), "_entry.*")


def strings(numbered: DataFrame, seen: DataFrame) -> DataFrame:
    """String table of every profile. The reserved strings come first, then labels before the frames of
    their sample, and a function's name before its file. `in_labels` tells which strings a label may
    use. `seen` must have been made from `numbered`, with strings."""
    return _listed(seen, "strings", 0, "string_id")


def functions(seen: DataFrame) -> DataFrame:
    return _listed(seen, "functions", 1, "function_id")


def locations(seen: DataFrame) -> DataFrame:
    """Distinct (file, function, line). A missing line and line zero stay two locations,
    although both show -1."""
    return _listed(seen, "locations", 1, "location_id").select(
        *KEY, "location_id", "file", "func", F.col("line").alias("raw_line"), shown_line(F.col("line")).alias("line")
    )


def _located(numbered: DataFrame, *columns: str) -> DataFrame:
    rows = in_parts(numbered.select(*KEY, "sample", *columns, "frames"))
    kept = [*KEY, "sample", *columns]
    return rows.mapInArrow(numbering.located(kept), f"{_types(rows, *kept)}, location_ids array<bigint>")


def stacks(numbered: DataFrame) -> DataFrame:
    """The location numbers of every sample, leaf first."""
    return _located(numbered)


def samples(numbered: DataFrame) -> DataFrame:
    """Samples of every profile: thread, context and stack."""
    return _located(numbered, "sample_id", "tid", "trace_id", "span_id")


def _label(key: str, text: Column | None = None, num: Column | None = None) -> Column:
    return F.struct(
        F.lit(RESERVED.index(key)).cast("long").alias("key_id"),
        (F.lit(None) if text is None else text).cast("string").alias("token"),
        (F.lit(None) if num is None else num).cast("long").alias("num"),
    )


def labels(numbered: DataFrame, strings_of: DataFrame, period_millis: int) -> DataFrame:
    """Labels of every sample as (key index, string index or number).

    All samples of a tick carry the tick's time. Only the two context labels name strings, so only
    these are joined, with the few strings that labels use.
    """
    numbers = F.array(
        _label(LABEL_TIME, num=clock.millis(F.col("tick_ts"))),
        _label(LABEL_PERIOD, num=F.lit(period_millis)),
        _label(LABEL_THREAD, num=F.col("tid")),
    )
    texts = F.array(
        _label(LABEL_TRACE, text=ids.trace_label(F.col("trace_id"))), _label(LABEL_SPAN, text=ids.span_label(F.col("span_id")))
    )
    none = F.lit(None).cast("long")
    plain = numbered.select(*KEY, "sample", F.posexplode(numbers).alias("ord", "_label")).select(
        *KEY, "sample", "ord", "_label.key_id", none.alias("string_id"), "_label.num"
    )
    named = numbered.select(*KEY, "sample", F.posexplode(texts).alias("ord", "_label")).where("_label.token is not null")
    used = strings_of.where("in_labels").select(*KEY, "token", "string_id")
    joined = named.select(*KEY, "sample", (F.col("ord") + 3).alias("ord"), "_label.key_id", "_label.token").join(used, [*KEY, "token"])
    return plain.where("num is not null").unionByName(
        joined.select(*KEY, "sample", "ord", "key_id", "string_id", none.alias("num"))
    )


def resolve_labels(encoded: DataFrame, strings_of: DataFrame) -> DataFrame:
    """Labels as text again. The keys are the reserved entries, which every table starts with."""
    key = F.element_at(F.array(*map(F.lit, RESERVED)), F.col("key_id").cast("int") + 1)
    used = strings_of.where("in_labels").select(*KEY, "string_id", F.col("token").alias("text"))
    with_key = encoded.withColumn("key", key)
    none = F.lit(None).cast("string")
    numbers = with_key.where("string_id is null").select(*KEY, "sample", "key", none.alias("text"), "num")
    texts = with_key.where("string_id is not null").join(used, [*KEY, "string_id"]).select(*KEY, "sample", "key", "text", "num")
    return numbers.unionByName(texts)
