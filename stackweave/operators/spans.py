"""Spans over time: entry spans, selection, open counts and active intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackweave.functions import clock, ids, sampling
from stackweave.operators.context import PROCESS, present

SLICE_SECONDS = 300
LINGER_SECONDS = 60
SELECTION_ATTRIBUTE = "snapshot.profiling"


def is_entry() -> Column:
    """A span that starts work in its process: no parent, or a parent elsewhere."""
    return ~ids.is_valid_id(F.col("parent_span_id")) | F.coalesce(
        F.col("parent_is_remote"), F.lit(False)
    )


def resolve_parents(spans: DataFrame) -> DataFrame:
    """Work out `parent_is_remote` where exporters did not store it.

    The parent is remote when it ran in another service, or was not exported at all. A parent
    that was exported more than once counts once.
    """
    parents = spans.groupBy("trace_id", F.col("span_id").alias("parent_span_id")).agg(
        F.min("service").alias("_parent_service")
    )
    return (
        spans.drop("parent_is_remote")
        .join(parents, ["trace_id", "parent_span_id"], "left")
        .withColumn(
            "parent_is_remote",
            ids.is_valid_id(F.col("parent_span_id"))
            & ~F.col("_parent_service").eqNullSafe(F.col("service")),
        )
        .drop("_parent_service")
    )


def entry_spans(spans: DataFrame) -> DataFrame:
    return spans.filter(is_entry())


def select_spans(spans: DataFrame) -> DataFrame:
    """Entry spans of traces with the `highest` volume, marked by an attribute.

    A missing decision is not the same as a negative one, but both leave the span alone.
    """
    mark = F.create_map(F.lit(SELECTION_ATTRIBUTE), F.lit("true"))
    kept = F.map_filter(F.col("attributes"), lambda key, _: key != SELECTION_ATTRIBUTE)
    return (
        entry_spans(spans)
        .filter(F.col("volume") == sampling.SELECTED)
        .withColumn("attributes", F.coalesce(F.map_concat(kept, mark), mark))
    )


def _end() -> Column:
    """When a span ends: not before its start, and null while it is open."""
    return F.when(F.col("end_ts").isNotNull(), F.greatest("start_ts", "end_ts"))


def _edges(spans: DataFrame, keys: Sequence[str], *extra: str) -> DataFrame:
    """One row where a span opens and one where it closes."""
    moments = F.array(
        F.struct(F.col("start_ts").alias("ts"), F.lit(1).cast("long").alias("delta")),
        F.struct(_end().alias("ts"), F.lit(-1).cast("long").alias("delta")),
    )
    return spans.select(*keys, *extra, F.inline(moments)).filter(F.col("ts").isNotNull())


def open_span_counts(
    spans: DataFrame, keys: Sequence[str] = PROCESS, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Number of open spans after every start and end; zero means the process went idle.

    A process may own most of the spans, so the running sum is taken per time slice and
    starts from the sum of all earlier slices.
    """
    keys = present(keys, spans)
    edges = _edges(spans, keys, "span_id").withColumn(
        "_slice", clock.slice_of(F.col("ts"), slice_seconds)
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        edges.groupBy(*keys, "_slice")
        .agg(F.sum("delta").alias("delta"))
        .withColumn("delta", F.sum("delta").over(before))
        .filter(F.col("delta").isNotNull())
        .withColumn("_edge", F.lit(False))
    )
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_edge", "ts", F.desc("delta"), "span_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        edges.withColumn("_edge", F.lit(True))
        .unionByName(opening, allowMissingColumns=True)
        .withColumn("open", F.sum("delta").over(so_far))
        .filter("_edge")
        .select(*keys, "span_id", "ts", "delta", "open")
    )


def keep_tracked(
    samples: DataFrame,
    tracked: DataFrame,
    keys: Sequence[str] = (*PROCESS, "trace_id"),
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Samples whose trace has a tracked span open in that process at that moment.

    Spans count from their start up to, not including, their end; one that does not end after
    its start counts at no moment, and one that never ended stays open. Samples and span edges
    are put in time order per trace and slice, and a running count decides. A slice starts from
    the sum over all earlier slices, which is one row for each slice that has samples. So a
    long trace is spread over its slices, a span costs two rows however long it lasts, and the
    work stays proportional to the rows however many spans a trace has.
    """
    keys = present(keys, samples, tracked)
    at = clock.micros(F.col("ts")).alias("_at")
    slot = clock.slice_of(F.col("ts"), slice_seconds).alias("_slice")
    lasting = tracked.filter(F.col("end_ts").isNull() | (F.col("end_ts") > F.col("start_ts")))
    changes = (
        _edges(lasting, keys).select(*keys, slot, at, "delta")
        .groupBy(*keys, "_slice", "_at")
        .agg(F.sum("delta").alias("_delta"))
    )
    kept = samples.filter(F.col("trace_id").isNotNull())
    used = kept.select(*keys, slot).distinct().withColumn("_used", F.lit(True))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    opening = (
        changes.groupBy(*keys, "_slice")
        .agg(F.sum("_delta").alias("_delta"))
        .withColumn("_used", F.lit(False))
        .unionByName(used, allowMissingColumns=True)
        .withColumn("_delta", F.sum("_delta").over(earlier))
        .filter(F.col("_used") & (F.col("_delta") != 0))
        .select(*keys, "_slice", F.col("_slice").alias("_at"), "_delta")
    )
    rows = kept.select("*", slot, at, F.lit(True).alias("_sample")).unionByName(
        changes.unionByName(opening).withColumn("_sample", F.lit(False)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_at", "_sample")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_open", F.sum("_delta").over(so_far))
        .filter(F.col("_sample") & (F.col("_open") > 0))
        .select(*samples.columns)
    )


def _merge(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    in_order = Window.partitionBy(*keys).orderBy("start_ts", "end_ts")
    latest_end = F.max("end_ts").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        intervals.withColumn(
            "_gap", F.when(latest_end.isNull() | (F.col("start_ts") > latest_end), 1).otherwise(0)
        )
        .withColumn("_run", F.sum("_gap").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_run")
        .agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))
        .drop("_run")
    )


def active_intervals(
    spans: DataFrame,
    keys: Sequence[str] = PROCESS,
    linger_seconds: int = LINGER_SECONDS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """When the snapshot profiler of a process runs: while a selected span is open, and a
    while longer unless the next one starts in time.

    Spans are merged within their start slice first. Every merged interval outlasts the
    linger, so a slice keeps at most slice / linger + 1 of them, and the second merge per
    process is small whatever the number of spans. An interval with a span that never ended
    has no end.
    """
    keys = present(keys, spans)
    never = F.lit("9999-12-31").cast(spans.schema["end_ts"].dataType)
    lingering = spans.select(
        *keys,
        "start_ts",
        F.coalesce(_end() + F.make_dt_interval(secs=F.lit(linger_seconds)), never).alias("end_ts"),
    )
    sliced = lingering.withColumn("_slice", clock.slice_of(F.col("start_ts"), slice_seconds))
    return _merge(_merge(sliced, [*keys, "_slice"]).drop("_slice"), keys).select(
        *keys, "start_ts", F.when(F.col("end_ts") < never, F.col("end_ts")).alias("end_ts")
    )


def span_counts(spans: DataFrame) -> DataFrame:
    return spans.groupBy("service").agg(F.count("*").alias("spans"))
