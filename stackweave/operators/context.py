"""Which trace and span a thread was working on when its stack was sampled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stackweave.functions import clock

PROCESS = ("service", "instance")
THREAD = (*PROCESS, "tid")
SLICE_SECONDS = 300


def present(keys: Sequence[str], *tables: DataFrame) -> list[str]:
    """The keys that all tables have: telemetry of a service that runs once may name no instance."""
    return [key for key in keys if all(key in table.columns for table in tables)]


def context_changes(events: DataFrame) -> DataFrame:
    """Reduce attach and detach events to the moments where a thread's state changes.

    Attaching a context without a span changes nothing. Detaching restores the previous
    span, or clears the state when there was none.
    """
    return events.filter(
        (F.col("kind") == "detach") | ((F.col("kind") == "attach") & F.col("trace_id").isNotNull())
    ).select(*present(THREAD, events), "ts", "seq", "trace_id", "span_id")


def exclude_sampler_thread(samples: DataFrame) -> DataFrame:
    """Drop stacks of the thread that takes the samples."""
    return samples.filter(F.col("tid") != F.col("sampler_tid")).drop("sampler_tid")


def attach_context(
    samples: DataFrame,
    changes: DataFrame,
    keys: Sequence[str] = THREAD,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """As-of join: every sample takes the latest change of its thread at or before it.

    Time is cut into slices, so that a busy thread is spread over many tasks. What a slice
    needs to know of the past is one row per thread and slice, found from the slices' last
    changes; it enters the slice as its first row. Samples cross the network once, and no
    pair of rows is ever formed. A change at the instant of a sample counts as before it.
    """
    keys = present(keys, samples, changes)
    at = clock.micros(F.col("ts")).alias("_at")
    slot = clock.slice_of(F.col("ts"), slice_seconds).alias("_slice")

    moves = changes.select(
        *keys, slot, at, F.struct(at, "seq", "trace_id", "span_id").alias("_state")
    )
    used = samples.select(*keys, slot).distinct()
    last = moves.groupBy(*keys, "_slice").agg(F.max("_state").alias("_state"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        last.withColumn("_used", F.lit(False))
        .unionByName(used.withColumn("_used", F.lit(True)), allowMissingColumns=True)
        .withColumn("_state", F.max("_state").over(earlier))
        .filter(F.col("_used") & F.col("_state").isNotNull())
        .select(*keys, "_slice", F.col("_slice").alias("_at"), "_state")
    )

    known = carried.unionByName(moves).withColumn("_sample", F.lit(False))
    rows = samples.select("*", slot, at, F.lit(True).alias("_sample")).unionByName(
        known, allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_at", "_sample")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_state", F.max("_state").over(so_far))
        .filter("_sample")
        .select(*samples.columns, F.col("_state.trace_id"), F.col("_state.span_id"))
    )
