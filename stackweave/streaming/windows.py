"""Event-time windows over samples and spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.functions import clock
from stackweave.operators.context import PROCESS, present
from stackweave.operators.spans import LINGER_SECONDS


def activity(
    starts: DataFrame, linger_seconds: int = LINGER_SECONDS, delay: str = "10 minutes"
) -> DataFrame:
    """Intervals in which the profiler of a process runs, from points of activity: each
    keeps it running for the linger, and the next one in time prolongs that."""
    process = present(PROCESS, starts)
    return (
        starts.select(*process, F.col("start_ts").cast("timestamp").alias("start_ts"))
        .withWatermark("start_ts", delay)
        .groupBy(*process, F.session_window("start_ts", f"{linger_seconds} seconds").alias("_w"))
        .agg(F.count("*").alias("starts"))
        .select(*process, "_w.start", "_w.end", "starts")
        .withColumnsRenamed({"start": "start_ts", "end": "end_ts"})
    )


NEVER = "9999-12-31"


def active_intervals(
    spans: DataFrame, linger_seconds: int = LINGER_SECONDS, delay: str = "10 minutes"
) -> DataFrame:
    """When the snapshot profiler of a process runs, from selected spans: sessions whose gap is a
    span's own duration and the linger.

    Spans of a session are merged in the state store, so it keeps a row for each session, not for
    each span. A session with a span that never ends stays open; it is given, without an end, once
    the watermark has passed all times.
    """
    process = present(PROCESS, spans)
    start, never = F.col("start_ts").cast("timestamp"), F.lit(NEVER).cast("timestamp")
    end = F.greatest(start, F.col("end_ts").cast("timestamp")) + F.make_dt_interval(secs=F.lit(linger_seconds))
    # Sessions that touch are one, so each ends a moment later than it is told.
    micros = clock.micros(F.when(F.col("end_ts").isNull(), never).otherwise(end)) - clock.micros(start) + 1
    gap = F.make_interval(secs=(micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))
    told = F.timestamp_micros(clock.micros(F.col("_w.end")) - 1)
    return (
        spans.select(*process, start.alias("start_ts"), gap.alias("_gap"))
        .withWatermark("start_ts", delay)
        .groupBy(*process, F.session_window("start_ts", F.col("_gap")).alias("_w"))
        .agg(F.count("*").alias("spans"))
        .select(*process, F.col("_w.start").alias("start_ts"), F.when(told < never, told).alias("end_ts"), "spans")
    )


def ticks(
    samples: DataFrame, source: str, period: str = "1 second", delay: str = "10 minutes"
) -> DataFrame:
    """Samples per process and tick, emitted once the watermark has passed the tick."""
    process = present(PROCESS, samples)
    return (
        samples.select(*process, F.col("ts").cast("timestamp").alias("ts"))
        .withWatermark("ts", delay)
        .groupBy(*process, F.window("ts", period).alias("_w"))
        .agg(F.count("*").alias("samples"))
        .select(*process, F.lit(source).alias("source"), F.col("_w.start").alias("tick_ts"), "samples")
    )
