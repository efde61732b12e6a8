"""Profile records built and decoded as streams.

The samples of a process and a tick wait in the state store until the watermark has passed the
tick; then the tick's records are numbered and encoded at once, and its state is gone. Stacks wait as
text (`functions.stacks`). What waits is bounded by a tick and the delay. A process with very many threads is spread by `parts`: each
part of a tick holds some of the threads, has state of its own and gives records of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave import session
from stackweave.functions import clock, ids, stacks
from stackweave.operators import profiles
from stackweave.sources import profile_log


def _closed_ticks(samples: DataFrame, source: str, period: str, delay: str, parts: int) -> DataFrame:
    """One row for each part of a tick that the watermark has passed, with its samples."""
    instance = F.coalesce("instance", F.lit("")) if "instance" in samples.columns else F.lit("")
    waiting = samples.select(
        "service", instance.alias("instance"), F.col("ts").cast("timestamp").alias("ts"),
        F.pmod(F.xxhash64("tid"), F.lit(parts)).cast("int").alias("part"),
        F.struct(
            clock.micros(F.col("ts")).alias("at"), F.col("tid").cast("long").alias("tid"), F.col("sample_id").cast("long").alias("sample_id"),
            ids.trace_label(F.col("trace_id")).alias("trace"), ids.span_label(F.col("span_id")).alias("span"), "frames",
        ).alias("_sample"),
    )
    return (
        waiting.withWatermark("ts", delay)
        .groupBy("service", "instance", "part", F.window("ts", period).alias("_tick"))
        .agg(F.collect_list("_sample").alias("samples"))
        .select("service", "instance", F.lit(source).alias("source"), F.col("_tick.start").alias("tick_ts"), "part", "samples")
    )


def _encode(period_ms: int, part_samples: int):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.slice(i, 1).select(profiles.TICK)
                rows = batch.column("samples")[i].values
                columns = {name: rows.field(name) for name in rows.type.names}
                columns["frames"] = stacks.frames_of(columns["frames"])
                table = pa.table(columns).sort_by([(name, "ascending") for name in ("at", "tid", "sample_id")])
                time_ms = key.column("tick_ts").cast(pa.int64())[0].as_py() // 1000
                for piece, start in enumerate(range(0, table.num_rows, part_samples)):
                    held = table.slice(start, part_samples).combine_chunks()
                    count = held.num_rows
                    for name, value in (("time_ms", time_ms), ("period_ms", period_ms)):
                        held = held.append_column(name, pa.array([value] * count, pa.int64()))
                    body, frames = profile_log.to_body(held)
                    # Threads' parts and pieces of them are told apart by one number.
                    part = batch.column("part")[i].as_py() + (piece << 16)
                    columns = [*key.columns, pa.array([part], pa.int32()), pa.array([frames]), pa.array([count]), pa.array([body])]
                    yield pa.RecordBatch.from_arrays(columns, [*profiles.KEY, "total_frames", "samples", "body"])

    return encode


def records(
    samples: DataFrame, source: str = profiles.CONTINUOUS, period: str = "1 second", delay: str = "10 minutes",
    parts: int = 1, part_samples: int = profiles.PART_SAMPLES,
) -> DataFrame:
    """Samples with their context, as a stream, to complete profile log records."""
    session.prepare(samples.sparkSession, streaming=True)
    closed = _closed_ticks(stacks.packed(samples), source, period, delay, parts)
    schema = f"{profile_log.KEY_SCHEMA.format(ts='timestamp')}, total_frames bigint, samples bigint, body string"
    return profiles.with_attributes(closed.mapInArrow(_encode(profiles.PERIOD_MILLIS[source], part_samples), schema))
