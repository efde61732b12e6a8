"""Starting, draining and replaying streams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from stackweave import session
from stackweave.operators import logs


def write_routes(
    records: DataFrame, path: str, checkpoint: str, routes: Mapping[str, str], time: str | None = None
) -> StreamingQuery:
    """Route log records to one folder per pipeline, and per day of a `time` column if one is named.

    Each micro-batch overwrites the folder of its own number, so a batch that is repeated
    after a failure leaves no record twice.
    """

    def save(batch: DataFrame, number: int) -> None:
        logs.write_routes(batch, f"{path}/batch={number}", routes, "overwrite", time)

    return (
        records.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Counts, for every query of a session, rows that came behind the watermark and were left out.

    Spark keeps the progress of the last batches only; a listener sees all of them. Add it with
    `spark.streams.addListener` before queries start.
    """

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self.rows[str(event.progress.id)] += dropped

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.rows[str(query.id)]


def split_late(
    stream: DataFrame, time: str, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Write all rows to `path`/rows, told apart by whether they came behind the watermark.

    The watermark of a batch is the latest time in all batches before it, less the delay, as
    Spark's own is; but late rows are kept as data, with the number of their batch and how far
    behind they were, so that they can be counted, repaired or merged later. `timing` and `number`
    are partitions: a reader of one kind prunes the other. Each batch notes the latest time seen so
    far under its own number, and overwrites its own folders, so a batch that is repeated after a
    failure decides alike and leaves nothing twice.
    """
    seconds = _seconds(delay)

    def save(batch: DataFrame, number: int) -> None:
        notes, rows = f"{path}/latest/number={number}", f"{path}/rows/number={number}"
        spark = batch.sparkSession
        latest = spark.read.parquet(f"{path}/latest/number={number - 1}").first()[0] if number else None
        known = F.lit(latest).cast("timestamp")
        at = F.col(time).cast("timestamp")
        behind = F.coalesce(F.unix_micros(known) - F.lit(round(seconds * 1e6)) - F.unix_micros(at), F.lit(0))
        marked = batch.withColumns({
            "behind_seconds": F.greatest(behind, F.lit(0)) / F.lit(1e6), "timing": F.when(behind > 0, "late").otherwise("timely"),
        })
        marked.write.mode("overwrite").partitionBy("timing").parquet(rows)
        told = spark.read.schema(marked.schema).parquet(rows)
        told.agg(F.greatest(F.max(at), known).alias("latest")).write.mode("overwrite").parquet(notes)

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _seconds(delay: str) -> float:
    """A delay such as '10 minutes' in seconds."""
    amount, _, unit = delay.strip().partition(" ")
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}
    return float(amount) * sizes[unit.strip().rstrip("s")]


def drain(stream: DataFrame, label: str, *replays: Replay) -> DataFrame:
    """Process what is there, keep the result in the shared folder, and read it back.

    Replayed tables land slice by slice, all up to the same moment, and the query goes on from its
    checkpoint each time, so no row comes behind one that was read before. The tables are closed
    after the last slice.
    """
    spark = stream.sparkSession
    path = session.new_folder(spark, label)

    def run() -> None:
        query = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("compression", "zstd")
            .option("checkpointLocation", f"{path}-checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    for low, high in _slices(replays):
        for replayed in replays:
            replayed.land(low, high)
        run()
    for replayed in replays:
        replayed.close()
    run()
    return spark.read.schema(stream.schema).parquet(path)


class Replay:
    """A table as a stream of slices in the order of time.

    `times` are its event-time column and any others that become event times downstream: a row
    arrives at the latest of them, as a span does when it ends. Only the rows of a slice, and what
    reaches back by the delay, are in state at a time. `close` adds a row after the end of all times,
    null elsewhere, which lets the watermark pass everything. Rows without a time arrive first.
    """

    def __init__(self, df: DataFrame, label: str, *times: str, slices: int = 3):
        spark = self.spark = df.sparkSession
        typed = df.withColumns({time: F.col(time).cast("timestamp") for time in times})
        self.rows, self.times = session.written(typed, label), times
        self.schema, self.path = typed.schema, session.new_folder(spark, f"{label}-landed")
        micros = [F.unix_micros(time) for time in times]
        self.arrival = F.greatest(*micros) if len(micros) > 1 else micros[0]
        first = F.least(*micros) if len(micros) > 1 else micros[0]
        told = self.rows.agg(F.min(self.arrival), F.max(self.arrival), F.max(self.arrival - first), F.count("*")).first()
        self.range = None if told[0] is None else (told[0], told[1])
        # How far a row may reach back before the moment at which it arrives.
        self.reach = told[2] or 0
        self.slices = max(slices, -(-told[3] // _SLICE_ROWS))
        self.until, self.landed = 0, False
        self.rows.limit(0).write.parquet(self.path)
        self.stream = spark.readStream.schema(self.schema).parquet(self.path)

    def land(self, low: int, high: int) -> None:
        """Rows that arrive in [low, high)."""
        wanted = (self.arrival >= low) & (self.arrival < high)
        if not self.landed:
            wanted |= self.arrival.isNull()
        self.landed = True
        self.rows.where(wanted).write.mode("append").parquet(self.path, compression="zstd")

    def close(self) -> None:
        columns = [
            (F.timestamp_seconds(F.lit(self.until)) if f.name == self.times[0] else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in self.schema
        ]
        self.spark.range(1).select(*columns).coalesce(1).write.mode("append").parquet(self.path)


_SLICE_ROWS = 20_000_000


def _slices(replays: Sequence[Replay]) -> list[tuple[int, int]]:
    """Spans of time, in microseconds, that together cover all rows of tables replayed together."""
    ranges = [replayed.range for replayed in replays if replayed.range]
    if not ranges:
        return [(0, 0)]
    low, high = min(r[0] for r in ranges), max(r[1] for r in ranges) + 1
    count = min(max(replayed.slices for replayed in replays), high - low)
    edges = [low + (high - low) * k // count for k in range(count + 1)]
    return list(zip(edges, edges[1:], strict=False))


def delay_of(*replays: Replay, until: str | None = None) -> str:
    """A watermark delay for tables that are replayed together; `until` is a day up to which what
    follows may reach beyond their times."""
    delay = max(replayed.reach for replayed in replays) // 1_000_000 + 1
    last = max((replayed.range[1] // 1_000_000 for replayed in replays if replayed.range), default=0)
    if until:
        last = max(last, int(datetime.fromisoformat(until).replace(tzinfo=timezone.utc).timestamp()))
    for replayed in replays:
        # A day for windows that reach further.
        replayed.until = last + delay + 86_400
    return f"{delay} seconds"
