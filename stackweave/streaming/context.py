"""Streaming forms of the as-of context join and of the snapshot filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions import clock
from stackweave.streaming.ordered import InOrder, run_in_order

FRAMES = "array<struct<file:string,func:string,line:int>>"


class CurrentContext(InOrder):
    """Remembers the trace and span a thread works on."""

    def init(self, handle) -> None:
        super().init(handle)
        self.current = handle.getValueState("current", "trace_id string, span_id string")

    def fold(self, rows: list[tuple]) -> list[tuple]:
        before = tuple(self.current.get() or (None, None))
        state = before
        kept = []
        for at, rank, seq, sample_id, trace_id, span_id, payload in rows:
            if rank == 0:
                state = (trace_id, span_id)
            else:
                kept.append((at, sample_id, *state, payload))
        if state != before:
            self.current.update(state)
        return kept

    def forget(self) -> None:
        self.current.clear()

    def output(self, key, row):
        at, sample_id, trace_id, span_id, payload = row
        return (key[0], key[1], int(key[2]), at, sample_id, trace_id, span_id, payload)


class TrackedSpans(InOrder):
    """Remembers the open tracked spans of a trace in one process.

    Starts and ends are ranked before samples of the same moment; the thread of a sample
    travels in `seq`. An end without a start is ignored.
    """

    def init(self, handle) -> None:
        super().init(handle)
        self.open = handle.getMapState("open", "span_id string", "at bigint")

    def fold(self, rows: list[tuple]) -> list[tuple]:
        before = {key[0]: value[0] for key, value in self.open.iterator()}
        known = dict(before)
        if self.idle and rows:
            # A span that has been open for so long has lost its end.
            for span_id in [s for s, at in known.items() if at + self.idle * 1000 < rows[0][0]]:
                del known[span_id]
        kept = []
        for at, rank, seq, sample_id, trace_id, span_id, payload in rows:
            if rank == 1:
                if known:
                    kept.append((at, sample_id, seq, span_id, payload))
            elif seq > 0:
                known[span_id] = at
            elif span_id in known:
                del known[span_id]
        # Spans that open and end among these rows never touch the state.
        for span_id in before.keys() - known.keys():
            self.open.removeKey((span_id,))
        for span_id, at in known.items():
            if before.get(span_id) != at:
                self.open.updateValue((span_id,), (at,))
        return kept

    def forget(self) -> None:
        self.open.clear()

    def output(self, key, row):
        at, sample_id, tid, span_id, payload = row
        return (key[0], key[1], tid, at, sample_id, key[2], span_id, payload)


def _row(rank: int, seq: Column, sample_id: Column | None = None, payload: Column | None = None) -> list:
    """Columns of `ROW_SCHEMA`. Numbers are never null: pandas would turn them into floats,
    which cannot hold every id."""
    none = F.lit(None).cast("string")
    return [
        clock.micros(F.col("ts")).alias("at"),
        F.lit(rank).alias("rank"),
        F.coalesce(seq.cast("bigint"), F.lit(0).cast("bigint")).alias("seq"),
        F.coalesce(
            (F.lit(0) if sample_id is None else sample_id).cast("bigint"), F.lit(0).cast("bigint")
        ).alias("sample_id"),
        F.col("trace_id").cast("string").alias("trace_id"),
        F.col("span_id").cast("string").alias("span_id"),
        (none if payload is None else payload).alias("payload"),
    ]


def _instance(df: DataFrame) -> Column:
    """Telemetry of a service that runs once may name no instance."""
    return (F.coalesce("instance", F.lit("")) if "instance" in df.columns else F.lit("")).alias("instance")


def _payload(samples: DataFrame) -> Column | None:
    return F.to_json("frames") if "frames" in samples.columns else None


def _restored(out: DataFrame, samples: DataFrame) -> DataFrame:
    if "frames" not in samples.columns:
        return out.drop("payload")
    return out.withColumn("frames", F.from_json("payload", FRAMES)).drop("payload")


def attach_context(
    samples: DataFrame, changes: DataFrame, delay: str = "10 minutes", bucket_seconds: int = 60, idle_seconds: int | None = None
) -> DataFrame:
    """Streaming as-of join; equals the batch one once the watermark has passed.

    The context of a thread that was silent for `idle_seconds` is forgotten; without it, every thread
    that ever had one keeps its last context in state."""
    at = F.col("ts").cast("timestamp").alias("ts")
    plain = samples.withColumns({"trace_id": F.lit(None), "span_id": F.lit(None)})
    rows = plain.select("service", _instance(samples), "tid", at, *_row(1, F.lit(0), F.col("sample_id"), _payload(samples)))
    moves = changes.select("service", _instance(changes), "tid", at, *_row(0, F.col("seq")))
    out = run_in_order(rows.unionByName(moves), ["service", "instance", "tid"], CurrentContext(bucket_seconds, idle_seconds), delay)
    return _restored(out, samples)


def keep_tracked(
    samples: DataFrame, tracked: DataFrame, delay: str = "10 minutes", bucket_seconds: int = 60, idle_seconds: int | None = None
) -> DataFrame:
    """Streaming snapshot filter over samples that carry their context.

    With `idle_seconds`, a span that has been open for longer, and a trace that was silent for as
    long, are forgotten; without it, spans that never end stay in state."""
    at = F.col("ts").cast("timestamp").alias("ts")
    rows = samples.filter(F.col("trace_id").isNotNull()).select(
        "service", _instance(samples), at, *_row(1, F.col("tid"), F.col("sample_id"), _payload(samples))
    )
    moments = F.array(
        F.struct(F.col("start_ts").alias("ts"), F.lit(1).alias("delta")),
        F.struct(F.col("end_ts").alias("ts"), F.lit(-1).alias("delta")),
    )
    # A span that does not end after its start is open at no moment; its end would come first.
    lasting = tracked.filter(F.col("end_ts").isNull() | (F.col("end_ts") > F.col("start_ts")))
    edges = lasting.select("service", _instance(lasting), "trace_id", "span_id", F.inline(moments)).filter("ts is not null")
    moves = edges.select("service", "instance", at, *_row(0, F.col("delta")))
    out = run_in_order(rows.unionByName(moves), ["service", "instance", "trace_id"], TrackedSpans(bucket_seconds, idle_seconds), delay)
    return _restored(out, samples)
