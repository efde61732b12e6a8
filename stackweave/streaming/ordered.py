"""State that follows event order although rows arrive in any order.

Rows of one key wait for the end of their bucket of time. A few wait beside what is known of the key;
more go, sorted, into chunks of bounded size, each one entry of the state. There is one timer, at the
end of the earliest bucket that has rows: when it fires, the chunks that begin in buckets which the
watermark has passed are read, folded in time order and removed; what of them is not due waits again.
So the state is touched a few times for a key and batch, not for each row, and the work on a row is
bounded by a chunk however many wait. Keys that stay silent for `idle_seconds` are forgotten, if that
is asked for.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# at: microseconds; rank: order within the same moment; then what the fold needs.
ROW_SCHEMA = (
    "at bigint, rank int, seq bigint, sample_id bigint, trace_id string, span_id string, payload string"
)
ROW_NAMES = [part.split()[0] for part in ROW_SCHEMA.split(", ")]
ROW_NUMBERS, ROW_TEXTS = ROW_NAMES[:4], ROW_NAMES[4:]
BESIDE_ROWS = 64
CHUNK_ROWS = 1000


def _text(item):
    """Arrow hands a missing text to pandas as NaN or None."""
    return None if pd.isna(item) else item


def _order(row) -> tuple:
    return tuple(row[:3])


class Waiting:
    """What is known of a key: rows that wait beside it, chunks as [number, end of their first bucket], the
    number of the next chunk, the end of the latest bucket, the time of the last row that was folded,
    and the timer that is set."""

    def __init__(self, told: str | None):
        known = json.loads(told) if told else [[], [], 0, 0, None, None]
        self.rows, self.chunks, self.next, self.last, self.folded, self.timer = known
        self.rows = [tuple(row) for row in self.rows]

    def told(self) -> str:
        return json.dumps([self.rows, self.chunks, self.next, self.last, self.folded, self.timer])


class InOrder(StatefulProcessor):
    """Keeps rows until the watermark has passed their bucket, and folds them in order."""

    def __init__(self, bucket_seconds: int = 60, idle_seconds: int | None = None):
        if idle_seconds is not None and idle_seconds < bucket_seconds:
            raise ValueError("a key cannot be silent for less than a bucket")
        self.width = bucket_seconds * 1_000_000
        self.idle = idle_seconds * 1000 if idle_seconds else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "chunk bigint", "rows string")
        self.known = handle.getValueState("known", "told string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = []
        for batch in rows:
            numbers = [[int(x) for x in batch[name].tolist()] for name in ROW_NUMBERS]
            texts = [[_text(x) for x in batch[name].tolist()] for name in ROW_TEXTS]
            found += zip(*numbers, *texts, strict=True)
        if found:
            known = self._known()
            known.last = max(known.last, max(self._end(row) for row in found))
            self._keep(known, found)
            self._set_timer(known)
            self.known.update((known.told(),))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        known = self._known()
        rows, known.rows = known.rows, []
        for number, end in known.chunks:
            if end <= passed:
                rows += [tuple(row) for row in json.loads(self.waiting.getValue((number,))[0])]
                self.waiting.removeKey((number,))
        known.chunks = [chunk for chunk in known.chunks if chunk[1] > passed]
        rows.sort(key=_order)
        due = bisect_right(rows, passed, key=self._end)
        self._keep(known, rows[due:])
        # Silence is measured between rows, so that it does not matter when the timer came.
        runs = groupby(rows[:due], lambda row: row[0] // self.width if self.idle else None)
        for run in (list(run) for _, run in runs):
            if self.idle and known.folded is not None and run[0][0] - known.folded > self.idle * 1000:
                self.forget()
            known.folded = run[-1][0]
            kept = self.fold(run)
            if kept:
                names = ["service", "instance", "tid", "at", "sample_id", "trace_id", "span_id", "payload"]
                yield pd.DataFrame([self.output(key, row) for row in kept], columns=names)
        left = known.rows or known.chunks
        if self.idle and not left and known.last + self.idle <= passed:
            self.forget()
            self.known.clear()
        elif due:
            known.timer = None
            self._set_timer(known)
            if not left and not self.idle:
                self.known.clear()
            else:
                self.known.update((known.told(),))
            if self.idle:
                self.handle.registerTimer(known.last + self.idle)

    def _keep(self, known: Waiting, rows: list[tuple]) -> None:
        rows = sorted(known.rows + rows, key=_order)
        known.rows = rows if len(rows) <= BESIDE_ROWS else []
        for start in range(0, 0 if known.rows else len(rows), CHUNK_ROWS):
            chunk = rows[start : start + CHUNK_ROWS]
            self.waiting.updateValue((known.next,), (json.dumps(chunk),))
            known.chunks.append([known.next, self._end(chunk[0])])
            known.next += 1

    def _set_timer(self, known: Waiting) -> None:
        ends = [end for _, end in known.chunks] + [self._end(row) for row in known.rows[:1]]
        if ends and (known.timer is None or min(ends) < known.timer):
            known.timer = min(ends)
            self.handle.registerTimer(known.timer)

    def forget(self) -> None:
        """Drop what a silent key has left."""

    def _end(self, row: tuple) -> int:
        """When the bucket of a row is over, in milliseconds."""
        return -(-(row[0] // self.width + 1) * self.width // 1000)

    def _known(self) -> Waiting:
        found = self.known.get()
        return Waiting(found[0] if found else None)

    def close(self) -> None:
        pass


OUTPUT_SCHEMA = (
    "service string, instance string, tid bigint, at bigint, sample_id bigint, trace_id string, span_id string, payload string"
)


def run_in_order(rows: DataFrame, keys: list[str], processor: InOrder, delay: str) -> DataFrame:
    """Samples that come out of the fold, with `ts` restored."""
    out = (
        rows.withWatermark("ts", delay)
        .groupBy(*keys)
        .transformWithStateInPandas(processor, OUTPUT_SCHEMA, "append", "eventTime")
    )
    return out.select(
        "service", "instance", "tid", F.timestamp_micros("at").alias("ts"), "sample_id", "trace_id", "span_id", "payload"
    )
