"""Time arithmetic on whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def nanos(ts: Column) -> Column:
    """Kept as a long: Spark timestamps hold microseconds."""
    return micros(ts) * F.lit(1000).cast("long")


def slice_of(ts: Column, seconds: int) -> Column:
    """Start, in microseconds, of the time slice a moment falls in."""
    at = micros(ts)
    return at - F.pmod(at, F.lit(seconds * 1_000_000).cast("long"))
