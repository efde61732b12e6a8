"""Trace and span identifiers.

Trace ids are unsigned 128-bit and span ids unsigned 64-bit numbers, so neither fits a
bigint. Both are held as lower-case hex text of fixed width, where text order is number order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header widths, and the smaller minimum widths used inside profile labels.
TRACE_WIDTH = 32
SPAN_WIDTH = 16
TRACE_LABEL_WIDTH = 16
SPAN_LABEL_WIDTH = 8


def _full(value: Column, width: int) -> Column:
    return F.lpad(F.lower(value), width, "0")


def trace_hex(value: Column) -> Column:
    """Any hex form of a trace id as 32 lower-case digits."""
    return _full(value, TRACE_WIDTH)


def span_hex(value: Column) -> Column:
    """Any hex form of a span id as 16 lower-case digits."""
    return _full(value, SPAN_WIDTH)


def _label(value: Column, width: int) -> Column:
    digits = F.ltrim(F.lower(value), F.lit("0"))
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def trace_label(value: Column) -> Column:
    """The form used in profile labels: leading zeros dropped down to 16 digits."""
    return _label(value, TRACE_LABEL_WIDTH)


def span_label(value: Column) -> Column:
    """The form used in profile labels: leading zeros dropped down to 8 digits."""
    return _label(value, SPAN_LABEL_WIDTH)


def is_valid_id(value: Column) -> Column:
    """Present and not all zeros."""
    return F.coalesce(F.ltrim(value, F.lit("0")) != "", F.lit(False))


def server_timing(trace_id: Column, span_id: Column) -> Column:
    """Value of the Server-Timing response header; null when the span is not valid."""
    return F.when(
        is_valid_id(trace_id) & is_valid_id(span_id),
        F.format_string('traceparent;desc="00-%s-%s-01"', trace_hex(trace_id), span_hex(span_id)),
    )


# The response header, and the one that lets scripts of other origins read it.
SERVER_TIMING = "Server-Timing"
EXPOSE_HEADERS = "Access-Control-Expose-Headers"


def response_headers(trace_id: Column, span_id: Column) -> Column:
    """All headers of a response as a map; none when the span is not valid."""
    value = server_timing(trace_id, span_id)
    headers = F.create_map(F.lit(SERVER_TIMING), value, F.lit(EXPOSE_HEADERS), F.lit(SERVER_TIMING))
    return F.when(value.isNotNull(), headers).otherwise(F.create_map().cast("map<string,string>"))
