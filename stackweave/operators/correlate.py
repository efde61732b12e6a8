"""Traces and the stacks sampled while they ran."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.functions import ids
from stackweave.operators.context import PROCESS, present


def span_profiles(spans: DataFrame, samples: DataFrame, period_millis: int) -> DataFrame:
    """CPU time sampled inside every span, through the ids embedded in the samples.

    Embedded ids lack leading zeros and are widened first. Samples are summed per span
    before they meet the spans, so a span with very many samples is one row in the join.
    """
    sampled = (
        samples.filter(F.col("trace_id").isNotNull())
        .groupBy(ids.trace_hex(F.col("trace_id")).alias("trace_id"),
                 ids.span_hex(F.col("span_id")).alias("span_id"))
        .agg(F.count("*").alias("samples"))
    )
    count = F.coalesce("samples", F.lit(0).cast("long"))
    return spans.join(sampled, ["trace_id", "span_id"], "left").select(
        *present(PROCESS, spans), "trace_id", "span_id", "start_ts", "end_ts",
        count.alias("samples"),
        (count * period_millis).alias("total_ms"),
    )


def spans_without_stacks(selected: DataFrame, samples: DataFrame) -> DataFrame:
    """Selected spans whose trace left no stack in that process."""
    process = present(PROCESS, selected, samples)
    seen = samples.select(*process, ids.trace_hex(F.col("trace_id")).alias("trace_id")).distinct()
    return selected.join(seen, [*process, "trace_id"], "left_anti")
