"""Checks on decoded profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.functions import ids
from stackweave.operators.profiles import FORMAT, KEY


def violations(decoded: DataFrame) -> DataFrame:
    """One row per broken rule and sample of decoded profiles."""
    has_sample = F.col("sample").isNotNull()
    rules = {
        "wrong_format": ~F.col("format").eqNullSafe(F.lit(FORMAT)),
        "undecodable": F.col("error").isNotNull(),
        "no_samples": ~has_sample & F.col("error").isNull(),
        "empty_stack": has_sample & (F.coalesce(F.size("frames"), F.lit(0)) <= 0),
        "missing_trace_id": has_sample & ~ids.is_valid_id(F.col("trace_id")),
        "missing_span_id": has_sample & ~ids.is_valid_id(F.col("span_id")),
    }
    broken = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, test in rules.items()]))
    return decoded.select(*KEY, "sample", F.explode(broken).alias("rule"))
