"""Dependency reports, which arrive in fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid() -> Column:
    """The checks a decoded fragment has to pass."""
    return F.coalesce(
        (F.col("id") != "")
        & (F.col("fragment_index") >= 0)
        & (F.col("max_fragments") >= 1)
        & F.col("is_done").isNotNull()
        & F.col("packages").isNotNull(),
        F.lit(False),
    )


def completeness(fragments: DataFrame) -> DataFrame:
    """Which reports arrived whole: every fragment from the first to the last announced one,
    and one of them flagged as done.

    Repeated deliveries of a fragment are reduced to one before they reach the report. A
    fragment outside the announced range is no part of it.
    """
    in_range = (F.col("fragment_index") >= 0) & (F.col("fragment_index") < F.col("max_fragments"))
    once = fragments.groupBy("id", "fragment_index").agg(
        F.max("max_fragments").alias("max_fragments"),
        F.max("is_done").alias("is_done"),
        F.max(F.size("packages").cast("long")).alias("packages"),
    )
    return (
        once.groupBy("id")
        .agg(
            F.count_if(in_range).alias("fragments"),
            F.max("max_fragments").cast("long").alias("max_fragments"),
            F.coalesce(F.max("is_done"), F.lit(False)).alias("is_done"),
            F.sum("packages").alias("packages"),
        )
        .withColumn(
            "complete", F.coalesce(F.col("is_done") & (F.col("fragments") >= F.col("max_fragments")), F.lit(False))
        )
    )


def reassemble(fragments: DataFrame) -> DataFrame:
    """Packages of complete reports in report order, one row each.

    The order is carried by (fragment_index, position); a report is never gathered into
    one row, so its size does not matter.
    """
    whole = completeness(fragments).filter("complete").select("id")
    return (
        fragments.join(whole, "id", "left_semi")
        .select("id", "fragment_index", F.posexplode("packages").alias("position", "_p"))
        .groupBy("id", "fragment_index", "position")
        .agg(F.max("_p").alias("_p"))
        .select("id", "fragment_index", "position", "_p.*")
    )


def package_names(fragments: DataFrame) -> DataFrame:
    """Distinct package names over all reports, in lower case."""
    return fragments.select(F.explode("packages").alias("_p")).select(
        F.lower("_p.name").alias("name")
    ).distinct()
