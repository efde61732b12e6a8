"""Where the time goes: functions, call edges and folded stacks.

A sample stands for one sampling period. Functions and edges count once per sample however
often a recursive stack repeats them; repeats are removed inside the row, so the only shuffle
is that of the partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that cannot occur in a file or function name.
_IN_NAME = "\u0000"
_IN_EDGE = "\u0001"
_MISSING = "\u0002"  # a native frame has no file
UNKNOWN = "[unknown]"


def _name(frame: Column) -> Column:
    """A frame as one string, which Spark can hash when it removes repeats."""
    file, func = (F.coalesce(part, F.lit(_MISSING)) for part in (frame["file"], frame["func"]))
    return F.concat(file, F.lit(_IN_NAME), func)


def _names() -> Column:
    return F.transform("frames", _name)


def _known(part: Column) -> Column:
    return F.when(part != _MISSING, part)


def _file(name: Column) -> Column:
    return _known(F.substring_index(name, _IN_NAME, 1))


def _func(name: Column) -> Column:
    return _known(F.substring_index(name, _IN_NAME, -1))


def function_times(
    samples: DataFrame, period_millis: int, by: Sequence[str] = ("service",)
) -> DataFrame:
    """Self and total time of every function.

    Self time goes to the leaf of a stack, total time to every function on it.
    """
    leaf = F.try_element_at("frames", F.lit(-1))
    return (
        # Empty stacks have nothing to explode; a filter on them would have packed stacks parsed twice.
        samples
        # The leaf gets its own projection, or it would be worked out again for every frame.
        .select(*by, "frames", _name(leaf).alias("_leaf"))
        .select(*by, "_leaf", F.explode(F.array_distinct(_names())).alias("_name"))
        .groupBy(*by, "_name")
        .agg(
            F.sum((F.col("_name") == F.col("_leaf")).cast("long")).alias("self_samples"),
            F.count("*").alias("total_samples"),
        )
        .select(
            *by,
            _file(F.col("_name")).alias("file"),
            _func(F.col("_name")).alias("func"),
            "self_samples",
            "total_samples",
            (F.col("self_samples") * period_millis).alias("self_ms"),
            (F.col("total_samples") * period_millis).alias("total_ms"),
        )
    )


def call_edges(
    samples: DataFrame, period_millis: int, by: Sequence[str] = ("trace_id",)
) -> DataFrame:
    """Caller and callee pairs of the call graph, by default per trace."""
    inner = F.greatest(F.size("frames") - 1, F.lit(0))
    edges = F.zip_with(
        F.slice(_names(), F.lit(1), inner),
        F.slice(_names(), F.lit(2), inner),
        lambda caller, callee: F.concat(caller, F.lit(_IN_EDGE), callee),
    )
    caller = F.substring_index("_edge", _IN_EDGE, 1)
    callee = F.substring_index("_edge", _IN_EDGE, -1)
    return (
        samples.select(*by, F.explode(F.array_distinct(edges)).alias("_edge"))
        .groupBy(*by, "_edge")
        .agg(F.count("*").alias("samples"))
        .select(
            *by,
            _file(caller).alias("caller_file"),
            _func(caller).alias("caller"),
            _file(callee).alias("callee_file"),
            _func(callee).alias("callee"),
            "samples",
            (F.col("samples") * period_millis).alias("total_ms"),
        )
    )


def folded_stacks(
    samples: DataFrame, period_millis: int, by: Sequence[str] = ("service",)
) -> DataFrame:
    """Distinct stack paths, root first, with their weight.

    Paths are told apart by their names, and joined for display only; a missing name shows
    as unknown.
    """
    path = F.transform("frames", lambda frame: frame.func)
    return (
        samples.select(*by, path.alias("_path"))
        .groupBy(*by, "_path")
        .agg(F.count("*").alias("samples"))
        .select(
            *by, F.array_join("_path", ";", UNKNOWN).alias("stack"), "samples",
            (F.col("samples") * period_millis).alias("total_ms"),
        )
    )
