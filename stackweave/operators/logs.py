"""Log, span and metric exports: flattening, filtering and routing; presence of metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ROUTE = "default"


def _flatten(exports: DataFrame, resources: str, scopes: str, items: str, *keep: str) -> DataFrame:
    """Requests holding resources holding scopes holding items, as one row per item."""
    of_resource = exports.select(*keep, F.explode(resources).alias("_r"))
    of_scope = of_resource.select(
        *keep, F.col("_r.resource.attributes").alias("resource"), F.explode(f"_r.{scopes}").alias("_s")
    )
    return of_scope.select(
        *keep, "resource", F.col("_s.scope.name").alias("scope"), F.posexplode(f"_s.{items}").alias("position", "_item")
    )


def flatten_logs(exports: DataFrame, *keep: str) -> DataFrame:
    """One row per log record."""
    return _flatten(exports, "resource_logs", "scope_logs", "log_records", *keep).select(
        *keep, "resource", "scope", "position", "_item.*"
    )


def _hex(value: Column, kind: str) -> Column:
    """Ids are bytes on the wire and text in JSON; rows hold them as lower-case hex, empty ones as null."""
    text = F.lower(F.hex(value)) if kind == "binary" else F.lower(value)
    return F.when(text != "", text)


def _moment(nanos: Column) -> Column:
    return F.timestamp_micros(F.floor(nanos / 1000))


def flatten_spans(exports: DataFrame, *keep: str) -> DataFrame:
    """One row per span. Ids become hex text, unset times null, and nanoseconds stay beside the times."""
    rows = _flatten(exports, "resource_spans", "scope_spans", "spans", *keep)
    kinds = dict(rows.select("_item.*").dtypes)
    ids = {name: _hex(F.col(f"_item.{name}"), kinds[name]) for name in ("trace_id", "span_id", "parent_span_id")}
    times = {}
    for name in ("start", "end"):
        nanos = F.col(f"_item.{name}_time_unix_nano").cast("long")
        times[f"{name}_ns"] = F.when(nanos > 0, nanos)
        times[f"{name}_ts"] = _moment(times[f"{name}_ns"])
    own = [F.col(f"_item.{name}") for name in kinds if name not in ids and not name.endswith("_time_unix_nano")]
    return rows.select(
        *keep, "resource", "scope", "position", *(v.alias(k) for k, v in {**ids, **times}.items()), *own
    )


# What a metric's data may be; of these, one is set. Points of all kinds become rows of one shape.
NUMBERS = ("gauge", "sum")
POINT = "time_ns long, value double, int_value long, count long, total double, bounds array<double>, buckets array<long>, attributes map<string,string>"


def _number_point(point: Column) -> Column:
    return F.struct(
        point["time_unix_nano"].cast("long"), F.coalesce(point["as_double"], point["as_int"].cast("double")), point["as_int"].cast("long"),
        F.lit(None), F.lit(None), F.lit(None), F.lit(None), point["attributes"],
    ).cast(f"struct<{POINT.replace(' ', ':').replace(',:', ',')}>")


def _histogram_point(point: Column) -> Column:
    return F.struct(
        point["time_unix_nano"].cast("long"), F.lit(None), F.lit(None), point["count"].cast("long"), point["sum"].cast("double"),
        point["explicit_bounds"], point["bucket_counts"], point["attributes"],
    ).cast(f"struct<{POINT.replace(' ', ':').replace(',:', ',')}>")


def flatten_metrics(exports: DataFrame, *keep: str) -> DataFrame:
    """One row per data point: metric, unit, kind (gauge, sum or histogram), temporality, whether a sum
    only grows, and the point. A whole number is also given as a double. A metric without data, or of
    another kind, has no rows."""
    rows = _flatten(exports, "resource_metrics", "scope_metrics", "metrics", *keep)
    item = F.col("_item")
    points = F.coalesce(
        *(F.transform(item[kind]["data_points"], _number_point) for kind in NUMBERS),
        F.transform(item["histogram"]["data_points"], _histogram_point),
    )
    kind = F.coalesce(*(F.when(item[name].isNotNull(), F.lit(name)) for name in (*NUMBERS, "histogram")))
    temporality = F.coalesce(item["sum"]["aggregation_temporality"], item["histogram"]["aggregation_temporality"])
    described = rows.select(
        *keep, "resource", "scope", item["name"].alias("metric"), item["unit"].alias("unit"), kind.alias("kind"),
        temporality.alias("temporality"), item["sum"]["is_monotonic"].alias("is_monotonic"), F.posexplode(points).alias("position", "_point"),
    )
    return described.select(*(c for c in described.columns if c != "_point"), "_point.*")


def route_of(scope: Column, routes: Mapping[str, str]) -> Column:
    """The one pipeline a record goes to: that of its scope, or the default."""
    chosen = None
    for name, route in routes.items():
        test = scope == name
        chosen = F.when(test, route) if chosen is None else chosen.when(test, route)
    return F.lit(DEFAULT_ROUTE) if chosen is None else chosen.otherwise(DEFAULT_ROUTE)


def write_routes(
    records: DataFrame, path: str, routes: Mapping[str, str], mode: str = "append", time: str | None = None
) -> None:
    """Write every record once, under the folder of its route, beside what is there; with a `time`
    column, under the day of that time first."""
    routed = records.withColumn("route", route_of(F.col("scope"), routes))
    folders = ["route"]
    if time:
        routed, folders = routed.withColumn("date", F.to_date(time)), ["date", "route"]
    routed.write.mode(mode).partitionBy(*folders).parquet(path)


def in_scope(
    records: DataFrame, scope: str, attribute: str | None = None, value: str | None = None
) -> DataFrame:
    """Records of one scope, optionally with one attribute equal to a value."""
    kept = records.filter(F.col("scope") == scope)
    if attribute is not None:
        kept = kept.filter(F.col("attributes").getItem(attribute) == value)
    return kept


def metric_presence(metrics: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Whether each expected metric was exported by a service.

    The expected names become columns of one partial aggregate, so there is nothing to
    collect and no cross product.
    """
    seen = metrics.groupBy("service").agg(
        *[F.max(F.col("metric") == name).alias(f"_{i}") for i, name in enumerate(expected)]
    )
    flags = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(f"_{i}").alias("present"))
            for i, name in enumerate(expected)
        ]
    )
    return seen.select("service", F.inline(flags))
