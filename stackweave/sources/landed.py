"""Reading landed telemetry, as tables or as streams, with declared schemas."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.functions import ids

FRAMES = "array<struct<file:string,func:string,line:int>>"
SCOPE = "scope:struct<name:string,version:string>"
RESOURCE = "resource:struct<attributes:map<string,string>>"
SPAN = (
    "struct<trace_id:string,span_id:string,parent_span_id:string,name:string,kind:int,start_time_unix_nano:bigint,"
    "end_time_unix_nano:bigint,attributes:map<string,string>,status:struct<code:int,message:string>>"
)
_NUMBERS = "data_points:array<struct<time_unix_nano:bigint,as_double:double,as_int:bigint,attributes:map<string,string>>>"
_HISTOGRAM = (
    "data_points:array<struct<time_unix_nano:bigint,count:bigint,sum:double,bucket_counts:array<bigint>,"
    "explicit_bounds:array<double>,attributes:map<string,string>>>"
)
# Of the kinds of a metric one is set.
METRIC = (
    f"struct<name:string,unit:string,gauge:struct<{_NUMBERS}>,sum:struct<{_NUMBERS},aggregation_temporality:int,is_monotonic:boolean>,"
    f"histogram:struct<{_HISTOGRAM},aggregation_temporality:int>>"
)
SCHEMAS = {
    "stack_samples": f"service string, instance string, tid bigint, sampler_tid bigint, ts timestamp, sample_id bigint, frames {FRAMES}",
    "context_events": (
        "service string, instance string, tid bigint, ts timestamp, seq bigint, kind string, trace_id string, span_id string"
    ),
    "spans": (
        "service string, instance string, trace_id string, span_id string, parent_span_id string, parent_is_remote boolean, "
        "start_ts timestamp, end_ts timestamp, attributes map<string,string>, volume string"
    ),
    "log_exports": (
        "resource_logs array<struct<resource:struct<attributes:map<string,string>>,"
        "scope_logs:array<struct<scope:struct<name:string,version:string>,"
        "log_records:array<struct<timestamp_ns:bigint,body:string,attributes:map<string,string>>>>>>>"
    ),
    "span_exports": f"resource_spans array<struct<{RESOURCE},scope_spans:array<struct<{SCOPE},spans:array<{SPAN}>>>>>",
    "metric_exports": f"resource_metrics array<struct<{RESOURCE},scope_metrics:array<struct<{SCOPE},metrics:array<{METRIC}>>>>>",
    "config_entries": "process string, key string, value string",
}


def read(spark: SparkSession, kind: str, path: str, format: str = "parquet", stream: bool = False) -> DataFrame:
    """Landed telemetry of one kind; nothing is inferred, so nothing is read twice."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(SCHEMAS[kind]).format(format).load(path)


def frames_of(listed: Column) -> Column:
    """Frames captured as [file, function, line] lists, as structs."""
    return F.transform(
        listed,
        lambda frame: F.struct(
            frame[0].alias("file"), frame[1].alias("func"), frame[2].try_cast("int").alias("line")
        ),
    )


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Captured stacks in JSON: one array of {frames, tid} per file, root frame first."""
    captured = spark.read.schema("frames array<array<string>>, tid bigint").json(path, multiLine=True)
    return captured.select("tid", frames_of(F.col("frames")).alias("frames"))


@F.pandas_udf(T.StringType())
def _hex(numbers: pd.Series) -> pd.Series:
    """Unsigned decimal text as hex; ids of 128 bits fit no SQL number."""
    return numbers.map(lambda text: None if text is None else f"{int(text):x}")


def read_thread_states(spark: SparkSession, path: str) -> DataFrame:
    """Thread states in JSON: an object of thread to [trace, span] or null, as decimal numbers."""
    states = F.from_json("value", "map<string,array<string>>")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(states).alias("tid", "_pair"))
        .select(
            F.col("tid").cast("bigint").alias("tid"),
            ids.trace_hex(_hex(F.col("_pair")[0])).alias("trace_id"),
            ids.span_hex(_hex(F.col("_pair")[1])).alias("span_id"),
        )
    )
