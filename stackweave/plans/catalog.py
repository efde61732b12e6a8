"""The registered queries: views in, operators applied, results out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave import session
from stackweave.functions import endpoints, ids, sampling, stacks, text
from stackweave.operators import (
    attributes,
    callgraph,
    config,
    context,
    correlate,
    inventory,
    limits,
    logs,
    profiles,
    quality,
    reports,
    spans,
)
from stackweave.sources import landed, profile_log, profile_source, report_log, tables
from stackweave.streaming import context as stream_context
from stackweave.streaming import profiles as stream_profiles
from stackweave.streaming import sinks, windows

Query = Callable[[SparkSession, str], DataFrame]
Taken = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        return run(session.prepare(spark), folder)

    QUERIES[run.__name__] = prepared
    return run


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return context.exclude_sampler_thread(tables.stack_samples(spark, folder))


def packed_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples with their stacks as text, for those that are shuffled before anybody looks at a frame."""
    return stacks.packed(samples(spark, folder))


def deep_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples with the depth of their stacks in place of the frames."""
    return samples(spark, folder).withColumn("depth", F.size("frames").cast("long")).drop("frames")


def traced(spark: SparkSession, folder: str, taken: Taken = packed_samples) -> DataFrame:
    changes = context.context_changes(tables.context_events(spark, folder))
    return context.attach_context(taken(spark, folder), changes)


def tracked(spark: SparkSession, folder: str, unit_seconds: int = 3600) -> DataFrame:
    return spans.select_spans(tables.event_spans(spark, folder, unit_seconds=unit_seconds))


def snapshot(spark: SparkSession, folder: str, taken: Taken = packed_samples) -> DataFrame:
    return spans.keep_tracked(traced(spark, folder, taken), tracked(spark, folder))


@query
def stack_frames(spark, folder):
    return samples(spark, folder).select(
        "service", "instance", "sample_id", "tid", "ts", F.posexplode("frames").alias("depth", "frame")
    ).select(
        "service", "instance", "sample_id", "tid", "ts", F.col("depth").cast("long").alias("depth"),
        "frame.file", "frame.func", F.col("frame.line").cast("long").alias("line"),
    )


@query
def context_changes(spark, folder):
    return context.context_changes(tables.context_events(spark, folder))


@query
def samples_with_context(spark, folder):
    return traced(spark, folder).drop("frames")


@query
def snapshot_samples(spark, folder):
    return snapshot(spark, folder).drop("frames")


@query
def open_spans(spark, folder):
    return spans.open_span_counts(tables.event_spans(spark, folder))


@query
def active_intervals(spark, folder):
    return spans.active_intervals(tracked(spark, folder, unit_seconds=60))


# The test tables hold about a sample a minute, so an hour stands for a tick, and parts of four
# samples for those that a busy tick is cut into. Records are also counted by the second.
TICK = "1 hour"
SECOND = "1 second"
PART_SAMPLES = 4


def ticked(spark: SparkSession, folder: str, period: str = TICK, taken: Taken = packed_samples) -> DataFrame:
    return profiles.in_ticks(traced(spark, folder, taken), profiles.CONTINUOUS, period)


def numbered(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.number_samples(ticked(spark, folder), PART_SAMPLES)


def all_ticked(spark: SparkSession, folder: str, period: str = SECOND, taken: Taken = packed_samples) -> DataFrame:
    """Continuous and snapshot samples side by side, told apart by their source."""
    return ticked(spark, folder, period, taken).unionByName(
        profiles.in_ticks(snapshot(spark, folder, taken), profiles.SNAPSHOT, period)
    )


def counted(ticked: DataFrame) -> DataFrame:
    """Records without their bodies, from samples with the depth of their stacks."""
    narrow = ticked.select(*profiles.TICK, "ts", "tid", "sample_id", "depth")
    return profiles.records(profiles.number_samples(narrow, PART_SAMPLES))


@query
def ticks(spark, folder):
    return profiles.ticks(all_ticked(spark, folder))


@query
def filtered_ticks(spark, folder):
    """Ticks of the samples that the caller's own filter keeps; a tick without any is left out."""
    busy = lambda rows: rows.filter(F.col("trace_id").isNotNull() & (F.col("tid") % 3 != 1))
    return profiles.ticks(profiles.in_ticks(traced(spark, folder), profiles.CONTINUOUS, TICK, keep=busy))


@query
def frame_counts(spark, folder):
    return counted(ticked(spark, folder, taken=deep_samples)).select("service", "instance", "tick_ts", "part", "total_frames")


def _record_columns(records: DataFrame) -> DataFrame:
    def attribute(name: str):
        return F.element_at("attributes", name)

    return records.select(
        "service", "instance", "source", "scope", "timestamp_ns", "part", "samples",
        attribute("profiling.data.format").alias("format"),
        attribute("profiling.data.type").alias("data_type"),
        attribute("profiling.data.total.frame.count").alias("total_frames"),
    )


@query
def profile_records(spark, folder):
    return _record_columns(counted(ticked(spark, folder, taken=deep_samples)))


@query
def all_profile_records(spark, folder):
    return _record_columns(counted(all_ticked(spark, folder, taken=deep_samples)))


PART = ["service", "instance", "tick_ts", "part"]


@query
def profile_strings(spark, folder):
    base = profiles.together(numbered(spark, folder))
    return profiles.strings(base, profiles.first_seen(base)).select(*PART, "string_id", "token")


@query
def profile_functions(spark, folder):
    seen = profiles.first_seen(profiles.together(numbered(spark, folder)), with_strings=False)
    return profiles.functions(seen).select(*PART, "function_id", "file", "func")


@query
def profile_locations(spark, folder):
    seen = profiles.first_seen(profiles.together(numbered(spark, folder)), with_strings=False)
    return profiles.locations(seen).select(*PART, "location_id", "file", "func", "line")


@query
def profile_samples(spark, folder):
    return profiles.samples(profiles.together(numbered(spark, folder))).select(
        *PART, "sample_id", F.col("sample").cast("long").alias("sample"), "tid",
        "trace_id", "span_id", F.array_join("location_ids", ",").alias("location_ids"),
    )


@query
def profile_labels(spark, folder):
    base = profiles.together(numbered(spark, folder))
    found = profiles.strings(base, profiles.first_seen(base)).where("in_labels")
    strings = session.written(found, "label-strings")
    encoded = profiles.labels(base, strings, profiles.PERIOD_MILLIS[profiles.CONTINUOUS])
    return profiles.resolve_labels(encoded, strings).select(
        *PART, F.col("sample").cast("long").alias("sample"), "key", "text", "num"
    )


CONTINUOUS_MS = profiles.PERIOD_MILLIS[profiles.CONTINUOUS]
SNAPSHOT_MS = profiles.PERIOD_MILLIS[profiles.SNAPSHOT]


@query
def function_times(spark, folder):
    """Where traced work spends its time."""
    busy = traced(spark, folder).filter(F.col("trace_id").isNotNull())
    return callgraph.function_times(stacks.unpacked(busy), CONTINUOUS_MS)


@query
def call_edges(spark, folder):
    return callgraph.call_edges(stacks.unpacked(snapshot(spark, folder)), SNAPSHOT_MS)


@query
def folded_stacks(spark, folder):
    return callgraph.folded_stacks(samples(spark, folder), CONTINUOUS_MS)


@query
def span_profiles(spark, folder):
    labelled = traced(spark, folder).withColumns(
        {"trace_id": ids.trace_label(F.col("trace_id")), "span_id": ids.span_label(F.col("span_id"))}
    )
    return correlate.span_profiles(tables.event_spans(spark, folder), labelled, CONTINUOUS_MS)


@query
def spans_without_stacks(spark, folder):
    return correlate.spans_without_stacks(tracked(spark, folder), snapshot(spark, folder)).select(
        "service", "instance", "trace_id", "span_id"
    )


@query
def entry_spans(spark, folder):
    return spans.entry_spans(tables.order_spans(spark, folder)).select("service", "trace_id", "span_id")


@query
def resolved_parents(spark, folder):
    """Entry spans where the exporter left out whether the parent is remote."""
    found = spans.resolve_parents(tables.order_spans(spark, folder).drop("parent_is_remote"))
    return spans.entry_spans(found).select("service", "trace_id", "span_id")


@query
def selected_spans(spark, folder):
    return tracked(spark, folder).select(
        "service", "instance", "trace_id", "span_id",
        F.element_at("attributes", spans.SELECTION_ATTRIBUTE).alias("mark"),
    )


@query
def span_counts(spark, folder):
    return spans.span_counts(tables.order_spans(spark, folder))


@query
def trace_volume(spark, folder):
    return tables.trace_baggage(spark, folder).select(
        "o_orderkey", "trace_id", "baggage",
        sampling.trace_volume(F.col("baggage"), F.col("trace_id"), 0.5).alias("volume"),
    )


@query
def random_selection(spark, folder):
    """Requests without a valid trace id: an upstream decision, or else a coin."""
    key = F.col("o_orderkey")
    understood = F.when(F.col("baggage").isin(sampling.SELECTED, sampling.NOT_SELECTED), F.col("baggage"))
    volume = sampling.trace_volume(understood, F.lit("0" * 32), 0.5, request=key, seed=7)
    return tables.trace_baggage(spark, folder).select("o_orderkey", volume.alias("volume"))


@query
def normalised_ids(spark, folder):
    """Ids as labels write them, and widened again."""
    trace, span = ids.trace_label(F.col("trace_id")), ids.span_label(F.col("span_id"))
    return tables.order_spans(spark, folder).select(
        "trace_id", "span_id",
        trace.alias("trace_label"), span.alias("span_label"),
        ids.trace_hex(trace).alias("trace_hex"), ids.span_hex(span).alias("span_hex"),
    )


@query
def server_timing(spark, folder):
    """Response headers; the first span of a trace stands for a request without a valid one."""
    return tables.order_spans(spark, folder).select(
        "trace_id", "parent_span_id",
        ids.server_timing(F.col("trace_id"), F.col("parent_span_id")).alias("header"),
    )


@query
def response_headers(spark, folder):
    """One row per header of a response."""
    headers = ids.response_headers(F.col("trace_id"), F.col("parent_span_id"))
    return tables.order_spans(spark, folder).select("trace_id", "span_id", F.explode(headers).alias("name", "value"))


@query
def flatten_scope_logs(spark, folder):
    flat = logs.flatten_logs(tables.log_exports(spark, folder), "doc_id")
    return flat.select(
        "doc_id", "scope", F.col("position").cast("long").alias("position"),
        F.col("resource").getItem("lang").alias("lang"), "body",
    )


@query
def flatten_spans(spark, folder):
    flat = logs.flatten_spans(tables.span_exports(spark, folder))
    return plain(flat, "start_ts", "end_ts").select(
        F.col("resource").getItem("service.name").alias("service"), "scope", "name", "trace_id", "span_id", "parent_span_id",
        "start_ns", "end_ns", "start_ts", "end_ts", F.col("attributes").getItem("remote").alias("remote"),
    )


@query
def exported_span_counts(spark, folder):
    """Spans counted by service, straight from the requests."""
    flat = logs.flatten_spans(tables.span_exports(spark, folder))
    return spans.span_counts(flat.select(F.col("resource").getItem("service.name").alias("service")))


@query
def flatten_metrics(spark, folder):
    flat = logs.flatten_metrics(tables.metric_exports(spark, folder), "event_id")
    return flat.select(
        "event_id", F.col("resource").getItem("service.name").alias("service"), "scope", "metric", "unit", "kind", "temporality",
        "is_monotonic", F.col("position").cast("long").alias("position"), "time_ns", "value", "int_value", "count", "total",
        F.array_join(F.transform("bounds", lambda b: F.format_string("%.1f", b)), ",").alias("bounds"),
        F.array_join(F.col("buckets").cast("array<string>"), ",").alias("buckets"), F.col("attributes").getItem("user").alias("user"),
    )


ROUTES = {"deps": "dependency-reports"}


@query
def route_logs(spark, folder):
    return tables.log_records(spark, folder).select(
        "event_id", "scope", logs.route_of(F.col("scope"), ROUTES).alias("route")
    )


@query
def scope_records(spark, folder):
    found = logs.in_scope(tables.log_records(spark, folder), "app", "event.name", "click")
    return found.select("event_id", "service", F.col("attributes").getItem("k").alias("k"))


METRICS = ("process.a.f", "process.n.o", "process.r.f", "process.r.o", "system.cpu.time")


@query
def metric_presence(spark, folder):
    return logs.metric_presence(tables.metrics(spark, folder), METRICS)


@query
def package_names(spark, folder):
    return reports.package_names(tables.package_reports(spark, folder))


@query
def reports_complete(spark, folder):
    return reports.completeness(tables.package_reports(spark, folder))


@query
def report_packages(spark, folder):
    return reports.reassemble(tables.package_reports(spark, folder)).withColumn(
        "position", F.col("position").cast("long")
    )


@query
def limit_links(spark, folder):
    links = F.split("text", " ")
    return tables.table(spark, folder, "documents").select(
        "doc_id", F.size(links).cast("long").alias("links"),
        limits.limit_links(links).alias("_kept"),
    ).select(
        "doc_id", "links", F.size("_kept").cast("long").alias("kept"),
        F.element_at("_kept", -1).alias("last"),
    )


@query
def limit_attributes(spark, folder):
    attributes = F.create_map(F.lit("lang"), F.col("lang"), F.lit("text"), F.col("text"))
    return tables.table(spark, folder, "documents").select(
        "doc_id", F.explode(limits.limit_values(attributes)).alias("key", "value")
    )


def process_config(spark: SparkSession, folder: str) -> DataFrame:
    return config.apply_distribution(config.per_process(tables.config_entries(spark, folder)))


@query
def effective_config(spark, folder):
    return config.effective(tables.config_entries(spark, folder))


@query
def resolved_endpoints(spark, folder):
    return config.resolved_endpoints(process_config(spark, folder))


@query
def typed_config(spark, folder):
    return config.typed(config.per_process(tables.config_entries(spark, folder)))


@query
def unreadable_settings(spark, folder):
    return config.read_warnings(config.per_process(tables.config_entries(spark, folder)))


@query
def config_report(spark, folder):
    return config.report(process_config(spark, folder))


@query
def config_report_parse(spark, folder):
    parsed = config.parse_properties(config.report(process_config(spark, folder)), "report", "process")
    return parsed.withColumn("line", F.col("line").cast("long"))


@query
def config_warnings(spark, folder):
    return process_config(spark, folder).select("process", "service_name_missing", "realm_ignored")


@query
def resource_attributes(spark, folder):
    """Resource attribute lists with the distribution's own entries, taken apart again."""
    return process_config(spark, folder).select(
        "process", F.inline(text.pairs(F.col("resource_attributes")))
    )


@query
def disabled_flags(spark, folder):
    instrumentations = ("flask", "furniture", "machinery")
    return tables.memberships(spark, folder).select(
        "c_custkey",
        *[text.is_listed(F.lit(name), F.col("disabled")).alias(name) for name in instrumentations],
    )


@query
def sanitised_endpoints(spark, folder):
    return tables.endpoints(spark, folder).select(
        "page_id", endpoints.sanitise(F.col("endpoint")).alias("endpoint")
    )


@query
def encoded_attributes(spark, folder):
    return attributes.encode(tables.typed_attributes(spark, folder))


@query
def unsupported_attributes(spark, folder):
    return attributes.unsupported(tables.typed_attributes(spark, folder)).select("p_partkey", "warning")


@query
def encoded_variants(spark, folder):
    return attributes.encode_variants(tables.variant_attributes(spark, folder))


@query
def unsupported_variants(spark, folder):
    return attributes.unsupported_variants(tables.variant_attributes(spark, folder)).select("p_partkey", "warning")


@query
def attribute_partition(spark, folder):
    resource = tables.resource_maps(spark, folder)

    def listed(column):
        entries = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
        return F.array_join(F.array_sort(entries), ";")

    return resource.select(
        "p_partkey",
        listed(attributes.identifying(F.col("attributes"))).alias("identifying"),
        listed(attributes.describing(F.col("attributes"))).alias("describing"),
    )


# Neutral stand-ins for package families and the places their sources live.
SOURCE_RULES = [
    ("exact", "standard", "https://example.org/core/{name}"),
    ("prefix", "sma", "https://example.org/exporters/{name}"),
    ("exact", "promo", "https://example.org/contrib"),
    ("prefix", "s", "https://example.org/other/{name}"),
]
SUMMARIES = [
    inventory.Summary("Core", "standard", "https://example.org/core", always_stable=True),
    inventory.Summary("Contrib", "promo", "https://example.org/contrib"),
]


@query
def requirements_parsed(spark, folder):
    return inventory.parse_requirements(tables.requirements(spark, folder), SOURCE_RULES)


@query
def dependency_inventory(spark, folder):
    return inventory.dependencies(tables.requirements(spark, folder), SUMMARIES, SOURCE_RULES)


@query
def catalogue(spark, folder):
    return inventory.catalogue(tables.manifests(spark, folder), ["lib-1", "lib-2"]).withColumn(
        "position", F.col("position").cast("long")
    )


@query
def inventory_counts(spark, folder):
    return inventory.counts(
        {
            "dependencies": inventory.dependencies(tables.requirements(spark, folder), SUMMARIES),
            "instrumentations": inventory.instrumentations(tables.manifests(spark, folder)),
            "settings": tables.config_entries(spark, folder).select("key").distinct(),
        }
    )


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    return profile_log.decode(profile_log.log_records(ticked(spark, folder), part_samples=PART_SAMPLES))


def _read_back(decoded: DataFrame) -> DataFrame:
    lines = F.transform("frames", lambda f: F.concat_ws(":", f["file"], f["func"], f["line"].cast("string")))
    return decoded.select(
        *PART, "source", F.col("sample").cast("long").alias("sample"), "time_ms", "period_ms", "tid",
        ids.trace_hex(F.col("trace_id")).alias("trace_id"), ids.span_hex(F.col("span_id")).alias("span_id"),
        F.size("frames").cast("long").alias("depth"), F.md5(F.array_join(lines, "\n")).alias("stack"),
    )


@query
def profile_roundtrip(spark, folder):
    """Samples encoded into log records and read back."""
    return _read_back(decoded(spark, folder))


@query
def all_profiles_roundtrip(spark, folder):
    """Continuous and snapshot samples encoded together, each with its own period, second by second."""
    records = profile_log.log_records(all_ticked(spark, folder), part_samples=PART_SAMPLES)
    return _read_back(profile_log.decode(records))


@query
def dated_records(spark, folder):
    """Records written by date, one batch twice over, and the first week of them read back."""
    path = session.new_folder(spark, "dated-records")
    narrow = profile_log.encode(profiles.number_samples(ticked(spark, folder, SECOND), PART_SAMPLES), ranged=True)
    records = session.written(profiles.with_attributes(narrow), "records")
    early = F.col("tick_ts") < F.lit("2024-01-05").cast("timestamp_ntz")
    for batch, chosen in enumerate((early, ~early, ~early)):
        profile_log.write(records.where(chosen), path, batch=min(batch, 1), spread=False)
    found = profile_log.read(spark, path, "2024-01-03", "2024-01-08")
    return found.groupBy("date", "service", "source").agg(F.count("*").alias("records"), F.sum("samples").alias("samples"))


@query
def read_profile_log(spark, folder):
    """Written records of a week, decoded by a data source that opens the files of these days only."""
    path = session.new_folder(spark, "profile-log")
    profile_log.write(profile_log.log_records(ticked(spark, folder), part_samples=PART_SAMPLES, ranged=True), path, spread=False)
    profile_source.register(spark)
    found = spark.read.format("profile_records").load(path)
    week = found.where((F.col("date") >= F.lit("2024-01-03").cast("date")) & (F.col("date") < F.lit("2024-01-10").cast("date")))
    return _read_back(plain(week, "tick_ts"))


# A compressed file is read by one task, so it holds this many samples at most.
LANDED_SAMPLES = 50_000


@query
def landed_frames(spark, folder):
    """Samples landed as compressed JSON lines, read with the declared schema."""
    path = session.new_folder(spark, "landed-samples")
    lines = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "maxRecordsPerFile": LANDED_SAMPLES}
    tables.stack_samples(spark, folder).write.options(**lines).json(path, compression="gzip")
    landed_rows = context.exclude_sampler_thread(landed.read(spark, "stack_samples", path, "json"))
    return plain(landed_rows, "ts").select(
        "service", "instance", "sample_id", "tid", "ts", F.posexplode("frames").alias("depth", "frame")
    ).select(
        "service", "instance", "sample_id", "tid", "ts", F.col("depth").cast("long").alias("depth"),
        "frame.file", "frame.func", F.col("frame.line").cast("long").alias("line"),
    )


@query
def profile_quality(spark, folder):
    return quality.violations(decoded(spark, folder)).select(*PART, F.col("sample").cast("long").alias("sample"), "rule")


@query
def decode_reports(spark, folder):
    """Report fragments encoded as log bodies and read back."""
    fragments = report_log.decode(report_log.encode(tables.package_reports(spark, folder)))
    return fragments.select(
        "id", "fragment_index", "max_fragments", "is_done",
        F.array_join(F.transform("packages", lambda p: p["name"]), ",").alias("packages"),
        reports.is_valid().alias("valid"),
    )


def plain(df: DataFrame, *times: str) -> DataFrame:
    """Times without a zone, as the tables have them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


@query
def stream_samples_with_context(spark, folder):
    session.prepare(spark, streaming=True)
    changes = context.context_changes(tables.context_events(spark, folder))
    taken = samples(spark, folder).drop("frames")
    both = sinks.Replay(taken, "samples", "ts"), sinks.Replay(changes, "changes", "ts")
    out = stream_context.attach_context(both[0].stream, both[1].stream, sinks.delay_of(*both))
    return plain(sinks.drain(out, "context", *both), "ts").select(
        "service", "instance", "tid", "ts", "sample_id", "trace_id", "span_id"
    )


@query
def stream_snapshot_samples(spark, folder):
    session.prepare(spark, streaming=True)
    taken = traced(spark, folder).drop("frames")
    chosen = tracked(spark, folder).select("service", "instance", "trace_id", "span_id", "start_ts", "end_ts")
    both = sinks.Replay(taken, "samples", "ts"), sinks.Replay(chosen, "spans", "start_ts", "end_ts")
    out = stream_context.keep_tracked(both[0].stream, both[1].stream, sinks.delay_of(*both))
    return plain(sinks.drain(out, "tracked", *both), "ts").select(
        "service", "instance", "tid", "ts", "sample_id", "trace_id", "span_id"
    )


@query
def stream_activity(spark, folder):
    session.prepare(spark, streaming=True)
    points = tracked(spark, folder).select("service", "instance", "start_ts")
    starts = sinks.Replay(points, "starts", "start_ts")
    out = windows.activity(starts.stream, 1800, sinks.delay_of(starts))
    return plain(sinks.drain(out, "activity", starts), "start_ts", "end_ts")


@query
def stream_active_intervals(spark, folder):
    session.prepare(spark, streaming=True)
    lasting = tracked(spark, folder, unit_seconds=60).select("service", "instance", "start_ts", "end_ts")
    replayed = sinks.Replay(lasting, "spans", "start_ts")
    out = windows.active_intervals(replayed.stream, delay=sinks.delay_of(replayed, until=windows.NEVER))
    return plain(sinks.drain(out, "active", replayed), "start_ts", "end_ts").drop("spans")


@query
def stream_profile_records(spark, folder):
    """Samples that become records in one stream, and records that are decoded in another."""
    session.prepare(spark, streaming=True)
    replayed = sinks.Replay(traced(spark, folder), "samples", "ts")
    encoded = stream_profiles.records(replayed.stream, profiles.CONTINUOUS, TICK, sinks.delay_of(replayed), part_samples=PART_SAMPLES)
    landed = session.new_folder(spark, "landed-records")
    sinks.drain(encoded, "records", replayed).write.parquet(landed, compression="zstd")
    found = profile_log.decode(spark.readStream.schema(encoded.schema).parquet(landed))
    decoded = sinks.drain(found, "decoded-records").withColumn("part", F.shiftright("part", 16))
    return _read_back(plain(decoded, "tick_ts"))


@query
def late_samples(spark, folder):
    """Samples that arrive in three deliveries; those of the later ones that come behind the watermark
    are told apart from the others, and none is lost."""
    session.prepare(spark, streaming=True)
    path, landed = session.new_folder(spark, "late"), session.new_folder(spark, "deliveries")
    taken = samples(spark, folder).select("service", "instance", "tid", "ts", "sample_id")
    for delivery in range(3):
        taken.where(F.col("sample_id") % 3 == delivery).write.mode("append").parquet(landed)
        arriving = spark.readStream.schema(taken.schema).parquet(landed)
        sinks.split_late(arriving, "ts", "5 days", path, f"{path}-checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select("service", "instance", "tid", "ts", "sample_id", F.col("number").cast("long").alias("batch"), "timing", "behind_seconds")


@query
def stream_ticks(spark, folder):
    taken = samples(spark, folder).select("service", "instance", "ts")
    replayed = sinks.Replay(taken, "samples", "ts")
    out = windows.ticks(replayed.stream, profiles.CONTINUOUS, TICK, sinks.delay_of(replayed))
    return plain(sinks.drain(out, "ticks", replayed), "tick_ts")


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, one file or a folder of part files, as a stream."""
    schema = tables.table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parquet*")


@query
def stream_routes(spark, folder):
    path = session.new_folder(spark, "routes")
    records = tables.log_records_of(stream_of(spark, folder, "events"))
    sinks.write_routes(records, path, f"{path}-checkpoint", ROUTES).awaitTermination()
    return spark.read.parquet(path).select("event_id", "scope", F.col("route").cast("string"))


@query
def stream_sanitised_endpoints(spark, folder):
    sent = tables.endpoints_of(stream_of(spark, folder, "pages"))
    out = sent.select("page_id", endpoints.sanitise(F.col("endpoint")).alias("endpoint"))
    return sinks.drain(out, "endpoints")


@query
def stream_decoded_reports(spark, folder):
    """Encoded report fragments decoded as they arrive."""
    encoded = report_log.encode(tables.package_reports(spark, folder))
    path = session.new_folder(spark, "reports")
    encoded.write.parquet(path)
    found = report_log.decode(spark.readStream.schema(encoded.schema).parquet(path))
    out = found.select(
        "id", "fragment_index", "max_fragments", "is_done",
        F.array_join(F.transform("packages", lambda p: p["name"]), ",").alias("packages"),
        reports.is_valid().alias("valid"),
    )
    return sinks.drain(out, "decoded-reports")
