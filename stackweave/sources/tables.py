"""Telemetry-shaped views over the star-schema tables.

Landed telemetry has these shapes; here they are derived from orders, events and texts, so
that every operator can be run, and checked, at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stackweave.functions import sampling
from stackweave.sources import landed

EVENT_SERVICES = 5
INSTANCES = 2
SPAN_SERVICES = 3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _service(key: str, count: int) -> Column:
    return F.concat(F.lit("svc"), (F.col(key) % count).cast("string"))


def _process_and_thread() -> list[Column]:
    """Service, instance and thread of a user; all instances have the same thread ids."""
    user = F.col("user_id")
    instance = F.floor(user / EVENT_SERVICES) % INSTANCES
    return [
        _service("user_id", EVENT_SERVICES).alias("service"),
        F.concat(F.lit("i"), instance.cast("string")).alias("instance"),
        F.floor(user / (EVENT_SERVICES * INSTANCES)).alias("tid"),
    ]


def _hex(prefix: str, *parts: Column | str) -> Column:
    return F.md5(F.concat(F.lit(prefix), *parts))


def context_events(spark: SparkSession, folder: str) -> DataFrame:
    """Attach and detach events of threads.

    Views and purchases attach a span, clicks attach a context without one, even sign-ups
    detach to an earlier span and odd sign-ups detach to nothing.
    """
    spanned = F.col("event_type").isin("view", "purchase") | (
        (F.col("event_type") == "signup") & (F.col("event_id") % 2 == 0)
    )
    trace = _hex("t", F.floor(F.col("event_id") / 4).cast("string"))
    span = F.substring(_hex("s", F.col("event_id").cast("string")), 1, 16)
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") != "error")
        .select(
            *_process_and_thread(),
            "ts",
            F.col("event_id").alias("seq"),
            F.when(F.col("event_type") == "signup", "detach").otherwise("attach").alias("kind"),
            F.when(spanned, trace).alias("trace_id"),
            F.when(spanned, span).alias("span_id"),
            "value",
        )
    )


def stack_samples(spark: SparkSession, folder: str) -> DataFrame:
    """One sampled stack per error event, root frame first.

    The frames are the words of a whole document. Words that end a sentence have no line
    number. Each service takes its samples on one thread of its own.
    """
    documents = table(spark, folder, "documents").select(
        "doc_id", "text", F.concat("source", F.lit("/"), "lang").alias("file")
    )
    frames = F.transform(
        F.split("text", " "),
        lambda word: F.struct(
            F.col("file").alias("file"),
            word.alias("func"),
            F.when(~word.endswith("."), F.length(word)).alias("line"),
        ),
    )
    size = documents.select(F.max("doc_id") + 1).scalar()
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "error")
        .select(
            *_process_and_thread(),
            (F.col("user_id") % EVENT_SERVICES).alias("sampler_tid"),
            "ts",
            F.col("event_id").alias("sample_id"),
            (F.col("event_id") % size).alias("doc_id"),
        )
        # Both sides grow with the data; a shuffle also spreads the few text files over all tasks.
        .join(documents.hint("merge"), "doc_id")
        .select("service", "instance", "tid", "sampler_tid", "ts", "sample_id", frames.alias("frames"))
    )


def event_spans(
    spark: SparkSession, folder: str, probability: float = 0.5, unit_seconds: int = 3600
) -> DataFrame:
    """Spans opened by attach events; the earliest of a trace is its entry span.

    They last `value` units of time. Some never end, some end as they start, and some end before.
    """
    opened = context_events(spark, folder).filter(
        (F.col("kind") == "attach") & F.col("trace_id").isNotNull()
    )
    first = opened.groupBy("trace_id").agg(F.min("ts").alias("_first"))
    case = F.col("seq") % 40
    seconds = F.when(case == 8, 0).when(case == 9, -10).otherwise(F.floor(F.col("value") * unit_seconds))
    return opened.join(first, "trace_id").select(
        "service",
        "instance",
        "trace_id",
        "span_id",
        F.when(F.col("ts") > F.col("_first"), F.lit("f" * 16)).alias("parent_span_id"),
        F.lit(False).alias("parent_is_remote"),
        F.col("ts").alias("start_ts"),
        F.when(F.col("seq") % 40 != 7, F.col("ts") + F.make_dt_interval(secs=seconds)).alias("end_ts"),
        F.create_map(F.lit("kind"), F.col("kind")).alias("attributes"),
        sampling.trace_volume(F.lit(None), F.col("trace_id"), probability).alias("volume"),
    )


def order_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as traces and their lines as a chain of spans over three services."""
    chain = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_suppkey").alias("l_suppkey"),
            F.min("l_shipdate").alias("l_shipdate"),
            F.min("l_quantity").alias("l_quantity"),
        )
        .withColumn("_line", F.lag("l_linenumber").over(chain))
        .withColumn("_service", F.lag("l_suppkey").over(chain) % SPAN_SERVICES)
    )

    def span(line: str) -> Column:
        number = F.col("l_orderkey").cast("string")
        return F.substring(_hex("l", number, F.lit("-"), F.col(line).cast("string")), 1, 16)

    return lines.select(
        _service("l_suppkey", SPAN_SERVICES).alias("service"),
        _hex("o", F.col("l_orderkey").cast("string")).alias("trace_id"),
        span("l_linenumber").alias("span_id"),
        span("_line").alias("parent_span_id"),
        F.coalesce(F.col("_service") != F.col("l_suppkey") % SPAN_SERVICES, F.lit(False)).alias(
            "parent_is_remote"
        ),
        F.col("l_shipdate").alias("start_ts"),
        (
            F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_quantity").cast("int"))
        ).alias("end_ts"),
    )


def trace_baggage(spark: SparkSession, folder: str) -> DataFrame:
    """The volume decision that reached each order's trace: kept, unknown or absent."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        _hex("o", F.col("o_orderkey").cast("string")).alias("trace_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "bogus")
        .when(F.col("o_orderstatus") == "F", sampling.SELECTED)
        .when(F.col("o_orderstatus") == "O", sampling.NOT_SELECTED)
        .alias("baggage"),
    )


def log_records(spark: SparkSession, folder: str) -> DataFrame:
    return log_records_of(table(spark, folder, "events"))


def log_records_of(events: DataFrame) -> DataFrame:
    """Flat log records of three scopes, with attributes from the event's JSON."""
    props = F.from_json("props", "map<string,string>")
    return events.select(
        "event_id",
        _service("user_id", EVENT_SERVICES).alias("service"),
        F.when(F.col("event_type") == "error", "deps")
        .when(F.col("event_type") == "purchase", "profiling")
        .otherwise("app")
        .alias("scope"),
        F.map_concat(F.create_map(F.lit("event.name"), F.col("event_type")), props).alias("attributes"),
    )


def log_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Nested export requests: a document is a request, its language and source make the
    resource, its table rows and its other lines are the records of two scopes."""
    lines = F.split("text", "\n")

    def scope(name: str, keep) -> Column:
        records = F.transform(
            F.filter(lines, keep), lambda line: F.struct(line.alias("body"), F.length(line).alias("size"))
        )
        return F.struct(F.struct(F.lit(name).alias("name")).alias("scope"), records.alias("log_records"))

    resource = F.struct(
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("attributes")
    )
    scopes = F.array(
        scope("app", lambda line: ~line.contains("|")), scope("deps", lambda line: line.contains("|"))
    )
    return table(spark, folder, "documents").select(
        "doc_id",
        F.array(F.struct(resource.alias("resource"), scopes.alias("scope_logs"))).alias("resource_logs"),
    )


def span_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Nested export requests: an order is a request, each service that takes part in it a resource.
    Ids are bytes, and times nanoseconds, as exporters send them."""
    def unhex(name: str) -> Column:
        return F.coalesce(F.unhex(name), F.lit(b"")).alias(name)

    def nanos(name: str) -> Column:
        return (F.unix_micros(F.col(name).cast("timestamp")) * 1000).alias(name.replace("_ts", "_time_unix_nano"))

    span = F.struct(
        unhex("trace_id"), unhex("span_id"), unhex("parent_span_id"), F.concat(F.lit("line "), F.substring("span_id", 1, 4)).alias("name"),
        nanos("start_ts"), nanos("end_ts"), F.create_map(F.lit("remote"), F.col("parent_is_remote").cast("string")).alias("attributes"),
    )
    of_service = order_spans(spark, folder).groupBy("trace_id", "service").agg(F.collect_list(span).alias("spans"))
    scope = F.struct(F.struct(F.lit("orders").alias("name")).alias("scope"), F.col("spans"))
    resource = F.struct(F.create_map(F.lit("service.name"), F.col("service")).alias("attributes"))
    entry = F.struct(resource.alias("resource"), F.array(scope).alias("scope_spans"))
    return of_service.groupBy("trace_id").agg(F.collect_list(entry).alias("resource_spans")).select("resource_spans")


def metric_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Nested export requests: an event is a request with a metric of the kind that goes with its type:
    gauges of one or two points, growing sums, histograms, and metrics without data."""
    event, value = F.col("event_type"), F.col("value").cast("double")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    attributes = F.create_map(F.lit("user"), F.col("user_id").cast("string"))
    none = F.lit(None)

    def point(as_double: Column, as_int: Column) -> Column:
        return F.struct(nanos, as_double, as_int, attributes)

    whole = (F.col("event_id") % 7).cast("long")
    gauge = F.when(event == "view", F.struct(F.array(point(value, none.cast("long"))))).when(
        event == "error", F.struct(F.array(point(value, none.cast("long")), point(none.cast("double"), whole)))
    )
    total = F.when(event == "click", F.struct(F.array(point(none.cast("double"), whole)), F.lit(2), F.lit(True)))
    histogram = F.when(event == "purchase", F.struct(F.array(F.struct(
        nanos, whole + 1, value, F.array(F.lit(1).cast("long"), whole), F.array(F.lit(10.0)), attributes)), F.lit(1)))
    metric = F.struct(F.concat(F.lit("events."), event), F.lit("1"), gauge, total, histogram).cast(landed.METRIC)
    scope = F.struct(F.struct(F.lit("events").alias("name")).alias("scope"), F.array(metric).alias("metrics"))
    resource = F.struct(F.create_map(F.lit("service.name"), _service("user_id", EVENT_SERVICES)).alias("attributes"))
    return table(spark, folder, "events").select(
        "event_id", F.array(F.struct(resource.alias("resource"), F.array(scope).alias("scope_metrics"))).alias("resource_metrics")
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Exported metric points, named after the return flag and status of order lines."""
    return table(spark, folder, "lineitem").select(
        _service("l_suppkey", 50).alias("service"),
        F.concat(F.lit("process."), F.lower("l_returnflag"), F.lit("."), F.lower("l_linestatus")).alias("metric"),
    )


def package_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Fragments of dependency reports: an order is a report, a line number a fragment."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    package = F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("version"))
    return (
        table(spark, folder, "lineitem")
        .join(parts, "l_partkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.array_sort(F.collect_list(package)).alias("packages"))
        .select(
            F.col("l_orderkey").cast("string").alias("id"),
            (F.col("l_linenumber") - 1).alias("fragment_index"),
            F.lit(7).alias("max_fragments"),
            (F.col("l_linenumber") == 7).alias("is_done"),
            "packages",
        )
    )


def config_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Settings of one process per customer: present, absent, empty and malformed."""
    key = F.col("c_custkey")
    number = key.cast("string")

    def pick(modulus: int, *values: str | Column | None) -> Column:
        chosen = F.lit(None).cast("string")
        for i, value in enumerate(values):
            chosen = F.when(key % modulus == i, value if isinstance(value, Column) else F.lit(value)).otherwise(chosen)
        return chosen

    values = {
        "service.name": pick(4, F.concat(F.lit("svc"), number), "", F.col("c_name")),
        "realm": pick(11, "us2", " eu0 ", "-us2", "us2/anything", "us2:443", ""),
        "access.token": pick(3, F.concat(F.lit(" token"), number), " "),
        "exporter.otlp.endpoint": pick(5, "https://collector:4318", "", "http://gw/", F.concat(F.lit("https://u:p@gw"), number)),
        "exporter.otlp.protocol": pick(6, "http/protobuf", "grpc", "", " http/protobuf "),
        "exporter.otlp.traces.endpoint": pick(7, F.concat(F.lit("https://a:b@traces"), number, F.lit("/v1/traces?token=x#y")), ""),
        "exporter.otlp.metrics.protocol": pick(4, "http/protobuf", "", "grpc"),
        "exporter.otlp.headers": pick(3, "a=1", "", "a=1,b=2"),
        "logs.exporter": pick(5, "otlp_proto_http", "none", " otlp_proto_http "),
        "profiler.enabled": pick(4, " TRUE ", "true", "yes"),
        "profiler.logs.endpoint": pick(3, "http://profiles:4318/v1/logs", ""),
        "profiler.call.stack.interval": pick(6, "500", "abc", "", " 250 ", "1.5"),
        "snapshot.profiler.enabled": pick(5, "True", "false", "1"),
        "snapshot.sampling.interval": pick(4, "25", "x", "-3"),
        "snapshot.selection.probability": pick(5, "0.5", "1", "half", ""),
        "agent.polling.interval": pick(5, "0", "-5", "60000", "soon"),
        "resource.attributes": pick(4, "team=a", "", "team=b,env=prod=x"),
        "disabled.instrumentations": pick(6, "logging", "requests, logging , flask", "*", "requests,flask", ""),
        "span.link.count.limit": pick(5, "10", ""),
        "attribute.count.limit": pick(4, "64", "", "many"),
        "system.metrics.enabled": pick(3, "true", " True"),
        "custom.setting": pick(2, F.col("c_mktsegment")),
    }
    # Some settings were told before with another value, and are told again.
    told = F.to_timestamp(F.lit("2024-03-01")) + F.make_dt_interval(hours=(key % 50).cast("int"))
    before = {"profiler.call.stack.interval": "77777", "snapshot.selection.probability": "zzz", "custom.setting": "zzz"}
    rows = [F.struct(F.lit(k).alias("key"), v.alias("value"), told.alias("ts")) for k, v in values.items()]
    rows += [
        F.struct(
            F.lit(k).alias("key"), F.when((key % 3 == 0) & values[k].isNotNull(), F.lit(v)).alias("value"),
            (told - F.make_dt_interval(days=F.lit(1))).alias("ts"),
        )
        for k, v in before.items()
    ]
    return (
        table(spark, folder, "customer")
        .select(F.concat(F.lit("p"), number).alias("process"), F.inline(F.array(*rows)))
        .filter(F.col("value").isNotNull())
    )


def requirements(spark: SparkSession, folder: str) -> DataFrame:
    """One requirement per part; a brand is a project."""
    size = F.col("p_size").cast("string")
    form = F.col("p_size") % 5
    text = (
        F.when(form == 0, F.concat(F.lit("==1.2."), size))
        .when(form == 1, F.concat(F.lit(" >= 0.4b"), size, F.lit(" , < 9")))
        .when(form == 2, F.concat(F.lit("~="), size, F.lit(" ; python_version < '3.13'")))
        .when(form == 3, F.concat(F.lit("[extra]==1.0RC"), size))
        .otherwise(F.lit(""))
    )
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("project"),
        F.col("p_partkey").alias("ord"),
        F.concat(F.lower("p_type"), text).alias("requirement"),
    )


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Package manifests from parts, some without requirements or entry points."""
    words = F.split("p_name", " ")
    size = F.col("p_size").cast("string")
    first = F.concat(words[0], F.lit(" >= 1."), size)
    both = F.array(F.concat(words[0], F.lit(" ~= 1.0")), F.concat(words[1], F.lit(" ~= "), size))
    none = F.array().cast("array<string>")
    target = F.concat(F.lit("pkg:"), F.col("p_brand"))
    return table(spark, folder, "part").select(
        F.concat(F.lit("lib-"), F.col("p_partkey").cast("string")).alias("name"),
        F.when(F.col("p_size") % 4 != 3, F.col("p_brand")).alias("description"),
        F.when(F.col("p_size") % 3 == 0, F.array(first)).when(F.col("p_size") % 3 == 1, none).alias("instruments"),
        F.when(F.col("p_partkey") % 2 == 0, both).alias("instruments_any"),
        F.when(F.col("p_size") % 5 == 0, F.create_map().cast("map<string,string>"))
        .when(F.col("p_size") % 5 == 1, F.create_map(words[1], target))
        .otherwise(F.create_map(F.concat(words[1], F.lit("-b")), target, F.concat(words[0], F.lit("-a")), target))
        .alias("entry_points"),
    )


def typed_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Resource attributes of mixed types, one resource per part."""
    def row(key: str, kind: str, value: Column | None = None, item_type: str | None = None, items: Column | None = None) -> Column:
        return F.struct(
            F.lit(key).alias("key"),
            F.lit(kind).alias("type"),
            (F.lit(None) if value is None else value).cast("string").alias("value"),
            F.lit(item_type).cast("string").alias("item_type"),
            (F.lit(None) if items is None else items).cast("array<string>").alias("items"),
        )

    size = F.col("p_size").cast("string")
    listed = F.array(
        row("service.name", "string", F.lower("p_brand")),
        row("service.namespace", "string", F.lower("p_type")),
        row("service.instance.id", "string", F.col("p_partkey")),
        row("process.pid", "int", F.col("p_size")),
        row("host.name", "string", F.concat(F.lit("host-"), size)),
        row("custom.flag", "bool", F.when(F.col("p_size") > 25, "true").otherwise("false")),
        row("custom.words", "list", item_type="string", items=F.split("p_name", " ")),
        row("custom.ports", "list", item_type="int", items=F.array(F.lit("4317"), F.lit(None).cast("string"), size)),
        row("custom.flags", "list", item_type="bool", items=F.array(F.lit("true"), F.lit(None).cast("string"))),
        row("custom.missing", "list", item_type="int"),
        row("custom.mapping", "map", F.lit("{}")),
    )
    return table(spark, folder, "part").select("p_partkey", F.inline(listed))


def variant_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Resource attributes as variants: lists of items of several types, nested lists, mappings."""
    size, name = F.col("p_size").cast("string"), F.element_at(F.split("p_name", " "), 1)
    texts = {
        "service.name": F.concat(F.lit('"'), F.lower("p_brand"), F.lit('"')),
        "process.pid": size,
        "custom.share": F.concat(size, F.lit(".5")),
        "custom.flag": F.when(F.col("p_size") > 25, "true").otherwise("false"),
        "custom.mixed": F.concat(F.lit('[ 1, "'), name, F.lit('é", true, null, 2.5, ['), size, F.lit(', "x"] ]')),
        "custom.objects": F.concat(F.lit('[{"k": '), size, F.lit("}]")),
        "custom.empty": F.lit("[]"),
        "custom.mapping": F.concat(F.lit('{"k": '), size, F.lit("}")),
        "custom.missing": F.lit("null"),
    }
    listed = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("text")) for k, v in texts.items()])
    rows = table(spark, folder, "part").select("p_partkey", F.inline(listed))
    return rows.select("p_partkey", "key", F.parse_json("text").alias("value"))


def resource_maps(spark: SparkSession, folder: str) -> DataFrame:
    """The same kind of attributes as one map per resource."""
    return table(spark, folder, "part").select(
        "p_partkey",
        F.create_map(
            F.lit("service.name"), F.lower("p_brand"),
            F.lit("service.instance.id"), F.col("p_partkey").cast("string"),
            F.lit("process.pid"), F.col("p_size").cast("string"),
            F.lit("host.name"), F.col("p_name"),
        ).alias("attributes"),
    )


def memberships(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of disabled instrumentations, with stray blanks and the wildcard."""
    key = F.col("c_custkey")
    segment = F.lower("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 7 == 0, "*")
        .when(key % 7 == 1, F.concat(F.lit("requests, "), segment, F.lit(" ,flask")))
        .when(key % 7 == 2, "")
        .when(key % 7 == 3, F.concat(segment, F.lit("x,y"), segment))
        .when(key % 7 == 4, F.concat(segment, F.lit(", *")))
        .otherwise(segment)
        .alias("disabled"),
    )


def endpoints(spark: SparkSession, folder: str) -> DataFrame:
    return endpoints_of(table(spark, folder, "pages"))


def endpoints_of(pages: DataFrame) -> DataFrame:
    """Page addresses as exporter endpoints, every third one with credentials."""
    return pages.select(
        "page_id",
        F.when(
            F.col("page_id") % 3 == 0, F.replace(F.col("url"), F.lit("://"), F.lit("://user:p@ss@"))
        )
        .otherwise(F.col("url"))
        .alias("endpoint"),
    )
