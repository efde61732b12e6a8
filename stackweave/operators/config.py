"""Effective configuration of every process in a fleet.

Settings arrive as rows (process, key, value), with the time `ts` at which they were told if that
is known. Of a setting that comes more than once the latest counts, whether its name is known or
not. The settings of a process then become one map and a column per known setting; everything
after that is column arithmetic without a shuffle. A missing setting is null, an empty one is ''.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions import endpoints, text

PROCESS = "process"

# Known settings as (property, default, type, category).
SETTINGS = [
    ("traces.exporter", "otlp", "string", "exporter"),
    ("metrics.exporter", "otlp", "string", "exporter"),
    ("logs.exporter", "otlp", "string", "exporter"),
    ("realm", "", "string", "exporter"),
    ("access.token", "", "string", "exporter"),
    ("exporter.otlp.protocol", "", "string", "exporter"),
    ("exporter.otlp.traces.protocol", "", "string", "exporter"),
    ("exporter.otlp.metrics.protocol", "", "string", "exporter"),
    ("exporter.otlp.logs.protocol", "", "string", "exporter"),
    ("exporter.otlp.headers", "", "string", "exporter"),
    ("exporter.otlp.endpoint", "", "string", "exporter"),
    ("exporter.otlp.traces.endpoint", "", "string", "exporter"),
    ("exporter.otlp.metrics.endpoint", "", "string", "exporter"),
    ("exporter.otlp.logs.endpoint", "", "string", "exporter"),
    ("attribute.count.limit", "", "int", "limits"),
    ("attribute.value.length.limit", "12000", "int", "limits"),
    ("span.attribute.count.limit", "", "int", "limits"),
    ("span.event.count.limit", "", "int", "limits"),
    ("event.attribute.count.limit", "", "int", "limits"),
    ("link.attribute.count.limit", "", "int", "limits"),
    ("span.link.count.limit", "1000", "int", "limits"),
    ("experimental.resource.detectors", "host,process", "string", "resource"),
    ("resource.attributes", "", "string", "resource"),
    ("service.name", "unnamed-python-service", "string", "resource"),
    ("traces.sampler", "always_on", "string", "sampler"),
    ("trace.response.header.enabled", "true", "boolean", "trace propagation"),
    ("system.metrics.enabled", "false", "boolean", "instrumentation"),
    ("disabled.instrumentations", "", "string", "instrumentation"),
    ("profiler.enabled", "false", "boolean", "profiling"),
    ("profiler.call.stack.interval", "1000", "int", "profiling"),
    ("profiler.logs.endpoint", "", "string", "profiling"),
    ("snapshot.profiler.enabled", "false", "boolean", "profiling"),
    ("snapshot.sampling.interval", "10", "int", "profiling"),
    ("snapshot.selection.probability", "0.01", "double", "profiling"),
    ("agent.enabled", "false", "boolean", "agent"),
    ("agent.endpoint", "http://localhost:4320/v1/opamp", "string", "agent"),
    ("agent.polling.interval", "30000", "int", "agent"),
]

# Settings written into the configuration when absent. The others keep their
# default to themselves until they are read.
WRITTEN_DEFAULTS = {
    "traces.exporter": "otlp",
    "metrics.exporter": "otlp",
    "logs.exporter": "otlp",
    "attribute.count.limit": "",
    "span.attribute.count.limit": "",
    "span.event.count.limit": "",
    "event.attribute.count.limit": "",
    "link.attribute.count.limit": "",
    "span.link.count.limit": "1000",
    "attribute.value.length.limit": "12000",
    "experimental.resource.detectors": "host,process",
    "traces.sampler": "always_on",
}
DEFAULT_SERVICE_NAME = "unnamed-python-service"

# Keys of the effective-configuration report, in order.
REPORT_KEYS = (
    "exporter.otlp.traces.endpoint",
    "exporter.otlp.metrics.endpoint",
    "exporter.otlp.logs.endpoint",
    "profiler.enabled",
    "profiler.memory.enabled",
    "snapshot.profiler.enabled",
    "snapshot.profiler.sampling.interval",
    "profiler.call.stack.interval",
    "config.file",
    "experimental.config.file",
)

DEFAULTS = {name: default for name, default, _, _ in SETTINGS}


@dataclass(frozen=True)
class Distribution:
    """What a distribution adds to the configuration on its own account."""

    name: str = "stackweave"
    version: str = "0.1.0"
    ingest_template: str = "https://ingest.{realm}.example.com"
    token_header: str = "x-access-token"


def column(name: str) -> str:
    return name.replace(".", "_")


def setting(name: str) -> Column:
    return F.col(column(name))


def property_name(variable: Column, *prefixes: str) -> Column:
    """Name of the setting behind an environment variable, without the given prefixes."""
    name = F.lower(variable)
    for prefix in prefixes:
        name = F.regexp_replace(name, f"^{prefix.lower()}", "")
    return F.translate(name, "_", ".")


SETTINGS_MAP = "_settings"


def latest(entries: DataFrame) -> DataFrame:
    """One row per process and setting: its value at the latest time, of equal times the greatest
    text. Repeats are dropped before they are grouped, so a process that tells its settings again and
    again does not grow a group. Both times a task sorts what it has; entries are first spread by what
    they say, so that it is no whole file, and no more than a partition of Spark's advised size."""
    at = F.col("ts") if "ts" in entries.columns else F.lit(None).cast("timestamp")
    told = F.struct(at.alias("ts"), F.coalesce("value", F.lit("")).alias("value"))
    named = entries.filter(F.col("key").isNotNull()).select(PROCESS, "key", told.alias("_told"))
    spread = named.hint("rebalance", F.col(PROCESS), F.col("key"), F.col("_told"))
    return spread.groupBy(PROCESS, "key").agg(F.max("_told").alias("_told")).select(PROCESS, "key", "_told.value")


def per_process(entries: DataFrame) -> DataFrame:
    """One row per process: all settings as a map, and one column per known setting."""
    listed = latest(entries).groupBy(PROCESS).agg(F.collect_list(F.struct("key", "value")).alias("_listed"))
    mapped = listed.select(PROCESS, F.map_from_entries("_listed").alias(SETTINGS_MAP))
    own = [F.col(SETTINGS_MAP).getItem(name).alias(column(name)) for name in DEFAULTS]
    return mapped.select(PROCESS, SETTINGS_MAP, *own)


def apply_distribution(config: DataFrame, distribution: Distribution = Distribution()) -> DataFrame:
    """Complete a configuration the way a distribution does at start-up.

    In order: absent defaults, service name, profiling log endpoint (overwrites), resource
    attributes (appended), realm (absent only), token header (appended).
    """
    filled = config.withColumns(
        {column(name): F.coalesce(setting(name), F.lit(value)) for name, value in WRITTEN_DEFAULTS.items()}
    )
    unnamed = text.present(setting("service.name")).isNull()
    profiling = text.is_true(setting("profiler.enabled")) | text.is_true(
        setting("snapshot.profiler.enabled")
    )
    own_logs = text.present(setting("profiler.logs.endpoint"))
    told = text.append(
        text.append(
            setting("resource.attributes"), F.lit(f"telemetry.distro.name={distribution.name}")
        ),
        F.lit(f"telemetry.distro.version={distribution.version}"),
    )
    realm = endpoints.valid_realm(setting("realm"))
    asked = text.present(text.strip(setting("realm")))
    token = text.present(text.strip(setting("access.token")))

    def for_realm(signal: str) -> Column:
        return F.coalesce(
            setting(f"exporter.otlp.{signal}.endpoint"),
            endpoints.realm_endpoint(realm, signal, distribution.ingest_template),
        )

    return filled.withColumns(
        {
            "service_name_missing": unnamed,
            "realm_ignored": asked.isNotNull() & realm.isNull(),
            "service_name": F.when(unnamed, DEFAULT_SERVICE_NAME).otherwise(setting("service.name")),
            "exporter_otlp_logs_endpoint": F.when(
                profiling & own_logs.isNotNull(), own_logs
            ).otherwise(setting("exporter.otlp.logs.endpoint")),
            "resource_attributes": told,
            "exporter_otlp_traces_endpoint": for_realm("traces"),
            "exporter_otlp_metrics_endpoint": for_realm("metrics"),
            "exporter_otlp_protocol": F.coalesce(
                setting("exporter.otlp.protocol"), F.when(realm.isNotNull(), endpoints.HTTP_PROTOCOL)
            ),
            "exporter_otlp_headers": F.when(
                token.isNotNull(),
                text.append(
                    setting("exporter.otlp.headers"),
                    F.concat(F.lit(f"{distribution.token_header}="), token),
                ),
            ).otherwise(setting("exporter.otlp.headers")),
        }
    )


def effective(entries: DataFrame, distribution: Distribution = Distribution()) -> DataFrame:
    """All settings of every process after start-up, unknown ones unchanged."""
    config = apply_distribution(per_process(entries), distribution)
    known = F.array(*[F.struct(F.lit(name).alias("key"), setting(name).alias("value")) for name in DEFAULTS])
    others = F.map_entries(F.map_filter(SETTINGS_MAP, lambda key, _: ~key.isin(*DEFAULTS)))
    return config.select(PROCESS, F.inline(F.concat(known, others))).filter(F.col("value").isNotNull())


def signal_endpoint(signal: str) -> Column:
    return endpoints.resolve(
        signal,
        setting(f"exporter.otlp.{signal}.endpoint"),
        setting("exporter.otlp.endpoint"),
        setting(f"exporter.otlp.{signal}.protocol"),
        setting("exporter.otlp.protocol"),
        setting(f"{signal}.exporter"),
    )


def resolved_endpoints(config: DataFrame) -> DataFrame:
    """The endpoint of every signal, one row per process and signal."""
    listed = F.array(
        *[
            F.struct(F.lit(signal).alias("signal"), signal_endpoint(signal).alias("endpoint"))
            for signal in endpoints.SIGNALS
        ]
    )
    return config.select(PROCESS, F.inline(listed))


SPARK_TYPES = {"int": "bigint", "double": "double", "boolean": "boolean"}
TYPED = {name: kind for name, _, kind, _ in SETTINGS if kind in SPARK_TYPES}


def _unreadable(name: str) -> Column:
    """Told, but not a number of the declared type. A limit without a default may be empty, which is no limit."""
    value = setting(name) if DEFAULTS[name] else text.present(setting(name))
    return text.is_bad(value, SPARK_TYPES[TYPED[name]])


def _read(name: str) -> Column:
    """A setting as its declared type; its declared default, or null, where it is absent or unreadable."""
    kind, default = TYPED[name], DEFAULTS[name]
    if kind == "boolean":
        return text.is_true(F.coalesce(setting(name), F.lit(default)))
    return F.coalesce(setting(name).try_cast(SPARK_TYPES[kind]), F.lit(default or None).cast(SPARK_TYPES[kind]))


def typed(config: DataFrame) -> DataFrame:
    """Every declared number and flag as its type, and which of the numbers could not be read."""
    numbers = [name for name, kind in TYPED.items() if kind != "boolean"]
    bad = F.array_compact(F.array(*[F.when(_unreadable(name), F.lit(name)) for name in numbers]))
    polling = _read("agent.polling.interval")
    values = {column(name): _read(name) for name in TYPED}
    values["agent_polling_interval"] = F.when(polling > 0, polling).otherwise(
        F.lit(int(DEFAULTS["agent.polling.interval"])).cast("bigint")
    )
    return config.select(
        PROCESS,
        *[value.alias(name) for name, value in values.items()],
        (polling <= 0).alias("polling_interval_not_positive"),
        F.array_join(bad, ",").alias("unreadable"),
    )


def read_warnings(config: DataFrame) -> DataFrame:
    """One row for every number that could not be read: process, key, value, and the warning."""
    listed = F.array(*[
        F.when(
            _unreadable(name),
            F.struct(F.lit(name).alias("key"), setting(name).alias("value"), F.lit(kind).alias("type"), F.lit(DEFAULTS[name]).alias("used")),
        )
        for name, kind in TYPED.items() if kind != "boolean"
    ])
    return config.select(PROCESS, F.inline(F.array_compact(listed))).withColumn(
        "warning", F.format_string("setting %s: %s is no %s", "key", "value", "type")
    )


def report(config: DataFrame) -> DataFrame:
    """The effective-configuration report of every process as properties text."""
    def truth(name: str) -> Column:
        return F.when(text.is_true(setting(name)), "true").otherwise("false")

    def whole(name: str) -> Column:
        return text.as_int(setting(name), int(DEFAULTS[name])).cast("string")

    values = {
        "exporter.otlp.traces.endpoint": endpoints.sanitise(signal_endpoint("traces")),
        "exporter.otlp.metrics.endpoint": endpoints.sanitise(signal_endpoint("metrics")),
        "exporter.otlp.logs.endpoint": endpoints.sanitise(signal_endpoint("logs")),
        "profiler.enabled": truth("profiler.enabled"),
        "profiler.memory.enabled": F.lit("false"),
        "snapshot.profiler.enabled": truth("snapshot.profiler.enabled"),
        "snapshot.profiler.sampling.interval": whole("snapshot.sampling.interval"),
        "profiler.call.stack.interval": whole("profiler.call.stack.interval"),
        "config.file": F.lit("null"),
        "experimental.config.file": F.lit("null"),
    }
    lines = [F.concat(F.lit(f"{key}="), values[key]) for key in REPORT_KEYS]
    return config.select(PROCESS, F.concat_ws("\n", *lines).alias("report"))


def parse_properties(texts: DataFrame, column_name: str = "report", *keep: str) -> DataFrame:
    """Properties text as rows; a line is split at its first `=`."""
    lines = F.posexplode(F.split(column_name, "\n")).alias("line", "_text")
    return (
        texts.select(*keep, lines)
        .filter(F.col("_text").contains("="))
        .select(
            *keep,
            "line",
            F.substring_index("_text", "=", 1).alias("key"),
            F.regexp_extract("_text", "(?s)^[^=]*=(.*)$", 1).alias("value"),
        )
    )
