"""Independent SQL for every registered query, in DuckDB's dialect.

Each statement reads the same tables as its query. The common table expressions restate the
views of `sources.tables` and are shared between statements.
"""

from __future__ import annotations

CONTEXT_EVENTS = """
context_events as (
  select concat('svc', user_id % 5) as service, concat('i', user_id // 5 % 2) as instance, user_id // 10 as tid, ts, event_id as seq,
    case when event_type = 'signup' then 'detach' else 'attach' end as kind,
    case when event_type in ('view', 'purchase') or (event_type = 'signup' and event_id % 2 = 0)
      then md5(concat('t', event_id // 4)) end as trace_id,
    case when event_type in ('view', 'purchase') or (event_type = 'signup' and event_id % 2 = 0)
      then substr(md5(concat('s', event_id)), 1, 16) end as span_id,
    value
  from events where event_type <> 'error')"""

CONTEXT_CHANGES = f"""{CONTEXT_EVENTS},
context_changes as (
  select service, instance, tid, ts, seq, trace_id, span_id from context_events
  where kind = 'detach' or trace_id is not null)"""

STACK_SAMPLES = """
stack_samples as (
  select concat('svc', e.user_id % 5) as service, concat('i', e.user_id // 5 % 2) as instance, e.user_id // 10 as tid, e.ts, e.event_id as sample_id,
    string_split(d.text, ' ') as words, concat(d.source, '/', d.lang) as file
  from events e
  join documents d on d.doc_id = e.event_id % (select max(doc_id) + 1 from documents)
  where e.event_type = 'error' and e.user_id // 10 <> e.user_id % 5)"""

STACK_FRAMES = f"""{STACK_SAMPLES},
stack_words as (
  select service, instance, tid, ts, sample_id, file, len(words) as depth_count,
    unnest(words) as func, unnest(range(len(words))) as depth
  from stack_samples),
stack_frames as (
  select service, instance, tid, ts, sample_id, depth, depth_count - 1 - depth as pos, file, func,
    case when not ends_with(func, '.') then length(func) end as line
  from stack_words)"""

WITH_CONTEXT = f"""{CONTEXT_CHANGES},
{STACK_SAMPLES},
with_context as (
  select s.service, s.instance, s.tid, s.ts, s.sample_id, c.trace_id, c.span_id
  from stack_samples s asof left join context_changes c
    on s.service = c.service and s.instance = c.instance and s.tid = c.tid and s.ts >= c.ts)"""


def _event_spans(unit_seconds: int) -> str:
    return f"""
event_spans as (
  select service, instance, trace_id, span_id, ts as start_ts,
    case when seq % 40 <> 7 then ts + to_seconds(cast(case seq % 40 when 8 then 0 when 9 then -10
      else floor(value * {unit_seconds}) end as bigint)) end as end_ts,
    ts = min(ts) over (partition by trace_id) as is_entry,
    case when substr(trace_id, 17) < '8000000000000000' then 'highest' else 'off' end as volume
  from context_events where kind = 'attach' and trace_id is not null),
tracked as (select * from event_spans where is_entry and volume = 'highest')"""


SNAPSHOT = f"""{WITH_CONTEXT},
{_event_spans(3600)},
snapshot as (
  select * from with_context s where exists (
    select 1 from tracked t where t.service = s.service and t.instance = s.instance and t.trace_id = s.trace_id
      and s.ts >= t.start_ts and (t.end_ts is null or s.ts < t.end_ts)))"""

OPEN_SPANS = f"""
with {CONTEXT_EVENTS},
{_event_spans(3600)},
edges as (
  select service, instance, span_id, start_ts as ts, cast(1 as bigint) as delta from event_spans
  union all
  select service, instance, span_id, greatest(start_ts, end_ts), cast(-1 as bigint) from event_spans where end_ts is not null)
select service, instance, span_id, ts, delta,
  cast(sum(delta) over (partition by service, instance order by ts, delta desc, span_id
    rows unbounded preceding) as bigint) as open
from edges"""

ACTIVE_INTERVALS = f"""
with {CONTEXT_EVENTS},
{_event_spans(60)},
runs as (
  select service, instance, start_ts, case when end_ts is null then timestamp '9999-12-31'
    else greatest(start_ts, end_ts) + interval 60 second end as end_ts from tracked),
marked as (
  select *, case when start_ts <= max(end_ts) over (partition by service, instance order by start_ts, end_ts
    rows between unbounded preceding and 1 preceding) then 0 else 1 end as gap
  from runs),
numbered as (
  select *, sum(gap) over (partition by service, instance order by start_ts, end_ts
    rows unbounded preceding) as run
  from marked)
select service, instance, min(start_ts) as start_ts, nullif(max(end_ts), timestamp '9999-12-31') as end_ts
from numbered group by service, instance, run"""

STATEMENTS = {
    "stack_frames": f"""
with {STACK_FRAMES}
select service, instance, sample_id, tid, ts, depth, file, func, line from stack_frames""",
    "context_changes": f"""
with {CONTEXT_CHANGES}
select service, instance, tid, ts, seq, trace_id, span_id from context_changes""",
    "samples_with_context": f"""
with {WITH_CONTEXT}
select service, instance, tid, ts, sample_id, trace_id, span_id from with_context""",
    "snapshot_samples": f"""
with {SNAPSHOT}
select service, instance, tid, ts, sample_id, trace_id, span_id from snapshot""",
    "open_spans": OPEN_SPANS,
    "active_intervals": ACTIVE_INTERVALS,
}

def _parts(rows: str, unit: str) -> str:
    """Samples numbered within their tick, and cut into parts of four."""
    return f"""
  select c.*, date_trunc('{unit}', c.ts) as tick_ts, cast((place - 1) // 4 as int) as part, (place - 1) % 4 + 1 as sample
  from (select r.*, row_number() over (partition by r.service, r.instance, r.source, date_trunc('{unit}', r.ts)
      order by r.ts, r.tid, r.sample_id) as place from ({rows}) r) c"""


TICKED = f"""{WITH_CONTEXT},
ticked as ({_parts("select *, 'continuous' as source from with_context", 'hour')})"""

PART = "service, instance, tick_ts, part"

TICKED_FRAMES = f"""{TICKED},
stack_words as (
  select sample_id, file, len(words) as depth_count,
    unnest(words) as func, unnest(range(len(words))) as depth
  from stack_samples),
frames as (
  select t.service, t.instance, t.tick_ts, t.part, t.sample, w.depth_count - 1 - w.depth as pos, w.file, w.func,
    case when not ends_with(w.func, '.') then length(w.func) end as line
  from ticked t join stack_words w using (sample_id))"""

ALL_TICKED = f"""{SNAPSHOT},
all_ticked as ({_parts("select *, 'continuous' as source from with_context union all select *, 'snapshot' from snapshot", 'second')})"""

LABEL_FORM = """
  case when length(ltrim({0}, '0')) < {1} then lpad(ltrim({0}, '0'), {1}, '0') else ltrim({0}, '0') end"""
TRACE_LABEL = LABEL_FORM.format("trace_id", 16)
SPAN_LABEL = LABEL_FORM.format("span_id", 8)

LOCATION_IDS = f"""{TICKED_FRAMES},
locations as (
  select *, row_number() over (partition by {PART} order by sample, pos) as location_id
  from (select *, row_number() over (
      partition by {PART}, file, func, line order by sample, pos) as occurrence from frames)
  where occurrence = 1)"""

STATEMENTS |= {
    "ticks": f"""
with {ALL_TICKED}
select service, instance, source, tick_ts, count(*) as samples from all_ticked group by all""",
    "filtered_ticks": f"""
with {WITH_CONTEXT}
select service, instance, 'continuous' as source, date_trunc('hour', ts) as tick_ts, count(*) as samples
from with_context where trace_id is not null and tid % 3 <> 1 group by all""",
    "frame_counts": f"""
with {TICKED}
select t.service, t.instance, t.tick_ts, t.part, cast(sum(len(s.words)) as bigint) as total_frames
from ticked t join stack_samples s using (sample_id) group by all""",
    "profile_records": f"""
with {TICKED}
select t.service, t.instance, 'continuous' as source, 'profiling' as scope,
  epoch_us(t.tick_ts) * 1000 as timestamp_ns, t.part, count(*) as samples,
  'pprof-gzip-base64' as format, 'cpu' as data_type,
  cast(sum(len(s.words)) as varchar) as total_frames
from ticked t join stack_samples s using (sample_id) group by t.service, t.instance, t.tick_ts, t.part""",
    "all_profile_records": f"""
with {ALL_TICKED}
select t.service, t.instance, t.source, 'profiling' as scope,
  epoch_us(t.tick_ts) * 1000 as timestamp_ns, t.part, count(*) as samples,
  'pprof-gzip-base64' as format, 'cpu' as data_type,
  cast(sum(len(s.words)) as varchar) as total_frames
from all_ticked t join stack_samples s using (sample_id) group by t.service, t.instance, t.source, t.tick_ts, t.part""",
    "profile_strings": f"""
with {TICKED_FRAMES},
tokens as (
  select {PART}, sample, 0 as ord, {TRACE_LABEL} as token from ticked where trace_id is not null
  union all
  select {PART}, sample, 1, {SPAN_LABEL} from ticked where span_id is not null
  union all
  select {PART}, sample, 2 * pos + 2, func from frames
  union all
  select {PART}, sample, 2 * pos + 3, file from frames
  union all
  select distinct {PART}, 0, unnest([0, 1, 2, 3, 4]),
    unnest(['source.event.time', 'trace_id', 'span_id', 'thread.id', 'source.event.period'])
  from ticked),
firsts as (
  select *, row_number() over (partition by {PART}, token order by sample, ord) as occurrence
  from tokens)
select {PART}, token,
  row_number() over (partition by {PART} order by sample, ord) - 1 as string_id
from firsts where occurrence = 1""",
    "profile_functions": f"""
with {TICKED_FRAMES},
firsts as (
  select *, row_number() over (
    partition by {PART}, file, func order by sample, pos) as occurrence
  from frames)
select {PART}, file, func,
  row_number() over (partition by {PART} order by sample, pos) as function_id
from firsts where occurrence = 1""",
    "profile_locations": f"""
with {LOCATION_IDS}
select {PART}, location_id, file, func,
  case when coalesce(line, 0) = 0 then -1 else line end as line
from locations""",
    "profile_samples": f"""
with {LOCATION_IDS},
stacks as (
  select f.service, f.instance, f.tick_ts, f.part, f.sample, string_agg(l.location_id, ',' order by f.pos) as location_ids
  from frames f join locations l on l.service = f.service and l.instance = f.instance and l.tick_ts = f.tick_ts and l.part = f.part
    and l.file = f.file and l.func = f.func and l.line is not distinct from f.line
  group by f.service, f.instance, f.tick_ts, f.part, f.sample)
select t.service, t.instance, t.tick_ts, t.part, t.sample_id, t.sample, t.tid, t.trace_id, t.span_id, s.location_ids
from ticked t join stacks s using (service, instance, tick_ts, part, sample)""",
    "profile_labels": f"""
with {TICKED}
select {PART}, sample, 'source.event.time' as key, cast(null as varchar) as text,
  epoch_ms(tick_ts) as num from ticked
union all
select {PART}, sample, 'source.event.period', null, 1000 from ticked
union all
select {PART}, sample, 'thread.id', null, tid from ticked
union all
select {PART}, sample, 'trace_id', {TRACE_LABEL}, null from ticked where trace_id is not null
union all
select {PART}, sample, 'span_id', {SPAN_LABEL}, null from ticked where span_id is not null""",
}

ORDER_SPANS = """
order_lines as (
  select l_orderkey, l_linenumber, min(l_suppkey) as l_suppkey, min(l_shipdate) as l_shipdate,
    min(l_quantity) as l_quantity
  from lineitem group by l_orderkey, l_linenumber),
chained as (
  select *, lag(l_linenumber) over (partition by l_orderkey order by l_linenumber) as prev_line,
    lag(l_suppkey) over (partition by l_orderkey order by l_linenumber) as prev_supp
  from order_lines),
order_spans as (
  select concat('svc', l_suppkey % 3) as service, md5(concat('o', l_orderkey)) as trace_id,
    substr(md5(concat('l', l_orderkey, '-', l_linenumber)), 1, 16) as span_id,
    case when prev_line is not null
      then substr(md5(concat('l', l_orderkey, '-', prev_line)), 1, 16) end as parent_span_id,
    coalesce(prev_supp % 3 <> l_suppkey % 3, false) as parent_is_remote,
    l_shipdate as start_ts, l_shipdate + to_hours(cast(l_quantity as int)) as end_ts
  from chained)"""

PACKAGE_REPORTS = """
package_reports as (
  select cast(l_orderkey as varchar) as id, l_linenumber - 1 as fragment_index, 7 as max_fragments,
    l_linenumber = 7 as is_done, p_name, p_brand
  from lineitem join part on p_partkey = l_partkey)"""

BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"

CONFIG = """
raw_config as (
  select concat('p', c_custkey) as process, c_custkey as k,
    case c_custkey % 4 when 0 then concat('svc', c_custkey) when 1 then '' when 2 then c_name end as service_name,
    case c_custkey % 11 when 0 then 'us2' when 1 then ' eu0 ' when 2 then '-us2'
      when 3 then 'us2/anything' when 4 then 'us2:443' when 5 then '' end as realm,
    case c_custkey % 3 when 0 then concat(' token', c_custkey) when 1 then ' ' end as token,
    case c_custkey % 5 when 0 then 'https://collector:4318' when 1 then '' when 2 then 'http://gw/'
      when 3 then concat('https://u:p@gw', c_custkey) end as base_endpoint,
    case c_custkey % 6 when 0 then 'http/protobuf' when 1 then 'grpc' when 2 then ''
      when 3 then ' http/protobuf ' end as base_protocol,
    case c_custkey % 7 when 0 then concat('https://a:b@traces', c_custkey, '/v1/traces?token=x#y')
      when 1 then '' end as traces_endpoint,
    case c_custkey % 4 when 0 then 'http/protobuf' when 1 then '' when 2 then 'grpc' end as metrics_protocol,
    case c_custkey % 3 when 0 then 'a=1' when 1 then '' when 2 then 'a=1,b=2' end as headers,
    case c_custkey % 5 when 0 then 'otlp_proto_http' when 1 then 'none'
      when 2 then ' otlp_proto_http ' end as logs_exporter,
    case c_custkey % 4 when 0 then ' TRUE ' when 1 then 'true' when 2 then 'yes' end as profiler,
    case c_custkey % 3 when 0 then 'http://profiles:4318/v1/logs' when 1 then '' end as profiler_logs,
    case c_custkey % 6 when 0 then '500' when 1 then 'abc' when 2 then '' when 3 then ' 250 '
      when 4 then '1.5' end as stack_interval,
    case c_custkey % 5 when 0 then 'True' when 1 then 'false' when 2 then '1' end as snapshot,
    case c_custkey % 4 when 0 then '25' when 1 then 'x' when 2 then '-3' end as snapshot_interval,
    case c_custkey % 5 when 0 then '0.5' when 1 then '1' when 2 then 'half' when 3 then '' end as probability,
    case c_custkey % 5 when 0 then '0' when 1 then '-5' when 2 then '60000' when 3 then 'soon' end as polling,
    case c_custkey % 4 when 0 then 'team=a' when 1 then '' when 2 then 'team=b,env=prod=x' end as resource,
    case c_custkey % 6 when 0 then 'logging' when 1 then 'requests, logging , flask' when 2 then '*'
      when 3 then 'requests,flask' when 4 then '' end as disabled,
    case c_custkey % 5 when 0 then '10' when 1 then '' end as link_limit,
    case c_custkey % 4 when 0 then '64' when 1 then '' when 2 then 'many' end as attribute_limit,
    case c_custkey % 3 when 0 then 'true' when 1 then ' True' end as system_metrics,
    case when c_custkey % 2 = 0 then c_mktsegment end as custom
  from customer),
named_config as (
  select *, case when regexp_full_match(trim(realm), '[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?')
      then trim(realm) end as good_realm,
    coalesce(lower(trim(profiler)) = 'true', false) as profiler_on,
    coalesce(lower(trim(snapshot)) = 'true', false) as snapshot_on
  from raw_config),
full_config as (
  select * replace (
      coalesce(nullif(service_name, ''), 'unnamed-python-service') as service_name,
      coalesce(traces_endpoint, 'https://ingest.' || good_realm || '.example.com/v2/trace/otlp') as traces_endpoint,
      coalesce(base_protocol, case when good_realm is not null then 'http/protobuf' end) as base_protocol,
      coalesce(logs_exporter, 'otlp') as logs_exporter,
      case when trim(token) <> '' then concat_ws(',', nullif(headers, ''), 'x-access-token=' || trim(token))
        else headers end as headers,
      concat_ws(',', nullif(resource, ''), 'telemetry.distro.name=stackweave',
        'telemetry.distro.version=0.1.0') as resource,
      coalesce(link_limit, '1000') as link_limit, coalesce(attribute_limit, '') as attribute_limit),
    coalesce(nullif(service_name, ''), '') = '' as service_name_missing,
    coalesce(trim(realm), '') <> '' and good_realm is null as realm_ignored,
    'https://ingest.' || good_realm || '.example.com/v2/datapoint/otlp' as metrics_endpoint,
    case when (profiler_on or snapshot_on) and profiler_logs <> '' then profiler_logs end as logs_endpoint
  from named_config)"""

ENDPOINTS_SQL = f"""{CONFIG},
chosen as (
  select process, 'traces' as signal, nullif(traces_endpoint, '') as own, nullif(base_endpoint, '') as base,
    case when nullif(base_protocol, '') is not null then trim(base_protocol) = 'http/protobuf' else false end as http
  from full_config
  union all
  select process, 'metrics', metrics_endpoint, nullif(base_endpoint, ''),
    coalesce(trim(coalesce(nullif(metrics_protocol, ''), nullif(base_protocol, ''))) = 'http/protobuf', false)
  from full_config
  union all
  select process, 'logs', logs_endpoint, nullif(base_endpoint, ''),
    case when nullif(base_protocol, '') is not null then trim(base_protocol) = 'http/protobuf'
      else trim(logs_exporter) = 'otlp_proto_http' end
  from full_config),
resolved as (
  select process, signal, coalesce(own, case when http
      then rtrim(coalesce(base, 'http://localhost:4318/'), '/') || '/v1/' || signal
      else coalesce(base, 'http://localhost:4317') end) as endpoint
  from chosen)"""

SANITISE = r"""regexp_replace(regexp_replace({0}, '(?s)[#?].*$', ''), '^([^:/]*://|//)[^/]*@', '\1')"""

WHOLE = "case when regexp_full_match(trim({0}), '[+-]?[0-9]+') then cast(trim({0}) as bigint) else {1} end"

REPORT_SQL = f"""{ENDPOINTS_SQL},
sent as (
  select process, max(case when signal = 'traces' then {SANITISE.format('endpoint')} end) as traces,
    max(case when signal = 'metrics' then {SANITISE.format('endpoint')} end) as metrics,
    max(case when signal = 'logs' then {SANITISE.format('endpoint')} end) as logs
  from resolved group by process),
report_lines as (
  select process, unnest(range(10)) as line,
    unnest(['exporter.otlp.traces.endpoint', 'exporter.otlp.metrics.endpoint',
      'exporter.otlp.logs.endpoint', 'profiler.enabled', 'profiler.memory.enabled',
      'snapshot.profiler.enabled', 'snapshot.profiler.sampling.interval',
      'profiler.call.stack.interval', 'config.file', 'experimental.config.file']) as key,
    unnest([traces, metrics, logs, cast(profiler_on as varchar), 'false', cast(snapshot_on as varchar),
      cast({WHOLE.format('snapshot_interval', 10)} as varchar),
      cast({WHOLE.format('stack_interval', 1000)} as varchar), 'null', 'null']) as value
  from full_config join sent using (process))"""

REQUIREMENTS = """
requirement_texts as (
  select p_brand as project, p_partkey as ord, lower(p_type) as name, p_size,
    concat(lower(p_type), case p_size % 5 when 0 then concat('==1.2.', p_size)
      when 1 then concat(' >= 0.4b', p_size, ' , < 9')
      when 2 then concat('~=', p_size, ' ; python_version < ''3.13''')
      when 3 then concat('[extra]==1.0RC', p_size) else '' end) as requirement,
    case p_size % 5 when 0 then concat('1.2.', p_size) when 1 then concat('>=0.4b', p_size, ',<9')
      when 2 then concat('~=', p_size) when 3 then concat('[extra]==1.0RC', p_size) else '' end as version
  from part),
requirements as (
  select project, ord, requirement, name, version,
    case when p_size % 5 in (1, 3) then 'experimental' else 'stable' end as stability,
    case when name = 'standard' then 'https://example.org/core/standard'
      when name = 'small' then 'https://example.org/exporters/small'
      when name = 'promo' then 'https://example.org/contrib' end as source_href
  from requirement_texts),
inventory as (
  select project, ord, name, version, stability, source_href,
    concat('https://pypi.org/project/', name, '/') as package_href
  from requirements
  union all
  select project, -2, 'Core', arg_max(version, ord), 'stable', 'https://example.org/core', null
  from requirements where name = 'standard' group by project
  union all
  select project, -1, 'Contrib', arg_max(version, ord), arg_max(stability, ord),
    'https://example.org/contrib', null
  from requirements where name = 'promo' group by project)"""

MANIFESTS = """
manifests as (
  select p_partkey, p_size, p_brand, string_split(p_name, ' ')[1] as w1, string_split(p_name, ' ')[2] as w2,
    list_concat(
      case when p_size % 3 = 0 then [concat(w1, ' >= 1.', p_size)] else [] end,
      case when p_partkey % 2 = 0 then [concat(w1, ' ~= 1.0'), concat(w2, ' ~= ', p_size)] else [] end) as wanted,
    list_concat(
      case when p_size % 3 = 0 then [w1] else [] end,
      case when p_partkey % 2 = 0 then [w1, w2] else [] end) as wanted_names
  from part where p_size % 5 <> 0)"""

STATEMENTS |= {
    "function_times": f"""
with {WITH_CONTEXT},
words as (
  select c.service, c.sample_id, s.file, unnest(s.words) as func, s.words[len(s.words)] as leaf
  from with_context c join stack_samples s using (sample_id) where c.trace_id is not null),
once as (select distinct * from words),
counted as (
  select service, file, func, count(*) filter (func = leaf) as self_samples, count(*) as total_samples
  from once group by service, file, func)
select *, self_samples * 1000 as self_ms, total_samples * 1000 as total_ms from counted""",
    "call_edges": f"""
with {SNAPSHOT},
words as (
  select c.trace_id, c.sample_id, s.file, s.words, unnest(range(1, len(s.words))) as i
  from snapshot c join stack_samples s using (sample_id)),
once as (
  select distinct trace_id, sample_id, file, words[i] as caller, words[i + 1] as callee from words)
select trace_id, file as caller_file, caller, file as callee_file, callee, count(*) as samples,
  count(*) * 10 as total_ms
from once group by trace_id, file, caller, callee""",
    "folded_stacks": f"""
with {STACK_SAMPLES}
select service, array_to_string(words, ';') as stack, count(*) as samples, count(*) * 1000 as total_ms
from stack_samples group by service, words""",
    "span_profiles": f"""
with {WITH_CONTEXT},
{_event_spans(3600)}
select s.service, s.instance, s.trace_id, s.span_id, s.start_ts, s.end_ts, count(c.sample_id) as samples,
  count(c.sample_id) * 1000 as total_ms
from event_spans s left join with_context c on c.trace_id = s.trace_id and c.span_id = s.span_id
group by s.service, s.instance, s.trace_id, s.span_id, s.start_ts, s.end_ts""",
    "spans_without_stacks": f"""
with {SNAPSHOT}
select service, instance, trace_id, span_id from tracked t
where not exists (select 1 from snapshot s where s.service = t.service and s.instance = t.instance and s.trace_id = t.trace_id)""",
    "entry_spans": f"""
with {ORDER_SPANS}
select service, trace_id, span_id from order_spans where parent_span_id is null or parent_is_remote""",
    "resolved_parents": f"""
with {ORDER_SPANS}
select s.service, s.trace_id, s.span_id from order_spans s
left join order_spans p on p.trace_id = s.trace_id and p.span_id = s.parent_span_id
where s.parent_span_id is null or p.service is distinct from s.service""",
    "selected_spans": f"""
with {CONTEXT_EVENTS},
{_event_spans(3600)}
select service, instance, trace_id, span_id, 'true' as mark from tracked""",
    "span_counts": f"""
with {ORDER_SPANS}
select service, count(*) as spans from order_spans group by service""",
    "trace_volume": """
with baggage as (
  select o_orderkey, md5(concat('o', o_orderkey)) as trace_id,
    case when o_orderpriority = '1-URGENT' then 'bogus' when o_orderstatus = 'F' then 'highest'
      when o_orderstatus = 'O' then 'off' end as baggage
  from orders)
select *, case when baggage in ('highest', 'off') then baggage
  when substr(trace_id, 17) < '8000000000000000' then 'highest' else 'off' end as volume
from baggage""",
    "random_selection": """
select o_orderkey, case when case when o_orderpriority = '1-URGENT' then null when o_orderstatus = 'F' then 'highest'
    when o_orderstatus = 'O' then 'off' end is not null then case o_orderstatus when 'F' then 'highest' else 'off' end
  when substr(md5(concat('7:', o_orderkey)), 1, 16) < '8000000000000000' then 'highest' else 'off' end as volume
from orders""",
    "normalised_ids": f"""
with {ORDER_SPANS}
select trace_id, span_id, {TRACE_LABEL} as trace_label, {SPAN_LABEL} as span_label,
  trace_id as trace_hex, span_id as span_hex
from order_spans""",
    "server_timing": f"""
with {ORDER_SPANS}
select trace_id, parent_span_id,
  'traceparent;desc="00-' || trace_id || '-' || parent_span_id || '-01"' as header
from order_spans""",
    "response_headers": f"""
with {ORDER_SPANS}
select trace_id, span_id, unnest(['Server-Timing', 'Access-Control-Expose-Headers']) as name,
  unnest(['traceparent;desc="00-' || trace_id || '-' || parent_span_id || '-01"', 'Server-Timing']) as value
from order_spans where parent_span_id is not null""",
    "flatten_scope_logs": """
with lines as (
  select doc_id, lang, unnest(string_split(text, chr(10))) as body,
    unnest(range(len(string_split(text, chr(10))))) as line
  from documents),
scoped as (select *, case when contains(body, '|') then 'deps' else 'app' end as scope from lines)
select doc_id, lang, scope, body,
  row_number() over (partition by doc_id, scope order by line) - 1 as position
from scoped""",
    "flatten_spans": f"""
with {ORDER_SPANS}
select service, 'orders' as scope, 'line ' || left(span_id, 4) as name, trace_id, span_id, parent_span_id,
  epoch_us(start_ts) * 1000 as start_ns, epoch_us(end_ts) * 1000 as end_ns, start_ts, end_ts,
  cast(parent_is_remote as varchar) as remote
from order_spans""",
    "exported_span_counts": f"""
with {ORDER_SPANS}
select service, count(*) as spans from order_spans group by service""",
    "flatten_metrics": """
with points as (
  select *, unnest(case event_type when 'error' then [0, 1] when 'signup' then [] else [0] end) as position from events)
select event_id, concat('svc', user_id % 5) as service, 'events' as scope, 'events.' || event_type as metric, '1' as unit,
  case event_type when 'click' then 'sum' when 'purchase' then 'histogram' else 'gauge' end as kind,
  case event_type when 'click' then 2 when 'purchase' then 1 end as temporality,
  case event_type when 'click' then true end as is_monotonic, cast(position as bigint) as position, epoch_us(ts) * 1000 as time_ns,
  case when event_type = 'click' or position = 1 then cast(event_id % 7 as double) when event_type <> 'purchase' then cast(value as double) end as value,
  case when event_type = 'click' or position = 1 then event_id % 7 end as int_value,
  case event_type when 'purchase' then event_id % 7 + 1 end as count, case event_type when 'purchase' then cast(value as double) end as total,
  case event_type when 'purchase' then '10.0' end as bounds, case event_type when 'purchase' then '1,' || event_id % 7 end as buckets,
  cast(user_id as varchar) as user
from points""",
    "route_logs": """
select event_id, case event_type when 'error' then 'deps' when 'purchase' then 'profiling' else 'app' end as scope,
  case event_type when 'error' then 'dependency-reports' else 'default' end as route
from events""",
    "scope_records": """
select event_id, concat('svc', user_id % 5) as service, json_extract_string(props, '$.k') as k
from events where event_type = 'click'""",
    "metric_presence": """
with seen as (
  select distinct concat('svc', l_suppkey % 50) as service,
    concat('process.', lower(l_returnflag), '.', lower(l_linestatus)) as metric
  from lineitem),
expected as (
  select * from (select distinct service from seen),
    (values ('process.a.f'), ('process.n.o'), ('process.r.f'), ('process.r.o'), ('system.cpu.time')) as v(metric))
select service, metric, (service, metric) in (select (service, metric) from seen) as present from expected""",
    "package_names": """
select distinct lower(p_name) as name from lineitem join part on p_partkey = l_partkey""",
    "reports_complete": f"""
with {PACKAGE_REPORTS}
select id, count(distinct fragment_index) as fragments, cast(7 as bigint) as max_fragments,
  bool_or(is_done) as is_done, count(*) as packages,
  bool_or(is_done) and count(distinct fragment_index) >= 7 as complete
from package_reports group by id""",
    "report_packages": f"""
with {PACKAGE_REPORTS}
select id, fragment_index, p_name as name, p_brand as version,
  row_number() over (partition by id, fragment_index order by p_name, p_brand) - 1 as position
from package_reports
where id in (select id from package_reports group by id having count(distinct fragment_index) = 7)""",
    "limit_links": """
select doc_id, len(string_split(text, ' ')) as links, least(len(string_split(text, ' ')), 1000) as kept,
  string_split(text, ' ')[least(len(string_split(text, ' ')), 1000)] as last
from documents""",
    "limit_attributes": """
select doc_id, 'lang' as key, lang as value from documents
union all
select doc_id, 'text', left(text, 12000) from documents""",
    "effective_config": f"""
with {CONFIG},
entries as (
  select process, unnest(['service.name', 'realm', 'access.token', 'exporter.otlp.endpoint',
      'exporter.otlp.protocol', 'exporter.otlp.traces.endpoint', 'exporter.otlp.metrics.endpoint',
      'exporter.otlp.logs.endpoint', 'exporter.otlp.metrics.protocol', 'exporter.otlp.headers',
      'logs.exporter', 'traces.exporter', 'metrics.exporter', 'profiler.enabled',
      'profiler.logs.endpoint', 'profiler.call.stack.interval', 'snapshot.profiler.enabled',
      'snapshot.sampling.interval', 'snapshot.selection.probability', 'agent.polling.interval',
      'resource.attributes', 'disabled.instrumentations', 'span.link.count.limit', 'custom.setting',
      'attribute.count.limit', 'span.attribute.count.limit', 'span.event.count.limit',
      'event.attribute.count.limit', 'link.attribute.count.limit', 'attribute.value.length.limit',
      'experimental.resource.detectors', 'traces.sampler', 'system.metrics.enabled']) as key,
    unnest([service_name, realm, token, base_endpoint, base_protocol, traces_endpoint, metrics_endpoint,
      logs_endpoint, metrics_protocol, headers, logs_exporter, 'otlp', 'otlp', profiler, profiler_logs,
      stack_interval, snapshot, snapshot_interval, probability, polling, resource, disabled, link_limit,
      custom, attribute_limit, '', '', '', '', '12000', 'host,process', 'always_on', system_metrics]) as value
  from full_config)
select * from entries where value is not null""",
    "resolved_endpoints": f"""
with {ENDPOINTS_SQL}
select * from resolved""",
    "typed_config": f"""
with {CONFIG}
select process, profiler_on as profiler_enabled, snapshot_on as snapshot_profiler_enabled,
  true as trace_response_header_enabled, false as agent_enabled, coalesce(lower(trim(system_metrics)) = 'true', false) as system_metrics_enabled,
  try_cast(nullif(attribute_limit, 'many') as bigint) as attribute_count_limit, cast(12000 as bigint) as attribute_value_length_limit,
  cast(null as bigint) as span_attribute_count_limit, cast(null as bigint) as span_event_count_limit,
  cast(null as bigint) as event_attribute_count_limit, cast(null as bigint) as link_attribute_count_limit,
  coalesce(try_cast(nullif(link_limit, '') as bigint), 1000) as span_link_count_limit,
  {WHOLE.format('stack_interval', 1000)} as profiler_call_stack_interval,
  {WHOLE.format('snapshot_interval', 10)} as snapshot_sampling_interval,
  coalesce(try_cast(nullif(probability, 'half') as double), 0.01) as snapshot_selection_probability,
  case when {WHOLE.format('polling', 30000)} > 0 then {WHOLE.format('polling', 30000)} else 30000 end
    as agent_polling_interval,
  coalesce(polling in ('0', '-5'), false) as polling_interval_not_positive,
  concat_ws(',', case when attribute_limit = 'many' then 'attribute.count.limit' end,
    case when link_limit = '' then 'span.link.count.limit' end, case when stack_interval in ('abc', '', '1.5') then 'profiler.call.stack.interval' end,
    case when snapshot_interval = 'x' then 'snapshot.sampling.interval' end,
    case when probability in ('half', '') then 'snapshot.selection.probability' end,
    case when polling = 'soon' then 'agent.polling.interval' end) as unreadable
from full_config""",
    "unreadable_settings": f"""
with {CONFIG},
bad as (
  select process, 'attribute.count.limit' as key, attribute_limit as value, 'int' as type, '' as used from raw_config where attribute_limit = 'many'
  union all
  select process, 'span.link.count.limit', link_limit, 'int', '1000' from raw_config where link_limit = ''
  union all
  select process, 'profiler.call.stack.interval', stack_interval, 'int', '1000' from raw_config where stack_interval in ('abc', '', '1.5')
  union all
  select process, 'snapshot.sampling.interval', snapshot_interval, 'int', '10' from raw_config where snapshot_interval = 'x'
  union all
  select process, 'snapshot.selection.probability', probability, 'double', '0.01' from raw_config where probability in ('half', '')
  union all
  select process, 'agent.polling.interval', polling, 'int', '30000' from raw_config where polling = 'soon')
select *, 'setting ' || key || ': ' || value || ' is no ' || type as warning from bad""",
    "config_report": f"""
with {REPORT_SQL}
select process, string_agg(key || '=' || value, chr(10) order by line) as report
from report_lines group by process""",
    "config_report_parse": f"""
with {REPORT_SQL}
select process, line, key, value from report_lines""",
    "config_warnings": f"""
with {CONFIG}
select process, service_name_missing, realm_ignored from (
  select f.process, r.service_name is null or r.service_name = '' as service_name_missing, f.realm_ignored
  from full_config f join raw_config r using (process))""",
    "resource_attributes": """
select concat('p', c_custkey) as process, key, value from customer,
  lateral (
    select 'team' as key, case c_custkey % 4 when 0 then 'a' when 2 then 'b' end as value
    union all select 'env', case c_custkey % 4 when 2 then 'prod=x' end
    union all select 'telemetry.distro.name', 'stackweave'
    union all select 'telemetry.distro.version', '0.1.0')
where value is not null""",
    "disabled_flags": """
with lists as (
  select c_custkey, lower(c_mktsegment) as segment,
    case when c_custkey % 7 in (1, 4, 5, 6) then lower(c_mktsegment) end as own, c_custkey % 7 in (0, 4) as every
  from customer)
select c_custkey, every or c_custkey % 7 = 1 as flask,
  every or coalesce(own = 'furniture', false) as furniture,
  every or coalesce(own = 'machinery', false) as machinery
from lists""",
    "sanitised_endpoints": f"""
with sent as (
  select page_id, case when page_id % 3 = 0 then replace(url, '://', '://user:p@ss@') else url end as endpoint
  from pages)
select page_id, {SANITISE.format('endpoint')} as endpoint from sent""",
    "encoded_attributes": """
select p_partkey, unnest(['service.name', 'service.namespace', 'service.instance.id', 'process.pid', 'host.name',
    'custom.flag', 'custom.words', 'custom.ports', 'custom.flags']) as key,
  unnest(['string', 'string', 'string', 'int', 'string', 'bool', 'string', 'string', 'string']) as type,
  unnest([lower(p_brand), lower(p_type), cast(p_partkey as varchar), cast(p_size as varchar),
    concat('host-', p_size), case when p_size > 25 then 'true' else 'false' end,
    '["' || replace(p_name, ' ', '","') || '"]', concat('[4317,null,', p_size, ']'), '[true,null]']) as value
from part""",
    "unsupported_attributes": """
select p_partkey, 'attribute custom.mapping has unsupported type map' as warning from part
union all
select p_partkey, 'attribute custom.missing has unsupported type list' from part""",
    "encoded_variants": """
select p_partkey, unnest(['service.name', 'process.pid', 'custom.share', 'custom.flag', 'custom.mixed', 'custom.objects', 'custom.empty']) as key,
  unnest(['string', 'int', 'float', 'bool', 'string', 'string', 'string']) as type,
  unnest([lower(p_brand), p_size::varchar, p_size || '.5', case when p_size > 25 then 'true' else 'false' end,
    '[1,"' || string_split(p_name, ' ')[1] || chr(92) || 'u00e9",true,null,2.5,[' || p_size || ',"x"]]',
    '[{"k":' || p_size || '}]', '[]']) as value
from part""",
    "unsupported_variants": """
select p_partkey, unnest(['attribute custom.mapping has unsupported type map', 'attribute custom.missing has unsupported type none']) as warning
from part""",
    "attribute_partition": """
select p_partkey, concat('service.instance.id=', p_partkey, ';service.name=', lower(p_brand)) as identifying,
  concat('host.name=', p_name, ';process.pid=', p_size) as describing
from part""",
    "requirements_parsed": f"""
with {REQUIREMENTS}
select * from requirements""",
    "dependency_inventory": f"""
with {REQUIREMENTS}
select * from inventory""",
    "catalogue": f"""
with {MANIFESTS},
listed as (
  select *, case when p_size % 5 = 1 then w2
      else concat_ws(',', least(w1 || '-a', w2 || '-b'), greatest(w1 || '-a', w2 || '-b')) end as keys,
    case when len(wanted) = 0 then [concat('lib-', p_partkey)] else wanted_names end as components,
    case when len(wanted) = 0 then [cast(null as varchar)] else wanted end as versions
  from manifests)
select keys, concat('lib-', p_partkey) as name, unnest(range(len(components))) as position,
  unnest(components) as component, unnest(versions) as supported_versions,
  case when p_size % 4 <> 3 then p_brand else '' end as description, 'experimental' as stability,
  case when p_partkey in (1, 2) then 'supported' else 'community' end as support
from listed""",
    "inventory_counts": f"""
with {REQUIREMENTS},
{CONFIG},
told as (
  select unnest([count(service_name), count(realm), count(token), count(base_endpoint), count(base_protocol), count(traces_endpoint),
    count(metrics_protocol), count(headers), count(logs_exporter), count(profiler), count(profiler_logs), count(stack_interval),
    count(snapshot), count(snapshot_interval), count(probability), count(polling), count(resource), count(disabled),
    count(link_limit), count(attribute_limit), count(system_metrics), count(custom)]) as processes
  from raw_config)
select 'dependencies' as kind, count(*) as entries from inventory
union all
select 'instrumentations', count(*) from part where p_size % 5 <> 0
union all
select 'settings', count(*) from told where processes > 0""",
}

STACK_LINES = """
lines as (
  select sample_id, len(words) as depth, list_transform(words, lambda w: concat(file, ':', w, ':',
      case when ends_with(w, '.') or length(w) = 0 then -1 else length(w) end)) as lines
  from stack_samples)"""

STATEMENTS |= {
    "profile_roundtrip": f"""
with {TICKED},
{STACK_LINES}
select {PART}, source, sample, epoch_ms(tick_ts) as time_ms, cast(1000 as bigint) as period_ms, tid,
  trace_id, span_id, depth, md5(array_to_string(lines, chr(10))) as stack
from ticked join lines using (sample_id)""",
    "all_profiles_roundtrip": f"""
with {ALL_TICKED},
{STACK_LINES}
select {PART}, source, sample, epoch_ms(tick_ts) as time_ms,
  cast(case source when 'snapshot' then 10 else 1000 end as bigint) as period_ms, tid,
  trace_id, span_id, depth, md5(array_to_string(lines, chr(10))) as stack
from all_ticked join lines using (sample_id)""",
    "dated_records": f"""
with {WITH_CONTEXT},
seconds as (
  select service, instance, date_trunc('second', ts) as tick_ts, count(*) as samples from with_context group by all)
select cast(tick_ts as date) as date, service, 'continuous' as source, cast(sum((samples + 3) // 4) as bigint) as records,
  cast(sum(samples) as bigint) as samples
from seconds where tick_ts >= '2024-01-03' and tick_ts < '2024-01-08' group by all""",
    "profile_quality": f"""
with {TICKED}
select {PART}, sample, 'missing_trace_id' as rule from ticked where trace_id is null
union all
select {PART}, sample, 'missing_span_id' from ticked where span_id is null""",
    "decode_reports": f"""
with {PACKAGE_REPORTS}
select id, fragment_index, max_fragments, is_done,
  string_agg(p_name, ',' order by p_name, p_brand) as packages, true as valid
from package_reports group by id, fragment_index, max_fragments, is_done""",
}

STATEMENTS |= {
    "stream_samples_with_context": STATEMENTS["samples_with_context"],
    "stream_snapshot_samples": STATEMENTS["snapshot_samples"],
    "stream_activity": f"""
with {CONTEXT_EVENTS},
{_event_spans(3600)},
marked as (
  select service, instance, start_ts, case when start_ts < lag(start_ts) over (partition by service, instance order by start_ts)
    + interval 1800 second then 0 else 1 end as gap
  from tracked),
numbered as (
  select *, sum(gap) over (partition by service, instance order by start_ts rows unbounded preceding) as run from marked)
select service, instance, min(start_ts) as start_ts, max(start_ts) + interval 1800 second as end_ts, count(*) as starts
from numbered group by service, instance, run""",
    "stream_ticks": f"""
with {STACK_SAMPLES}
select service, instance, 'continuous' as source, date_trunc('hour', ts) as tick_ts, count(*) as samples
from stack_samples group by all""",
    "stream_active_intervals": STATEMENTS["active_intervals"],
    "stream_profile_records": STATEMENTS["profile_roundtrip"],
    "late_samples": f"""
with {STACK_SAMPLES},
delivered as (
  select service, instance, tid, ts, sample_id, sample_id % 3 as batch from stack_samples),
marks as (
  select batch, max(ts) over (order by batch rows between unbounded preceding and 1 preceding) - interval 5 day as mark
  from (select batch, max(ts) as ts from delivered group by batch))
select service, instance, tid, ts, sample_id, batch, case when ts < mark then 'late' else 'timely' end as timing,
  greatest(coalesce(epoch_us(mark) - epoch_us(ts), 0), 0) / 1e6::double as behind_seconds
from delivered join marks using (batch)""",
    "landed_frames": STATEMENTS["stack_frames"],
    "read_profile_log": STATEMENTS["profile_roundtrip"] + " where tick_ts >= '2024-01-03' and tick_ts < '2024-01-10'",
    "stream_routes": STATEMENTS["route_logs"],
    "stream_sanitised_endpoints": STATEMENTS["sanitised_endpoints"],
    "stream_decoded_reports": STATEMENTS["decode_reports"],
}
