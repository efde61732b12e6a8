"""Profile log records: the encoded body, and writing and reading the records.

Spark orders the samples, cuts ticks into parts and brings each part together; the codec turns the
columns of parts into bytes, or bytes into columns, with numpy and Arrow. Small parts are held some at
a time, a large one alone. Their numbers are those of `operators.profiles`, which the tests hold against each other.
"""

from __future__ import annotations

import base64
import gzip
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stackweave import session
from stackweave.functions import clock, ids, stacks
from stackweave.operators import numbering, profiles

KEY_SCHEMA = "service string, instance string, source string, tick_ts {ts}, part int"
DECODED_SCHEMA = (
    "format string, sample int, time_ms bigint, period_ms bigint, tid bigint, trace_id string, "
    "span_id string, frames array<struct<file:string,func:string,line:bigint>>, error string"
)

# The parts of the public pprof message that profiles use, as
# message -> [(field, number, type)]; a trailing * marks a repeated field.
PPROF = {
    "Label": [("key", 1, "int64"), ("str", 2, "int64"), ("num", 3, "int64")],
    "Sample": [("location_id", 1, "uint64*"), ("label", 3, "Label*")],
    "Line": [("function_id", 1, "uint64"), ("line", 2, "int64")],
    "Location": [("id", 1, "uint64"), ("line", 4, "Line*")],
    "Function": [
        ("id", 1, "uint64"), ("name", 2, "int64"), ("system_name", 3, "int64"), ("filename", 4, "int64"),
    ],
    "Profile": [
        ("sample", 2, "Sample*"), ("location", 4, "Location*"), ("function", 5, "Function*"),
        ("string_table", 6, "string*"),
    ],
    # The same profile, with functions and locations as they lie.
    "Coded": [("sample", 2, "Sample*"), ("location", 4, "bytes*"), ("function", 5, "bytes*"), ("string_table", 6, "string*")],
}

FORMAT_ATTRIBUTE = "profiling.data.format"
_LEVEL = 3  # of gzip: higher ones take up to three times the time and save a hundredth
_FRAMES = 1 << 18  # decoded frames in one batch of results, before the next one is begun


@cache
def profile_message(wanted: str = "Profile"):
    """The message class of a profile, built once per Python worker."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as error:
        raise RuntimeError("encoding and decoding profiles needs the protobuf package") from error

    field = descriptor_pb2.FieldDescriptorProto
    package = "stackweave.pprof"
    file = descriptor_pb2.FileDescriptorProto(
        name="stackweave/pprof.proto", package=package, syntax="proto3"
    )
    for name, fields in PPROF.items():
        message = file.message_type.add(name=name)
        for label, number, kind in fields:
            base = kind.rstrip("*")
            entry = message.field.add(
                name=label,
                number=number,
                label=field.LABEL_REPEATED if kind.endswith("*") else field.LABEL_OPTIONAL,
            )
            if base in PPROF:
                entry.type, entry.type_name = field.TYPE_MESSAGE, f".{package}.{base}"
            else:
                entry.type = getattr(field, f"TYPE_{base.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{package}.{wanted}"))


def _varints(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers, in order, as the bytes of varints, and the bytes of each."""
    values = columns.ravel().astype(np.int64).view(np.uint64)
    sizes = np.ones(len(values), np.int64)
    top = int(values.max()) if len(values) else 0
    for bits in range(7, 64, 7):
        if top >> bits:
            sizes += values >= np.uint64(1 << bits)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[begin] = values & np.uint64(127)
    longer = np.arange(len(values))
    for k in range(1, int(sizes.max()) if len(sizes) else 0):
        longer = longer[sizes[longer] > k]
        out[begin[longer] + k - 1] |= 128
        out[begin[longer] + k] = (values[longer] >> np.uint64(7 * k)) & np.uint64(127)
    return out, sizes


def _size(values: np.ndarray) -> np.ndarray:
    """Bytes of each number as a varint."""
    return _varints(values)[1]


def _bounds(sizes: np.ndarray, starts: np.ndarray) -> list[int]:
    """Where the bytes of each part begin, and where the last one's end; parts begin at given numbers."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return [*ends[starts].tolist(), int(ends[-1])]


def _fixed(*columns: np.ndarray | int) -> np.ndarray:
    return np.stack(np.broadcast_arrays(*columns), axis=1)


def _functions(w: numbering.Walk, found: numbering.Strings) -> tuple[bytes, list[int]]:
    number = np.arange(len(w.met)) - w.function_start[w.part[w.sample[w.met]]] + 1
    inner = 4 + _size(number) + 2 * _size(found.func) + _size(found.file)
    data, sizes = _varints(_fixed(42, inner, 8, number, 16, found.func, 24, found.func, 32, found.file))
    return data.tobytes(), _bounds(sizes.reshape(-1, 10).sum(axis=1), w.function_start)


def _locations(w: numbering.Walk) -> tuple[bytes, list[int]]:
    part = w.part[w.sample[w.new]]
    number = np.arange(len(w.new)) - w.location_start[part] + 1
    function = w.function_of[w.new] - w.function_start[part] + 1
    shown = w.lines.cast(pa.int64()).fill_null(0).to_numpy()
    line = np.where(shown == 0, -1, shown)[w.line[w.at[w.new]]]
    inner = 2 + _size(function) + _size(line)
    data, sizes = _varints(_fixed(34, 2 + _size(number) + _size(inner) + inner, 8, number, 34, inner, 8, function, 16, line))
    return data.tobytes(), _bounds(sizes.reshape(-1, 10).sum(axis=1), w.location_start)


def _samples(rows: pa.Table, w: numbering.Walk, found: numbering.Strings, first: np.ndarray) -> tuple[bytes, list[int]]:
    count = len(w.sizes)
    ids = w.location_of - w.location_start[w.part[w.sample]] + 1
    row_of = np.concatenate((np.cumsum(_size(ids)), [0]))
    listed = row_of[w.ends - 1] - row_of[w.ends - w.sizes - 1]
    listed = np.where(w.sizes > 0, listed, 0)
    # A label is five numbers: its tag and size, its key, and either a string's number or a number.
    key = {name: profiles.RESERVED.index(name) for name in profiles.RESERVED}
    labels, there = [], []
    for name, column in ((profiles.LABEL_TIME, "time_ms"), (profiles.LABEL_PERIOD, "period_ms"), (profiles.LABEL_THREAD, "tid")):
        values = rows[column].cast(pa.int64())
        value = values.fill_null(0).to_numpy()
        labels.append(_fixed(26, 3 + _size(value), 8, key[name], 24, value))
        there.append(values.is_valid().to_numpy())
    for name, value in ((profiles.LABEL_TRACE, found.trace), (profiles.LABEL_SPAN, found.span)):
        value_here = np.maximum(value, 0)
        labels.append(_fixed(26, 3 + _size(value_here), 8, key[name], 16, value_here))
        there.append(value >= 0)
    labels, there = np.stack(labels, axis=1), np.stack(there, axis=1)
    each = np.where(there, 2 + labels[:, :, 1], 0).sum(axis=1)
    inner = np.where(w.sizes > 0, 1 + _size(listed) + listed, 0) + each
    # All numbers in one run: head, location numbers, labels.
    head = np.where(w.sizes > 0, 4, 2)
    many = head + w.sizes + 6 * there.sum(axis=1)
    begin = np.cumsum(many) - many
    run = np.zeros(int(many.sum()), np.int64)
    run[begin], run[begin + 1] = 18, inner
    full = np.flatnonzero(w.sizes > 0)
    run[begin[full] + 2], run[begin[full] + 3] = 10, listed[full]
    run[np.repeat(begin + head, w.sizes) + w.place] = ids
    place = (begin + head + w.sizes)[:, None] + 6 * (np.cumsum(there, axis=1) - 1)
    run[(place[there][:, None] + np.arange(6)).ravel()] = labels[there].ravel()
    data, sizes = _varints(run)
    sums = np.concatenate(([0], np.cumsum(sizes)))
    return data.tobytes(), _bounds(sums[np.append(begin[1:], len(run))] - sums[begin] if count else sums[:0], first)


def _string_table(found: numbering.Strings) -> tuple[memoryview, list[int]]:
    texts = [(text or "").encode() for text in found.values.to_pylist()]  # a missing label is no string
    heads = [_varints(np.array([50, len(text)]))[0].tobytes() if len(text) > 127 else bytes((50, len(text))) for text in texts]
    entries = pa.array([head + text for head, text in zip(heads, texts, strict=True)], pa.large_binary()).take(pa.array(found.code))
    entries = pa.concat_arrays([entries])
    ends = np.frombuffer(entries.buffers()[1], np.int64)[: len(entries) + 1]
    data = entries.buffers()[2]
    return memoryview(data) if data else memoryview(b""), _bounds(np.diff(ends), found.start)


def to_bodies(rows: pa.Table, first: np.ndarray) -> tuple[list[str], list[int]]:
    """Profiles as record bodies, and their numbers of frames, from their samples in order: time_ms,
    period_ms, tid, trace, span, frames root first. `first` tells where profiles start. Equal profiles
    give equal text. All numbers of a message are written at once, as varints."""
    w = numbering.walk(rows, first)
    # A missing name is the empty string, as a message has no other.
    func, file = (values.fill_null("").take(pa.array(codes[w.at[w.met]])) for values, codes in ((w.funcs, w.func), (w.files, w.file)))
    found = numbering.strings(rows, w, profiles.RESERVED, func, file)
    sections = [_samples(rows, w, found, first), _locations(w), _functions(w, found), _string_table(found)]
    bodies = []
    for k in range(len(first)):
        message = b"".join(data[at[k] : at[k + 1]] for data, at in sections)
        bodies.append(base64.b64encode(gzip.compress(message, _LEVEL, mtime=0)).decode("ascii"))
    return bodies, np.add.reduceat(w.sizes, first).tolist() if len(first) else []


def to_body(part: pa.Table) -> tuple[str, int]:
    """One profile as record body, and its number of frames."""
    (body,), (frames,) = to_bodies(part, np.zeros(1, np.int64))
    return body, frames


class Samples(NamedTuple):
    """Samples of a record: (time, period, thread, trace, span) each, and their frames, root first, as
    numbers of strings, and lines."""

    rows: list[tuple]
    sizes: list[int]
    text: list[str]
    file: np.ndarray
    func: np.ndarray
    line: np.ndarray


def _numbers(messages: list[bytes], tags: tuple[int, ...]) -> np.ndarray | None:
    """The numbers of messages that hold these fields, in this order; None for other messages."""
    data = np.frombuffer(b"".join(messages), np.uint8)
    ends = np.flatnonzero(data < 128)
    if len(ends) != 2 * len(tags) * len(messages) or not len(ends) or ends[-1] + 1 != len(data):
        return None
    sizes = np.diff(ends, prepend=-1)
    begin = ends - sizes + 1
    values = (data[begin] & 127).astype(np.uint64)
    longer = np.arange(len(ends))
    for k in range(1, min(10, int(sizes.max()))):
        longer = longer[sizes[longer] > k]
        values[longer] |= (data[begin[longer] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    pairs = values.view(np.int64).reshape(len(messages), len(tags), 2)
    # A message ends where the last number of its row does.
    whole = np.cumsum(np.fromiter(map(len, messages), np.int64, len(messages))) == ends[2 * len(tags) - 1 :: 2 * len(tags)] + 1
    return pairs[:, :, 1] if sizes.max() <= 10 and (pairs[:, :, 0] == tags).all() and whole.all() else None


def _coded(profile) -> tuple[np.ndarray, np.ndarray] | None:
    """(file, name) of functions and (function, line) of locations that are numbered from 1 as `to_bodies`
    does; None for others."""
    named, shown = _numbers(list(profile.function), (8, 16, 24, 32)), _numbers(list(profile.location), (8, 34, 8, 16))
    if named is None or shown is None:
        return None
    in_order = all((x[:, 0] == np.arange(1, len(x) + 1)).all() for x in (named, shown))
    if not in_order or shown[:, 2].min() < 1 or shown[:, 2].max() > len(named):
        return None
    return named[:, [3, 1]], np.stack((shown[:, 2] - 1, shown[:, 3]), axis=1)


def from_body(body: str) -> Samples:
    """What a record body holds. Bodies of other writers are read field by field."""
    data = gzip.decompress(base64.b64decode(body, validate=True))
    profile = profile_message("Coded")()
    profile.ParseFromString(data)
    text = list(profile.string_table)
    found = _coded(profile)
    if found:
        named, shown = found
        places = None
    else:
        other = profile_message()()
        other.ParseFromString(data)
        functions = {f.id: i for i, f in enumerate(other.function)}
        named = np.array([(f.filename, f.name) for f in other.function], np.int64).reshape(-1, 2)
        places = {p.id: i for i, p in enumerate(other.location)}
        shown = np.array([(functions[p.line[0].function_id], p.line[0].line) for p in other.location], np.int64).reshape(-1, 2)
    rows, sizes, stacks = [], [], []
    for sample in profile.sample:
        found = {text[label.key]: label for label in sample.label}
        number = {key: found[key].num if key in found else None for key in profiles.RESERVED}
        name = {key: text[found[key].str] if key in found else None for key in profiles.RESERVED}
        rows.append((
            number[profiles.LABEL_TIME], number[profiles.LABEL_PERIOD], number[profiles.LABEL_THREAD],
            name[profiles.LABEL_TRACE], name[profiles.LABEL_SPAN],
        ))
        ids = sample.location_id
        sizes.append(len(ids))
        stacks.append(np.array(ids, np.int64)[::-1] - 1 if places is None else np.array([places[i] for i in reversed(ids)], np.int64))
    at = np.concatenate([np.zeros(0, np.int64), *stacks])
    if len(at) and at.min() < 0:
        raise KeyError("unknown location")
    shown = shown[at]
    named = named[shown[:, 0]]
    if len(named) and (named.min() < 0 or named.max() >= len(text)):
        raise IndexError("unknown string")
    return Samples(rows, sizes, text, named[:, 0], named[:, 1], shown[:, 1])


SAMPLE_COLUMNS = ["sample", "time_ms", "period_ms", "tid", "trace", "span", "frames"]


def _encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and sample -> a record for each part."""
    for rows, first in numbering.parts(batches):
        bodies, frames = to_bodies(rows, first)
        keys = rows.select(profiles.KEY).take(pa.array(first)).combine_chunks().to_batches()[0]
        columns = [pa.array(frames, pa.int64()), pa.array(np.diff(first, append=rows.num_rows), pa.int64()), pa.array(bodies, pa.string())]
        yield pa.RecordBatch.from_arrays([*keys.columns, *columns], [*profiles.KEY, "total_frames", "samples", "body"])


_DECODED = [*profiles.KEY, "format", "sample", "time_ms", "period_ms", "tid", "trace_id", "span_id", "frames", "error"]


def _decoded(batch: pa.RecordBatch, done: list[tuple[int, Samples, str | None]]) -> pa.RecordBatch:
    """Decoded records as rows, one without a sample for a record that has none."""
    at = [i for i, found, _ in done for _ in found.rows or (None,)]
    columns = [batch.column(name).take(pa.array(at, pa.int64())) for name in (*profiles.KEY, "format")]
    columns.append(pa.array([k for _, found, _ in done for k in (range(1, len(found.rows) + 1) if found.rows else (None,))], pa.int32()))
    rows = [row for _, found, _ in done for row in found.rows or [(None,) * 5]]
    for values, kind in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()] * 2, strict=True):
        columns.append(pa.array(values, kind))
    base = np.cumsum([0, *(len(found.text) for _, found, _ in done)])
    table = pa.array([text for _, found, _ in done for text in found.text], pa.string())
    names = [
        table.take(pa.array(np.concatenate([getattr(found, which) + low for (_, found, _), low in zip(done, base, strict=False)]).astype(np.int64)))
        for which in ("file", "func")
    ]
    lines = pa.array(np.concatenate([found.line for _, found, _ in done]).astype(np.int64))
    frames = pa.StructArray.from_arrays([*names, lines], ["file", "func", "line"])
    offsets = np.cumsum([0, *(size for _, found, _ in done for size in (found.sizes or (0,)))])
    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), frames))
    columns.append(pa.array([error for _, found, error in done for _ in found.rows or (None,)], pa.string()))
    return pa.RecordBatch.from_arrays(columns, _DECODED)


def decode_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (key, format, body) to their samples."""
    none = np.zeros(0, np.int64)
    for batch in batches:
        done: list[tuple[int, Samples, str | None]] = []
        size = 0
        for i, body in enumerate(batch.column("body").to_pylist()):
            try:
                found, error = from_body(body), None
            except Exception as failure:  # noqa: BLE001 - one bad record must not stop the job
                found, error = Samples([], [], [], none, none, none), f"{type(failure).__name__}: {failure}"
            done.append((i, found, error))
            size += len(found.line)
            if size >= _FRAMES:
                yield _decoded(batch, done)
                done, size = [], 0
        if done:
            yield _decoded(batch, done)


def _key_schema(df: DataFrame) -> str:
    return KEY_SCHEMA.format(ts=df.schema["tick_ts"].dataType.simpleString())


def sample_columns(numbered: DataFrame, period_millis: int | None = None) -> DataFrame:
    """What the codec reads of a sample. The period follows from the source where none is given, so
    that continuous and snapshot samples may be encoded together."""
    of_source = F.create_map(*(F.lit(x) for item in profiles.PERIOD_MILLIS.items() for x in item))
    period = of_source[F.col("source")] if period_millis is None else F.lit(period_millis)
    return numbered.select(
        *profiles.KEY, "sample", clock.millis(F.col("tick_ts")).alias("time_ms"), period.cast("long").alias("period_ms"),
        F.col("tid").cast("long").alias("tid"), ids.trace_label(F.col("trace_id")).alias("trace"),
        ids.span_label(F.col("span_id")).alias("span"), "frames",
    )


def encode(numbered: DataFrame, period_millis: int | None = None, ranged: bool = False) -> DataFrame:
    """Numbered samples to (key, total_frames, samples, body), one row a part."""
    rows = profiles.in_parts(sample_columns(numbered, period_millis), ranged)
    return rows.mapInArrow(_encode, f"{_key_schema(numbered)}, total_frames bigint, samples bigint, body string")


def log_records(
    ticked: DataFrame, period_millis: int | None = None, part_samples: int = profiles.PART_SAMPLES, ranged: bool = False
) -> DataFrame:
    """Complete profile log records: the facts of every profile and its encoded body. With `ranged`, a task
    makes neighbouring records, which `write` need not spread."""
    columns = [*profiles.TICK, "ts", "tid", "sample_id", "trace_id", "span_id", "frames"]
    packed = stacks.packed(ticked.select(*columns))
    return profiles.with_attributes(encode(profiles.number_samples(packed, part_samples), period_millis, ranged))


def write(records: DataFrame, path: str, batch: int = 0, spread: bool = True) -> None:
    """Write one batch of records by date, service and source, beside the batches that are there.

    Only the partitions of this batch are replaced, so writing it again changes nothing. Rebalancing
    keeps the number of files down and still splits a service that holds much of the data. Records that
    lie in the order of their keys (`ranged`) have that already and need no shuffle (`spread`).
    """
    dated = records.withColumns({"date": F.to_date("tick_ts"), "batch": F.lit(batch)})
    rows = dated.hint("rebalance", F.col("date"), F.col("service"), F.col("source")) if spread else dated
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date", "service", "source", "batch"
    ).parquet(path, compression="zstd")


def write_stream(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of records to the same layout; a batch that is repeated after a failure replaces itself."""
    def save(batch: DataFrame, number: int) -> None:
        write(batch, path, number)

    return records.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read(spark: SparkSession, path: str, begin: str | None = None, end: str | None = None) -> DataFrame:
    """Written records whose tick lies in [begin, end); the days outside are not opened."""
    records = spark.read.parquet(path)
    kind = records.schema["tick_ts"].dataType
    if begin is not None:
        records = records.where((F.col("date") >= F.to_date(F.lit(begin))) & (F.col("tick_ts") >= F.lit(begin).cast(kind)))
    if end is not None:
        records = records.where((F.col("date") <= F.to_date(F.lit(end))) & (F.col("tick_ts") < F.lit(end).cast(kind)))
    return records


def decode(records: DataFrame) -> DataFrame:
    """Profile log records to one row per sample.

    Records of other scopes never reach Python. A record that cannot be decoded, or holds no
    sample, gives one row without a sample.
    """
    wanted = records.filter(F.col("scope") == profiles.SCOPE).select(
        *profiles.KEY,
        F.col("attributes").getItem(FORMAT_ATTRIBUTE).alias("format"),
        "body",
    )
    return wanted.mapInArrow(decode_batches, f"{_key_schema(records)}, {DECODED_SCHEMA}")
