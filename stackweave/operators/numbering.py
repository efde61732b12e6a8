"""The numbers of parts' functions, locations and strings, from their samples as Arrow columns.

Spark orders the samples, cuts ticks into parts and sorts each task's rows by part and sample; here some
whole parts at a time are walked, sample by sample and each stack from its leaf. Small parts share the
walk, so that a part of one sample costs little; a large one is walked alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from stackweave.functions import stacks

_ROWS = 256  # samples that are walked together, if their parts are smaller


def parts(batches: Iterable[pa.RecordBatch], rows: int = _ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by part and sample -> those of some whole parts, and the places at which parts start."""
    held: list[pa.RecordBatch] = []
    count = 0

    def group() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        return table, np.flatnonzero(table["sample"].to_numpy() == 1)

    for batch in batches:
        if not batch.num_rows:
            continue
        # A part starts with its first sample.
        starts = np.flatnonzero(batch.column("sample").to_numpy(zero_copy_only=False) == 1).tolist()
        edges = [0, *(start for start in starts if start), batch.num_rows]
        fresh = {0: bool(starts) and starts[0] == 0}
        for begin, end in zip(edges, edges[1:], strict=False):
            if count >= rows and fresh.get(begin, True):
                yield group()
                held.clear()
                count = 0
            held.append(batch.slice(begin, end - begin))
            count += end - begin
    if held:
        yield group()


def first_seen(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at which new codes are met, in order, and for every code the number of its first one."""
    number = pd.factorize(codes)[0].astype(np.int64)
    met = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1)) if len(number) else number
    return met, number


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers for the values of a column, missing ones included, and the values."""
    encoded = pc.dictionary_encode(column, null_encoding="encode")
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


class Walk(NamedTuple):
    """Frames of some parts in the order of numbering. Codes stand for frames as they lie; `at` tells which
    of them is met when, `met` and `new` when a function or a location is met first in its part. Numbers
    go on from part to part; `function_start` and `location_start` tell where those of a part begin."""

    part: np.ndarray
    sizes: np.ndarray
    ends: np.ndarray
    at: np.ndarray
    place: np.ndarray
    sample: np.ndarray
    file: np.ndarray
    files: pa.Array
    func: np.ndarray
    funcs: pa.Array
    line: np.ndarray
    lines: pa.Array
    met: np.ndarray
    function_of: np.ndarray
    function_start: np.ndarray
    new: np.ndarray
    location_of: np.ndarray
    location_start: np.ndarray


def walk(rows: pa.Table | pa.RecordBatch, first: np.ndarray) -> Walk:
    """`first` has the places at which parts start."""
    found = rows["frames"].combine_chunks() if isinstance(rows, pa.Table) else rows["frames"]
    found = stacks.frames_of(found) if pa.types.is_string(found.type) else found
    found = found.fill_null(pa.scalar([], found.type)) if found.null_count else found
    part = np.repeat(np.arange(len(first)), np.diff(first, append=len(found)))
    sizes = np.diff(found.offsets.to_numpy()).astype(np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    # Frames in the order of numbering: sample by sample, each from its leaf.
    at = np.repeat(2 * ends - sizes - 1, sizes) - np.arange(total)
    place = np.arange(total) - np.repeat(ends - sizes, sizes)
    sample = np.repeat(np.arange(len(sizes)), sizes)
    flat = found.flatten()
    (file, files), (func, funcs), (line, lines) = (_codes(flat.field(name)) for name in ("file", "func", "line"))
    met, function_of = first_seen(((part[sample] * len(files) + file[at]) * len(funcs)) + func[at])
    new, location_of = first_seen(function_of * len(lines) + line[at])
    numbers = np.arange(len(first))
    starts = [np.searchsorted(part[sample[places]], numbers) for places in (met, new)]
    return Walk(part, sizes, ends, at, place, sample, file, files, func, funcs, line, lines, met, function_of, starts[0], new, location_of, starts[1])


class Strings(NamedTuple):
    """The strings of some parts in the order of their numbers: their texts, whether a label may use
    them, and where those of a part begin; and the numbers of labels and of functions' names and files
    within their part, -1 for a missing label."""

    values: pa.Array
    code: np.ndarray
    in_labels: np.ndarray
    start: np.ndarray
    trace: np.ndarray
    span: np.ndarray
    func: np.ndarray
    file: np.ndarray


def strings(rows: pa.Table | pa.RecordBatch, w: Walk, reserved: tuple[str, ...], func: pa.Array, file: pa.Array) -> Strings:
    """Strings in the order in which they are met: the reserved ones, then labels before the frames of
    their sample, and a name before its file. A missing label is no string, a missing name is one."""
    labels = [rows[name] for name in ("trace", "span")]
    labels = [(x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).cast(pa.string()) for x in labels]
    count, held, known = len(w.sizes), len(w.met), len(reserved)
    parts = len(w.function_start)
    tokens = pa.concat_arrays([pa.array(reserved, pa.string()), *labels, func.cast(pa.string()), file.cast(pa.string())])
    codes, values = _codes(tokens)
    # Where each token stands in the order of all.
    of_row = w.sample[w.met]
    many = np.bincount(of_row, minlength=count)
    before = np.cumsum(many) - many
    base = known * (w.part + 1) + 2 * np.arange(count) + 2 * before
    opening = base[np.searchsorted(w.part, np.arange(parts))] - known
    named = base[of_row] + 2 + 2 * (np.arange(held) - before[of_row])
    places = np.concatenate([(opening[:, None] + np.arange(known)).ravel(), base, base + 1, named, named + 1])
    code = np.concatenate([np.tile(codes[:known], parts), codes[known:]])
    part = np.concatenate([np.repeat(np.arange(parts), known), w.part, w.part, w.part[of_row], w.part[of_row]])
    there = np.ones(len(places), bool)
    low = known * parts
    for k, label in enumerate(labels):
        there[low + k * count : low + (k + 1) * count] = label.is_valid().to_numpy(zero_copy_only=False)
    key = np.full(len(places), -1, np.int64)
    key[places[there]] = (part * len(values) + code)[there]
    order = np.flatnonzero(key >= 0)
    met, number = first_seen(key[order])
    met_key = key[order[met]]
    start = np.searchsorted(met_key // len(values), np.arange(parts)) if len(values) else np.zeros(parts, np.int64)
    numbers = np.full(len(places), -1, np.int64)
    numbers[order] = number
    numbers = numbers[places]
    in_labels = np.zeros(len(met), bool)
    of_label = numbers[: low + 2 * count]
    in_labels[of_label[of_label >= 0]] = True
    local = np.where(numbers >= 0, numbers - start[part], -1)
    cuts = np.cumsum([low, count, count, held])
    _, trace, span, func_number, file_number = np.split(local, cuts)
    return Strings(values, met_key % max(1, len(values)), in_labels, start, trace, span, func_number, file_number)


def _lists(values: pa.Array, start: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(start, len(values)).astype(np.int32)), values)


def dictionaries(key: list[str], reserved: tuple[str, ...], with_strings: bool, line: str):
    """For each part its functions, locations and strings (none, if they are not asked for), as lists in the
    order of their numbers. `line` is the type of lines."""
    kind = {"int": pa.int32(), "bigint": pa.int64()}[line]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in parts(batches):
            w = walk(rows, begin)
            first, new = w.at[w.met], w.at[w.new]
            file, func = (values.take(pa.array(codes[first])) for values, codes in ((w.files, w.file), (w.funcs, w.func)))
            located = [values.take(pa.array(codes[new])) for values, codes in ((w.files, w.file), (w.funcs, w.func), (w.lines, w.line))]
            located[2] = located[2].cast(kind)
            if with_strings:
                found = strings(rows, w, reserved, func, file)
                listed = pa.StructArray.from_arrays([found.values.take(pa.array(found.code)), pa.array(found.in_labels)], ["token", "in_labels"])
                listed = _lists(listed, found.start)
            else:
                listed = _lists(pa.array([], pa.struct([("token", pa.string()), ("in_labels", pa.bool_())])), np.zeros(len(begin), np.int32))
            keys = rows.select(key).take(pa.array(begin)).combine_chunks().to_batches()[0]
            columns = [
                _lists(pa.StructArray.from_arrays([file, func], ["file", "func"]), w.function_start),
                _lists(pa.StructArray.from_arrays(located, ["file", "func", "line"]), w.location_start), listed,
            ]
            yield pa.RecordBatch.from_arrays([*keys.columns, *columns], [*key, "functions", "locations", "strings"])

    return run


def located(columns: list[str]):
    """Samples with the numbers of their frames' locations, leaf first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in parts(batches):
            w = walk(rows, begin)
            ids = w.location_of - w.location_start[w.part[w.sample]] + 1
            found = _lists(pa.array(ids), w.ends - w.sizes)
            kept = rows.select(columns).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([*kept.columns, found], [*columns, "location_ids"])

    return run
