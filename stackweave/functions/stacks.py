"""Stacks as text while they travel.

A frame as a row takes some 70 bytes, most of them offsets and padding. Where rows with stacks are
sorted, shuffled or written and nobody looks at the frames, a stack is one compressed text: its flags,
sizes, lines and names, each as a run, by zstd, in characters of seven bits. Each text stands for
itself. Nothing is lost: missing stacks and missing parts of frames stay missing, empty stacks stay
empty. Tasks that read frames in Python parse the texts there (`frames_of`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAMES = "array<struct<file:string,func:string,line:int>>"
_FILE, _FUNC, _LINE = 1, 2, 4  # flags of the parts that a frame has
_HEAD = 16  # frames, then bytes of a file's size, a name's size and a line number


def is_packed(df: DataFrame) -> bool:
    return "frames" in df.columns and isinstance(df.schema["frames"].dataType, T.StringType)


def kind_of(df: DataFrame) -> str:
    """The type of frames, as packed stacks come back by default."""
    return FRAMES if is_packed(df) else df.schema["frames"].dataType.simpleString()


def _names(column: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Offsets of texts in their bytes, and which of them are there."""
    column = pa.concat_arrays([column.cast(pa.string())])
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    return ends.astype(np.int64), column.is_valid().to_numpy(zero_copy_only=False), data.to_pybytes() if data else b""


def _narrow(values: np.ndarray, kind: str) -> np.ndarray:
    """In as few bytes as hold them all."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    for size in (1, 2, 4):
        bounds = np.iinfo(f"{kind}{size}")
        if bounds.min <= low and high <= bounds.max:
            return values.astype(f"<{kind}{size}")
    return values.astype(f"<{kind}8")


def _seven_bits(data: bytes) -> bytes:
    eight = np.zeros((-(-len(data) // 7), 8), np.uint8)
    eight[:, :7] = np.frombuffer(data.ljust(7 * len(eight), b"\0"), np.uint8).reshape(-1, 7)
    numbers = eight.view("<u8")
    return ((numbers >> np.arange(0, 56, 7, dtype=np.uint64)) & np.uint64(127)).astype(np.uint8).tobytes()


def _eight_bits(text: bytes) -> bytes:
    numbers = np.frombuffer(text, np.uint8).reshape(-1, 8).astype("<u8") << np.arange(0, 56, 7, dtype=np.uint64)
    whole = np.bitwise_or.reduce(numbers, axis=1).astype("<u8")
    return whole.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def texts_of(frames: pa.ListArray) -> pa.Array:
    """Stacks as text."""
    here = frames.is_valid().to_numpy(zero_copy_only=False)
    sizes = frames.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    flat = frames.flatten()
    (file, file_valid, file_data), (func, func_valid, func_data) = (_names(flat.field(k)) for k in (0, 1))
    lines = flat.field(2).cast(pa.int64())
    line_valid = lines.is_valid().to_numpy(zero_copy_only=False)
    whole = flat.is_valid().to_numpy(zero_copy_only=False)
    flags = (file_valid * _FILE + func_valid * _FUNC + line_valid * _LINE).astype(np.uint8) * whole.astype(np.uint8)
    line = lines.fill_null(0).to_numpy()
    codec = pa.Codec("zstd", 3)
    out: list[str | None] = []
    for there, high, size in zip(here.tolist(), ends.tolist(), sizes.tolist(), strict=True):
        if not there:
            out.append(None)
            continue
        low = high - size
        columns = [_narrow(np.diff(file[low : high + 1]), "u"), _narrow(np.diff(func[low : high + 1]), "u"), _narrow(line[low:high], "i")]
        head = np.array([size, *(column.itemsize for column in columns)], "<u4").tobytes()
        raw = b"".join((
            head, flags[low:high].tobytes(), *(column.tobytes() for column in columns),
            file_data[file[low] : file[high]], func_data[func[low] : func[high]],
        ))
        packed = codec.compress(raw, asbytes=True)
        out.append(_seven_bits(np.array([len(raw), len(packed)], "<u4").tobytes() + packed).decode("ascii"))
    return pa.array(out, pa.string())


def frames_of(texts: pa.Array) -> pa.ListArray:
    """Stacks that have been packed, as lists of frames; a missing one stays missing."""
    codec = pa.Codec("zstd")
    sizes, flags, files, funcs, lines, file_data, func_data = [], [], [], [], [], [], []
    for text in texts:
        text = text.as_buffer()
        if text is None:
            sizes.append(0)
            continue
        data = _eight_bits(text)
        length, packed = np.frombuffer(data, "<u4", 2).tolist()
        raw = codec.decompress(data[8 : 8 + packed], length, asbytes=True)
        size, *widths = np.frombuffer(raw, "<u4", 4).tolist()
        at = _HEAD + size
        sizes.append(size)
        flags.append(np.frombuffer(raw, np.uint8, size, _HEAD))
        for found, width, kind in zip((files, funcs, lines), widths, "uui", strict=True):
            found.append(np.frombuffer(raw, f"<{kind}{width}", size, at).astype(np.int64))
            at += size * width
        split = at + int(files[-1].sum())
        file_data.append(raw[at:split])
        func_data.append(raw[split:])
    join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
    flag = join(flags, np.uint8)

    def valid(which: int) -> pa.Buffer:
        return pa.py_buffer(np.packbits(flag & which != 0, bitorder="little").tobytes())

    def names(parts: list, data: list[bytes], which: int) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(join(parts, np.int64))))
        kind, offsets = (pa.string(), ends.astype(np.int32)) if ends[-1] < 2**31 else (pa.large_string(), ends)
        return pa.Array.from_buffers(kind, len(flag), [valid(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(data))])

    line = pa.Array.from_buffers(pa.int64(), len(flag), [valid(_LINE), pa.py_buffer(join(lines, np.int64).tobytes())])
    frames = pa.StructArray.from_arrays([names(files, file_data, _FILE), names(funcs, func_data, _FUNC), line], ["file", "func", "line"])
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    missing = pa.array(~texts.is_valid().to_numpy(zero_copy_only=False)) if texts.null_count else None
    return pa.ListArray.from_arrays(offsets, frames, mask=missing)


def packed(df: DataFrame) -> DataFrame:
    """The same rows, with `frames`, if there are any, as text."""
    if "frames" not in df.columns or is_packed(df):
        return df

    @F.arrow_udf("string")
    def pack(frames: pa.Array) -> pa.Array:
        return texts_of(frames)

    return df.withColumn("frames", pack("frames"))


def unpacked(df: DataFrame, kind: str = FRAMES) -> DataFrame:
    """Rows of `packed` with their frames again, as an array of `kind`."""
    if not is_packed(df):
        return df

    @F.arrow_udf("array<struct<file:string,func:string,line:bigint>>")
    def unpack(texts: pa.Array) -> pa.Array:
        return frames_of(texts)

    return df.withColumn("frames", unpack("frames").cast(kind))
