import base64
import gzip
import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa

from stackweave.operators import profiles
from stackweave.sources import profile_log

FRAMES = pa.list_(pa.struct([("file", pa.string()), ("func", pa.string()), ("line", pa.int64())]))
FACTS = [("time_ms", pa.int64()), ("period_ms", pa.int64()), ("tid", pa.int64()), ("trace", pa.string()), ("span", pa.string())]


def sample(dice):
    stack = [(dice.choice([None, "", "f", "span_id", "g" * 150]), f"h{dice.randrange(300)}", dice.choice([None, 0, 1, 200, -5, 2**31])) for _ in range(dice.randrange(300))]
    facts = (dice.choice([None, 0, 2**45, -3]), 100, dice.choice([None, 1, -7, 2**62]), dice.choice([None, "", "ab", "trace_id"]), dice.choice([None, "cd"]))
    return (*facts, dice.choice([None, [], stack, stack]))


def rows_of(parts):
    rows = [row for part in parts for row in part]
    columns = {name: pa.array([row[k] for row in rows], kind) for k, (name, kind) in enumerate(FACTS)}
    stacks = [None if row[5] is None else [dict(zip(("file", "func", "line"), frame, strict=True)) for frame in row[5]] for row in rows]
    return pa.table({**columns, "frames": pa.array(stacks, FRAMES)}), np.cumsum([0, *map(len, parts[:-1])])


def shown(found):
    ends = np.cumsum([0, *found.sizes])
    frames = [(found.text[a], found.text[b], int(line)) for a, b, line in zip(found.file, found.func, found.line, strict=True)]
    return [(*row, frames[low:high]) for row, low, high in zip(found.rows, ends, ends[1:], strict=False)]


def test_parts_that_are_encoded_together_hold_their_own_samples():
    for seed in range(20):
        dice = random.Random(seed)
        parts = [[sample(dice) for _ in range(dice.randrange(1, 4))] for _ in range(dice.randrange(1, 5))]
        bodies, frames = profile_log.to_bodies(*rows_of(parts))
        for part, body, count in zip(parts, bodies, frames, strict=True):
            assert count == sum(len(row[5] or []) for row in part)
            assert shown(profile_log.from_body(body)) == [(*row[:5], [(f or "", g or "", line or -1) for f, g, line in row[5] or []]) for row in part]
            assert body == profile_log.to_body(rows_of([part])[0])[0]


def test_bodies_of_other_writers_are_read_alike():
    """Numbers left out, other ids and another order of fields."""
    dice = random.Random(7)
    part = [sample(dice) for _ in range(3)] + [(0, 100, 1, None, None, [("source.event.time", "g", 5)])]
    body = profile_log.to_body(rows_of([part])[0])[0]
    profile = profile_log.profile_message()()
    profile.ParseFromString(gzip.decompress(base64.b64decode(body)))
    for shift in (0, 9):
        for place in profile.location:
            place.id += shift
        for stack in profile.sample:
            stack.location_id[:] = [i + shift for i in stack.location_id]
        other = base64.b64encode(gzip.compress(profile.SerializeToString())).decode()
        assert shown(profile_log.from_body(other)) == shown(profile_log.from_body(body))


def test_ranged_records_are_written_without_a_shuffle(spark, tmp_path):
    """Neighbouring records come from one task, so a day of a service has few files though nothing is spread."""
    start = datetime(2024, 1, 1)
    rows = [(f"s{k % 3}", k, start + timedelta(hours=k // 3 % 240), k, None, None, [("f", f"g{k}", 1)]) for k in range(1440)]
    df = spark.createDataFrame(rows, "service string, tid long, ts timestamp_ntz, sample_id long, trace_id string, span_id string, frames array<struct<file:string,func:string,line:int>>")
    records = profile_log.log_records(profiles.in_ticks(df, period="1 hour"), ranged=True)
    path = str(tmp_path / "out")
    profile_log.write(records, path, spread=False)
    files = list((tmp_path / "out").rglob("part-*.parquet"))
    assert len(files) <= 3 * 10 + 2 * 4 and all(".zstd." in file.name for file in files)
    found = profile_log.decode(spark.read.parquet(path)).select("service", "tid", "tick_ts", "part", "sample")
    want = profile_log.decode(profile_log.log_records(profiles.in_ticks(df, period="1 hour"))).select(found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and found.count() == 1440
