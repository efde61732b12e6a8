"""Compare a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import pathlib

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if (pathlib.Path(folder) / f"{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def kind(name: str) -> str:
    name = name.lower()
    for word, label in (
        ("timestamp", "time"), ("bool", "bool"), ("bigint", "long"), ("long", "long"),
        ("hugeint", "huge"), ("int", "int"), ("double", "double"), ("float", "float"),
        ("decimal", "decimal"), ("varchar", "text"), ("string", "text"),
    ):
        if word in name:
            return label
    return name


def difference(df, con, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    cursor = con.execute(sql)
    want_types = {d[0]: kind(str(d[1])) for d in cursor.description}
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    got_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    order = sorted(want_names)
    got = df.select(*order).collect()
    at = [want_names.index(name) for name in order]
    left = sorted(repr(tuple(row)) for row in got)
    right = sorted(repr(tuple(row[i] for i in at)) for row in want)
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        return f"{len(left)} rows against {len(right)}; {only_left} != {only_right}"
    return None
