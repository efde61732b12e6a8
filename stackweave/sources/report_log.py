"""Dependency reports as log bodies: base64 text of gzipped JSON."""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = (
    "id string, fragment_index int, max_fragments int, is_done boolean, "
    "packages array<struct<name:string,version:string>>"
)


@F.pandas_udf(T.BinaryType())
def _gzip(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: gzip.compress(text.encode("utf-8"), mtime=0))


@F.pandas_udf(T.StringType())
def _gunzip(bodies: pd.Series) -> pd.Series:
    def text(body):
        try:
            return gzip.decompress(body).decode("utf-8")
        except (OSError, EOFError, zlib.error, UnicodeDecodeError, TypeError):
            return None

    return bodies.map(text)


def body_of(report: Column) -> Column:
    return F.base64(_gzip(F.to_json(report)))


def encode(fragments: DataFrame) -> DataFrame:
    """Fragments as log records with an encoded body."""
    report = F.struct("id", "fragment_index", "max_fragments", "is_done", "packages")
    return fragments.select(body_of(report).alias("body"))


def decode(records: DataFrame, *keep: str) -> DataFrame:
    """Encoded bodies as report fragments; all fields are null where a body is broken."""
    json = _gunzip(F.try_to_binary("body", F.lit("base64")))
    return records.select(*keep, F.from_json(json, REPORT_SCHEMA).alias("_r")).select(*keep, "_r.*")
