"""What several corpus operators share: tables, words, work tables and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stackweave import session

# White space of the contracts: space and the six control characters \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
ROW = "_row"
# Null ids sort last.
NO_ID = 2**63 - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    session.prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def words(text: Column) -> Column:
    """Words in order; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda word: word != "")


def word_count(text: Column) -> Column:
    """How many words a text has: the white-space runs between its trimmed ends, plus one."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def in_training(doc_id: Column) -> Column:
    """Rows labels may be learned from; the others are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0)) != 1


def first_by(rows: DataFrame, order: Column, number: int, size: int | None = None) -> DataFrame:
    """The ``number`` rows with the least hash ``order`` (a long).

    Most rows are left out by a threshold before any is sent to the task that takes the first:
    hashes are even, so of ``size`` rows (counted if not given) four times as many as are wanted
    pass it. Only where the size given is far too great can fewer than ``number`` come.
    """
    size = rows.count() if size is None else size
    share = min(1.0, 4 * number / max(1, size))
    least = order < F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)
    return rows.where(least).orderBy(order).limit(number)


def with_arrow_columns(df: DataFrame, fields: Iterable[T.StructField], compute: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """df and new columns that ``compute`` makes from each Arrow batch; the others pass through."""
    session.prepare(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *fields])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for batch in batches:
            new = compute(batch)
            kinds = [field.type for field in target][batch.num_columns :]
            arrays = [*batch.columns, *(pa.array(values, kind) for values, kind in zip(new, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=target.names)
        give_back()

    return df.mapInArrow(extend, schema)


def sealed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others as one column that no other name can clash with."""
    others = [F.col(f"`{name}`") for name in docs.columns if name not in names]
    return docs.select(*names, F.struct(*others or [F.lit(0).alias("none")]).alias(ROW))


def unsealed(df: DataFrame, columns: list[str], *names: str, **changed: Column) -> DataFrame:
    """The rows that ``sealed`` put away, with some columns replaced."""
    own = {name: F.col(name) if name in names else F.col(ROW).getField(name) for name in columns}
    return df.select(*(changed.get(name, own[name]).alias(name) for name in columns))


def bounded_groups(texts: Iterable[str | bytes | None], size: int) -> Iterator[list]:
    """Consecutive texts in lists of at most ``size`` characters; a longer text is alone."""
    group, held = [], 0
    for text in texts:
        more = len(text or "")
        if group and held + more > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += more
    if group:
        yield group


def give_back() -> None:
    """Return freed memory to the system, so that a Python worker that waits for its next task
    holds little of its executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class WorkTable:
    """A table in the shared folder that can be dropped when nothing reads it any more."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = session.new_folder(self.spark, label)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame) -> DataFrame:
    """Connected components: links (a long, b long) -> (node, component), component the smallest node.

    Alternates large-star and small-star steps until nothing changes. A step is one
    pre-aggregated minimum and one join by node, so a hub with most of the links is split
    like any skewed join key. Every round is written to the shared folder and the round
    before it is dropped; links never reach the driver, only a count and a checksum do.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = WorkTable(pairs.where("u != v").distinct(), "links")
    mark = _mark(current.df)
    while mark[0]:
        stars = WorkTable(_small_star(_large_star(current.df)), "links")
        current.drop()
        current, before, mark = stars, mark, _mark(stars.df)
        if mark == before:
            break
    found = current.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), sums).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    down = edges.where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
