"""Hard-negative mining with exact scores by the method of the Four Russians.

Components become integers, floor(256 x), and a score is their inner product. The eight
components of a group have 256 subsets, so for every anchor and group a table holds the sums of
all subsets. A candidate is cut into bit planes (two's complement); in a plane the eight bits of
a group are one byte, and the byte is the index of the table entry that this plane adds. Planes
are summed from the highest down, doubling in between: table look-ups, shifts and additions give
the exact score without a product.

Candidates stay where they are read and are never shuffled or paired by a join. Anchors are a
stated query set; they go round in groups of at most ``GROUP`` rows, which bounds what is sent to
the tasks whatever the input. For a group, every task first scores the candidates of an anchor's
own label and keeps the best few; the winners of all tasks give the positives, and with them the
band of scores that a negative must lie in. Then every task scores the candidates of other labels
and keeps the best few of each band. So each pair is scored once, and what is shuffled is a few
rows for each anchor and task. What a task holds is bounded by ``BLOCK`` and ``ROWS``.

Defined cases: a null label or vector, or a null, NaN or infinite component, leaves a row out; so
does a null vec_id, by which no result could name it, and a component from 2**16 on, whose scores
would not fit a long. Shorter vectors count as filled up with zeros. Rows with an anchor's own
vec_id are the anchor and no candidates of it; of anchors that share an id the one with the least
label and vector counts. Other repeated rows are rows of their own. Anchors without positives and
positives without negatives give no rows. Columns other than the three take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackweave import session
from stackweave.llm import common

SCALE = 256
EVERY = 50
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
GROUP = 200_000  # anchors in a round, at most; four bytes a component
BLOCK = 256  # anchors whose tables are held at once
ROWS = 2000  # candidates scored at once
LARGEST = 2**16
_NONE = -(2**62)
_LAST = 2**63 - 1


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    number = F.col("embedding").cast("array<double>")
    fits = lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)) & ~F.isnan(x)
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), number.alias("vector"))
    return known.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vector", fits), F.lit(False)))


def mislabelled(rows: DataFrame) -> DataFrame:
    """The contract's labels: every seventh row gets the next one."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def _integers(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of numbers -> a matrix of floor(256 x), filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
    width = width or -(-max(1, int(sizes.max(initial=0))) // 8) * 8
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(group of eight components, subset, anchor) -> sum of the components in the subset."""
    groups = anchors.shape[1] // 8
    tables = np.zeros((groups, 256, len(anchors)), np.int64)
    for bit in range(8):
        # Sums with this component follow those without it.
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + anchors.T.reshape(groups, 8, 1, -1)[:, bit]
    return tables


def bit_planes(candidates: np.ndarray) -> np.ndarray:
    """(plane, candidate, group of eight components) -> byte; the last plane is the sign's."""
    most = max(int(candidates.max(initial=0)), -int(candidates.min(initial=0)) - 1, 0)
    planes = most.bit_length() + 1
    bits = [(candidates >> plane & 1).astype(np.uint8) for plane in range(planes)]
    return np.stack([np.packbits(b, axis=1, bitorder="little") for b in bits])


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products, (candidate, anchor), from look-ups, shifts and additions."""
    total = None
    for number in range(len(planes) - 1, -1, -1):
        part = tables[0][planes[number][:, 0]]
        for group in range(1, len(tables)):
            part += tables[group][planes[number][:, group]]
        if total is None:
            total = -part
        else:
            np.left_shift(total, 1, out=total)
            total += part
    return total


def _tables(anchors: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables and planes of one width, in 32 bits where all scores fit."""
    width = max(anchors.shape[1], candidates.shape[1])
    a, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, candidates))
    tables = subset_sums(a)
    largest = np.abs(c).max(initial=0) * 2 + 1
    if np.abs(a).sum(axis=1).max(initial=0) * largest < 2**30:
        tables = tables.astype(np.int32)
    return tables, bit_planes(c)


class Best:
    """The first few (score descending, id ascending) candidates of each slot, a slot being an anchor
    or a band of one; candidates come in any order."""

    def __init__(self, slots: int, size: int):
        self.score = np.full((slots, size), _NONE, np.int64)
        self.vec_id = np.full((slots, size), _LAST, np.int64)

    def wanted(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which of the scores (candidate, slot) would enter their slot."""
        last, last_id = self.score[slots, -1], self.vec_id[slots, -1]
        return (score > last) | ((score == last) & (ids[:, None] < last_id))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, places = np.unique(slot, return_inverse=True)
        size = self.score.shape[1]
        slots = np.concatenate((places, np.repeat(np.arange(len(touched)), size)))
        score = np.concatenate((score, self.score[touched].ravel()))
        ids = np.concatenate((ids, self.vec_id[touched].ravel()))
        order = np.lexsort((ids, -score, slots))
        starts = np.searchsorted(slots[order], np.arange(len(touched)))
        first = order[starts[:, None] + np.arange(size)]
        self.score[touched], self.vec_id[touched] = score[first], ids[first]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all places taken."""
        slot, place = np.nonzero(self.score != _NONE)
        return slot, self.score[slot, place], self.vec_id[slot, place]


class Anchors:
    """A group of anchors as a task gets it: ids, labels, integers, and bands once they are known."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")]).combine_chunks()
        column = table["vector"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64()))
        self.ids, self.labels = (table[name].to_numpy().astype(np.int64) for name in ("vec_id", "label"))
        self.vectors = _integers(column).astype(np.int32)
        self.low = self.high = None

    def bands(self, positives: pa.Table) -> None:
        """Score limits of each anchor's positives; a band without a positive is empty."""
        self.low = np.full((len(self.ids), POSITIVES), _LAST, np.int64)
        self.high = np.full((len(self.ids), POSITIVES), _NONE, np.int64)
        place = np.argsort(self.ids)
        row = place[np.searchsorted(self.ids, positives["anchor_id"].to_numpy(), sorter=place)]
        number, score = positives["place"].to_numpy() - 1, positives["positive_score"].to_numpy()
        self.low[row, number] = -(-LOW * score // 100)
        self.high[row, number] = HIGH * score // 100


def _blocks(anchors: Anchors, chosen: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, len(chosen), BLOCK):
        yield chosen[start : start + BLOCK]


def _best_positives(anchors: Anchors, best: Best, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        begin, end = np.searchsorted(anchors.labels, [label, label + 1])
        for block in _blocks(anchors, np.arange(begin, end)):
            score = scores(*_tables(anchors.vectors[block], vectors[rows]))
            enter = best.wanted(block, score, ids[rows]) & (ids[rows][:, None] != anchors.ids[block])
            row, column = np.nonzero(enter)
            if len(row):
                best.add(block[column], score[row, column].astype(np.int64), ids[rows][row])


def _best_negatives(anchors: Anchors, best: Best, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
    with_band = np.flatnonzero((anchors.low <= anchors.high).any(axis=1))
    for block in _blocks(anchors, with_band):
        score = scores(*_tables(anchors.vectors[block], vectors))
        low, high = anchors.low[block], anchors.high[block]
        # Few scores lie in any band of their anchor and beat the least that is kept.
        least = np.maximum(low, best.score.reshape(-1, POSITIVES, NEGATIVES)[block, :, -1]).min(axis=1)
        other = labels[:, None] != anchors.labels[block]
        row, column = np.nonzero((score >= least) & (score <= high.max(axis=1)) & other)
        found = score[row, column].astype(np.int64)
        for number in range(POSITIVES):
            slot = block[column] * POSITIVES + number
            inside = (found >= low[column, number]) & (found <= high[column, number])
            last, last_id = best.score[slot, -1], best.vec_id[slot, -1]
            enter = inside & ((found > last) | ((found == last) & (ids[row] < last_id)))
            if enter.any():
                best.add(slot[enter], found[enter], ids[row][enter])


def _search(rows: DataFrame, anchors: Anchors, negatives: bool) -> DataFrame:
    """Each task's best candidates: anchor_id, place (of the positive), score, vec_id."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)
    size, slots, find = (NEGATIVES, POSITIVES, _best_negatives) if negatives else (POSITIVES, 1, _best_positives)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        best = Best(len(mine.ids) * slots, size)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids, labels = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                column = part.column(2)
                column = pa.ListArray.from_arrays(pa.array(column.offsets.to_numpy() - column.offsets[0].as_py(), pa.int32()), column.flatten())
                find(mine, best, ids, labels, _integers(column))
        slot, score, vec_id = best.rows()
        for start in range(0, len(slot), 100_000):
            at = slice(start, start + 100_000)
            arrays = [mine.ids[slot[at] // slots], slot[at] % slots + 1, score[at], vec_id[at]]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["anchor_id", "place", "score", "vec_id"])

    return rows.mapInArrow(search, "anchor_id long, place long, score long, vec_id long")


def _ranked(found: DataFrame, most: int, *keys: str) -> DataFrame:
    """The first few of all tasks; Spark cuts each group down before it is shuffled."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, is_anchor: Column | None = None) -> DataFrame:
    """vec_id, label, vector -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = session.prepare(rows.sparkSession)
    wanted = is_anchor if is_anchor is not None else F.col("vec_id") % EVERY == 0
    rows = rows.select("vec_id", "label", "vector")
    one = F.min(F.struct("label", "vector")).alias("one")
    asked = common.WorkTable(rows.where(wanted).groupBy("vec_id").agg(one).select("vec_id", "one.*"), "anchors").df
    rounds = -(-asked.count() // (GROUP // 2)) or 1
    out = None
    for number in range(rounds):
        # Rounds are dealt by a hash to half a group, so that none comes near a whole one.
        table = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == number).toArrow()
        anchors = Anchors(table)
        best = _ranked(_search(rows, anchors, False), POSITIVES, "anchor_id")
        positives = common.WorkTable(best.select(
            "anchor_id", F.col("rank").cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        ), "positives").df
        anchors.bands(positives.select("anchor_id", "place", "positive_score").toArrow())
        negatives = _ranked(_search(rows, anchors, True), NEGATIVES, "anchor_id", "place")
        found = negatives.join(positives, ["anchor_id", "place"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        out = found if out is None else out.unionByName(found)
    return out
