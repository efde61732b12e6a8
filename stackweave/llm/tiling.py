"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share five-word seeds are joined, which leaves few pairs. For
each pair the longest common runs of words are marked again and again, without overlap, down to
runs of five words; running Karp-Rabin hashes find them. The share of an item's words that lies
in marked runs is its coverage, in whatever order the runs come, so a passage with its sentences
reordered is caught. A document is contaminated by the items it covers by ``COVERAGE`` or more.

Words are runs of letters and digits in lower case. Defined cases: a null or empty text has no
words, items of fewer than five words are never matched, and repeated items count as one. Rows are
judged by their own texts: those that share an id, or have none, do not decide for each other. The
report names ids: rows without one appear under a null id, and of rows that share an id the greatest
coverage is given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.llm import common

SEED = 5
FIRST_LENGTH = 20
COVERAGE = 0.5
_WORDS = re.compile(r"[^\W_]+")
_FACTOR = 0x9E3779B97F4A7C15


def _words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda word: word != "")


def _seeds(words: Column) -> Column:
    """Hashes of all runs of five words, in order."""
    last = F.size(words) - SEED
    at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SEED))))


def _hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Running Karp-Rabin hash of every run of ``length`` words."""
    factor = np.full(len(ids) + 1, _FACTOR, np.uint64)
    factor[0] = 1
    powers = np.multiply.accumulate(factor)
    factor[1:] = pow(_FACTOR, -1, 1 << 64)
    inverse = np.multiply.accumulate(factor)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((ids + np.uint64(1)) * powers[:-1])))
    return (sums[length:] - sums[:-length]) * inverse[: len(ids) - length + 1]


def _free_runs(marked: np.ndarray, length: int) -> np.ndarray:
    """Where runs without a marked word start."""
    counts = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(counts[length:] == counts[:-length])


def _matches(item: np.ndarray, text: np.ndarray, done: tuple, length: int) -> list[tuple[int, int, int]]:
    """(size, item place, text place) of maximal common unmarked runs of at least ``length``."""
    if min(len(item), len(text)) < length:
        return []
    in_item, in_text = (_free_runs(marked, length) for marked in done)
    of_item, of_text = _hashes(item, length), _hashes(text, length)[in_text]
    order = np.argsort(of_text, kind="stable")
    ranked, places = of_text[order], in_text[order]
    low = np.searchsorted(ranked, of_item[in_item], side="left").tolist()
    high = np.searchsorted(ranked, of_item[in_item], side="right").tolist()
    found = []
    for p, a, b in zip(in_item.tolist(), low, high, strict=True):
        at = places[a:b]
        if p and not done[0][p - 1]:
            # A run that could be longer on its left is found from there.
            before = np.maximum(at - 1, 0)
            at = at[(at == 0) | done[1][before] | (text[before] != item[p - 1])]
        size, active = 0, at
        while len(active) and p + size < len(item) and not done[0][p + size]:
            inside = active[active + size < len(text)]
            more = inside[(text[inside + size] == item[p + size]) & ~done[1][inside + size]]
            if size >= length:
                ended = np.setdiff1d(active, more, assume_unique=True)
                found += [(size, p, t) for t in ended.tolist()]
            size, active = size + 1, more
        if size >= length:
            found += [(size, p, t) for t in active.tolist()]
    return found


def tiles(item_words: list[str], text_words: list[str], least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item place, text place, words) of marked runs."""
    numbers: dict[str, int] = {}
    item, text = (np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64) for words in (item_words, text_words))
    done = (np.zeros(len(item), bool), np.zeros(len(text), bool))
    out, length = [], max(FIRST_LENGTH, least)
    while True:
        found = _matches(item, text, done, length)
        longest = max((size for size, _, _ in found), default=0)
        if longest > 2 * length:
            length = longest
            continue
        # Longest first; of a run that is partly taken, what is left is looked for again.
        again = False
        for size, p, t in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            taken = done[0][p : p + size] | done[1][t : t + size]
            if not taken.any():
                done[0][p : p + size] = True
                done[1][t : t + size] = True
                out.append((p, t, size))
            else:
                again = again or not taken.all()
        if again and _matches(item, text, done, length):
            continue
        if length <= least:
            return out
        length = max(least, length // 2)


def _row_key() -> Column:
    """Id and text together name a row, so that no group of copies becomes one key."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(":"), F.col("text"))))


def _covered(docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """(_key, item_id, coverage, n_tiles) of every row and item it gives away; repeated rows are one."""
    # Words are a column of their own: within a lambda they would be made anew for each place.
    items = benchmark.select("item_id", F.col("text").alias("_item"), _words(F.col("text")).alias("_words"))
    seeds = items.select("item_id", F.size("_words").alias("_size"), F.posexplode(_seeds(F.col("_words"))).alias("_place", "_seed"))
    keyed = docs.where("text is not null").select(_row_key().alias("_key"), F.col("text").alias("_text"))
    runs = keyed.select("_key", _words(F.col("_text")).alias("_words")).select("_key", F.explode(F.array_distinct(_seeds(F.col("_words")))).alias("_seed"))
    # Spark sends the seeds of the benchmark to all tasks if they are small, else it shuffles.
    shared = runs.join(seeds, "_seed").groupBy("_key", "item_id", "_size").agg(F.countDistinct("_place").alias("_places"))
    # A run of w words has w - 4 seeds, so coverage needs at least a fifth as many.
    pairs = shared.where(F.col("_places") * SEED >= F.col("_size") * coverage).select("_key", "item_id")
    # Repeated rows all meet their pairs; one of each goes on.
    both = pairs.join(keyed, "_key").dropDuplicates(["_key", "item_id"]).join(items.select("item_id", "_item"), "item_id")
    schema = both.select("_key", "item_id").schema.add("coverage", "double").add("n_tiles", "long")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares, counts = [], []
            for text, item in zip(batch.column("_text"), batch.column("_item"), strict=True):
                wanted = _WORDS.findall(item.as_py().lower())
                found = tiles(wanted, _WORDS.findall(text.as_py().lower()))
                shares.append(sum(size for _, _, size in found) / max(1, len(wanted)))
                counts.append(len(found))
            arrays = [batch.column(0), batch.column(1), pa.array(shares, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_key", "item_id", "coverage", "n_tiles"])

    return both.select("_key", "item_id", "_text", "_item").mapInArrow(tile, schema).where(F.col("coverage") >= coverage)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) of every document and item it gives away."""
    found = _covered(docs, benchmark, coverage)
    named = docs.select("doc_id", _row_key().alias("_key")).join(found, "_key")
    return named.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"), F.max("n_tiles").alias("n_tiles"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Filtering stage: rows whose text gives no item away, columns unchanged."""
    spoilt = _covered(docs, benchmark, coverage).select("_key").distinct()
    rows = common.sealed(docs, "doc_id", "text").withColumn("_key", _row_key())
    return common.unsealed(rows.join(spoilt, "_key", "left_anti"), docs.columns, "doc_id", "text")
