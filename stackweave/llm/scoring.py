"""Language-model scoring by masked pseudo-likelihood.

A small network sees the word before and the word after a place and predicts the class of the
word that is hidden there; a table of all words of the corpus says how likely the word is within
its class. A document's score is the sum of the log-probabilities of all its words, each the
product of both.

The most frequent words of the whole corpus are classes of their own; every other word belongs to
one of a fixed number of classes by its ending. With so few classes the counts of (left, hidden,
right) over all documents say everything about the corpus that the network needs: they are
gathered by Spark, so training covers every word of every document at any size, and their number
is bounded by the cube of the number of classes. The network is then trained in numpy on them.

The words within the classes follow the corpus: each has its own count of all its occurrences.
Of n words of a class, one said c times has the share c / (n + 1). A word said once has what one
never seen would have, 1 / (n + 1), so only words said ``LEAST`` times are sent to the tasks, as
hashes, and nothing is lost by that.

Defined cases: a null text, or one without a word, has 0 words, log-likelihood 0 and no mean.
Repeated rows count as often as they come and score alike; other columns pass through. An empty
corpus leaves the untrained, uniform network.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm import common

FREQUENT, ENDINGS = 96, 31
EDGE = FREQUENT + ENDINGS  # stands before the first and after the last word
VOCABULARY = EDGE + 1
LEAST = 2  # occurrences of words that are sent to the tasks; all others have the same share
HIDDEN = 24
STEPS = 300
_WORDS = re.compile(r"[^\W_]+")
_SLICE = 1 << 18
_SCORED = (T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()), T.StructField("mean_log_likelihood", T.DoubleType()))


def spelled(text: str | None) -> list[str]:
    """All words of a text."""
    return _WORDS.findall((text or "").lower())


def tokens(text: str | None, known: dict[str, int]) -> list[int]:
    """Numbers of all words of a text; a word outside the frequent ones is its ending's class."""
    return classes(spelled(text), known)


def classes(words: list[str], known: dict[str, int]) -> list[int]:
    get = known.get
    return [t if (t := get(w)) is not None else FREQUENT + zlib.crc32(w[-2:].encode("utf-8", "surrogatepass")) % ENDINGS for w in words]


def places(texts: list[list[str]], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(left, hidden, right) as one number for every word of all texts, and how many each text has."""
    stream, sizes = [EDGE], []
    for words in texts:
        own = classes(words, known)
        stream += own
        stream.append(EDGE)
        sizes.append(len(own))
    ids = np.array(stream, np.int64)
    at = np.flatnonzero(ids != EDGE)
    return (ids[at - 1] * VOCABULARY + ids[at]) * VOCABULARY + ids[at + 1], np.array(sizes, np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) of all words of all documents."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+")
    return docs.select(F.explode(words).alias("word")).where("word != ''").groupBy("word").count()


def vocabulary(docs: DataFrame) -> dict[str, int]:
    """The most frequent words of all documents, numbered by count and then by name."""
    return most_frequent(word_counts(docs))


def most_frequent(counts: DataFrame) -> dict[str, int]:
    top = counts.orderBy(F.desc("count"), "word").limit(FREQUENT).collect()
    return {row.word: number for number, row in enumerate(top)}


@dataclass
class Members:
    """How likely each word is within its class."""

    hashes: np.ndarray  # of words said LEAST times or more, sorted
    counts: np.ndarray
    sizes: np.ndarray  # all occurrences of each class

    def log_shares(self, words: list[str], ids: np.ndarray) -> np.ndarray:
        """Log-probabilities of words, given their classes; a frequent word is all of its own."""
        out = np.zeros(len(words))
        others = np.flatnonzero(ids >= FREQUENT)
        if not len(others):
            return out
        number: dict[str, int] = {}
        back = [number.setdefault(words[k], len(number)) for k in others.tolist()]
        many = np.ones(len(number))
        if len(self.hashes):
            # As Spark hashes text.
            hashed = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 42) for w in number), np.uint64, len(number)).view(np.int64)
            spot = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
            many = np.where(self.hashes[spot] == hashed, self.counts[spot], 1)
        out[others] = np.log(many[back] / (self.sizes[ids[others] - FREQUENT] + 1))
        return out


def members(counts: DataFrame, known: dict[str, int]) -> Members:
    """The table of all words outside the frequent ones; it grows with the words of the corpus."""
    ending = F.crc32(F.right("word", F.lit(2)).cast("binary")) % ENDINGS
    others = counts.where(~F.col("word").isin(list(known))) if known else counts
    sizes = np.zeros(ENDINGS)
    for row in others.groupBy(ending.alias("ending")).agg(F.sum("count").alias("n")).collect():
        sizes[row.ending] = row.n
    found = others.where(F.col("count") >= LEAST).select(F.xxhash64("word").alias("hash"), "count").toArrow()
    hashes, many = found.column("hash").to_numpy(), found.column("count").to_numpy()
    order = np.argsort(hashes)
    return Members(hashes[order], many[order].astype(np.float32), sizes)


def context_counts(docs: DataFrame, known: dict[str, int]) -> DataFrame:
    """(place, n): how often each (left, hidden, right) occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One bounded table a task is the partial aggregate before the shuffle.
        total = np.zeros(VOCABULARY**3, np.int64)
        for batch in batches:
            for group in common.bounded_groups(batch.column(0).to_pylist(), _SLICE):
                found, many = np.unique(places(list(map(spelled, group)), known)[0], return_counts=True)
                total[found] += many
        found = np.flatnonzero(total)
        for low in range(0, len(found), 1 << 16):
            some = found[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "n"])

    return docs.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))


@dataclass
class Network:
    left: np.ndarray
    right: np.ndarray
    hidden: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.left, self.right, self.hidden, self.out, self.bias]

    def log_probabilities(self) -> np.ndarray:
        """For every (left, right): log-probability of every hidden word, as a flat table by place."""
        table = np.empty((VOCABULARY,) * 3, np.float32)
        for one in range(VOCABULARY):
            state = np.tanh(self.left[one] + self.right + self.hidden)
            odds = state @ self.out + self.bias
            odds -= odds.max(1, keepdims=True)
            table[one] = (odds - np.log(np.exp(odds).sum(1, keepdims=True))).T
        return table.reshape(-1)


def fit(place: np.ndarray, n: np.ndarray, steps: int = STEPS, seed: int = 5) -> Network:
    """Train on counts by full-batch Adam steps, so the result does not depend on any order."""
    dice = np.random.default_rng(seed)
    draw = lambda *shape: dice.normal(0, 0.1, shape).astype(np.float32)
    net = Network(draw(VOCABULARY, HIDDEN), draw(VOCABULARY, HIDDEN), np.zeros(HIDDEN, np.float32), draw(HIDDEN, VOCABULARY), np.zeros(VOCABULARY, np.float32))
    if not len(place):
        net.out[:] = 0
        return net
    one, rest = np.divmod(place, VOCABULARY**2)
    word, two = np.divmod(rest, VOCABULARY)
    pair, row = np.unique(one * VOCABULARY + two, return_inverse=True)
    goal = np.zeros((len(pair), VOCABULARY), np.float32)
    goal[row, word] = n / n.sum()
    weight = goal.sum(1, keepdims=True)
    left, right = np.divmod(pair, VOCABULARY)
    to_left, to_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    mean, spread = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    for step in range(1, steps + 1):
        state = np.tanh(net.left[left] + net.right[right] + net.hidden)
        odds = state @ net.out + net.bias
        odds -= odds.max(1, keepdims=True)
        np.exp(odds, out=odds)
        odds *= weight / odds.sum(1, keepdims=True)
        odds -= goal
        back = (odds @ net.out.T) * (1 - state * state)
        slopes = [_by_word(back, left, to_left), _by_word(back, right, to_right), back.sum(0), state.T @ odds, odds.sum(0)]
        rate = 0.03 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, slope, m, v in zip(net.parameters(), slopes, mean, spread, strict=True):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _by_word(rows: np.ndarray, word: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Sums of rows by word."""
    out = np.zeros((VOCABULARY, rows.shape[1]), np.float32)
    ranked = word[order]
    heads = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    out[ranked[heads]] = np.add.reduceat(rows[order], heads)
    return out


def train(docs: DataFrame) -> tuple[dict[str, int], Network]:
    known = vocabulary(docs)
    return known, network(docs, known)


def learn(docs: DataFrame) -> tuple[dict[str, int], Network, Members]:
    """All that a whole score needs; words are counted once."""
    counts = common.WorkTable(word_counts(docs), "words")
    known = most_frequent(counts.df)
    within = members(counts.df, known)
    counts.drop()
    return known, network(docs, known), within


def network(docs: DataFrame, known: dict[str, int]) -> Network:
    # At most VOCABULARY ** 3 rows, whatever the number of documents.
    counts = context_counts(docs, known).toArrow()
    place, n = counts.column("place").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(place)
    return fit(place[order], n[order])


def score(docs: DataFrame, known: dict[str, int], net: Network, within: Members | None = None) -> DataFrame:
    """docs with n_tokens, log_likelihood and mean_log_likelihood; whole texts, no shuffle.

    Without ``within`` it is the likelihood of the classes alone.
    """
    rows = docs.drop(*(field.name for field in _SCORED))
    shared = docs.sparkSession.sparkContext.broadcast((known, net, within))
    tables: list[np.ndarray] = []

    def judge(batch: pa.RecordBatch) -> list:
        frequent, network, own = shared.value
        if not tables:
            tables.append(network.log_probabilities())
        sizes, sums = [], []
        for group in common.bounded_groups(batch.column("text").to_pylist(), _SLICE):
            words = list(map(spelled, group))
            place, many = places(words, frequent)
            owner = np.repeat(np.arange(len(group)), many)
            found = tables[0][place].astype(np.float64)
            if own is not None:
                found += own.log_shares([w for text in words for w in text], place // VOCABULARY % VOCABULARY)
            sums.append(np.bincount(owner, found, len(group)))
            sizes.append(many)
        if not sizes:
            return [[], [], []]
        many, total = np.concatenate(sizes), np.concatenate(sums)
        return [many, total, pa.array(total / np.maximum(many, 1), mask=many == 0)]

    return common.with_arrow_columns(rows, _SCORED, judge)
