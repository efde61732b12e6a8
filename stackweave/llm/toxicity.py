"""Toxicity from subword-bag embeddings averaged into a linear softmax.

A window of words is the average of the embeddings of its character n-grams (three to five
characters, word edges included, hashed to a fixed table), and a linear softmax turns that
average into two classes. Embeddings and softmax are trained together in numpy. Words nobody has
seen, misspelt ones above all, share n-grams with known ones.

A label says that a document is toxic, not where. So windows of toxic documents first all count
as toxic; then, round by round, only those that the model itself finds toxic do. A document's
score comes from its most toxic window, through a logistic curve fitted on labelled documents
that took no part in training.

The labelled sample is bounded by ``ROWS`` documents a class. Whole texts are scored, in slices.

Defined cases: a null text, or one without a word, scores 0. Documents without a label, or with
contradicting ones, are not learned from. Without both classes every score is 0. Repeated rows
score alike, and other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm import common

ROWS = 1500  # labelled documents of each class in the sample
SIZES = (3, 4, 5)
TABLE = 1 << 17
WIDTH = 8
WINDOW, STRIDE = 12, 6
ROUNDS, PASSES = 5, 3
THRESHOLD = 0.7
# Share of the windows of clean documents that enter a round of training, beside all that look toxic.
CLEAN_WINDOWS = 0.25
_SLICE = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SCORED = (T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()))


_word_characters: np.ndarray | None = None


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram, word) pairs, words numbered through all texts, and each word's text.

    A word is a run of letters and digits in lower case; a space stands for its edges.
    """
    global _word_characters
    if _word_characters is None:
        _word_characters = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
    folded = [" " + ("" if text is None else text.lower()) + " " for text in texts]
    sizes = np.fromiter(map(len, folded), np.int64, len(folded))
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _word_characters[points]
    keep = inside | np.concatenate(([True], inside[:-1]))  # one space after each word
    first = np.cumsum(sizes) - sizes
    keep[first] = True
    owner = np.repeat(np.arange(len(folded)), sizes)[keep]
    points = np.where(inside, points, 0)[keep].astype(np.uint64) + np.uint64(1)
    space = points == 1
    # A word starts after a space; an n-gram that begins with a space belongs to the word behind it.
    starts = np.concatenate((space[:-1] & ~space[1:], [False]))
    word = np.cumsum(starts) - 1
    text_of = owner[1:][starts[:-1]] if len(owner) else owner
    found, words = [], []
    edges = np.concatenate(([0], np.cumsum(space)))
    for size in SIZES:
        count = len(points) - size + 1
        if count <= 0:
            continue
        mixed = np.full(count, np.uint64(size))
        for k in range(size):
            mixed = (mixed + points[k : k + count]) * _FACTOR
            mixed ^= mixed >> np.uint64(31)
        # No space between the ends.
        whole = edges[size - 1 : size - 1 + count] == edges[1 : 1 + count]
        found.append((mixed[whole] % np.uint64(TABLE)).astype(np.int32))
        words.append(word[:count][whole])
    if not len(text_of):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), text_of
    gram, word = np.concatenate(found), np.concatenate(words)
    # A word said again at once adds nothing: a window of one word would look extreme.
    marks = [np.bincount(word, weights, len(text_of)) for weights in (None, gram, gram.astype(float) ** 2)]
    fresh = np.ones(len(text_of), bool)
    fresh[1:] = (text_of[1:] != text_of[:-1]) | np.any([mark[1:] != mark[:-1] for mark in marks], axis=0)
    number = np.cumsum(fresh) - 1
    kept = fresh[word]
    return gram[kept], number[word[kept]], text_of[fresh]


@dataclass
class Model:
    """Embeddings times softmax weights: what an n-gram adds to a window's log odds."""

    evidence: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def peaks(self, texts: list[str | None]) -> np.ndarray:
        """Log odds of the most toxic window of each text; NaN without a word."""
        parts = [self._peaks(group) for group in common.bounded_groups(texts, _SLICE)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _peaks(self, texts: list[str | None]) -> np.ndarray:
        gram, word, text_of = grams(texts)
        out = np.full(len(texts), np.nan)
        if not len(text_of):
            return out
        sums = np.concatenate(([0.0], np.cumsum(np.bincount(word, self.evidence[gram], len(text_of)))))
        counts = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(text_of)))))
        begin, end = window_bounds(text_of)
        odds = (sums[end] - sums[begin]) / np.maximum(counts[end] - counts[begin], 1) + self.bias
        heads = np.flatnonzero(np.concatenate(([True], np.diff(text_of[begin]) > 0)))
        out[text_of[begin[heads]]] = np.maximum.reduceat(odds, heads)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        odds = self.slope * self.peaks(texts) + self.shift
        return np.where(np.isnan(odds), 0.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))


def window_bounds(text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of the windows of all texts: every STRIDE words, the last one ends with the text."""
    heads = np.flatnonzero(np.concatenate(([True], np.diff(text_of) > 0)))
    tails = np.append(heads[1:], len(text_of))
    first = np.repeat(heads, tails - heads)
    place = np.arange(len(text_of)) - first
    last = np.repeat(tails, tails - heads)
    begin = np.flatnonzero((place % STRIDE == 0) & ((place == 0) | (np.arange(len(text_of)) + WINDOW - STRIDE < last)))
    return begin, np.minimum(begin + WINDOW, last[begin])


def _windows(texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
    """N-grams of the all windows of each text, and their text."""
    bags, owner = [], []
    for number, text in enumerate(texts):
        gram, word, text_of = grams([text])
        if not len(text_of):
            continue
        order = np.argsort(word, kind="stable")
        gram, ends = gram[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(text_of)))))
        begin, end = window_bounds(text_of)
        for k in range(len(begin)):
            bag = gram[ends[begin[k]] : ends[end[k]]]
            if len(bag):
                bags.append(bag)
                owner.append(number)
    return bags, owner


def fit(texts: list[str], toxic: list[bool], seed: int = 7) -> Model:
    """Train embeddings and softmax together by stochastic gradient descent with AdaGrad steps."""
    dice = np.random.default_rng(seed)
    bags, owner = _windows(texts)
    owner, label = np.array(owner), np.array(toxic)[owner].astype(int)
    table = dice.normal(0, 0.1, (TABLE, WIDTH)).astype(np.float32)
    weight = dice.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    table_steps, weight_steps = np.full(TABLE, 1e-6, np.float32), np.full((WIDTH, 2), 1e-6, np.float32)
    sizes = np.fromiter(map(len, bags), np.int64, len(bags))
    # All windows of toxic documents; of clean ones a share, and later those that look toxic.
    drawn = (label == 1) | (dice.random(len(bags)) < CLEAN_WINDOWS)
    active = np.flatnonzero(drawn)
    for round_ in range(ROUNDS):
        # Both classes weigh the same, however many windows each has.
        share = (len(active) / np.maximum(np.bincount(label[active], minlength=2), 1) / 2).astype(np.float32)
        for _ in range(PASSES):
            dice.shuffle(active)
            for low in range(0, len(active), 256):
                some = active[low : low + 256]
                ids = np.concatenate([bags[k] for k in some])
                bag = np.repeat(np.arange(len(some)), sizes[some])
                starts = np.cumsum(sizes[some]) - sizes[some]
                mean = np.add.reduceat(table[ids], starts) / sizes[some][:, None]
                odds = mean @ weight + bias
                odds -= odds.max(1, keepdims=True)
                wrong = np.exp(odds) / np.exp(odds).sum(1, keepdims=True)
                wrong[np.arange(len(some)), label[some]] -= 1
                wrong *= share[label[some]][:, None]
                step = mean.T @ wrong / len(some)
                weight_steps += step * step
                back = (wrong @ weight.T / sizes[some][:, None])[bag]
                weight -= 0.1 * step / np.sqrt(weight_steps)
                bias -= 0.1 * wrong.mean(0)
                places, inverse = np.unique(ids, return_inverse=True)
                total = np.stack([np.bincount(inverse, back[:, d]) for d in range(WIDTH)], 1)
                table_steps[places] += (total * total).mean(1)
                table[places] -= (0.1 * total / np.sqrt(table_steps[places])[:, None]).astype(np.float32)
        evidence = table @ (weight[:, 1] - weight[:, 0])
        model = Model(evidence.astype(np.float64), float(bias[1] - bias[0]))
        # Of a toxic document only windows count that look toxic, its worst one always.
        odds = np.array([evidence[bag].mean() for bag in bags]) + model.bias
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, owner, odds)
        drawn = dice.random(len(bags)) < CLEAN_WINDOWS
        active = np.flatnonzero(np.where(label == 1, (odds > 0) | (odds == worst[owner]), drawn | (odds > -2)))
    return model


def calibrate(model: Model, texts: list[str], toxic: list[bool]) -> None:
    """Fit the curve from the most toxic window to a probability, by Newton's method."""
    peaks = model.peaks(texts)
    known = ~np.isnan(peaks)
    x, y = peaks[known], np.array(toxic, float)[known]
    if len(set(y)) < 2:
        return
    middle, spread = x.mean(), x.std() or 1.0
    design = np.stack([(x - middle) / spread, np.ones(len(x))], 1)
    beta = np.zeros(2)
    # Smoothed labels keep the curve finite when the classes are separable.
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ beta))
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, design.T @ (p - goal) + 1e-4 * beta)
        beta -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    if beta[0] > 0:
        model.slope, model.shift = float(beta[0] / spread), float(beta[1] - beta[0] * middle / spread)


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model | None:
    """Learn from a bounded sample of labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & common.in_training(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("toxic").alias("low"), F.max("toxic").alias("toxic")
    ).where("low = toxic")
    order = F.xxhash64(F.lit(4), "doc_id")
    # At most 2 x rows ids: small enough to be sent to every task.
    chosen = common.first_by(known.where("toxic = 0"), order, rows).unionByName(common.first_by(known.where("toxic > 0"), order, rows))
    sample = docs.where("text is not null").join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")
    # The numpy model is fitted on the driver; the sample's bound is what it may cost.
    # Of rows that share an id the least text counts, whatever order they come in.
    found = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()
    toxic = [row.toxic > 0 for row in found]
    if len(set(toxic)) < 2:
        return None
    texts = [row.text for row in found]
    fitting = [k for k in range(len(found)) if k % 4]
    held = [k for k in range(len(found)) if not k % 4]
    model = fit([texts[k] for k in fitting], [toxic[k] for k in fitting])
    calibrate(model, [texts[k] for k in held], [toxic[k] for k in held])
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with score and predicted; whole texts, no shuffle."""
    rows = docs.drop(*(field.name for field in _SCORED))
    if model is None:
        return rows.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: pa.RecordBatch) -> list:
        scores = shared.value.scores(batch.column("text").to_pylist())
        return [scores, (scores >= THRESHOLD).astype(np.int32)]

    return common.with_arrow_columns(rows, _SCORED, judge)
