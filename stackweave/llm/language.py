"""Language ID with interpolated Kneser-Ney character language models.

A text is lower-cased, everything that is not a letter becomes one space, and each language's
model of character n-grams gives the text a cross-entropy per character. The language with the
lowest one wins. Models of all languages share sorted arrays of n-gram hashes, so one binary
search serves all languages.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and is rejected.
Null languages and held-out rows are never learned from. Repeated rows are scored alike. With
nothing to learn from, every text is ``und``. Other columns are carried through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm import common

UNKNOWN = "und"
ORDER = 4
FIT_ROWS = 400  # about so many labelled rows a language are read to count n-grams
CALIBRATION_ROWS = 3000  # and so many to place the threshold of rejection
REJECT = 0.001  # share of labelled rows that may lie beyond the threshold
TAIL = 2  # power by which the share of ordinary texts beyond a threshold falls, where a sample is too small to see it
_SLICE = 1 << 17  # characters scored at once
_JUDGED = (
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("entropy", T.DoubleType()), T.StructField("letters", T.LongType()),
    T.StructField("rejected", T.BooleanType()),
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


_letters: np.ndarray | None = None


def characters(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of all texts, the text each belongs to, and where a prediction is due.

    Each text begins with order - 1 spaces, which give context and are not predicted.
    """
    global _letters
    if _letters is None:
        _letters = _letter_table()
    pad = " " * (order - 1)
    folded = [pad + ("" if text is None else text.lower()) for text in texts]
    sizes = np.fromiter(map(len, folded), np.int64, len(folded))
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(folded)), sizes)
    letter = _letters[points]
    starts = np.cumsum(sizes) - sizes
    padding = np.zeros(len(points), bool)
    for k in range(order - 1):
        padding[starts + k] = True
    before = np.concatenate(([False], letter[:-1]))
    keep = letter | before | padding
    points = np.where(letter, points, np.uint32(32))[keep]
    return points, owner[keep], ~padding[keep]


def hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """hashes[n][i] identifies the n characters that end at i; n = 0 is constant."""
    found = [np.zeros(len(points), np.uint64)]
    wide = points.astype(np.uint64) + np.uint64(1)
    for n in range(1, order + 1):
        longer = found[-1].copy()
        shifted = wide if n == 1 else np.concatenate((np.zeros(n - 1, np.uint64), wide[: 1 - n]))
        longer = (longer + shifted * np.uint64(2 * n + 1)) * _FACTOR
        longer ^= longer >> np.uint64(29)
        found.append(longer)
    return found


@dataclass
class Model:
    """names; for each n: sorted n-gram hashes with log probabilities (one column a language),
    and sorted context hashes with log weights of the shorter model."""

    names: list[str]
    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    centre: np.ndarray | None = None
    limit: float = np.inf

    def log_probabilities(self, found: list[np.ndarray], at: np.ndarray, n: int) -> np.ndarray:
        """Log probability of the character at each place, given the n - 1 before it."""
        if n == 0:
            return np.broadcast_to(self.floor, (len(at), len(self.names)))
        keys, values = self.grams[n]
        spot = np.minimum(np.searchsorted(keys, found[n][at]), len(keys) - 1)
        hit = keys[spot] == found[n][at]
        out = values[spot]
        if not hit.all():
            missed = at[~hit]
            keys, weights = self.contexts[n]
            before = found[n - 1][missed - 1]
            spot = np.minimum(np.searchsorted(keys, before), len(keys) - 1)
            known = keys[spot] == before
            out[~hit] = self.log_probabilities(found, missed, n - 1) + np.where(known[:, None], weights[spot], 0)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats a character by text and language, and the letters of each text."""
        parts = [self._entropies(group) for group in common.bounded_groups(texts, _SLICE)]
        if not parts:
            return np.zeros((0, len(self.names))), np.zeros(0)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        points, owner, due = characters(texts, self.order)
        sums = np.zeros((len(texts), len(self.names)))
        for begin in range(0, len(points), _SLICE):
            low = max(0, begin - self.order)
            found = hashes(points[low : begin + _SLICE], self.order)
            at = np.flatnonzero(due[low : begin + _SLICE])
            at = at[at >= begin - low]
            logs = self.log_probabilities(found, at, self.order)
            for k in range(len(self.names)):
                sums[:, k] += np.bincount(owner[low + at], logs[:, k], len(texts))
        count = np.bincount(owner[due], minlength=len(texts))
        letters = np.bincount(owner[due], points[due] != 32, len(texts))
        return -sums / np.maximum(count, 1)[:, None], letters


def _kneser_ney(texts: list[str], order: int) -> tuple[list, list, int]:
    """Of one language: for each n, (hash, context, suffix, log p) and (context, log weight)."""
    points, _, due = characters(texts, order)
    found = hashes(points, order)
    alphabet = len(np.unique(points)) + 1
    due = np.flatnonzero(due)
    grams, counts, first = [None] * (order + 1), None, due
    level: list[tuple] = [()] * (order + 1)
    for n in range(order, 0, -1):
        # Longest n-grams count occurrences, shorter ones the different characters before them.
        keys, at, counts = np.unique(found[n][first], return_index=True, return_counts=True)
        first = first[at]
        level[n] = (keys, first, counts)
    lower_keys, lower = np.zeros(1, np.uint64), np.array([1.0 / alphabet])
    contexts = [None] * (order + 1)
    for n in range(1, order + 1):
        keys, first, counts = level[n]
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        context, back = np.unique(found[n - 1][first - 1], return_inverse=True)
        total = np.bincount(back, counts)
        weight = discount * np.bincount(back) / total
        suffix = found[n - 1][first]
        shorter = lower[np.searchsorted(lower_keys, suffix)]
        p = (counts - discount) / total[back] + weight[back] * shorter
        grams[n] = (keys, context[back], suffix, np.log(p))
        contexts[n] = (context, np.log(weight))
        lower_keys, lower = keys, p
    return grams, contexts, alphabet


def fit(texts: dict[str, list[str]], order: int = ORDER) -> Model:
    """Train one model a language and lay them out in shared sorted arrays."""
    names = sorted(texts)
    own = [_kneser_ney(texts[name], order) for name in names]
    floor = np.array([-np.log(alphabet) for _, _, alphabet in own], np.float32)
    model = Model(names, order, [()] * (order + 1), [()] * (order + 1), floor)
    for n in range(1, order + 1):
        keys = np.unique(np.concatenate([contexts[n][0] for _, contexts, _ in own]))
        weights = np.zeros((len(keys), len(names)), np.float32)
        for k, (_, contexts, _) in enumerate(own):
            weights[np.searchsorted(keys, contexts[n][0]), k] = contexts[n][1]
        model.contexts[n] = (keys, weights)
        parts = [np.concatenate([grams[n][i] for grams, _, _ in own]) for i in range(3)]
        keys, at = np.unique(parts[0], return_index=True)
        context, suffix = parts[1][at], parts[2][at]
        # What a language has not seen, it takes from its shorter model.
        values = weights[np.searchsorted(model.contexts[n][0], context)]
        if n == 1:
            values = values + floor
        else:
            shorter_keys, shorter = model.grams[n - 1]
            values = values + shorter[np.searchsorted(shorter_keys, suffix)]
        for k, (grams, _, _) in enumerate(own):
            values[np.searchsorted(keys, grams[n][0]), k] = grams[n][3]
        model.grams[n] = (keys, values.astype(np.float32))
    return model


def _residual(model: Model, entropy: np.ndarray, letters: np.ndarray, best: np.ndarray) -> np.ndarray:
    """How much worse than usual for its language a text is; short texts vary more."""
    return (entropy - model.centre[best]) * np.sqrt(np.minimum(letters, 256))


def _sample(docs: DataFrame, rows: int, salt: int) -> DataFrame:
    """About ``rows`` labelled rows of every language, chosen by a hash of the id."""
    labelled = docs.where(common.in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One count a language comes to the driver, so that no text has to be shuffled to meet it.
    sizes = labelled.groupBy("lang").count().collect()
    if not sizes:
        return labelled.select("doc_id", "lang", "text").limit(0)
    share = F.create_map(*(F.lit(x) for row in sizes for x in (row["lang"], rows / row["count"])))
    dice = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(dice < share[F.col("lang")]).select("doc_id", "lang", "text")


def train(docs: DataFrame, order: int = ORDER, fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> Model | None:
    """Count n-grams on one bounded sample and calibrate rejection on another."""
    # The fit runs in numpy on the driver; the sample's bound is what it may cost.
    # Rows that were counted fit too well to calibrate on: a quarter is kept for that alone.
    kept = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) == 0
    sample = _sample(docs.where(~kept), fit_rows, 1).orderBy("doc_id").collect()
    texts: dict[str, list[str]] = {}
    for row in sample:
        if any(map(str.isalpha, row.text)):
            texts.setdefault(row.lang, []).append(row.text)
    if not texts:
        return None
    model = fit(texts, order)
    fitted = docs.where(kept & F.col("lang").isin(model.names))
    held = identify(_sample(fitted, calibration_rows, 2), model).where(f"lang_pred != '{UNKNOWN}'")
    rows = held.select("lang_pred", "entropy", "letters").collect()
    best = np.array([model.names.index(row.lang_pred) for row in rows], int)
    entropy = np.array([row.entropy for row in rows])
    letters = np.array([row.letters for row in rows])
    model.centre = np.zeros(len(model.names))
    for k in set(best):
        model.centre[k] = np.median(entropy[best == k])
    if rows:
        # A sample too small for the quantile gives its largest residual, carried on to the quantile.
        rank = min(int(np.ceil((len(rows) + 1) * (1 - REJECT))), len(rows))
        short = max(1.0, 1 / (REJECT * (len(rows) + 1))) ** (1 / TAIL)
        model.limit = short * max(0.0, np.sort(_residual(model, entropy, letters, best))[rank - 1])
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with lang_pred, score, entropy, letters and rejected; whole texts, no shuffle."""
    rows = docs.drop(*(field.name for field in _JUDGED))
    if model is None:
        return rows.withColumns({
            "lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "entropy": F.lit(None).cast("double"),
            "letters": F.lit(0).cast("long"), "rejected": F.lit(True),
        })
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: pa.RecordBatch) -> list:
        own = shared.value
        texts = batch.column("text").to_pylist()
        entropies, letters = own.entropies(texts)
        best = entropies.argmin(axis=1)
        entropy = entropies[np.arange(len(texts)), best]
        evidence = np.exp((entropy[:, None] - entropies) * np.minimum(letters, 32)[:, None])
        named = letters > 0
        rejected = ~named
        if own.centre is not None:
            rejected = rejected | (_residual(own, entropy, letters, best) > own.limit)
        names = np.where(named, np.array(own.names, object)[best], UNKNOWN)
        return [names, np.where(named, 1 / evidence.sum(axis=1), 0.0), entropy, letters.astype(np.int64), rejected]

    return common.with_arrow_columns(rows, _JUDGED, judge)


def keep_identified(docs: DataFrame) -> DataFrame:
    """Filtering stage: documents the calibrated models do not reject, columns unchanged."""
    judged = identify(common.sealed(docs, "text"), train(docs))
    return common.unsealed(judged.where(~F.col("rejected")), docs.columns, "text")
