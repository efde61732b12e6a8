"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Four shares (symbols, capitals, repeated lines, repeated words) each get a cutoff per stratum. A
cutoff may be used if the labelled good documents prove that it rejects few of them: the exact
binomial tail of the rejections seen, at the allowed false-rejection rate, must not exceed the
error level divided by the number of all cutoffs tried (rules x grid x strata). Of the proven
cutoffs the one that best separates bad from good is used; a rule without one rejects nothing.
The allowed rate of a stratum is divided among the rules, so with probability 1 - ``ERROR`` no
stratum loses more than ``FALSE_REJECTION`` of its good documents.

Every labelled document counts; the histograms behind the tests have a fixed size per stratum.

Defined cases: a null text has no words and fails the base rule. A null stratum is one of its
own. A document labelled more than once counts once, as bad if any label says so. Without labels
only the base rule rejects. Repeated rows are judged alike, and other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackweave.llm import common

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATS = 30  # percent of words
FALSE_REJECTION = 0.05
ERROR = 0.05
# Cutoffs tried, per mille; they don't depend on the data.
GRID = (5, 10, 15, 20, 30, 40, 50, 75, 100, 150, 200, 300, 400, 500, 700)
RULES = ("symbols", "capitals", "lines", "repeats")


def _named(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body, with a name for a value that it uses more than once.

    A column of its own would not do: a filter above is pushed below it, and copies what it
    stands for into every use, down to the lambdas that run once a word.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeats(words: Column) -> Column:
    """How many words lie in windows that come twice or more."""
    last = F.size(words) - WINDOW
    at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))

    def starts(ordered: Column) -> Column:
        same = lambda x, k: x["h"] == F.get(ordered, k)["h"]
        again = F.filter(ordered, lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def covered(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.aggregate(
            _named(F.array_sort(pairs), starts),
            F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last")),
            lambda done, i: F.struct((done["words"] + F.least(F.lit(WINDOW), i - done["last"])).alias("words"), i.alias("last")),
            lambda done: done["words"],
        )

    # Only texts in which some window comes twice are sorted.
    return _named(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))


def features(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    names = ("n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = docs.drop(*names)
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))

    def of_words(words: Column, lines: Column) -> Column:
        length, size = F.size(words), F.size(lines)
        counts = lambda again: {
            "n_words": length, "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", "")),
            "n_capitals": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", "")),
            "n_lines": size, "n_dup_lines": size - F.size(F.array_distinct(lines)), "n_repeat_words": again,
        }
        failed = lambda again: (length < MIN_WORDS) | (100 * again.cast("long") > MAX_REPEATS * length)
        return _named(_repeats(words), lambda again: F.struct(
            *(value.cast("long").alias(name) for name, value in counts(again).items()), failed(again).alias("base_failed")
        ))

    # One expression makes all counts, so that they are made at once.
    counted = _named(common.words(F.col("text")), lambda words: _named(lines, lambda found: of_words(words, found)))
    return rows.select(*(F.col(f"`{name}`") for name in rows.columns), counted.alias(common.ROW)).select(
        *(F.col(f"`{name}`") for name in rows.columns), *(F.col(f"{common.ROW}.{name}") for name in names)
    )


def shares() -> dict[str, Column]:
    """What each rule looks at, per mille."""
    per = lambda part, whole: F.lit(1000.0) * F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return {
        "symbols": per("n_symbols", "word_chars"), "capitals": per("n_capitals", "word_chars"),
        "lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
    }


def _log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 9, where four terms are exact to 12 digits."""
    z = x.cast("double") + 9
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    high = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    return high - reduce(lambda a, b: a + b, (F.log(x.cast("double") + k) for k in range(1, 9)))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for n draws at a rate; 1 where k is at or above the mean."""
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(rate) + (n - k) * math.log1p(-rate)
    # Terms shrink from k down; those left out are below the last digit of the sum.
    steps = F.least(k, F.ceil(8 * F.sqrt(n * rate)) + 50).cast("long")
    sums = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1)))).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda done, j: _next_term(done, (k - j + 1) * (1 - rate) / ((n - k + j) * rate)),
        lambda done: done["sum"],
    )
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.exp(top) * sums)


def _next_term(done: Column, ratio: Column) -> Column:
    term = done["term"] * ratio
    return F.struct(term.alias("term"), (done["sum"] + term).alias("sum"))


def cutoffs(labelled: DataFrame, rate: float = FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """stratum, good boolean and one column for each rule -> stratum and a proven cutoff for each rule."""
    grid = F.array(*map(F.lit, GRID))
    passed = lambda rule: F.size(F.filter(grid, lambda c: F.col(rule) > c))
    bins = [F.struct(F.lit(rule).alias("rule"), passed(rule).alias("bin")) for rule in RULES]
    histogram = (
        labelled.select("stratum", "good", F.inline(F.array(*bins)))
        .groupBy("stratum", "rule", "bin")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # A document in bin b is above the first b cutoffs.
    tried = histogram.select("stratum", "rule", "bin", "good", "bad", F.explode(F.sequence(F.lit(1), F.lit(len(GRID)))).alias("cut"))
    above = tried.groupBy("stratum", "rule", "cut").agg(
        F.sum(F.when(F.col("bin") >= F.col("cut"), F.col("good")).otherwise(0)).alias("k"), F.sum("good").alias("n"),
        F.sum(F.when(F.col("bin") >= F.col("cut"), F.col("bad")).otherwise(0)).alias("caught"), F.sum("bad").alias("bad"),
    )
    number = labelled.agg((F.count_distinct("stratum") * len(RULES) * len(GRID)).alias("n")).scalar()
    proven = above.where((F.col("n") > 0) & (binomial_tail(F.col("k"), F.col("n"), rate / len(RULES)) <= F.lit(error) / number))
    gain = F.col("caught") / F.greatest("bad", F.lit(1)) - F.col("k") / F.col("n")
    # Of equal gains the highest cutoff, which rejects the fewest.
    best = proven.where(gain > 0).groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), F.col("cut"))).alias("best"))
    chosen = F.element_at(grid, F.col("best.cut"))
    return best.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == rule, chosen)).alias(f"{rule}_cutoff") for rule in RULES))


def judge(counted: DataFrame, labels: DataFrame, stratum: str = "lang", rate: float = FALSE_REJECTION) -> DataFrame:
    """Counted features and labels (doc_id, quality) -> the same rows with kept."""
    # Everything else a row has is put away, so that no name of a rule can clash with it.
    numbers = {name: value.alias(f"{name}_share") for name, value in shares().items()}
    rows = counted.select(
        "doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "base_failed", *numbers.values(),
        F.struct(*(F.col(f"`{name}`") for name in counted.columns if name != "kept")).alias(common.ROW),
    )
    good = labels.where("quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    own = [F.col(f"{rule}_share").alias(rule) for rule in RULES]
    # Of rows that share an id the least by its numbers counts, whatever order they come in.
    known = rows.where(~F.col("base_failed")).select("doc_id", F.struct("stratum", *own).alias("_own"))
    one = known.groupBy("doc_id").agg(F.min("_own").alias("_own")).join(good, "doc_id")
    limits = cutoffs(one.select("_own.*", "good"), rate)
    judged = rows.join(limits, "stratum", "left")
    over = [F.coalesce(F.col(f"{rule}_share") > F.col(f"{rule}_cutoff"), F.lit(False)) for rule in RULES]
    kept = ~(F.col("base_failed") | reduce(lambda a, b: a | b, over))
    return judged.select(f"{common.ROW}.*", kept.alias("kept"))
