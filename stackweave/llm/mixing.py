"""Mixing of sources to target weights, as a time-varying curriculum.

Sources get their shares of a budget of words by weight; a source gives at most ``REPEATS``
times its own words, and what it cannot give goes to the others by weight. Each source lays its
documents in an order fixed by a hash of the id, once for every pass, along its line of words.
The source's weight over training time is integrated to a cumulative demand; inverting that
demand gives the training time at which a word is wanted, which is the position of the document
that starts there. Documents are then sorted by range of position.

The running sums are taken per source and hash bucket, with the starts of the buckets from a
small aggregate, so a source that holds most rows is spread over all tasks. All steps are
DataFrame functions.

Defined cases: null texts have size 0 and are not taken. The null source is a source of its own
and comes last. Repeated rows are separate rows. The document at the edge of a target gives its
first words only, so the words taken from a source are its target, rounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackweave.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
# For each weight, knots (time, factor) of its schedule; factors between knots are interpolated.
# Time runs from 0 to 1: the first kind of source fades, the second grows, the third stays even.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)))
BUCKET_DIGITS = 3  # hexadecimal digits of the hash that name a bucket of a source
_ADDED = ("size", "source_no", "weight", "source_size", "target", "offset", "taken", "position")


def time_of_share(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time by which a share of a schedule's total demand has arisen."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    total = sum(areas)
    out, done = F.lit(float(knots[-1][0])), total
    for (t0, m0), (t1, m1), area in list(zip(knots, knots[1:], areas, strict=False))[::-1]:
        done -= area
        rest = share * F.lit(total) - F.lit(done)
        slope = (m1 - m0) / (t1 - t0)
        # Solves m0 x + slope x^2 / 2 = rest, in the form that also holds for a slope of 0.
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(m0 * m0) + F.lit(2 * slope) * rest))
        # Where a source starts from nothing, both are 0 at its first word.
        inside = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * rest, F.lit(m0) + root), F.lit(0.0))
        out = F.when(share * F.lit(total) < F.lit(done + area), inside).otherwise(out)
    return out


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, size -> source, source_no, weight, source_size and target; one row a source.

    A source is full if the level at which it fills up asks for no more than the budget; the
    others share what is left by weight. The windows run over the table of sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("source_no", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1)
    most = F.col("source_size") * repeats
    level = F.col("_most") / F.col("weight")
    filling = Window.orderBy("_level", "source_no")
    ranked = (
        numbered.withColumn("weight", weight).withColumn("_most", most).withColumn("_level", level)
        .withColumn("_below", F.sum("_most").over(filling.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_above", F.coalesce(F.sum("weight").over(filling.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
    )
    whole = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * F.lit(share)
    asked = F.col("_below") + F.col("_level") * F.col("_above")
    full = ranked.withColumn("_budget", budget).withColumn("_full", asked <= F.col("_budget"))
    given = F.sum(F.when(F.col("_full"), F.col("_most")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("_full"), F.col("_most").cast("double")).otherwise(
        (F.col("_budget") - given) / open_weight * F.col("weight")
    )
    return full.select("source", "source_no", "weight", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, repeats: int = REPEATS, schedules: Sequence = SCHEDULES, ties: Sequence[str] = (), **shares: object
) -> DataFrame:
    """docs with doc_id, source and size (words) -> the same rows with what the mix takes of them.

    Rows of one id and size are laid in the order of the columns ``ties``.

    Adds source_no, weight, source_size, target, offset (words of the source before the
    document), taken (words over all passes) and position (training time, null if not taken).
    """
    rows = docs.drop(*(name for name in _ADDED if name != "size"))
    wanted = targets(rows.select("source", "size"), repeats=repeats, **shares)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    of = wanted.withColumnRenamed("source", "_source")
    placed = rows.join(of, rows.source.eqNullSafe(F.col("_source"))).drop("_source").withColumn("_key", key)
    placed = placed.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    bucket = ["source_no", "_bucket"]
    sums = placed.groupBy(*bucket).agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*bucket, F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*bucket).orderBy("_key", "doc_id", "size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_running", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, bucket)
    offset = F.col("_start") + F.col("_running")
    words = F.round("target").cast("long")
    parts = [taken_in_pass(words, k) for k in range(repeats)]
    share = F.col("offset") / words
    position = F.lit(None).cast("double")
    for kind, knots in reversed(list(enumerate(schedules))):
        mine = F.col("source_no") % len(schedules) == kind
        position = F.when(mine, time_of_share(share, knots)).otherwise(position)
    out = running.withColumn("offset", offset).withColumn("taken", sum(parts[1:], parts[0]))
    out = out.withColumn("position", F.when(F.col("taken") > 0, position))
    return out.select(*rows.columns, *(name for name in _ADDED if name != "size"))


def taken_in_pass(words: Column, number: int) -> Column:
    """Words of a document that lie below its source's target in one pass over the source."""
    left = words - F.col("source_size") * number - F.col("offset")
    return F.greatest(F.lit(0), F.least(left, F.col("size")))


def training_order(docs: DataFrame, repeats: int = REPEATS, schedules: Sequence = SCHEDULES) -> DataFrame:
    """Stage: one row for each time a document is taken, range-sorted by training time.

    Keeps the columns of docs and adds size, taken (words of this pass), pass_no and position,
    which take the place of columns of these four names.
    """
    kept = [name for name in docs.columns if name not in ("size", "taken", "pass_no", "position")]
    sealed = common.sealed(docs.select(*(F.col(f"`{name}`") for name in kept)), "doc_id", "source", "text")
    # Rows that share an id and a size keep their order in every run: the text decides.
    sized = sealed.withColumn("size", common.word_count(F.col("text"))).withColumn("_tie", F.sha2(F.coalesce("text", F.lit("")), 256))
    mixed = mix(sized, repeats, schedules, ["_tie"])
    words = F.round("target").cast("long")
    passes = F.array(*(F.struct(F.lit(k).alias("pass_no"), taken_in_pass(words, k).alias("part")) for k in range(repeats)))
    rows = mixed.where("taken > 0").withColumn("_pass", F.explode(passes)).where("_pass.part > 0")
    share = (F.col("offset") + F.col("source_size") * F.col("_pass.pass_no")) / words
    position = F.lit(None).cast("double")
    for kind, knots in reversed(list(enumerate(schedules))):
        position = F.when(F.col("source_no") % len(schedules) == kind, time_of_share(share, knots)).otherwise(position)
    back = [F.col(name) if name in ("doc_id", "source", "text") else F.col(common.ROW).getField(name).alias(name) for name in kept]
    out = rows.select(*back, "size", F.col("_pass.part").alias("taken"), F.col("_pass.pass_no").alias("pass_no"), position.alias("position"))
    return by_position(out)


def by_position(df: DataFrame) -> DataFrame:
    return df.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
