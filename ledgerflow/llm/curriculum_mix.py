"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a weight from a repeating cycle; the mix holds a given share
of all words, a source's target stops at ``max_epochs`` times its size and the
excess is shared again by weight. Over training time t in [0, 1] a source's
weight follows a linear schedule whose integral is its target, so its
cumulative demand of words at time t is

    D(t) = target * (a t + (b - a) t^2 / 2) / ((a + b) / 2).

The documents of a source stand in one fixed pseudo-random order, pass after
pass. A take that begins after c words of its source, those of earlier passes
included, is wanted at the time t with D(t) = c: its training position. Takes
are range-sorted by position, so each pass of a document has a place of its own.

The running sums are built from sums of (source, slice) groups, slices being
ranges of the order's hash: no source, however large, meets in one task. The
only table that passes one task has one row for each source.

Defined cases: null text has size 0 and takes nothing; a null source is a
source of its own, last; null ids are ordered first; repeated rows each count;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spaced_words, stored

WEIGHTS = (3, 1, 2)
# (weight multiple at t = 0, at t = 1) for each place of the cycle; mean 1 each,
# so that the integral over training is the plain weight.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
SHARE = (3, 2)  # the mix holds 3/2 of all words
MAX_EPOCHS = 2
SLICE_DIGITS = 3  # 16^3 slices of the order's hash for each source


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, place, source_size, target (double).

    Sources are capped in ascending order of cap / weight; with C the caps and
    W the weights left when the first uncapped source is met, every uncapped
    target is (share * total - C) * weight / W: one division of whole numbers.
    """
    num, den = share
    cycle = F.array(*[F.lit(w).cast("decimal(38,0)") for w in weights])
    common = lcm(*weights)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    ranked = (per
              .withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("w", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size").cast("decimal(38,0)") * max_epochs)
              .withColumn("total", F.sum(F.col("source_size").cast("decimal(38,0)")).over(everything)))
    by_ratio = Window.orderBy((F.col("cap") * (F.lit(common) / F.col("w")).cast("decimal(10,0)")).asc(), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    dec = lambda c: c.cast("decimal(38,0)")
    # all terms are multiplied by the share's denominator
    capped = (ranked
              .withColumn("left", dec(F.col("total") * num) - dec(F.coalesce(F.sum("cap").over(before), F.lit(0)) * den))
              .withColumn("w_left", dec(F.sum("w").over(onward)))
              .withColumn("capped", dec(F.col("left") * F.col("w")) > dec(dec(F.col("cap") * den) * F.col("w_left"))))
    settled = (capped
               .withColumn("c_all", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
               .withColumn("w_all", F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0)).over(everything)))
    shared = (dec((dec(F.col("total") * num) - dec(F.col("c_all") * den)) * F.col("w")).cast("double")
              / (F.col("w_all") * den).cast("double"))
    return settled.select(
        "source", "place", "source_size",
        F.when(F.col("capped") | (F.col("w_all") == 0), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def _position(start: Column, quota: Column, place: Column, schedules) -> Column:
    """Time t at which the cumulative demand reaches ``start`` words."""
    share = start.cast("double") / quota.cast("double")

    def solved(a: float, b: float) -> Column:
        if a == b:
            return share
        return (F.sqrt(a * a + (b * b - a * a) * share) - a) / (b - a)

    cases = [(i, solved(a, b)) for i, (a, b) in enumerate(schedules)]
    kind = place % len(schedules)
    return reduce(lambda acc, c: F.when(kind == c[0], c[1]).otherwise(acc), cases[1:], cases[0][1])


def _planned(documents: DataFrame, weights, schedules, share, max_epochs: int, slice_digits: int, keep: tuple[str, ...]) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, takes, first and ``keep``;
    ``takes`` has (pass, taken, position) for each pass that takes words, in order;
    with words, ``first`` is true of the first document of its source that has any."""
    narrow = documents.select(
        "doc_id", "source", spaced_words().alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("order_key"), *keep)
    docs = narrow if keep else stored(narrow, "sizes")
    sized = docs.select("source", "size", F.substring("order_key", 1, slice_digits).alias("slice"))
    targets = stored(source_targets(sized, weights, share, max_epochs), "targets")
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    offsets = slices.select(
        "source", "slice",
        F.coalesce(F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("slice_start"))
    plan = (offsets.alias("o").join(targets.alias("t"), F.expr("o.source <=> t.source"))
            .select("o.source", "slice", "slice_start", "place", "source_size", "target"))
    d = docs.withColumn("slice", F.substring("order_key", 1, slice_digits))
    joined = (d.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source and d.slice = p.slice"))
              .select("d.*", "slice_start", "place", "source_size", "target"))
    within = (Window.partitionBy("source", "slice").orderBy("order_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    quota = F.floor("target").cast("long")
    begun = (joined.withColumn("start", F.col("slice_start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
             .withColumn("quota", quota))
    takes = []
    for e in range(max_epochs):
        at = F.col("start") + e * F.col("source_size")
        taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - at)).cast("long")
        takes.append(F.when(taken > 0, F.struct(F.lit(e).alias("pass"), taken.alias("taken"),
                                                _position(at, F.col("quota"), F.col("place"), schedules).alias("position"))))
    return begun.select("doc_id", "size", "source_size", "target", F.array_compact(F.array(*takes)).alias("takes"),
                        (F.col("start") == 0).alias("first"), *keep)


def curriculum(documents: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share=SHARE, max_epochs: int = MAX_EPOCHS,
               slice_digits: int = SLICE_DIGITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, position.

    ``taken`` counts the words of all passes the mix takes (a source's sum is
    its target, rounded down); ``position`` is the training time of the first
    take, null if nothing is taken. Columns named in ``keep`` follow as they are.
    """
    return _planned(documents, weights, schedules, share, max_epochs, slice_digits, keep).select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("takes", F.lit(0).cast("long"), lambda n, x: n + x["taken"]).alias("taken"),
        F.get("takes", F.lit(0))["position"].alias("position"), *keep)


def passes(documents: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share=SHARE, max_epochs: int = MAX_EPOCHS,
           slice_digits: int = SLICE_DIGITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document and pass that takes words of it: doc_id, size,
    source_size, target, pass (from 0), taken, position, first (whether no words of
    the source stand before the document). A document of which nothing is taken has
    one row with null pass and position."""
    return (_planned(documents, weights, schedules, share, max_epochs, slice_digits, keep)
            .withColumn("take", F.explode_outer("takes"))
            .select("doc_id", "size", "source_size", "target", F.col("take")["pass"].alias("pass"),
                    F.coalesce(F.col("take")["taken"], F.lit(0).cast("long")).alias("taken"),
                    F.col("take")["position"].alias("position"), "first", *keep))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Range-sorted by position; documents not taken (null position) come first."""
    return mixed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def copies(documents: DataFrame, columns: list[str], **options) -> DataFrame:
    """The mixed corpus: every document once for each pass that takes at least
    half of its words, whole, each at that pass's own place in training order.
    Documents without words stay, and so does the first pass of a source's first
    document with words where any are wanted: no source with a quota disappears."""
    whole = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row")
    mixed = passes(documents.select("doc_id", "text", "source", whole), keep=("__row",), **options)
    opening = F.col("first") & (F.col("pass") == 0)
    return in_training_order(mixed.where((F.col("size") == 0) | (F.col("taken") * 2 >= F.col("size")) | opening)).select("__row.*")
