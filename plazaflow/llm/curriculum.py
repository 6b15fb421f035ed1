"""Mixing to target weights along a curriculum.

Each source has a weight schedule over training time 0..1. Its share of all words is the
integral of the schedule; what a source cannot supply within `most` repeats goes to the others
by weight. A word of a source is due when the integrated schedule has demanded the words before
it, so positions come from inverting the cumulative demand. Prefix sums run per bucket of a
source and over its bucket totals, so a source of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from plazaflow.llm.common import numbered, written

BUCKETS = 4096  # of each source, by a hash of the document
WORD = r"[^\x20\x09-\x0D]+"
#: Schedules by the rank of the source, repeating: knots of (time, relative weight), linear between.
RAMPS = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
WEIGHTS = (5.0, 2.0, 1.0)


def integrated(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """Per segment: start time, start weight, slope, and the share of the whole demand before it."""
    if len(knots) < 2 or knots[0][0] != 0 or knots[-1][0] != 1 or any(w < 0 for _, w in knots) or any(a[0] >= b[0] for a, b in zip(knots, knots[1:])):
        raise ValueError("a schedule needs rising times from 0 to 1 and weights of 0 or more")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole = sum(areas)
    if not whole:
        raise ValueError("a schedule needs some weight")
    before = [0.0, *accumulate(areas)]
    return [(a[0], a[1] / whole, (b[1] - a[1]) / (b[0] - a[0]) / whole, before[i] / whole) for i, (a, b) in enumerate(zip(knots, knots[1:]))]


def when_due(u: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the share u of a source's words has been demanded."""
    due = None
    for start, weight, slope, before in integrated(knots):
        rest = F.greatest(u - before, F.lit(0.0))
        # root of weight t + slope t^2 / 2 = rest, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(weight * weight + 2 * slope * rest, F.lit(0.0)))
        t = start + F.when(rest > 0, F.try_divide(2 * rest, weight + root)).otherwise(0.0)
        due = t if due is None else F.when(u >= before, t).otherwise(due)
    return F.least(F.coalesce(due, F.lit(1.0)), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """Adds rank (by code point, null last), weight and target to each source's source_size.

    Targets share all words by weight; none exceeds `most` times its source. The excess is shared
    again by weight: with c the level at which sum(min(most * size, c * weight)) is the whole, the
    capped sources are those with the smallest most * size / weight, found in one ordered pass.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be above 0")
    own = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(own) - 1)
    ranked = ranked.withColumn("weight", F.element_at(table, (F.col("rank") % len(weights) + 1).cast("int"))).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level).withColumn("capped", F.col("cap") / F.col("weight") < F.col("level"))
    # sources are capped up to the first whose cap is above the level; that level holds for the rest
    c = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("k"), "rank", "level"))).over(Window.partitionBy())["level"]
    target = F.least("cap", F.coalesce(F.col("c") * F.col("weight"), F.col("cap")))
    return leveled.withColumn("c", c).withColumn("target", target).drop("c", "level", "capped", "cap")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = 3, ramps: Sequence = RAMPS, carry: list[str] | None = None) -> DataFrame:
    """Per document: row (its columns `carry`, all by default), size, source_size, target, taken, and takes.

    takes is an array of (position, words), one for each time the document is read. A source's
    documents stand in the order of a hash of doc_id (ties by doc_id, size and a hash of the text)
    and are read round and round until the target is met; the last one read may be taken in part,
    so the words taken are the target up to rounding. Null text has size 0 and is never taken. A
    null source is a source. Rows may repeat, and each counts. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    source, bucket = F.col("source").cast("string"), F.pmod(F.shiftrightunsigned(F.xxhash64("doc_id"), 40), F.lit(BUCKETS))
    key = F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"), "doc_id", source.alias("source"), key.alias("key"),
                       bucket.alias("bucket"), size.alias("size"), F.xxhash64("text").alias("copy"))
    sizes = written(rows.groupBy("key", "source", "bucket").agg(F.sum("size").alias("words")), "bucket-sizes")
    targets = source_targets(sizes.groupBy("key", "source").agg(F.sum("words").alias("source_size")), weights, float(most))
    upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("key", "bucket", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("bucket_start")).join(
        targets.select("key", "source_size", "rank", "target"), "key")
    inside = Window.partitionBy("key", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["key", "bucket"])
    start, goal = F.col("bucket_start") + F.col("before"), F.round("target").cast("long")

    def take(turn: Column) -> Column:
        first = start + turn * F.col("source_size")
        share, due = F.least(F.coalesce(F.try_divide(first.cast("double"), F.col("target")), F.lit(1.0)), F.lit(1.0)), None
        for i, knots in enumerate(ramps):
            own = when_due(share, knots)
            due = own if due is None else F.when(F.col("rank") % len(ramps) == i, own).otherwise(due)
        return F.struct(due.alias("position"), F.least(F.col("size"), F.greatest(goal - first, F.lit(0))).alias("words"))

    takes = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), take), lambda t: t["words"] > 0)
    return placed.withColumn("takes", takes).select(
        "row", "size", "source_size", "target", F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + t["words"]).alias("taken"), "takes")


def _readings(mixed: DataFrame, *others: str) -> DataFrame:
    """One row per reading of a document: row, position, words, reading (from 1) and `others`."""
    return mixed.select("row", *others, F.posexplode("takes").alias("reading", "take")).select(
        "row", F.col("take.position").alias("position"), F.col("take.words").alias("words"), (F.col("reading") + 1).alias("reading"), *others)


def _order() -> list[Column]:
    return [F.col("position"), F.xxhash64("row.doc_id"), F.col("reading")]


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading of a document, range-sorted by position: row, position, words, reading (from 1)."""
    return _readings(mixed).repartitionByRange(*_order()).sortWithinPartitions(*_order())


def with_places(mixed: DataFrame) -> DataFrame:
    """Per row of `mixed`, what its readings are in training order: adds position and place of the first one.

    All readings are range-sorted as by `in_training_order` and numbered from 0 (among readings alike in
    position, doc_id and reading, by words, size and target). taken is the sum over a row's readings;
    a row that is never read has 0, and null for position and place.
    """
    rows = written(mixed.withColumn("_doc", F.monotonically_increasing_id()), "mixed")
    read = numbered(_readings(rows, "_doc", "size", "target"), [], [*_order(), F.col("words"), F.col("size"), F.col("target")], "place")
    first = read.groupBy("_doc").agg(F.min("position").alias("position"), F.min("place").alias("place"), F.sum("words").alias("taken"))
    joined = rows.drop("taken").join(first, "_doc", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    return joined.select(*mixed.columns, "position", "place")
