"""Mixing sources to target weights: a time-varying curriculum.

Every source gets a token target by weight. Its documents stand in a hash
order; a copy of a document that starts ``c`` tokens into its source's demand
is trained at the time at which the source's integrated weight schedule has
asked for ``c`` tokens. Sorting all copies by that time gives the training
order. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadframe.llm.common import ordered, read_table, shuffle_partitions, stored, uniform

#: words are runs of anything but space and the ASCII controls 9 to 13
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEAT = 2
#: change of a source's weight over the run, by its place among the sources:
#: its rate goes linearly from 1 - slope at the start to 1 + slope at the end
SLOPES = (-0.5, 0.0, 0.5)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values: Sequence[float], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (index % len(values)).cast("int") + 1)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_repeat: int = MAX_REPEAT, slopes: Sequence[float] = SLOPES) -> DataFrame:
    """``(source, size)`` rows to one row per source: ``source_size``,
    ``target``, ``slope``.

    Sources by code point, null last, take ``weights`` and ``slopes`` in turn.
    The budget is ``share`` of all sizes; a target stops at ``max_repeat``
    times its source's size and the excess goes to the others by weight. That
    fixpoint is target = min(cap, level * weight): sources by cap / weight,
    the level is the first that leaves the rest of them below their caps. The
    two windows run over the summary, one row per source, not over documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = sources.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    sources = sources.select("source", "source_size", _cycle(weights, F.col("place")).alias("weight"),
                             _cycle(slopes, F.col("place")).alias("slope"),
                             (F.lit(max_repeat) * F.col("source_size")).cast("double").alias("cap"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_first())
    earlier, whole = by_fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    budget = F.lit(share) * F.sum("source_size").over(whole)
    sources = sources.withColumns({
        "left": budget - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)),
        "open": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))})
    fits = F.col("left") / F.col("open") <= F.col("cap") / F.col("weight")
    sources = sources.withColumn("level", F.first(
        F.when(fits, F.col("left") / F.col("open")), ignorenulls=True)
        .over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return sources.select("source", "source_size", "slope",
                          F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def demand_time(share: Column, slope: Column) -> Column:
    """Time in [0, 1] at which a source has been asked for ``share`` of its
    target: the inverse of the integral D(t) = t + slope * (t^2 - t) of its
    rate 1 + slope * (2t - 1)."""
    b = F.lit(1.0) - slope
    root = F.sqrt(F.greatest(b * b + F.lit(4.0) * slope * share, F.lit(0.0)))
    return F.when(slope == 0, share).otherwise((root - b) / (F.lit(2.0) * slope))


def _with_targets(frame: DataFrame, targets: DataFrame) -> DataFrame:
    """Null-safe join; the stored per-source table is broadcast by Spark when
    its file size allows."""
    t = targets.withColumnRenamed("source", "_source")
    return frame.join(t, frame["source"].eqNullSafe(t["_source"])).drop("_source")


def _draw(seed: int) -> Column:
    return uniform(F.lit(seed), F.col("doc_id"), F.col("text"))


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
             max_repeat: int = MAX_REPEAT, slopes: Sequence[float] = SLOPES, seed: int = 0) -> DataFrame:
    """One row per document row: ``doc_id, source, size, source_size, target,
    copies, taken, positions`` (times of its copies in [0, 1], ascending),
    ``draw``, its place in the source's hash order, and ``row``, its number.

    Whole documents are taken, in hash order, as long as a copy's middle lies
    within its source's target; the second pass repeats the order. So a source
    misses its target by less than one document. Null or empty texts have size
    0 and are taken once per pass that reaches them; null sources are a
    source; documents equal in id and text share one draw and stand side by
    side. Same input, same result, whatever the partitioning.
    """
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _draw(seed).alias("draw"))
    narrow = stored(narrow, "mix-sizes")  # the range sort samples its input; words are counted once
    placed = ordered(narrow, [F.col("source").asc_nulls_last(), F.col("draw"), F.col("doc_id")], "mix", sums=["size"])
    targets = source_targets(placed.select("source", "size"), weights, share, max_repeat, slopes)
    # where each source begins in the global order
    starts = placed.groupBy("source").agg(F.min("size_before").alias("source_start"))
    targets = stored(_with_targets(starts, targets), "mix-targets")
    plan = _with_targets(placed, targets).withColumn("start", F.col("size_before") - F.col("source_start"))
    middles = F.transform(F.sequence(F.lit(0), F.lit(max_repeat - 1)),
                          lambda e: F.col("start") + e * F.col("source_size") + F.col("size") / 2)
    kept = F.filter(middles, lambda m: m <= F.col("target"))
    when = F.transform(kept, lambda m: demand_time(
        F.coalesce(F.try_divide(m, F.col("target")), F.lit(0.0)), F.col("slope")))
    plan = plan.withColumn("positions", when).withColumn("copies", F.size("positions"))
    return plan.select(F.col("rank").alias("row"), "doc_id", "source", "size", "source_size", "target", "slope", "draw",
                       "copies", (F.col("copies") * F.col("size")).alias("taken"), "positions")


def placed_copies(plan: DataFrame) -> DataFrame:
    """One row per copy with ``place``, its rank (long, gapless from 0) in the
    training order: by position, and at one position by draw, copy and row."""
    copies = plan.select("*", F.posexplode("positions").alias("copy", "position"))
    keys = [F.col(c) for c in ("position", "draw", "copy", "row")]
    return ordered(copies, keys, "mix-order").withColumnRenamed("rank", "place")


def training_order(plan: DataFrame) -> DataFrame:
    """The rows of ``placed_copies``, range-sorted by place."""
    placed = placed_copies(plan)
    return placed.repartitionByRange(shuffle_partitions(plan.sparkSession), "place").sortWithinPartitions("place")


def plan_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``plan_mix`` with ``places``: the ranks of the document's
    copies in the training order, one for each of its positions."""
    plan = stored(plan_mix(docs, **options), "mix-plan")  # the range sort samples its input
    placed = placed_copies(plan.select("row", "draw", "positions"))
    places = placed.groupBy("row").agg(F.sort_array(F.collect_list("place")).alias("places"))  # at most `max_repeat`
    return plan.join(places, "row", "left").withColumn(
        "places", F.coalesce("places", F.array().cast("array<long>")))


def mix_documents(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mixed documents themselves: all columns of ``docs``, one row per
    copy, range-sorted by training time.

    The exact plan gives, for each source, the draw up to which each pass
    takes documents; these cut points (one row per source) are applied to the
    documents where they lie, so texts move once, for the final sort. There
    the position uses the draw, a document's expected share of its source, as
    cumulative demand.
    """
    columns = docs.columns
    plan = plan_mix(docs, seed=seed, **options)
    most = int(options.get("max_repeat", MAX_REPEAT))
    cuts = stored(plan.groupBy("source").agg(
        F.first("slope").alias("_slope"), F.first("source_size").alias("_size"), F.first("target").alias("_target"),
        *(F.max(F.when(F.col("copies") > e, F.col("draw"))).alias(f"_cut{e}") for e in range(most))), "mix-cuts")
    drawn = docs.withColumn("_draw", _draw(seed))
    c = cuts.withColumnRenamed("source", "_source")
    drawn = drawn.join(c, drawn["source"].eqNullSafe(c["_source"]))
    copies = F.filter(F.array(*(F.when(F.col("_draw") <= F.col(f"_cut{e}"), F.lit(e)) for e in range(most))),
                      lambda x: x.isNotNull())
    drawn = drawn.withColumn("_copy", F.explode(copies))
    share = F.coalesce(F.try_divide((F.col("_copy") + F.col("_draw")) * F.col("_size"), F.col("_target")), F.lit(0.0))
    drawn = drawn.withColumn("_time", demand_time(F.least(share, F.lit(1.0)), F.col("_slope")))
    keys = ["_time", "_draw", "_copy"]
    drawn = drawn.repartitionByRange(shuffle_partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    return drawn.select(*columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the words the mix takes of each and the places of
    their copies in the training order; see ``plan_mix`` and ``plan_order``."""
    plan = plan_order(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "positions", "places")
