"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import clean_name, stored

HASH_BITS = 60
LEVEL_BITS = 12
# Weights of the sources in the order of their code points, repeating.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column) -> Column:
    """A fixed 60-bit number for a document: the MD5 of its id as text, or of its text where
    the id is null. The same document gets the same number in every run."""
    seed = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(seed), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """One row per source: source, source_size, target.

    All targets sum to the size of all sources. Each is proportional to its weight, up to
    ``most`` times the source's own size; what a full source cannot take goes to the others by
    weight. Closed form: in ascending order of (limit / weight) a source is full if the share
    that is left for it and all later ones reaches its limit; the first that is not full fixes
    the common factor. Works on one row per source."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("place", in_order).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ).withColumn("limit", F.col("source_size") * most)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("size_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    # Full exactly where limit * weight_left <= size_left * weight; whole numbers, so no rounding.
    full = F.col("limit").cast("decimal(38,0)") * F.col("weight_left") <= F.col("size_left").cast("decimal(38,0)") * F.col("weight")
    # The first that is not full has the most weight left.
    first = F.max(F.when(~full, F.struct("weight_left", "size_left"))).over(everything)
    return left.withColumn("first", first).select(
        "source", "source_size",
        F.when(full | F.col("first").isNull(), F.col("limit").cast("double"))
        .otherwise(F.col("weight").cast("double") * F.col("first.size_left").cast("double") / F.col("first.weight_left").cast("double"))
        .alias("target"),
    )


def _level(rows: DataFrame, plan: DataFrame, done_bits: int) -> DataFrame:
    """``plan`` (source, budget, low, ...) with ``low`` moved up by one level: the histogram of the
    next bits inside the boundary bucket, and the highest edge that stays within the budget."""
    shift = HASH_BITS - done_bits - LEVEL_BITS
    inside = rows.join(plan.select(F.col("source").alias("s"), "low"), F.col("source").eqNullSafe(F.col("s")))
    inside = inside.where(F.shiftright("draw", HASH_BITS - done_bits) == F.shiftright("low", HASH_BITS - done_bits)) if done_bits else inside
    bucket = F.shiftright("draw", shift)
    bins = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("upto", F.sum("size").over(below)).join(
        plan.select(F.col("source").alias("s"), "budget"), F.col("source").eqNullSafe(F.col("s")))
    crossed = bins.where(F.col("upto") > F.col("budget")).groupBy("source").agg(
        F.min(F.struct("bucket", "upto", "size", "n")).alias("at"))
    return plan.join(crossed.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole",
        F.when(F.col("at").isNull(), F.col("budget")).otherwise(F.col("budget") - F.col("at.upto") + F.col("at.size")).alias("budget"),
        # No bucket crosses: the whole range fits, so every draw is below the threshold.
        F.when(F.col("at").isNull(), F.col("high")).otherwise(F.shiftleft("at.bucket", shift)).alias("low"),
        F.when(F.col("at").isNull(), F.col("high")).otherwise(F.shiftleft(F.col("at.bucket") + 1, shift)).alias("high"),
        F.coalesce(F.col("at.n"), F.lit(0)).alias("inside"), F.coalesce(F.col("at.size"), F.lit(0)).alias("edge_size"),
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: how many whole times it is taken, and the draw below which a document is taken
    once more. Only the bucket that holds the threshold is refined, until it holds one document
    (or documents of one draw); that one is taken if this brings the sum nearer to the target."""
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    plan = targets.withColumn("whole", whole).select(
        "source", "source_size", "target", "whole", (F.col("target") - F.col("whole") * size).alias("budget"),
        F.lit(0).cast("long").alias("low"), F.lit(1 << HASH_BITS).cast("long").alias("high"), F.lit(2).cast("long").alias("inside"),
    )
    for done in range(0, HASH_BITS, LEVEL_BITS):
        plan = stored(_level(sized, plan, done), "mix-level")
        if plan.where("inside > 1").isEmpty():
            break
    nearer = F.col("edge_size") - F.col("budget") < F.col("budget")
    return plan.select("source", "source_size", "target", "whole",
                       F.when(nearer, F.col("high")).otherwise(F.col("low")).alias("threshold"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """doc_id, source, size, source_size, target, times (0 to ``most``) and taken (times * size).

    Nulls: a null text has size 0, a null source is a source of its own, the last one; a null id
    draws by its text. Equal ids draw alike. An empty table gives no rows. Thresholds are nested:
    a larger target of a source takes all that a smaller one takes. Nothing is sorted but the
    histograms; texts are read once and never shuffled."""
    sized = stored(docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        draw(F.col("doc_id"), F.col("text")).alias("draw"),
    ), "mix-sizes")
    chosen = thresholds(sized, source_targets(sized, weights, most)).withColumnRenamed("source", "s")
    times = F.col("whole") + F.when(F.col("draw") < F.col("threshold"), 1).otherwise(0)
    return sized.join(chosen, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", F.least(times, F.lit(most)).cast("int").alias("times"),
    ).withColumn("taken", F.col("times") * F.col("size"))


def repeat_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """The mixed documents themselves, each as often as the mix takes it, with the columns of
    ``docs``. The thresholds are one row per source, so no document is shuffled by its id."""
    sized = stored(docs.select(
        F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
        draw(F.col("doc_id"), F.col("text")).alias("draw"),
    ), "mix-sizes")
    plan = thresholds(sized, source_targets(sized, weights, most))
    held, copy = clean_name(docs.columns, "mix_plan"), clean_name(docs.columns, "mix_copy")
    packed = plan.select(F.struct("source", "whole", "threshold").alias(held))
    joined = docs.join(packed, F.col("source").cast("string").eqNullSafe(F.col(f"{held}.source")))
    times = F.col(f"{held}.whole") + F.when(
        draw(F.col("doc_id"), F.col("text")) < F.col(f"{held}.threshold"), 1).otherwise(0)
    copies = F.explode(F.sequence(F.lit(1), F.least(times, F.lit(most)).cast("int")))
    return joined.where(times > 0).withColumn(copy, copies).select(*[F.col(f"`{c}`") for c in docs.columns])
