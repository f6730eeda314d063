"""Mixing sources to target weights.

Sizes are summed per source, the wanted total is shared out by weight, and the
target over the size of a source is its repetition rate.  Every document is
then emitted floor(rate) times, and once more if a draw that is a hash of seed
and doc_id falls below the fraction.  All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, unused

DRAWS = 1 << 52  # a draw is one of so many equally likely steps: 13 hex digits


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of seed and id; null ids draw as the text 'null'."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(DRAWS))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, share: float = 1.0) -> DataFrame:
    """(source, source_size, weight, target) for each source of ``sizes`` (source, size).

    Weights repeat over the sources in code-point order, null last.  Where a
    source's share exceeds ``most`` times its size, its target stops there and
    the excess is shared among the others by weight until none is above.  That
    fixed point has one level L with target = min(most * size, weight * L): the
    sources reach their stops in the order of most * size / weight, so L is
    read off running sums over the sources in that order.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    ranked = per.withColumn("weight", weight.cast("long")).withColumn("stop", F.col("source_size") * most)
    by_stop = Window.orderBy((F.col("stop") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("stop").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    level = (total * F.lit(share) - before) / after  # if this source and all later ones stay below their stops
    rows = ranked.withColumn("own_level", level)
    # the level is that of the first source which stays below its stop
    holds = F.when(F.col("own_level") * F.col("weight") <= F.col("stop"), F.col("own_level"))
    first = F.first(holds, ignorenulls=True).over(by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    stop = F.col("stop").cast("double")
    target = F.when(F.col("level").isNull(), stop).otherwise(F.least(stop, F.col("level") * F.col("weight")))
    return rows.withColumn("level", first).select("source", "source_size", "weight", target.alias("target"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3,
             share: float = 1.0, seed: str = "mix") -> DataFrame:
    """``docs`` with size, source_size, target, rate and copies; input columns of these names give way.

    Null and empty texts have size 0; rows without a source form a source of
    their own, last in order; a source of size 0 has rate 0.  Rows that share a
    doc_id draw alike.  Reruns agree, as nothing but seed and id is drawn from.
    The few source rows are joined by broadcast when Spark finds them small,
    else by a shuffle that splits hot sources.
    """
    docs = docs.drop("size", "source_size", "target", "rate", "copies")
    sized = docs.withColumn("size", n_words(F.col("text").cast("string")))
    targets = source_targets(sized.select("source", "size"), weights, most, share)
    own = unused(docs, "_source")
    targets = targets.select(F.col("source").alias(own), "source_size", "target")
    joined = sized.join(targets, sized["source"].eqNullSafe(targets[own])).drop(own)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate").cast("long")
    again = F.when(draw(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.withColumn("rate", rate).withColumn("copies", whole + again)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3,
        share: float = 1.0, seed: str = "mix") -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the plan says, with the columns of ``docs``.

    Extra columns may have any name: they are carried in a struct beside the
    plan.  Null texts and sources, rows that repeat or share an id and an empty
    table are as in ``plan_mix``.
    """
    inner = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))
    plan = plan_mix(inner, weights, most, share, seed).where("copies > 0")
    return plan.select(F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"), "_row").select("_row.*")
