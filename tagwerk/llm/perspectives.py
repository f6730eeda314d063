"""Chat formatting by rotating the perspective of a dialogue.

For every participant the dialogue is rendered once with that speaker as the
assistant and everyone else as a named user; the loss mask covers what the
assistant says.  The rendering is returned turn by turn with its place in the
whole, so a long dialogue never has to fit into one row or one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered

SYSTEM = ("system",)   # speakers that set the scene and are not participants
NOBODY = "unknown"     # the name of a speaker that the table does not name
END = "<|end|>\n"


def rotate(turns: DataFrame, system: tuple[str, ...] = SYSTEM, block: int = 512) -> DataFrame:
    """One row per conversation, participant and turn.

    ``turns``: conv_id, turn, role, text.  Returns conv_id, perspective, seq
    (place of the turn, from 0), turn, role (assistant, user or system), name
    (of a user), segment (rendered text), start (characters of the segments
    before), mask_start and mask_end (the loss span, empty unless the
    perspective speaks).

    Turns follow one another by turn, then role, then text, nulls first.  A
    null role is the participant "unknown", a null text is empty, every row
    without conv_id is a dialogue of its own, repeated rows are turns of their
    own.  A conversation of system turns only has no participant and so no row,
    nor has an empty table.  Other columns are not read.

    Turns are numbered by ranges of (conversation, turn, role, text), and places
    are summed inside blocks of ``block`` turns, whose totals are summed after
    that: no task and no window has to take in a whole conversation.  The join
    with the participants splits hot conversations.
    """
    t = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NOBODY)).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("said"))
    alone = t.where("conv_id IS NULL").where(~F.col("speaker").isin(*system))
    alone = _rendered(alone.withColumn("perspective", F.col("speaker")), system).select(
        "*", *[F.lit(0).cast("long").alias(c) for c in ("seq", "start")])
    # equal turns are interchangeable: their order in the scan spreads them over ranges
    named = t.where("conv_id IS NOT NULL").withColumn("_scan", F.monotonically_increasing_id())
    named = numbered(named, ["conv_id"], ["turn", "speaker", "said", "_scan"]).withColumn("block", F.floor(F.col("pos") / block).cast("long"))
    own = t.where("conv_id IS NOT NULL").where(~F.col("speaker").isin(*system)).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    views = _rendered(named.join(own, "conv_id"), system).withColumn("size", F.char_length("segment").cast("long"))
    dialogue = ["conv_id", "perspective"]
    inside = Window.partitionBy(*dialogue, "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = views.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    totals = views.groupBy(*dialogue, "block").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy(*dialogue).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*dialogue, "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    joined = placed.join(base, [*dialogue, "block"]).withColumn("start", F.col("base") + F.col("before")).withColumnRenamed("pos", "seq")
    mask_start = F.col("start") + F.char_length("head")
    speaks = F.col("role") == "assistant"
    columns = ["conv_id", "perspective", "seq", "turn", "role", "name", "segment", "start", "head", "said"]
    return (joined.select(*columns).unionByName(alone.select(*columns))
            .select(*columns[:-2], mask_start.alias("mask_start"),
                    F.when(speaks, mask_start + F.char_length("said")).otherwise(mask_start).alias("mask_end")))


def _rendered(views: DataFrame, system: tuple[str, ...]) -> DataFrame:
    """Role, name, head and segment of each turn as its perspective sees it."""
    role = (F.when(F.col("speaker") == F.col("perspective"), "assistant")
            .when(F.col("speaker").isin(*system), "system").otherwise("user"))
    name = F.when(F.col("role") == "user", F.col("speaker"))
    head = F.concat(F.lit("<|"), F.col("role"), F.coalesce(F.concat(F.lit(" "), F.col("name")), F.lit("")), F.lit("|>\n"))
    return (views.withColumn("role", role).withColumn("name", name).withColumn("head", head)
            .withColumn("segment", F.concat("head", "said", F.lit(END))))
