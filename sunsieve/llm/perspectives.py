"""Multi-party perspective rotation: a dialogue rendered once for each participant.

For every speaker of a conversation that speaker is the assistant, all others are named users, and
only the assistant's words are trained on. The result has a row per message and perspective, with
the message's place in the rendered dialogue; joined by start they are the dialogue. So a
conversation of any length is rendered without gathering it. Only built-in columns.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunsieve.llm.common import numbered, text_of
from sunsieve.sources.shared import landed

#: Whoever speaks under this role frames the dialogue and is no participant.
FRAME = "system"
#: The speaker of a message without a role.
NOBODY = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Messages that one window holds.
SPAN = 256


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the left ones stay."""
    named = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(named, on, how).drop(*(f"_{k}" for k in keys))


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, turn, speaker, role, segment, start, end, mask_start, mask_end.

    `role` is assistant, user or system; `segment` stands at code points start..end of the rendered
    dialogue, of which mask_start..mask_end are trained on (empty unless the assistant speaks: then
    its words and the closing mark). Turns come by number, null numbers first, ties by speaker and
    text; repeated rows are repeated turns. A null role is `unknown`, a null text empty, rows with a
    null conv_id are one conversation, and a conversation without participants has no rows. Other
    columns are not read. Marks that stand in a text, and line ends in a speaker's name, are taken as
    they are: the spans of a segment, not its marks, tell where it ends.

    Messages are put in order by ranges, and places are summed over spans of neighbours in that
    order, so no task holds a long conversation, whatever its turns are numbered.
    """
    speaker = F.coalesce(F.when(F.btrim("role") != "", F.col("role")), F.lit(NOBODY))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        speaker.alias("speaker"),
        text_of().alias("text"),
        F.monotonically_increasing_id().alias("by"),  # parts equal messages
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("speaker"), F.asc("text"), F.asc("by")]
    rows = numbered(landed(rows, "messages"), order).drop("by")
    who = rows.where(F.col("speaker") != FRAME).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    seen = _same(rows, who, ["conv_id"])
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == FRAME, FRAME).otherwise("user")
    head = F.concat(F.lit(OPEN), role, F.when(role == "user", F.concat(F.lit(" name="), "speaker")).otherwise(""), F.lit("\n"))
    seen = seen.select("*", role.alias("role"), head.alias("head"), F.floor(F.col("place") / SPAN).alias("span"))
    seen = seen.withColumn("segment", F.concat("head", "text", F.lit(CLOSE + "\n")))
    seen = seen.withColumn("size", F.length("segment").cast("long"))

    # Places by a scan in two steps: sums of spans first.
    keys = ["conv_id", "perspective", "span"]
    before = Window.partitionBy(*keys[:2]).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = seen.groupBy(*keys).agg(F.sum("size").alias("total"))
    spans = spans.select(*keys, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin"))
    placed = _same(seen, spans, keys)
    up_to_here = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end: Column = F.col("begin") + F.sum("size").over(up_to_here)
    placed = placed.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    trained = F.col("role") == "assistant"
    first = F.col("start") + F.length("head")
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        "role",
        "segment",
        "start",
        "end",
        F.when(trained, first).otherwise(F.col("end")).alias("mask_start"),
        F.when(trained, F.col("end") - 1).otherwise(F.col("end")).alias("mask_end"),
    )
