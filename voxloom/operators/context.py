"""What else was said in a call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a channel's transcript that become context, and what stands behind a cut one.
CONTEXT_CHARS, CUT_MARK = 2500, "\n[TRUNCATED]"


def channel_texts(segments: DataFrame) -> DataFrame:
    """call_id, channel, transcript: the channel's turns in order, a line each, without white space at the ends."""
    lines = segments.groupBy("call_id", "channel").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    joined = F.array_join(F.transform("x", lambda x: x["text"]), "\n")
    return lines.select("call_id", "channel", F.regexp_replace(joined, r"^[ \t-\r]+|[ \t-\r]+$", "").alias("transcript"))


def other_channels(segments: DataFrame, most: int = CONTEXT_CHARS) -> DataFrame:
    """call_id, channel, context: the call's other channels under a heading each, cut with a mark beyond ``most`` characters."""
    own = channel_texts(segments)
    short = F.when(F.char_length("transcript") > most, F.concat(F.substring("transcript", 1, most), F.lit(CUT_MARK))).otherwise(F.col("transcript"))
    part = F.concat(F.lit("Other channel "), F.col("channel").cast("string"), F.lit(":\n"), short)
    parts = own.where("transcript <> ''").groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("channel", part.alias("part")))).alias("parts"))
    other = F.transform(F.filter("parts", lambda x: x["channel"] != F.col("channel")), lambda x: x["part"])
    return own.select("call_id", "channel").join(parts, "call_id", "left").select("call_id", "channel", F.coalesce(F.array_join(other, "\n\n"), F.lit("")).alias("context"))
