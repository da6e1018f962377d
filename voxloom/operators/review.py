"""Reviews of masked calls, joins that check their keys, and invariants of speaker groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def verdicts(calls: DataFrame, explicit: DataFrame, ranges: list[tuple[int, int, str]]) -> DataFrame:
    """Calls (call_id, place) with ``verdict``: the reviewer's own, else that of a range [from, to) of places, else ``unseen``; and whether it came by range."""
    by_range = F.lit(None).cast("string")
    for first, behind, verdict in reversed(ranges):  # the first range that holds a place decides
        by_range = F.when((F.col("place") >= first) & (F.col("place") < behind), verdict).otherwise(by_range)
    own = explicit.select("call_id", F.col("verdict").alias("_own"))
    rows = calls.join(own, "call_id", "left")
    return rows.withColumns({"verdict": F.coalesce("_own", by_range, F.lit("unseen")), "by_range": F.col("_own").isNull() & by_range.isNotNull()}).drop("_own")


def export(judged: DataFrame, most: int, order: str = "pii") -> DataFrame:
    """The ``most`` passed calls that have a file and the most personal data; refused, when rows are read, if any call leaks."""
    leaks = judged.agg(F.count_if(F.col("verdict") == "leak").alias("leaks"))
    clean = F.assert_true(F.col("leaks") == 0, F.lit("a call leaks: nothing is exported"))
    passed = judged.where("verdict = 'pass' and has_file").join(F.broadcast(leaks)).where(clean.isNull()).drop("leaks")
    return passed.orderBy(F.desc(order), "call_id").limit(most)


def join_one_to_one(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """A join whose keys are once on either side; another row with a key is an error, raised when rows are read."""
    for name, side in (("left", left), ("right", right)):
        once = side.groupBy(key).agg(F.count("*").alias("_n"))
        bad = F.assert_true(F.col("_n") == 1, F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(f" is more than once on the {name}")))
        checked = side.join(once, key).where(bad.isNull()).drop("_n")
        left, right = (checked, right) if name == "left" else (left, checked)
    return left.join(right, key, how)


def violations(sides: DataFrame) -> DataFrame:
    """(invariant, n): calls in two split groups, sides with two clusters, calls whose sides share a cluster. sides: call_id, channel, cluster, split_group."""
    calls = sides.groupBy("call_id").agg(F.count_distinct("split_group").alias("groups"), F.count_distinct("cluster").alias("clusters"), F.count_distinct("channel").alias("channels"))
    two = sides.groupBy("call_id", "channel").agg(F.count_distinct("cluster").alias("n")).agg(F.count_if(F.col("n") > 1).alias("split_sides"))
    row = calls.agg(F.count_if(F.col("groups") > 1).alias("split_calls"), F.count_if((F.col("channels") > 1) & (F.col("clusters") < F.col("channels"))).alias("shared_speakers")).join(F.broadcast(two))
    names = ("split_calls", "split_sides", "shared_speakers")
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("invariant"), F.col(n).alias("n")) for n in names])))
