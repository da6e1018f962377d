"""Interval algebra: merging, clipping, overlap, plans of masked intervals, chunks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.columns import word_places
from voxloom.functions.kernels import resolve
from voxloom.operators.alignment import chunk
from voxloom.operators.order import Scans
from voxloom.sources.work import write_work


def islands(rows: DataFrame, keys: list[str], gap: float = 0.0, start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """Adds ``island``: intervals of a key whose gaps are at most ``gap`` share one. Ties are ordered by end. A key may have any share of the rows."""
    scans = Scans(rows, keys, [F.col(start), F.col(end)]).before(F.col(end), "max", "_reach")
    opens = F.when(F.col("_reach").isNull() | (F.col(start) - F.col("_reach") > gap), 1).otherwise(0)
    return scans.upto(opens, "sum", "island").done("island")


def merge(rows: DataFrame, keys: list[str], gap: float = 0.0, start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """Merged intervals of each key."""
    return islands(rows, keys, gap, start, end).groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("merged")).drop("island")


def in_order(found: DataFrame, keys: list[str], value: str, mark: str, distinct: bool, start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """(keys, island, value): an island's values in order of its intervals, joined by a mark; of equal ones, if ``distinct``, the first alone."""
    one = F.struct(start, end, value)
    if distinct:
        found = found.where(F.col(value).isNotNull()).groupBy(*keys, "island", value).agg(F.min(one).alias("_x"))
    else:
        found = found.select(*keys, "island", one.alias("_x"))
    listed = F.transform(F.array_sort(F.collect_list("_x")), lambda x: x[value])
    return found.groupBy(*keys, "island").agg(F.array_join(listed, mark).alias(value))


def merge_masks(rows: DataFrame, keys: list[str], gap: float = 0.02) -> DataFrame:
    """Merged mask intervals with their distinct reasons in order, first known type, highest confidence."""
    found = write_work(islands(rows, keys, gap), "islands")
    whole = found.groupBy(*keys, "island").agg(
        F.min("start_sec").alias("start_sec"),
        F.max("end_sec").alias("end_sec"),
        F.min_by("entity_type", F.when(F.col("entity_type").isNotNull(), F.struct("start_sec", "end_sec", "entity_type"))).alias("entity_type"),
        F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"),
    )
    reasons = in_order(found, keys, "reason", ",", True)
    same = [whole[k].eqNullSafe(reasons[k]) for k in [*keys, "island"]]
    return whole.join(reasons, same, "left").select(*[whole[k] for k in keys], "start_sec", "end_sec", F.coalesce("reason", F.lit("")).alias("reason"), "entity_type", "confidence")


def merge_times(rows: DataFrame, keys: list[str], values: list[str], gap: float = 0.0, start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """Merged intervals of a key with the values of all of theirs in order, joined by `` | ``; a null value counts as empty."""
    found = islands(rows.withColumns({v: F.coalesce(v, F.lit("")) for v in values}), keys, gap, start, end)
    one = F.struct(start, end, *values)
    listed = F.array_sort(F.collect_list(one))
    texts = [F.array_join(F.transform(listed, lambda x: x[v]), " | ").alias(v) for v in values]
    return found.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), *texts).drop("island")


def resolve_spans(spans: DataFrame, keys: list[str], start: str = "start", end: str = "end", confidence: str = "confidence") -> DataFrame:
    """Spans (keys, start, end, confidence) of which no kept one was held against a surer one that it overlaps (``kernels.resolve``), island by island.

    Spans that touch but don't overlap, and those of two islands, can't clash. An empty span joins the island that it starts in.
    """
    kinds = dict(spans.dtypes)
    spans = write_work(spans.select(*keys, start, end, confidence), "spans")  # ranges are found, sorted and counted by reads of their own
    found = islands(spans, keys, -1e-9 if kinds[start] in ("double", "float") else -1, start, end)

    def chosen(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[int] = []
        s, e, c = (pdf[x].to_list() for x in (start, end, confidence))
        for first, at in _islands_of(pdf, keys, "island"):
            kept += [first] if len(at) == 1 else [k["row"] for k in resolve([{"row": i, "start": s[i], "end": e[i], "confidence": c[i]} for i in at])]
        return pdf.iloc[kept][[*keys, start, end, confidence]]

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, start, end, confidence])
    return _dealt(found, keys, "island", spans.count()).applyInPandas(chosen, schema)


#: Rows that a task has at a time, of as many islands as these are.
ISLAND_ROWS = 20_000


def _dealt(found: DataFrame, keys: list[str], island: str, rows: int):
    """Rows grouped so that an island stays together and many small ones share a task; null keys are apart, so that pandas keeps whole numbers beside them."""
    return found.groupBy(F.pmod(F.xxhash64(*keys, island), F.lit(max(1, rows // ISLAND_ROWS))), *[F.col(f"`{k}`").isNull() for k in keys])


def _islands_of(pdf: pd.DataFrame, keys: list[str], island: str):
    """(first row, rows) of each island, by place in the frame."""
    number = pdf.groupby([*keys, island], dropna=False, sort=False).ngroup().to_numpy()
    order = np.argsort(number, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(number[order])) + 1) if len(order) else []:
        yield at[0], at.tolist()


def chunks(rows: DataFrame, keys: list[str], limit: Column | None = None, gap: float = 0.8, target: float = 12.0, most: float = 30.0, least: float = 0.25, pause: float = 0.35, depth: int = 10) -> DataFrame:
    """(keys, start_sec, end_sec): activity cut into chunks at pauses (``alignment.chunk``), within [0, ``limit``] of the key.

    Activity whose gaps to the interval before are at most ``gap`` is a block; blocks are found by a scan and cut apart, so a long recording is spread. Empty intervals go.
    """
    kinds = dict(rows.dtypes)
    asked = rows.where(F.col("end_sec") > F.col("start_sec")).select(*keys, F.col("start_sec").cast("double").alias("start_sec"), F.col("end_sec").cast("double").alias("end_sec"), (F.lit(None) if limit is None else limit).cast("double").alias("_limit"))
    asked = write_work(asked, "activity")  # ranges are found, sorted and counted by reads of their own
    scans = Scans(asked, keys, [F.col("start_sec"), F.col("end_sec")]).before(F.col("end_sec"), "last", "_before")
    opens = F.when(F.col("_before").isNull() | (F.col("start_sec") - F.col("_before") > gap), 1).otherwise(0)
    found = scans.upto(opens, "sum", "_block").done("_block")

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start_sec", "end_sec"])
        place, starts, ends = [], [], []
        own, tops = list(zip(pdf["start_sec"].to_list(), pdf["end_sec"].to_list(), strict=True)), pdf["_limit"].to_list()
        for first, at in _islands_of(pdf, keys, "_block"):
            got = chunk([own[i] for i in at], target, most, least, pause, depth)
            top = tops[first]
            if not pd.isna(top):
                got = [(max(0.0, min(a, top)), max(0.0, min(b, top))) for a, b in got]
            got = [(a, b) for a, b in got if b - a >= least]
            place += [first] * len(got)
            starts += [a for a, _ in got]
            ends += [b for _, b in got]
        return pdf.iloc[place][keys].assign(start_sec=starts, end_sec=ends)

    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "start_sec double", "end_sec double"])
    return _dealt(found, keys, "_block", asked.count()).applyInPandas(cut, schema)


def clip(rows: DataFrame, limit: Column, start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """Intervals within [0, limit]; empty and inverted ones go first."""
    return rows.where(F.col(end) > F.col(start)).withColumns({start: F.greatest(F.lit(0.0), F.least(F.col(start), limit)), end: F.greatest(F.lit(0.0), F.least(F.col(end), limit))})


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(e1, e2) - F.greatest(s1, s2))


def overlap_seconds(rows: DataFrame, others: DataFrame, keys: list[str], id_: str = "segment_id") -> DataFrame:
    """(id, seconds): the sum of each row's overlaps with the others of its key, by a sweep over their ends instead of pairs.

    The sum of overlaps with [s, e) is the integral over it of how many others are open, which grows linearly between ends; so it is
    the difference of a running integral at e and at s.
    """
    mark = lambda at, step, who: F.struct(at.alias("at"), F.lit(step).alias("step"), who.alias("who"))
    none = F.lit(None).cast(dict(rows.dtypes)[id_])
    ends = others.where("end_sec > start_sec").select(*keys, F.explode(F.array(mark(F.col("start_sec"), 1, none), mark(F.col("end_sec"), -1, none))).alias("x"))
    asks = rows.select(*keys, F.explode(F.array(mark(F.col("start_sec"), 0, F.col(id_)), mark(F.greatest("start_sec", "end_sec"), 0, F.col(id_)))).alias("x"))
    line = ends.unionAll(asks).select(*keys, "x.*")
    # Between a mark and the one before it as many are open as the steps before say.
    scans = Scans(line, keys, [F.col("at"), F.col("step"), F.col("who")]).before(F.col("step"), "sum", "_open").before(F.col("at"), "max", "_earlier")
    area = F.coalesce("_open", F.lit(0)) * (F.col("at") - F.coalesce("_earlier", "at"))
    run = scans.upto(area, "sum", "_upto").done("_upto")
    return run.where(F.col("who").isNotNull()).groupBy(F.col("who").alias(id_)).agg((F.max("_upto") - F.min("_upto")).alias("seconds"))


def uniform_words(rows: DataFrame, text: str = "text", duration: str = "duration_sec") -> DataFrame:
    """Each word of a text with its characters [start_char, end_char) and an equal share of the time."""

    words = word_places(F.col(text))
    each = rows.withColumn("_w", words).withColumn("_n", F.size("_w"))
    # posexplode would ask for words that aren't empty before they are made: the function would run twice, in two workers a task.
    out = each.select(*rows.columns, "_n", F.posexplode_outer("_w").alias("word_index", "_x")).where(F.col("_x").isNotNull())
    step = F.col(duration) / F.col("_n")
    return out.withColumns(
        {"word": F.col("_x.word"), "start_char": F.col("_x.start_char"), "end_char": F.col("_x.start_char") + F.char_length("_x.word"), "word_start": F.col("word_index") * step, "word_end": (F.col("word_index") + 1) * step}
    ).drop("_x", "_n")


def spans_to_intervals(spans: DataFrame, words: DataFrame, before: float = 0.08, after: float = 0.12) -> DataFrame:
    """Padded time of each span (segment_id, span_start, span_end) from the words that it overlaps."""
    hit = spans.join(words, "segment_id").where((F.col("start_char") < F.col("span_end")) & (F.col("span_start") < F.col("end_char")))
    got = hit.groupBy("segment_id", "span_start", "span_end").agg(F.min("word_start").alias("s"), F.max("word_end").alias("e"), F.any_value("duration_sec").alias("d"))
    return got.select("segment_id", "span_start", "span_end", F.round(F.greatest(F.lit(0.0), F.col("s") - before), 6).alias("start_sec"), F.round(F.least(F.col("d"), F.col("e") + after), 6).alias("end_sec"))


def mask_plan(files: DataFrame, alignments: DataFrame) -> DataFrame:
    """Per file: completed or failed, and its intervals in file time; a file without intervals has an empty, completed plan.

    alignments: file_id, failed, segment_start, start_sec, end_sec (null without interval).
    """
    at = F.struct(F.round(F.col("segment_start") + F.col("start_sec"), 6).alias("start_sec"), F.round(F.col("segment_start") + F.col("end_sec"), 6).alias("end_sec"))
    by = alignments.groupBy("file_id").agg(F.bool_or("failed").alias("failed"), F.array_sort(F.collect_list(F.when(F.col("start_sec").isNotNull(), at))).alias("intervals"))
    done = files.join(by, "file_id", "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
    none = F.array().cast("array<struct<start_sec:double,end_sec:double>>")
    return done.select("file_id", F.when(F.col("failed"), "failed").otherwise("completed").alias("status"), F.when(F.col("failed"), none).otherwise(F.coalesce("intervals", none)).alias("intervals"))
