"""Spans of personal data on their way from where they are found to when they are said.

A detector reads any transcript of a segment; its spans are dropped if they say nothing, placed in the final transcript, grown over the number
that they are part of, and kept once. Then words that have times give them theirs, numbers with room for what recognisers swallow. All but the detectors
are expressions of Spark; a segment's words travel as one array, which its length bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.functions import fixed as K

_TRIMMED, _DIGIT = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", r"\p{Nd}"


def digits(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_DIGIT))


def numeric(kind: Column, text: Column) -> Column:
    """Whether a span is a number by its type or its digits."""
    return F.upper(kind).isin(*K.NUMERIC_TYPES) | (digits(text) >= 4)


def placed(spans: DataFrame) -> DataFrame:
    """Spans (type, text, start, end) found in ``transcript``, in ``final``: as they are if both are the same text, else at the first place that has their text, in any case.

    A span without text, or whose text the final transcript doesn't have, goes.
    """
    same = F.col("transcript") == F.col("final")
    needle = F.lower(F.regexp_replace("text", _TRIMMED, ""))
    at = F.when(same, F.col("start")).when(needle != "", F.instr(F.lower("final"), needle).cast("int") - 1)
    moved = spans.withColumn("_at", at).where(F.col("_at") >= 0)
    end = F.when(same, F.col("end")).otherwise(F.col("_at") + F.char_length("text"))
    said = F.when(same, F.col("text")).otherwise(F.substr("final", F.col("_at") + 1, F.char_length("text")))
    return moved.withColumn("end", end).withColumn("text", said).withColumn("start", F.col("_at")).drop("_at")


def grown(spans: DataFrame) -> DataFrame:
    """Numeric spans of ``final`` grown over the digits and separators on both sides, less the separators at the ends.

    One that doesn't get to as many digits as before, and four, stays; one with seven of a numeric kind is a phone.
    """
    left = F.char_length(F.rtrim(F.substr("final", F.lit(1), F.greatest("start", F.lit(0))), F.lit(K.NUMBER_CHARS)))
    rest = F.substr("final", F.col("end") + 1, F.char_length("final"))
    right = F.least("end", F.char_length("final")) + F.char_length(rest) - F.char_length(F.ltrim(rest, F.lit(K.NUMBER_CHARS)))
    run = spans.withColumns({"_left": left, "_right": right}).withColumn("_run", F.substr("final", F.col("_left") + 1, F.col("_right") - F.col("_left")))
    lead = F.char_length("_run") - F.char_length(F.ltrim("_run", F.lit(K.NUMBER_EDGES)))
    run = run.withColumns({"_from": F.col("_left") + lead, "_grown": F.btrim("_run", F.lit(K.NUMBER_EDGES))})
    grows = numeric(F.col("type"), F.col("text")) & (digits(F.col("_grown")) >= F.greatest(F.lit(4), digits(F.col("text"))))
    phone = (digits(F.col("_grown")) >= 7) & F.upper("type").isin("NUMBER", "CARDINAL", "PHONE", "PHONE_NUMBER")
    out = run.withColumn("_grows", F.coalesce(grows, F.lit(False)))
    return out.withColumns(
        {
            "type": F.when(F.col("_grows") & phone, "PHONE").otherwise(F.col("type")),
            "text": F.when(F.col("_grows"), F.col("_grown")).otherwise(F.col("text")),
            "start": F.when(F.col("_grows"), F.col("_from")).otherwise(F.col("start")).cast("int"),
            "end": F.when(F.col("_grows"), F.col("_from") + F.char_length("_grown")).otherwise(F.col("end")).cast("int"),
        }
    ).drop("_left", "_right", "_run", "_from", "_grown", "_grows")


def told_apart(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Of spans of one place, type and transcript the surest."""
    by = [*keys, "start", "end", "type", "source_name"]
    rest = [c for c in spans.columns if c not in by]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce("confidence", F.lit(0.0)), *[c for c in rest if c != "confidence"]))
    return spans.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.*")


def personal(finals: DataFrame, heard: DataFrame | None = None, key: str = "segment_id") -> DataFrame:
    """(key, type, text, start, end, confidence, source, source_name) in the final transcripts, of all that detectors find in them and, if given, in ``heard``.

    finals: key, final. heard: key, source_name, transcript, of every model; null and empty transcripts have nothing.
    """
    rows = finals.select(key, "final", F.lit("final").alias("source_name"), F.col("final").alias("transcript"))
    if heard is not None:
        # A transcript that says what the final one does is told apart by its name alone: its spans are found once.
        rows = rows.unionByName(heard.where(F.coalesce("transcript", F.lit("")) != "").select(key, "source_name", "transcript").join(finals.select(key, "final"), key).select(key, "final", "source_name", "transcript"))
    found = rows.withColumn("s", F.explode(C.said_spans("transcript"))).select(key, "final", "source_name", "transcript", "s.*")
    kept = found.where(~F.upper("type").isin(*K.NOT_MASKED) & ~C.vague(F.col("type"), F.col("text")))
    return told_apart(grown(placed(kept)).select(key, "type", "text", "start", "end", "confidence", "source", "source_name"), [key])


def in_time(spans: DataFrame, words: DataFrame, before: float = 0.08, after: float = 0.12, key: str = "segment_id") -> DataFrame:
    """Adds start_sec and end_sec to spans (key, type, text, start, end) from words (key, start_char, end_char, word_start, word_end, duration_sec), padded.

    A span has the time of the words that it overlaps. A number starts earlier if its first characters have no word, but not before the word before it ends, and
    ends later if too few of its digits have words or they are too quick for it: by what so many digits take, or where the next word starts.
    A span with nothing to say goes; one that overlaps no word has the time of all words; without words it has none (null).
    """
    line = words.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("word_start", "start_char", "end_char", "word_end"))).alias("_words"), F.max("duration_sec").alias("_limit"))
    rows = spans.where(F.col("text").rlike(r"[\p{L}\p{N}]")).join(line, key, "left").withColumn("_words", F.coalesce("_words", F.array().cast("array<struct<word_start:double,start_char:int,end_char:int,word_end:double>>")))
    rows = rows.withColumn("_hit", F.filter("_words", lambda w: (w["end_char"] > F.col("start")) & (w["start_char"] < F.col("end"))))
    chars = F.transform(F.sequence(F.lit(1), F.char_length("text")), lambda i: F.struct((F.col("start") + i - 1).alias("at"), F.substr("text", i, F.lit(1)).alias("c")))
    figures, solid = F.filter(chars, lambda x: x["c"].rlike(_DIGIT)), F.filter(chars, lambda x: ~x["c"].rlike(r"^[\s\x1c-\x1f\x85\p{Z}]$"))
    high = numeric(F.col("type"), F.col("text"))
    rows = rows.withColumns({"_high": high, "_n": digits(F.col("text")), "_sig": F.when(high & (digits(F.col("text")) > 0), figures).otherwise(solid)})
    seen = F.filter("_sig", lambda x: F.exists("_hit", lambda w: (w["start_char"] <= x["at"]) & (x["at"] < w["end_char"])))
    rows = rows.withColumns({"_first": F.get("_hit", F.lit(0)), "_last": F.try_element_at("_hit", F.lit(-1)), "_covered": F.size(seen) / F.greatest(F.size("_sig"), F.lit(1))})
    short = lambda n: F.greatest(F.lit(0.25), n * 0.08)
    missing = F.greatest(F.lit(0), F.col("_first.start_char") - F.col("start"))
    earlier = F.try_element_at(F.filter("_words", lambda w: (w["end_char"] <= F.col("start")) & (w["word_end"] <= F.col("_first.word_start"))), F.lit(-1))
    begins = F.greatest(F.lit(0.0), F.col("_first.word_start") - short(F.least(missing, F.char_length("text"))))
    begins = F.when(~F.col("_high") | (F.col("_covered") >= 0.85) | (missing == 0), F.col("_first.word_start")).otherwise(F.greatest(begins, earlier["word_end"]))
    need = F.when(F.col("_n") >= 7, F.greatest(F.lit(2.4), F.col("_n") * 0.32)).when(F.col("_n") >= 4, F.greatest(F.lit(1.2), F.col("_n") * 0.28)).otherwise(short(F.char_length("text")))
    took = F.greatest(F.lit(0.0), F.col("_last.word_end") - F.col("_first.word_start"))
    enough = ~F.col("_high") | ((F.col("_covered") >= 0.85) & (took >= need * 0.65))
    following = F.get(F.filter("_words", lambda w: (w["start_char"] >= F.col("end")) & (w["word_start"] >= F.col("_last.word_end"))), F.lit(0))
    ends = F.when(enough, F.col("_last.word_end")).otherwise(F.greatest(F.col("_last.word_end"), F.col("_first.word_start") + need, following["word_start"]))
    lost = F.size("_hit") == 0
    begins = F.when(lost, F.array_min(F.transform("_words", lambda w: w["word_start"]))).otherwise(begins)
    ends = F.when(lost, F.array_max(F.transform("_words", lambda w: w["word_end"]))).otherwise(ends)
    timed = rows.withColumns({"start_sec": F.round(F.greatest(F.lit(0.0), begins - before), 6), "end_sec": F.round(F.least(F.col("_limit"), ends + after), 6)})
    # least() and greatest() pass over a null; a span without words has no time.
    empty = F.size("_words") == 0
    timed = timed.withColumns({c: F.when(~empty, F.col(c)) for c in ("start_sec", "end_sec")})
    return timed.select(*spans.columns, "start_sec", "end_sec")
