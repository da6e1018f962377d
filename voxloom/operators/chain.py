"""From transcripts to masked files: consensus, personal data, times, plans, redaction, each stage on the one before.

What can't be read is masked as a whole, what fails fails its file: no stage passes on what it couldn't judge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.operators import audio
from voxloom.operators import intervals as IV
from voxloom.operators import spans as SP
from voxloom.operators.consensus import consensus

INTERVAL = "array<struct<start_sec:double,end_sec:double,type:string,reason:string>>"


def transcripts(segments: DataFrame, results: DataFrame, min_models: int = 3) -> DataFrame:
    """Segments (segment_id, file_id, channel, start_sec, duration_sec) with method and text; without results the method is failed_no_transcripts."""
    final = consensus(results, min_models).select("segment_id", "method", F.col("final_transcript").alias("text"))
    rows = segments.select("segment_id", "file_id", "channel", "start_sec", "duration_sec").join(final, "segment_id", "left")
    return rows.withColumns({"method": F.coalesce("method", F.lit("failed_no_transcripts")), "text": F.coalesce("text", F.lit(""))})


def personal(texts: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """(segment_id, type, text, start, end) of the spans that are masked, in the final text: of all that is found in it and, with ``results``, in what each model heard."""
    finals = texts.select("segment_id", F.col("text").alias("final"))
    heard = results.select("segment_id", F.col("model_name").alias("source_name"), "transcript") if results is not None else None
    return SP.personal(finals, heard).select("segment_id", "type", "text", "start", "end").distinct()


def route(method: Column, text: Column, spans: Column, language: Column, error: Column, supported: tuple[str, ...] = ("en", "es")) -> Column:
    """How a segment gets its times: masked as a whole if it can't be read, nothing without spans, uniform words if the aligner doesn't know the language or failed, else aligned."""
    unreadable = method.startswith("failed") | ~C.has_text(text)
    known = F.coalesce(F.substring_index(F.lower(language), "-", 1).isin(*supported), F.lit(False))
    return F.when(unreadable, "mask_whole").when(spans == 0, "no_spans").when(~known, "uniform_language").when(error.isNotNull(), "uniform_error").otherwise("align")


def alignments(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Per segment its status and intervals, in the segment's time.

    A segment without a usable transcript is one interval; a span for which there is no word at all fails its segment.
    """
    unreadable = F.col("method").startswith("failed") | ~C.has_text(F.col("text"))
    words = IV.uniform_words(texts.select("segment_id", "text", "duration_sec"))
    each = SP.in_time(spans, words)
    at = F.struct("start_sec", "end_sec", "type", F.lit("pii").alias("reason"))
    by = each.groupBy("segment_id").agg(F.array_sort(F.collect_list(F.when(F.col("start_sec").isNotNull(), at))).alias("found"), F.count_if(F.col("start_sec").isNull()).alias("lost"))
    whole = F.array(F.struct(F.lit(0.0).alias("start_sec"), F.col("duration_sec").alias("end_sec"), F.lit("UNKNOWN").alias("type"), F.lit("no_usable_transcript").alias("reason"))).cast(INTERVAL)
    none = F.array().cast(INTERVAL)
    rows = texts.join(by, "segment_id", "left")
    failed = ~unreadable & (F.coalesce("lost", F.lit(0)) > 0)
    return rows.select(
        "segment_id",
        "file_id",
        "channel",
        "start_sec",
        F.when(failed, "failed").otherwise("completed").alias("status"),
        F.when(unreadable, whole).when(failed, none).otherwise(F.coalesce(F.col("found").cast(INTERVAL), none)).alias("intervals"),
    )


def plans(files: DataFrame, aligned: DataFrame) -> DataFrame:
    """(file_id, status, intervals of channel, start_sec, end_sec in the file's time) of every file; one failed segment fails the file."""
    shift = F.transform("intervals", lambda x: F.struct(F.col("channel").cast("int").alias("channel"), F.round(F.col("start_sec") + x["start_sec"], 6).alias("start_sec"), F.round(F.col("start_sec") + x["end_sec"], 6).alias("end_sec")))
    by = aligned.groupBy("file_id").agg(F.count_if(F.col("status") == "failed").alias("failed"), F.array_sort(F.flatten(F.collect_list(shift))).alias("all"))
    none = F.array().cast("array<struct<channel:int,start_sec:double,end_sec:double>>")
    bad = F.coalesce("failed", F.lit(0)) > 0
    return files.select("file_id").distinct().join(by, "file_id", "left").select("file_id", F.when(bad, "failed").otherwise("completed").alias("status"), F.when(bad, none).otherwise(F.coalesce("all", none)).alias("intervals"))


def plan_run(segments: DataFrame, results: DataFrame, files: DataFrame, min_models: int = 3, every_model: bool = True) -> DataFrame:
    texts = transcripts(segments, results, min_models)
    return plans(files, alignments(texts, personal(texts, results if every_model else None)))


def protect(segments: DataFrame, results: DataFrame, files: DataFrame, strategy: str = "beep", min_models: int = 3, every_model: bool = True) -> DataFrame:
    """(file_id, status, message, content) of files (file_id, content) with all that was found masked."""
    return audio.redact(files, plan_run(segments, results, files, min_models, every_model), strategy)
