"""Intervals, personal data in transcripts, alignment, speakers, sources, sinks and streams as queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.functions import fixed as K
from voxloom.functions import kernels
from voxloom.functions.fixed import NOT_MASKED
from voxloom.operators import adapters, alignment
from voxloom.operators import consensus as CN
from voxloom.operators import intervals as IV
from voxloom.operators import spans as SN
from voxloom.operators import speakers as SP
from voxloom.plans.base import RES, SEG, SIDES, model_results, query, read, segments, sides
from voxloom.sources import calls as SRC
from voxloom.sources import sinks
from voxloom.sources.work import work_path
from voxloom.streaming import resume

R = F.round


def _activity(spark, d):
    """Intervals of a user: an hour's reach after each event, in seconds of the month."""
    at = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double") - 1704067200.0
    return read(spark, d, "events").select("user_id", "event_type", "value", "event_id", at.alias("start_sec"), (at + 600.0 * (1 + F.col("event_id") % 6)).alias("end_sec"))


ACT = """act AS (SELECT user_id, event_type, value, event_id, CAST(floor(epoch(ts)) AS DOUBLE) - 1704067200.0 AS start_sec, CAST(floor(epoch(ts)) AS DOUBLE) - 1704067200.0 + 600.0 * (1 + event_id % 6) AS end_sec FROM events)"""
ISL = """isl AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY start_sec, end_sec RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM (
  SELECT *, CASE WHEN r IS NULL OR start_sec - r > {gap} THEN 1 ELSE 0 END AS opens FROM (
    SELECT *, max(end_sec) OVER (PARTITION BY user_id ORDER BY start_sec, end_sec, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM act)))"""


@query("INT-MERGE", f"WITH {ACT}, {ISL.format(gap=60)} SELECT user_id, min(start_sec) AS start_sec, max(end_sec) AS end_sec, count(*) AS merged FROM isl GROUP BY user_id, island")
def int_merge(spark, d):
    return IV.merge(_activity(spark, d), ["user_id"], 60.0)


@query("WN-GAPS", f"WITH {ACT}, {ISL.format(gap=0)} SELECT user_id, count(DISTINCT island) AS islands FROM isl GROUP BY user_id")
def wn_gaps(spark, d):
    return IV.islands(_activity(spark, d), ["user_id"]).groupBy("user_id").agg(F.count_distinct("island").alias("islands"))


@query("INT-MASKMERGE")
def int_maskmerge(spark, d):
    rows = _activity(spark, d).select("user_id", "start_sec", "end_sec", F.col("event_type").alias("reason"), F.when(F.col("event_id") % 3 > 0, F.upper("event_type")).alias("entity_type"), F.col("value").alias("confidence"))
    return IV.merge_masks(rows, ["user_id"], 0.02)


@query("INT-TIMEMERGE", f"WITH {ACT}, {ISL.format(gap=0)} SELECT user_id, min(start_sec) AS start_sec, max(end_sec) AS end_sec, string_agg(CAST(event_id AS VARCHAR), ' | ' ORDER BY start_sec, end_sec, CAST(event_id AS VARCHAR), upper(event_type), event_type) AS texts, string_agg(upper(event_type), ' | ' ORDER BY start_sec, end_sec, CAST(event_id AS VARCHAR), upper(event_type), event_type) AS types, string_agg(event_type, ' | ' ORDER BY start_sec, end_sec, CAST(event_id AS VARCHAR), upper(event_type), event_type) AS sources FROM isl GROUP BY user_id, island")
def int_timemerge(spark, d):
    rows = _activity(spark, d).select("user_id", "start_sec", "end_sec", F.col("event_id").cast("string").alias("texts"), F.upper("event_type").alias("types"), F.col("event_type").alias("sources"))
    return IV.merge_times(rows, ["user_id"], ["texts", "types", "sources"])


@query("INT-CLIP", f"WITH {ACT} SELECT event_id, greatest(0, least(start_sec, 1000000)) AS start_sec, greatest(0, least(end_sec, 1000000)) AS end_sec FROM act WHERE end_sec > start_sec")
def int_clip(spark, d):
    return IV.clip(_activity(spark, d), F.lit(1000000.0)).select("event_id", "start_sec", "end_sec")


@query("INT-OVERLAP", f"WITH {SEG} SELECT a.segment_id, round(sum(greatest(0, least(a.end_sec, b.end_sec + 1) - greatest(a.start_sec, b.start_sec))), 6) AS seconds FROM seg a JOIN seg b ON a.call_id = b.call_id AND a.channel <> b.channel GROUP BY a.segment_id")
def int_overlap(spark, d):
    s = segments(spark, d)
    # With all of the call less with the channel's own: with the other channels.
    late = s.select("call_id", "channel", "start_sec", (F.col("end_sec") + 1).alias("end_sec"))
    call = IV.overlap_seconds(s, late, ["call_id"]).withColumnRenamed("seconds", "whole")
    own = IV.overlap_seconds(s, late, ["call_id", "channel"]).withColumnRenamed("seconds", "own")
    many = s.groupBy("call_id").agg(F.count_distinct("channel").alias("channels")).where("channels > 1")
    kept = s.join(many, "call_id", "left_semi").select("segment_id")
    return kept.join(call, "segment_id").join(own, "segment_id").select("segment_id", R(F.greatest(F.lit(0.0), F.col("whole") - F.col("own")), 6).alias("seconds"))


@query("JN-OVERSEC", f"WITH {SEG} SELECT segment_id, round(greatest(0, least(end_sec, 30) - greatest(start_sec, 10)), 6) AS seconds FROM seg")
def jn_oversec(spark, d):
    return segments(spark, d).select("segment_id", R(IV.overlap(F.col("start_sec"), F.col("end_sec"), F.lit(10.0), F.lit(30.0)), 6).alias("seconds"))


@query("INT-SHIFT", f"WITH {SEG} SELECT segment_id, round(start_sec + duration_sec / 4, 6) AS from_sec, round(start_sec + duration_sec / 2, 6) AS to_sec FROM seg")
def int_shift(spark, d):
    return segments(spark, d).select("segment_id", R(F.col("start_sec") + F.col("duration_sec") / 4, 6).alias("from_sec"), R(F.col("start_sec") + F.col("duration_sec") / 2, 6).alias("to_sec"))


@query("INT-SAMPLES", f"WITH {SEG} SELECT segment_id, CAST(round_even(start_sec * 16000, 0) AS BIGINT) AS start_sample FROM seg")
def int_samples(spark, d):
    return segments(spark, d).select("segment_id", F.bround(F.col("start_sec") * 16000).cast("long").alias("start_sample"))


@query("INT-NOVAD", f"WITH {SEG}, c AS (SELECT call_id, channel, max(end_sec) AS e, sum(CASE WHEN duration_sec > 8 THEN 1 ELSE 0 END) AS n FROM seg GROUP BY call_id, channel) SELECT call_id, channel, CASE WHEN n = 0 THEN CAST(0 AS DOUBLE) END AS start_sec, CASE WHEN n = 0 THEN e END AS end_sec FROM c")
def int_novad(spark, d):
    c = segments(spark, d).groupBy("call_id", "channel").agg(F.max("end_sec").alias("e"), F.count_if(F.col("duration_sec") > 8).alias("n"))
    return c.select("call_id", "channel", F.when(F.col("n") == 0, F.lit(0.0)).alias("start_sec"), F.when(F.col("n") == 0, F.col("e")).alias("end_sec"))


def _alignments(spark, d):
    s = segments(spark, d)
    return s.select(F.col("call_id").alias("file_id"), (F.col("turn") == 7).alias("failed"), F.col("start_sec").alias("segment_start"), F.when(F.col("channel") == 0, F.lit(0.25)).alias("start_sec"), F.when(F.col("channel") == 0, F.lit(0.75)).alias("end_sec"))


@query("INT-PLAN", f"WITH {SEG}, f AS (SELECT call_id AS file_id, bool_or(turn = 7) AS failed, count(*) FILTER (WHERE channel = 0) AS n, round(sum(CASE WHEN channel = 0 THEN round(start_sec + 0.75, 6) ELSE 0 END), 5) AS ends FROM seg GROUP BY call_id) SELECT file_id, CASE WHEN failed THEN 'failed' ELSE 'completed' END AS status, CASE WHEN failed THEN 0 ELSE n END AS n, CASE WHEN failed THEN 0 ELSE ends END AS ends FROM f")
def int_plan(spark, d):
    a = _alignments(spark, d)
    p = IV.mask_plan(a.select("file_id").distinct(), a)
    return p.select("file_id", "status", F.size("intervals").cast("long").alias("n"), R(F.aggregate("intervals", F.lit(0.0), lambda s, x: s + x["end_sec"]), 5).alias("ends"))


@query("INT-CHUNK")
def int_chunk(spark, d):
    """Documents as recordings: their sentences are activity, with pauses between that follow from their lengths."""
    each = read(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "[.]")).alias("at", "said"))
    each = each.withColumns({"took": F.char_length("said") / 15.0, "pause": 0.1 + (F.char_length("said") % 10) / 10.0})
    before = Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.round(F.coalesce(F.sum(F.col("took") + F.col("pause")).over(before), F.lit(0.0)), 6)
    said = each.withColumn("start_sec", start).withColumn("end_sec", F.round(F.col("start_sec") + F.col("took"), 6))
    return IV.chunks(said, ["doc_id"])


@query("INT-ENERGYVAD")
def int_energyvad(spark, d):
    @F.pandas_udf("array<struct<start_sec:double,end_sec:double>>")
    def active(v: pd.Series) -> pd.Series:
        return pd.Series([[{"start_sec": a, "end_sec": b} for a, b in alignment.energy_vad(np.asarray(x, dtype=float), 100, 0.04, 1.0)] for x in v], dtype=object)

    return read(spark, d, "embeddings").select("vec_id", active("embedding").alias("intervals"))


# Spans and personal data


def _spans(spark, d):
    return read(spark, d, "documents").select("doc_id", F.explode(C.detect("text")).alias("s")).select("doc_id", "s.*")


@query("PII-SEG")
def pii_seg(spark, d):
    return _spans(spark, d).groupBy("type", "source").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query("PII-REGEXALL")
def pii_regexall(spark, d):
    return read(spark, d, "documents").select("doc_id", F.explode(C.detect("text")).alias("s")).select("doc_id", "s.type", "s.start", "s.end", "s.confidence", "s.source")


def _found(kind: str, pattern: str):
    sql = f"SELECT doc_id, len(x) AS n, array_to_string(x, '|') AS found FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS x FROM documents) WHERE len(x) > 0"

    @query(f"PII-{kind}", sql)
    def run(spark, d):
        x = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(0))
        return read(spark, d, "documents").select("doc_id", x.alias("x")).where(F.size("x") > 0).select("doc_id", F.size("x").cast("long").alias("n"), F.array_join("x", "|").alias("found"))


_found("EMAIL", r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b")
_found("SSN", r"\b\d{3}-\d{2}-\d{4}\b")
_found("DOB", r"\b(?:\d{1,2}[/-]){2}\d{2,4}\b")
_found("ZIP", r"\b\d{5}(?:-\d{4})?\b")


@query("PII-PHONE")
def pii_phone(spark, d):
    """Phone numbers by their pattern, which looks at the characters around: RE2 can't."""
    pattern = next(p for kind, p, *_ in K.PATTERNS if kind == "PHONE")
    x = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(0))
    return read(spark, d, "documents").select("doc_id", x.alias("x")).where(F.size("x") > 0).select("doc_id", F.size("x").cast("long").alias("n"), F.array_join("x", "|").alias("found"))


@query("PII-ID")
def pii_id(spark, d):
    return _kind(spark, d, "ID", F.concat(F.lit("my member id is four four four two. "), "text"))


@query("PII-NAME")
def pii_name(spark, d):
    return _kind(spark, d, "PERSON_NAME", F.concat(F.lit("my name is John Smith. "), "text"))


def _kind(spark, d, kind, text):
    s = segments(spark, d).select("segment_id", F.explode(C.detect(text)).alias("s")).select("segment_id", "s.*")
    return s.where(F.col("type") == kind).select("segment_id", "start", "end", "text", "source")


@query("PII-SPOKEN")
def pii_spoken(spark, d):
    said = F.concat("text", F.lit(" call me at five five five one two three four five"))
    return segments(spark, d).select("segment_id", F.explode(C.spoken_numbers(said)).alias("s")).select("segment_id", "s.type", "s.start", "s.end")


def _timed(spark, d):
    """Dates and numbers of documents."""
    return read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("final"), F.explode(C.times_and_numbers("text")).alias("s")).select("doc_id", "final", "s.*")


@query("PII-TEMPORAL")
def pii_temporal(spark, d):
    return _timed(spark, d).select("doc_id", "type", "text", "start", "end", C.vague(F.col("type"), F.col("text")).alias("drop"))


@query("PII-LABELMAP", "SELECT event_id, CASE event_type WHEN 'click' THEN 'PERSON_NAME' WHEN 'view' THEN 'LOCATION' ELSE upper(event_type) END AS entity_type FROM events")
def pii_labelmap(spark, d):
    names = F.create_map(F.lit("click"), F.lit("PERSON_NAME"), F.lit("view"), F.lit("LOCATION"))
    return read(spark, d, "events").select("event_id", F.coalesce(names[F.col("event_type")], F.upper("event_type")).alias("entity_type"))


@query("FLT-MASKABLE", "SELECT event_id, upper(event_type) NOT IN ('MEDICAL_CONDITION', 'MEDICATION', 'LAB_RESULT') AS masked FROM events")
def flt_maskable(spark, d):
    return read(spark, d, "events").select("event_id", (~F.upper("event_type").isin(*NOT_MASKED)).alias("masked"))


@query("PII-BATCH")
def pii_batch(spark, d):
    """Spans of every model's transcript, placed in the final one by its text, the surest of equals kept."""
    final = CN.consensus(model_results(spark, d)).select("segment_id", "final_transcript")
    found = model_results(spark, d).where("transcript is not null").select("segment_id", F.explode(C.detect("transcript")).alias("s")).select("segment_id", "s.*")
    at = F.instr(F.lower("final_transcript"), F.lower("text"))
    placed = found.join(final, "segment_id").withColumn("at", at).where("at > 0").where(~F.upper("type").isin(*NOT_MASKED))
    return placed.groupBy("segment_id", (F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.char_length("text")).alias("end"), "type").agg(F.max("confidence").alias("confidence"))


@query("SPN-RESOLVE")
def spn_resolve(spark, d):
    """Spans of a key are chosen in islands that no span connects, so a key with many spans is spread."""
    e = _activity(spark, d).select("user_id", F.col("start_sec").cast("int").alias("start"), F.col("end_sec").cast("int").alias("end"), F.col("value").alias("confidence"))
    return IV.resolve_spans(e, ["user_id"]).groupBy("user_id").agg(F.count("*").alias("kept"), F.sum("start").alias("starts"))


@query("SPN-DEDUPE", "SELECT user_id, event_type, max(value) AS value FROM events GROUP BY user_id, event_type")
def spn_dedupe(spark, d):
    return read(spark, d, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("value"))


@query("SPN-MAP")
def spn_map(spark, d):
    """Spans that are found in what a model heard of a document, without its marks and in small letters, placed in the document."""
    docs = read(spark, d, "documents").where("text is not null").select("doc_id", F.col("text").alias("final"), F.lower(F.regexp_replace("text", "[,;:!?]", "")).alias("transcript"))
    found = docs.withColumn("s", F.explode(C.detect("transcript"))).select("doc_id", "final", "transcript", "s.*")
    return SN.placed(found).select("doc_id", "type", "text", "start", "end")


@query("SPN-EXPAND")
def spn_expand(spark, d):
    """Numbers of documents grown over the digits and separators around them."""
    return SN.grown(_timed(spark, d)).select("doc_id", "type", "text", "start", "end")


@query("SPN-LONG", "SELECT event_id, user_id, unnest([event_type, 'any']) AS entity FROM events")
def spn_long(spark, d):
    return read(spark, d, "events").select("event_id", "user_id", F.explode(F.array("event_type", F.lit("any"))).alias("entity"))


@query("SPN-WINDOW")
def spn_window(spark, d):
    @F.pandas_udf("array<struct<start:int,end:int>>")
    def parts(texts: pd.Series) -> pd.Series:
        def cut(t: str, size: int = 1200, back: int = 150) -> list[dict]:
            out, at = [], 0
            while at < len(t):
                end = min(len(t), at + size)
                if end < len(t) and (space := t.rfind(" ", at + size // 2, end)) > 0:
                    end = space
                out.append({"start": at, "end": end})
                at = end if end >= len(t) else max(end - back, at + 1)
            return out

        return pd.Series([cut(t or "") for t in texts], dtype=object)

    return read(spark, d, "documents").select("doc_id", F.explode(parts("text")).alias("w")).select("doc_id", "w.start", "w.end")


@query("TXT-TOKSPAN", f"WITH {SEG}, w AS (SELECT segment_id, unnest(string_split(text, ' ')) AS word FROM seg) SELECT segment_id, count(*) FILTER (WHERE word <> '') AS words, CAST(sum(length(word)) AS BIGINT) AS chars FROM w GROUP BY segment_id HAVING count(*) FILTER (WHERE word <> '') > 0")
def txt_tokspan(spark, d):
    w = IV.uniform_words(segments(spark, d))
    return w.groupBy("segment_id").agg(F.count("*").alias("words"), F.sum(F.col("end_char") - F.col("start_char")).alias("chars"))


# Alignment, masking, validation


@query("ALN-UNIFORM")
def aln_uniform(spark, d):
    return IV.uniform_words(segments(spark, d)).select("segment_id", "word_index", "word", "start_char", "end_char", R("word_start", 6).alias("start_sec"), R("word_end", 6).alias("end_sec"))


@query("ALN-SPANS")
def aln_spans(spark, d):
    s = segments(spark, d)
    spans = s.where(F.char_length("text") > 20).select("segment_id", F.lit(5).alias("span_start"), F.lit(17).alias("span_end"))
    return IV.spans_to_intervals(spans, IV.uniform_words(s))


@query("JN-INTERVAL")
def jn_interval(spark, d):
    s = segments(spark, d)
    w = IV.uniform_words(s).select("segment_id", "word", "start_char", "end_char")
    return w.join(s.select("segment_id", F.lit(5).alias("a"), F.lit(17).alias("b")), "segment_id").where("start_char < b and a < end_char").select("segment_id", "word")


@query("ALN-NUMERIC")
def aln_numeric(spark, d):
    """Times of the numbers and dates of documents, from words of equal length of which every fifth has got lost and others are clipped."""
    docs = read(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("segment_id"), "text", (F.char_length("text") / 15.0).alias("duration_sec"))
    spans = SN.grown(_timed(spark, d)).withColumnRenamed("doc_id", "segment_id").select("segment_id", "type", "text", "start", "end").distinct()
    words = IV.uniform_words(docs).where(F.col("word_index") % 5 != 3).withColumn("end_char", F.when(F.col("word_index") % 2 == 0, F.col("end_char")).otherwise(F.col("end_char") - F.floor(F.char_length("word") / 2)).cast("int"))
    return SN.in_time(spans, words)


@query("ALN-CTC")
def aln_ctc(spark, d):
    @F.pandas_udf("array<struct<first:int,behind:int,probability:double>>")
    def path(v: pd.Series) -> pd.Series:
        out = []
        for x in v:
            m = np.asarray(x, dtype=float)[:64].reshape(16, 4)
            lp = m - np.log(np.exp(m).sum(axis=1, keepdims=True))
            out.append([{"first": a, "behind": b, "probability": p} for a, b, p in alignment.ctc_align(lp, [1, 2, 3])])
        return pd.Series(out, dtype=object)

    return read(spark, d, "embeddings").select("vec_id", F.posexplode(path("embedding")).alias("token", "p")).select("vec_id", "token", "p.first", "p.behind", R("p.probability", 6).alias("probability"))



# Speakers


@query("SPK-NORM", f"WITH {SIDES} SELECT side_id, round(list_sum(list_transform(v, lambda x: x / (sqrt(list_dot_product(v, v)) + 1e-12))), 6) AS total FROM sides")
def spk_norm(spark, d):
    return sides(spark, d).select("side_id", R(F.aggregate(SP.normalised(F.col("v")), F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("SPK-WEIGHT", f"WITH {SEG} SELECT segment_id, round(sqrt(least(greatest(duration_sec, 0.5), 3)), 6) AS weight FROM seg")
def spk_weight(spark, d):
    return segments(spark, d).select("segment_id", R(F.sqrt(F.least(F.greatest(F.col("duration_sec"), F.lit(0.5)), F.lit(3.0))), 6).alias("weight"))


@query("SPK-WCENT", f"WITH {SIDES}, x AS (SELECT label, 0.5 + channel AS w, unnest(v) AS c, unnest(range(len(v))) AS i FROM sides) SELECT label, i AS dim, round(sum(w * c) / sum(w), 6) AS mean FROM x GROUP BY label, i")
def spk_wcent(spark, d):
    x = sides(spark, d).select("label", (0.5 + F.col("channel")).alias("w"), F.posexplode("v").alias("dim", "c"))
    return x.groupBy("label", F.col("dim").cast("long").alias("dim")).agg(R(F.sum(F.col("w") * F.col("c")) / F.sum("w"), 6).alias("mean"))


@query("SPK-ROBUST")
def spk_robust(spark, d):
    return SP.robust_centroids(sides(spark, d).select("label", "v"), ["label"]).select("label", R("mean_sim", 6).alias("mean_sim"), R("min_sim", 6).alias("min_sim"), "n_used", "n_segments")


_NEG = "neg AS (SELECT a.call_id, list_dot_product(a.v, b.v) / ((sqrt(list_dot_product(a.v, a.v)) + 1e-12) * (sqrt(list_dot_product(b.v, b.v)) + 1e-12)) AS sim FROM sides a JOIN sides b ON a.call_id = b.call_id AND a.channel < b.channel)"


@query("SPK-NEG", f"WITH {SIDES}, {_NEG} SELECT call_id, round(sim, 6) AS sim FROM neg")
def spk_neg(spark, d):
    return SP.opposite_similarities(sides(spark, d)).select("call_id", R("sim", 6).alias("sim"))


@query("SPK-CALIB", f"WITH {SIDES}, {_NEG}, q AS (SELECT count(*) AS n, CASE WHEN count(*) >= 100 THEN greatest(0.90, least(0.96, quantile_cont(sim, 0.999) + 0.035)) ELSE 0.92 END AS a FROM neg) SELECT n, round(a, 6) AS auto_threshold, round(greatest(0.92, a), 6) AS edge_threshold, round(greatest(0.90, greatest(0.92, a) - 0.015), 6) AS component_threshold FROM q")
def spk_calib(spark, d):
    return SP.calibrate(SP.opposite_similarities(sides(spark, d)))


_KNN = "knn AS (SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rank FROM (SELECT a.side_id AS a, b.side_id AS b, round(list_dot_product(a.v, b.v) / ((sqrt(list_dot_product(a.v, a.v)) + 1e-12) * (sqrt(list_dot_product(b.v, b.v)) + 1e-12)), 9) AS sim FROM sides a JOIN sides b ON a.side_id <> b.side_id)), top AS (SELECT * FROM knn WHERE rank <= 10)"


@query("SPK-KNN", f"WITH {SIDES}, {_KNN} SELECT a, b, round(sim, 6) AS sim FROM top")
def spk_knn(spark, d):
    return SP.neighbours(sides(spark, d), 10).select("a", "b", R("sim", 6).alias("sim"))


@query("SPK-EDGES", f"WITH {SIDES}, {_KNN} SELECT x.a, x.b, round(x.sim, 6) AS sim FROM top x JOIN top y ON x.a = y.b AND x.b = y.a WHERE x.a < x.b AND x.sim >= 0.35")
def spk_edges(spark, d):
    return SP.mutual_edges(SP.neighbours(sides(spark, d), 10), 0.35).select("a", "b", R("sim", 6).alias("sim"))


@query("SPK-CLUSTER")
def spk_cluster(spark, d):
    s = sides(spark, d)
    return SP.constrained_clusters(SP.mutual_edges(SP.neighbours(s, 10), 0.35), s, 0.30, compact=0.72)


@query("SPK-LABEL", "WITH c AS (SELECT label, count(*) AS size FROM embeddings GROUP BY label), n AS (SELECT *, row_number() OVER (ORDER BY size DESC, label) - 1 AS k FROM c) SELECT e.vec_id, 'spk_' || lpad(CAST(k AS VARCHAR), 6, '0') AS name FROM embeddings e JOIN n USING (label)")
def spk_label(spark, d):
    return SP.renumber(read(spark, d, "embeddings").select("vec_id", "label"), "label", "spk_").select("vec_id", "name")


@query("SPK-SIM2SIDE", f"WITH {SIDES}, {_NEG} SELECT call_id, CASE WHEN sim < 0.55 THEN 'low' WHEN sim >= 0.75 THEN 'high' ELSE 'medium' END AS confidence, sim < 0.55 AS outlier FROM neg")
def spk_sim2side(spark, d):
    x = SP.opposite_similarities(sides(spark, d))
    return x.select("call_id", F.when(F.col("sim") < 0.55, "low").when(F.col("sim") >= 0.75, "high").otherwise("medium").alias("confidence"), (F.col("sim") < 0.55).alias("outlier"))


@query("GRP-SPLIT")
def grp_split(spark, d):
    return read(spark, d, "embeddings").select("vec_id", SP.split_of(F.col("label")).alias("split"))


# Sources, sinks, streams, adapters


@query("SRC-PUSHDOWN", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_quantity > 45")
def src_pushdown(spark, d):
    return read(spark, d, "lineitem").where(F.col("l_returnflag").isin("A", "R") & (F.col("l_quantity") > 45)).select("l_orderkey", "l_quantity")


@query("SRC-ROWGROUP", "WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha1(CAST(doc_id AS VARCHAR)), doc_id) AS k FROM documents WHERE lang LIKE 'e%') SELECT doc_id, source FROM r WHERE k <= 5")
def src_rowgroup(spark, d):
    w = Window.partitionBy("source").orderBy(F.sha1(F.col("doc_id").cast("string")), "doc_id")
    return read(spark, d, "documents").where(F.col("lang").like("e%")).select("doc_id", "source", F.row_number().over(w).alias("k")).where("k <= 5").drop("k")


@query("SRC-DUP", "SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 24) AS duplicate_group_id, count(*) OVER (PARTITION BY sha256(coalesce(text, ''))) AS copies FROM documents")
def src_dup(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return docs.join(docs.groupBy("h").agg(F.count("*").alias("copies")), "h").select("doc_id", F.substring("h", 1, 24).alias("duplicate_group_id"), "copies")


@query("SRC-RECORD")
def src_record(spark, d):
    root = d if "://" in d else d.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/documents.parquet").select("path", "length", "modificationTime")
    return SRC.records(files, root, "path").select("relative_path", "call_id", "year", "file_id")


@query("SRC-METAKEY", "SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events")
def src_metakey(spark, d):
    return read(spark, d, "events").select("event_id", SRC.first_matching(SRC.flatten_json(F.col("props")), ("K",)).alias("value"))


@query("SNK-MANIFEST", f"WITH {RES}, n AS (SELECT segment_id, count(*) AS models FROM ok GROUP BY segment_id) SELECT CAST(call_id AS VARCHAR) AS call_id, CAST(models AS VARCHAR) AS models, segment_id FROM seg LEFT JOIN n USING (segment_id)")
def snk_manifest(spark, d):
    n = model_results(spark, d).where("error is null").where(C.has_text(F.col("transcript"))).groupBy("segment_id").agg(F.count("*").alias("models"))
    path = work_path(spark, "manifest")
    sinks.write_manifest(sinks.manifest(segments(spark, d).select("segment_id", "call_id"), n), path)
    return spark.read.schema("call_id string, models string, segment_id string").parquet(f"{path}/parquet")


@query("SNK-MERGE", "SELECT o_orderkey, o_orderstatus FROM orders")
def snk_merge(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sinks.merge_shards([o.where(F.col("o_orderkey") % 2 == i) for i in (0, 1)], "o_orderkey")


@query("STR-RESUME", "SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def str_resume(spark, d):
    """Events as a log that a stream applies, with a checkpoint in the shared folder."""
    events = read(spark, d, "events").select("user_id", "value", "ts", "event_id")
    log, target, checkpoint = (work_path(spark, n) for n in ("log", "state", "stream"))
    events.write.parquet(log)
    resume.take_new(spark, log, events.schema, target, checkpoint, ["user_id"], ["ts", "event_id"])
    return resume.current(spark, target).select("user_id", "value")


@query("STR-WINDOW", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def str_window(spark, d):
    return resume.windowed_counts(read(spark, d, "events")).select(F.col("w.start").alias("start"), "event_type", "n", R("total", 4).alias("total"))


@query("ADP-FIXTURE", f"WITH {SEG} SELECT segment_id, text AS transcript, CAST(0.9 AS DOUBLE) AS confidence FROM seg")
def adp_fixture(spark, d):
    return adapters.transcribe(segments(spark, d), adapters.Fixture).select("segment_id", "transcript", "confidence")
