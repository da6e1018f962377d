"""Text and scalar functions as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.functions import fixed as K
from voxloom.operators import filters as FT
from voxloom.plans.base import REPEAT, RES, SEG, model_results, query, read, results_ok, segments

R = F.round


@query("NRM-FULL")
def nrm_full(spark, d):
    return segments(spark, d).select("segment_id", C.normalise("text").alias("norm"))


@query("NRM-DOCS")
def nrm_docs(spark, d):
    return read(spark, d, "documents").select("doc_id", C.normalise("text").alias("norm"))


@query("NRM-TOKEN", f"WITH {SEG} SELECT segment_id, array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ') AS norm FROM seg")
def nrm_token(spark, d):
    return segments(spark, d).select("segment_id", C.plain(F.col("text")).alias("norm"))


@query(
    "NRM-FILLER",
    f"WITH {SEG} SELECT segment_id, array_to_string(list_filter(regexp_extract_all(lower(text || ' Um hmm'), '[a-z0-9]+'), lambda w: NOT list_contains({list(K.FILLERS)}, w)), ' ') AS norm FROM seg",
)
def nrm_filler(spark, d):
    return segments(spark, d).select("segment_id", F.array_join(C.without_fillers(C.tokens(F.concat("text", F.lit(" Um hmm")))), " ").alias("norm"))


def _contractions(x: str) -> str:
    for short, long in K.CONTRACTIONS.items():
        x = f"regexp_replace({x}, '\\b{short.replace(chr(39), chr(39) * 2)}\\b', '{long}', 'g')"
    return x


@query("NRM-CONTR", f"WITH {SEG} SELECT segment_id, {_contractions('''lower(text || ' i''m gonna')''')} AS norm FROM seg")
def nrm_contr(spark, d):
    return segments(spark, d).select("segment_id", C.expand_contractions(F.lower(F.concat("text", F.lit(" i'm gonna")))).alias("norm"))


@query("NRM-ARTIFACT", f"WITH {SEG} SELECT segment_id, regexp_replace(regexp_replace('User: ' || text || ' [noise] <|x|>', '{K.ECHO}', ' ', 'g'), '{K.ARTIFACT}', ' ', 'g') AS norm FROM seg")
def nrm_artifact(spark, d):
    return segments(spark, d).select("segment_id", C.clean_artifacts(F.concat(F.lit("User: "), "text", F.lit(" [noise] <|x|>"))).alias("norm"))


@query("TXT-REPEAT", rf"SELECT doc_id, round({REPEAT}, 6) AS repeat_ratio FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+') AS w FROM documents)")
def txt_repeat(spark, d):
    return read(spark, d, "documents").select("doc_id", R(C.repeat_ratio(F.col("text")), 6).alias("repeat_ratio"))


@query(
    "TXT-DEGEN",
    rf"""WITH {RES}, x AS (SELECT *, regexp_extract_all(transcript, '[^ \t\n\r\f\x0B]+') AS w FROM res WHERE transcript IS NOT NULL)
    SELECT segment_id, model_name, CASE WHEN length(transcript) >= 200 AND length(transcript) / duration_sec > 45 THEN 'impossible_speech_rate' WHEN len(w) >= 40 AND {REPEAT} > 0.7 THEN 'repetition_loop' END AS reason FROM x""",
)
def txt_degen(spark, d):
    from voxloom.operators.consensus import mark_loops

    return mark_loops(model_results(spark, d).where("transcript is not null")).select("segment_id", "model_name", F.col("degenerate").alias("reason"))


@query("TXT-LEV", f"WITH {RES} SELECT a.segment_id, b.model_name, levenshtein(a.norm, b.norm) AS dist FROM ok a JOIN ok b ON a.segment_id = b.segment_id WHERE a.rank = 0 AND b.rank > 0")
def txt_lev(spark, d):
    r = results_ok(spark, d)
    a = r.where("rank = 0").select("segment_id", F.col("norm").alias("a"))
    pairs = r.where("rank > 0").join(a, "segment_id")
    return pairs.select("segment_id", "model_name", C.distance(F.col("a"), F.col("norm")).cast("long").alias("dist"))


@query("TXT-CER", f"WITH {RES} SELECT a.segment_id, b.model_name, round(CASE WHEN length(a.norm) = 0 AND length(b.norm) = 0 THEN 0 WHEN length(a.norm) = 0 THEN 1 ELSE CAST(levenshtein(a.norm, b.norm) AS DOUBLE) / length(a.norm) END, 6) AS cer FROM ok a JOIN ok b ON a.segment_id = b.segment_id WHERE a.rank = 0 AND b.rank > 0")
def txt_cer(spark, d):
    r = results_ok(spark, d)
    pairs = r.where("rank > 0").join(r.where("rank = 0").select("segment_id", F.col("norm").alias("a")), "segment_id")
    return pairs.select("segment_id", "model_name", R(C.error_rate(C.distance(F.col("a"), F.col("norm")), F.char_length("a"), F.char_length("norm")), 6).alias("cer"))


@query("TXT-WER")
def txt_wer(spark, d):
    from voxloom.operators.consensus import pair_metrics

    return pair_metrics(results_ok(spark, d)).select("segment_id", "ref", "hyp", R("wer", 6).alias("wer"), R("cer", 6).alias("cer"), R("jaccard", 6).alias("jaccard"), R("sim", 6).alias("sim"))


@query("TXT-JACC", f"WITH {RES}, x AS (SELECT a.segment_id, b.model_name, list_distinct(string_split(a.norm, ' ')) AS u, list_distinct(string_split(b.norm, ' ')) AS v FROM ok a JOIN ok b ON a.segment_id = b.segment_id WHERE a.rank = 0 AND b.rank > 0) SELECT segment_id, model_name, round(CAST(len(list_intersect(u, v)) AS DOUBLE) / len(list_distinct(list_concat(u, v))), 6) AS jaccard FROM x")
def txt_jacc(spark, d):
    r = results_ok(spark, d)
    pairs = r.where("rank > 0").join(r.where("rank = 0").select("segment_id", F.col("norm").alias("a")), "segment_id")
    return pairs.select("segment_id", "model_name", R(C.jaccard(F.array_distinct(F.split("a", " ")), F.array_distinct(F.split("norm", " "))), 6).alias("jaccard"))


@query(
    "TXT-QC",
    r"""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+')) AS words, length(coalesce(text, '')) AS chars,
    len(regexp_extract_all(coalesce(text, ''), '[\x{4E00}-\x{9FFF}]')) AS cjk, round(CASE WHEN length(coalesce(text, '')) = 0 THEN 0 ELSE CAST(len(regexp_extract_all(text, '[^\x00-\x7F]')) AS DOUBLE) / length(text) END, 6) AS non_ascii FROM documents""",
)
def txt_qc(spark, d):
    t = F.coalesce("text", F.lit(""))
    n = F.char_length(t)
    return read(spark, d, "documents").select(
        "doc_id",
        F.size(C.split_words(t)).cast("long").alias("words"),
        n.cast("long").alias("chars"),
        F.regexp_count(t, F.lit(r"[\x{4E00}-\x{9FFF}]")).cast("long").alias("cjk"),
        R(F.when(n == 0, 0.0).otherwise(F.regexp_count(t, F.lit(r"[^\x00-\x7F]")) / n), 6).alias("non_ascii"),
    )


@query("TXT-TRIM", "SELECT doc_id, CASE WHEN length(text) <= 400 THEN text ELSE substr(text, 1, 200) || '[TRUNCATED]' || substr(text, length(text) - 199) END AS short FROM documents")
def txt_trim(spark, d):
    return read(spark, d, "documents").select("doc_id", F.when(F.char_length("text") <= 400, F.col("text")).otherwise(F.concat(F.substring("text", 1, 200), F.lit("[TRUNCATED]"), F.substring("text", -200, 200))).alias("short"))


@query("TXT-TRANSCRIPT", f"WITH {SEG} SELECT call_id, channel, string_agg('[' || printf('%.2f', start_sec) || '-' || printf('%.2f', end_sec) || '] ' || text, chr(10) ORDER BY start_sec, turn) AS transcript FROM seg GROUP BY call_id, channel")
def txt_transcript(spark, d):
    line = F.concat(F.lit("["), F.format_string("%.2f", "start_sec"), F.lit("-"), F.format_string("%.2f", "end_sec"), F.lit("] "), "text")
    rows = segments(spark, d).groupBy("call_id", "channel").agg(F.array_sort(F.collect_list(F.struct("start_sec", "turn", line.alias("line")))).alias("x"))
    return rows.select("call_id", "channel", F.array_join(F.transform("x", lambda x: x["line"]), "\n").alias("transcript"))


@query(
    "TXT-BUCKET",
    f"""WITH {RES}, p AS (SELECT a.norm AS a, b.norm AS b, list_distinct(string_split(a.norm, ' ')) AS u, list_distinct(string_split(b.norm, ' ')) AS v FROM ok a JOIN ok b ON a.segment_id = b.segment_id WHERE a.rank = 0 AND b.rank = 3),
    x AS (SELECT *, CAST(len(list_intersect(u, v)) AS DOUBLE) / len(list_distinct(list_concat(u, v))) AS j FROM p)
    SELECT CASE WHEN a = b THEN 'identical' WHEN a = '' OR b = '' THEN 'one_empty' WHEN j >= 0.8 THEN 'high' WHEN j >= 0.5 THEN 'middle' ELSE 'low' END AS bucket, count(*) AS n FROM x GROUP BY 1""",
)
def txt_bucket(spark, d):
    r = results_ok(spark, d)
    pairs = r.where("rank = 3").select("segment_id", F.col("norm").alias("b")).join(r.where("rank = 0").select("segment_id", F.col("norm").alias("a")), "segment_id")
    j = C.jaccard(F.array_distinct(F.split("a", " ")), F.array_distinct(F.split("b", " ")))
    name = F.when(F.col("a") == F.col("b"), "identical").when((F.col("a") == "") | (F.col("b") == ""), "one_empty").when(j >= 0.8, "high").when(j >= 0.5, "middle").otherwise("low")
    return pairs.groupBy(name.alias("bucket")).agg(F.count("*").alias("n"))


_ROLE = " ".join(f"WHEN {' OR '.join(f'contains(t, {chr(39)}{w}{chr(39)})' for w in words)} THEN '{r}'" for r, words in FT.ROLE_WORDS)
_STAGE = " ".join(f"WHEN contains(t, '{x}') THEN '{x}'" for x in FT.STAGES)


@query(
    "TXT-JSONX",
    f"""WITH {SEG}, x AS (SELECT *, turn % 5 AS which, upper(CASE WHEN turn % 5 = 2 THEN '{{broken}} the customer left a ' || CASE WHEN channel = 0 THEN 'voicemail ' ELSE '' END || text ELSE text END) AS t FROM seg),
    y AS (SELECT *, CASE {_ROLE} ELSE 'UNKNOWN' END AS r, CASE {_STAGE} ELSE 'UNKNOWN' END AS g FROM x),
    z AS (SELECT *, CASE WHEN which = 0 THEN 'json' WHEN which IN (1, 3) THEN 'keys' WHEN r <> 'UNKNOWN' OR g <> 'UNKNOWN' THEN 'keywords' END AS way FROM y)
    SELECT segment_id, way, CASE which WHEN 0 THEN CAST(channel AS VARCHAR) WHEN 1 THEN 'AGENT' WHEN 3 THEN 'UNKNOWN' ELSE CASE WHEN way IS NOT NULL THEN r END END AS speaker_role,
           CASE WHEN which = 1 THEN 'high' WHEN which <> 0 AND way IS NOT NULL THEN 'medium' END AS speaker_role_confidence,
           CASE which WHEN 0 THEN 'x{{y' WHEN 1 THEN 'UNKNOWN' WHEN 3 THEN 'FOLLOW_UP' ELSE CASE WHEN way IS NOT NULL THEN g END END AS call_stage,
           CASE WHEN which <> 0 AND way IS NOT NULL THEN 'medium' END AS call_stage_confidence FROM z""",
)
def txt_jsonx(spark, d):
    """Labels read from what a model may write of a turn: an object in a fence with a trailing comma, fields in words, a sentence, or nothing of use."""
    which = F.col("turn") % 5
    said = (
        F.when(which == 0, F.concat(F.lit('Sure:\n```json\n{"speaker_role": "'), F.col("channel").cast("string"), F.lit('", "call_stage": "x{y", "more": {"a": [1,]},}\n```')))
        .when(which == 1, F.concat(F.lit("speaker_role = 'agent', Speaker_Role_Confidence: HIGH; "), "text"))
        .when(which == 2, F.concat(F.lit("{broken} the customer left a "), F.when(F.col("channel") == 0, "voicemail ").otherwise(""), "text"))
        .when(which == 3, F.concat(F.lit("call_stage: follow_up "), "text"))
        .otherwise(F.col("text"))
    )
    return segments(spark, d).select("segment_id", FT.label_of(said).alias("l")).select("segment_id", "l.*")


@query("TXT-JSONTOL")
def txt_jsontol(spark, d):
    wrapped = F.concat(F.lit("Sure:\n```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n```"))
    return read(spark, d, "events").select("event_id", F.get_json_object(C.json_object(wrapped), "$.k").cast("long").alias("k"))


@query("SCL-HASH", "SELECT doc_id, sha1(coalesce(text, ''))[1:10] AS short_id, sha256(coalesce(text, ''))[1:24] AS file_id FROM documents")
def scl_hash(spark, d):
    t = F.coalesce("text", F.lit(""))
    return read(spark, d, "documents").select("doc_id", F.substring(F.sha1(t), 1, 10).alias("short_id"), F.substring(F.sha2(t, 256), 1, 24).alias("file_id"))


@query("SCL-AUDIO", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) / len(embedding)), 6) AS rms, round(CAST(len(list_filter(embedding, lambda x: abs(x) >= 0.25)) AS DOUBLE) / len(embedding), 6) AS clip_ratio FROM embeddings")
def scl_audio(spark, d):
    v = F.col("embedding").cast("array<double>")
    return read(spark, d, "embeddings").select("vec_id", R(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) / F.size(v)), 6).alias("rms"), R(F.size(F.filter(v, lambda x: F.abs(x) >= 0.25)) / F.size(v), 6).alias("clip_ratio"))


@query("SRC-SHARD", "SELECT conv_id, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(sha1(CAST(conv_id AS VARCHAR)), ''), lambda c: CAST(instr('0123456789abcdef', c) - 1 AS BIGINT))), lambda a, x: (a * 16 + x) % 7) AS INTEGER) AS shard FROM (SELECT DISTINCT conv_id FROM conversations)")
def src_shard(spark, d):
    return read(spark, d, "conversations").select("conv_id").distinct().select("conv_id", C.shard_of(F.col("conv_id").cast("string"), 7).alias("shard"))


@query("LNG-CODE", "SELECT doc_id, CASE WHEN lower(lang) LIKE 'es%' OR lower(lang) LIKE 'spanish%' THEN 'es' ELSE 'en' END AS code FROM documents")
def lng_code(spark, d):
    low = F.lower("lang")
    return read(spark, d, "documents").select("doc_id", F.when(low.startswith("es") | low.startswith("spanish"), "es").otherwise("en").alias("code"))
