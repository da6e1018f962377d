"""Relational steps over calls as queries: filters, joins, aggregates, windows, sets, state, audits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.functions.fixed import PANEL
from voxloom.operators import consensus as CN
from voxloom.operators import filters as FT
from voxloom.operators import context as CX
from voxloom.operators import state as ST
from voxloom.plans.base import HAS_TEXT, RES, SEG, model_results, query, read, results_ok, segments, FACTS, sound_facts

R = F.round

# Filters and projections


@query("FLT-OK", f"WITH {RES} SELECT segment_id, model_name, error IS NULL AND {HAS_TEXT} AS ok FROM res")
def flt_ok(spark, d):
    return model_results(spark, d).select("segment_id", "model_name", (F.col("error").isNull() & C.has_text(F.col("transcript"))).alias("ok"))


@query("FLT-LANG", "SELECT doc_id, CASE WHEN lower(lang) IN ('en', 'es') THEN 'pending' ELSE 'unsupported_language' END AS status FROM documents")
def flt_lang(spark, d):
    return read(spark, d, "documents").select("doc_id", F.when(F.lower("lang").isin("en", "es"), "pending").otherwise("unsupported_language").alias("status"))


@query("FLT-TRAIN", f"WITH {FACTS} SELECT vec_id, trainable FROM trained")
def flt_train(spark, d):
    return sound_facts(spark, d).select("vec_id", FT.trainable().alias("trainable"))


@query("FLT-CAND")
def flt_cand(spark, d):
    """Segments whose final text may teach, and whether it's surely right: by label, votes or likeness."""
    r = results_ok(spark, d)
    judged = CN.final_method(r).join(CN.soft_consensus(r).select("segment_id", "agreement_label", F.col("soft_text").alias("text")), "segment_id", "left")
    return FT.candidates(judged).select("segment_id", "candidate", "sure")


@query("FLT-COLSEL", "SELECT doc_id, coalesce(lang, source, 'none') AS label FROM documents")
def flt_colsel(spark, d):
    return read(spark, d, "documents").select("doc_id", F.coalesce("lang", "source", F.lit("none")).alias("label"))


@query("FLT-LENGTH", f"WITH {SEG} SELECT call_id, round(max(end_sec), 6) AS seconds FROM seg GROUP BY call_id HAVING max(end_sec) BETWEEN 10 AND 360")
def flt_length(spark, d):
    return segments(spark, d).groupBy("call_id").agg(R(F.max("end_sec"), 6).alias("seconds")).where(F.col("seconds").between(10, 360))


@query("PRJ-COERCE", "SELECT event_id, coalesce(TRY_CAST(event_type AS DOUBLE), 0) AS number, lower(event_type) IN ('true', '1', 'yes', 'click') AS flag FROM events")
def prj_coerce(spark, d):
    return read(spark, d, "events").select("event_id", F.coalesce(F.col("event_type").try_cast("double"), F.lit(0.0)).alias("number"), F.lower("event_type").isin("true", "1", "yes", "click").alias("flag"))


@query("PRJ-STRCLEAN", "SELECT doc_id, CASE WHEN lower(trim(lang)) IN ('', 'nan', '<na>', 'none') THEN NULL ELSE trim(lang) END AS lang FROM documents")
def prj_strclean(spark, d):
    return read(spark, d, "documents").select("doc_id", C.blank(F.col("lang")).alias("lang"))


# Joins


def _wide(m: str) -> str:
    return f"max(CASE WHEN model_name = '{m}' THEN coalesce(transcript, '') END) AS {m}"


@query("JN-MODELS", f"WITH {RES} SELECT segment_id, {', '.join(_wide(m) for m in PANEL)} FROM res GROUP BY segment_id")
def jn_models(spark, d):
    return model_results(spark, d).groupBy("segment_id").agg(*[F.coalesce(F.max(F.when(F.col("model_name") == m, F.col("transcript"))), F.lit("")).alias(m) for m in PANEL])


@query("JN-EXTRAS", f"WITH {RES}, n AS (SELECT segment_id, count(*) AS models FROM ok GROUP BY segment_id) SELECT seg.segment_id, seg.call_id, coalesce(n.models, 0) AS models, round(seg.duration_sec, 6) AS duration_sec FROM seg LEFT JOIN n ON seg.segment_id = n.segment_id")
def jn_extras(spark, d):
    n = results_ok(spark, d).groupBy("segment_id").agg(F.count("*").alias("models"))
    return segments(spark, d).join(n, "segment_id", "left").select("segment_id", "call_id", F.coalesce("models", F.lit(0)).alias("models"), R("duration_sec", 6).alias("duration_sec"))


@query(
    "JN-FILEMETA",
    f"WITH {SEG}, m AS (SELECT call_id, 8000 + 8000 * (call_id % 2) AS rate, count(DISTINCT channel) AS channels FROM seg GROUP BY call_id) SELECT s.segment_id, m.rate, m.channels, CASE WHEN s.call_id % 4 < 3 THEN 'redacted/' || s.call_id || '.wav' END AS redacted_path, CASE WHEN s.call_id % 4 = 3 THEN 'pending' WHEN s.call_id % 8 = 1 THEN 'failed' ELSE 'redacted' END AS redacted_status FROM seg s LEFT JOIN m ON m.call_id = s.call_id AND s.call_id % 5 < 4",
)
def jn_filemeta(spark, d):
    """Segments with what is known of their files and of what became of these; files that nobody looked into, and redactions that weren't, leave nulls and a status."""
    s = segments(spark, d)
    call = F.col("call_id")
    files = s.groupBy("call_id").agg(F.count_distinct("channel").alias("channels")).where(call % 5 < 4).select(call.alias("file_id"), (8000 + 8000 * (call % 2)).alias("rate"), "channels")
    done = s.select("call_id").distinct().where(call % 4 < 3).select(call.alias("file_id"), F.concat(F.lit("redacted/"), call.cast("string"), F.lit(".wav")).alias("redacted_path"), F.when(call % 8 == 1, "failed").otherwise("redacted").alias("redacted_status"))
    rows = s.select("segment_id", call.alias("file_id")).join(files, "file_id", "left").join(done, "file_id", "left")
    return rows.select("segment_id", "rate", "channels", "redacted_path", F.coalesce("redacted_status", F.lit("pending")).alias("redacted_status"))


@query("JN-SPEAKER", f"WITH {SEG}, m AS (SELECT CAST(vec_id // 2 AS VARCHAR) AS c, CAST(vec_id % 2 AS VARCHAR) AS h, 'spk_' || label AS s FROM embeddings) SELECT segment_id, coalesce(s, 'spk_fallback_' || call_id || '_ch' || channel) AS speaker FROM seg LEFT JOIN m ON CAST(call_id AS VARCHAR) = c AND CAST(channel AS VARCHAR) = h")
def jn_speaker(spark, d):
    m = read(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 2).cast("string").alias("c"), (F.col("vec_id") % 2).cast("string").alias("h"), F.concat(F.lit("spk_"), "label").alias("s"))
    s = segments(spark, d).withColumns({"c": F.col("call_id").cast("string"), "h": F.col("channel").cast("string")})
    return s.join(m, ["c", "h"], "left").select("segment_id", F.coalesce("s", F.concat(F.lit("spk_fallback_"), "c", F.lit("_ch"), "h")).alias("speaker"))


@query("JN-REPLACE", "WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY doc_id ORDER BY quality DESC, toxic) AS k FROM labels) SELECT d.doc_id, d.lang, coalesce(r.quality, -1) AS quality FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id AND r.k = 1")
def jn_replace(spark, d):
    first = read(spark, d, "labels").withColumn("_k", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("quality"), "toxic"))).where("_k = 1").select("doc_id", "quality")
    return read(spark, d, "documents").drop("quality").join(first, "doc_id", "left").select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("JN-INNERSIDES", f"WITH {SEG}, v AS (SELECT call_id, channel FROM seg GROUP BY call_id, channel HAVING count(*) >= 2) SELECT segment_id FROM seg JOIN v USING (call_id, channel)")
def jn_innersides(spark, d):
    s = segments(spark, d)
    return s.join(s.groupBy("call_id", "channel").count().where("count >= 2"), ["call_id", "channel"], "left_semi").select("segment_id")


@query("JN-SELFPAIR", f"WITH {SEG} SELECT a.segment_id AS a, b.segment_id AS b FROM seg a JOIN seg b ON a.call_id = b.call_id AND a.turn < b.turn AND a.channel <> b.channel")
def jn_selfpair(spark, d):
    s = segments(spark, d).select("call_id", "turn", "channel", "segment_id")
    a, b = s.alias("a"), s.alias("b")
    return a.join(b, (F.col("a.call_id") == F.col("b.call_id")) & (F.col("a.turn") < F.col("b.turn")) & (F.col("a.channel") != F.col("b.channel"))).select(F.col("a.segment_id").alias("a"), F.col("b.segment_id").alias("b"))


@query("JN-SELFMODEL", f"WITH {RES} SELECT a.segment_id, a.model_name AS ref, b.model_name AS hyp, a.norm = b.norm AS same FROM ok a JOIN ok b ON a.segment_id = b.segment_id AND a.rank < b.rank")
def jn_selfmodel(spark, d):
    r = results_ok(spark, d).select("segment_id", "rank", "model_name", "norm")
    a, b = r.alias("a"), r.alias("b")
    return a.join(b, (F.col("a.segment_id") == F.col("b.segment_id")) & (F.col("a.rank") < F.col("b.rank"))).select("a.segment_id", F.col("a.model_name").alias("ref"), F.col("b.model_name").alias("hyp"), (F.col("a.norm") == F.col("b.norm")).alias("same"))


@query(
    "JN-OTHERCH",
    f"""WITH {SEG}, t AS (SELECT call_id, channel, regexp_replace(string_agg(text, chr(10) ORDER BY turn), '^[ \\t-\\r]+|[ \\t-\\r]+$', '', 'g') AS txt FROM seg GROUP BY call_id, channel),
    o AS (SELECT call_id, channel, 'Other channel ' || channel || ':' || chr(10) || CASE WHEN length(txt) > 2500 THEN substr(txt, 1, 2500) || chr(10) || '[TRUNCATED]' ELSE txt END AS part FROM t WHERE txt <> '')
    SELECT a.call_id, a.channel, coalesce(string_agg(o.part, chr(10) || chr(10) ORDER BY o.channel), '') AS context FROM t a LEFT JOIN o ON a.call_id = o.call_id AND a.channel <> o.channel GROUP BY a.call_id, a.channel""",
)
def jn_otherch(spark, d):
    return CX.other_channels(segments(spark, d))


@query("JN-PAIRBOTH", f"WITH {RES} SELECT a.segment_id FROM ok a JOIN ok b ON a.segment_id = b.segment_id WHERE a.model_name = 'parakeet' AND b.model_name = 'granite'")
def jn_pairboth(spark, d):
    r = results_ok(spark, d)
    return r.where("model_name = 'parakeet'").select("segment_id").join(r.where("model_name = 'granite'").select("segment_id"), "segment_id")


@query("JN-SEMI", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def jn_semi(spark, d):
    return read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels").where("toxic = 1"), "doc_id", "left_semi")


@query("JN-ANTI", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def jn_anti(spark, d):
    return read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left_anti")


@query("JN-REPLAY", f"WITH {RES}, o AS (SELECT call_id, split_part(segment_id, '_', 2) || '_' || split_part(segment_id, '_', 3) AS k, norm FROM ok WHERE rank = 0), n AS (SELECT call_id, split_part(segment_id, '_', 2) || '_' || split_part(segment_id, '_', 3) AS k, norm FROM ok WHERE rank = 3) SELECT o.call_id, o.k, o.norm = n.norm AS same FROM o JOIN n ON o.call_id = n.call_id AND o.k = n.k")
def jn_replay(spark, d):
    key = F.concat_ws("_", F.split_part("segment_id", F.lit("_"), F.lit(2)), F.split_part("segment_id", F.lit("_"), F.lit(3)))
    r = results_ok(spark, d).withColumn("k", key)
    return r.where("rank = 0").select("call_id", "k", F.col("norm").alias("o")).join(r.where("rank = 3").select("call_id", "k", F.col("norm").alias("n")), ["call_id", "k"]).select("call_id", "k", (F.col("o") == F.col("n")).alias("same"))


# Aggregates


@query("AG-HOURS", f"WITH {SEG}, x AS (SELECT CASE WHEN turn % 4 = 3 THEN NULL ELSE 'label_' || channel END AS label, duration_sec, turn % 2 = 0 AS accepted FROM seg) SELECT label, count(*) AS segments, count(*) FILTER (WHERE accepted) AS accepted, round(sum(duration_sec) / 3600, 6) AS hours, round(sum(CASE WHEN accepted THEN duration_sec ELSE 0 END) / 3600, 6) AS accepted_hours, round(sum(CASE WHEN accepted THEN 0 ELSE duration_sec END) / 3600, 6) AS rejected_hours FROM x GROUP BY label")
def ag_hours(spark, d):
    x = segments(spark, d).select(F.when(F.col("turn") % 4 != 3, F.concat(F.lit("label_"), "channel")).alias("label"), "duration_sec", (F.col("turn") % 2 == 0).alias("ok"))
    h = lambda c: R(F.sum(c) / 3600, 6)
    return x.groupBy("label").agg(F.count("*").alias("segments"), F.count_if("ok").alias("accepted"), h(F.col("duration_sec")).alias("hours"), h(F.when(F.col("ok"), F.col("duration_sec")).otherwise(0)).alias("accepted_hours"), h(F.when(F.col("ok"), 0).otherwise(F.col("duration_sec"))).alias("rejected_hours"))


@query("AG-TRAINHOURS", f"WITH {SEG} SELECT channel, count(*) AS segments, round(sum(duration_sec) / 3600, 6) AS hours FROM seg WHERE turn % 2 = 0 GROUP BY channel")
def ag_trainhours(spark, d):
    return segments(spark, d).where("turn % 2 = 0").groupBy("channel").agg(F.count("*").alias("segments"), R(F.sum("duration_sec") / 3600, 6).alias("hours"))


_AGREE = """, n AS (SELECT segment_id, norm, count(*) AS c FROM ok GROUP BY segment_id, norm), a AS (SELECT segment_id, sum(c) AS p, max(c) AS g FROM n GROUP BY segment_id),
agree AS (SELECT s.segment_id, CAST(coalesce(p, 0) AS BIGINT) AS models_present, CAST(coalesce(g, 0) AS BIGINT) AS models_agreeing,
CASE WHEN coalesce(p, 0) < 5 THEN 'incomplete_' || CAST(coalesce(p, 0) AS INTEGER) || '_models' WHEN g = 4 THEN 'all_4_agree' WHEN g = 3 THEN 'three_agree' WHEN g = 2 THEN 'two_agree' ELSE 'all_different' END AS model_agreement FROM seg s LEFT JOIN a USING (segment_id))"""


@query("CNS-AGREE", f"WITH {RES}{_AGREE} SELECT * FROM agree")
def cns_agree(spark, d):
    return CN.agreement(model_results(spark, d))


@query("AG-AGREE", f"WITH {RES}{_AGREE} SELECT model_agreement, models_present, count(*) AS n FROM agree GROUP BY ALL")
def ag_agree(spark, d):
    return CN.agreement(model_results(spark, d)).groupBy("model_agreement", "models_present").agg(F.count("*").alias("n"))


@query("AG-VOTE", f"WITH {RES}, n AS (SELECT segment_id, norm, count(*) AS n, min(rank) AS f FROM ok GROUP BY segment_id, norm), r AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, f) AS k FROM n) SELECT segment_id, norm AS winner, n AS votes FROM r WHERE k = 1")
def ag_vote(spark, d):
    n = results_ok(spark, d).groupBy("segment_id", "norm").agg(F.count("*").alias("n"), F.min("rank").alias("f"))
    return n.groupBy("segment_id").agg(F.max_by(F.struct("norm", "n"), F.struct("n", F.negative("f"))).alias("t")).select("segment_id", F.col("t.norm").alias("winner"), F.col("t.n").alias("votes"))


@query("AG-SIDE", f"WITH {SEG} SELECT call_id, channel, count(*) AS segments, arg_min(segment_id, turn) AS first_segment, round(sum(duration_sec), 6) AS seconds, count(*) FILTER (WHERE duration_sec > 5) AS long_segments FROM seg GROUP BY call_id, channel")
def ag_side(spark, d):
    return segments(spark, d).groupBy("call_id", "channel").agg(F.count("*").alias("segments"), F.min_by("segment_id", "turn").alias("first_segment"), R(F.sum("duration_sec"), 6).alias("seconds"), F.count_if(F.col("duration_sec") > 5).alias("long_segments"))


@query("AG-SIDESTATS", f"WITH {SEG} SELECT call_id, channel, count(*) AS total_segments, round(sum(greatest(duration_sec - 0.2, 0)), 6) AS usable, round(sum(duration_sec), 6) AS duration FROM seg GROUP BY call_id, channel")
def ag_sidestats(spark, d):
    return segments(spark, d).groupBy("call_id", "channel").agg(F.count("*").alias("total_segments"), R(F.sum(F.greatest(F.col("duration_sec") - 0.2, F.lit(0))), 6).alias("usable"), R(F.sum("duration_sec"), 6).alias("duration"))


@query("AG-CLUSTERSZ", "SELECT label, count(*) AS call_sides, count(DISTINCT vec_id // 2) AS calls FROM embeddings GROUP BY label")
def ag_clustersz(spark, d):
    return read(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("call_sides"), F.count_distinct(F.floor(F.col("vec_id") / 2)).alias("calls"))


@query("AG-DISTINCT", f"WITH {SEG} SELECT count(DISTINCT call_id) AS calls, count(DISTINCT (call_id, channel)) AS sides FROM seg")
def ag_distinct(spark, d):
    return segments(spark, d).agg(F.count_distinct("call_id").alias("calls"), F.count_distinct(F.struct("call_id", "channel")).alias("sides"))


@query("AG-LANGVOTE", "WITH v AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang), r AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY source) AS share, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS k FROM v) SELECT source, lang, round(share, 6) AS share FROM r WHERE k = 1")
def ag_langvote(spark, d):
    v = read(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    by = Window.partitionBy("source")
    return v.select("source", "lang", R(F.col("n") / F.sum("n").over(by), 6).alias("share"), F.row_number().over(by.orderBy(F.desc("n"), "lang")).alias("k")).where("k = 1").drop("k")


# Windows, order, batches


@query("WN-TOPK", f"WITH {SEG}, r AS (SELECT *, row_number() OVER (PARTITION BY call_id, channel ORDER BY duration_sec DESC, turn) AS k FROM seg) SELECT segment_id, k FROM r WHERE k <= 2")
def wn_topk(spark, d):
    w = Window.partitionBy("call_id", "channel").orderBy(F.desc("duration_sec"), "turn")
    return segments(spark, d).withColumn("k", F.row_number().over(w)).where("k <= 2").select("segment_id", "k")


@query("WN-MINCNT", f"WITH {SEG}, c AS (SELECT *, count(*) OVER (PARTITION BY call_id, channel) AS n FROM seg) SELECT segment_id, n FROM c WHERE n >= 3")
def wn_mincnt(spark, d):
    return segments(spark, d).withColumn("n", F.count("*").over(Window.partitionBy("call_id", "channel"))).where("n >= 3").select("segment_id", "n")


@query("WN-REPEATCNT", "SELECT doc_id, count(*) OVER (PARTITION BY text) AS n, length(text) >= 12 AND count(*) OVER (PARTITION BY text) >= 3 AS suspicious FROM documents")
def wn_repeatcnt(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text", F.xxhash64("text").alias("h"))
    n = docs.groupBy("h", "text").agg(F.count("*").alias("n"))
    return docs.join(n, ["h", "text"]).select("doc_id", "n", ((F.char_length("text") >= 12) & (F.col("n") >= 3)).alias("suspicious"))


@query("WN-DEDUPE", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def wn_dedupe(spark, d):
    return ST.latest(read(spark, d, "events"), ["user_id"], ["event_id"]).select("user_id", "event_id")


@query("WN-ROWID", f"WITH {SEG} SELECT segment_id, 'seg_' || lpad(CAST(row_number() OVER (PARTITION BY call_id, channel ORDER BY turn) - 1 AS VARCHAR), 5, '0') AS row_id FROM seg")
def wn_rowid(spark, d):
    n = F.row_number().over(Window.partitionBy("call_id", "channel").orderBy("turn")) - 1
    return segments(spark, d).select("segment_id", F.concat(F.lit("seg_"), F.lpad(n.cast("string"), 5, "0")).alias("row_id"))


@query("WN-SHARE", f"WITH {SEG}, c AS (SELECT call_id, channel, count(*) AS n FROM seg GROUP BY call_id, channel) SELECT call_id, channel, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY call_id), 6) AS share FROM c")
def wn_share(spark, d):
    c = segments(spark, d).groupBy("call_id", "channel").agg(F.count("*").alias("n"))
    return c.select("call_id", "channel", R(F.col("n") / F.sum("n").over(Window.partitionBy("call_id")), 6).alias("share"))


@query("SO-REVIEW", f"WITH {SEG} SELECT call_id, n, seconds FROM (SELECT call_id, count(*) AS n, round(sum(duration_sec), 6) AS seconds FROM seg GROUP BY call_id) ORDER BY n DESC, seconds DESC, call_id LIMIT 30")
def so_review(spark, d):
    c = segments(spark, d).groupBy("call_id").agg(F.count("*").alias("n"), R(F.sum("duration_sec"), 6).alias("seconds"))
    return c.orderBy(F.desc("n"), F.desc("seconds"), "call_id").limit(30)


@query("SO-SAMPLE", "SELECT doc_id FROM documents ORDER BY sha1(CAST(doc_id AS VARCHAR) || '42'), doc_id LIMIT 50")
def so_sample(spark, d):
    return read(spark, d, "documents").select("doc_id").orderBy(F.sha1(F.concat(F.col("doc_id").cast("string"), F.lit("42"))), "doc_id").limit(50)


#: A loop over rows in SQL: ``line`` has i from 1, and ``key``, and ``size``; a batch closes before a row for which ``closes`` holds.
LOOP = """line AS MATERIALIZED ({line}), loop AS (
  SELECT i, {key}, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS held, CAST(size AS DOUBLE) AS total FROM line WHERE i = 1
  UNION ALL
  SELECT n.i, n.{key}, l.batch + CASE WHEN {closes} THEN 1 ELSE 0 END, CASE WHEN {closes} THEN 1 ELSE l.held + 1 END, CASE WHEN {closes} THEN n.size ELSE l.total + n.size END
  FROM loop l JOIN line n ON n.i = l.i + 1
)"""
_CALLS = "SELECT row_number() OVER (ORDER BY seen, call_id) AS i, call_id, CAST(n AS DOUBLE) AS size FROM (SELECT call_id, count(*) AS n, min((start_sec, segment_id)) AS seen FROM seg GROUP BY call_id)"
_SHORTEST = "SELECT row_number() OVER (ORDER BY {size}, segment_id) AS i, segment_id, CAST({size} AS DOUBLE) AS size FROM seg"


@query("SO-CHUNK", f"WITH RECURSIVE {SEG}, {LOOP.format(line=_CALLS, key='call_id', closes='l.total >= 50')} SELECT call_id, batch AS chunk FROM loop")
def so_chunk(spark, d):
    return ST.chunks(segments(spark, d), "call_id", 50, ["start_sec", "segment_id"])


@query("SO-BATCH", f"WITH RECURSIVE {SEG}, {LOOP.format(line=_SHORTEST.format(size='duration_sec'), key='segment_id', closes='(l.held >= 8 OR l.total + n.size > 240)')} SELECT segment_id, batch FROM loop")
def so_batch(spark, d):
    return ST.batches(segments(spark, d), "duration_sec", "segment_id", 8, 240.0)


@query("SO-CHARBATCH", f"WITH RECURSIVE {SEG}, {LOOP.format(line=_SHORTEST.format(size='length(text)'), key='segment_id', closes='(l.held >= 16 OR (l.held + 1) * n.size > 24000)')} SELECT segment_id, batch FROM loop")
def so_charbatch(spark, d):
    """All texts by length, until 16 of them or until their number times the longest passes 24,000 characters."""
    s = segments(spark, d).select("segment_id", F.char_length("text").cast("double").alias("n"))
    return ST.batches(s, "n", "segment_id", 16, 24_000, "padded")


@query("SO-RR", f"WITH {SEG} SELECT segment_id, (row_number() OVER (PARTITION BY call_id ORDER BY turn) - 1) % 4 AS worker FROM seg")
def so_rr(spark, d):
    n = F.row_number().over(Window.partitionBy("call_id").orderBy("turn")) - 1
    return segments(spark, d).select("segment_id", F.pmod(n, F.lit(4)).cast("long").alias("worker"))


# Sets


@query("SET-UNIONCOLS", "SELECT doc_id, lang, NULL AS quality FROM documents UNION ALL SELECT doc_id, NULL, CAST(quality AS VARCHAR) FROM labels")
def set_unioncols(spark, d):
    return read(spark, d, "documents").select("doc_id", "lang").unionByName(read(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("quality")), allowMissingColumns=True)


@query("SET-EXCEPT", "SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def set_except(spark, d):
    return read(spark, d, "orders").select(F.col("o_custkey").alias("k")).exceptAll(read(spark, d, "customer").where("c_acctbal > 0").select("c_custkey"))


@query("SET-INTERSECT", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def set_intersect(spark, d):
    return read(spark, d, "documents").select("doc_id").intersect(read(spark, d, "labels").select("doc_id"))


# State


@query("ST-UPSERT", "SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, max(ts) AS updated_at FROM events GROUP BY user_id, event_type")
def st_upsert(spark, d):
    return ST.latest(read(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "value", F.col("ts").alias("updated_at"))


@query("ST-ANTI", f"WITH {RES} SELECT DISTINCT segment_id, model_name FROM res WHERE error IS NOT NULL")
def st_anti(spark, d):
    r = model_results(spark, d)
    return ST.pending(r.select("segment_id", "model_name"), r.where("error is null"), ["segment_id", "model_name"])


@query("ST-RETRY", f"WITH {RES} SELECT segment_id, model_name, 'failed' AS status FROM res WHERE error IS NOT NULL")
def st_retry(spark, d):
    r = model_results(spark, d).withColumn("status", F.when(F.col("error").isNull(), "transcribed").otherwise("failed"))
    return r.join(r.where("status = 'transcribed'").select("segment_id", "model_name"), ["segment_id", "model_name"], "left_anti").select("segment_id", "model_name", "status")


@query("ST-FAIL", f"WITH {RES} SELECT segment_id || ':' || model_name AS failure_id FROM res WHERE error IS NOT NULL AND segment_id NOT IN (SELECT segment_id FROM ok WHERE model_name = 'whisper')")
def st_fail(spark, d):
    r = model_results(spark, d)
    return r.where("error is not null").join(r.where("model_name = 'whisper' and error is null").where(C.has_text(F.col("transcript"))).select("segment_id"), "segment_id", "left_anti").select(F.concat_ws(":", "segment_id", "model_name").alias("failure_id"))


@query("ST-COUNT", "SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'pages', count(*) FROM pages")
def st_count(spark, d):
    out = None
    for name in ("documents", "labels", "pages"):
        one = read(spark, d, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@query("ST-STATUS", "SELECT user_id % 8 AS shard, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) AS n FROM events GROUP BY 1")
def st_status(spark, d):
    return read(spark, d, "events").groupBy((F.col("user_id") % 8).alias("shard")).agg(F.count_if(F.col("event_type") == "click").alias("clicks"), F.count_if(F.col("event_type") == "view").alias("views"), F.count("*").alias("n"))


@query("ST-BYSTATUS", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def st_bystatus(spark, d):
    return read(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("ST-JOINSQL", f"WITH {RES} SELECT r.segment_id, s.channel, r.transcript FROM res r JOIN seg s ON r.segment_id = s.segment_id WHERE model_name = 'whisper'")
def st_joinsql(spark, d):
    return model_results(spark, d).where("model_name = 'whisper'").join(segments(spark, d).select("segment_id", "channel"), "segment_id").select("segment_id", "channel", "transcript")


# Consensus


@query("CNS-EXACT", f"WITH {RES}, n AS (SELECT segment_id, norm, count(*) AS n, min(rank) AS f FROM ok GROUP BY segment_id, norm) SELECT segment_id, max(n) >= 3 AS strong, arg_max(f, n * 100 - f) AS rank FROM n GROUP BY segment_id")
def cns_exact(spark, d):
    n = results_ok(spark, d).groupBy("segment_id", "norm").agg(F.count("*").alias("n"), F.min("rank").alias("f"))
    return n.groupBy("segment_id").agg((F.max("n") >= 3).alias("strong"), F.max_by("f", F.struct("n", F.negative("f"))).cast("long").alias("rank"))


@query("CN-COMPUTE")
def cn_compute(spark, d):
    return CN.consensus(model_results(spark, d).withColumn("norm", C.normalise("transcript")))


def _looped(w: str) -> str:
    from voxloom.plans.base import REPEAT

    return f"(length(transcript) >= 200 AND length(transcript) / duration_sec > 45) OR (len({w}) >= 40 AND {REPEAT} > 0.7)"


@query(
    "CNS-FULL",
    rf"""WITH {RES}, x AS (SELECT *, regexp_extract_all(transcript, '[^ \t\n\r\f\x0B]+') AS w FROM ok), u AS (SELECT * FROM x WHERE NOT ({_looped("w")})),
    g AS (SELECT segment_id, norm, count(*) AS n, min(rank) AS f, arg_min(model_name, rank) AS m FROM u GROUP BY segment_id, norm),
    t AS (SELECT segment_id, sum(n) AS usable, max(n) AS top, arg_max(m, n * 100 - f) AS best FROM g GROUP BY segment_id),
    s AS (SELECT segment_id, model_name AS surest, confidence FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY confidence DESC, rank) AS k FROM u) WHERE k = 1),
    o AS (SELECT segment_id, count(*) AS n_ok FROM ok GROUP BY segment_id)
    SELECT seg.segment_id, CASE WHEN usable IS NULL AND coalesce(n_ok, 0) > 0 THEN 'failed_all_degenerate' WHEN usable IS NULL THEN 'failed_no_transcripts' WHEN top >= 3 THEN 'strong_exact' ELSE 'weak_best_available' END AS method,
           round(CASE WHEN usable IS NULL THEN 0 WHEN top >= 3 THEN CAST(top AS DOUBLE) / usable ELSE confidence END, 6) AS score, CASE WHEN top >= 3 THEN best ELSE surest END AS selected_model
    FROM seg LEFT JOIN t USING (segment_id) LEFT JOIN s USING (segment_id) LEFT JOIN o USING (segment_id)""",
)
def cns_full(spark, d):
    return CN.consensus(model_results(spark, d)).select("segment_id", "method", "score", "selected_model")


@query("CNS-SOFT")
def cns_soft(spark, d):
    return CN.soft_consensus(results_ok(spark, d))


def _pair_averages(spark, d):
    return CN.pair_averages(model_results(spark, d), usable=F.col("error").isNull() & C.has_text(F.col("transcript")))


@query("CNS-PAIRAVG")
def cns_pairavg(spark, d):
    return _pair_averages(spark, d).select("segment_id", *[f"avg_{c}" for c in CN.AVERAGES])


@query("CNS-PAIRCOLS")
def cns_paircols(spark, d):
    """The averages, and the metrics of each pair of models in columns of their own."""
    return _pair_averages(spark, d)


@query("CNS-FINAL")
def cns_final(spark, d):
    return CN.final_method(results_ok(spark, d)).select("segment_id", "final_method", "accepted", "avg_wer", "avg_cer", "avg_jaccard")


@query("CNS-RAW", f"WITH {RES}, n AS (SELECT segment_id, norm, count(*) AS n, min(rank) AS f FROM ok GROUP BY segment_id, norm), t AS (SELECT segment_id, arg_max(norm, n * 100 - f) AS norm FROM n GROUP BY segment_id) SELECT segment_id, max(length(transcript)) AS longest FROM ok JOIN t USING (segment_id, norm) GROUP BY segment_id")
def cns_raw(spark, d):
    r = results_ok(spark, d)
    n = r.groupBy("segment_id", "norm").agg(F.count("*").alias("n"), F.min("rank").alias("f"), F.max_by("transcript", F.struct(F.char_length("transcript"), F.negative("rank"))).alias("raw"))
    return n.groupBy("segment_id").agg(F.max_by("raw", F.struct("n", F.negative("f"))).alias("raw")).select("segment_id", F.char_length("raw").cast("long").alias("longest"))


# Audits


@query("AUD-ERRTOP", f"WITH {RES} SELECT model_name, substr(error, 1, 200) AS error, count(*) AS n, min(segment_id) AS sample FROM res WHERE error IS NOT NULL GROUP BY ALL")
def aud_errtop(spark, d):
    e = model_results(spark, d).where("error is not null").groupBy("model_name", F.substring("error", 1, 200).alias("error")).agg(F.count("*").alias("n"), F.min("segment_id").alias("sample"))
    return e.withColumn("_k", F.row_number().over(Window.partitionBy("model_name").orderBy(F.desc("n"), "error"))).where("_k <= 10").drop("_k")


@query("AUD-PICKCALL", f"WITH {SEG} SELECT call_id, n, chars FROM (SELECT call_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM seg GROUP BY call_id) ORDER BY n DESC, chars DESC, call_id LIMIT 1")
def aud_pickcall(spark, d):
    return segments(spark, d).groupBy("call_id").agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars")).orderBy(F.desc("n"), F.desc("chars"), "call_id").limit(1)


@query("AUD-CALLVIEW", f"WITH {RES} SELECT segment_id, model_name, coalesce(error, transcript) AS shown FROM res WHERE call_id = 3")
def aud_callview(spark, d):
    return model_results(spark, d).where("call_id = 3").select("segment_id", "model_name", F.coalesce("error", "transcript").alias("shown"))


@query("AUD-PEEK", f"WITH {RES} SELECT model_name, count(*) AS n, count(*) FILTER (WHERE error IS NOT NULL) AS errors, count(*) FILTER (WHERE NOT {HAS_TEXT}) AS empties, round(avg(length(transcript)), 6) AS mean_chars FROM res GROUP BY model_name")
def aud_peek(spark, d):
    return model_results(spark, d).groupBy("model_name").agg(F.count("*").alias("n"), F.count("error").alias("errors"), F.count_if(~C.has_text(F.col("transcript"))).alias("empties"), R(F.avg(F.char_length("transcript")), 6).alias("mean_chars"))
