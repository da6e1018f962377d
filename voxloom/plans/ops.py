"""State of runs, reviews, reports and the whole chain as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.operators import adapters, chain, context, order, review
from voxloom.plans.base import SEG, model_results, query, read, segments
from voxloom.sources import calls as SRC
from voxloom.sources import config, sinks
from voxloom.sources.work import work_path

R = F.round

# State


@query(
    "ST-PAUSE",
    """WITH r AS (SELECT user_id % 50 AS run_id, event_id % 7 AS worker_id, event_type = 'click' AS everyone, CASE WHEN value > 50 THEN ts END AS released_at FROM events WHERE event_id % 97 = 0),
    w AS (SELECT DISTINCT user_id % 50 AS run_id, unnest(range(7)) AS worker_id FROM events)
    SELECT run_id, worker_id, EXISTS (SELECT 1 FROM r WHERE r.run_id = w.run_id AND released_at IS NULL AND (everyone OR r.worker_id = w.worker_id)) AS paused FROM w""",
)
def st_pause(spark, d):
    """Workers of runs that a request of their run, for all or for them, holds; released ones hold nobody."""
    e = read(spark, d, "events")
    asked = e.where("event_id % 97 = 0").select((F.col("user_id") % 50).alias("run_id"), (F.col("event_id") % 7).alias("worker_id"), (F.col("event_type") == "click").alias("everyone"), F.when(F.col("value") > 50, F.col("ts")).alias("released_at"))
    workers = e.select((F.col("user_id") % 50).alias("run_id")).distinct().select("run_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(6).cast("long"))).alias("worker_id"))
    held = asked.where("released_at is null").groupBy("run_id").agg(F.bool_or("everyone").alias("everyone"), F.collect_set("worker_id").alias("them"))
    return workers.join(held, "run_id", "left").select("run_id", "worker_id", F.coalesce(F.col("everyone") | F.array_contains("them", F.col("worker_id")), F.lit(False)).alias("paused"))


@query(
    "ST-LEASE",
    """WITH b AS (SELECT user_id % 20 AS shard, arg_max(user_id, (ts, event_id)) AS holder, max(ts) AS beat FROM events GROUP BY 1), n AS (SELECT max(ts) AS clock FROM events)
    SELECT shard, holder, date_diff('second', beat, clock) > 3600 AS stale, CASE WHEN date_diff('second', beat, clock) > 3600 THEN -1 ELSE holder END AS owner FROM b, n""",
)
def st_lease(spark, d):
    """Of each shard the worker that beat last, and whether its lease is older than an hour, so that another may take it."""
    e = read(spark, d, "events")
    beats = e.groupBy((F.col("user_id") % 20).alias("shard")).agg(F.max_by("user_id", F.struct("ts", "event_id")).alias("holder"), F.max("ts").alias("beat"))
    # One row: the clock.
    now = e.agg(F.max("ts").alias("at"))
    age = F.unix_seconds(F.col("at").cast("timestamp")) - F.unix_seconds(F.col("beat").cast("timestamp"))
    return beats.join(F.broadcast(now)).select("shard", "holder", (age > 3600).alias("stale"), F.when(age > 3600, -1).otherwise(F.col("holder")).alias("owner"))


@query("ST-INVALIDATE")
def st_invalidate(spark, d):
    """Artifacts that stay when segments in which a number is recited, and so their files, are to be done again; every third turn recites one."""
    said = F.when(F.col("turn") % 3 == 2, F.concat("text", F.lit(" call me at five five five one two three four five"))).when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" in 20 minutes or two"))).otherwise(F.col("text"))
    s = segments(spark, d).withColumn("text", F.when(F.col("call_id") % 4 > 0, said).otherwise(F.col("text")))
    owned = lambda owner, *kinds: s.select(owner.alias("owner"), F.explode(F.array(*map(F.lit, kinds))).alias("kind"))
    file = F.concat(F.lit("file_"), F.col("call_id").cast("string"))
    artifacts = owned(F.col("segment_id"), "pii", "alignment").unionAll(owned(file, "mask_plan", "redacted").distinct())
    affected = s.where(F.size(C.spoken_numbers("text")) > 0)
    gone = affected.select(F.col("segment_id").alias("owner")).unionAll(affected.select(file.alias("owner")).distinct())
    return artifacts.join(gone, "owner", "left_anti")


@query("SRC-STATE", "SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS batch FROM orders WHERE o_orderstatus = 'F'")
def src_state(spark, d):
    """A table read with a filter, in batches of 1000 rows by key."""
    rows = read(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    return order.running(rows, [F.col("o_orderkey")]).select("o_orderkey", "o_orderstatus", F.floor(F.col("before") / 1000).alias("batch"))


@query("SRC-SUBSET", "SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id ORDER BY conv_id LIMIT 10")
def src_subset(spark, d):
    """The first ten calls, and their index as it is read back."""
    path = work_path(spark, "subset")
    first = read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns")).orderBy("conv_id").limit(10)
    first.write.json(f"{path}/index")
    return spark.read.schema("conv_id long, turns long").json(f"{path}/index")


@query("SRC-SIDECAR", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS k, CASE WHEN event_id % 5 = 0 THEN NULL ELSE '[1, {\"x\": 2}]' END AS tags, event_id % 5 = 0 AS broken FROM events")
def src_sidecar(spark, d):
    """Nested objects by dotted names; text that isn't JSON is an error of its row."""
    nested = F.concat(F.lit('{"call": {"props": '), "props", F.lit(', "tags": [1, {"x": 2}]}}'))
    e = read(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{"), "props")).otherwise(nested).alias("text"))
    flat = e.select("event_id", SRC.flatten_json(F.col("text")).alias("m"))
    return flat.select("event_id", F.col("m")["call.props.k"].alias("k"), F.col("m")["call.tags"].alias("tags"), F.col("m")["metadata_error"].isNotNull().alias("broken"))


# Joins, invariants, reviews


@query("JN-VALIDATE1", "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def jn_validate1(spark, d):
    return review.join_one_to_one(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels").select("doc_id", "quality"), "doc_id")


_SIDE = "s AS (SELECT vec_id // 2 AS call_id, vec_id % 2 AS channel, label AS cluster, CASE WHEN vec_id % 10 = 0 THEN vec_id ELSE vec_id // 20 END AS split_group FROM embeddings UNION ALL SELECT vec_id // 2, vec_id % 2, 99, vec_id // 20 FROM embeddings WHERE vec_id % 14 = 3)"


@query(
    "AG-INVARIANT",
    f"""WITH {_SIDE}, c AS (SELECT call_id, count(DISTINCT split_group) AS g, count(DISTINCT cluster) AS k, count(DISTINCT channel) AS n FROM s GROUP BY call_id)
    SELECT 'split_calls' AS invariant, count(*) FILTER (WHERE g > 1) AS n FROM c UNION ALL SELECT 'shared_speakers', count(*) FILTER (WHERE n > 1 AND k < n) FROM c
    UNION ALL SELECT 'split_sides', count(*) FROM (SELECT 1 FROM s GROUP BY call_id, channel HAVING count(DISTINCT cluster) > 1)""",
)
def ag_invariant(spark, d):
    """Broken on purpose: calls in two split groups, sides with two clusters, calls with one speaker."""
    v = read(spark, d, "embeddings")
    half, fold = F.floor(F.col("vec_id") / 2), F.floor(F.col("vec_id") / 20)
    side = v.select(half.alias("call_id"), (F.col("vec_id") % 2).alias("channel"), F.col("label").alias("cluster"), F.when(F.col("vec_id") % 10 == 0, F.col("vec_id")).otherwise(fold).alias("split_group"))
    more = v.where("vec_id % 14 = 3").select(half.alias("call_id"), (F.col("vec_id") % 2).alias("channel"), F.lit(99).alias("cluster"), fold.alias("split_group"))
    return review.violations(side.unionAll(more))


_JUDGED = """j AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'skip' WHEN quality = 1 AND doc_id % 3 = 0 THEN 'pass' WHEN doc_id < 60 THEN 'pass' ELSE 'unseen' END AS verdict,
  NOT (toxic = 1 OR (quality = 1 AND doc_id % 3 = 0)) AND doc_id < 60 AS by_range FROM labels)"""


@query("AUD-VERDICT", f"WITH {_JUDGED} SELECT verdict, by_range, count(*) AS n FROM j GROUP BY ALL")
def aud_verdict(spark, d):
    """Explicit verdicts win over a range of places; the tally says which came by range."""
    return _judged(spark, d).groupBy("verdict", "by_range").agg(F.count("*").alias("n"))


@query("AUD-EXPORT", f"WITH {_JUDGED} SELECT doc_id AS call_id, doc_id % 11 AS pii FROM j WHERE verdict = 'pass' AND doc_id % 2 = 0 ORDER BY pii DESC, call_id LIMIT 20")
def aud_export(spark, d):
    """The twenty passed calls with a file that have most personal data."""
    return review.export(_judged(spark, d), 20).select("call_id", "pii")


def _judged(spark, d):
    labels = read(spark, d, "labels")
    own = F.when(F.col("toxic") == 1, "skip").when((F.col("quality") == 1) & (F.col("doc_id") % 3 == 0), "pass")
    calls = labels.select(F.col("doc_id").alias("call_id"), F.col("doc_id").alias("place"), (F.col("doc_id") % 11).alias("pii"), (F.col("doc_id") % 2 == 0).alias("has_file"))
    return review.verdicts(calls, labels.select(F.col("doc_id").alias("call_id"), own.alias("verdict")).where("verdict is not null"), [(0, 60, "pass")])


# Reports and sheets


_RATES = {"parakeet": 77.7, "qwen": 7.65, "granite": 8.43, "cohere": 11.76}


@query(
    "AG-PROJECT",
    f"""WITH {SEG}, c AS (SELECT count(*) AS n, sum(duration_sec) AS s, count(DISTINCT call_id) AS calls FROM seg), r AS (SELECT unnest([{", ".join(f"'{m}'" for m in _RATES)}, 'all in turn']) AS model_name, unnest([{", ".join(f"CAST({r} AS DOUBLE)" for r in _RATES.values())}, {1 / sum(1 / r for r in _RATES.values())!r}]) AS rate)
    SELECT model_name, round(rate, 6) AS rate, round(n / calls, 6) AS segments_per_call, round(s / calls, 6) AS seconds_per_call, round(s / calls * 32400 / rate / 3600, 6) AS hours FROM c, r""",
)
def ag_project(spark, d):
    """Hours that 32,400 calls like these take, by each model's rate and by all in turn."""
    c = segments(spark, d).agg(F.count("*").alias("n"), F.sum("duration_sec").alias("s"), F.count_distinct("call_id").alias("calls"))
    rates = spark.createDataFrame([*_RATES.items(), ("all in turn", 1 / sum(1 / r for r in _RATES.values()))], "model_name string, rate double")
    per = F.col("s") / F.col("calls")
    return rates.join(F.broadcast(c)).select("model_name", R("rate", 6).alias("rate"), R(F.col("n") / F.col("calls"), 6).alias("segments_per_call"), R(per, 6).alias("seconds_per_call"), R(per * 32400 / F.col("rate") / 3600, 6).alias("hours"))


@query("OPS-DRYRUN", f"WITH {SEG}, c AS (SELECT count(*) AS segments, count(DISTINCT call_id) AS calls, round(sum(duration_sec), 4) AS seconds FROM seg) SELECT unnest(['calls', 'config_hash', 'seconds', 'segments']) AS name, unnest([CAST(calls AS VARCHAR), '{config.config_hash(config.DEFAULTS)}', printf('%.4f', seconds), CAST(segments AS VARCHAR)]) AS value FROM c")
def ops_dryrun(spark, d):
    """What a run would take, without doing it, and the options that it would have."""
    c = segments(spark, d).agg(F.count("*").alias("segments"), F.count_distinct("call_id").alias("calls"), R(F.sum("duration_sec"), 4).alias("seconds"))
    of = {"calls": F.col("calls").cast("string"), "config_hash": F.lit(config.config_hash(config.merge(config.DEFAULTS))), "seconds": F.format_string("%.4f", "seconds"), "segments": F.col("segments").cast("string")}
    return c.select(F.inline(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in of.items()])))


@query("SNK-REPORT", "SELECT '{\"documents\":' || count(*) || ',\"languages\":' || count(DISTINCT lang) || ',\"stage\":\"discover\"}' AS value FROM documents")
def snk_report(spark, d):
    """A stage's summary as one line of JSON, names in order, as it is read back."""
    path = work_path(spark, "report")
    summary = read(spark, d, "documents").agg(F.lit("discover").alias("stage"), F.count("*").alias("documents"), F.count_distinct("lang").alias("languages"))
    sinks.write_report(summary, path)
    return spark.read.text(path)


@query("SNK-YEAR", "SELECT event_id, CAST(year(ts) AS INTEGER) AS year, unnest(['json', 'csv']) AS form FROM events")
def snk_year(spark, d):
    """Copies by year, as JSON and as CSV."""
    path = work_path(spark, "manifest")
    sinks.write_manifest(read(spark, d, "events").select("event_id", F.year("ts").alias("year")), path, csv=True, by_year=True)
    kind = "event_id long, year int"
    both = spark.read.schema(kind).json(f"{path}/by_year").withColumn("form", F.lit("json"))
    return both.unionByName(spark.read.schema(kind).option("header", "true").csv(f"{path}/by_year_csv").withColumn("form", F.lit("csv")))


@query("SNK-XLSX", r"SELECT doc_id, substr(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), 1, 32767) AS text FROM documents WHERE (SELECT count(*) FROM documents) BETWEEN 1 AND 1048575")
def snk_xlsx(spark, d):
    """Cells of a sheet; more rows than a sheet has, or none, give no sheet."""
    return sinks.sheet(read(spark, d, "documents").select("doc_id", "text"))


# The whole chain


_TEXTS = """t AS (SELECT call_id, channel, regexp_replace(string_agg(text, chr(10) ORDER BY turn), '^[ \\t-\\r]+|[ \\t-\\r]+$', '', 'g') AS transcript FROM seg GROUP BY call_id, channel)"""


@query("LBL-ROLE", f"WITH {SEG}, {_TEXTS} SELECT call_id, channel, CASE WHEN transcript = '' THEN 'unknown' WHEN length(transcript) % 3 = 0 THEN 'customer' WHEN length(transcript) % 3 = 1 THEN 'agent' ELSE 'unknown' END AS role, CASE WHEN transcript = '' THEN '' ELSE length(transcript) || ' characters' END AS reason FROM t WHERE call_id % 4 <> 1")
def lbl_role(spark, d):
    """Sides labelled by a stand-in, but for calls that a run before has labelled."""
    s = segments(spark, d)
    done = s.where("call_id % 4 = 1").select("call_id", "channel").distinct()
    return adapters.label_sides(context.channel_texts(s), adapters.ByLength, done).drop("error")


@query(
    "ALN-STAGE",
    f"""WITH {SEG} SELECT segment_id, CASE WHEN turn % 7 = 6 OR NOT regexp_matches(text, '[^\\s]') THEN 'mask_whole' WHEN turn % 2 = 1 THEN 'no_spans' WHEN call_id % 5 IN (2, 4) THEN 'uniform_language' WHEN turn % 4 = 2 THEN 'uniform_error' ELSE 'align' END AS route FROM seg""",
)
def aln_stage(spark, d):
    lang = F.array(*[F.lit(x) for x in ("en", "es-MX", "fr", "EN-us", None)])[F.col("call_id") % 5]
    method = F.when(F.col("turn") % 7 == 6, "failed_no_transcripts").otherwise("strong_exact")
    error = F.when(F.col("turn") % 4 == 2, "aligner failed")
    return segments(spark, d).select("segment_id", chain.route(method, F.col("text"), 1 - F.col("turn") % 2, lang, error).alias("route"))


@query("ALN-WHISPERX")
def aln_whisperx(spark, d):
    """Words by the times of aligned characters of the text with digits as words: each character of a stand-in takes 50 ms."""
    s = segments(spark, d).select("segment_id", F.concat("text", F.lit(" at 212-537 now")).alias("said"))
    x = s.withColumn("x", C.spelled_digits(F.col("said"), F.lit("en")))
    times = lambda late: F.transform("x.place", lambda _, i: (i + late) * 0.05)
    units = x.select("segment_id", F.inline(C.remapped_units(F.col("said"), F.col("x.place"), times(0), times(1))))
    return units.select("segment_id", "word", "start_char", R("start_sec", 6).alias("start_sec"), R("end_sec", 6).alias("end_sec"))


@query("PII-NEURAL")
def pii_neural(spark, d):
    """The detectors' interface with a stand-in, over whole texts in windows."""
    docs = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("segment_id"), "text")
    return adapters.find_entities(docs, adapters.CapitalWords, 0.45).drop("error")


@query("RUN-PLAN")
def run_plan(spark, d):
    """Consensus, personal data, times and plans of all calls, each on the one before."""
    s = segments(spark, d).select("segment_id", F.col("call_id").alias("file_id"), "channel", "start_sec", "duration_sec")
    said = F.when(F.col("transcript").isNotNull() & (F.col("turn") % 2 == 1), F.concat(F.lit("my name is John Smith call 555-123-4567 "), "transcript")).otherwise(F.col("transcript"))
    results = model_results(spark, d).withColumn("transcript", F.when(F.col("turn") % 7 == 6, None).otherwise(said)).withColumn("error", F.when(F.col("transcript").isNull(), F.lit("none")))
    plan = chain.plan_run(s, results, s.select("file_id"))
    return plan.select("file_id", "status", F.size("intervals").alias("n"), R(F.aggregate("intervals", F.lit(0.0), lambda a, x: a + x["end_sec"] - x["start_sec"]), 4).alias("seconds"))
