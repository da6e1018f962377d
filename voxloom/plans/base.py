"""Call data derived from the test tables, as DataFrames and as SQL, and a registry of queries.

Segments are conversation turns: a call per conversation, a channel per role, a length from the
text, a start from the turns before. Model results are variants of a segment's text, one per
model of the panel. Call sides are embeddings, two to a call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.functions.fixed import PANEL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = turns.select(
        F.concat_ws("_", F.lit("call"), "conv_id", F.lpad(F.col("turn").cast("string"), 5, "0")).alias("segment_id"),
        F.col("conv_id").alias("call_id"),
        F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2).alias("channel"),
        "turn",
        "conv_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.greatest(F.lit(0.25), F.char_length(F.coalesce("text", F.lit(""))) / 15.0).alias("duration_sec"),
    )
    return rows.withColumn("start_sec", F.round(F.coalesce(F.sum("duration_sec").over(before), F.lit(0.0)), 6)).withColumn("end_sec", F.round(F.col("start_sec") + F.col("duration_sec"), 6)).drop("conv_id")


def model_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long: one row per segment and model; an error has no transcript."""
    s = segments(spark, sf_dir).select("segment_id", "call_id", "turn", "duration_sec", "text")
    text = {
        "parakeet": F.col("text"),
        "whisper": F.lower("text"),
        "qwen": F.regexp_replace("text", "[.,!?;:]", " "),
        "cohere": F.when(F.col("turn") % 3 == 0, F.regexp_replace("text", r"[^ ]+ *$", "")).otherwise(F.col("text")),
        "granite": F.when(F.col("call_id") % 17 == 0, F.repeat(F.concat(F.col("text"), F.lit(" ")), 12)).otherwise(F.col("text")),
    }
    failed = (F.col("turn") % 5 == 4) & (F.col("call_id") % 3 == 0)
    each = F.array(*[F.struct(F.lit(m).alias("model_name"), F.lit(i).alias("rank"), F.when(failed & F.lit(m in ("granite", "cohere")), F.lit(None)).otherwise(text[m]).alias("transcript")) for i, m in enumerate(PANEL)])
    rows = s.select("segment_id", "call_id", "turn", "duration_sec", F.inline(each))
    return rows.withColumn("error", F.when(F.col("transcript").isNull(), F.lit("decode failed"))).withColumn("confidence", ((F.col("call_id") * 7 + F.col("turn") * 3 + F.col("rank") * 11) % 100) / 100.0).withColumn("norm", C.plain(F.col("transcript")))


def results_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_results(spark, sf_dir).where(F.col("error").isNull() & C.has_text(F.col("transcript")))


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call sides with a vector: two embeddings are the sides of a call."""
    return read(spark, sf_dir, "embeddings").select((F.col("vec_id") / 2).cast("long").alias("call_id"), (F.col("vec_id") % 2).cast("int").alias("channel"), F.col("vec_id").alias("side_id"), "label", F.col("embedding").cast("array<double>").alias("v"))


#: Whether a transcript is more than white space, in SQL.
HAS_TEXT = f"regexp_matches(coalesce(transcript, ''), '{C.NOT_SPACE}')"

SEG = r"""seg AS (
  SELECT 'call_' || call_id || '_' || lpad(CAST(turn AS VARCHAR), 5, '0') AS segment_id, call_id, channel, turn, text, duration_sec,
         start_sec, round(start_sec + duration_sec, 6) AS end_sec
  FROM (
    SELECT *, round(coalesce(sum(duration_sec) OVER (PARTITION BY call_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_sec
    FROM (SELECT conv_id AS call_id, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS channel, turn, coalesce(text, '') AS text,
                 greatest(0.25, length(coalesce(text, '')) / CAST(15 AS DOUBLE)) AS duration_sec FROM conversations)
  )
)"""

RES = (
    SEG
    + r""", panel AS (
  SELECT unnest(['parakeet', 'whisper', 'qwen', 'cohere', 'granite']) AS model_name, unnest([0, 1, 2, 3, 4]) AS rank
), res AS (
  SELECT *, CASE WHEN transcript IS NULL THEN 'decode failed' END AS error, ((call_id * 7 + turn * 3 + rank * 11) % 100) / CAST(100 AS DOUBLE) AS confidence,
         array_to_string(regexp_extract_all(lower(coalesce(transcript, '')), '[a-z0-9]+'), ' ') AS norm
  FROM (
    SELECT segment_id, call_id, turn, duration_sec, model_name, rank,
           CASE WHEN turn % 5 = 4 AND call_id % 3 = 0 AND model_name IN ('granite', 'cohere') THEN NULL
                WHEN model_name = 'whisper' THEN lower(text)
                WHEN model_name = 'qwen' THEN regexp_replace(text, '[.,!?;:]', ' ', 'g')
                WHEN model_name = 'cohere' AND turn % 3 = 0 THEN regexp_replace(text, '[^ ]+ *$', '')
                WHEN model_name = 'granite' AND call_id % 17 = 0 THEN repeat(text || ' ', 12)
                ELSE text END AS transcript
    FROM seg, panel
  )
), ok AS (
  SELECT * FROM res WHERE error IS NULL AND regexp_matches(transcript, '[^\t-\r\x1c-\x20\x{85}\p{Z}]')
)"""
)

SIDES = """sides AS (
  SELECT vec_id // 2 AS call_id, CAST(vec_id % 2 AS INTEGER) AS channel, vec_id AS side_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
)"""

#: A sum of a repeat ratio's parts in SQL, over a column of words.
REPEAT = "CASE WHEN len(w) < 10 THEN CAST(0 AS DOUBLE) ELSE 1 - CAST(len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))) AS DOUBLE) / (len(w) - 4) END"


def sound_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is measured of a vector as a clip of sound: error, duration, usable speech, shares of active windows and clipped samples, level, language."""
    v = F.col("embedding").cast("array<double>")
    power = lambda x: F.aggregate(x, F.lit(0.0), lambda a, y: a + y * y)
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", v.alias("v")).withColumn("n", F.size("v"))
    windows = F.transform(F.sequence(F.lit(0), F.col("n") - 1, F.lit(4)), lambda i: power(F.slice("v", i + 1, 4)) / 4)
    rows = rows.withColumns({"mean": power(F.col("v")) / F.col("n"), "w": windows})
    speech = F.size(F.filter("w", lambda x: x >= 0.05 * F.col("mean"))) / F.size("w")
    duration = F.when(F.col("vec_id") % 29 != 7, F.col("n") / (2 + F.col("vec_id") % 30))
    return rows.select(
        "vec_id",
        F.when(F.col("vec_id") % 23 == 5, "cut short").alias("error"),
        duration.alias("duration"),
        (duration * speech).alias("usable"),
        F.when(F.col("vec_id") % 31 != 3, speech).alias("speech"),
        F.when(F.col("vec_id") % 37 != 3, F.size(F.filter("v", lambda x: F.abs(x) >= 0.35)) / F.col("n")).alias("clipped"),
        F.when(F.col("label") != 7, F.col("label") % 5 != 3).alias("english"),
        F.round(F.sqrt("mean") * (1 + F.col("label")), 9).alias("level"),
    )


FACTS = """fact AS (
  SELECT vec_id, CASE WHEN vec_id % 23 = 5 THEN 'cut short' END AS error, duration, duration * s AS usable, CASE WHEN vec_id % 31 <> 3 THEN s END AS speech,
         CASE WHEN vec_id % 37 <> 3 THEN len(list_filter(v, lambda x: abs(x) >= 0.35)) / CAST(len(v) AS DOUBLE) END AS clipped,
         CASE WHEN label <> 7 THEN label % 5 <> 3 END AS english, round(sqrt(mean) * (1 + label), 9) AS level
  FROM (SELECT *, len(list_filter(w, lambda x: x >= 0.05 * mean)) / CAST(len(w) AS DOUBLE) AS s, CASE WHEN vec_id % 29 <> 7 THEN len(v) / CAST(2 + vec_id % 30 AS DOUBLE) END AS duration
        FROM (SELECT vec_id, label, v, list_sum(list_transform(v, lambda x: x * x)) / len(v) AS mean,
                     list_transform(range(0, len(v), 4), lambda i: list_sum(list_transform(v[i + 1 : i + 4], lambda x: x * x)) / 4) AS w
              FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)))
), trained AS (SELECT *, error IS NULL AND coalesce(duration, 0) > 0 AND coalesce(duration, 999999) <= 20 AND coalesce(usable, 0) >= 1 AND coalesce(speech, 0) >= 0.85 AND coalesce(clipped, 1) < 0.02 AS trainable FROM fact)"""
