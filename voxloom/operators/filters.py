"""Which segments teach, are embedded or are surely labelled, by all that was measured of them; labels read from what a model wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.operators.order import quantiles

#: Seconds, shares of speech and of clipped samples, and quantiles of level that the filters ask for.
TRAIN_SEC, TRAIN_SPEECH_SEC, TRAIN_SPEECH, TRAIN_CLIP = 20.0, 1.0, 0.85, 0.02
EMBED_SPEECH_SEC, EMBED_CLIP = 0.50, 0.05
CLEAN_SPEECH_SEC, CLEAN_SPEECH, CLEAN_CLIP, CLEAN_LEVEL = 2.0, 0.90, 0.005, {"low": 0.02, "high": 0.995}
SURE_LABELS, SURE = ("all_same", "3_agree"), 3
#: Words that stand for a role, in the order in which they are looked for, and the stages.
ROLE_WORDS = (("AGENT", ("AGENT", "EMPLOYEE", "COMPANY REPRESENTATIVE")), ("USER", ("USER", "PATIENT", "CUSTOMER", "MEMBER")), ("IVR", ("IVR", "AUTOMATED", "RECORDED")), ("MIXED", ("MIXED",)))
STAGES = ("ONBOARDING", "OFFBOARDING", "FOLLOW_UP", "ROUTINE_CHECKIN", "VOICEMAIL", "OTHER")
FIELDS = ("speaker_role", "speaker_role_confidence", "call_stage", "call_stage_confidence")


def _or(c: str, value) -> Column:
    return F.coalesce(c, F.lit(value))


def trainable() -> Column:
    """From error, duration, usable, speech and clipped: no error, a length within the limit, enough speech, few clipped samples. What is unknown fails its term."""
    length = (_or("duration", 0.0) > 0) & (_or("duration", 999999.0) <= TRAIN_SEC)
    return F.col("error").isNull() & length & (_or("usable", 0.0) >= TRAIN_SPEECH_SEC) & (_or("speech", 0.0) >= TRAIN_SPEECH) & (_or("clipped", 1.0) < TRAIN_CLIP)


def embeddable() -> Column:
    """From usable, clipped, trainable and english: unknown measures fail, unknown flags pass."""
    measured = (F.col("usable") >= EMBED_SPEECH_SEC) & (F.col("clipped") < EMBED_CLIP)
    return F.coalesce(measured, F.lit(False)) & _or("trainable", True) & _or("english", True)


def clean(rows: DataFrame) -> DataFrame:
    """Rows (usable, speech, clipped, english, level) that are clean: of those that pass the limits (an unknown share passes, an unknown language fails), the ones whose level is within two of their quantiles."""
    kept = rows.where((_or("usable", 0.0) >= CLEAN_SPEECH_SEC) & (_or("speech", 1.0) >= CLEAN_SPEECH) & (_or("clipped", 0.0) < CLEAN_CLIP) & _or("english", False))
    # One row: a scalar.
    return kept.join(F.broadcast(quantiles(kept, [], "level", CLEAN_LEVEL).drop("n"))).where(F.col("level").between(F.col("low"), F.col("high"))).drop("low", "high")


def candidates(rows: DataFrame) -> DataFrame:
    """Adds candidate (accepted, with a text) and sure: by its agreement_label, models_agreeing or soft_agreed; unknown ones count for nothing."""
    sure = _or("agreement_label", "").isin(*SURE_LABELS) | (_or("models_agreeing", 0) >= SURE) | (_or("soft_agreed", 0) >= SURE)
    return rows.withColumns({"candidate": _or("accepted", False) & C.has_text(F.col("text")), "sure": sure})


def label_of(text: Column) -> Column:
    """Struct of a role and stage label with confidences and the way it was read: ``json`` as the object says; ``keys`` of text that names the fields; ``keywords`` that stand for roles and stages; null if none."""
    text = F.coalesce(text, F.lit(""))
    json = C.json_object(text)
    parsed = F.from_json(json, "map<string,string>")
    kind = "struct<speaker_role:string,speaker_role_confidence:string,call_stage:string,call_stage_confidence:string,way:string>"
    read = F.struct(*[F.get_json_object(json, f"$.{f}").alias(f) for f in FIELDS], F.lit("json").alias("way")).cast(kind)
    key = {f: F.nullif(F.regexp_extract(text, rf"(?i){f}['\"]?\s*+[:=]\s*+['\"]?([A-Za-z_]+)", 1), F.lit("")) for f in FIELDS}
    upper = F.upper(text)
    named = lambda words: F.reduce(F.array(*[F.contains(upper, F.lit(w)) for w in words]), F.lit(False), lambda a, x: a | x)
    role = F.coalesce(*[F.when(named(words), r) for r, words in ROLE_WORDS], F.lit("UNKNOWN"))
    stage = F.coalesce(*[F.when(F.contains(upper, F.lit(s)), s) for s in STAGES], F.lit("UNKNOWN"))

    def made(r: Column, rc: Column, s: Column, sc: Column, way: str) -> Column:
        return F.struct(r.alias("speaker_role"), rc.alias("speaker_role_confidence"), s.alias("call_stage"), sc.alias("call_stage_confidence"), F.lit(way).alias("way")).cast(kind)

    medium = F.lit("medium")
    keys = made(F.coalesce(F.upper(key["speaker_role"]), F.lit("UNKNOWN")), F.coalesce(F.lower(key["speaker_role_confidence"]), medium), F.coalesce(F.upper(key["call_stage"]), F.lit("UNKNOWN")), F.coalesce(F.lower(key["call_stage_confidence"]), medium), "keys")
    words = made(role, medium, stage, medium, "keywords")
    return F.when(parsed.isNotNull(), read).when(key["speaker_role"].isNotNull() | key["call_stage"].isNotNull(), keys).when((role != "UNKNOWN") | (stage != "UNKNOWN"), words)
