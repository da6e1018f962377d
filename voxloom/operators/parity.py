"""Audits of a run's segment manifest against a reference run's, as rows (check_name, ok, bad)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.columns import has_text

#: Statuses of redacted files that are in order.
HEALTHY = ("completed", "ok", "redacted", "clean", "no_pii", "skipped")
COVERAGE_SLACK, OVERSHOOT_LEAST, OVERSHOOT_SLACK, WHOLE_SLACK, DURATION_SLACK, SPANISH_SLACK = 0.05, 0.05, 0.01, 0.05, 0.25, 0.02


def _stats(manifest: DataFrame, models: tuple[str, ...]) -> DataFrame:
    """One row of counts, shares and extremes of a manifest; intervals are relative to their segment."""
    spans = F.coalesce("intervals", F.array().cast("array<struct<start_sec:double,end_sec:double>>"))
    pii = F.coalesce("pii_count", F.lit(0)) > 0
    over = F.aggregate(spans, F.lit(0.0), lambda a, x: F.greatest(a, x["end_sec"] - F.col("duration_sec"), -x["start_sec"]))
    whole = F.exists(spans, lambda x: (x["start_sec"] <= 0) & (x["end_sec"] >= F.col("duration_sec")))
    return manifest.agg(
        *[F.coalesce(F.avg(has_text(F.col(f"{m}_transcript")).cast("double")), F.lit(0.0)).alias(f"covered_{m}") for m in models],
        F.count_if(F.col("alignment_status") == "failed").alias("failed"),
        F.count_if(~F.coalesce("redacted_status", F.lit("")).isin(*HEALTHY)).alias("unhealthy"),
        F.count_if(pii).alias("pii"),
        F.count_if(pii & (F.size(spans) == 0)).alias("unmasked"),
        F.coalesce(F.sum(F.when(pii, F.size(F.filter(spans, lambda x: x["end_sec"] <= x["start_sec"]))).otherwise(0)), F.lit(0)).alias("inverted"),
        F.coalesce(F.max(F.when(pii, over)), F.lit(0.0)).alias("overshoot"),
        F.coalesce(F.avg(F.when(pii, whole.cast("double"))), F.lit(0.0)).alias("whole"),
        F.count_if(~has_text(F.col("language"))).alias("unlabelled"),
    )


def _replay(manifest: DataFrame, old: DataFrame) -> DataFrame:
    """One row: calls with other numbers of segments, segments with other spans, calls that lost Spanish."""
    key = F.regexp_extract("segment_id", r"([^_]*_[^_]*)$", 1)
    pick = lambda x, p: x.select("call_id", key.alias("k"), F.struct("start_sample", "end_sample").alias(f"{p}_span"), F.coalesce("language", F.lit("")).startswith("es").alias(f"{p}_es"))
    both = pick(old, "o").join(pick(manifest.join(old.select("call_id").distinct(), "call_id", "left_semi"), "n"), ["call_id", "k"], "full")
    met = F.col("o_span").isNotNull() & F.col("n_span").isNotNull()
    by = both.groupBy("call_id").agg(
        F.count("o_span").alias("o"),
        F.count("n_span").alias("n"),
        F.count_if(met).alias("met"),
        F.count_if(met & (F.col("o_span") != F.col("n_span"))).alias("moved"),
        F.count_if(met & F.col("o_es")).alias("o_es"),
        F.count_if(met & F.col("n_es")).alias("n_es"),
    )
    lost = (F.col("met") == 0) | (F.col("n_es") < F.col("o_es") - F.greatest(F.lit(1.0), SPANISH_SLACK * F.col("met")))
    return by.agg(F.count_if(F.col("o") != F.col("n")).alias("resegmented"), F.coalesce(F.sum("moved"), F.lit(0)).alias("moved"), F.count_if(lost).alias("lost_spanish"))


def audit(manifest: DataFrame, reference: DataFrame, inputs: DataFrame, models: tuple[str, ...], replay: DataFrame | None = None) -> DataFrame:
    """All checks. inputs: call_id, source_sec, redacted_sec (null without a redacted file); replay: segments of calls that ran before."""
    mine, theirs = _stats(manifest, models), _stats(reference, models)
    stats = mine.select([F.col(c).alias(f"m_{c}") for c in mine.columns]).join(F.broadcast(theirs.select([F.col(c).alias(f"r_{c}") for c in theirs.columns])))
    calls = inputs.join(manifest.select("call_id").distinct().withColumn("seen", F.lit(True)), "call_id", "left")
    calls = calls.agg(
        F.count_if(F.col("seen").isNull()).alias("rowless"),
        F.count_if(F.col("redacted_sec").isNull()).alias("unredacted"),
        F.count_if(F.abs(F.col("redacted_sec") - F.col("source_sec")) > DURATION_SLACK).alias("other_length"),
    )
    # One row each.
    row = stats.join(F.broadcast(calls))
    lost = sorted(set(reference.columns) - set(manifest.columns))
    thin = sum((F.when(F.col(f"m_covered_{m}") < F.col(f"r_covered_{m}") - COVERAGE_SLACK, 1).otherwise(0) for m in models), F.lit(0))
    zero = lambda c: (F.col(c) == 0, F.col(c))
    flag = lambda ok: (ok, F.when(ok, 0).otherwise(1))
    checks: dict[str, tuple[Column, Column]] = {
        "columns": (F.lit(not lost), F.lit(len(lost))),
        "calls_have_rows": zero("rowless"),
        "calls_are_redacted": zero("unredacted"),
        "durations_match": zero("other_length"),
        "models_cover": (thin == 0, thin),
        "alignments": zero("m_failed"),
        "redactions": zero("m_unhealthy"),
        "pii_is_found": flag(F.col("m_pii") > 0),
        "pii_is_masked": zero("m_unmasked"),
        "masks_are_upright": zero("m_inverted"),
        "masks_stay_near": flag(F.col("m_overshoot") <= F.greatest(F.col("r_overshoot"), F.lit(OVERSHOOT_LEAST)) + OVERSHOOT_SLACK),
        "masks_are_targeted": flag(F.col("m_whole") <= F.col("r_whole") + WHOLE_SLACK),
        "languages": zero("m_unlabelled"),
    }
    if replay is not None:
        row = row.join(F.broadcast(_replay(manifest, replay)))
        checks |= {"replay_segments": zero("resegmented"), "replay_spans": zero("moved"), "replay_spanish": zero("lost_spanish")}
    each = [F.struct(F.lit(name).alias("check_name"), ok.alias("ok"), bad.cast("long").alias("bad")) for name, (ok, bad) in checks.items()]
    return row.select(F.inline(F.array(*each)))
