"""Audio, plans, audits, options, caches, order and language rules against plain versions."""

import io
import math
import random
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import kernels as K
from voxloom.operators import audio, consensus, context, language, order, parity, speakers
from voxloom.plans import calls
from voxloom.sources import config, publish


def stereo(n=800, rate=8000):
    t = np.arange(n) / rate
    return audio.write_wav(audio.to_int16(np.stack([0.5 * np.sin(2 * np.pi * 440 * t), 0.25 * np.sin(2 * np.pi * 880 * t)], axis=1)), rate)


def test_wav_round_trip_and_clip():
    rate, frames = audio.read_wav(stereo())
    assert (rate, frames.shape) == (8000, (800, 2)) and audio.read_wav(audio.write_wav(frames, rate))[1].tolist() == frames.tolist()
    assert audio.read_wav(audio.clip(stereo(), 1, 100, 300))[1].tolist() == frames[100:300, [1]].tolist()
    with pytest.raises(ValueError, match="channel 2"):
        audio.clip(stereo(), 2, 0, 1)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(1), w.setframerate(8000), w.writeframes(b"\x80" * 10)
    with pytest.raises(ValueError, match="16 bits"):
        audio.read_wav(out.getvalue())


@pytest.mark.parametrize("strategy", audio.STRATEGIES)
def test_mask_touches_its_channel_only(strategy, monkeypatch):
    monkeypatch.setattr(audio, "BLOCK", 300)
    rate, before = audio.read_wav(stereo())
    after = audio.read_wav(audio.mask_wav(stereo(), [(0, 0.02, 0.06), (0, 0.09, 9.0)], strategy))[1]
    same = [int(round(v / 32768 * 32767)) for v in before[:, 0].tolist()]
    draw = random.Random(1337)
    for a, b in ((160, 480), (720, 800)):
        for i in range(a, b):
            x = {"silence": 0.0, "beep": 0.35 * math.sin(2 * math.pi * 1000 * i / rate)}.get(strategy)
            same[i] = round((draw.uniform(-0.35, 0.35) if x is None else x) * 32767)
    assert np.abs(after[:, 0] - np.array(same)).max() <= 1
    assert np.abs(after[:, 1].astype(int) - np.round(before[:, 1] / 32768 * 32767)).max() == 0
    with pytest.raises(ValueError, match="strategy"):
        audio.mask_wav(stereo(), [], "hum")


def test_redact_passes_nothing_unmasked(spark):
    files = spark.createDataFrame([(i, stereo()) for i in range(6)] + [(6, b"no file")], "file_id long, content binary")
    one = [(0, 0.0, 0.01)]
    plans = [(0, "completed", one), (1, "completed", []), (2, "failed", []), (3, "completed", [(5, 0.0, 1.0)]), (4, "completed", None), (5, "completed", [(0, 0.5, 0.2)]), (6, "completed", one)]
    kind = "file_id long, status string, intervals array<struct<channel:int,start_sec:double,end_sec:double>>"
    got = {r.file_id: r for r in audio.redact(files, spark.createDataFrame(plans[1:] + plans[:1], kind), "silence").collect()}
    assert {i: r.status for i, r in got.items()} == {0: "redacted", 1: "copied", 2: "failed", 3: "failed", 4: "copied", 5: "copied", 6: "failed"}
    assert all((r.content is None) == r.status.startswith("failed") for r in got.values())
    assert not audio.read_wav(got[0].content)[1][:80, 0].any()
    assert audio.redact(files, spark.createDataFrame([], kind)).where("content is not null").count() == 0


def test_running_sums_and_quantiles(spark):
    rng = np.random.default_rng(0)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 4, 500), rng.choice([1.0, 2.0, 2.5, *rng.normal(size=60)], 500), strict=True)] + [(9, None), (8, 1.0)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(7)
    numbered = order.running(df.where("v is not null").withColumn("id", F.monotonically_increasing_id()), [F.col("k"), F.col("v"), F.col("id")], name="n").orderBy("n").collect()
    assert [r.n for r in numbered] == list(range(501)) and [(r.k, r.v) for r in numbered] == sorted(r for r in rows if r[1] is not None)
    got = {r.k: r for r in order.quantiles(df, ["k"], "v", {"q0": 0.0, "q3": 0.3, "q99": 0.99}).collect()}
    assert set(got) == {0, 1, 2, 3, 8}
    for k, r in got.items():
        own = [v for x, v in rows if x == k]
        assert r.n == len(own) and np.allclose([r.q0, r.q3, r.q99], np.quantile(own, [0, 0.3, 0.99]))
    whole = order.quantiles(df, [], "v", {"m": 0.5}).collect()
    assert len(whole) == 1 and np.isclose(whole[0].m, np.median([v for _, v in rows if v is not None]))
    assert order.quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_robust_centroids_plain(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=5).tolist()) for k in range(4) for _ in range([1, 3, 6, 20][k])]
    for r in speakers.robust_centroids(spark.createDataFrame(rows, "label int, v array<double>"), ["label"]).collect():
        m = np.array([v for k, v in rows if k == r.label])
        m = m / np.linalg.norm(m, axis=1, keepdims=True)
        unit = lambda x: x / np.linalg.norm(x)
        c = unit(m.mean(axis=0))
        keep = m @ c >= np.quantile(m @ c, 0.2 if len(m) >= 5 else 0.1) - 1e-12 if len(m) >= 3 else np.ones(len(m), bool)
        c = unit(m[keep].mean(axis=0))
        assert np.allclose(r.centroid, c) and np.isclose(r.mean_sim, (m @ c).mean()) and np.isclose(r.min_sim, (m @ c).min())
        assert (r.n_used, r.n_segments) == (keep.sum(), len(m))


def test_leakage_groups(spark):
    pairs = [("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 3), ("d", 9), ("e", None), ("f", 7), ("g", 7), ("f", 7)]
    got = {r.call_id: r.split_group_id for r in speakers.leakage_groups(spark.createDataFrame(pairs, "call_id string, speaker int")).collect()}
    assert got == {"a": "leakgrp_000000", "b": "leakgrp_000000", "c": "leakgrp_000000", "f": "leakgrp_000001", "g": "leakgrp_000001", "d": "leakgrp_000002", "e": "leakgrp_000003"}


RULES = [
    ("Gracias por su llamada", "es"), ("¿Cuál es su número de teléfono?", "es"), ("Cual es su numero de telefono", "es"), ("Bueno.", "es"), ("Sí.", "es"), ("Muy bien.", "es"),
    ("Thank you for calling, how can I help you today?", "en"), ("Mm-hmm.", None), ("Okay.", None), ("", None), (None, None), ("the que", None), ("the ñ", "es"),
]
ES_MARKS, EN_MARKS = "gracias por su llamada cual es numero de telefono bueno si muy bien que".split(), "thank you for calling how help the today".split()


def test_language_rule(spark):
    marks = spark.createDataFrame([(w, "es") for w in ES_MARKS] + [(w, "en") for w in EN_MARKS], "w string, lang string")
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RULES)] * 2, "i int, text string")
    got = language.score(rows, marks).collect()
    assert len(got) == 2 * len(RULES)
    for r in got:
        assert r.code == RULES[r.i][1] and 0 <= r.sure <= 1 and (r.code is not None or r.sure == 0)


def test_learned_marks(spark):
    docs = spark.createDataFrame([(i, "es" if i % 2 else "en", "Mañana casa no" if i % 2 else "house no") for i in range(60)] + [(99, "fr", "maison"), (100, None, "nada"), (101, "es", None)], "doc_id long, lang string, text string")
    assert {(r.w, r.lang) for r in language.pair_marks(docs).collect()} == {("manana", "es"), ("casa", "es"), ("house", "en")}


def test_options(tmp_path, spark):
    text = "a:\n  b: 1\n  c:\n    d: [x, 2]\n# no\ne:\nf: 'g'\nh: 1.5\ni: true\nj: ~\n"
    assert config.parse(text) == {"a": {"b": 1, "c": {"d": ["x", 2]}}, "e": None, "f": "g", "h": 1.5, "i": True, "j": None}
    assert config.parse('{"a": {"b": [1]}}') == {"a": {"b": [1]}}
    base = {"a": {"b": 1, "c": 2}, "d": 3}
    assert config.merge(base, {"a": {"b": 5, "z": 1}, "y": 2}, {"d": None}) == {"a": {"b": 5, "c": 2}, "d": None} and base["d"] == 3
    assert config.config_hash({"a": 1, "b": 2}) == config.config_hash({"b": 2, "a": 1}) != config.config_hash({"a": 1, "b": 3})
    assert len(config.config_hash({})) == 16
    (tmp_path / "run.yaml").write_text("masking:\n  strategy: silence\n")
    assert config.load(spark, str(tmp_path / "run.yaml"))["masking"]["strategy"] == "silence"


def test_cache_is_built_again_if_broken(spark, tmp_path):
    root, cache = f"{tmp_path}/in", f"{tmp_path}/cache"
    spark.range(3).write.parquet(root)
    assert not publish.cached_scan(spark, root, cache, ("parquet",))[1]
    assert publish.cached_scan(spark, root, cache, ("parquet",))[1]
    for f in (tmp_path / "cache").glob("part-*"):
        f.write_bytes(b"broken")
    for f in (tmp_path / "cache").glob(".part-*"):
        f.unlink()
    files, cached = publish.cached_scan(spark, root, cache, ("parquet",))
    assert not cached and files.count() > 0 and publish.cached_scan(spark, root, cache, ("parquet",))[1]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["cache", "in"]


def test_parity_flags(spark):
    kind = "call_id string, segment_id string, duration_sec double, start_sample long, end_sample long, language string, alignment_status string, redacted_status string, pii_count int, intervals array<struct<start_sec:double,end_sec:double>>, m_transcript string"
    row = ("c1", "x_ch0_00000", 2.0, 0, 10, "es", "completed", "ok", 1, [(0.1, 0.4)], "hola")
    good = spark.createDataFrame([row], kind)
    inputs = spark.createDataFrame([("c1", 2.0, 2.1)], "call_id string, source_sec double, redacted_sec double")
    assert parity.audit(good, good, inputs, ("m",), good).where("not ok").count() == 0

    def bad(replay=good, **change):
        names = [f.split()[0] for f in kind.split(", ")]
        df = spark.createDataFrame([tuple(change.get(n, v) for n, v in zip(names, row, strict=True))], kind)
        return {r.check_name for r in parity.audit(df, good, inputs, ("m",), replay).where("not ok").collect()}

    assert bad(intervals=[]) == {"pii_is_masked"}
    assert bad(intervals=[(0.4, 0.1)]) == {"masks_are_upright"}
    assert bad(intervals=[(0.0, 2.0)]) == {"masks_are_targeted"}
    assert bad(intervals=[(-0.2, 0.1)]) == {"masks_stay_near"}
    assert bad(language=None) == {"languages"}  # one segment less of Spanish is within the slack
    assert bad(alignment_status="failed", redacted_status="partial") == {"alignments", "redactions"}
    assert bad(m_transcript=" \t") == {"models_cover"}
    assert bad(pii_count=0) == {"pii_is_found"}
    assert bad(end_sample=11) == {"replay_spans"}
    assert bad(segment_id="x_ch1_00000") == {"replay_spanish"}
    assert bad(call_id="c2") == {"calls_have_rows", "replay_segments", "replay_spanish"}


def test_consensus_null_confidence_and_blank(spark):
    kind = "segment_id string, model_name string, rank int, transcript string, norm string, error string, confidence double, duration_sec double"
    rows = [("s", "parakeet", 0, "one", "one", None, None, 3.0), ("s", "whisper", 1, "two", "two", None, 0.9, 3.0), ("t", "parakeet", 0, "\n\t\u00a0", "", None, 0.9, 3.0)]
    got = {r.segment_id: r for r in consensus.consensus(spark.createDataFrame(rows, kind)).collect()}
    assert (got["s"].selected_model, got["s"].score) == ("whisper", 0.9)
    assert (got["t"].method, got["t"].final_transcript) == ("failed_no_transcripts", "")


def test_word_distance_plain():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x, y = ([f"w{i}" for i in rng.integers(0, 6, int(rng.integers(0, 90)))] for _ in range(2))
        row = list(range(len(y) + 1))
        for i, w in enumerate(x, 1):
            corner, row[0] = row[0], i
            for j, v in enumerate(y, 1):
                corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (w != v))
        assert K.word_distance(" ".join(x), " ".join(y)) == row[-1]


def test_first_normal_form():
    assert K.normalise_first("The 21st, um, twenty five — OK I'm, mhm") == "the 20 5 okay i am mhm"
    assert K.normalise_first(None) == ""


def test_context_is_cut_with_a_mark(spark):
    rows = [(1, 0, 0, "hello"), (1, 1, 1, "x" * 3000), (1, 2, 1, "more"), (1, 3, 2, "  "), (2, 0, 0, "alone")]
    got = {(r.call_id, r.channel): r.context for r in context.other_channels(spark.createDataFrame(rows, "call_id long, turn int, channel int, text string")).collect()}
    assert got == {(1, 0): "Other channel 1:\n" + "x" * 2500 + "\n[TRUNCATED]", (1, 1): "Other channel 0:\nhello", (1, 2): "Other channel 0:\nhello\n\nOther channel 1:\n" + "x" * 2500 + "\n[TRUNCATED]", (2, 0): ""}


def test_speaker_fallback(spark, tmp_path):
    spark.createDataFrame([(5, 0, "user", "a"), (5, 1, "assistant", "b"), (6, 0, "user", "c")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(10, 3)], "vec_id long, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.segment_id: r.speaker for r in calls.jn_speaker(spark, str(tmp_path)).collect()}
    assert got == {"call_5_00000": "spk_3", "call_5_00001": "spk_fallback_5_ch1", "call_6_00000": "spk_fallback_6_ch0"}
