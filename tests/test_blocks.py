"""Audio in blocks against whole files."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_brute import check
from voxloom.operators import audio
from voxloom.operators import blocks as BL

SF = "/root/testdata/sf0.001"


def wav(n, channels, rate=8000, seed=0):
    rng = np.random.default_rng(seed)
    return audio.write_wav(rng.integers(-32768, 32767, (n, channels), endpoint=True).astype("<i2"), rate)


def joined(rows):
    return b"".join(bytes(r.samples) for r in sorted(rows, key=lambda r: r.block))


@pytest.mark.parametrize("strategy", ["silence", "beep", "noise"])
def test_blocks_give_the_whole_files_bytes(spark, strategy):
    files = {"a": wav(1000, 2), "b": wav(137, 1, seed=1), "c": wav(50, 2, seed=2), "d": wav(0, 1)}
    plan = {"a": [(0, 0.01, 0.07), (1, 0.02, 0.11), (0, 0.05, 0.2), (1, 0.3, 0.1)], "b": [(0, 0.0, 9.0)], "c": []}
    df = spark.createDataFrame([(k, v) for k, v in files.items()], "file_id string, content binary")
    cuts = spark.createDataFrame([(k, i, *x) for k, own in plan.items() for i, x in enumerate(own)], "file_id string, place int, channel int, start_sec double, end_sec double")
    heads, blocks = BL.from_files(df, 64)
    by = {}
    for r in BL.mask(heads, blocks, cuts, strategy, 64).collect():
        by.setdefault(r.file_id, []).append(r)
    assert len(by["a"]) == 16 and "d" not in by
    for k in "abc":
        with audio.open_wav(audio.mask_wav(files[k], plan[k], strategy) if plan[k] else files[k]) as w:
            assert joined(by[k]) == w.readframes(w.getnframes())
    with pytest.raises(Exception, match="channel 2 of 2"):
        BL.mask(heads, blocks, cuts.withColumn("channel", F.lit(2)), strategy, 64).collect()
    with pytest.raises(ValueError, match="unknown strategy"):
        BL.mask(heads, blocks, cuts, "hum")


def test_faded_tones(spark):
    """The tone of a whole file: a quarter of its peak, from the span's start, with ramps."""
    files = {"a": wav(700, 2), "b": audio.write_wav(np.zeros((90, 1), "<i2"), 8000)}
    spans = {"a": [(0.01, 0.06), (0.07, 0.072)], "b": [(0.0, 0.005)]}
    df = spark.createDataFrame([(k, v) for k, v in files.items()], "file_id string, content binary")
    cuts = spark.createDataFrame([(k, i, *x) for k, own in spans.items() for i, x in enumerate(own)], "file_id string, place int, start_sec double, end_sec double")
    heads, blocks = BL.from_files(df, 50)
    by = {}
    for r in BL.fade(heads, blocks, cuts, frames=50).collect():
        by.setdefault(r.file_id, []).append(r)
    for k, own in spans.items():
        rate, x = audio.read_wav(files[k])
        x = x / 32768.0
        amp, ramp = 0.25 * (np.abs(x).max() or 1.0), int(rate * 8 / 1000)
        for s, e in own:
            a, b = int(s * rate), min(len(x), int(e * rate))
            tone = amp * np.sin(2 * np.pi * 1000 * np.arange(b - a) / rate)
            if b - a > 2 * ramp:
                tone[:ramp] *= np.linspace(0, 1, ramp)
                tone[-ramp:] *= np.linspace(1, 0, ramp)
            x[a:b] = tone[:, None]
        got = np.frombuffer(joined(by[k]), "<i2").reshape(x.shape)
        assert np.abs(got - audio.to_int16(x).astype(int)).max() <= 1


def test_rebuilt_files(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-9000, 9000, (500, 2)).astype("<i2")
    whole = spark.createDataFrame([("a", audio.write_wav(x, 100)), ("e", wav(0, 1))], "file_id string, content binary")
    heads, blocks = BL.from_files(whole, 64)
    cuts = [(c, s, x[s : s + 70, c].tobytes()) for c in (0, 1) for s in range(0, 500, 70)]
    clips = lambda rows: spark.createDataFrame([("a", *r) for r in rows], "file_id string, channel int, first long, samples binary")
    look = lambda rows: BL.placement(BL.rebuilt(clips(rows), heads, 64), blocks, heads).collect()[0]
    r = look(cuts)
    assert (r.ok, r.duration_ok, r.bad, r.doubled, r.holes) == (True, True, 0, 0, 0) and r.max_error <= BL.SAMPLE
    moved = [*cuts[:3], (cuts[3][0], cuts[3][1] + 1, cuts[3][2]), *cuts[4:]]
    r = look(moved)
    assert not r.ok and r.bad > 50 and r.doubled == 1 and r.holes == 1 and r.duration_ok
    r = look(cuts[:-1])
    assert not r.ok and r.holes == 10
    r = look([*cuts, (0, -3, x[:10, 0].tobytes()), (0, 499, x[:10, 0].tobytes())])
    assert not r.ok and r.doubled == 8


data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")


@pytest.fixture(scope="module")
def sound(spark):
    """Channels of each call as whole numbers."""
    out = {}
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        out.setdefault(r.vec_id // 2, {})[r.vec_id % 2] = audio.to_int16(np.asarray(r.embedding, float)).astype(int)
    return {k: np.stack([v[c] for c in sorted(v)], axis=1) for k, v in out.items()}


@data
def test_tones_of_the_tables(spark, sound):
    beep, fade = [], []
    for k, q in sound.items():
        x = q / 32768.0
        y = x.copy()
        y[10:30, 0] = [0.35 * math.sin(2 * math.pi * 1000 * i / 16000) for i in range(10, 30)]
        beep += [(k, c, int((audio.to_int16(y[:, c]).astype(int) ** 2).sum())) for c in range(x.shape[1])]
        tone = 0.25 * (np.abs(x).max() or 1.0) * np.sin(2 * np.pi * 1000 * np.arange(40) / 16000)
        tone[:8] *= np.linspace(0, 1, 8)
        tone[-8:] *= np.linspace(1, 0, 8)
        x[10:50] = tone[:, None]
        z = audio.to_int16(x).astype(int)
        fade += [(k, c, int(np.abs(z[:, c]).sum()), int((z[:, c] ** 2).sum())) for c in range(x.shape[1])]
    check(spark, "MSK-BEEP", ["file_id", "channel", "energy"], beep)
    check(spark, "MSK-FADE", ["file_id", "channel", "loud", "energy"], fade)


@data
def test_checks_of_the_tables(spark, sound):
    want = []
    for k, q in sound.items():
        n, c = q.shape
        there = k % 11 != 10
        d, ch, r = there and not (k % 5 == 1 and abs(n / 16000 * 7) > 0.010) and not (k % 5 == 3 and abs(n / 16000 - n / 8000) > 0.010), there and not (k % 5 == 2 and c != 1), there and k % 5 != 3
        want.append((k, d, ch, r, d and ch and r))
    check(spark, "VAL-PAIR", ["file_id", "duration_ok", "channels_ok", "rate_ok", "ok"], want)
    assert {w[1:4] for w in want} >= {(True, True, True), (False, True, True), (True, False, True), (True, True, False), (False, False, False)}
    want = []
    for k, q in sound.items():
        n, channels = q.shape
        x, held = np.zeros((n, channels)), np.zeros((n, channels), int)
        for c in range(channels):
            for s in range(0, n, 13):
                if s == 39 and k % 9 == 4:
                    continue
                at = s - 5 if s == 39 and k % 9 == 2 else s
                part = q[s : s + 13, c]
                x[at : at + len(part), c] += part
                held[at : at + len(part), c] += 1
        e = np.abs(np.clip(x, -32768, 32767) - q) / 32768.0
        bad = int((e > 5e-4).sum())
        want.append((k, float(e.max()), bad, int((held > 1).sum()), int((held == 0).sum()), True, bad == 0))
    check(spark, "VAL-RECON", ["file_id", "max_error", "bad", "doubled", "holes", "duration_ok", "ok"], want)
    assert {w[-1] for w in want} == {True, False}


def test_small_blocks_share_a_frame(monkeypatch):
    rows = [(i, 0, bytes(4)) for i in range(1000)]
    frames = list(BL._together(iter(rows), ["file_id", "block", "samples"], "samples"))
    assert len(frames) == 1 and [tuple(r) for r in frames[0].itertuples(index=False)] == rows
    monkeypatch.setattr(BL, "PART_BYTES", 40)
    assert [len(f) for f in BL._together(iter(rows), ["file_id", "block", "samples"], "samples")] == [10] * 100
    assert list(BL._together(iter([]), ["file_id", "block", "samples"], "samples")) == []
