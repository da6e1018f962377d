"""Audio as rows of numbered blocks of samples: masked, faded, checked and put together without a file in one cell.

A file is one row of its header (file_id, rate, channels, frames) and rows (file_id, block, samples) of ``FRAMES`` frames each, 16 bits, channels side by side. Intervals are dealt
to the blocks that they touch; tones follow the place in the file, and noise goes on over blocks, so blocks are masked apart from each other and give the bytes that the
whole file would. A file with any share of all samples is spread.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.audio import GAIN, NOISE_SEED, STRATEGIES, TONE_HZ, open_wav, to_int16

#: Frames of a block; bytes of samples, and rows, that leave a worker at a time.
FRAMES, PART_BYTES, PART_ROWS = 1 << 18, 1 << 24, 10_000
#: Fixed values of the faded tone: gain of the file's peak, ramp in milliseconds.
FADE_GAIN, FADE_MS = 0.25, 8
#: Fixed values of the checks: seconds between lengths of a masked file and of a rebuilt call, difference of a sample.
PAIR_SEC, CALL_SEC, SAMPLE = 0.010, 0.05, 5e-4


def _together(rows: Iterator[tuple], columns: list[str], binary: str) -> Iterator[pd.DataFrame]:
    """Rows in frames that hold a bounded number of bytes, or one row: small blocks share a frame."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[columns.index(binary)])
        if size >= PART_BYTES or len(held) >= PART_ROWS:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def from_files(files: DataFrame, frames: int = FRAMES) -> tuple[DataFrame, DataFrame]:
    """Headers and blocks of WAV files (file_id, content) of 16 bits."""
    kind = dict(files.dtypes)["file_id"]

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, c in zip(pdf["file_id"], pdf["content"], strict=True):
                with open_wav(c) as w:
                    rows.append((i, w.getframerate(), w.getnchannels(), w.getnframes()))
            yield pd.DataFrame(rows, columns=["file_id", "rate", "channels", "frames"])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for i, c in zip(pdf["file_id"], pdf["content"], strict=True):
                with open_wav(c) as w:
                    for b in range(-(-w.getnframes() // frames)):
                        yield i, b, w.readframes(frames)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(each(batches), ["file_id", "block", "samples"], "samples")

    rows = files.select("file_id", "content").where(F.col("content").isNotNull())
    return rows.mapInPandas(heads, f"file_id {kind}, rate int, channels int, frames long"), rows.mapInPandas(cut, f"file_id {kind}, block long, samples binary")


def _noise(skip: int, n: int, gain: float) -> np.ndarray:
    """n numbers of the seeded noise after so many: those that the generator of the standard library draws."""
    _, state, _ = random.Random(NOISE_SEED).getstate()
    r = np.random.RandomState()
    r.set_state(("MT19937", np.array(state[:-1], np.uint32), state[-1]))
    for at in range(0, skip, 1 << 20):
        r.random_sample(min(1 << 20, skip - at))
    return -gain + 2 * gain * r.random_sample(n)


def dealt(heads: DataFrame, intervals: DataFrame, frames: int = FRAMES, rounding=F.bround) -> DataFrame:
    """(file_id, block, cuts of channel, first, behind, drawn) from (file_id, channel, start_sec, end_sec): the cuts that touch each block, in order of the plan.

    ``first`` and ``behind`` are frames of the file; ``drawn`` numbers of noise come before a cut. An interval of a channel that the file hasn't fails its job.
    """
    rows = intervals.join(heads, "file_id")
    edge = lambda c: F.greatest(F.lit(0), F.least(F.col("frames"), rounding(F.col(c) * F.col("rate")).cast("long")))
    right = F.when((F.col("channel") < 0) | (F.col("channel") >= F.col("channels")), F.raise_error(F.concat(F.lit("channel "), F.col("channel").cast("string"), F.lit(" of "), F.col("channels").cast("string"))).cast("int")).otherwise(F.col("channel"))
    cuts = rows.select("file_id", "place", right.alias("channel"), edge("start_sec").alias("first"), edge("end_sec").alias("behind"))
    # One file's intervals fit one row: a plan is one.
    plan = F.array_sort(F.collect_list(F.struct("place", "channel", "first", "behind")))
    size = lambda x: F.greatest(F.lit(0).cast("long"), x["behind"] - x["first"])
    by = cuts.groupBy("file_id").agg(plan.alias("p"))
    drawn = F.transform("p", lambda x, i: F.struct(x["channel"].alias("channel"), x["first"].alias("first"), x["behind"].alias("behind"), F.aggregate(F.slice("p", F.lit(1), i), F.lit(0).cast("long"), lambda a, y: a + size(y)).alias("drawn")))
    each = by.select("file_id", F.posexplode(drawn).alias("n", "c")).where("c.behind > c.first")
    touched = F.sequence(F.floor(F.col("c.first") / frames), F.floor((F.col("c.behind") - 1) / frames))
    return each.select("file_id", F.explode(touched).alias("block"), F.struct("n", "c.channel", "c.first", "c.behind", "c.drawn").alias("c")).groupBy("file_id", "block").agg(F.array_sort(F.collect_list("c")).alias("cuts"))


def _changed(blocks: DataFrame, heads: DataFrame, cuts: DataFrame, change, frames: int, facts: list[str]) -> DataFrame:
    """Blocks with ``change(block as floats, its first frame, cuts, facts of its file)`` applied where there are cuts; others pass as they are."""
    rows = blocks.join(heads.select("file_id", *facts), "file_id").join(cuts, ["file_id", "block"], "left")
    kind = dict(blocks.dtypes)["file_id"]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                samples = r.samples
                if r.cuts is not None and len(r.cuts):
                    x = np.clip(np.frombuffer(samples, "<i2").reshape(-1, r.channels) / 32768.0, -1.0, 1.0)
                    change(x, r.block * frames, r.cuts, r)
                    samples = to_int16(x).tobytes()
                elif r.redone:  # samples of a file that is masked pass through floats, as all of it do
                    samples = to_int16(np.clip(np.frombuffer(samples, "<i2") / 32768.0, -1.0, 1.0)).tobytes()
                yield r.file_id, r.block, samples

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(each(batches), ["file_id", "block", "samples"], "samples")

    masked = cuts.select("file_id").distinct().withColumn("redone", F.lit(True))
    rows = rows.join(masked, "file_id", "left").withColumn("redone", F.coalesce("redone", F.lit(False)))
    return rows.select("file_id", "block", "samples", "cuts", "redone", *facts).mapInPandas(run, f"file_id {kind}, block long, samples binary")


def mask(heads: DataFrame, blocks: DataFrame, intervals: DataFrame, strategy: str = "beep", frames: int = FRAMES) -> DataFrame:
    """Blocks with intervals (file_id, place, channel, start_sec, end_sec) silenced, or replaced by a tone in the file's phase or by seeded noise; ``place`` orders a file's."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")

    def change(x: np.ndarray, at: int, cuts, r) -> None:
        for c in cuts:
            lo, hi = max(c["first"], at), min(c["behind"], at + len(x))
            if strategy == "silence":
                x[lo - at : hi - at, c["channel"]] = 0.0
            elif strategy == "beep":
                x[lo - at : hi - at, c["channel"]] = GAIN * np.sin(2 * np.pi * TONE_HZ * (np.arange(lo, hi, dtype=np.float64) / r.rate))
            else:
                x[lo - at : hi - at, c["channel"]] = _noise(c["drawn"] + lo - c["first"], hi - lo, GAIN)

    return _changed(blocks, heads, dealt(heads, intervals, frames), change, frames, ["rate", "channels"])


def fade(heads: DataFrame, blocks: DataFrame, spans: DataFrame, hz: float = TONE_HZ, gain: float = FADE_GAIN, ms: float = FADE_MS, frames: int = FRAMES) -> DataFrame:
    """Blocks with spans (file_id, place, start_sec, end_sec) of all channels replaced by a tone of a share of the file's peak, which starts with the span and fades in and out."""

    def loud(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"file_id": pdf["file_id"], "peak": [int(np.abs(np.frombuffer(s, "<i2").astype(np.int32)).max(initial=0)) for s in pdf["samples"]]})

    kind = dict(blocks.dtypes)["file_id"]
    peaks = blocks.select("file_id", "samples").mapInPandas(loud, f"file_id {kind}, peak int").groupBy("file_id").agg(F.max("peak").alias("peak"))
    facts = heads.join(peaks, "file_id", "left")

    def change(x: np.ndarray, at: int, cuts, r) -> None:
        amp = gain * (r.peak / 32768.0 if r.peak else 1.0)
        for c in cuts:
            lo, hi, n = max(c["first"], at), min(c["behind"], at + len(x)), c["behind"] - c["first"]
            place = np.arange(lo, hi) - c["first"]
            tone = amp * np.sin(2 * np.pi * hz * (place / r.rate))
            if n > 2 * (ramp := max(1, int(r.rate * ms / 1000))):
                up = np.linspace(0, 1, ramp)
                shape = np.concatenate([up, up[::-1]])
                # The first and last frames lie on the ramp, the others keep the tone.
                tone = tone * np.where(place < ramp, shape[np.minimum(place, ramp - 1)], np.where(place >= n - ramp, shape[np.clip(place - n + 2 * ramp, 0, 2 * ramp - 1)], 1.0))
            x[lo - at : hi - at] = tone[:, None]

    cuts = dealt(heads, spans.withColumn("channel", F.lit(0)), frames, F.floor)
    return _changed(blocks, facts, cuts, change, frames, ["rate", "channels", "peak"])


def heard(blocks: DataFrame, heads: DataFrame, of: str = "channel") -> DataFrame:
    """(file_id, channel, loud, energy): sums of absolute and of squared samples."""
    kind = dict(blocks.dtypes)["file_id"]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, s, n in zip(pdf["file_id"], pdf["samples"], pdf["channels"], strict=True):
                x = np.frombuffer(s, "<i2").reshape(-1, n).astype(np.int64)
                rows += zip([i] * n, range(n), np.abs(x).sum(axis=0).tolist(), (x * x).sum(axis=0).tolist(), strict=True)
            yield pd.DataFrame(rows, columns=["file_id", of, "loud", "energy"])

    rows = blocks.join(heads.select("file_id", "channels"), "file_id").mapInPandas(sums, f"file_id {kind}, {of} int, loud long, energy long")
    return rows.groupBy("file_id", of).agg(F.sum("loud").alias("loud"), F.sum("energy").alias("energy"))


def pairs(source: DataFrame, output: DataFrame, tolerance: float = PAIR_SEC) -> DataFrame:
    """(file_id, ok, and each check) of the headers of files and of what became of them; a file without an output fails."""
    sec = lambda: F.col("frames") / F.col("rate")
    a = source.select("file_id", sec().alias("sa"), F.col("channels").alias("ca"), F.col("rate").alias("ra"))
    b = output.select("file_id", sec().alias("sb"), F.col("channels").alias("cb"), F.col("rate").alias("rb"))
    checks = {"duration_ok": F.abs(F.col("sa") - F.col("sb")) <= tolerance + 1e-12, "channels_ok": F.col("ca") == F.col("cb"), "rate_ok": F.col("ra") == F.col("rb")}
    rows = a.join(b, "file_id", "left").select("file_id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    return rows.withColumn("ok", F.col("duration_ok") & F.col("channels_ok") & F.col("rate_ok"))


def rebuilt(clips: DataFrame, heads: DataFrame, frames: int = FRAMES) -> DataFrame:
    """(file_id, block, samples, doubled, holes): files put together from clips (file_id, channel, first, samples of 16 bits) by their first frame, a block at a time.

    Clips add up where they overlap, within full scale; what lies beyond the file's frames goes. ``doubled`` and ``holes`` count a block's samples with several clips and with none.
    """
    kind = dict(heads.dtypes)["file_id"]

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                x = np.frombuffer(r.samples, "<i2")
                lo, hi = max(0, -r.first), min(len(x), r.frames - r.first)
                while lo < hi:
                    block, at = divmod(r.first + lo, frames)
                    n = min(hi - lo, frames - at)
                    yield r.file_id, block, r.channel, at, x[lo : lo + n].tobytes()
                    lo += n

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(stretches(batches), ["file_id", "block", "channel", "at", "part"], "part")

    parts = clips.join(heads.select("file_id", "frames"), "file_id").mapInPandas(cut, f"file_id {kind}, block long, channel int, at long, part binary")
    every = heads.where("frames > 0").select("file_id", "channels", "frames", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("frames") - 1) / frames))).alias("block"))
    # A block's clips are as many as lie on it; blocks without any are holes.
    by = every.join(parts.groupBy("file_id", "block").agg(F.collect_list(F.struct("channel", "at", "part")).alias("parts")), ["file_id", "block"], "left")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                n = min(frames, r.frames - r.block * frames)
                x, held = np.zeros((n, r.channels)), np.zeros((n, r.channels), np.int32)
                for p in r.parts if r.parts is not None else []:
                    s = np.frombuffer(p["part"], "<i2") / 32768.0
                    x[p["at"] : p["at"] + len(s), p["channel"]] += s
                    held[p["at"] : p["at"] + len(s), p["channel"]] += 1
                q = np.clip(np.round(x * 32768.0), -32768, 32767).astype("<i2")
                yield r.file_id, r.block, q.tobytes(), int((held > 1).sum()), int((held == 0).sum())

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(whole(batches), ["file_id", "block", "samples", "doubled", "holes"], "samples")

    return by.mapInPandas(build, f"file_id {kind}, block long, samples binary, doubled long, holes long")


def placement(built: DataFrame, blocks: DataFrame, heads: DataFrame, expected: Column | None = None, tolerance: float = SAMPLE, seconds: float = CALL_SEC) -> DataFrame:
    """(file_id, max_error, bad, doubled, holes, duration_ok, ok): rebuilt blocks against those of the source: the largest difference, samples beyond the tolerance, and the length."""
    kind = dict(built.dtypes)["file_id"]

    def differ(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                a, b = (np.frombuffer(s, "<i2").astype(np.int32) if s is not None else np.zeros(0, np.int32) for s in (r.samples, r.theirs))
                n = min(len(a), len(b))
                d = np.abs(a[:n] - b[:n]) / 32768.0
                rows.append((r.file_id, float(d.max(initial=0.0)), int((d > tolerance).sum()), r.doubled, r.holes, len(a), len(b)))
            yield pd.DataFrame(rows, columns=["file_id", "max_error", "bad", "doubled", "holes", "mine", "whole"])

    both = built.join(blocks.select("file_id", "block", F.col("samples").alias("theirs")), ["file_id", "block"], "full").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("doubled", "holes")})
    rows = both.mapInPandas(differ, f"file_id {kind}, max_error double, bad long, doubled long, holes long, mine long, whole long")
    by = rows.groupBy("file_id").agg(F.max("max_error").alias("max_error"), *[F.sum(c).alias(c) for c in ("bad", "doubled", "holes", "mine", "whole")])
    done = by.join(heads.select("file_id", "rate", "channels"), "file_id")
    length = F.abs(F.col("mine") - F.col("whole")) / F.col("channels") / F.col("rate") <= seconds
    return done.select("file_id", "max_error", "bad", "doubled", "holes", length.alias("duration_ok"), (length & (F.col("bad") == 0)).alias("ok"))
