"""16-bit WAV as bytes: writing, clipping, masking; and files redacted by plans, as DataFrames.

Audio travels as (file_id, content) rows: a sink for it is a Parquet table, which Spark commits as a whole.
"""

from __future__ import annotations

import io
import random
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

STRATEGIES = ("silence", "beep", "noise")
TONE_HZ, GAIN, NOISE_SEED = 1000.0, 0.35, 1337
#: Frames that are masked at a time.
BLOCK = 1 << 18


def to_int16(x: np.ndarray) -> np.ndarray:
    return np.round(np.clip(np.asarray(x, dtype=np.float64), -1.0, 1.0) * 32767.0).astype("<i2")


def write_wav(frames: np.ndarray, rate: int) -> bytes:
    """A file of frames (n, channels) of 16 bits."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(frames.shape[1])
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.ascontiguousarray(frames, dtype="<i2").tobytes())
    return out.getvalue()


def open_wav(content: bytes) -> wave.Wave_read:
    w = wave.open(io.BytesIO(content))
    if w.getsampwidth() != 2:
        raise ValueError("only WAV of 16 bits is read")
    return w


def read_wav(content: bytes) -> tuple[int, np.ndarray]:
    with open_wav(content) as w:
        return w.getframerate(), np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())


def clip(content: bytes, channel: int, first: int, behind: int) -> bytes:
    """One channel's frames [first, behind) as a file of their own."""
    rate, frames = read_wav(content)
    if not 0 <= channel < frames.shape[1]:
        raise ValueError(f"channel {channel} of {frames.shape[1]}")
    return write_wav(frames[max(0, first) : behind, [channel]], rate)


def mask_wav(content: bytes, intervals: list[tuple[int, float, float]], strategy: str = "beep") -> bytes:
    """The file with (channel, start_sec, end_sec) silenced, or replaced by a tone in the file's phase, or by seeded noise.

    Samples pass through the range of floats, as all of the file's do.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    noise = random.Random(NOISE_SEED)
    with open_wav(content) as src:
        rate, channels, n = src.getframerate(), src.getnchannels(), src.getnframes()
        if bad := [c for c, _, _ in intervals if not 0 <= c < channels]:
            raise ValueError(f"channel {bad[0]} of {channels}")
        cuts = [(c, max(0, round(s * rate)), min(n, round(e * rate))) for c, s, e in intervals]
        drawn = {i: np.array([noise.uniform(-GAIN, GAIN) for _ in range(max(0, b - a))]) for i, (_, a, b) in enumerate(cuts)} if strategy == "noise" else {}
        out = []
        for at in range(0, n, BLOCK):
            block = np.clip(np.frombuffer(src.readframes(BLOCK), "<i2").reshape(-1, channels) / 32768.0, -1.0, 1.0)
            for i, (c, a, b) in enumerate(cuts):
                lo, hi = max(a, at), min(b, at + len(block))
                if lo < hi:
                    where = np.arange(lo, hi, dtype=np.float64)
                    block[lo - at : hi - at, c] = 0.0 if strategy == "silence" else GAIN * np.sin(2 * np.pi * TONE_HZ * (where / rate)) if strategy == "beep" else drawn[i][lo - a : hi - a]
            out.append(to_int16(block))
    return write_wav(np.concatenate(out) if out else np.zeros((0, channels), "<i2"), rate)


def render(files: DataFrame, rate: int = 16_000) -> DataFrame:
    """(file_id, content) from (file_id, channels: arrays of samples); shorter channels end in silence."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for own in pdf["channels"]:
                x = np.zeros((max(map(len, own)), len(own)))
                for i, c in enumerate(own):
                    x[: len(c), i] = c
                out.append(write_wav(to_int16(x), rate))
            yield pd.DataFrame({"file_id": pdf["file_id"], "content": out})

    kind = dict(files.dtypes)["file_id"]
    return files.select("file_id", "channels").mapInPandas(make, f"file_id {kind}, content binary")


def redact(files: DataFrame, plans: DataFrame, strategy: str = "beep") -> DataFrame:
    """(file_id, status, message, content) of files (file_id, content) by plans (file_id, status, intervals of channel, start_sec, end_sec).

    A failed or missing plan, and a file that can't be masked or comes out in another shape, has no content: nothing unmasked is passed on.
    An empty plan copies the file.
    """

    def one(content: bytes, status: str | None, intervals) -> tuple:
        if status != "completed":
            return "failed", "no completed plan", None
        try:
            with open_wav(content) as w:
                rate, frames = w.getframerate(), w.getnframes()
                shape, end = (rate, w.getnchannels(), frames), frames / rate
            cut = [(r["channel"], max(0.0, min(end, r["start_sec"])), max(0.0, min(end, r["end_sec"]))) for r in intervals if r["end_sec"] > r["start_sec"]]
            if not cut:
                return "copied", "", content
            masked = mask_wav(content, cut, strategy)
            with open_wav(masked) as w:
                same = (w.getframerate(), w.getnchannels(), w.getnframes()) == shape
        except (ValueError, EOFError, wave.Error) as e:
            return "failed", str(e)[:500] or type(e).__name__, None
        return ("redacted", "", masked) if same else ("failed_validation", "the masked file has another shape", None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [one(c, s, i if i is not None else []) for c, s, i in zip(pdf["content"], pdf["status"], pdf["intervals"], strict=True)]
            done = pd.DataFrame(rows, columns=["status", "message", "content"])
            done.insert(0, "file_id", pdf["file_id"].to_numpy())
            yield done

    kind = dict(files.dtypes)["file_id"]
    return files.select("file_id", "content").join(plans.select("file_id", "status", "intervals"), "file_id", "left").mapInPandas(run, f"file_id {kind}, status string, message string, content binary")
