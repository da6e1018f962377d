"""Interfaces to models that run elsewhere, with deterministic stand-ins."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.columns import parts as parts_of


class Recogniser(Protocol):
    """Loaded once a worker; transcribes rows of (segment_id, payload) in batches."""

    name: str

    def transcribe(self, payloads: list) -> list[tuple[str | None, float, str | None]]:
        """(transcript, confidence, error) of each payload."""


class Fixture:
    """Answers with the payload itself, or fails on those that hold a given word."""

    def __init__(self, name: str = "fixture", fails_on: str | None = None):
        self.name, self.fails_on = name, fails_on

    def transcribe(self, payloads: list) -> list[tuple[str | None, float, str | None]]:
        return [(None, 0.0, "refused") if self.fails_on and self.fails_on in (p or "") else (p or "", 0.9, None) for p in payloads]


def transcribe(segments: DataFrame, make: Callable[[], Recogniser], payload: str = "text", batch: int = 128) -> DataFrame:
    """(segment_id, model_name, transcript, confidence, error); a batch that raises is tried row by row, so one bad row fails alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            out = []
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                try:
                    got = model.transcribe(part["p"].to_list())
                except Exception:  # noqa: BLE001  any model failure becomes rows with an error
                    got = []
                    for p in part["p"]:
                        try:
                            got += model.transcribe([p])
                        except Exception as e:  # noqa: BLE001
                            got.append((None, 0.0, f"{type(e).__name__}: {e}"[:500]))
                out += [(s, model.name, *g) for s, g in zip(part["segment_id"], got, strict=True)]
            yield pd.DataFrame(out, columns=["segment_id", "model_name", "transcript", "confidence", "error"])

    return segments.select("segment_id", F.col(payload).alias("p")).mapInPandas(run, "segment_id string, model_name string, transcript string, confidence double, error string")


class Detector(Protocol):
    """Loaded once a worker; finds entities in texts of bounded length."""

    def find(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """(type, start, end, confidence) of the entities in each text."""


class CapitalWords:
    """A stand-in: words with a capital are names, the surer the longer."""

    def find(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        return [[("PERSON_NAME", m.start(), m.end(), min(1.0, len(m[0]) / 10)) for m in re.finditer(r"\b[A-Z][a-z]+\b", t)] for t in texts]


def text_windows(text: str, size: int = 1200, back: int = 150) -> list[tuple[int, int]]:
    """Windows of at most ``size`` characters, cut at a space in their second half if there is one, that reach ``back`` over each other."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text) and (space := text.rfind(" ", at + size // 2, end)) > 0:
            end = space
        out.append((at, end))
        at = end if end >= len(text) else max(end - back, at + 1)
    return out


def _slices(batches: Iterator[pd.DataFrame], text: str) -> Iterator[pd.DataFrame]:
    """Batches cut into rows of bounded text in all (``columns.parts``), so that what is found in them leaves a worker as it goes."""
    for pdf in batches:
        at = 0
        for part in parts_of([(x or "",) for x in pdf[text]]):
            yield pdf.iloc[at : at + len(part)]
            at += len(part)


def find_entities(rows: DataFrame, make: Callable[[], Detector], threshold: float, text: str = "text", size: int = 1200, back: int = 150, batch: int = 128) -> DataFrame:
    """(segment_id, type, start, end, confidence, error): whole texts in windows, entities at least so sure, of overlapping finds of a type the surest.

    A batch that raises is tried window by window; a window that raises gives its row an error and no entity.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in _slices(batches, "t"):
            parts = [(i, a, t[a:b]) for i, t in enumerate(pdf["t"]) for a, b in text_windows(t or "", size, back)]
            found: list[list[tuple[str, int, int, float]]] = [[] for _ in range(len(pdf))]
            wrong: dict[int, str] = {}
            for at in range(0, len(parts), batch):
                some = parts[at : at + batch]
                try:
                    got = model.find([t for _, _, t in some])
                except Exception:  # noqa: BLE001  any model failure becomes rows with an error
                    got = []
                    for i, _, t in some:
                        try:
                            got += model.find([t])
                        except Exception as e:  # noqa: BLE001
                            got.append([])
                            wrong[i] = f"{type(e).__name__}: {e}"[:500]
                for (i, a, _), own in zip(some, got, strict=True):
                    found[i] += [(k, a + s, a + e, c) for k, s, e, c in own if c >= threshold]
            out = []
            for i, key in enumerate(pdf["segment_id"]):
                kept: list[tuple[str, int, int, float]] = []
                for x in sorted(set(found[i]), key=lambda x: (-x[3], x[1], -x[2], x[0])) if i not in wrong else ():
                    if not any(k[0] == x[0] and k[1] < x[2] and x[1] < k[2] for k in kept):
                        kept.append(x)
                out += [(key, *x, None) for x in kept] + ([(key, None, None, None, None, wrong[i])] if i in wrong else [])
            yield pd.DataFrame(out, columns=["segment_id", "type", "start", "end", "confidence", "error"]).astype({"start": "Int32", "end": "Int32"})

    return rows.select("segment_id", F.col(text).alias("t")).mapInPandas(run, "segment_id string, type string, start int, end int, confidence double, error string")


class Labeller(Protocol):
    """Loaded once a worker; labels a transcript."""

    def label(self, transcript: str) -> tuple[str, str]:
        """(role, reason)."""


#: Roles of a call's sides, and the characters of a reason that are kept.
ROLES, REASON_CHARS = ("customer", "agent", "voicemail", "other"), 250


def label_sides(sides: DataFrame, make: Callable[[], Labeller], done: DataFrame | None = None, tries: int = 3) -> DataFrame:
    """(call_id, channel, role, reason, error) of sides (call_id, channel, transcript) that ``done`` doesn't have.

    Empty transcripts are ``unknown`` without asking, as is a role that isn't one of ROLES; a side whose every try raises is ``unknown`` with the error.
    """
    keys = ["call_id", "channel"]
    todo = sides if done is None else sides.join(done.select(*keys), keys, "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            out = []
            for t in pdf["transcript"]:
                role, reason, error = "unknown", "", None
                for _ in range(tries if t and t.strip() else 0):
                    try:
                        role, reason = model.label(t)
                    except Exception as e:  # noqa: BLE001  any model failure becomes a row with an error
                        error = f"{type(e).__name__}: {e}"[:500]
                    else:
                        error = None
                        break
                role = role.strip().lower()
                out.append((role if role in ROLES else "unknown", reason[:REASON_CHARS], error))
            got = pd.DataFrame(out, columns=["role", "reason", "error"])
            yield pd.concat([pdf[keys].reset_index(drop=True), got], axis=1)

    kinds = dict(sides.dtypes)
    return todo.select(*keys, "transcript").mapInPandas(run, f"call_id {kinds['call_id']}, channel {kinds['channel']}, role string, reason string, error string")


class ByLength:
    """A stand-in: the role is the transcript's length by threes."""

    def label(self, transcript: str) -> tuple[str, str]:
        return ("Customer ", "agent", "robot")[len(transcript) % 3], f"{len(transcript)} characters"
