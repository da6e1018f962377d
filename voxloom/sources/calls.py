"""Sources of call data: folder scans, side-car metadata, WAV headers."""

from __future__ import annotations

import io
import json
import wave
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings of audio files.
AUDIO = ("wav", "mp3", "flac", "m4a", "ogg", "opus", "aac", "wma", "webm")


def scan(spark: SparkSession, root: str, endings: tuple[str, ...] = AUDIO) -> DataFrame:
    """(path, length, modificationTime) of files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(endings) + "}").load(root)
    return files.select("path", "length", "modificationTime")


def records(files: DataFrame, root: str, fingerprint: str = "path") -> DataFrame:
    """Ids of files: relative path, call (its folder if the file is called audio), year, file_id, duplicate group.

    fingerprint: path, metadata (path, size and time), or content (needs the column).
    """
    rel = F.regexp_replace(F.regexp_replace("path", r"^file:/+", "/"), "^" + root.rstrip("/").replace(".", r"\.") + "/", "")
    parts = F.split(rel, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    year = F.when((F.size(parts) > 1) & parts[0].rlike(r"^\d{4}$"), parts[0]).otherwise("unknown")
    call = F.when((stem == "audio") & (F.size(parts) > 1), F.try_element_at(parts, F.lit(-2))).otherwise(stem)
    mark = {
        "path": lambda: F.sha2(rel, 256),
        "metadata": lambda: F.sha2(F.concat_ws(":", rel, "length", F.unix_micros("modificationTime").cast("string")), 256),
        "content": lambda: F.sha2(F.col("content"), 256),
    }[fingerprint]()
    rows = files.withColumns({"relative_path": rel, "call_id": call, "year": year, "content_hash": mark})
    rows = rows.withColumn("file_id", F.substring(F.sha2(F.concat_ws(":", "relative_path", "content_hash"), 256), 1, 24))
    return rows.withColumn("duplicate_group_id", F.substring("content_hash", 1, 24) if fingerprint == "content" else F.col("file_id"))


def flatten_json(text: Column) -> Column:
    """A nested JSON object as a map from dotted keys to strings; text that isn't one as ``metadata_error``."""

    @F.pandas_udf("map<string,string>")
    def flat(texts: pd.Series) -> pd.Series:
        def walk(x, prefix: str, out: dict) -> dict:
            if isinstance(x, dict):
                for k, v in x.items():
                    walk(v, f"{prefix}.{k}" if prefix else str(k), out)
            else:
                out[prefix] = x if isinstance(x, str) else json.dumps(x)
            return out

        def one(t):
            try:
                return walk(json.loads(t), "", {})
            except (TypeError, ValueError) as e:
                return {"metadata_error": str(e)[:200]}

        return pd.Series([one(t) for t in texts], dtype=object)

    return flat(text)


def first_matching(meta: Column, words: tuple[str, ...]) -> Column:
    """The first value that isn't blank of a key that holds one of the words, whatever their case."""
    hit = F.map_filter(meta, lambda k, v: F.lower(k).rlike("|".join(w.lower() for w in words)) & (F.trim(v) != ""))
    return F.try_element_at(F.map_values(hit), F.lit(1))


def wav_headers(files: DataFrame) -> DataFrame:
    """Rate, channels and duration of WAV files (path, content)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        out.append((path, w.getframerate(), w.getnchannels(), w.getnframes() / w.getframerate(), None))
                except (wave.Error, EOFError) as e:
                    out.append((path, None, None, None, str(e) or "end of file"))
            yield pd.DataFrame(out, columns=["path", "sample_rate", "channels", "duration_sec", "error"])

    return files.select("path", "content").mapInPandas(read, "path string, sample_rate int, channels int, duration_sec double, error string")
