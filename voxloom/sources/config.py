"""Options of a run: defaults, files and overrides in one nested mapping, with a hash that names it."""

from __future__ import annotations

import hashlib
import json
from copy import deepcopy
from typing import Any

from pyspark.sql import DataFrame, SparkSession

#: Options with their defaults; a file or an override may set these, by section.
DEFAULTS: dict[str, Any] = {
    "consensus": {"min_models": 3, "models": ["parakeet", "whisper", "qwen", "cohere", "granite"]},
    "discovery": {"hash_mode": "path", "num_shards": 1, "shard_index": None},
    "masking": {"strategy": "beep", "pad_before": 0.08, "pad_after": 0.12, "merge_gap": 0.02},
    "speaker": {"edge": 0.92, "component": 0.90, "compact": 0.72, "neighbours": 10},
    "languages": ["en", "es"],
}


def parse(text: str) -> dict[str, Any]:
    """A mapping from JSON, or from lines ``key: value`` nested by their indents (numbers, booleans, null, [lists], strings)."""
    try:
        found = json.loads(text)
    except ValueError:
        found = _lines(text)
    if not isinstance(found, dict):
        raise ValueError("options are a mapping")
    return found


def _lines(text: str) -> dict[str, Any]:
    rows = [(len(x) - len(x.lstrip(" ")), *x.strip().partition(":")[::2]) for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#")]

    def block(at: int, depth: int) -> tuple[dict[str, Any], int]:
        out: dict[str, Any] = {}
        while at < len(rows) and rows[at][0] >= depth:
            indent, key, value = rows[at]
            at += 1
            if value.strip():
                out[key] = _value(value.strip())
            elif at < len(rows) and rows[at][0] > indent:
                out[key], at = block(at, rows[at][0])
            else:
                out[key] = None
        return out, at

    return block(0, 0)[0]


def _value(text: str) -> Any:
    if text.startswith("[") and text.endswith("]"):
        return [_value(x.strip()) for x in text[1:-1].split(",") if x.strip()]
    for known, value in (("true", True), ("false", False), ("null", None), ("none", None), ("~", None)):
        if text.lower() == known:
            return value
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text.strip("'\"")


def merge(base: dict[str, Any], *changes: dict[str, Any]) -> dict[str, Any]:
    """The base with changes applied in order, section by section; options that the base doesn't have are left out."""
    out = deepcopy(base)
    for change in changes:
        for key, value in change.items():
            if key not in out:
                continue
            out[key] = merge(out[key], value or {}) if isinstance(out[key], dict) else value
    return out


def config_hash(options: dict[str, Any]) -> str:
    """Sixteen hex digits that depend on the options' values, not on their order."""
    return hashlib.sha256(json.dumps(options, sort_keys=True, default=str).encode()).hexdigest()[:16]


def flat(options: dict[str, Any], prefix: str = "") -> list[tuple[str, str]]:
    out = []
    for key, value in sorted(options.items()):
        name = f"{prefix}.{key}" if prefix else key
        out += flat(value, name) if isinstance(value, dict) else [(name, json.dumps(value))]
    return out


def load(spark: SparkSession, path: str, overrides: dict[str, Any] | None = None) -> dict[str, Any]:
    """Defaults, then the file (on any file system that Spark reads), then the overrides."""
    text = spark.read.text(path, wholetext=True).first()
    return merge(DEFAULTS, parse(text[0]) if text else {}, overrides or {})


def as_table(spark: SparkSession, options: dict[str, Any]) -> DataFrame:
    return spark.createDataFrame(flat(options), "option string, value string")
