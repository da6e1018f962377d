"""Scans that were quadratic, against their plain versions, and on long hostile texts."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import fixed
from voxloom.functions import kernels as K
from voxloom.operators import intervals as IV
from voxloom.operators import state
from voxloom.operators.order import Scans

RNG = np.random.default_rng(3)


def random_text(alphabet, most):
    return "".join(RNG.choice(list(alphabet), int(RNG.integers(0, most))))


def test_emails_by_their_at():
    pattern = re.compile(next(p for kind, p, *_ in fixed.PATTERNS if kind == "EMAIL"))
    for _ in range(20_000):
        t = random_text("aB1.@-%é _ſ", 14) + ("x@y.zz" if RNG.random() < 0.2 else "")
        assert [m.span() for m in K._matches("EMAIL", pattern, t)] == [m.span() for m in pattern.finditer(t)], t


def plain_json(text):
    value = re.sub(r"```(?:json)?", "", text or "")
    for start in (i for i, c in enumerate(value) if c == "{"):
        depth, quoted, skip = 0, False, False
        for i in range(start, len(value)):
            c = value[i]
            if skip:
                skip = False
            elif c == "\\":
                skip = quoted
            elif c == '"':
                quoted = not quoted
            elif not quoted:
                depth += (c == "{") - (c == "}")
                if depth == 0:
                    return re.sub(r",\s*([}\]])", r"\1", value[start : i + 1])
    return None


def test_json_plain():
    for _ in range(20_000):
        t = random_text('{}{}"\\a,', 14)
        assert K.json_object(t) == plain_json(t), t


def plain_resolve(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (s["start"], s["start"] - s["end"], -s["confidence"])):
        clash = next((i for i, k in enumerate(kept) if s["start"] < k["end"] and k["start"] < s["end"]), None)
        if clash is None:
            kept.append(s)
        elif s["confidence"] > kept[clash]["confidence"]:
            kept[clash] = s
    return sorted(kept, key=lambda s: s["start"])


def test_resolve_plain():
    for _ in range(4000):
        spans = [{"start": int(a), "end": int(a + RNG.integers(0, 6)), "confidence": float(RNG.integers(0, 4))} for a in RNG.integers(0, 20, int(RNG.integers(0, 14)))]
        assert K.resolve(spans) == plain_resolve(spans)


def test_long_hostile_texts():
    n = 200_000
    spans = [{"start": i, "end": i + int(RNG.integers(1, 9)), "confidence": float(RNG.random())} for i in range(n)]
    for run in (lambda: K.resolve(spans), lambda: K.json_object("{" * n), lambda: K.json_object('{"' * n), lambda: K.detect("a." * n), lambda: K.detect("member" + " " * n + "!"), lambda: K.detect("a@" * n)):
        began = time.process_time()
        run()
        assert time.process_time() - began < 10


@pytest.fixture
def ranges(spark):
    """Ranges of few rows stay apart."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize("kind", ["max", "sum"])
def test_scans_restart_at_keys(spark, kind, ranges):
    """A key with two thirds of the rows, null keys and null values."""
    rows = [(None if i % 9 == 0 else "hot" if i % 3 else f"k{i % 7}", int(RNG.integers(0, 10**6)) * 1000 + i, None if i % 11 == 0 else int(RNG.integers(0, 100))) for i in range(900)]
    df = spark.createDataFrame(rows, "key string, at long, v long").repartition(8)
    got = Scans(df, ["key"], [F.col("at")]).before(F.col("v"), kind, "b").upto(F.col("v"), kind, "u").done("b", "u")
    want, held = [], {}
    fold = max if kind == "max" else lambda a, b: a + b
    for key, at, v in sorted(rows, key=lambda r: r[1]):
        before = held.get(key)
        held[key] = before if v is None else v if before is None else fold(before, v)
        want.append((at, before, held[key]))
    assert sorted((r["at"], r["b"], r["u"]) for r in got.collect()) == sorted(want)
    parts = Scans(df, ["key"], [F.col("at")]).rows.groupBy("_p").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert parts < 600


def test_merged_times_and_reasons(spark, ranges):
    rows = [(1, 0.0, 2.0, "b", "T1"), (1, 1.0, 1.5, "a", None), (1, 2.0, 3.0, "b", "T2"), (1, 5.0, 6.0, None, "T3"), (2, 0.0, 1.0, "x", "T"), (None, 0.0, 1.0, "y", "U"), (None, 0.5, 3.0, "z", "V")]
    df = spark.createDataFrame(rows, "key long, start_sec double, end_sec double, reason string, entity_type string")
    got = {(r["key"], r["start_sec"], r["end_sec"], r["reason"], r["entity_type"]) for r in IV.merge_times(df, ["key"], ["reason", "entity_type"]).collect()}
    assert got == {(1, 0.0, 3.0, "b | a | b", "T1 |  | T2"), (1, 5.0, 6.0, "", "T3"), (2, 0.0, 1.0, "x", "T"), (None, 0.0, 3.0, "y | z", "U | V")}
    masks = {(r["key"], r["start_sec"], r["reason"], r["entity_type"]) for r in IV.merge_masks(df.withColumn("confidence", F.lit(0.5)), ["key"]).collect()}
    assert masks == {(1, 0.0, "b,a", "T1"), (1, 5.0, "", "T3"), (2, 0.0, "x", "T"), (None, 0.0, "y,z", "U")}


def test_signature_is_one_tree(spark, ranges):
    import hashlib

    def tree(lines, fan):
        while True:
            got = [hashlib.sha256("\n".join(lines[i : i + fan]).encode()).hexdigest() for i in range(0, max(len(lines), 1), fan)]
            if len(got) == 1:
                return got[0][:24]
            lines = got

    for n in (0, 1, 3, 4, 10, 64, 65, 200):
        files = sorted((f"p{int(i):05d}", int(RNG.integers(0, 99))) for i in RNG.integers(0, 10**5, n))
        df = spark.createDataFrame(files, "p string, n int").repartition(3)
        r = state.signature(df, "p", "n", fan=4).first()
        assert (r["signature"], r["files"]) == (tree([f"{p}:{k}" for p, k in files], 4), n)


def test_hot_key_of_spans(spark, ranges):
    """100,000 spans of one key, spread over ranges and islands, as the loop chooses them."""
    n = 100_000
    start = np.sort(RNG.integers(0, 12 * n, n))
    spans = [("hot", int(s), int(s + RNG.integers(0, 30)), float(RNG.integers(0, 50))) for s in start]
    spans += [(f"k{i}", int(a), int(a + RNG.integers(0, 9)), float(RNG.integers(0, 5))) for i in range(40) for a in RNG.integers(0, 60, 20)] + [(None, 1, 5, 0.5), (None, 4, 5, 0.9)]
    df = spark.createDataFrame(spans, "key string, start int, end int, confidence double").repartition(8)
    got = sorted(((r["key"] or "", r["start"], r["end"], r["confidence"]) for r in IV.resolve_spans(df, ["key"]).collect()))
    by = {}
    for k, s, e, c in spans:
        by.setdefault(k or "", []).append({"start": s, "end": e, "confidence": c})
    assert got == sorted((k, s["start"], s["end"], s["confidence"]) for k, own in by.items() for s in K.resolve(own))


def test_large_keys_beside_null_ones(spark):
    big = 9007199254740993
    spans = spark.createDataFrame([(None, 1, 5, 0.5), (None, 4, 6, 0.9), (big, 1, 2, 0.3), (3, 1, 2, 0.3)], "key long, start int, end int, confidence double")
    assert {tuple(r)[:3] for r in IV.resolve_spans(spans, ["key"]).collect()} == {(None, 4, 6), (big, 1, 2), (3, 1, 2)}
    active = spark.createDataFrame([(None, 0.0, 5.0), (big, 1.0, 4.0)], "key long, start_sec double, end_sec double")
    assert {tuple(r) for r in IV.chunks(active, ["key"]).collect()} == {(None, 0.0, 5.0), (big, 1.0, 4.0)}
    assert IV.chunks(active.limit(0), ["key"]).count() == 0
