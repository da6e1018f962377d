"""The chain from transcripts to masked files, reviews, and detectors, on small rows."""

import numpy as np
import pytest

from voxloom.operators import adapters, audio, chain, review
from voxloom.sources import sinks

SEG = "segment_id string, file_id string, channel int, start_sec double, duration_sec double"
RES = "segment_id string, model_name string, rank int, transcript string, norm string, error string, confidence double, duration_sec double"


def wav(seconds=4, rate=8000):
    t = np.arange(seconds * rate) / rate
    return audio.write_wav(audio.to_int16(np.stack([0.5 * np.sin(2 * np.pi * 440 * t), 0.5 * np.sin(2 * np.pi * 880 * t)], axis=1)), rate)


def results(spark, texts):
    """Three models that say the same of each segment; None is an error."""
    rows = [(s, m, i, t, (t or "").lower(), None if t is not None else "failed", 0.9, 2.0) for s, t in texts.items() for i, m in enumerate(("parakeet", "whisper", "qwen"))]
    return spark.createDataFrame(rows, RES)


def test_personal_data_is_masked_to_the_end(spark):
    segments = spark.createDataFrame([("a0", "a", 0, 0.0, 2.0), ("a1", "a", 1, 2.0, 2.0), ("b0", "b", 0, 0.0, 2.0), ("b1", "b", 1, 1.0, 2.0)], SEG)
    texts = {"a0": "my name is John Smith and phone is 555-123-4567", "a1": "nothing to hide here", "b0": None, "b1": " \t"}
    files = spark.createDataFrame([(f, wav()) for f in "abc"], "file_id string, content binary")
    plans = {r.file_id: r for r in chain.plan_run(segments, results(spark, texts), files).collect()}
    assert {f: p.status for f, p in plans.items()} == {"a": "completed", "b": "completed", "c": "completed"}
    assert [tuple(x) for x in plans["b"].intervals] == [(0, 0.0, 2.0), (1, 1.0, 3.0)]  # unreadable segments as wholes
    assert len(plans["a"].intervals) == 2 and all(x.channel == 0 and 0 <= x.start_sec < x.end_sec <= 2.0 for x in plans["a"].intervals)
    done = {r.file_id: r for r in chain.protect(segments, results(spark, texts), files, "silence").collect()}
    assert {f: r.status for f, r in done.items()} == {"a": "redacted", "b": "redacted", "c": "copied"}
    rate, a = audio.read_wav(done["a"].content)
    for x in plans["a"].intervals:
        assert not a[round(x.start_sec * rate) : round(x.end_sec * rate), 0].any()
    assert a[:, 1].any() and a[2 * rate :, 0].any() and not audio.read_wav(done["b"].content)[1][: 2 * rate, 0].any()
    assert bytes(done["c"].content) == wav()


def test_a_segment_that_fails_fails_its_file(spark):
    aligned = spark.createDataFrame([("s", "f", 0, 0.0, "failed", []), ("t", "f", 1, 1.0, "completed", [(0.1, 0.2, "ID", "pii")]), ("u", "g", 0, 5.0, "completed", [(0.1, 0.2, "ID", "pii")])], f"segment_id string, file_id string, channel int, start_sec double, status string, intervals {chain.INTERVAL}")
    files = spark.createDataFrame([("f",), ("g",), ("h",)], "file_id string")
    got = {r.file_id: (r.status, [tuple(x) for x in r.intervals]) for r in chain.plans(files, aligned).collect()}
    assert got == {"f": ("failed", []), "g": ("completed", [(0, 5.1, 5.2)]), "h": ("completed", [])}


def test_nothing_is_exported_with_a_leak(spark):
    calls = spark.createDataFrame([(i, i, 10 * (i % 4), i != 3) for i in range(8)], "call_id long, place long, pii long, has_file boolean")
    explicit = spark.createDataFrame([(2, "skip"), (6, "pass")], "call_id long, verdict string")
    judged = review.verdicts(calls, explicit, [(0, 5, "pass"), (4, 7, "skip")])
    assert {r.call_id: (r.verdict, r.by_range) for r in judged.collect()} == {0: ("pass", True), 1: ("pass", True), 2: ("skip", False), 3: ("pass", True), 4: ("pass", True), 5: ("skip", True), 6: ("pass", False), 7: ("unseen", False)}
    assert [r.call_id for r in review.export(judged, 3).collect()] == [6, 1, 0]
    leak = review.verdicts(calls, spark.createDataFrame([(7, "leak")], "call_id long, verdict string"), [(0, 5, "pass")])
    with pytest.raises(Exception, match="nothing is exported"):
        review.export(leak, 3).collect()


def test_keys_are_checked(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    assert review.join_one_to_one(one, one.withColumnRenamed("x", "y").where("k = 1"), "k").count() == 2
    with pytest.raises(Exception, match="k 1 is more than once on the right"):
        review.join_one_to_one(one, one.unionAll(one.where("k = 1")).withColumnRenamed("x", "y"), "k").collect()
    assert sinks.merge_shards([one.where("k = 1"), one.where("k = 2").drop("x")], "k").count() == 2
    both = sinks.merge_shards([one, one.where("k = 2")], "k")  # an error of rows that are read, not of the call
    with pytest.raises(Exception, match="k 2 is in more than one shard"):
        both.collect()
    assert sinks.sheet(one, 1).count() == 0 and sinks.sheet(one, 2).count() == 2


class Picky:
    """Finds every x; raises on windows with a bang."""

    def find(self, texts):
        if any("!" in t for t in texts):
            raise RuntimeError("no bangs")
        return [[("X", i, i + 1, 0.9 if i % 2 else 0.3) for i, c in enumerate(t) if c == "x"] for t in texts]


def test_detectors_fail_row_by_row(spark):
    long = "word " * 700 + "x end"
    rows = spark.createDataFrame([("a", "ax x"), ("b", "x!"), ("c", long), ("d", None)], "segment_id string, text string")
    got = sorted(tuple(r) for r in adapters.find_entities(rows, Picky, 0.5).select("segment_id", "start", "error").collect())
    assert got[:2] == [("a", 1, None), ("a", 3, None)] and got[2] == ("b", None, "RuntimeError: no bangs")
    assert all(s == "c" and t == long.index("x") for s, t, _ in got[3:]) and len(got) <= 4
    cuts = adapters.text_windows(long)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(long) and all(b - a <= 1200 for a, b in cuts)


class Moody:
    """Labels at the second try; never those with a bang."""

    def __init__(self):
        self.asked = 0

    def label(self, transcript):
        self.asked += 1
        if self.asked % 2 or "!" in transcript:
            raise RuntimeError("not now")
        return " AGENT", "r" * 999


def test_labels_are_tried_again(spark):
    sides = spark.createDataFrame([(1, 0, "hi"), (1, 1, " "), (2, 0, None), (3, 0, "no!"), (4, 0, "was there")], "call_id long, channel int, transcript string").coalesce(1)
    got = {r.call_id * 10 + r.channel: (r.role, len(r.reason), r.error) for r in adapters.label_sides(sides, Moody, sides.where("call_id = 4")).collect()}
    assert got == {10: ("agent", 250, None), 11: ("unknown", 0, None), 20: ("unknown", 0, None), 30: ("unknown", 0, "RuntimeError: not now")}
