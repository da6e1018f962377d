"""Tokens mapped onto words, and runs of words, against plain versions."""

import os
import re

import numpy as np
import pytest

from tests.test_brute import check
from voxloom.functions import kernels as K
from voxloom.operators import tokenmap as TM

SF = "/root/testdata/sf0.001"


def half_up(x):
    return round(x + 1e-9, 6)


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("a b c", "a b c", [0, 1, 2]),
        ("a b c", "a x c", [0, 1, 2]),  # replaced runs stand for each other in order
        ("a b b c", "a b c", [0, 1, None, 2]),
        ("a c", "a b b c", [0, 3]),
        ("x y z q", "q", [None, None, None, 0]),
        ("my name is jon smith", "well my name was john smith ok", [1, 2, 3, 4, 5]),
        ("", "a", []),
        ("a", "", [None]),
        ("e f g h a b c d", "a b c d e f g h", [None, None, None, None, 0, 1, 2, 3]),
    ],
)
def test_known_maps(a, b, want):
    assert TM.token_map(a.split(), b.split()) == want


def test_maps_of_random_texts():
    """Increasing, in range; what wasn't touched is found again; a copy maps onto itself."""
    rng = np.random.default_rng(1)
    for _ in range(500):
        a = [f"w{i}" for i in rng.integers(0, 60, int(rng.integers(1, 80)))]
        keep = rng.random(len(a)) > 0.15
        b = [w if rng.random() > 0.1 else "zz" for w, k in zip(a, keep, strict=True) if k]
        got = TM.token_map(a, b)
        used = [j for j in got if j is not None]
        assert used == sorted(set(used)) and all(0 <= j < len(b) for j in used) and len(got) == len(a)
        assert TM.token_map(a, a) == list(range(len(a)))
        place = np.cumsum(keep) - 1
        right = sum(got[i] == place[i] for i in range(len(a)) if keep[i])
        assert right >= 0.5 * keep.sum() or len(a) < 15
    long = [f"w{i % 997}" for i in range(20_000)]
    assert TM.token_map(long, long[:9000] + ["zz"] + long[9003:])[9500] == 9498


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")
def test_times_of_entities(spark):
    clean = lambda w: re.sub(r"[^\w]|_", "", w.lower())
    want = []
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        if d.text is None:
            continue
        heard = "".join(c if c.isalpha() or c.isnumeric() or c in " @." else " " for c in d.text.lower())
        heard = re.sub("[0-9]", lambda m: f" {TM.DIGITS[int(m[0])]} ", heard)
        words, step = [w for w in heard.split(" ") if w], 0
        step = len(d.text) / 15.0 / max(1, len(words))
        line = [(k * step, (k + 1) * step, clean(w)) for k, w in enumerate(words) if k % 7 != 5 and clean(w)]
        tokens, at = [], 0
        for w in d.text.split(" "):
            if clean(w):
                tokens.append((at, at + len(w), clean(w)))
            at += len(w) + 1
        spans = K.detect(d.text) + K.times_and_numbers(d.text)
        place = TM.token_map([t[2] for t in tokens], [x[2] for x in line]) if spans and line else []
        for x in spans if line else []:
            hit = [line[p] for (a, b, _), p in zip(tokens, place, strict=True) if p is not None and b > x["start"] and a < x["end"]]
            if hit:
                want.append((d.doc_id, x["type"], x["text"], half_up(max(0.0, min(h[0] for h in hit) - 0.06)), half_up(max(h[1] for h in hit) + 0.06), "mapped"))
        for kind, text in {(x["type"], x["text"]) for x in spans}:
            toks = []
            for t in map(clean, re.findall(r"[A-Za-z0-9@._%+\-']+", text)):
                toks += [TM.DIGITS[int(c)] for c in t] if re.fullmatch("[0-9]+", t) else [t] if t else []
            for i in range(len(line) - len(toks) + 1) if toks else []:
                if [x[2] for x in line[i : i + len(toks)]] == toks:
                    s, e = max(0.0, line[i][0] - 0.08), line[i + len(toks) - 1][1] + 0.08
                    if e - s < 0.25:
                        s, e = max(0.0, (s + e) / 2 - 0.125), (s + e) / 2 + 0.125
                    want.append((d.doc_id, kind, text, half_up(s), half_up(e), "searched"))
    assert sum(w[-1] == "mapped" for w in want) > 50 and sum(w[-1] == "searched" for w in want) > 50
    check(spark, "ALN-TOKENMAP", ["segment_id", "type", "text", "start_sec", "end_sec", "way"], want)


def test_spans_and_runs_of_a_long_text_are_found_together():
    """4,000 spans among 40,000 words: all of them against all words would be 1.6e8 steps in each of three passes."""
    import time

    n = 40_000
    words = [f"w{i % 9973}" for i in range(n)]
    begins = [i * 7 for i in range(n)]
    ends = [b + 5 for b in begins]
    starts = [i * 70 + 3 for i in range(4000)]
    began = time.time()
    got = TM.span_words(words, begins, ends, words, starts, [s + 12 for s in starts])
    assert got == [[i * 10, i * 10 + 1, *([i * 10 + 2] if 70 * i + 14 < s + 12 else [])] for i, s in enumerate(starts)]
    assert TM.run_places(words, [words[i : i + 3] for i in range(0, 4000)]) == [list(range(i, n - 2, 9973)) for i in range(0, 4000)]
    assert time.time() - began < 5


def test_times_are_found_where_one_can_begin():
    """The same matches as the pattern gives by itself, also with letters that it takes for others; texts without vague times or digits don't meet it."""
    rng = np.random.default_rng(5)
    words = [*K.K.VAGUE_TIMES, *K.K.MONTHS, *K.K.COUNTS, "the", "this", "a", "1", "123", "3/4/20", "1st", "x", "_", "é", "ſ", "ı", "İ", "dayſ", "tıme", "day_"]
    for _ in range(5000):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", " ", "  ", ". ", ", ", "-", "", "\n"])) for _ in range(int(rng.integers(1, 8))))
        text = text if rng.random() < 0.8 else text.upper()
        assert [m.span() for m in K._times(text)] == [m.span() for m in K._TIMES.finditer(text)], text
        few = len(K._DIGIT_WORD.findall(text)) < min(K.K.TRUE_DIGITS, K.K.CUED_DIGITS)
        assert few or not K._few_digits(text), text


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")
def test_words_stay_in_their_rows(spark):
    """Nothing is shuffled, each function runs once, and tables of spans and words give the same rows."""
    from pyspark.sql import functions as F

    from voxloom.plans import catalog, more

    df = catalog.QUERIES["ALN-TOKENMAP"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 2
    rows = more._recognised(spark, SF)
    spans = rows.select("segment_id", F.explode_outer("spans").alias("s")).where("s is not null").select("segment_id", "s.type", "s.text", "s.start", "s.end")
    words = rows.select("segment_id", F.posexplode_outer("words").alias("word_index", "w")).where("w is not null").select("segment_id", "word_index", F.col("w.norm").alias("word"), "w.word_start", "w.word_end")
    apart = TM.times(TM.gathered(spans, rows.select("segment_id", "text"), words))
    assert df.count() > 100 and sorted(map(tuple, apart.collect())) == sorted(map(tuple, df.collect()))
