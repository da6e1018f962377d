"""What tasks hold and do grows with a part or a difference, not with a batch, a call or the square of a text."""

import hashlib
import random
import time

import pandas as pd
from pyspark.sql import functions as F

from voxloom.functions import columns as C
from voxloom.functions import kernels


def test_results_leave_a_batch_in_parts():
    texts, seen = pd.Series(["word " * 200 + str(i) for i in range(1000)]), []

    def kernel(t):
        seen.append(t)
        return kernels.word_places(t)

    out = C.worked(kernel, iter([(texts,)]))
    first = next(out)
    assert len(first) == len(seen) <= C.PART_CHARS / 1000
    got = [x for part in [first, *out] for x in part]
    assert len(seen) == 1000 and got == [kernels.word_places(t) for t in texts]


def test_parts_keep_rows_and_order():
    rows = [("a" * n, i) for i, n in enumerate([0, 5, 100, 1, 1, 40, 300, 0])]
    got = list(C.parts(rows, 50))
    assert [r for p in got for r in p] == rows and all(len(p) == 1 or sum(len(r[0]) for r in p) <= 50 for p in got)
    assert list(C.parts([], 50)) == [[]]


def test_lifted_functions_over_many_rows(spark):
    rows = [(i, None if i % 7 == 0 else f"a{i} " + "bcd  é " * (i % 400)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    got = {r["id"]: [x.asDict() for x in r["w"]] for r in df.select("id", C.word_places("text").alias("w")).collect()}
    assert got == {i: kernels.word_places(t) for i, t in rows}


def test_distance_is_levenshteins(spark):
    r = random.Random(1)
    said = lambda n, of="abé 𝄞": "".join(r.choice(of) for _ in range(n))
    long = said(400, "ab cdef")
    rows = [(said(r.randint(0, 40)), said(r.randint(0, 40))) for _ in range(100)] + [(said(1500), said(1300)), ("", ""), ("", "a"), ("ab", "ab ab"), ("aaaa", "aa"), (None, "a"), ("a", None)]
    rows += [(long, long[:i] + said(j) + long[i + k :]) for i in (0, 7, 399, 400) for j in (0, 30) for k in (0, 1, 40)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.where(~C.distance(F.col("a"), F.col("b")).eqNullSafe(F.levenshtein("a", "b"))).count() == 0


def test_distance_of_long_texts_takes_no_whole_table(spark):
    """Four pairs of 100,000 characters: whole tables have 5e10 cells."""
    text = " ".join(str(i * i) for i in range(15_000))[:100_000]
    df = spark.createDataFrame([(text, text + " " + text), (text, "x" + text), (text[5:], text), (text, text[:50_000] + "!?" + text[50_003:-1])], "a string, b string")
    began = time.time()
    assert sorted(x for x, in df.select(C.distance(F.col("a"), F.col("b"))).collect()) == [1, 4, 5, 100_001]
    assert time.time() - began < 60


def test_signature_is_the_digest_of_all_lines(spark):
    from voxloom.operators import state

    files = [(f"p{(i * 7919) % 25_000:05d}", i % 97) for i in range(25_000)] + [("p00000", 5), ("p00000", 5), (None, 3)]
    df = spark.createDataFrame(files, "p string, n int").repartition(5)
    lines = [f"{p}:{n}" for p, n in sorted(f for f in files if f[0] is not None)]
    want = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:24]
    assert [tuple(r) for r in state.digest_of_lines(df, "p", "n").collect()] == [(want, len(files))]
    assert [tuple(r) for r in state.digest_of_lines(df.where("false"), "p", "n").collect()] == [(None, 0)]


def test_entities_leave_a_batch_in_slices():
    from voxloom.operators import adapters

    pdf = pd.DataFrame({"segment_id": range(1000), "t": ["Word " * 200 if i % 9 else None for i in range(1000)]})
    got = list(adapters._slices(iter([pdf]), "t"))
    assert pd.concat(got).equals(pdf) and max(x["t"].fillna("").str.len().sum() for x in got) <= C.PART_CHARS


def test_merged_spans_leave_a_batch_in_parts():
    """PII-MERGE takes its spans from one lifted kernel: no list of spans comes back to Python."""
    import inspect

    from voxloom.plans import more

    assert "pandas_udf" not in inspect.getsource(more.pii_merge) and "C.sure_spans(" in inspect.getsource(more.pii_merge)


def test_words_of_texts_are_not_shuffled(spark):
    """Words meet a bounded list of marks where they are: a text is one row of the shuffle; a longer list gives the same."""
    import re

    from voxloom.operators import language

    rows = spark.createDataFrame([(i, None if i % 9 == 0 else "el the Niño " * (i % 5) + "casa " * (i % 3)) for i in range(60)], "doc_id int, text string")
    marks = spark.createDataFrame([("el", "es"), ("casa", "es"), ("the", "en")], "w string, lang string")
    found = language.score(rows, marks)
    assert re.search(r"hashpartitioning\(_row#\d+L?, w#", found._jdf.queryExecution().toString()) is None
    got = sorted(tuple(r) for r in found.select("doc_id", "code", "sure").collect())
    assert got == sorted(tuple(r) for r in language.score(rows, marks, most=0).select("doc_id", "code", "sure").collect())
    assert {x for _, x, _ in got} == {"es", None}


def test_values_of_a_batch_are_made_part_by_part():
    """When a part leaves, no more values of its batch than the part's and one are Python objects."""
    made = []

    def values():
        for i in range(1000):
            made.append(i)
            yield "word " * 200 + str(i)

    out = C.worked(kernels.word_places, iter([(values(),)]))
    first = next(out)
    assert len(made) <= len(first) + 1 < 1000
    assert len(first) + sum(len(x) for x in out) == len(made) == 1000


def test_both_kinds_of_spans_take_one_worker_a_task(spark):
    from voxloom.operators import spans

    rows = [("a", "call 555-123-4567 tomorrow at 5"), ("b", ""), ("c", None), ("d", "ana@x.org, 12 euros")]
    df = spark.createDataFrame(rows, "segment_id string, final string")
    assert spans.personal(df)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = {r["segment_id"]: r for r in df.select("segment_id", C.said_spans("final").alias("x"), F.concat(C.detect("final"), C.times_and_numbers("final")).alias("y")).collect()}
    assert all(r["x"] == r["y"] for r in got.values()) and len(got["a"]["x"]) >= 2 and got["c"]["x"] == []


def test_words_of_a_text_are_found_once(spark):
    """Asking for texts with words must not find their words a second time, in a second worker of the task; texts without words have no rows."""
    from voxloom.operators import intervals

    df = spark.createDataFrame([("a", "one two", 2.0), ("b", "", 1.0), ("c", "  ", 1.0), ("d", None, 1.0)], "segment_id string, text string, duration_sec double")
    words = intervals.uniform_words(df).where("start_char < 17")
    assert words._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = sorted((r["segment_id"], r["word_index"], r["word"], r["start_char"], r["end_char"], r["word_start"], r["word_end"]) for r in words.collect())
    assert got == [("a", 0, "one", 0, 3, 0.0, 1.0), ("a", 1, "two", 4, 7, 1.0, 2.0)]
