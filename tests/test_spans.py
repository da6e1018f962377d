"""Spans on their way into time, against plain versions over the same rows."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.test_brute import check
from voxloom.functions import columns as C
from voxloom.functions import fixed
from voxloom.functions import kernels as K
from voxloom.operators import spans as SP

SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()


def n_digits(t):
    return sum(c.isdigit() for c in t)


def plain_grown(kind, said, start, end, final):
    if kind.upper() not in fixed.NUMERIC_TYPES and n_digits(said) < 4:
        return kind, said, start, end
    a, b = start, end
    while a and final[a - 1] in "0123456789+().-/ #":
        a -= 1
    while b < len(final) and final[b] in "0123456789+().-/ #":
        b += 1
    whole = final[a:b]
    a += len(whole) - len(whole.lstrip(" +().-/ #"))
    whole = whole.strip(" +().-/ #")
    if n_digits(whole) < max(4, n_digits(said)):
        return kind, said, start, end
    if n_digits(whole) >= 7 and kind.upper() in ("NUMBER", "CARDINAL", "PHONE", "PHONE_NUMBER"):
        kind = "PHONE"
    return kind, whole, a, a + len(whole)


def plain_time(kind, said, start, end, words, limit, pads=(0.08, 0.12)):
    """words: (start_char, end_char, start_sec, end_sec) in order."""
    if not any(c.isalnum() for c in said):
        return None
    if not words:
        return None, None
    hit = [w for w in words if w[1] > start and w[0] < end]
    if not hit:
        first, last = min(w[2] for w in words), max(w[3] for w in words)
        return round(max(0.0, first - pads[0]), 6), round(min(limit, last + pads[1]), 6)
    high = kind.upper() in fixed.NUMERIC_TYPES or n_digits(said) >= 4
    marks = [start + i for i, c in enumerate(said) if c.isdigit()] if high else []
    marks = marks or [start + i for i, c in enumerate(said) if not c.isspace()]
    covered = sum(any(w[0] <= p < w[1] for w in hit) for p in marks) / max(1, len(marks))
    first, last = hit[0][2], hit[-1][3]
    s, e = first, last
    if high:
        if covered < 0.85 and (missing := max(0, hit[0][0] - start)):
            s = max(0.0, s - max(0.25, len(said[:missing]) * 0.08))
            ahead = [w for w in words if w[1] <= start and w[3] <= first]
            if ahead:
                s = max(s, ahead[-1][3])
        n = n_digits(said)
        need = max(2.4, n * 0.32) if n >= 7 else max(1.2, n * 0.28) if n >= 4 else max(0.25, len(said) * 0.08)
        if covered < 0.85 or max(0.0, last - first) < need * 0.65:
            behind = [w for w in words if w[0] >= end and w[2] >= last]
            e = max(last, first + need, *([behind[0][2]] if behind else []))
    return round(max(0.0, s - pads[0]), 6), round(min(limit, e + pads[1]), 6)


def plain_vague(kind, text):
    t = text.strip().lower().strip(".,!?;:'\"")
    if kind not in ("DATE", "NUMBER"):
        return False
    relative = re.match(fixed.VAGUE_START, t, re.I) and not re.search(fixed.MONTH_OR_YEAR, t, re.I)
    return not t or t in fixed.VAGUE_TIMES or bool(re.match(r"^\d{1,2}$", t)) or bool(relative)


@data
def test_times_and_numbers(spark, docs):
    found = [(d.doc_id, x) for d in docs for x in K.times_and_numbers(d.text)]
    assert {x["type"] for _, x in found} == {"NUMBER"} or len(found) > 100
    check(spark, "PII-TEMPORAL", ["doc_id", "type", "text", "start", "end", "drop"], [(i, x["type"], x["text"], x["start"], x["end"], plain_vague(x["type"], x["text"])) for i, x in found])
    text = {d.doc_id: d.text for d in docs}
    grown = [(i, *plain_grown(x["type"], x["text"], x["start"], x["end"], text[i])) for i, x in found]
    assert sum(g[1] == "PHONE" for g in grown) > 20
    check(spark, "SPN-EXPAND", ["doc_id", "type", "text", "start", "end"], grown)
    want = []
    for i, kind, said, start, end in sorted(set(grown)):
        words = [(m.start(), m.end()) for m in re.finditer("[^ ]+", text[i])]
        limit = len(text[i]) / 15.0
        step = limit / max(1, len(words))
        timed = [(a, b if k % 2 == 0 else b - (b - a) // 2, k * step, (k + 1) * step) for k, (a, b) in enumerate(words) if k % 5 != 3]
        got = plain_time(kind, said, start, end, timed, limit)
        want += [(i, kind, said, start, end, *got)] if got else []
    check(spark, "ALN-NUMERIC", ["segment_id", "type", "text", "start", "end", "start_sec", "end_sec"], want)


@data
def test_spans_of_another_transcript(spark, docs):
    want, lost = [], 0
    for d in docs:
        if d.text is None:
            continue
        heard = re.sub("[,;:!?]", "", d.text).lower()
        for x in K.detect(heard):
            at = x["start"] if heard == d.text else d.text.lower().find(x["text"].strip())
            lost += at < 0
            if at >= 0:
                want.append((d.doc_id, x["type"], d.text[at : at + len(x["text"])], at, at + len(x["text"])))
    assert len(want) > 20
    check(spark, "SPN-MAP", ["doc_id", "type", "text", "start", "end"], want)


CASES = [
    ("NUMBER", "212", "can I call 212-537-0830 today?", ("PHONE", "212-537-0830")),
    ("NUMBER", "537", "(+1 (212) 537)", ("PHONE", "1 (212) 537")),
    ("NUMBER", "12", "only 12 of them", ("NUMBER", "12")),
    ("ZIP", "12345", "zip 12345-6789.", ("ZIP", "12345-6789")),
    ("PERSON_NAME", "Smith", "Smith 4444444", ("PERSON_NAME", "Smith")),
    ("PERSON_NAME", "R2D2 1234", "R2D2 1234 567 8", ("PERSON_NAME", "R2D2 1234")),
    ("NUMBER", "5", "5", ("NUMBER", "5")),
]


def test_known_growth(spark):
    rows = [(i, t, text, text.index(t), text.index(t) + len(t), k) for i, (k, t, text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i long, text string, final string, start int, end int, type string")
    got = {r["i"]: (r["type"], r["text"]) for r in SP.grown(df).collect()}
    for i, (k, t, text, want) in enumerate(CASES):
        at = text.index(t)
        assert plain_grown(k, t, at, at + len(t), text)[:2] == got[i]
        if k != "PERSON_NAME" or n_digits(t) < 4:
            assert got[i] == want


def test_all_transcripts_are_read(spark):
    finals = spark.createDataFrame([("a", "my number is 555-123-4567 today"), ("b", "nothing here"), ("c", ""), ("d", "Call J@X.ORG now 49")], "segment_id string, final string")
    heard = spark.createDataFrame([("a", "whisper", "MY NAME IS jane DOE 555-123-4567"), ("a", "qwen", None), ("b", "whisper", "write to x@y.org"), ("c", "whisper", "555-123-4567"), ("d", "qwen", "call j@x.org now"), ("d", "cohere", "call j@x.org now")], "segment_id string, source_name string, transcript string")
    got = {(r["segment_id"], r["type"], r["text"], r["source_name"]) for r in SP.personal(finals, heard).collect()}
    assert got == {("a", "PHONE", "555-123-4567", "final"), ("a", "PHONE", "555-123-4567", "whisper"), ("d", "EMAIL", "J@X.ORG", "final"), ("d", "EMAIL", "J@X.ORG", "qwen"), ("d", "EMAIL", "J@X.ORG", "cohere")}
    alone = {(r["segment_id"], r["type"]) for r in SP.personal(finals).collect()}
    assert alone == {("a", "PHONE"), ("d", "EMAIL")}


def test_times_by_hand(spark):
    """Start and end rules apart: a lost first word, a lost last word, a quick number, no word at all, nothing to say."""
    words = {"a": [(0, 4, 0.0, 1.0), (5, 9, 2.0, 2.3), (30, 34, 9.0, 9.5)], "b": [(0, 3, 1.0, 1.5)], "c": []}
    spans = [("a", "PHONE", "5551234567", 2, 12), ("a", "PHONE", "1234567 890", 4, 15), ("a", "PERSON_NAME", "Jo", 20, 22), ("a", "ID", "-", 5, 6), ("a", "EMAIL", "ab", 5, 7), ("b", "DATE", "May", 0, 3), ("b", "ZIP", "12345", 0, 5), ("c", "PHONE", "555", 0, 3)]
    line = spark.createDataFrame([(k, *w, 10.0) for k, ws in words.items() for w in ws], "segment_id string, start_char int, end_char int, word_start double, word_end double, duration_sec double")
    df = spark.createDataFrame(spans, "segment_id string, type string, text string, start int, end int")
    got = {tuple(r)[:5]: tuple(r)[5:] for r in SP.in_time(df, line).collect()}
    want = {x: plain_time(*x[1:], words[x[0]], 10.0) for x in spans}
    assert got == {k: v for k, v in want.items() if v is not None} and ("a", "ID", "-", 5, 6) not in got


@pytest.mark.parametrize("text", ["today", "two years", "49", "last week", "  Now. ", "", "March 5th", "1999", "12/05/1987", "an hour", "the next 3 days", "may", "next May", "200"])
def test_vague(spark, text):
    got = spark.createDataFrame([("DATE", text), ("NUMBER", text), ("ID", text)], "k string, t string").select(C.vague(F.col("k"), F.col("t"))).collect()
    assert [r[0] for r in got] == [K.vague_time(k, text) for k in ("DATE", "NUMBER", "ID")] == [plain_vague(k, text) for k in ("DATE", "NUMBER", "ID")]


def test_chunks_and_choices_work_out_their_input_once(spark):
    """Ranges are sampled, sorted and counted; what the rows are derived by runs for one of these alone."""
    from voxloom.operators import intervals

    seen = spark.sparkContext.accumulator(0)

    def derived(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.createDataFrame([(k, 2.0 * i, 2.0 * i + 1.5, 0.5) for k in range(3) for i in range(20)], "k long, start_sec double, end_sec double, confidence double").coalesce(1)
    rows = rows.mapInPandas(derived, rows.schema)
    assert len(intervals.chunks(rows, ["k"]).collect()) > 0 and seen.value == 60
    assert len(intervals.resolve_spans(rows, ["k"], "start_sec", "end_sec").collect()) == 60 and seen.value == 120
