"""Inline cases of text functions, and properties of intervals, spans and batches."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.functions import fixed as X
from voxloom.functions import kernels as K
from voxloom.operators import alignment as A


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("User: Call me at FIVE five five 1234! [noise]", "call me at 555 1234"),
        ("I'm gonna call twenty five people.", "i am going to call 25 people"),
        (None, ""),
        ("nan", ""),
        ("the 1st, uh, ok", "the 1 okay"),
        ("oh dear", "oh dear"),
        ("five oh two", "502"),
        ("4 0 7", "407"),
        ("twenty thirty two oh one ten", "20 32 01 10"),
    ],
)
def test_normalise(text, want):
    assert K.normalise(text) == want


def kinds(text):
    return [s["type"] for s in K.detect(text)]


def test_detect():
    assert kinds("My name is John Smith and phone is 555-123-4567") == ["PERSON_NAME", "PHONE"]
    assert kinds("my member ID is four four four two") == ["ID"]
    assert kinds("five five five one two three four") == ["PHONE"]
    assert kinds("one twenty over eighty, pulse seventy two") == []
    assert kinds("write to a.b@c.org or 123-45-6789") == ["EMAIL", "PHONE"]  # a phone pattern has the same span and is listed first
    assert kinds(None) == []


@pytest.mark.parametrize("text", ["today", "two years", "49", "last week", "", None])
def test_vague(text):
    assert K.vague_time("DATE", text)


@pytest.mark.parametrize("text", ["March 5th", "1999", "12/05/1987"])
def test_not_vague(text):
    assert not K.vague_time("DATE", text)


spans = st.lists(st.tuples(st.integers(0, 30), st.integers(1, 8), st.sampled_from([0.5, 0.9, 0.95])), max_size=12)


@settings(deadline=None)
@given(spans)
def test_resolve_keeps_some_of_its_spans(xs):
    rows = [{"start": s, "end": s + n, "confidence": c} for s, n, c in xs]
    kept = K.resolve(rows)
    assert all(k in rows for k in kept) and bool(kept) == bool(rows)
    assert [k["start"] for k in kept] == sorted(k["start"] for k in kept)


@given(st.lists(st.floats(0.1, 50), max_size=40), st.integers(1, 6), st.floats(1, 60))
def test_batches_hold_their_limits(sizes, most, budget):
    got = K.pack_batches(sizes, most, budget)
    for b in set(got):
        own = [s for s, x in zip(sizes, got, strict=True) if x == b]
        assert len(own) <= most and (len(own) == 1 or sum(own) <= budget + 1e-9)
    assert got == sorted(got)


def test_word_distance():
    assert K.word_distance("a b c", "a x c d") == 2
    assert K.word_distance("", "a") == 1


def test_json_object():
    assert K.json_object('x ```json\n{"a": {"b": "}"},}\n```') == '{"a": {"b": "}"}}'
    assert K.json_object("none") is None


def test_vad():
    x = np.r_[np.zeros(100), np.ones(100), np.zeros(100)]
    assert A.energy_vad(x, 100, 0.1) == [(1.0, 2.0)]
    assert A.energy_vad(np.zeros(0), 100) == []


def test_ctc():
    lp = np.log(np.full((8, 3), 0.1))
    for t, k in enumerate([0, 1, 1, 0, 2, 2, 0, 0]):
        lp[t, k] = np.log(0.8)
    assert [(a, b) for a, b, _ in A.ctc_align(lp, [1, 2])] == [(1, 3), (4, 6)]


def test_chunks_stay_within_the_limit():
    got = A.chunk([(0, 4), (4.2, 9), (12, 18), (18.1, 25)], 10, 15)
    assert got == [(0, 10.5), (10.5, 25)]  # in the middle of the pause
    assert all(b - a <= 28 for a, b in A.chunk([(0, 100)], 15, 28))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*list(X.CONTRACTIONS), "they", "'", "s", "all", " ", "re", "ma", "can", "-", "am"]), max_size=14))
def test_contractions_in_one_pass(parts):
    import re

    for sep in ("", " "):
        text = want = sep.join(parts)
        for short, long in X.CONTRACTIONS.items():
            want = re.sub(rf"\b{re.escape(short)}\b", long, want)
        assert K._CONTRACTION.sub(lambda m: X.CONTRACTIONS[m[0]], text) == want
