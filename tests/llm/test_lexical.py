"""Ranked lexical search against plain scores."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import lexical

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    """Every document's score for every item, sorted."""
    find = lambda t: re.findall(TERM, (t or "").translate(LOW))
    held = [(i, find(t)) for i, t in docs]
    held = [(i, w, collections.Counter(w)) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w, _ in held)
    df = collections.Counter(t for _, _, c in held for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(find(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, w, c in held:
            m = 100 - 50 + (50 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "é", "x9", "ÄB", "東京"]
    p = 1.0 / np.arange(1, len(vocab) + 1)
    text = lambda m: " ".join(rng.choice(vocab, m, p=p / p.sum())).replace(" w1 ", ", W1!\n")
    return [(int(rng.integers(-50, 10**12)), text(int(rng.integers(0, 80)))) for _ in range(n)], text


@pytest.mark.parametrize(("n", "parts"), [(300, 7), (60, 1)])
def test_brute(spark, n, parts):
    rows, text = corpus(n, n)
    rows += [(3, "w2 w3 w40"), (3, "w2 w3 w40"), (4, "w2 w3 w40"), (None, "w2 w40 w41"), (5, None), (6, ""), (7, "!!"), (8, "w5 " * 30_000)]
    items = [(i, text(9)) for i in range(12)] + [(0, "W40 É"), (None, "w2"), (20, None), (21, "zz"), (22, "w40 w40")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).withColumns({"rank": F.lit(1), "score": F.lit("x"), "item_id": F.lit(0)})
    got = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit(1)), 10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, items, 10)


def test_blocks_of_queries(spark, monkeypatch):
    rows, text = corpus(5, 120)
    items = [(i, text(6)) for i in range(30)]
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 25)
    got = lexical.search(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted(map(tuple, got.collect())) == plain(rows, items, 4)


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs, items, 3).count() == 0 and lexical.search(docs, items.limit(0), 3).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0), 3).count() == 0


def test_harvest_takes_every_place_once():
    """Lists of a full window against sums by place."""
    rng = np.random.default_rng(1)
    window = lexical._Open()
    codes = {f"t{i}".encode(): i for i in range(40)}
    for i in range(lexical.WINDOW):
        window.add(int(rng.integers(0, 10**9)), [f"t{j}".encode() for j in rng.integers(0, 60, int(rng.integers(1, 20)))], codes)
    row = window.row()
    weights = rng.integers(0, 9000, 40)
    lists = lexical.Lists(type("Row", (), row), weights, lexical.WINDOW, row["words"])
    sums, taken = np.zeros(lexical.WINDOW, np.int64), np.zeros(lexical.WINDOW // 64, np.uint64)
    order = np.argsort(np.array(window.ids), kind="stable")
    for _ in range(5):
        terms = np.unique(rng.integers(0, 40, 7))
        want = {}
        for place, i in enumerate(order):
            m = 50 + (50 * window.sizes[i] * lexical.WINDOW) // row["words"]
            hits = [(t, window.held[i][t]) for t in terms.tolist() if window.held[i][t]]
            if hits:
                want[place] = sum(int(weights[t]) * ((10**9 * c) // (1000 * c + 20 * m)) for t, c in hits)
        hit, found = lists.harvest(terms, sums, taken)
        assert dict(zip(hit.tolist(), found.tolist(), strict=True)) == want
        assert not sums.any() and not taken.any()
