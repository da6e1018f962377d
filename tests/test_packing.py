"""Greedy packing in blocks against a loop over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators import state
from voxloom.operators.packing import pack, successors


def loop(sizes, rule, most, limit):
    """Batches of rows in order, one row after the other."""
    out, batch, held, total = [], 0, 0, 0.0
    for x in sizes:
        over = {"target": total >= limit, "padded": (held + 1) * x > limit, "budget": total + x > limit}[rule]
        if held and (over or held >= most):
            batch, held, total = batch + 1, 0, 0.0
        held, total = held + 1, total + x
        out.append(batch)
    return out


@pytest.mark.parametrize(
    ("sizes", "most", "limit", "lengths"),
    [([1.0] * 10, 3, 1e9, [3, 3, 3, 1]), ([0.1] * 5, 2, 1000.0, [2, 2, 1]), ([4.0] * 3, 99, 6.0, [1, 1, 1]), ([2.0] * 12, 99, 10.0, [5, 5, 2]), ([99.0, 1.0, 1.0], 4, 5.0, [1, 2]), ([2.0] * 6, 3, 10.0, [3, 3])],
)
def test_known_batches(sizes, most, limit, lengths):
    after, at, got = successors(np.array(sizes), most, "budget", limit), 0, []
    while at < len(sizes):
        got.append(int(after[at]) - at)
        at = int(after[at])
    assert got == lengths


@pytest.mark.parametrize(("rule", "most", "limit"), [("budget", 7, 3.0), ("budget", 1, 9.0), ("padded", 5, 4.0), ("target", 12, 12.0)])
@pytest.mark.parametrize(("n", "block", "fan"), [(700, 13, 3), (60, 100, 4), (1, 5, 2), (39, 13, 2)])
def test_blocks_equal_the_loop(spark, rule, most, limit, n, block, fan):
    rng = np.random.default_rng(n + most)
    sizes = np.round(rng.exponential(0.6, n), 3) if rule != "target" else rng.integers(1, 9, n).astype(float)
    if rule == "padded":
        sizes = np.sort(sizes)
    rows = spark.createDataFrame([(f"k{i}", i, float(x)) for i, x in enumerate(sizes)], "name string, i long, size double").repartition(5)
    got = pack(rows, [F.col("i")], F.col("size"), rule, most, limit, ["name"], block, fan)
    by = {r["name"]: r["batch"] for r in got.collect()}
    assert [by[f"k{i}"] for i in range(n)] == loop(sizes.tolist(), rule, most, limit)


def test_whole_calls(spark):
    rows = [(c, i, f"{c}-{i:03d}") for c in range(7) for i in range(30)]
    seg = spark.createDataFrame(rows, "call long, i long, id string")
    got = sorted((r["call"], r["chunk"]) for r in state.chunks(seg, "call", 50, ["id"]).collect())
    assert [c for _, c in got] == [0, 0, 1, 1, 2, 2, 3]
    one = spark.createDataFrame([(5, 0, "b"), (9, 0, "a"), *[(5, i, f"c{i}") for i in range(200)]], "call long, i long, id string")
    assert {(r["call"], r["chunk"]) for r in state.chunks(one, "call", 50, ["id"]).collect()} == {(9, 0), (5, 0)}
    assert state.chunks(seg.limit(0), "call", 50, ["id"]).count() == 0


def test_null_sizes(spark):
    rows = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 9.0), ("d", -2.0)], "key string, size double")
    assert {r["key"]: r["batch"] for r in state.batches(rows, "size", "key", 3, 4.0).collect()} == {"d": 0, "a": 0, "b": 0, "c": 1}
