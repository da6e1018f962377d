"""Dual-tree clustering against plain Lloyd rounds in whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import dualtree


def plain(rows, k, rounds, dim, scale=1024, seed="3"):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) if abs(scale * x) < 2**52 else int(min(max(scale * x, -dualtree.np.finfo(float).max), dualtree.np.finfo(float).max)) for x in v]))
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cent = [list(v) for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cent)):
            mine = [v for (_, v), c in zip(kept, own, strict=True) if c == j]
            if mine:
                cent[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    top = dualtree.LARGEST
    out = [(i, near(v)) for i, v in kept]
    out = [(i, c, min(d, top)) for i, (d, c) in out]
    by = {c: sum(d for _, j, d in out if j == c) for _, c, _ in out}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted((i, c, d, min(by[c], top), min(sum(by.values()), top), sha[c]) for i, c, d in out)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)


def test_brute(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(0, 3, (6, 5))
    rows = [(i, (centers[i % 6] + rng.normal(0, 0.2, 5)).tolist()) for i in range(700)]
    rows += [(9, rows[9][1])] * 200 + [(10, [0.0] * 5), (10, [1.0] * 5), (800, None), (801, []), (802, [1.0] * 4), (803, [None, 1.0, 1.0, 1.0, 1.0]), (804, [float("nan")] * 5), (805, [float("inf")] * 5), (None, [0.5] * 5)]
    clash = frame(spark, rows).withColumns({"cluster": F.lit("x"), "distance": F.lit(1), "v": F.lit(2)})
    got = dualtree.cluster(clash, 7, 4, 5, "3")
    assert sorted(map(tuple, got.collect())) == plain(rows, 7, 4, 5)
    few = rows[:3]
    assert sorted(map(tuple, dualtree.cluster(frame(spark, few), 8, 3, 5, "3").collect())) == plain(few, 8, 3, 5)
    assert dualtree.cluster(frame(spark, rows[:0] + [(1, None)]), 8, 3, 5, "3").count() == 0


@pytest.mark.parametrize("size", [1e9, 1e300])
def test_large_numbers_are_exact(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 3) * size).tolist()) for i in range(80)]
    assert sorted(map(tuple, dualtree.cluster(frame(spark, rows), 4, 3, 3, "3").collect())) == plain(rows, 4, 3, 3)


@pytest.mark.parametrize(("dim", "spread", "k"), [(2, 0.3, 40), (8, 0.05, 20), (16, 3.0, 5)])
def test_walk_is_exact_and_prunes(dim, spread, k):
    """Nearest centroids of a walk, ties included, and fewer comparisons than all where data have clusters."""
    rng = np.random.default_rng(dim)
    centers = rng.normal(0, 4, (k, dim))
    rows = np.floor(64 * (centers[rng.integers(0, k, 900)] + rng.normal(0, spread, (900, dim)))).astype(np.int64)
    cent = np.concatenate([np.floor(64 * centers).astype(np.int64), np.floor(64 * centers[:2]).astype(np.int64)])  # the last two tie
    tree = dualtree.cover_tree(rows)
    assert sorted(tree.order.tolist()) == list(range(900))
    for i in range(len(tree.low)):
        held = tree.order[tree.low[i] : tree.high[i]]
        assert tree.center[i] in held and (dualtree._distances(rows[held], rows[tree.center[i]][None, :]) <= tree.radius[i] + 1e-9).all()
        if tree.count[i]:
            kids = np.arange(tree.first[i], tree.first[i] + tree.count[i])
            assert (tree.high[kids] - tree.low[kids]).sum() == len(held)
            apart = rows[tree.center[kids]]
            assert len(kids) < 2 or min(dualtree._distances(apart[:j], apart[j][None, :]).min() for j in range(1, len(kids))) > tree.radius[i] / 2 - 1e-6
    near, whole, compared = dualtree.assign(tree, rows, dualtree.cover_tree(cent, 1), cent)
    for low, high, c in whole:
        assert (near[tree.order[low:high]] == -1).all()
        near[tree.order[low:high]] = c
    d = ((rows[:, None, :] - cent[None, :, :]) ** 2).sum(axis=2)
    assert (near == d.argmin(axis=1)).all()
    if spread < 1:
        assert compared < 0.3 * d.size


def test_one_place(spark):
    rows = [(i, [0.25, -0.25]) for i in range(300)]
    assert sorted(map(tuple, dualtree.cluster(frame(spark, rows), 3, 2, 2, "3").collect())) == plain(rows, 3, 2, 2)
