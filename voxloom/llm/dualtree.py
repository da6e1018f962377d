"""Centroid clustering: Lloyd's rounds by dual trees.

Vectors are packed into blocks that stay where they are; each block has a cover tree over its vectors, built once, whose nodes know
the sum of what they hold. Every round broadcasts the centroids, over which each task builds a cover tree as well, and walks pairs of a node
of vectors and a node of centroids, all pairs of a level at a time. Distance bounds of nodes (centers and radii) drop pairs that can't
hold any vector's nearest centroid; a node that is left with one centroid adds its sum without a look at its vectors; pairs of leaves are compared exactly.
A task sends one row a cluster, so a round shuffles no vectors.

Components become whole numbers floor(scale * x). All distances, sums and means are exact: doubles where squares stay within 2**52, else Python's numbers.

Defined results: vectors that are null, have another number of components, a null or non-finite component or no id take no part; repeated
ids are vectors of their own (as first centroids those with the smaller components come first); fewer vectors than clusters give fewer clusters; an empty cluster
stays where it is; ties go to the smaller number; other columns are ignored; an empty table gives no rows. Distances and their sums that pass 64 bits
are given as the largest number of 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import compact, discard, materialise, table
from voxloom.llm.topk import _whole

#: Vectors of a block (one tree) and of a leaf.
BLOCK, LEAF = 1024, 16
#: Bytes of a block's vectors, however long these are.
BLOCK_BYTES = 4 << 20
#: Below this, sums of squares of differences in so many dimensions are exact as doubles.
EXACT = 2.0**52
LARGEST = (1 << 63) - 1


class Tree(NamedTuple):
    """A cover tree over rows of whole numbers; node 0 is the root, a node's children are ``kids[first:first + count]`` of the nodes."""

    order: np.ndarray  # rows in the order of the leaves
    center: np.ndarray  # by node: a row
    radius: np.ndarray  # no row of the node is farther from its center
    low: np.ndarray  # the node's rows are order[low:high]
    high: np.ndarray
    first: np.ndarray
    count: np.ndarray  # 0: a leaf


def _distances(a: np.ndarray, b: np.ndarray, unit: float = 1.0) -> np.ndarray:
    """Lengths of row-wise differences, as doubles (rounded), in units that keep squares of large numbers finite."""
    d = a.astype(np.float64) / unit - b.astype(np.float64) / unit
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def cover_tree(rows: np.ndarray, leaf: int = LEAF, unit: float = 1.0) -> Tree:
    """Radii are in the unit. Covers each node's rows by balls of half its radius, whose centers are farther than that from each other."""
    v = rows.astype(np.float64) / unit
    nodes: list[list] = []  # center, radius, rows, first child, children
    order: list[np.ndarray] = []
    at = 0

    def add(center: int, members: np.ndarray, dist: np.ndarray) -> None:
        nodes.append([center, float(dist.max(initial=0.0)), members, 0, 0, dist])

    if len(v):
        every = np.arange(len(v))
        add(0, every, _distances(v, v[:1]))
    while at < len(nodes):
        center, radius, members, _, _, dist = nodes[at]
        if len(members) > leaf and radius > 0:
            nodes[at][3] = len(nodes)
            left, d, half = members, dist, radius / 2
            c = center
            while len(left):
                inside = d <= half
                add(c, left[inside], d[inside])
                left = left[~inside]
                if len(left):
                    c = int(left[0])
                    d = _distances(v[left], v[c][None, :])
            nodes[at][4] = len(nodes) - nodes[at][3]
        nodes[at][5] = None
        at += 1
    # Leaves from left to right; then every node's rows are one stretch.
    low, high = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    stack, done = [(0, False)] if nodes else [], 0
    while stack:
        i, closed = stack.pop()
        if closed:
            high[i] = done
            continue
        low[i] = done
        stack.append((i, True))
        if nodes[i][4]:
            stack += [(j, False) for j in reversed(range(nodes[i][3], nodes[i][3] + nodes[i][4]))]
        else:
            order.append(nodes[i][2])
            done += len(nodes[i][2])
    pick = lambda j, kind: np.array([n[j] for n in nodes], kind)
    return Tree(np.concatenate(order) if order else np.zeros(0, np.int64), pick(0, np.int64), pick(1, np.float64) * (1 + 1e-12), low, high, pick(3, np.int64), pick(4, np.int64))


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of every number of the stretches that begin at starts."""
    owner = np.repeat(np.arange(len(starts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def assign(tree: Tree, rows: np.ndarray, ctree: Tree, centroids: np.ndarray, unit: float = 1.0) -> tuple[np.ndarray, list[tuple[int, int, int]], int]:
    """(nearest centroid of each row or -1, whole stretches of the tree's order with their centroid, exact comparisons).

    Rows in a stretch have no entry of their own.
    """
    near, whole, compared = np.full(len(rows), -1, np.int64), [], 0
    if not len(rows):
        return near, whole, 0
    vn, cn = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(vn):
        d = _distances(rows[tree.center[vn]], centroids[ctree.center[cn]], unit)
        best = np.full(len(tree.low), np.inf)
        np.minimum.at(best, vn, d + tree.radius[vn] + ctree.radius[cn])
        keep = d - tree.radius[vn] - ctree.radius[cn] <= best[vn] * (1 + 1e-9) + 1e-6
        vn, cn = vn[keep], cn[keep]
        single = ctree.count[cn] == 0
        pairs, open_c, far = np.bincount(vn, minlength=len(best)), np.zeros(len(best), bool), np.zeros(len(best))
        open_c[vn[~single]] = True
        np.maximum.at(far, vn, ctree.radius[cn])
        decided = (pairs[vn] == 1) & single & (ctree.high[cn] - ctree.low[cn] == 1)
        whole += zip(tree.low[vn[decided]].tolist(), tree.high[vn[decided]].tolist(), ctree.order[ctree.low[cn[decided]]].tolist(), strict=True)
        vn, cn, single = vn[~decided], cn[~decided], single[~decided]
        leaf = tree.count[vn] == 0
        exact = leaf & ~open_c[vn]
        if exact.any():
            compared += _compare(tree, rows, ctree, centroids, vn[exact], cn[exact], near)
        vn, cn, single, leaf = vn[~exact], cn[~exact], single[~exact], leaf[~exact]
        # The side with the larger radius is opened.
        split_c = open_c[vn] & (leaf | (far[vn] >= tree.radius[vn]))
        stay, opened, down = split_c & single, split_c & ~single, ~split_c
        own, kids = _spread(ctree.first[cn[opened]], ctree.count[cn[opened]])
        own2, kids2 = _spread(tree.first[vn[down]], tree.count[vn[down]])
        vn, cn = np.concatenate([vn[stay], vn[opened][own], kids2]), np.concatenate([cn[stay], kids, cn[down][own2]])
    return near, whole, compared


def _compare(tree: Tree, rows: np.ndarray, ctree: Tree, centroids: np.ndarray, vn: np.ndarray, cn: np.ndarray, near: np.ndarray) -> int:
    """Decides the rows of leaves against all centroids of the leaves that they are left with."""
    own, c_at = _spread(ctree.low[cn], ctree.high[cn] - ctree.low[cn])
    node, cent = vn[own], ctree.order[c_at]
    own, r_at = _spread(tree.low[node], tree.high[node] - tree.low[node])
    row, cent = tree.order[r_at], cent[own]
    d = rows[row] - centroids[cent]
    square = (d * d).sum(axis=1)
    by = np.lexsort((cent, square, row))
    row, cent = row[by], cent[by]
    firsts = np.append(True, row[1:] != row[:-1])
    near[row[firsts]] = cent[firsts]
    return len(square)


def _numbers(mat: np.ndarray, fits: bool) -> np.ndarray:
    """Whole doubles as exact numbers."""
    if fits:
        return mat.astype(np.int64)
    out = np.empty(mat.shape, dtype=object)
    out[:] = [[int(x) for x in r] for r in mat.tolist()]
    return out


def _packed(rows: DataFrame, dim: int, unit: float) -> DataFrame:
    """Blocks of each partition's (vec_id, v): ids, vectors in the tree's order, the tree."""
    size = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(dim, 1))))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), size):
                part = pdf.iloc[at : at + size]
                mat = np.stack(part["v"].to_list()).astype("<f8").reshape(len(part), -1)
                t = cover_tree(mat, LEAF, unit)
                back = np.empty(len(mat), np.int64)
                back[t.order] = np.arange(len(mat))
                shape = np.stack([back[t.center], t.low, t.high, t.first, t.count]).astype("<i8")
                yield pd.DataFrame({"ids": [part["vec_id"].to_numpy("<i8")[t.order].tobytes()], "mat": [mat[t.order].tobytes()], "nodes": [shape.tobytes()], "radii": [t.radius.astype("<f8").tobytes()]})

    return rows.select("vec_id", "v").mapInPandas(pack, "ids binary, mat binary, nodes binary, radii binary")


def _unpacked(r, dim: int, fits: bool) -> tuple[np.ndarray, np.ndarray, Tree]:
    ids, mat = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.mat, "<f8")
    center, low, high, first, count = np.frombuffer(r.nodes, "<i8").reshape(5, -1)
    return ids, _numbers(mat.reshape(len(ids), dim), fits), Tree(np.arange(len(ids)), center, np.frombuffer(r.radii, "<f8"), low, high, first, count)


def _sums(blocks: DataFrame, centroids: np.ndarray, fits: bool, unit: float) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Count and componentwise sum of every cluster that has vectors."""
    shared, (k, dim) = blocks.sparkSession.sparkContext.broadcast(centroids), centroids.shape

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cent = shared.value
        ctree = cover_tree(cent, 1, unit)
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), dtype=object)
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids, rows, tree = _unpacked(r, dim, fits)
                near, whole, _ = assign(tree, rows, ctree, cent, unit)
                upto = np.concatenate([np.zeros((1, dim), rows.dtype), np.cumsum(rows, axis=0)])
                for low, high, c in whole:
                    n[c] += high - low
                    total[c] += upto[high] - upto[low]
                for c in np.unique(near[near >= 0]).tolist():
                    mine = near == c
                    n[c] += mine.sum()
                    total[c] += rows[mine].sum(axis=0)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": np.repeat(some, dim).astype(np.int32), "at": np.tile(np.arange(dim), len(some)).astype(np.int32), "n": np.repeat(n[some], dim), "s": [str(x) for x in total[some].ravel()]})

    rows = blocks.mapInPandas(add, "cluster int, at int, n long, s string")
    if fits:
        added = rows.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"))
    else:
        # Sums of any length: the few rows a task are added as Python's numbers.
        added = rows.groupBy("cluster", "at").applyInPandas(
            lambda key, pdf: pd.DataFrame({"cluster": [key[0]], "at": [key[1]], "n": [int(pdf["n"].sum())], "s": [str(sum(map(int, pdf["s"])))]}), "cluster int, at int, n long, s string"
        )
    n, total = {}, {}
    for r in added.collect():  # clusters times dimensions
        n[r["cluster"]] = r["n"]
        total.setdefault(r["cluster"], [0] * dim)[r["at"]] = int(r["s"])
    return n, total


def _assigned(blocks: DataFrame, centroids: np.ndarray, fits: bool, unit: float) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; the squared distance is a decimal or, where numbers are large, held within 64 bits."""
    shared, dim = blocks.sparkSession.sparkContext.broadcast(centroids), centroids.shape[1]

    def give(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cent = shared.value
        ctree = cover_tree(cent, 1, unit)
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids, rows, tree = _unpacked(r, dim, fits)
                near, whole, _ = assign(tree, rows, ctree, cent, unit)
                for low, high, c in whole:
                    near[low:high] = c
                d = rows - cent[near]
                square = (d * d).sum(axis=1)
                yield pd.DataFrame({"vec_id": ids, "cluster": near.astype(np.int32), "distance": np.array([min(int(x), LARGEST) for x in square], np.int64)})

    return blocks.mapInPandas(give, "vec_id long, cluster int, distance long")


def cluster(vecs: DataFrame, k: int, rounds: int, dim: int, seed: str, vec_id: str = "vec_id", vec: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) after so many rounds.

    The first centroids are the k vectors with the smallest sha256 of ``seed:id``.
    """
    spark = vecs.sparkSession
    v = F.col(f"`{vec}`").cast("array<double>")
    ok = F.col(f"`{vec_id}`").isNotNull() & v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = vecs.where(ok).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.transform(v, lambda x: _whole(x, scale)).alias("v"))
    first = good.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)).orderBy("h", "v").limit(k).collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    widest = good.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))).first()[0]
    fits = 2 * widest * max(dim, 1) ** 0.5 < EXACT**0.5
    unit = 1.0 if fits else float(widest)
    blocks = materialise(_packed(good, dim, unit), "cluster-trees")
    centroids = _numbers(np.array([r["v"] for r in first], np.float64).reshape(len(first), dim), fits)
    for _ in range(rounds):
        n, total = _sums(blocks, centroids, fits, unit)
        for c, count in n.items():
            centroids[c] = [s // count for s in total[c]]
    done = materialise(_assigned(blocks, centroids, fits, unit), "clusters")
    discard(blocks)
    inertia = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(inertia.values())
    named = [(c, min(s, LARGEST), min(whole, LARGEST), hashlib.sha256(",".join(str(int(x)) for x in centroids[c]).encode()).hexdigest()) for c, s in inertia.items()]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select(*[x.split()[0] for x in result.split(", ")])


def op12_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors of 64 components: 8 of them, ten rounds."""
    return cluster(compact(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")), 8, 10, 64, "3")


def _oracle(k: int = 8, rounds: int = 10) -> str:
    """Plain rounds, one pair of subqueries each."""
    out = [
        """
v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""",
        f"""
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c FROM v
  QUALIFY cluster < {k}
)""",
    ]
    near = """
a{i} AS MATERIALIZED (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT r, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{i}) GROUP BY r
)"""
    move = """
c{j} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c
    FROM (SELECT cluster, pos, sum(x) AS s, count(*) AS n FROM (SELECT r, unnest(v) AS x, unnest(range(1, 65)) AS pos FROM v) JOIN a{i} USING (r) GROUP BY cluster, pos)
    GROUP BY cluster
  ) m USING (cluster)
)"""
    for i in range(rounds):
        out += [near.format(i=i), move.format(i=i, j=i + 1)]
    out.append(near.format(i=rounds))
    return f"""WITH {",".join(out)}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} USING (cluster)
"""


ORACLE_SQL = _oracle()
