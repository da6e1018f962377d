"""Incremental state: upserts, pending work, chunks and batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.order import running
from voxloom.operators.packing import pack

#: Lines of a node of the tree that a signature is the root of.
FAN = 10_000


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last write of each key; partial maxima keep a frequent key from one task."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def upsert(table: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table with changes applied: of each key the last write by ``order``."""
    return latest(table.unionByName(changes, allowMissingColumns=True), keys, order)


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose key isn't done."""
    return work.join(done.select(*keys), keys, "left_anti")


def signature(rows: DataFrame, path: str, size: str, fan: int = FAN) -> DataFrame:
    """One row: the signature of all ``path:size`` lines in order, and their number.

    It is the root of a hash tree: each ``fan`` consecutive lines have a digest, their digests are the next level's lines, and the
    last level has one. The same at every size: up to ``fan`` lines that one is the digest of all lines, as they are; no task sees more of a level.
    """
    line = F.concat_ws(":", F.col(path).cast("string"), F.col(size).cast("string"))
    level = rows.select(F.col(path).cast("string").alias("p"), F.col(size).cast("long").alias("n"), line.alias("l"))
    files = left = rows.count()
    order = [F.col("p"), F.col("n")]
    while True:
        placed = running(level, order).select(F.floor(F.col("before") / fan).alias("g"), F.struct("before", "l").alias("x"))
        digest = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["l"]), "\n"), 256)
        if left <= fan:
            return placed.agg(F.substring(digest, 1, 24).alias("signature")).withColumn("files", F.lit(files).cast("long"))
        level, left, order = placed.groupBy("g").agg(digest.alias("l")), -(-left // fan), [F.col("g")]


def digest_of_lines(rows: DataFrame, path: str, size: str, fan: int = 100) -> DataFrame:
    """One row: the start of the SHA-256 of all ``path:size`` lines in order, joined by line feeds (null without lines), and the number of rows.

    Lines are sorted and joined in ranges of ``fan``, in all tasks. SHA-256 goes through its input in order, so one task is fed them one after another; it holds an Arrow batch of them at a time.
    """
    lines = rows.select(F.col(path).cast("string").alias("p"), F.col(size).cast("long").alias("n"))
    # A line without path or size is null: it counts as a row and isn't signed.
    signed = running(lines.where("p is not null and n is not null").withColumn("l", F.concat_ws(":", "p", F.col("n").cast("string"))), [F.col("p"), F.col("n")])
    ranges = signed.groupBy(F.floor(F.col("before") / fan).alias("g")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("before", "l"))), lambda x: x["l"]), "\n").alias("l"))

    def fed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, first = hashlib.sha256(), True
        for pdf in batches:
            for text in pdf["l"]:
                whole.update((text if first else "\n" + text).encode())
                first = False
        yield pd.DataFrame({"signature": [None if first else whole.hexdigest()[:24]]})

    signature = ranges.repartition(1).sortWithinPartitions("g").select("l").mapInPandas(fed, "signature string")
    return lines.agg(F.count("*").alias("files")).join(signature, F.lit(True), "left").select("signature", "files")


def chunks(rows: DataFrame, call: str, target: int, order: list[str]) -> DataFrame:
    """(call, chunk): whole calls in the order in which their first rows are seen; a chunk closes once it has ``target`` rows. A larger call closes its chunk."""
    sizes = rows.groupBy(call).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("seen"))
    return pack(sizes, [F.col("seen"), F.col(call)], F.col("n"), "target", target, target, [call]).withColumnRenamed("batch", "chunk")


def batches(rows: DataFrame, size: str, key: str, most: int, budget: float, rule: str = "budget") -> DataFrame:
    """(key, batch): all rows, shortest first, until ``most`` rows or ``budget`` in all (``padded``: or rows times the longest); a larger row is alone."""
    return pack(rows, [F.coalesce(F.col(size), F.lit(0)), F.col(key)], F.greatest(F.col(size), F.lit(0)), rule, most, budget, [key])
