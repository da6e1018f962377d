"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where work tables go if a session on one machine (tests) names no folder.
_own_dir: dict[str, str] = {}
#: Words of 64 bits of a key filter: it's broadcast, so this is its bound (4 MB of numbers) whatever the keys.
FILTER_WORDS = 1 << 18
#: Rows that go to a Python worker at a time: rows may hold long texts.
ARROW_ROWS = 1000
#: Texts, and narrow rows of a result, that a task writes.
TEXT_ROWS, RESULT_ROWS = 4000, 20_000
#: Narrow rows (keys and labels) that a task of a work table writes.
FILE_ROWS = 250_000
#: Bytes that a task reads, as Spark estimates them after it has pruned columns: small, so that only tiny partitions are put together.
FILE_BYTES = 6 << 20


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share (spark.checkpoint.dir)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _own_dir.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="voxloom-"))
    return f"{base.rstrip('/')}/voxloom/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Sets the session's rows of an Arrow batch to ARROW_ROWS, unless someone has set another number than Spark's own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, ARROW_ROWS)


def compact(df: DataFrame, rows: int | None = None, each: int = FILE_ROWS) -> DataFrame:
    """No more tasks than df needs: one for ``each`` of the ``rows`` that are expected at most, or, where these aren't known, for FILE_BYTES of what is read, but two a core at least."""
    if rows is not None:
        tasks = -(-rows // each)
    else:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    return df.coalesce(min(max(1, tasks), 1 << 20))


def materialise(df: DataFrame, name: str, rows: int | None = None, each: int = FILE_ROWS) -> DataFrame:
    """Write a work table and read it back: cuts the lineage in storage that outlives executors. See compact() for rows and each."""
    path = work_dir(df.sparkSession, name)
    df = compact(df, rows, each)
    small_batches(df.sparkSession)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.work_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes work tables whose last reader has been written."""
    for df in tables:
        remove(df.sparkSession, df.work_path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of the shared folder, by the file system that it's on."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """These names, each with so many underscores in front that no column of df has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    """All columns of df, also those whose names hold dots."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def _place(key: Column) -> tuple[Column, Column]:
    """Word and bits of a 64-bit hash in a key filter."""
    word = F.pmod(key, F.lit(FILTER_WORDS)).cast("int")
    one = F.lit(1).cast("long")
    spread = F.xxhash64(key)
    bits = F.call_function("shiftleft", one, F.pmod(spread, F.lit(64)).cast("int")).bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.shiftright(spread, 20), F.lit(64)).cast("int")))
    return word, bits


def sift(rows: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """Adds a column: false only where ``key`` isn't among ``keys`` (its one column, 64-bit hashes).

    A key filter of bounded size is broadcast: rows that it rules out need no shuffle to learn that they have no partner. With
    more keys than it has bits it rules out few, and the join that follows does the work.
    """
    (only,) = keys.columns
    word, bits = _place(F.col(only))
    made = keys.select(word.alias("w"), bits.alias("bits")).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    w, b = free_names(rows, "_word", "_bits")
    word, mine = _place(key)
    out = rows.join(F.broadcast(made.select(F.col("w").alias(w), F.col("bits").alias(b))), word == F.col(w), "left")
    return out.select(*columns(rows), F.coalesce(F.col(b).bitwiseAND(mine) == mine, F.lit(False)).alias(name))


def look_up(rows: DataFrame, keys: list[Column], found: DataFrame) -> DataFrame:
    """A left join with the work table ``found``: as many key columns, once each, then values whose names rows doesn't have.

    Only rows that the key filter can't rule out are shuffled.
    """
    n = len(keys)
    own, kinds = columns(rows), found.schema.fields[n:]
    names = free_names(rows, *(f"_k{i}" for i in range(2 * n)), "_maybe")
    mine, theirs, maybe = names[:n], names[n : 2 * n], names[-1]
    hashed = rows.select(*own, *[k.alias(c) for k, c in zip(keys, mine, strict=True)])
    sifted = sift(hashed, F.xxhash64(*mine), found.select(F.xxhash64(*found.columns[:n]).alias("k")), maybe)
    sure = sifted.where(~F.col(maybe)).select(*own, *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds])
    renamed = found.select(*[F.col(a).alias(b) for a, b in zip(found.columns, theirs, strict=False)], *[F.col(f.name) for f in kinds])
    same = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(mine, theirs, strict=True)])
    unsure = sifted.where(maybe).join(renamed.hint("merge"), same, "left").select(*own, *[F.col(f.name) for f in kinds])
    return sure.unionAll(unsure)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that no model may learn from; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
