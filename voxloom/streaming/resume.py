"""Incremental runs as streams: each file is taken once, and state survives between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.state import latest
from voxloom.sources.work import write_work

#: Parts of a streamed table that are rewritten apart from each other.
BUCKETS = 64


def take_new(spark: SparkSession, source: str, schema, target: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = BUCKETS) -> None:
    """Applies files that have come since the last run to the table at ``target``, the last write of a key wins.

    Keys are dealt into buckets. A batch writes new versions of the buckets that it touches, and then a list of the version of
    every bucket, which makes them the table's; a batch that runs again writes the same, so
    a lost driver or executor repeats work but doesn't double it. Versions that neither this list nor the one before has are deleted.
    """

    def apply(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        new = write_work(batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "batch")
        before = _versions(session, target, number - 1)
        touched = [r[0] for r in new.select("_bucket").distinct().collect()]  # at most ``buckets``
        old = {b: before[b] for b in touched if b in before}
        if old:
            new = new.unionByName(_buckets(session, target, old), allowMissingColumns=True)
        latest(new, ["_bucket", *keys], order).write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/data/_version={number}")
        after = before | dict.fromkeys(touched, number)
        session.createDataFrame(sorted(after.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").json(f"{target}/list/_version={number}")
        for v in _numbers(session, f"{target}/data") - {*before.values(), *after.values()}:
            _delete(session, f"{target}/data/_version={v}")
        for v in _numbers(session, f"{target}/list") - {number, number - 1}:
            _delete(session, f"{target}/list/_version={v}")

    spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The table's last version."""
    return _buckets(spark, target, _versions(spark, target, max(_numbers(spark, f"{target}/list")))).drop("_bucket")


def _versions(spark: SparkSession, target: str, number: int) -> dict[int, int]:
    """Bucket to version, as the list of a batch has it; none if there is no such list."""
    path = f"{target}/list/_version={number}"
    if number < 0 or not _exists(spark, path):
        return {}
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version long").json(path).collect()}


def _buckets(spark: SparkSession, target: str, versions: dict[int, int]) -> DataFrame:
    """The rows of buckets at their versions."""
    rows = spark.read.option("basePath", f"{target}/data").parquet(*[f"{target}/data/_version={v}" for v in sorted(set(versions.values()))])
    wanted = spark.createDataFrame(sorted(versions.items()), "_bucket int, _version long").withColumn("_version", F.col("_version").cast(dict(rows.dtypes)["_version"]))
    return rows.join(F.broadcast(wanted), ["_bucket", "_version"], "left_semi").drop("_version")


def _numbers(spark: SparkSession, path: str) -> set[int]:
    if not _exists(spark, path):
        return set()
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)]
    return {int(n.partition("=")[2]) for n in names if n.startswith("_version=")}


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by tumbling window and type; on a stream, later rows than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
