"""Tables that appear as a whole, and scans that are kept while their folder doesn't change."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.state import signature
from voxloom.sources.calls import AUDIO, scan


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def publish(df: DataFrame, path: str) -> None:
    """Replaces a table at a path: readers see the old one or the new one, never a part.

    It is written beside the path and renamed; if the write fails, what is there stays and the part is deleted.
    """
    spark, own = df.sparkSession, uuid.uuid4().hex
    staged, old = f"{path.rstrip('/')}.staged-{own}", f"{path.rstrip('/')}.old-{own}"
    fs, to = _fs(spark, path)
    start, aside = _fs(spark, staged)[1], _fs(spark, old)[1]
    try:
        df.write.parquet(staged)
        fs.mkdirs(to.getParent())
        moved = fs.exists(to) and fs.rename(to, aside)
        if not fs.rename(start, to):
            if moved:
                fs.rename(aside, to)
            raise OSError(f"{staged} can't be renamed to {path}")
    finally:
        fs.delete(start, True)
    fs.delete(aside, True)


def cached_scan(spark: SparkSession, root: str, cache: str, endings: tuple[str, ...] = AUDIO) -> tuple[DataFrame, bool]:
    """A scan of a folder, and whether it came from the cache.

    The cache holds the files and the signature of their paths and sizes; if it is missing, broken or of another state of the
    folder, the folder's own listing is taken and published as the cache.
    """
    live = scan(spark, root, endings)
    now = signature(live, "path", "length").first()
    if exists(spark, f"{cache}/_SUCCESS"):
        try:
            kept = spark.read.parquet(cache)
            held = kept.select("signature").first()
            if held is not None and held["signature"] == now["signature"] and kept.count() == now["files"]:
                return kept.drop("signature"), True
        except (PySparkException, Py4JJavaError):
            pass  # a broken cache is as good as none
    publish(live.withColumn("signature", F.lit(now["signature"])), cache)
    return spark.read.parquet(cache).drop("signature"), False
