"""Work tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; a session on one machine that has none (tests) gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _own_dir.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="voxloom-"))
    return f"{base.rstrip('/')}/voxloom/{name}-{uuid.uuid4().hex}"


def write_work(df: DataFrame, name: str) -> DataFrame:
    """Writes a table and reads it back: cuts the lineage in storage that outlives executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
