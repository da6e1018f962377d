"""Sinks: manifests as JSON, Parquet and CSV, with columns in order and as strings where shards must unite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL, SHEET_ROWS = 32_767, 1_048_576


def manifest(segments: DataFrame, extras: DataFrame, key: str = "segment_id") -> DataFrame:
    """Segments with their extra columns, all columns by name."""
    joined = segments.join(extras, key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in sorted(joined.columns)])


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*[(F.to_json(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string")).alias(c) for c, t in df.dtypes])


def write_manifest(df: DataFrame, path: str, csv: bool = False, by_year: bool = False) -> None:
    """JSON lines as they are, Parquet with all columns as strings; Spark commits a folder as a whole."""
    df.write.mode("overwrite").json(f"{path}/json")
    as_strings(df).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/parquet")
    if csv:
        as_strings(df).write.mode("overwrite").option("header", "true").csv(f"{path}/csv")
    if by_year:
        df.write.mode("overwrite").partitionBy("year").json(f"{path}/by_year")
        if csv:
            df.write.mode("overwrite").partitionBy("year").option("header", "true").csv(f"{path}/by_year_csv")


def write_report(summary: DataFrame, path: str) -> None:
    """One row as a line of JSON with its names in order."""
    ordered = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(summary.columns)]))
    summary.select(ordered.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def merge_shards(parts: list[DataFrame], key: str) -> DataFrame:
    """Shards as one table with the union of their columns; a key in two shards is an error, raised when rows are read."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("_shard", F.lit(i)) for i, p in enumerate(parts)])
    held = every.groupBy(F.col(key).alias("_key")).agg(F.count_distinct("_shard").alias("_n"))
    once = F.assert_true(F.col("_n") == 1, F.concat(F.lit(f"{key} "), F.col("_key").cast("string"), F.lit(" is in more than one shard")))
    checked = every.join(held, F.col(key).eqNullSafe(F.col("_key"))).where(once.isNull())
    return checked.drop("_shard", "_key", "_n")


def sheet(df: DataFrame, most: int = SHEET_ROWS - 1) -> DataFrame:
    """Clean cells of a sheet with a header line; no rows if there are more than ``most``."""
    many = df.agg(F.count("*").alias("_rows"))
    return clean_cells(df).join(F.broadcast(many)).where(F.col("_rows") <= most).drop("_rows")


def clean_cells(df: DataFrame) -> DataFrame:
    """String cells without control characters, of at most as many characters as a sheet's cell holds."""
    return df.select(*[F.substring(F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""), 1, CELL).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
