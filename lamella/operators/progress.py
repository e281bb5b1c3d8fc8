"""The progress log as an append-only table, and what is asked of it.

Columns: collection, step_name, global_slice, local_slice, ts, metadata (JSON).
Both slice numbers are named columns, so a step can't be looked up by the wrong
one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "collection string, step_name string, global_slice int, local_slice int, ts timestamp, metadata string"


def entries(done: DataFrame, collection: str, step: str, metadata: list[str] | None = None) -> DataFrame:
    """Log rows for slices (global_slice, local_slice, ...) done just now."""
    meta = F.to_json(F.struct(*metadata)) if metadata else F.lit("{}")
    return done.select(F.lit(collection).alias("collection"), F.lit(step).alias("step_name"), F.col("global_slice").cast("int"), F.col("local_slice").cast("int"), F.current_timestamp().alias("ts"), meta.alias("metadata"))


def append(log: DataFrame, path: str) -> None:
    log.write.mode("append").partitionBy("collection").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The log, or an empty one if none has been written."""
    from ..sources import store

    return store.read(spark, path, SCHEMA, missing_ok=True)


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(done, keys, "left_anti")


def completed(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(done, keys, "left_semi")


def completion(wanted: DataFrame, done: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """(by, wanted, done, complete) for each group; done has each key once."""
    both = wanted.distinct().join(done.withColumn("__done", F.lit(1)), keys, "left")
    n = both.groupBy(*by).agg(F.count("*").alias("wanted"), F.count("__done").alias("done"))
    return n.withColumn("complete", F.col("done") >= F.col("wanted"))


def wiped(log: DataFrame, collection: str, step: str | None = None) -> DataFrame:
    """The log without a collection, or without one step of it."""
    gone = F.col("collection") == collection
    return log.where(~(gone & (F.col("step_name") == step) if step else gone))
