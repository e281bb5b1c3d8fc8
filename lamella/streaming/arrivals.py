"""Slices and log entries that arrive over time. An extension: the batch operators, made incremental."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import progress


def new_files(spark: SparkSession, folder: str, schema: str, per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that appear in folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def once_each(stream: DataFrame, keys: list[str], at: str, delay: str = "1 hour") -> DataFrame:
    """The stream without repeats of a key within the delay; state is dropped after it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def counts(stream: DataFrame, at: str, by: str, length: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """(start, by, n) over tumbling or sliding windows."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return stream.withWatermark(at, delay).groupBy(w.alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def sessions(stream: DataFrame, at: str, by: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """(start, end, by, n) over sessions that end after a gap."""
    w = F.session_window(at, gap)
    return stream.withWatermark(at, delay).groupBy(w.alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")


def process(stream: DataFrame, work: Callable[[DataFrame], DataFrame], output: str, log_path: str, step: str, checkpoint: str) -> StreamingQuery:
    """work() on each batch of slices (dataset, z, ...), written and logged; a batch that comes again does nothing twice.

    Log entries name their batch. Slices that other batches have logged are left
    out, so a batch replayed after a failure, wherever that was, works on the
    same slices again, rewrites its own folder with the same content, and logs
    what it hadn't logged.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = F.get_json_object("metadata", "$.batch") == str(number)
        log = progress.read(spark, log_path).where(F.col("step_name") == step).select(F.col("collection").alias("dataset"), F.col("local_slice").alias("z"), F.coalesce(own, F.lit(False)).alias("own"))
        rest = progress.pending(batch, log.where("not own").select("dataset", "z").distinct(), ["dataset", "z"])
        work(rest).write.mode("overwrite").parquet(f"{output}/batch={number}")
        rows = progress.pending(rest.select("dataset", "z").distinct(), log.where("own").select("dataset", "z"), ["dataset", "z"])
        meta = F.to_json(F.struct(F.lit(number).alias("batch")))
        progress.append(rows.select(F.col("dataset").alias("collection"), F.lit(step).alias("step_name"), F.col("z").alias("global_slice"), F.col("z").alias("local_slice"), F.current_timestamp().alias("ts"), meta.alias("metadata")), log_path)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
