"""Stacks from a listing of paths: which slices each dataset has, in which runs, and what is missing.

    python -m jobs.stacks --input /data/listing.parquet --output /data/stacks [--config stacks.json]

The first step of an alignment project. A path gives a dataset, a stack and a
slice number; the pattern of the configuration says where they stand. Of the
paths of a slice the first by name counts, as copies of a file don't make
another slice. Slices of a dataset on which the same set of stacks is present,
one after the other, are a run: it is stitched as one stack, or as a combined
one if it has several. Slices that are missing between the first and the last of
a dataset are listed too, with the run before and the run after, from which an
alignment can take a substitute.

output/slices and output/gaps, in folders by the hash of the dataset, so that
one with most of the slices or millions of small ones make no other layout. A
run overwrites what an earlier one wrote, with the same rows for the same input.
Paths that don't fit the pattern are counted and left out.
"""

from __future__ import annotations

import argparse
import json
import logging
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import names
from lamella.operators import asof, islands

log = logging.getLogger("jobs.stacks")
DEFAULTS = Path(__file__).with_name("stacks.json")


def parsed(listing: DataFrame, config: dict) -> DataFrame:
    """(dataset, stack, z, path) of each path; dataset is null where the pattern doesn't fit or a number is too long."""
    path = F.col(config["path"])
    part = lambda i: F.regexp_extract(path, config["pattern"], i)
    plain = reduce(lambda name, p: F.when(name.startswith(p), F.substring(name, F.lit(len(p) + 1), F.length(name))).otherwise(name), config["prefixes"], part(1))
    fits = F.coalesce(path.rlike(config["pattern"]), F.lit(False)) & part(3).try_cast("int").isNotNull()
    return listing.select(F.when(fits, plain).alias("dataset"), part(2).alias("stack"), part(3).try_cast("int").alias("z"), path.alias("path"))


def slices(paths: DataFrame, band: int) -> DataFrame:
    """(dataset, z, run, name, combined, members, n_paths, first_path) of each slice that a dataset has."""
    found = paths.groupBy("dataset", "z", "stack").agg(F.min("path").alias("path"), F.count("*").alias("n"))
    members = F.array_sort(F.collect_set("stack"))
    by_slice = found.groupBy("dataset", "z").agg(members.alias("members"), F.sum("n").alias("n_paths"), F.min("path").alias("first_path"))
    runs = islands.banded(by_slice, "z", F.col("members"), ["dataset"], band, "run")
    name = F.concat_ws("_", names.zero_filled(F.col("run"), 2), F.array_join("members", "_"))
    return runs.select("dataset", "z", "run", name.alias("name"), (F.size("members") > 1).alias("combined"), F.array_join("members", ",").alias("members"), "n_paths", "first_path")


def gaps(present: DataFrame, band: int) -> DataFrame:
    """(dataset, z_start, z_end, n, before, after): slices [z_start, z_end) that lie between two of a dataset's, and the runs beside them.

    A gap is one row, however long it is.
    """
    ends = present.select("dataset", "z", "run", (F.col("z") + 1).alias("next"))
    after = asof.banded(ends, present.select("dataset", F.col("z").alias("to"), F.col("run").alias("after")), "next", "to", band, back=False, by=["dataset"], carry=["after"])
    return after.where("to > next").select("dataset", F.col("next").alias("z_start"), F.col("to").alias("z_end"), (F.col("to") - F.col("next")).alias("n"), F.col("run").alias("before"), "after")


def _write(df: DataFrame, path: str, folders: int) -> None:
    part = F.pmod(F.hash("dataset"), F.lit(folders)).alias("part")
    df.select("*", part).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(path)


def run(spark: SparkSession, source: str, output: str, config: dict | None = None) -> DataFrame:
    """Write the slices and gaps of a listing; the slices as they stand, each with its run's extent and the gap after it.

    z_start and z_end bound the run's slices, half-open; gap is the number of
    missing slices right after this one.
    """
    config = json.loads(DEFAULTS.read_text()) | (config or {})
    listing = parsed(spark.read.parquet(source).select(config["path"]), config)
    read = listing.agg(F.count("*").alias("paths"), F.count("dataset").alias("fit")).first()
    log.info("read %d paths of %s, %d don't fit the pattern", read["paths"], source, read["paths"] - read["fit"])
    _write(slices(listing.where("dataset is not null"), config["band"]), f"{output}/slices", config["folders"])
    present = spark.read.schema(SLICES).parquet(f"{output}/slices")
    _write(gaps(present, config["band"]), f"{output}/gaps", config["folders"])
    missing = spark.read.schema(GAPS).parquet(f"{output}/gaps")
    n = missing.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("z")).first()
    log.info("wrote %d slices and %d gaps of %d slices to %s", present.count(), n["n"], n["z"], output)
    return whole(present, missing)


SLICES = "dataset string, z int, run long, name string, combined boolean, members string, n_paths long, first_path string, part int"
GAPS = "dataset string, z_start int, z_end int, n int, before long, after long, part int"


def whole(present: DataFrame, missing: DataFrame) -> DataFrame:
    """Slices with their run's extent and the gap after them."""
    at = lambda c, name: F.col(c).alias(name)
    runs = present.groupBy(at("dataset", "of"), at("run", "of_run")).agg(F.min("z").alias("z_start"), (F.max("z") + 1).alias("z_end"))
    gap = missing.select(at("dataset", "gap_of"), (F.col("z_start") - 1).alias("gap_at"), at("n", "gap"))
    found = present.drop("part").join(runs, (F.col("dataset") == F.col("of")) & (F.col("run") == F.col("of_run")))
    found = found.join(gap, (F.col("dataset") == F.col("gap_of")) & (F.col("z") == F.col("gap_at")), "left")
    return found.withColumn("gap", F.coalesce("gap", F.lit(0))).drop("of", "of_run", "gap_of", "gap_at")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("--input", "--output"):
        parser.add_argument(name, required=True)
    parser.add_argument("--config", help="JSON; overrides the defaults beside this file")
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = json.loads(Path(given.config).read_text()) if given.config else None
    spark = SparkSession.builder.appName("stacks").getOrCreate()
    try:
        run(spark, given.input, given.output, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
