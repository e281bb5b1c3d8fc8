"""Configuration documents: schemas, reading, defaults and checks.

Documents are read with an explicit schema; a check gives rows (level, item,
message), so that a caller can list all that is wrong at once.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STACK = "combined boolean, z_start int, z_end int, tile_maps map<string, map<string, string>>, tile_maps_invert map<string, boolean>"
MAIN = "project_name string, main_dir string, stack_configs map<string, string>, tilesets_combined int, resolution array<int>, offset array<int>, output_path string, scale double, stride int, overlap int, apply_gaussian boolean, apply_clahe boolean, io_mode string"
PLAN = "root_stack string, paths array<array<string>>, reverse_order array<boolean>, root_offset array<int>, pad_offset array<int>, yx_target_resolution array<int>, dataset_local_bounds map<string, array<int>>, destination_path string, project_name string, _config_version string, _created_at string"
FUSE = "dataset_paths array<string>, z_offsets array<int>, zmin int, zmax int"
DATASET = "dataset_name string, dataset_path string, first_slice int, z_offset int, reverse_order boolean, flow struct<patch:int, stride:int, max_size:double, max_deviation:double>, mesh struct<dt:double, pull:double, spring:double, most:int>, scale double, output_path string"
REQUIRED = {"stack": ["z_start", "z_end", "tile_maps"], "plan": ["root_stack", "paths", "reverse_order", "root_offset", "dataset_local_bounds", "destination_path"], "dataset": ["dataset_name", "dataset_path", "first_slice", "z_offset", "flow", "mesh", "output_path"]}


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row a document, with its file in _file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("_file", F.col("_metadata.file_path"))


def tile_maps(stacks: DataFrame) -> DataFrame:
    """(_file, z, tx, ty, path, invert) of stack documents, whose keys are slices and positions as text."""
    slices = stacks.select("_file", "tile_maps_invert", F.explode("tile_maps").alias("z", "tiles"))
    tiles = slices.select("_file", "tile_maps_invert", F.col("z").cast("int").alias("z"), F.explode("tiles").alias("key", "path"))
    pos = F.transform(F.regexp_extract_all("key", F.lit(r"(-?\d+)"), 1), lambda x: x.cast("int"))
    return tiles.select("_file", "z", F.get(pos, F.lit(0)).alias("tx"), F.get(pos, F.lit(1)).alias("ty"), "path", F.coalesce(F.try_element_at("tile_maps_invert", F.col("key")), F.lit(False)).alias("invert"))


def missing(docs: DataFrame, required: list[str]) -> DataFrame:
    """(level, item, message) for each required field that a document lacks."""
    lost = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required]))
    return docs.select(F.lit("error").alias("level"), F.col("_file").alias("item"), F.explode(lost).alias("f")).select("level", "item", F.concat(F.lit("missing field: "), "f").alias("message"))


def check_plan(plan: DataFrame, datasets: DataFrame, version: str = "1.0") -> DataFrame:
    """(level, item, message): lengths that don't match, datasets without a document and the reverse, an unknown version."""
    named = plan.select(F.explode(F.flatten("paths")).alias("item")).distinct()
    have = datasets.select(F.col("dataset_name").alias("item")).distinct()
    row = lambda df, level, text: df.select(F.lit(level).alias("level"), "item", F.lit(text).alias("message"))
    uneven = plan.where(F.size("paths") != F.size("reverse_order")).select(F.col("root_stack").alias("item"))
    old = plan.where(~F.coalesce(F.col("_config_version") == version, F.lit(False))).select(F.col("root_stack").alias("item"))
    bound = named.join(plan.select(F.explode(F.map_keys("dataset_local_bounds")).alias("item")), "item", "left_anti")
    out = row(named.join(have, "item", "left_anti"), "error", "no document for dataset")
    for df, level, text in ((have.join(named, "item", "left_anti"), "warning", "dataset is in no path"), (uneven, "error", "paths and reverse_order differ in length"), (old, "warning", "unknown version"), (bound, "error", "no local bounds for dataset")):
        out = out.unionByName(row(df, level, text))
    return out


def merged(defaults: dict, given: dict) -> dict:
    """Defaults overridden by what is given, group by group."""
    return {k: merged(v, given.get(k) or {}) if isinstance(v, dict) else given.get(k, v) for k, v in defaults.items()} | {k: v for k, v in given.items() if k not in defaults}


def accepted(fields: Column, function: Callable) -> Column:
    """A map of parameters cut down to those that function takes by name."""
    names = [F.lit(n) for n in inspect.signature(function).parameters]
    return F.map_filter(fields, lambda k, _: k.isin(*names))


def stamped(docs: DataFrame, version: str = "1.0") -> DataFrame:
    """Documents with the version of their form and the time of their making, ISO 8601 in UTC."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return docs.withColumns({"_config_version": F.lit(version), "_created_at": now})
