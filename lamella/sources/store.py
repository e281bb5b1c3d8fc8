"""The chunked image store on Parquet.

A store is a folder with `chunks`, partitioned by z: rows (z, cy, cx, y0, x0, h,
w, px binary, mask binary), and `attributes` (name, value as JSON). The extent
is never stored; it follows from the rows, so writing outside the present one
needs nothing special. Scans prune by z as partition and by cy, cx through
Parquet statistics.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 512
CHUNKS = "z int, cy int, cx int, y0 int, x0 int, h int, w int, px binary, mask binary"
#: How a store is opened: read, read and replace slices, append, replace all, only if absent.
MODES = {"r": None, "r+": "overwrite", "a": "append", "w": "overwrite", "w-": "error"}


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """The table at path; an empty one of the same schema if it is absent and may be."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def open_chunks(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    return read(spark, f"{path}/chunks", CHUNKS, missing_ok)


def write_chunks(chunks: DataFrame, path: str, mode: str = "a") -> None:
    """Write chunks. r+ replaces the slices that chunks holds and leaves the others."""
    if not MODES.get(mode):
        raise ValueError(f"can't write in mode {mode!r}")
    columns = [c.split()[0] for c in CHUNKS.split(", ")]
    out = chunks.select(*columns).repartition("z").sortWithinPartitions("z", "cy", "cx").write.mode(MODES[mode]).partitionBy("z")
    out.option("partitionOverwriteMode", "dynamic" if mode == "r+" else "static").parquet(f"{path}/chunks")


def cut(images: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks of slices (z, h, w, px[, mask]) whose corner is at (y0, x0), by default the origin; corners must not be negative."""
    has = set(images.columns)
    rows = images.select("z", "h", "w", "px", *[(F.col(c) if c in has else F.lit(0)).cast("int").alias(c) for c in ("y0", "x0")], (F.col("mask") if "mask" in has else F.lit(None).cast("binary")).alias("mask"))
    rows = rows.where(F.assert_true((F.col("y0") >= 0) & (F.col("x0") >= 0), F.lit("offsets must not be negative")).isNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        for batch in batches:
            for r in batch.to_dict("records"):
                px = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])
                mask = None if r["mask"] is None else np.frombuffer(r["mask"], np.uint8).reshape(r["h"], r["w"])
                out = []
                for cy in range(r["y0"] // size, (r["y0"] + r["h"] - 1) // size + 1):
                    for cx in range(r["x0"] // size, (r["x0"] + r["w"] - 1) // size + 1):
                        y, x = max(r["y0"], cy * size), max(r["x0"], cx * size)
                        box = np.s_[y - r["y0"] : (cy + 1) * size - r["y0"], x - r["x0"] : (cx + 1) * size - r["x0"]]
                        own = px[box]
                        out.append((r["z"], cy, cx, y, x, *own.shape, own.tobytes(), None if mask is None else mask[box].tobytes()))
                yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, CHUNKS)


def merge(old: DataFrame, new: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks of old with those of new written over them: where new's mask is true, or everywhere if it has none.

    A chunk of the result spans its whole cell as far as any part of it reaches;
    pixels that neither has are 0. Writing the same twice changes nothing.
    """
    columns = [c.split()[0] for c in CHUNKS.split(", ")]
    both = old.select(*columns, F.lit(0).alias("rank")).unionByName(new.select(*columns, F.lit(1).alias("rank")))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        top = frame.iloc[0]
        cy, cx = int(top["cy"]) * size, int(top["cx"]) * size
        h, w = int((frame["y0"] + frame["h"]).max()) - cy, int((frame["x0"] + frame["w"]).max()) - cx
        px, mask = np.zeros((h, w), np.uint8), np.zeros((h, w), np.uint8)
        for r in frame.sort_values(["rank", "y0", "x0"], kind="stable").to_dict("records"):
            own = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])
            use = np.ones(own.shape, bool) if r["mask"] is None else np.frombuffer(r["mask"], np.uint8).reshape(own.shape) > 0
            box = np.s_[r["y0"] - cy : r["y0"] - cy + r["h"], r["x0"] - cx : r["x0"] - cx + r["w"]]
            px[box][use], mask[box][use] = own[use], 1
        return pd.DataFrame([(top["z"], top["cy"], top["cx"], cy, cx, h, w, px.tobytes(), mask.tobytes())], columns=columns)

    return both.groupBy("z", "cy", "cx").applyInPandas(run, CHUNKS)


def read_window(chunks: DataFrame, z: tuple[int, int], y: tuple[int, int] | None = None, x: tuple[int, int] | None = None, size: int = CHUNK, keep_empty: bool = True) -> DataFrame:
    """(z, h, w, px) of the half-open box, clamped at 0; only chunks that it touches are read.

    A slice without any chunk in the box has no row; one whose pixels are all 0
    has none either unless keep_empty.
    """
    y, x = (None if b is None else (max(0, b[0]), b[1]) for b in (y, x))
    out = chunks.where((F.col("z") >= max(0, z[0])) & (F.col("z") < z[1]))
    for b, c in ((y, "cy"), (x, "cx")):
        if b:
            out = out.where(F.col(c).between(b[0] // size, (b[1] - 1) // size))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        y1, x1 = int((frame["y0"] + frame["h"]).max()), int((frame["x0"] + frame["w"]).max())
        (ya, yb), (xa, xb) = (b if b else (0, n) for b, n in ((y, y1), (x, x1)))
        full = np.zeros((min(yb, y1), min(xb, x1)), np.uint8)
        for r in frame.to_dict("records"):
            own = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])
            part = full[r["y0"] : r["y0"] + r["h"], r["x0"] : r["x0"] + r["w"]]
            part[...] = own[: part.shape[0], : part.shape[1]]
        full = full[ya:, xa:]
        if not full.size or not (keep_empty or full.any()):
            return pd.DataFrame(columns=["z", "h", "w", "px"])
        return pd.DataFrame({"z": [int(frame["z"].iloc[0])], "h": [full.shape[0]], "w": [full.shape[1]], "px": [full.tobytes()]})

    return out.select("z", "y0", "x0", "h", "w", "px").groupBy("z").applyInPandas(run, "z int, h int, w int, px binary")


def extent(chunks: DataFrame) -> DataFrame:
    return chunks.agg((F.max("z") + 1).alias("depth"), F.max(F.col("y0") + F.col("h")).alias("height"), F.max(F.col("x0") + F.col("w")).alias("width"), F.min("z").alias("zmin"))


def pyramid_path(path: str, factor: int) -> str:
    """Name of the store that holds the reduced copy for inspection."""
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head}/{int(factor)}x_{tail}"


def reduced(images: DataFrame, factor: int) -> DataFrame:
    """Slices (z, h, w, px) with every factor-th pixel of every factor-th line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                own = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])[::factor, ::factor]
                out.append((r["z"], *own.shape, own.tobytes()))
            yield pd.DataFrame(out, columns=["z", "h", "w", "px"])

    return images.select("z", "h", "w", "px").mapInPandas(run, "z int, h int, w int, px binary")


def write_pyramid(spark: SparkSession, path: str, factor: int, size: int = CHUNK) -> str:
    """Write the reduced copy of a store for inspection, slices that are there already replaced; its path."""
    whole = open_chunks(spark, path)
    target = pyramid_path(path, factor)
    write_chunks(cut(reduced(read_window(whole, (0, 1 << 30), size=size), factor), size), target, "r+")
    return target


def scratch(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, which all executors share; a local one only where that is unset and Spark is one process."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="lamella-")
    return f"{shared}/lamella-{uuid.uuid4().hex}"


def cached(spark: SparkSession, folder: str, parameters: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """What build gives for these parameters, written the first time and read afterwards; other parameters have a place of their own."""
    key = hashlib.sha256(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()[:16]
    path = f"{folder}/cache-{key}"
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def staged(spark: SparkSession, folder: str, name: str, parameters: dict, schema: str, wanted: DataFrame, build: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, str]:
    """(table, key) of a stage that has rows for the wanted slices (z): what these parameters have made so far, and the rest.

    build gets the slices that are missing and the table as it is, and gives the
    rows to append. Other parameters have a table of their own. The key stands
    for stage and parameters, so a later stage that has it among its own is made
    anew if this one is. A run that breaks off leaves what it had appended.
    """
    key = hashlib.sha256(json.dumps([name, parameters], sort_keys=True, default=str).encode()).hexdigest()[:16]
    path = f"{folder}/{name}-{key}"
    old = read(spark, path, schema, missing_ok=True)
    rest = wanted.select("z").join(old.select("z").distinct(), "z", "left_anti")
    if not rest.isEmpty():
        build(rest, old).write.mode("append").parquet(path)
    return read(spark, path, schema, missing_ok=True), key


def write_attributes(spark: SparkSession, path: str, values: dict) -> None:
    """Set attributes; those already there and not named stay."""
    old = read_attributes(spark, path)
    rows = [(k, json.dumps(v)) for k, v in sorted((old | values).items())]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/attributes")


def read_attributes(spark: SparkSession, path: str) -> dict:
    """A store's attributes: a handful of names and values."""
    return {r.name: json.loads(r.value) for r in read(spark, f"{path}/attributes", "name string, value string", missing_ok=True).collect()}


def stamped(config: dict, version: str = "1.0") -> dict:
    return config | {"_config_version": version, "_created_at": datetime.now(UTC).isoformat()}
