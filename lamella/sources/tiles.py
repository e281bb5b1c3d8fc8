"""Tile files: folders of tiles, their metadata, and images as a Spark source.

A backend tells how names and metadata are read, as expressions, so listing and
parsing stay in one scan; file contents are pruned from a listing.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import names
from ..kernels import masks, resample
from . import tiff

IMAGE = "path string, h int, w int, px binary"


@dataclass(frozen=True)
class Backend:
    """How a microscope's files are named."""

    extension: str
    tile_x: Callable[[Column], Column]
    tile_y: Callable[[Column], Column]
    tile_slice: Callable[[Column], Column]
    info: str  # pattern of metadata files


BACKENDS = {"tiles": Backend(".tif", names.tile_x, names.tile_y, names.tile_slice, "*.info")}


def backend(name: str) -> Backend:
    if name not in BACKENDS:
        raise KeyError(f"no backend {name!r}; there are {sorted(BACKENDS)}")
    return BACKENDS[name]


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, length) of the files below folder; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length")


def catalogue(spark: SparkSession, folder: str, kind: str = "tiles") -> DataFrame:
    """(tileset, path, z, ty, tx) of all tiles below folder."""
    b = backend(kind)
    path = F.col("path")
    found = listing(spark, folder, f"*{b.extension}").select(names.parent_name(path).alias("tileset"), "path", b.tile_slice(path).alias("z"), b.tile_y(path).alias("ty"), b.tile_x(path).alias("tx"))
    return found.where(F.col("z").isNotNull())


def tilesets(spark: SparkSession, folder: str, resolution: tuple[int, int], patterns: list[str], kind: str = "tiles") -> DataFrame:
    """(tileset, pattern), sorted: folders whose metadata give that resolution, once for each pattern in their name."""
    files = spark.read.option("wholetext", "true").option("pathGlobFilter", backend(kind).info).option("recursiveFileLookup", "true").text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    found = names.resolution(lines, "path").where((F.col("res_y") == resolution[0]) & (F.col("res_x") == resolution[1]))
    sets = found.select(names.parent_name(F.col("path")).alias("tileset"), F.explode(F.array(*map(F.lit, patterns))).alias("pattern"))
    return sets.where(F.col("tileset").contains(F.col("pattern"))).orderBy("tileset", "pattern")


def with_invert(found: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """Tiles with their set's instruction to invert (key, invert); a set without one is an error."""
    missing = F.raise_error(F.concat(F.lit("no invert flag for "), F.col(key).cast("string"))).cast("boolean")
    return found.join(flags, key, "left").withColumn("invert", F.coalesce("invert", missing))


def decode(content: bytes) -> np.ndarray:
    """A grey image from a TIFF (see ``tiff``) or an NPY array; 16 bits are cut to 8."""
    if content[:6] == b"\x93NUMPY":
        out = np.load(io.BytesIO(content), allow_pickle=False)
    else:
        out = tiff.read(content)
    return (out >> 8).astype(np.uint8) if out.dtype == np.uint16 else out.astype(np.uint8)


def encode(image: np.ndarray) -> bytes:
    """A baseline TIFF of one strip."""
    return tiff.write(image.astype(np.uint8))


def load(files: DataFrame, scheme: dict[str, dict] | None = None, scale: float = 1.0, background: int | None = None) -> DataFrame:
    """files (path, content, ...) with h, w, px decoded, processed by scheme and scaled; null where a file can't be read.

    A column `invert` (boolean), if there, says which tiles are inverted first.
    With a background value, a column mask tells the specimen from what is no
    brighter than that, in the shape of px (see ``masks.foreground``).
    """
    scheme, mask = scheme or {}, background is not None
    others = [c for c in files.columns if c != "content"]
    schema = StructType([*files.select(*others).schema.fields, StructField("h", IntegerType()), StructField("w", IntegerType()), StructField("px", BinaryType()), *[StructField("mask", BinaryType())] * mask])
    names_of = ["h", "w", "px", *["mask"] * mask]

    def one(content: bytes | None, invert: bool) -> tuple:
        try:
            image = decode(content) if content is not None else None
        except (ValueError, KeyError, struct.error, zlib.error):
            image = None
        if image is None:
            return (None,) * len(names_of)
        image = masks.process(image, ({"invert": {}} if invert else {}) | scheme)
        have = [resample.resample(masks.foreground(image, background), scale).tobytes()] if mask else []
        image = resample.resample(image, scale)
        return (*image.shape, image.tobytes(), *have)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            invert = batch["invert"].fillna(False).astype(bool) if "invert" in batch else [False] * len(batch)
            got = pd.DataFrame([one(c, i) for c, i in zip(batch["content"], invert, strict=True)], columns=names_of, dtype=object)
            yield pd.concat([batch[others].reset_index(drop=True), got.astype({"h": "Int64", "w": "Int64"})], axis=1)

    return files.mapInPandas(run, schema)


def read_images(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """(path, h, w, px) of image files, decoded in the tasks that read them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return load(files.select("path", "content"))


class SyntheticTiles(DataSource):
    """spark.read.format("synthetic_tiles"): overlapping tiles cut from one smooth random image, for trials.

    Options: slices, rows, columns, size, overlap, seed.
    """

    @classmethod
    def name(cls) -> str:
        return "synthetic_tiles"

    def schema(self) -> str:
        return "z int, ty int, tx int, h int, w int, px binary"

    def reader(self, schema) -> DataSourceReader:
        return _SyntheticReader(self.options)


class _SyntheticReader(DataSourceReader):
    def __init__(self, options) -> None:
        get = lambda k, d: int(options.get(k, d))
        self.n, self.rows, self.columns, self.size, self.overlap, self.seed = get("slices", 3), get("rows", 2), get("columns", 2), get("size", 64), get("overlap", 16), get("seed", 0)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(z) for z in range(self.n)]

    def read(self, partition: InputPartition):
        step = self.size - self.overlap
        whole = texture((self.rows * step + self.overlap, self.columns * step + self.overlap), self.seed + partition.value)
        for y in range(self.rows):
            for x in range(self.columns):
                yield partition.value, y, x, self.size, self.size, whole[y * step : y * step + self.size, x * step : x * step + self.size].tobytes()


def texture(shape: tuple[int, int], seed: int = 0, smooth: int = 2) -> np.ndarray:
    """A random image with structure at a few pixels, never 0."""
    out = np.random.default_rng(seed).normal(size=shape)
    for axis in (0, 1):
        out = sum(np.roll(out, k, axis) for k in range(-smooth, smooth + 1))
    low, high = out.min(), out.max()
    return (1 + (out - low) / (high - low) * 254).astype(np.uint8)
