"""Layouts of an image volume, and reads and writes on them.

Row layout (z, y, px: array of int) is the working form: one record for a line
of pixels, so a neighbour in x is an array index and a neighbour in y a lag over
lines, and a shuffle moves lines, not pixels. Pixel layout (z, y, x, v) serves
joins and reports. An absent pixel and a pixel of value 0 are background.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BACKGROUND = 127


def from_vectors(vectors: DataFrame, height: int = 64) -> DataFrame:
    """Row layout of a table of vectors: slices of `height` vectors, components scaled to 0..255."""
    px = F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) * 127.5).cast("int"))
    return vectors.select(F.floor(F.col("vec_id") / height).cast("int").alias("z"), (F.col("vec_id") % height).cast("int").alias("y"), px.alias("px"))


def slices_of(vectors: DataFrame, z0: int, z1: int, height: int = 64) -> DataFrame:
    """Vectors of the slices z0 <= z < z1, by a range of ids that reaches the scan."""
    return vectors.where(F.col("vec_id").between(max(0, z0) * height, z1 * height - 1))


def pixels(rows: DataFrame) -> DataFrame:
    """Pixel layout of a row layout; other columns are kept."""
    others = [c for c in rows.columns if c != "px"]
    return rows.select(*others, F.posexplode("px").alias("x", "v"))


def lines(px: DataFrame, *keys: str) -> DataFrame:
    """Row layout of a pixel layout; absent pixels inside a line become 0."""
    keys = keys or ("z", "y")
    found = px.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("x", "v"))).alias("at"), F.max("x").alias("last"))
    return found.select(*keys, F.transform(F.sequence(F.lit(0), F.col("last")), lambda x: F.coalesce(F.try_element_at("at", x), F.lit(0))).alias("px"))


def window(px: DataFrame, z: tuple[int, int], y: tuple[int, int], x: tuple[int, int]) -> DataFrame:
    """Half-open box, re-based to its corner in y and x; z keeps its numbers."""
    inside = F.col("z").between(z[0], z[1] - 1) & F.col("y").between(y[0], y[1] - 1) & F.col("x").between(x[0], x[1] - 1)
    return px.where(inside).withColumns({"y": F.col("y") - y[0], "x": F.col("x") - x[0]})


def crop_rows(rows: DataFrame, z: tuple[int, int], y: tuple[int, int], x: tuple[int, int]) -> DataFrame:
    """window() on the row layout; a bound that reaches out is clamped."""
    cut = F.slice("px", max(0, x[0]) + 1, max(0, x[1] - max(0, x[0])))
    return rows.where(F.col("z").between(z[0], z[1] - 1) & F.col("y").between(y[0], y[1] - 1)).select("z", (F.col("y") - max(0, y[0])).alias("y"), cut.alias("px"))


def has_content(px: Column) -> Column:
    return F.exists(px, lambda v: v != 0)


def nonempty(rows: DataFrame) -> DataFrame:
    """(z) of slices that hold any pixel but background."""
    return rows.groupBy("z").agg(F.bool_or(has_content(F.col("px"))).alias("any")).where("any").select("z")


def masked_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Lines (z, y, px) of old, replaced where new (z, y, px, mask) has a true mask; 0 where neither has a pixel. Lines meet, not pixels."""
    o, n = old.select("z", "y", F.col("px").alias("opx")), new.select("z", "y", F.col("px").alias("npx"), "mask")
    width = F.greatest(F.coalesce(F.size("opx"), F.lit(0)), F.coalesce(F.size("npx"), F.lit(0)))
    pixel = lambda i: F.when(F.get("mask", i), F.get("npx", i)).otherwise(F.coalesce(F.get("opx", i), F.lit(0)))
    return o.join(n, ["z", "y"], "full").select("z", "y", F.transform(F.slice(F.sequence(F.lit(0), width), 1, width), pixel).alias("px"))


def paint(layers: DataFrame, *keys: str) -> DataFrame:
    """One line (keys, px) from layers (keys, priority, px, mask): each pixel of the layer with the highest priority whose mask is true there; 0 where none is.

    A group holds the layers of one line.
    """
    keys = keys or ("z", "y")
    top = F.sort_array(F.collect_list(F.struct("priority", "px", "mask")), asc=False)
    found = layers.groupBy(*keys).agg(top.alias("layers"), F.max(F.size("px")).alias("width"))
    seen = lambda i: F.filter("layers", lambda k: F.coalesce(F.get(k["mask"], i), F.lit(False)))
    pixel = lambda i: F.coalesce(F.get(F.get(seen(i), F.lit(0))["px"], i), F.lit(0))
    return found.select(*keys, F.transform(F.slice(F.sequence(F.lit(0), F.col("width")), 1, F.col("width")), pixel).alias("px"))


def tile(px: DataFrame, height: int, width: int) -> DataFrame:
    """Pixels with tile (ty, tx) and place in it; y and x are kept."""
    by = {"ty": F.floor(F.col("y") / height).cast("int"), "tx": F.floor(F.col("x") / width).cast("int")}
    return px.withColumns(by | {"iy": F.col("y") % height, "ix": F.col("x") % width})


def mosaic(tiles: DataFrame, height: int, width: int) -> DataFrame:
    """Tiles (z, ty, tx, iy, ix, v) laid side by side, without overlap."""
    return tiles.select("z", (F.col("ty") * height + F.col("iy")).alias("y"), (F.col("tx") * width + F.col("ix")).alias("x"), "v")


def down_nearest(rows: DataFrame, n: int) -> DataFrame:
    """Every n-th pixel of every n-th line."""
    px = F.transform(F.sequence(F.lit(0), F.floor((F.size("px") - 1) / n).cast("int")), lambda i: F.element_at("px", i * n + 1))
    return rows.where(F.col("y") % n == 0).select("z", (F.col("y") / n).cast("int").alias("y"), px.alias("px"))


def down_mean(px: DataFrame, n: int) -> DataFrame:
    """Mean of n x n blocks, cut to an integer."""
    by = [F.floor(F.col(c) / n).cast("int").alias(c) for c in ("y", "x")]
    return px.groupBy("z", *by).agg(F.floor(F.sum("v") / F.count("*")).cast("int").alias("v"))


def shape(rows: DataFrame) -> DataFrame:
    """(depth, height, width, zmin) as they follow from the rows; nothing is stored."""
    return rows.agg((F.max("z") + 1).alias("depth"), (F.max("y") + 1).alias("height"), F.max(F.size("px")).alias("width"), F.min("z").alias("zmin"))


def neighbours(rows: DataFrame) -> DataFrame:
    """Lines with those above and below (up, down), mirrored at the border without repeating it."""
    w = Window.partitionBy("z").orderBy("y")
    up, down = F.lag("px").over(w), F.lead("px").over(w)
    return rows.select("z", "y", "px", F.coalesce(up, down, "px").alias("up"), F.coalesce(down, up, "px").alias("down"))


def with_mask(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Lines of images (z, y, px) with those of their masks (z, y, mask); a line without a mask has none, which counts as true everywhere."""
    return images.join(masks.select("z", "y", "mask"), ["z", "y"], "left")


def masked(lines: DataFrame) -> DataFrame:
    """Lines of with_mask() with only the pixels whose mask is true."""
    inside = F.transform(F.filter(F.arrays_zip("px", "mask"), lambda p: p["mask"]), lambda p: p["px"])
    return lines.withColumn("px", F.when(F.col("mask").isNull(), F.col("px")).otherwise(inside))


def holds(test: Callable[[Column], Column], name: str) -> list[Column]:
    """Aggregates over a slice's lines: whether test is true of any pixel (any_name), and of all (all_name)."""
    return [F.bool_or(F.exists("px", test)).alias(f"any_{name}"), F.bool_and(F.forall("px", test)).alias(f"all_{name}")]


def transposed(rows: DataFrame) -> DataFrame:
    """Slices with lines and columns exchanged; a slice is one row meanwhile, as an array of arrays."""
    lines = rows.groupBy("z").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "px"))), lambda r: r["px"]).alias("lines"))
    turned = F.transform(F.sequence(F.lit(0), F.size(F.get("lines", F.lit(0))) - 1), lambda x: F.transform("lines", lambda line: F.get(line, x)))
    return lines.select("z", F.posexplode(turned).alias("y", "px"))
