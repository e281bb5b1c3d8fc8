"""Boxes, pads, margins and transforms: expressions, and the joins on tiles that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def similarity(a: Column, b: Column) -> Column:
    """1 - |a - b| / max(a, b); 1 if both are 0, null if one is missing."""
    top = F.greatest(a, b)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(top == 0, F.lit(1.0)).otherwise(1 - F.abs(a - b) / top)


def bbox(px: DataFrame, *keys: str) -> DataFrame:
    """Half-open box of the pixels whose mask is true; null where there are none."""
    y, x = F.when(F.col("mask"), F.col("y")), F.when(F.col("mask"), F.col("x"))
    return px.groupBy(*keys).agg(F.min(y).alias("y0"), (F.max(y) + 1).alias("y1"), F.min(x).alias("x0"), (F.max(x) + 1).alias("x1"))


def mask_bbox(lines: DataFrame, *keys: str) -> DataFrame:
    """Half-open box of the true pixels of lines (keys, y, mask: array); null where there are none."""
    at = F.filter(F.sequence(F.lit(0), F.size("mask") - 1), lambda i: F.get("mask", i))
    found = lines.select(*keys, "y", F.array_min(at).alias("low"), F.array_max(at).alias("high"))
    y = F.when(F.col("low").isNotNull(), F.col("y"))
    return found.groupBy(*keys).agg(F.min(y).alias("y0"), (F.max(y) + 1).alias("y1"), F.min("low").alias("x0"), (F.max("high") + 1).alias("x1"))


def pad_before(offset: Column) -> Column:
    return F.greatest(-offset, F.lit(0))


def pad_after(offset: Column) -> Column:
    return F.greatest(offset, F.lit(0))


def pad_lines(rows: DataFrame, height: int, width: int, value: int = 0) -> DataFrame:
    """Every slice of a row layout filled up at its ends; nothing is cut."""
    grid = rows.select("z").distinct().select("z", F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("y"))
    have = F.coalesce("px", F.array().cast("array<int>"))
    px = F.concat(have, F.array_repeat(F.lit(value), F.greatest(F.lit(0), width - F.size(have))))
    return grid.join(rows, ["z", "y"], "left").select("z", "y", px.alias("px"))


def overlap(first: DataFrame, second: DataFrame, dx: int, dy: int) -> DataFrame:
    """Lines (z, y, px1, px2) that two images (z, y, px) share if the second lies at (dx, dy) of the first; places are those in the second."""
    right, left = max(0, dx), max(0, -dx)
    a = first.select("z", (F.col("y") - dy).alias("y"), F.col("px").alias("a"))
    both = a.join(second.select("z", "y", F.col("px").alias("b")), ["z", "y"])
    width = F.least(F.size("a") - right, F.size("b") - left)
    return both.where(width > 0).select("z", "y", F.slice("a", right + 1, width).alias("px1"), F.slice("b", left + 1, width).alias("px2"))


def margins(tiles: DataFrame, inner: int, outer: int) -> DataFrame:
    """(tx, ty, top, bottom, l, r): the inner margin toward a neighbour, the outer where there is none."""
    sides = (("top", 0, 1), ("bottom", 0, -1), ("l", 1, 0), ("r", -1, 0))
    seen = F.array(*[F.struct((F.col("tx") + dx).alias("tx"), (F.col("ty") + dy).alias("ty"), F.lit(side).alias("side")) for side, dx, dy in sides])
    near = tiles.select(F.explode(seen).alias("n")).groupBy("n.tx", "n.ty").agg(F.collect_set("n.side").alias("sides"))  # four sides at most
    out = tiles.join(near, ["tx", "ty"], "left")
    return out.select("tx", "ty", *[F.when(F.coalesce(F.array_contains("sides", side), F.lit(False)), inner).otherwise(outer).alias(side) for side, _, _ in sides])


def adjacent(tiles: DataFrame, key: str, value: str) -> DataFrame:
    """(key, ty, tx, side, a, b): each tile with its right neighbour and the one below."""
    a = tiles.select(key, "ty", "tx", F.col(value).alias("a"))
    near = F.array(
        F.struct(F.col("ty").alias("ty"), (F.col("tx") - 1).alias("tx"), F.lit("right").alias("side")),
        F.struct((F.col("ty") - 1).alias("ty"), F.col("tx").alias("tx"), F.lit("below").alias("side")),
    )
    b = tiles.select(key, F.explode(near).alias("n"), F.col(value).alias("b")).select(key, "n.ty", "n.tx", "n.side", "b")
    return a.join(b, [key, "ty", "tx"]).select(key, "ty", "tx", "side", "a", "b")


def to_mesh(px: DataFrame, height: int, width: int, nodes_y: int, nodes_x: int) -> DataFrame:
    """(z, gy, gx, mask) at nodes spread evenly from the first pixel to the last, cut to integers."""
    spark = px.sparkSession
    ys = [(i, i * (height - 1) // (nodes_y - 1)) for i in range(nodes_y)]
    xs = [(i, i * (width - 1) // (nodes_x - 1)) for i in range(nodes_x)]
    nodes = spark.createDataFrame([(i, y, j, x) for i, y in ys for j, x in xs], "gy int, y int, gx int, x int")
    return px.join(F.broadcast(nodes), ["y", "x"]).select("z", "gy", "gx", "mask")  # nodes_y * nodes_x rows


def affine(x: Column, y: Column, m: tuple[float, ...]) -> tuple[Column, Column]:
    """(a, b, tx, c, d, ty) applied to a point."""
    a, b, tx, c, d, ty = m
    return a * x + b * y + tx, c * x + d * y + ty


def moved_by_slice(points: DataFrame, transforms: DataFrame, at: str = "z") -> DataFrame:
    """points (at, x, ...) moved along x by the transform (at, a, tx) of their slice, with ``identity`` where it has none and they stay."""
    found = points.join(transforms.select(at, "a", "tx"), at, "left")
    x = F.coalesce("a", F.lit(1.0)) * F.col("x") + F.coalesce("tx", F.lit(0.0))
    return found.withColumns({"x": x, "identity": F.col("a").isNull()}).drop("a", "tx")


def scaled(m: Column, ratio: Column) -> Column:
    """A transform struct (a, b, tx, c, d, ty) for an image scaled by ratio."""
    return F.struct(m["a"].alias("a"), m["b"].alias("b"), (m["tx"] * ratio).alias("tx"), m["c"].alias("c"), m["d"].alias("d"), (m["ty"] * ratio).alias("ty"))


def rotated_bounds(h: Column, w: Column, degrees: Column) -> tuple[Column, Column]:
    """Height and width of the canvas that holds a rotated image."""
    s, c = F.abs(F.sin(F.radians(degrees))), F.abs(F.cos(F.radians(degrees)))
    return F.floor(h * c + w * s + 1e-9).cast("int"), F.floor(h * s + w * c + 1e-9).cast("int")


def overlap_left(search: Column, dx: Column, dy: Column) -> Column:
    """How far two tiles still overlap if they were sought within ``search`` pixels and found at an offset; at least 0."""
    return F.greatest(search - F.greatest(F.abs(dx), F.abs(dy)), F.lit(0))


def runs_down(dx: Column, dy: Column) -> Column:
    """Whether an offset is rather between rows than between columns."""
    return F.abs(dx) <= F.abs(dy)


def equal_shapes(tiles: DataFrame, *keys: str) -> DataFrame:
    """tiles (keys, tx, ty, h, w) with the pads (top, bottom, l, r) that make all of a group the largest's shape.

    Lines are added below in the last row and above elsewhere, columns on the
    left in the last column and on the right elsewhere, so that the sides that
    face a neighbour stay where they are.
    """
    top = tiles.groupBy(*keys).agg(F.max("h").alias("mh"), F.max("w").alias("mw"), F.max("tx").alias("mx"), F.max("ty").alias("my"))
    y, x = F.col("mh") - F.col("h"), F.col("mw") - F.col("w")
    down, left = F.col("ty") == F.col("my"), F.col("tx") == F.col("mx")
    pads = {"top": F.when(down, 0).otherwise(y), "bottom": F.when(down, y).otherwise(0), "l": F.when(left, x).otherwise(0), "r": F.when(left, 0).otherwise(x)}
    return tiles.join(top, list(keys)).select(*tiles.columns, *[v.alias(k) for k, v in pads.items()])


def scale_ratio(resolution: Column, target: Column, least: float | None = None) -> Column:
    """The factor that brings an image of one resolution to another; below ``least`` it is an error."""
    ratio = resolution.cast("double") / target
    if least is None:
        return ratio
    return F.when(ratio >= least, ratio).otherwise(F.raise_error(F.concat(F.lit("resolution is finer than the target's: "), ratio.cast("string"))).cast("double"))
