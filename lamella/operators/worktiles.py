"""Slices that are larger than a task: flow and warp by work tiles.

A slice is chunks (z, y0, x0, h, w, px), as a store has them. Each chunk sends to
every work tile near it what that tile sees of it: its own pixels and a halo.
Tiles are put together by a grouping, worked on alone, and come out as chunks or
nodes again. So a task holds one tile with its halo, whatever the slice's size,
and tiles of all slices run at once. Results are those of the kernels on whole
slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..kernels import register, resample
from ..sources.store import CHUNKS
from .registration import FIELD, field_rows

WINDOW = "z int, ty int, tx int, y0 int, x0 int, h int, w int, px binary, height int, width int"
_NAMES = [c.split()[0] for c in WINDOW.split(", ")]
TILE = ["z", "ty", "tx"]


def extent(chunks: DataFrame) -> DataFrame:
    """(z, height, width) of each slice."""
    return chunks.groupBy("z").agg(F.max(F.col("y0") + F.col("h")).alias("height"), F.max(F.col("x0") + F.col("w")).alias("width"))


def windows(chunks: DataFrame, size: int, before: int, after: int, extents: DataFrame | None = None) -> DataFrame:
    """WINDOW of each work tile of size x size pixels: what it sees of its slice, from (y0, x0).

    That is its own pixels, ``before`` more above and to the left and ``after``
    more below and to the right, as far as the slice goes. extents (z, height,
    width), if given, cut slices off. Where there is no chunk, pixels are 0.
    """
    sized = chunks.select("z", "y0", "x0", "h", "w", "px").join(extent(chunks) if extents is None else extents, "z")  # a row for each slice

    def tiles_of(a: int, b: int, whole: int) -> range:
        return range(max(0, (a - after) // size), min((b + before - 1) // size, (whole - 1) // size) + 1)

    def bounds(tile: int, whole: int) -> tuple[int, int]:
        return max(0, tile * size - before), min(whole, (tile + 1) * size + after)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                px, out = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"]), []
                y0, x0, height, width = r["y0"], r["x0"], r["height"], r["width"]
                y1, x1 = min(y0 + r["h"], height), min(x0 + r["w"], width)
                for ty in tiles_of(y0, y1, height) if y1 > y0 and x1 > x0 else ():
                    a, b = bounds(ty, height)
                    for tx in tiles_of(x0, x1, width):
                        c, d = bounds(tx, width)
                        ya, yb, xa, xb = max(a, y0), min(b, y1), max(c, x0), min(d, x1)
                        if ya < yb and xa < xb:
                            own = px[ya - y0 : yb - y0, xa - x0 : xb - x0]
                            out.append((r["z"], ty, tx, ya, xa, *own.shape, own.tobytes(), height, width))
                yield pd.DataFrame(out, columns=_NAMES)

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        z, ty, tx, height, width = (int(frame[c].iloc[0]) for c in ("z", "ty", "tx", "height", "width"))
        (a, b), (c, d) = bounds(ty, height), bounds(tx, width)
        out = np.zeros((b - a, d - c), np.uint8)
        for y, x, h, w, px in zip(*[frame[k] for k in ("y0", "x0", "h", "w", "px")], strict=True):
            out[y - a : y - a + h, x - c : x - c + w] = np.frombuffer(px, np.uint8).reshape(h, w)
        return pd.DataFrame([(z, ty, tx, a, c, *out.shape, out.tobytes(), height, width)], columns=_NAMES)

    return sized.mapInPandas(pieces, WINDOW).groupBy(*TILE).applyInPandas(join, WINDOW)


def flow(reference: DataFrame, moving: DataFrame, patch: int = 32, stride: int = 16, most: int = 8, size: int = 1024) -> DataFrame:
    """FIELD of moving's slices against reference's of the same z (chunks of both): ``register.flow`` where both have pixels.

    A node belongs to the work tile that its patch begins in.
    """
    h, w = F.least("height", "other_height").alias("height"), F.least("width", "other_width").alias("width")
    other = extent(reference).withColumnsRenamed({"height": "other_height", "width": "other_width"})
    extents = extent(moving).join(other, "z").select("z", h, w)
    seen = windows(reference, size, 0, patch, extents).select(*TILE, F.col("px").alias("rpx"))
    both = windows(moving, size, 0, patch, extents).join(seen, TILE)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                a, b = (np.frombuffer(r[c], np.uint8).reshape(r["h"], r["w"]) for c in ("rpx", "px"))
                first = [-(-t * size // stride) for t in (r["ty"], r["tx"])]
                # The patches that begin in this tile and fit into the slice.
                count = [max(0, min(-(-(t + 1) * size // stride), (n - patch) // stride + 1) - f) for t, n, f in zip((r["ty"], r["tx"]), (r["height"], r["width"]), first, strict=True)]
                if not all(count):
                    continue
                y, x = first[0] * stride - r["y0"], first[1] * stride - r["x0"]
                box = np.s_[y : y + (count[0] - 1) * stride + patch, x : x + (count[1] - 1) * stride + patch]
                a, b = a[box], b[box]
                out = field_rows(r["z"], register.flow(a, b, patch, stride, most, a > 0, b > 0))
                yield out.assign(gy=out["gy"] + first[0], gx=out["gx"] + first[1])

    return both.mapInPandas(run, FIELD)


def _nodes(field: DataFrame, extents: DataFrame, stride: int, size: int, first: float) -> DataFrame:
    """(z, ty, tx, nodes): the nodes of a field that each work tile's pixels lie between; outer nodes reach to the border."""
    last = field.groupBy("z").agg(F.max("gy").alias("my"), F.max("gx").alias("mx"))
    sized = field.select("z", "gy", "gx", "dx", "dy").join(last.join(extents, "z"), "z")

    def tiles(g: str, most: str, whole: str):
        # A pixel lies between two nodes, so a node counts for pixels less than a stride away.
        top = F.floor((F.col(whole) - 1) / size)
        low = F.when(F.col(g) == 0, 0).otherwise(F.floor((first + (F.col(g) - 1) * stride) / size))
        high = F.when(F.col(g) == F.col(most), top).otherwise(F.floor((first + (F.col(g) + 1) * stride) / size))
        low, high = F.greatest(low, F.lit(0)), F.least(high, top)
        return F.explode(F.when(low <= high, F.sequence(low, high))).alias("t")

    by_y = sized.select("*", tiles("gy", "my", "height")).withColumnRenamed("t", "ty")
    both = by_y.select("*", tiles("gx", "mx", "width")).withColumnRenamed("t", "tx")
    key = [F.col(c).cast("int").alias(c) for c in TILE]
    return both.groupBy(*key).agg(F.collect_list(F.struct("gy", "gx", "dx", "dy")).alias("nodes"))


def warp(chunks: DataFrame, field: DataFrame, stride: int, size: int = 1024, first: float = 0.0) -> DataFrame:
    """CHUNKS of slices seen through a field (z, gy, gx, dx, dy) at nodes: ``elastic.warp``, with a mask of what came from the slice.

    Nodes are ``stride`` pixels apart, the first at pixel ``first``. The halo is
    as wide as the longest vector. A slice without a field stays as it is.
    """
    extents = extent(chunks)
    longest = field.agg(F.max(F.greatest(F.abs("dx"), F.abs("dy")))).first()[0]
    reach = int(np.ceil(longest or 0)) + 2
    own = windows(chunks, size, reach, reach).join(_nodes(field, extents, stride, size, first), TILE, "left")
    names_of = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                image = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])
                y0, x0 = r["ty"] * size, r["tx"] * size
                y1, x1 = min(y0 + size, r["height"]), min(x0 + size, r["width"])
                out, have = image[y0 - r["y0"] : y1 - r["y0"], x0 - r["x0"] : x1 - r["x0"]], np.ones((y1 - y0, x1 - x0), bool)
                if r["nodes"] is not None:
                    n = pd.DataFrame([tuple(v.values()) if isinstance(v, dict) else tuple(v) for v in r["nodes"]], columns=["gy", "gx", "dx", "dy"])
                    gy, gx = n["gy"].min(), n["gx"].min()
                    nodes = np.full((2, n["gy"].max() - gy + 1, n["gx"].max() - gx + 1), np.nan)
                    nodes[0, n["gy"] - gy, n["gx"] - gx], nodes[1, n["gy"] - gy, n["gx"] - gx] = n["dx"].astype(float), n["dy"].astype(float)
                    y, x = ((np.clip((np.arange(a, b) - first) / stride - g, 0, m - 1)) for a, b, g, m in ((y0, y1, gy, nodes.shape[1]), (x0, x1, gx, nodes.shape[2])))
                    f = np.stack([resample.sample(c, *np.meshgrid(y, x, indexing="ij")) for c in nodes])
                    bad = np.isnan(f).any(axis=0)
                    f = np.where(bad, 0, f)
                    at = np.meshgrid(np.arange(y0, y1) - r["y0"], np.arange(x0, x1) - r["x0"], indexing="ij")
                    seen = lambda v: np.where(bad, 0, resample.sample(v, at[0] + f[1], at[1] + f[0]))  # noqa: B023, E731
                    out, have = np.round(seen(image)).astype(np.uint8), seen(np.ones(image.shape)) >= 0.5
                yield pd.DataFrame([(r["z"], r["ty"], r["tx"], y0, x0, *out.shape, out.tobytes(), have.tobytes())], columns=names_of)

    return own.mapInPandas(run, CHUNKS)


def meshes(field: DataFrame, stride: int, mesh: register.Mesh, clean: dict, min_patch: int = 2, start: DataFrame | None = None) -> DataFrame:
    """(z, gy, gx, dx, dy) of all slices on the first one's place, from the flow of each against the one before (FIELD).

    In order of z, the flow's trusted vectors are composed with the mesh of the
    slice before, and the mesh relaxes from there; a slice without any keeps that
    mesh. start (z, gy, gx, dx, dy) is the mesh to go on from. The walk is serial
    and one task's, which holds the nodes of one slice: some hundred times fewer
    than its pixels.
    """
    rows = field.select(F.lit(1).alias("kind"), *[c.split()[0] for c in FIELD.split(", ")])
    if start is not None:
        nothing = F.lit(None).cast("double")
        rows = rows.unionByName(start.select(F.lit(0).alias("kind"), "z", "gy", "gx", "dx", "dy", nothing.alias("sharp"), nothing.alias("ratio")))

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, part in batch.groupby(["kind", "z"]):
                if held and tuple(held[0][["kind", "z"]].iloc[0]) != tuple(part[["kind", "z"]].iloc[0]):
                    yield pd.concat(held)
                    held = []
                held.append(part)
        if held:
            yield pd.concat(held)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        solved = None
        for frame in slices(batches):
            raw = np.full((4, int(frame["gy"].max()) + 1, int(frame["gx"].max()) + 1), np.nan)
            for k, c in enumerate(("dx", "dy", "sharp", "ratio")):
                raw[k, frame["gy"], frame["gx"]] = frame[c].astype(float)
            if not frame["kind"].iloc[0]:
                solved = raw[:2]
                continue
            d = register.drop_small(register.clean(raw, **clean), min_patch)
            before = np.zeros(d.shape) if solved is None or solved.shape != d.shape else solved
            target = resample.compose(d / stride, before / stride) * stride
            solved = before if np.isnan(target).all() else register.relax(target, mesh, before)[0]
            yield field_rows(int(frame["z"].iloc[0]), solved)

    return rows.repartition(1).sortWithinPartitions("kind", "z").mapInPandas(walk, MESH)


MESH = "z int, gy int, gx int, dx double, dy double"
