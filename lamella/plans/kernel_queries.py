"""Kernels applied to the volume; SQL can't express these, tests hold them against known deformations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..kernels import masks, register, resample
from ..operators import batches, graph, tilemaps, volume
from ..operators import registration as reg
from .image_queries import LAP, SOBEL, rows
from .registry import Tables, query


def smooth_field(t: Tables, step: int = 4) -> DataFrame:
    """A smooth field for each slice, a node for each square of pixels: how bright it is, and how bright the square opposite is."""
    node = lambda c: F.floor(F.col(c) / step).cast("int")
    light = volume.pixels(rows(t)).groupBy("z", node("y").alias("gy"), node("x").alias("gx")).agg(((F.avg("v") - 127) / 32).alias("dx"))
    other = light.select("z", F.col("gy").alias("gx"), F.col("gx").alias("gy"), F.col("dx").alias("dy"))
    return light.join(other, ["z", "gy", "gx"], "left").withColumn("dy", F.coalesce("dy", F.lit(0.0)))


def slices(t: Tables) -> DataFrame:
    return reg.to_binary(rows(t))


@query()
def ncc_flow(t: Tables) -> DataFrame:
    return reg.ncc_flow(slices(t))


@query()
def mesh_relax(t: Tables) -> DataFrame:
    return reg.relax(smooth_field(t), register.Mesh(most=2000))


@query()
def map_invert(t: Tables) -> DataFrame:
    return reg.invert(smooth_field(t))


@query()
def map_compose(t: Tables) -> DataFrame:
    """A field and its inverse: near zero away from the border."""
    f = smooth_field(t)
    return reg.compose(reg.invert(f), f)


@query()
def elastic_warp(t: Tables) -> DataFrame:
    out = reg.warp(slices(t), smooth_field(t))
    return out.select("z", "h", "w", F.sha2("px", 256).alias("digest"))


@query()
def similarity_transform(t: Tables) -> DataFrame:
    return reg.transforms(slices(t))


FOLD = """D AS (SELECT z, y, x, v, z // 4 AS dataset, dense_rank() OVER (PARTITION BY z // 4 ORDER BY z) AS k FROM V WHERE z <> 5),
R AS (SELECT dataset, k, z, y, x, v::DOUBLE AS s, NULL::DOUBLE AS p FROM D WHERE k = 1
    UNION ALL SELECT D.dataset, D.k, D.z, D.y, D.x, 0.5 * coalesce(R.s, 0) + 0.5 * D.v, coalesce(R.s, 0) FROM D JOIN (SELECT dataset, max(k) AS k FROM R GROUP BY dataset) L ON D.dataset = L.dataset AND D.k = L.k + 1 LEFT JOIN R ON R.dataset = D.dataset AND R.k = L.k AND R.y = D.y AND R.x = D.x)"""


@query("WITH RECURSIVE {V}, " + FOLD + " SELECT dataset::INT AS dataset, z, sum(s) / count(*) AS mean, sum(abs(s - p)) / count(p) AS change FROM R GROUP BY dataset, z")
def stateful_fold_z(t: Tables) -> DataFrame:
    """Each slice blended with the result for the slice before, along z."""

    def step(state: np.ndarray | None, image: np.ndarray) -> tuple[np.ndarray, dict]:
        if state is not None and state.shape != image.shape:
            state = np.pad(state, [(0, max(0, n - m)) for n, m in zip(image.shape, state.shape, strict=True)])[: image.shape[0], : image.shape[1]]
        new = image.astype(float) if state is None else 0.5 * state + 0.5 * image
        return new, {"mean": float(new.mean()), "change": None if state is None else float(np.abs(new - state).mean())}

    images = slices(t).withColumn("dataset", F.floor(F.col("z") / 4).cast("int"))
    return reg.fold(images, "dataset", step, "dataset int, z int, mean double, change double", ignore=(5,))


@query(f"WITH {SOBEL}, {LAP}, G AS (SELECT z, y, x, CASE WHEN lag(v) OVER r IS NULL THEN 2 * (lead(v) OVER r - v) WHEN lead(v) OVER r IS NULL THEN 2 * (v - lag(v) OVER r) ELSE lead(v) OVER r - lag(v) OVER r END AS gx, CASE WHEN lag(v) OVER c IS NULL THEN 2 * (lead(v) OVER c - v) WHEN lead(v) OVER c IS NULL THEN 2 * (v - lag(v) OVER c) ELSE lead(v) OVER c - lag(v) OVER c END AS gy FROM V WINDOW r AS (PARTITION BY z, y ORDER BY x), c AS (PARTITION BY z, x ORDER BY y)), GM AS (SELECT z, avg(sqrt((gx * gx + gy * gy)::DOUBLE) / 2) AS m FROM G GROUP BY z), SM AS (SELECT z, avg(sqrt((GX.v * GX.v + GY.v * GY.v)::DOUBLE)) AS m FROM GX JOIN GY USING (z, y, x) GROUP BY z) SELECT z, floor((0.5 * var + SM.m + 100 * GM.m) * 1000 + 0.5)::BIGINT AS quality FROM LV JOIN SM USING (z) JOIN GM USING (z)")
def image_quality_udf(t: Tables) -> DataFrame:
    """The composite sharpness by a function of the caller's, in thousandths."""
    q = reg.quality(slices(t), lambda image, mask: masks.sharpness(image, mask)["quality"])
    return q.select("z", F.floor(F.col("quality") * 1000 + 0.5).alias("quality"))


@query()
def foreground_mask(t: Tables) -> DataFrame:
    """Pixels of each slice's foreground: largest part, holes filled, opened and closed."""
    scored = reg.quality(slices(t), lambda image, mask: masks.foreground(image, 127).sum())
    return scored.select("z", F.col("quality").cast("bigint").alias("n"))


@query()
def rotated_slices(t: Tables) -> DataFrame:
    """Mean of each slice after a turn by its number times ten degrees."""

    def run(batches):
        for batch in batches:
            yield pd.DataFrame([(r["z"], *(out := resample.rotate(reg.image(r["h"], r["w"], r["px"]), 10.0 * r["z"])).shape, float(out.mean())) for r in batch.to_dict("records")], columns=["z", "h", "w", "mean"])

    return slices(t).mapInPandas(run, "z int, h int, w int, mean double")


#: Side and distance of the overlapping tiles that a slice is cut into, and their places in the order of their tilesets' names.
TILE, STEP, PLACES = 44, 20, ((1, 0), (0, 1), (1, 1), (0, 0))


@query(f"WITH N AS (SELECT vec_id // 64 AS z FROM embeddings GROUP BY 1 HAVING count(*) = 64) SELECT z::VARCHAR AS grp, 'set' || k AS tileset, [{', '.join(str(x) for x, _ in PLACES)}][k + 1]::BIGINT AS ox, [{', '.join(str(y) for _, y in PLACES)}][k + 1]::BIGINT AS oy FROM N, range(4) r(k)")
def tile_grid_from_images(t: Tables) -> DataFrame:
    """Each whole slice cut into four overlapping tiles of tilesets named in no order: their images give back the grid."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            out = []
            for r in batch.to_dict("records"):
                image = masks.equalize(masks.gaussian(reg.image(r["h"], r["w"], r["px"])))
                for k, (x, y) in enumerate(PLACES):
                    part = image[y * STEP : y * STEP + TILE, x * STEP : x * STEP + TILE]
                    out.append((str(r["z"]), f"{r['z']}/{k}", f"set{k}", 0, 0, *part.shape, part.tobytes()))
            yield pd.DataFrame(out, columns=["grp", "node", "tileset", "tx", "ty", "h", "w", "px"])

    tiles = slices(t).where("h = 64").mapInPandas(cut, "grp string, node string, tileset string, tx int, ty int, h int, w int, px binary")
    with batches.small(tiles.sparkSession):
        tiles = graph.checkpoint(tiles)
    return tilemaps.grids(tiles, scales=(1.0,)).select("grp", "tileset", "ox", "oy")
