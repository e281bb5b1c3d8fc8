"""Where tiles of several tilesets lie on one grid: found from the images themselves.

Tilesets that cover the same slices were acquired side by side, but their tile
numbers don't say where they meet. Of one slice, each tile is described once
(see ``kernels.features``), descriptions of tiles of unlike tilesets are matched
in pairs, and pairs that match are looked at: the tiles' pixels must agree where
they overlap. The graph of tilesets related by such pairs gives the grids, one
for each connected part.

Pairs are made within a slice of a group of tilesets only, which has as many
tiles as a microscope's field. A pair is one row, so the pairs of one slice are
worked on by many tasks; a task holds two tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import robustness as formula
from ..kernels import elastic, register, resample
from . import batches, graph

DESCRIBED = "grp string, node string, tileset string, places binary, vectors binary"
MATCH = "grp string, u string, v string, dx double, dy double, angle double, matches int, inliers int, index double"
#: Descriptors travel as bytes: their values, at most 0.5 or so, in steps of 1 / GRAIN.
GRAIN = 512


def described(tiles: DataFrame, scale: float = 1.0, most: int = register.FEATURES) -> DataFrame:
    """(grp, node, tileset, places, vectors): features of tiles (grp, node, tileset, h, w, px), in pixels of the whole image."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            out = []
            for r in batch.to_dict("records"):
                image = np.frombuffer(r["px"], np.uint8).reshape(r["h"], r["w"])
                places, vectors = register.features(resample.resample(image, scale), most)
                packed = np.clip(np.round(vectors * GRAIN), 0, 255).astype(np.uint8)
                out.append((r["grp"], r["node"], r["tileset"], (places / scale).astype("<f4").tobytes(), packed.tobytes()))
            yield pd.DataFrame(out, columns=["grp", "node", "tileset", "places", "vectors"])

    return tiles.where("px is not null").select("grp", "node", "tileset", "h", "w", "px").mapInPandas(run, DESCRIBED)


def _features(places: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(places, "<f4").reshape(-1, 2).astype(float)
    v = np.frombuffer(vectors, np.uint8).reshape(len(at), -1).astype(np.float32) if len(at) else np.zeros((0, 1), np.float32)
    return at, v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def _pairs(d: DataFrame) -> DataFrame:
    side = lambda name: d.select("grp", *[F.col(c).alias(f"{name}_{c}") for c in d.columns if c != "grp"])
    return side("u").join(side("v"), "grp").where((F.col("u_node") < F.col("v_node")) & (F.col("u_tileset") != F.col("v_tileset")))


def matched(d: DataFrame, todo: DataFrame | None = None, **options) -> DataFrame:
    """(grp, u, v, dx, dy, angle, matches, inliers, index) of the pairs of described tiles of unlike tilesets that a similarity was found for.

    v's centre lies at (dx, dy) from where u would have it, turned by angle in
    degrees; index is the robustness of the match. todo (grp, u, v), if given,
    limits the pairs.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            out = []
            for r in batch.to_dict("records"):
                u, v = (_features(r[f"{s}_places"], r[f"{s}_vectors"]) for s in "uv")
                e = register.matched(u, v, **options)
                if e.matrix is None:
                    continue
                middle = v[0].mean(axis=0)
                dx, dy = e.matrix[:, :2] @ middle + e.matrix[:, 2] - middle
                angle = np.rad2deg(np.arctan2(e.matrix[1, 0], e.matrix[0, 0]))
                out.append((r["grp"], r["u_node"], r["v_node"], dx, dy, angle, e.matches, len(e.residuals), register.robustness(e.matches, e.residuals)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in MATCH.split(", ")])

    pairs = _pairs(d)
    if todo is not None:
        pairs = pairs.join(todo.select("grp", F.col("u").alias("u_node"), F.col("v").alias("v_node")), ["grp", "u_node", "v_node"], "left_semi")
    return pairs.repartition("grp", "u_node", "v_node").mapInPandas(run, MATCH)


def scored(found: DataFrame, tiles: DataFrame, threshold: float, scales: tuple[float, ...]) -> DataFrame:
    """Matches with score: how alike both tiles are where they overlap (see ``elastic.check_overlap``)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            out = []
            for r in batch.to_dict("records"):
                u, v = (np.frombuffer(r[f"{s}_px"], np.uint8).reshape(r[f"{s}_h"], r[f"{s}_w"]) for s in "uv")
                out.append(elastic.check_overlap(u, v, (r["dx"], r["dy"]), 0.0, threshold, scales))
            yield batch[columns].assign(score=np.array(out, float))

    columns = [c.split()[0] for c in MATCH.split(", ")]
    side = lambda s: tiles.select("grp", F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("h", "w", "px")])
    both = found.join(side("u"), ["grp", "u"]).join(side("v"), ["grp", "v"])
    return both.mapInPandas(run, f"{MATCH}, score double")


def estimated(tiles: DataFrame, scales: tuple[float, ...] = (0.5, 1.0), threshold: float = 0.8, rotation: float = 5.0) -> DataFrame:
    """(grp, u, v, dx, dy, angle, matches, inliers, index, score) between tiles (grp, node, tileset, h, w, px) of unlike tilesets.

    Pairs are matched at the first of the scales, those without a robust match
    again at the next. A match must turn by less than ``rotation`` degrees; its
    score then tells how well the images agree. A tile that can't be read has no
    match.
    """
    every = _pairs(tiles.where("px is not null").select("grp", "node", "tileset"))
    every = graph.checkpoint(every.select("grp", F.col("u_node").alias("u"), F.col("v_node").alias("v")))
    found = todo = None
    robust = F.col("index") >= formula.ROBUST
    for scale in scales:
        with batches.small(tiles.sparkSession):
            now = matched(graph.checkpoint(described(tiles, scale)), todo).where(robust)
            found = graph.checkpoint(now if found is None else found.unionByName(now))
        todo = graph.checkpoint(every.join(found, ["grp", "u", "v"], "left_anti"))
        if todo.isEmpty():
            break
    return scored(found.where(F.abs("angle") < rotation), tiles, threshold, scales)


def grids(tiles: DataFrame, scales: tuple[float, ...] = (0.5, 1.0), threshold: float = 0.8, rotation: float = 5.0) -> DataFrame:
    """(grp, tileset, component, ox, oy): how far each tileset's tiles are shifted on the grid of those that it is connected with.

    tiles: (grp, node, tileset, tx, ty, h, w, px), one for each place of a
    tileset, node named alike nowhere else. A match of two tiles puts one beside,
    above or below the other, or at its corner, whichever its offset is nearest
    to, and so tells how their tilesets lie. Of two tilesets the relation that most matches agree
    on counts, then the one that scores best. A tileset without a match is a
    component of its own.
    """
    good = estimated(tiles, scales, threshold, rotation).where(F.col("score") >= threshold)
    at = lambda s: tiles.select("grp", F.col("node").alias(s), F.col("tileset").alias(f"{s}s"), F.col("tx").alias(f"{s}x"), F.col("ty").alias(f"{s}y"))
    # Beside, above or below; at a corner if the offset runs along both ways.
    step = lambda c, across: F.when(2 * F.abs(c) > F.abs(across), F.signum(c)).otherwise(0)
    both = good.join(at("u"), ["grp", "u"]).join(at("v"), ["grp", "v"])
    dx, dy = F.col("ux") + step(F.col("dx"), F.col("dy")) - F.col("vx"), F.col("uy") + step(F.col("dy"), F.col("dx")) - F.col("vy")
    told = both.select("grp", "us", "vs", dx.cast("long").alias("dx"), dy.cast("long").alias("dy"), "score")
    # Tiles are named in any order, so each pair of tilesets is turned one way round.
    turned = F.col("us") > F.col("vs")
    turn = lambda a, b: F.when(turned, b).otherwise(a)
    told = told.select("grp", turn(F.col("us"), F.col("vs")).alias("a"), turn(F.col("vs"), F.col("us")).alias("b"), turn(F.col("dx"), -F.col("dx")).alias("dx"), turn(F.col("dy"), -F.col("dy")).alias("dy"), "score")
    votes = told.groupBy("grp", "a", "b", "dx", "dy").agg(F.count("*").alias("k"), F.max("score").alias("score"))
    best = votes.groupBy("grp", "a", "b").agg(F.max_by(F.struct("dx", "dy"), F.struct("k", "score", "dx", "dy")).alias("o"))
    name = lambda c: F.concat_ws("\n", "grp", c)
    with batches.small(tiles.sparkSession):
        edges = graph.checkpoint(best.select(name("a").alias("u"), name("b").alias("v"), "o.dx", "o.dy"))
    sets = tiles.select("grp", "tileset", name("tileset").alias("node")).distinct()
    found = graph.placed(sets.select("node"), edges)
    return sets.join(found, "node").select("grp", "tileset", "component", F.col("tx").alias("ox"), F.col("ty").alias("oy"))
