"""Kernels over tables: one task for a slice or an ordered run of slices.

Images travel as (z, h, w, px binary), one row a slice or chunk; a pair of
adjacent slices is made by a join, and serial work along z is one group a
dataset, walked in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..kernels import register, resample
from . import islands

FIELD = "z int, gy int, gx int, dx double, dy double, sharp double, ratio double"


def to_binary(rows: DataFrame) -> DataFrame:
    """(z, h, w, px) of the row layout; a short last line is filled with 0."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("y")
        image = np.zeros((int(frame["y"].max()) + 1, max(map(len, frame["px"]))), np.uint8)
        for y, line in zip(frame["y"], frame["px"], strict=True):
            image[y, : len(line)] = line
        return pd.DataFrame({"z": [int(frame["z"].iloc[0])], "h": [image.shape[0]], "w": [image.shape[1]], "px": [image.tobytes()]})

    return rows.groupBy("z").applyInPandas(run, "z int, h int, w int, px binary")


def image(h: int, w: int, px: bytes) -> np.ndarray:
    return np.frombuffer(px, np.uint8).reshape(h, w)


def has_content(px: Column) -> Column:
    """Whether an image has a pixel that isn't 0."""
    return F.length(F.trim(px.cast("string"), F.lit("\0"))) > 0


def pairs(images: DataFrame) -> DataFrame:
    """Each slice with the slice before it that has content: columns of both, the reference's with prefix r."""
    filled = images.select("z", has_content(F.col("px")).alias("any"))
    ref = islands.last_valid(filled, "z", F.col("any")).where("any and reference is not null").select("z", "reference")  # one row for a slice
    r = images.select(F.col("z").alias("reference"), F.col("h").alias("rh"), F.col("w").alias("rw"), F.col("px").alias("rpx"))
    return images.join(ref, "z").join(r, "reference")


def field_rows(z: int, field: np.ndarray) -> pd.DataFrame:
    """A field (channels, gy, gx) as rows; NaN becomes null."""
    gy, gx = np.mgrid[: field.shape[1], : field.shape[2]]
    out = pd.DataFrame({"z": np.full(gy.size, z, np.int32), "gy": gy.ravel().astype(np.int32), "gx": gx.ravel().astype(np.int32)})
    for name, c in zip(("dx", "dy", "sharp", "ratio"), field, strict=False):
        out[name] = pd.Series(c.ravel(), dtype="float64").astype(object).where(~np.isnan(c.ravel()), None)
    return out


def ncc_flow(images: DataFrame, patch: int = 32, stride: int = 16, most: int = 8) -> DataFrame:
    """(z, gy, gx, dx, dy, sharp, ratio) between each slice and the last one with content; each pair is its own task's work."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                a, b = image(r["rh"], r["rw"], r["rpx"]), image(r["h"], r["w"], r["px"])
                h, w = min(a.shape[0], b.shape[0]), min(a.shape[1], b.shape[1])
                a, b = a[:h, :w], b[:h, :w]
                yield field_rows(r["z"], register.flow(a, b, patch, stride, most, a > 0, b > 0))

    return pairs(images).repartition("z").mapInPandas(run, FIELD)


def _field(frame: pd.DataFrame) -> np.ndarray:
    out = np.full((2, int(frame["gy"].max()) + 1, int(frame["gx"].max()) + 1), np.nan)
    out[0, frame["gy"], frame["gx"]] = frame["dx"].astype(float)
    out[1, frame["gy"], frame["gx"]] = frame["dy"].astype(float)
    return out


def by_slice(field: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """f on each slice's field (2, gy, gx), as a table again."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return field_rows(int(frame["z"].iloc[0]), f(_field(frame)))

    return field.select("z", "gy", "gx", "dx", "dy").groupBy("z").applyInPandas(run, "z int, gy int, gx int, dx double, dy double")


def relax(field: DataFrame, mesh: register.Mesh = register.Mesh()) -> DataFrame:
    return by_slice(field, lambda f: register.relax(f, mesh)[0])


def invert(field: DataFrame) -> DataFrame:
    return by_slice(field, lambda f: resample.invert(np.nan_to_num(f)))


def compose(first: DataFrame, then: DataFrame) -> DataFrame:
    """The fields of two tables composed, slice by slice."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({c: [] for c in ("z", "gy", "gx", "dx", "dy")})
        return field_rows(int(a["z"].iloc[0]), resample.compose(np.nan_to_num(_field(a)), np.nan_to_num(_field(b))))

    pick = ("z", "gy", "gx", "dx", "dy")
    return first.select(*pick).groupBy("z").cogroup(then.select(*pick).groupBy("z")).applyInPandas(run, "z int, gy int, gx int, dx double, dy double")


def warp(images: DataFrame, field: DataFrame) -> DataFrame:
    """Slices seen through their field, which is spread over the whole image; a slice without a field stays as it is."""

    def run(a: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        if a.empty:
            return pd.DataFrame({c: [] for c in ("z", "h", "w", "px")})
        r = a.iloc[0]
        out = image(r["h"], r["w"], r["px"])
        if len(f):
            out = resample.warp(out, resample.upsample_field(np.nan_to_num(_field(f)), out.shape, 1))
        return pd.DataFrame({"z": [r["z"]], "h": [r["h"]], "w": [r["w"]], "px": [out.tobytes()]})

    return images.groupBy("z").cogroup(field.select("z", "gy", "gx", "dx", "dy").groupBy("z")).applyInPandas(run, "z int, h int, w int, px binary")


def transforms(images: DataFrame, scale: float = 1.0) -> DataFrame:
    """(z, a, b, tx, c, d, ty, out_h, out_w, matches, inliers, robust): similarity of each slice to the one before; nulls where none was found."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["z", "a", "b", "tx", "c", "d", "ty", "out_h", "out_w", "matches", "inliers", "robust"]
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                e = register.estimate(image(r["rh"], r["rw"], r["rpx"]), image(r["h"], r["w"], r["px"]), scale)
                out.append((r["z"], *([None] * 6 if e.matrix is None else e.matrix.ravel().tolist()), *(e.shape or (None, None)), e.matches, len(e.residuals), e.robust))
            yield pd.DataFrame(out, columns=names).astype({"out_h": "Int64", "out_w": "Int64"})

    return pairs(images).repartition("z").mapInPandas(run, "z int, a double, b double, tx double, c double, d double, ty double, out_h int, out_w int, matches int, inliers int, robust boolean")


def fold(images: DataFrame, group: str, step: Callable[[np.ndarray | None, np.ndarray], tuple[np.ndarray, dict]], schema: str, ignore: tuple[int, ...] = ()) -> DataFrame:
    """A serial walk over z in each group: step(previous result, image) -> (result, values for the output).

    Empty and ignored slices leave the state as it was and have no output. A
    group is walked by one task, which holds the slice at hand and the state.
    """
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                if r[group] != at:
                    at, state = r[group], None
                current = image(r["h"], r["w"], r["px"])
                if r["z"] in ignore or not current.any():
                    continue
                state, values = step(state, current)
                out.append({group: r[group], "z": r["z"], **values})
            yield pd.DataFrame(out, columns=columns)

    return images.select(group, "z", "h", "w", "px").repartition(group).sortWithinPartitions(group, "z").mapInPandas(run, schema)


def rescale(images: DataFrame, ratio: str) -> DataFrame:
    """images (z, h, w, px, ...) scaled by each row's ratio, so that datasets of unlike resolution match; other columns are kept."""
    others = [c for c in images.columns if c not in ("h", "w", "px")]
    kinds = ", ".join(f"{c} {images.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [resample.resample(image(h, w, px), float(k)) for h, w, px, k in zip(*[batch[c] for c in ("h", "w", "px", ratio)], strict=True)]
            sizes = pd.DataFrame([(*i.shape, i.tobytes()) for i in out], columns=["h", "w", "px"])
            yield pd.concat([batch[others].reset_index(drop=True), sizes], axis=1)

    return images.mapInPandas(run, f"{kinds}, h int, w int, px binary")


def at_resolution(images: DataFrame, target: float) -> DataFrame:
    """images (resolution, h, w, px, ...) scaled to the target resolution, which is theirs from now on.

    Resolutions are pixel sizes: an image of finer pixels than the target's is
    an error, as scaling it would lose some.
    """
    ratio = geometry.scale_ratio(F.col("resolution"), F.lit(float(target)), 1.0)
    return rescale(images.withColumn("__ratio", ratio), "__ratio").drop("__ratio").withColumn("resolution", F.lit(float(target)))


def quality(images: DataFrame, score: Callable[[np.ndarray, np.ndarray | None], float]) -> DataFrame:
    """(z, quality) by a function of the caller's: the slice that scores higher goes on top."""

    @F.pandas_udf("double")
    def scored(h: pd.Series, w: pd.Series, px: pd.Series) -> pd.Series:
        return pd.Series([float(score(image(a, b, c), None)) for a, b, c in zip(h, w, px, strict=True)])

    return images.select("z", scored("h", "w", "px").alias("quality"))


