"""Stencils on the row layout: arrays for x, lags over lines for y.

The border is mirrored without repeating the edge pixel unless said otherwise.
Sums are integers wherever pixels are, so results do not depend on the order of
addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .volume import neighbours


def mirrored(i: Column, n: Column) -> Column:
    """Index i of 0..n-1, mirrored at the ends."""
    j = F.abs(i)
    return F.when(n <= 1, F.lit(0)).when(j >= n, 2 * (n - 1) - j).otherwise(j)


def at(px: str | Column, i: Column) -> Column:
    """px[i], mirrored."""
    px = F.col(px) if isinstance(px, str) else px
    return F.element_at(px, mirrored(i, F.size(px)) + 1)


def per_pixel(f: Callable[[Column], Column]) -> Column:
    """An array with f(i) for each place i of px."""
    return F.transform(F.sequence(F.lit(0), F.size("px") - 1), f)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value bound to a variable, so that it is computed once and not copied into each use."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def laplacian(rows: DataFrame) -> DataFrame:
    """(z, y, px) with px the 3x3 Laplacian."""
    value = per_pixel(lambda i: at("up", i) + at("down", i) + at("px", i - 1) + at("px", i + 1) - 4 * at("px", i))
    return neighbours(rows).select("z", "y", value.alias("px"))


def variance(rows: DataFrame) -> DataFrame:
    """(z, n, var): population variance of all pixels of a slice, from integer sums."""
    s = rows.groupBy("z").agg(
        F.sum(F.size("px")).cast("bigint").alias("n"),
        F.sum(F.aggregate("px", F.lit(0).cast("bigint"), lambda a, v: a + v)).alias("s1"),
        F.sum(F.aggregate("px", F.lit(0).cast("bigint"), lambda a, v: a + v.cast("bigint") * v)).alias("s2"),
    )
    n, s1, s2 = (F.col(c).cast("double") for c in ("n", "s1", "s2"))
    return s.select("z", "n", ((s2 * n - s1 * s1) / (n * n)).alias("var"))


def weighted_rows(rows: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Correlation along y with odd-length weights, border mirrored."""
    k = len(weights) // 2
    w = Window.partitionBy("z").orderBy("y").rowsBetween(-k, k)
    near = rows.select("*", F.collect_list("px").over(w).alias("near"), F.min("y").over(w).alias("first"), F.count("*").over(Window.partitionBy("z")).cast("int").alias("height"))
    lines = F.array(*[F.element_at("near", (mirrored(F.col("y") + (d - k), F.col("height")) - F.col("first") + 1).cast("int")) for d in range(len(weights))])
    add = lambda n: F.transform(F.sequence(F.lit(1), F.size(n[0])), lambda i: sum((F.element_at(n[d], i) * c for d, c in enumerate(weights) if c), F.lit(0)))
    return near.select("z", "y", let(lines, add).alias("px"))


def weighted_columns(rows: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Correlation along x with odd-length weights, border mirrored."""
    k = len(weights) // 2

    def line(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(p) - 1), lambda i: sum((at(p, i + (d - k)) * c for d, c in enumerate(weights) if c), F.lit(0)))

    return rows.select("z", "y", let(F.col("px"), line).alias("px"))


#: 5-tap Sobel: binomial smoothing and its derivative.
SMOOTH, SLOPE = (1, 4, 6, 4, 1), (-1, -2, 0, 2, 1)


def sobel_magnitude(rows: DataFrame) -> DataFrame:
    """(z, y, x, gx, gy): 5x5 Sobel gradients."""
    gx = weighted_columns(weighted_rows(rows, SMOOTH), SLOPE).withColumnRenamed("px", "gx")
    gy = weighted_columns(weighted_rows(rows, SLOPE), SMOOTH).withColumnRenamed("px", "gy")
    both = gx.join(gy, ["z", "y"])
    return both.select("z", "y", F.posexplode(F.arrays_zip("gx", "gy")).alias("x", "g")).select("z", "y", "x", "g.gx", "g.gy")


def central_gradients(rows: DataFrame) -> DataFrame:
    """(z, y, x, gx2, gy2): twice the central differences, one-sided (so doubled) at the borders."""
    w = Window.partitionBy("z").orderBy("y")
    r = rows.select("z", "y", "px", F.lag("px").over(w).alias("up"), F.lead("px").over(w).alias("down"))
    n = F.size("px")
    double = F.when(F.col("up").isNull() | F.col("down").isNull(), 2).otherwise(1)
    gx = per_pixel(lambda i: (F.element_at("px", F.least(i + 2, n)) - F.element_at("px", F.greatest(i, F.lit(1)))) * F.when((i == 0) | (i == n - 1), 2).otherwise(1))
    gy = per_pixel(lambda i: (F.element_at(F.coalesce("down", "px"), i + 1) - F.element_at(F.coalesce("up", "px"), i + 1)) * double)
    return r.select("z", "y", F.posexplode(F.arrays_zip(gx.alias("gx2"), gy.alias("gy2"))).alias("x", "g")).select("z", "y", "x", "g.gx2", "g.gy2")


def extreme(rows: DataFrame, k: int, least: bool) -> DataFrame:
    """Minimum or maximum over (2k+1)^2 pixels, those outside the image left out."""
    pick = F.array_min if least else F.array_max
    flat = rows.select("z", "y", per_pixel(lambda i: pick(F.slice("px", F.greatest(i - k + 1, F.lit(1)), F.least(i + k + 1, F.size("px")) - F.greatest(i - k + 1, F.lit(1)) + 1))).alias("px"))
    w = Window.partitionBy("z").orderBy("y").rowsBetween(-k, k)
    near = flat.select("z", "y", "px", F.collect_list("px").over(w).alias("near"))
    return near.select("z", "y", per_pixel(lambda i: pick(F.transform("near", lambda line: F.element_at(line, i + 1)))).alias("px"))


def range_mask(rows: DataFrame, k: int, limit: int) -> DataFrame:
    """(z, y, px) with px true where the local range is below the limit."""
    high, low = extreme(rows, k, False).withColumnRenamed("px", "high"), extreme(rows, k, True).withColumnRenamed("px", "low")
    return high.join(low, ["z", "y"]).select("z", "y", F.zip_with("high", "low", lambda a, b: a - b < limit).alias("px"))


def close_mask(rows: DataFrame, k: int = 1) -> DataFrame:
    """Morphological closing of a 0/1 mask: dilation, then erosion."""
    return extreme(extreme(rows, k, False), k, True)


def gaussian3(rows: DataFrame) -> DataFrame:
    """3x3 binomial blur (1 2 1), rounded down."""
    b = weighted_columns(weighted_rows(rows, (1, 2, 1)), (1, 2, 1))
    return b.select("z", "y", F.transform("px", lambda v: F.floor(v / 16).cast("int")).alias("px"))


def invert(rows: DataFrame) -> DataFrame:
    return rows.withColumn("px", F.transform("px", lambda v: 255 - v))
