"""Scans, sinks, stencils and compositing over the pixel volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import asof, stencil, volume
from .registry import VOLUME, Tables, query


def rows(t: Tables) -> DataFrame:
    return volume.from_vectors(t("embeddings"))


def px(t: Tables) -> DataFrame:
    return volume.pixels(rows(t))


@query("WITH {V} SELECT z, (y - 8)::INT AS y, (x - 16)::INT AS x, v FROM V WHERE z BETWEEN 1 AND 4 AND y BETWEEN 8 AND 39 AND x BETWEEN 16 AND 47")
def scan_window(t: Tables) -> DataFrame:
    """Slices by a range that the scan sees, lines and columns cut before pixels are made."""
    r = volume.from_vectors(volume.slices_of(t("embeddings"), 1, 5))
    return volume.pixels(volume.crop_rows(r, (1, 5), (8, 40), (16, 48)))


@query("WITH {V}, b AS (SELECT greatest(-3, 0) AS z0, least(5, max(z) + 1) AS z1 FROM V), keep AS (SELECT z FROM V GROUP BY z HAVING bool_or(v <> 0)) SELECT V.z, V.y, V.x, V.v FROM V, b WHERE V.z >= z0 AND V.z < z1 AND V.z IN (SELECT z FROM keep)")
def read_bbox_clamped(t: Tables) -> DataFrame:
    """A box that reaches out on both sides is clamped; empty slices go."""
    r = volume.from_vectors(volume.slices_of(t("embeddings"), -3, 5))
    return volume.pixels(r.join(volume.nonempty(r), "z", "left_semi"))


#: Slices that are emptied for the queries about gaps.
EMPTY = "z % 3 = 1"
HOLED = VOLUME + f", H AS (SELECT z, y, x, CASE WHEN {EMPTY} THEN 0 ELSE v END AS v FROM V)"


def holed(t: Tables) -> DataFrame:
    return rows(t).withColumn("px", F.when(F.expr(EMPTY), F.transform("px", lambda v: F.lit(0))).otherwise(F.col("px")))


@query(f"WITH {HOLED} SELECT z, count(*) FILTER (v <> 0) AS filled FROM H GROUP BY z HAVING bool_or(v <> 0)")
def nonempty_slices(t: Tables) -> DataFrame:
    r = holed(t)
    return r.groupBy("z").agg(F.sum(F.size(F.filter("px", lambda v: v != 0))).cast("bigint").alias("filled")).where("filled > 0")


@query(f"WITH {HOLED}, s AS (SELECT DISTINCT z FROM H), f AS (SELECT DISTINCT z FROM H WHERE v <> 0), g AS (SELECT unnest(range(min(z), max(z) + 1, 2))::INT AS z FROM s UNION SELECT max(z) FROM s) SELECT g.z AS sample, min(f.z) AS z FROM g LEFT JOIN f ON f.z >= g.z GROUP BY g.z")
def sample_slices_asof(t: Tables) -> DataFrame:
    """Every second slice and the last, each moved on to the next slice with content."""
    r = holed(t)
    ends = r.agg(F.min("z").alias("a"), F.max("z").alias("b"))
    wanted = ends.select(F.explode(F.array_union(F.sequence("a", "b", F.lit(2)), F.array("b"))).alias("sample"))
    return asof.forward(wanted, volume.nonempty(r), "sample", "z").select("sample", "z")


@query("WITH {V} SELECT z, (y // 32)::INT AS ty, (x // 32)::INT AS tx, count(*) AS n, sum(v)::BIGINT AS total, max(y * 64 + x)::INT AS last FROM V GROUP BY ALL")
def mosaic_assemble(t: Tables) -> DataFrame:
    """Cut into 32 x 32 tiles, put together again, and summed by tile."""
    again = volume.mosaic(volume.tile(px(t), 32, 32), 32, 32)
    return volume.tile(again, 32, 32).groupBy("z", "ty", "tx").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.max(F.col("y") * 64 + F.col("x")).alias("last"))


@query("WITH {V} SELECT z, (y // 3)::INT AS y, (x // 3)::INT AS x, v FROM V WHERE y % 3 = 0 AND x % 3 = 0")
def downsample_nearest(t: Tables) -> DataFrame:
    return volume.pixels(volume.down_nearest(rows(t), 3))


@query("WITH {V} SELECT z, (y // 4)::INT AS y, (x // 4)::INT AS x, (sum(v) // count(*))::INT AS v FROM V GROUP BY ALL")
def downsample_block_mean(t: Tables) -> DataFrame:
    return volume.down_mean(px(t), 4)


@query("WITH {V} SELECT z, (y // 2)::INT AS y, (x // 2)::INT AS x, sum(v)::DOUBLE / 4 AS v FROM V GROUP BY ALL HAVING count(*) = 4")
def bilinear_half(t: Tables) -> DataFrame:
    """At ratio one half, a bilinear sample lies in the middle of four pixels."""
    half = [F.floor(F.col(c) / 2).cast("int").alias(c) for c in ("y", "x")]
    return px(t).groupBy("z", *half).agg((F.sum("v").cast("double") / 4).alias("v"), F.count("*").alias("n")).where("n = 4").drop("n")


@query("WITH {V}, o AS (SELECT * FROM V WHERE x < 48), n AS (SELECT z - 1 AS z, y, x, v, v > 140 AS m FROM V WHERE z > 0) SELECT z::INT AS z, y, x, CASE WHEN m THEN n.v ELSE coalesce(o.v, 0) END AS v FROM o FULL JOIN n USING (z, y, x)")
def masked_merge(t: Tables) -> DataFrame:
    """Each slice overwritten by the next where that is bright."""
    r = rows(t)
    new = r.where("z > 0").select((F.col("z") - 1).alias("z"), "y", "px", F.transform("px", lambda v: v > 140).alias("mask"))
    return volume.pixels(volume.masked_merge(r.withColumn("px", F.slice("px", 1, 48)), new))


@query("WITH {V} SELECT max(z) + 1 AS depth, max(y) + 1 AS height, max(x) + 1 AS width, min(z) AS zmin FROM V")
def dataset_shape(t: Tables) -> DataFrame:
    return volume.shape(rows(t))


LAP = """L AS (
    SELECT z, y, x,
        coalesce(lag(v) OVER c, lead(v) OVER c, v) + coalesce(lead(v) OVER c, lag(v) OVER c, v) + coalesce(lag(v) OVER r, lead(v) OVER r, v) + coalesce(lead(v) OVER r, lag(v) OVER r, v) - 4 * v AS l
    FROM V WINDOW r AS (PARTITION BY z, y ORDER BY x), c AS (PARTITION BY z, x ORDER BY y)
), S AS (SELECT z, count(*)::BIGINT AS n, sum(l)::BIGINT AS s1, sum(l * l)::BIGINT AS s2 FROM L GROUP BY z),
LV AS (SELECT z, n, (s2::DOUBLE * n::DOUBLE - s1::DOUBLE * s1::DOUBLE) / (n::DOUBLE * n::DOUBLE) AS var FROM S)"""


@query(f"WITH {VOLUME}, {LAP} SELECT z, n, var FROM LV")
def laplacian_var(t: Tables) -> DataFrame:
    return stencil.variance(stencil.laplacian(rows(t)))


@query(f"WITH {VOLUME}, {LAP}, P AS (SELECT z, var, lag(var) OVER (ORDER BY z) AS prev FROM LV) SELECT z, var, prev, CASE WHEN prev IS NULL THEN NULL WHEN greatest(var, prev) = 0 THEN 1.0 ELSE 1 - abs(var - prev) / greatest(var, prev) END AS similarity, coalesce(CASE WHEN greatest(var, prev) = 0 THEN 1.0 ELSE 1 - abs(var - prev) / greatest(var, prev) END < 0.98, false) AS flagged FROM P")
def laplacian_var_diff(t: Tables) -> DataFrame:
    """Slices whose sharpness differs from the slice before; the flagship query."""
    v = laplacian_var_of(rows(t))
    s = geometry.similarity(F.col("var"), F.col("prev"))
    return v.select("z", "var", "prev", s.alias("similarity"), F.coalesce(s < 0.98, F.lit(False)).alias("flagged"))


def laplacian_var_of(r: DataFrame) -> DataFrame:
    v = stencil.variance(stencil.laplacian(r)).select("z", "var")
    return v.withColumn("prev", F.lag("var").over(Window.orderBy("z")))  # one row for a slice


def _sql_taps(weights: tuple[int, ...], by: str, other: str, source: str, name: str) -> str:
    """Weighted sum along one axis with a mirrored border, as SQL."""
    taps = ", ".join(f"({i - len(weights) // 2}, {w})" for i, w in enumerate(weights) if w)
    return f"""{name}n AS (SELECT z, max({by}) + 1 AS n FROM {source} GROUP BY z),
    {name}t AS (SELECT a.*, w, CASE WHEN abs({by} + d) >= n THEN 2 * (n - 1) - abs({by} + d) ELSE abs({by} + d) END AS at FROM {source} a JOIN {name}n USING (z), (VALUES {taps}) t(d, w)),
    {name} AS (SELECT a.z, a.y, a.x, sum(a.w * b.v)::BIGINT AS v FROM {name}t a JOIN {source} b ON b.z = a.z AND b.{other} = a.{other} AND b.{by} = a.at GROUP BY ALL)"""


SOBEL = ", ".join([
    VOLUME, _sql_taps(stencil.SMOOTH, "y", "x", "V", "SY"), _sql_taps(stencil.SLOPE, "x", "y", "SY", "GX"), _sql_taps(stencil.SLOPE, "y", "x", "V", "DY"), _sql_taps(stencil.SMOOTH, "x", "y", "DY", "GY"),
])


@query(f"WITH {SOBEL} SELECT z, sum(GX.v * GX.v)::BIGINT AS gx2, sum(GY.v * GY.v)::BIGINT AS gy2, sum(floor(sqrt((GX.v * GX.v + GY.v * GY.v)::DOUBLE))::BIGINT)::DOUBLE / count(*) AS mean FROM GX JOIN GY USING (z, y, x) GROUP BY z")
def sobel_mean(t: Tables) -> DataFrame:
    """Mean magnitude of the 5x5 Sobel gradient; magnitudes are cut to integers so that the sum is exact."""
    g = stencil.sobel_magnitude(rows(t)).select("z", F.col("gx").cast("bigint").alias("gx"), F.col("gy").cast("bigint").alias("gy"))
    square = F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")
    return g.groupBy("z").agg(F.sum(F.col("gx") * F.col("gx")).alias("gx2"), F.sum(F.col("gy") * F.col("gy")).alias("gy2"), (F.sum(F.floor(F.sqrt(square.cast("double")))).cast("double") / F.count("*")).alias("mean"))


GRAD = """G AS (
    SELECT z, y, x,
        CASE WHEN lag(v) OVER r IS NULL THEN 2 * (lead(v) OVER r - v) WHEN lead(v) OVER r IS NULL THEN 2 * (v - lag(v) OVER r) ELSE lead(v) OVER r - lag(v) OVER r END AS gx,
        CASE WHEN lag(v) OVER c IS NULL THEN 2 * (lead(v) OVER c - v) WHEN lead(v) OVER c IS NULL THEN 2 * (v - lag(v) OVER c) ELSE lead(v) OVER c - lag(v) OVER c END AS gy
    FROM V WINDOW r AS (PARTITION BY z, y ORDER BY x), c AS (PARTITION BY z, x ORDER BY y)
), GM AS (SELECT z, sum(floor(sqrt((gx * gx + gy * gy)::DOUBLE) * 50)::BIGINT)::DOUBLE / count(*) AS grad FROM G GROUP BY z)"""


def gradient_score(r: DataFrame) -> DataFrame:
    g = stencil.central_gradients(r)
    return g.groupBy("z").agg((F.sum(F.floor(F.sqrt((F.col("gx2") * F.col("gx2") + F.col("gy2") * F.col("gy2")).cast("double")) * 50)).cast("double") / F.count("*")).alias("grad"))


@query(f"WITH {VOLUME}, {GRAD} SELECT z, grad / 100 AS grad FROM GM")
def grad_mag(t: Tables) -> DataFrame:
    """Mean central-difference gradient, in hundredths cut to integers before the sum."""
    return gradient_score(rows(t)).select("z", (F.col("grad") / 100).alias("grad"))


@query(f"WITH {VOLUME}, {LAP}, {GRAD}, Q AS (SELECT z // 2 AS pair, z, 0.5 * var + grad AS quality FROM LV JOIN GM USING (z)) SELECT pair::INT AS pair, arg_max(z, quality) AS on_top, max(quality) AS quality FROM Q GROUP BY pair")
def quality_on_top(t: Tables) -> DataFrame:
    """Of two overlapping images the one with the better sharpness score is painted on top."""
    r = rows(t)
    q = stencil.variance(stencil.laplacian(r)).join(gradient_score(r), "z").select(F.floor(F.col("z") / 2).cast("int").alias("pair"), "z", (0.5 * F.col("var") + F.col("grad")).alias("quality"))
    return q.groupBy("pair").agg(F.max_by("z", "quality").alias("on_top"), F.max("quality").alias("quality"))


@query("WITH {V} SELECT z, min(y) FILTER (v > 150) AS y0, max(y) FILTER (v > 150) + 1 AS y1, min(x) FILTER (v > 150) AS x0, max(x) FILTER (v > 150) + 1 AS x1 FROM V GROUP BY z")
def mask_bbox(t: Tables) -> DataFrame:
    return geometry.mask_bbox(rows(t).select("z", "y", F.transform("px", lambda v: v > 150).alias("mask")), "z")


@query("WITH {V}, T AS (SELECT z, max(y) + 1 AS h, max(x) + 1 - z AS w FROM V GROUP BY z) SELECT max(h) AS h, max(w) AS w, min(h) AS min_h, min(w) AS min_w FROM T")
def max_shape(t: Tables) -> DataFrame:
    s = rows(t).groupBy("z").agg((F.max("y") + 1).alias("h"), F.max(F.size("px")).alias("w")).withColumn("w", F.col("w") - F.col("z"))
    return s.agg(F.max("h").alias("h"), F.max("w").alias("w"), F.min("h").alias("min_h"), F.min("w").alias("min_w"))


@query("WITH {V}, H AS (SELECT z, v, count(*)::BIGINT AS n FROM V GROUP BY ALL), C AS (SELECT z, v, n, sum(n) OVER (PARTITION BY z ORDER BY v)::BIGINT AS cdf, sum(n) OVER (PARTITION BY z)::BIGINT AS total FROM H), M AS (SELECT *, min(cdf) OVER (PARTITION BY z) AS low FROM C) SELECT z, v, n, ((cdf - low) * 255 // greatest(total - low, 1))::INT AS equalized FROM M")
def hist_equalize(t: Tables) -> DataFrame:
    """Histogram by value, then its running sum: at most 256 rows a slice are windowed."""
    h = px(t).groupBy("z", "v").agg(F.count("*").alias("n"))
    c = h.withColumn("cdf", F.sum("n").over(Window.partitionBy("z").orderBy("v"))).withColumn("total", F.sum("n").over(Window.partitionBy("z"))).withColumn("low", F.min("cdf").over(Window.partitionBy("z")))
    return c.select("z", "v", "n", F.expr("cast((cdf - low) * 255 div greatest(total - low, 1) as int)").alias("equalized"))


@query("WITH {V} SELECT z, (y // 16)::INT AS by, (x // 16)::INT AS bx, v, count(*) AS n, least(count(*), 4) AS clipped FROM V GROUP BY ALL")
def clahe_block_hist(t: Tables) -> DataFrame:
    """Histograms of 16 x 16 blocks with the clip limit applied: the first step of adaptive equalisation."""
    b = volume.tile(px(t), 16, 16)
    return b.groupBy("z", F.col("ty").alias("by"), F.col("tx").alias("bx"), "v").agg(F.count("*").alias("n"), F.least(F.count("*"), F.lit(4)).alias("clipped"))


@query("WITH {V} SELECT z, y, x, 255 - v AS v FROM V")
def invert_pixels(t: Tables) -> DataFrame:
    return volume.pixels(stencil.invert(rows(t)))


BLUR = ", ".join([VOLUME, _sql_taps((1, 2, 1), "y", "x", "V", "BY1"), _sql_taps((1, 2, 1), "x", "y", "BY1", "B")])


@query(f"WITH {BLUR} SELECT z, y, x, (v // 16)::INT AS v FROM B")
def gaussian_blur(t: Tables) -> DataFrame:
    return volume.pixels(stencil.gaussian3(rows(t)))


@query("WITH {V}, R AS (SELECT z, y, x, max(v) OVER w AS h, min(v) OVER w AS l FROM V WINDOW w AS (PARTITION BY z, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) SELECT z, y, x, max(h) OVER c - min(l) OVER c < 45 AS mask FROM R WINDOW c AS (PARTITION BY z, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)")
def range_mask(t: Tables) -> DataFrame:
    return volume.pixels(stencil.range_mask(rows(t), 1, 45)).withColumnRenamed("v", "mask")


@query("WITH {V}, M AS (SELECT z, y, x, (v > 140)::INT AS m FROM V), A AS (SELECT z, y, x, max(m) OVER (PARTITION BY z, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM M), B AS (SELECT z, y, x, max(m) OVER (PARTITION BY z, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM A), C AS (SELECT z, y, x, min(m) OVER (PARTITION BY z, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM B) SELECT z, y, x, min(m) OVER (PARTITION BY z, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM C")
def morph_close(t: Tables) -> DataFrame:
    mask = rows(t).withColumn("px", F.transform("px", lambda v: (v > 140).cast("int")))
    return volume.pixels(stencil.close_mask(mask)).withColumnRenamed("v", "m")


@query("WITH {V} SELECT a.z, a.y, (a.x - 44)::INT AS x, a.v AS v1, b.v AS v2 FROM V a JOIN V b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x - 44 WHERE a.x >= 44")
def crop_overlap(t: Tables) -> DataFrame:
    """The common part of a slice and the next, placed 44 pixels to the right of it."""
    r = rows(t)
    both = geometry.overlap(r, r.withColumn("z", F.col("z") - 1), 44, 0)
    return both.select("z", "y", F.posexplode(F.arrays_zip("px1", "px2")).alias("x", "v")).select("z", "y", "x", F.col("v.px1").alias("v1"), F.col("v.px2").alias("v2"))


@query("WITH {V}, O AS (SELECT a.z, a.y, a.x FROM V a JOIN V b ON b.z = a.z + 1 AND b.y = a.y AND b.x = a.x WHERE a.v > 150 AND b.v > 150) SELECT z, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1 FROM O GROUP BY z")
def overlap_mask_bbox(t: Tables) -> DataFrame:
    """Box of where two adjacent slices both have a mask."""
    r = rows(t)
    both = geometry.overlap(r, r.withColumn("z", F.col("z") - 1), 0, 0)
    mask = F.zip_with("px1", "px2", lambda a, b: (a > 150) & (b > 150))
    return geometry.mask_bbox(both.select("z", "y", mask.alias("mask")), "z").where("y0 is not null")


@query("SELECT o AS offset_px, greatest(-o, 0) AS pad_before, greatest(o, 0) AS pad_after FROM (SELECT DISTINCT (l_quantity - 25)::BIGINT AS o FROM lineitem)")
def offset_to_pad(t: Tables) -> DataFrame:
    d = t("lineitem").select((F.col("l_quantity") - 25).cast("bigint").alias("offset_px")).distinct()
    return d.select("offset_px", geometry.pad_before(F.col("offset_px")).alias("pad_before"), geometry.pad_after(F.col("offset_px")).alias("pad_after"))


@query("WITH {V}, G AS (SELECT z, y::INT AS y, x::INT AS x FROM (SELECT DISTINCT z FROM V), range(66) a(y), range(64) b(x)) SELECT G.z, G.y, G.x, coalesce(v, 0) AS v FROM G LEFT JOIN V USING (z, y, x)")
def pad_grid(t: Tables) -> DataFrame:
    """Slices padded at the end of y to one height."""
    return volume.pixels(geometry.pad_lines(rows(t), 66, 64))


@query("WITH T AS (SELECT DISTINCT (s_suppkey * s_suppkey % 11)::INT AS tx, (s_suppkey * s_suppkey % 7)::INT AS ty FROM supplier) SELECT T.tx, T.ty, CASE WHEN u.tx IS NULL THEN 10 ELSE 50 END AS top, CASE WHEN d.tx IS NULL THEN 10 ELSE 50 END AS bottom, CASE WHEN l.tx IS NULL THEN 10 ELSE 50 END AS l, CASE WHEN r.tx IS NULL THEN 10 ELSE 50 END AS r FROM T LEFT JOIN T u ON u.tx = T.tx AND u.ty = T.ty - 1 LEFT JOIN T d ON d.tx = T.tx AND d.ty = T.ty + 1 LEFT JOIN T l ON l.ty = T.ty AND l.tx = T.tx - 1 LEFT JOIN T r ON r.ty = T.ty AND r.tx = T.tx + 1")
def tile_margins(t: Tables) -> DataFrame:
    """Tiles of a grid with holes (squares leave few remainders): margins are wide only toward a neighbour."""
    square = F.col("s_suppkey") * F.col("s_suppkey")
    tiles = t("supplier").select((square % 11).cast("int").alias("tx"), (square % 7).cast("int").alias("ty")).distinct()
    return geometry.margins(tiles, 50, 10)


@query("WITH {V}, G AS (SELECT i::INT AS gy, j::INT AS gx, (i * 51 // 9)::INT AS y, (j * 63 // 9)::INT AS x FROM range(10) a(i), range(10) b(j)) SELECT z, gy, gx, v > 127 AS mask FROM V JOIN G USING (y, x)")
def mask_to_mesh(t: Tables) -> DataFrame:
    """A mask sampled at 10 x 10 nodes spread evenly from the first pixel to the last."""
    return geometry.to_mesh(px(t).withColumn("mask", F.col("v") > 127), 52, 64, 10, 10)


@query(f"WITH {VOLUME}, T AS (SELECT z, (y // 16)::INT AS ty, (x // 16)::INT AS tx, sum(v)::BIGINT AS s1, sum(v * v)::BIGINT AS s2, count(*)::BIGINT AS n FROM V GROUP BY ALL), Q AS (SELECT z, ty, tx, (s2::DOUBLE * n - s1::DOUBLE * s1) / (n::DOUBLE * n) AS q FROM T), E AS (SELECT a.z, a.ty, a.tx, 'right' AS side, a.q AS a, b.q AS b FROM Q a JOIN Q b ON a.z = b.z AND a.ty = b.ty AND b.tx = a.tx + 1 UNION ALL SELECT a.z, a.ty, a.tx, 'below', a.q, b.q FROM Q a JOIN Q b ON a.z = b.z AND a.tx = b.tx AND b.ty = a.ty + 1) SELECT z, ty, tx, side, CASE WHEN greatest(a, b) = 0 THEN 1.0 ELSE 1 - abs(a - b) / greatest(a, b) END AS score FROM E")
def stitch_scores(t: Tables) -> DataFrame:
    """Similarity of the variance of each pair of adjacent 16 x 16 tiles."""
    n, s1, s2 = (F.col(c).cast("double") for c in ("n", "s1", "s2"))
    v = F.col("v").cast("bigint")
    tiles = volume.tile(px(t), 16, 16).groupBy("z", "ty", "tx").agg(F.sum(v).alias("s1"), F.sum(v * v).alias("s2"), F.count("*").alias("n")).select("z", "ty", "tx", ((s2 * n - s1 * s1) / (n * n)).alias("q"))
    e = geometry.adjacent(tiles, "z", "q")
    return e.select("z", "ty", "tx", "side", geometry.similarity(F.col("a"), F.col("b")).alias("score"))


@query("WITH {V}, L AS (SELECT z // 3 AS g, z % 3 AS priority, y, x, v, v > 120 AS m FROM V) SELECT g::INT AS g, y, x, coalesce(arg_max(v, CASE WHEN m THEN priority END) FILTER (m), 0) AS v FROM L GROUP BY g, y, x")
def paint_order_composite(t: Tables) -> DataFrame:
    """Three slices painted over each other; the mask lets lower ones through."""
    layers = rows(t).select(F.floor(F.col("z") / 3).cast("int").alias("g"), (F.col("z") % 3).alias("priority"), "y", "px", F.transform("px", lambda v: v > 120).alias("mask"))
    return volume.pixels(volume.paint(layers, "g", "y"))
