"""Displacement fields as tables (z, gy, gx, dx, dy, sharp, ratio); an invalid vector is null.

Cleaning, reconciling and resampling are relational; the numeric kernels are in
``kernels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import graph


def clean(flow: DataFrame, min_ratio: float, min_sharp: float, max_size: float = 0, max_deviation: float = 0, keys: tuple[str, ...] = ("z",)) -> DataFrame:
    """flow with dx, dy null where a peak is weak, a vector too long, or too far from the 3 x 3 median. A limit of 0 is off."""
    fine = (F.col("ratio") >= min_ratio) & (F.col("sharp") >= min_sharp)
    if max_size:
        fine &= (F.abs("dx") <= max_size) & (F.abs("dy") <= max_size)
    out = flow.withColumns({c: F.when(fine, F.col(c)) for c in ("dx", "dy")})
    if max_deviation:
        near = out.select(*keys, "dx", "dy", F.explode(F.flatten(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda a: F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda b: F.struct((F.col("gy") + a).alias("gy"), (F.col("gx") + b).alias("gx")))))).alias("g"))
        middle = near.groupBy(*keys, "g.gy", "g.gx").agg(F.median("dx").alias("mx"), F.median("dy").alias("my"))
        keep = (F.abs(F.col("dx") - F.col("mx")) <= max_deviation) & (F.abs(F.col("dy") - F.col("my")) <= max_deviation)
        out = out.join(middle, [*keys, "gy", "gx"], "left").withColumns({c: F.when(keep, F.col(c)) for c in ("dx", "dy")}).drop("mx", "my")
    return out


def reconcile(flows: DataFrame, max_gradient: float = 0, min_patch: int = 0) -> DataFrame:
    """One vector a node: of the flow with the lowest priority number that has one.

    flows: (z, gy, gx, priority, dx, dy). Then vectors that differ from their
    left or upper neighbour by more than max_gradient go, and connected patches
    of fewer than min_patch nodes. A limit of 0 is off.
    """
    best = F.struct("priority", "dx", "dy")
    out = flows.groupBy("z", "gy", "gx").agg(F.min(F.when(F.col("dx").isNotNull() & F.col("dy").isNotNull(), best)).alias("b")).select("z", "gy", "gx", "b.dx", "b.dy")
    if max_gradient:
        row, column = Window.partitionBy("z", "gy").orderBy("gx"), Window.partitionBy("z", "gx").orderBy("gy")
        steep = [F.coalesce(F.abs(F.col(c) - F.lag(c).over(w)) > max_gradient, F.lit(False)) for c in ("dx", "dy") for w in (row, column)]
        bad = out.withColumn("__bad", steep[0] | steep[1] | steep[2] | steep[3])
        out = bad.withColumns({c: F.when(~F.col("__bad"), F.col(c)) for c in ("dx", "dy")}).drop("__bad")
    if min_patch:
        out = drop_patches(out, min_patch)
    return out


def patches(valid: DataFrame, width: int = 1 << 20) -> DataFrame:
    """(z, gy, gx, patch) of 4-connected nodes (z, gy, gx); a patch is named by its first node."""
    node = ((F.col("z").cast("bigint") * width) + F.col("gy")) * width + F.col("gx")
    n = valid.select("z", "gy", "gx", node.alias("node"))
    step = lambda d: n.select("node", (F.col("node") + d).alias("v"))
    edges = step(1).unionByName(step(width)).join(n.select(F.col("node").alias("v")), "v", "left_semi").select(F.col("node").alias("u"), "v")
    return n.join(graph.components(n.select("node"), edges), "node").select("z", "gy", "gx", F.col("component").alias("patch"))


def drop_patches(flow: DataFrame, least: int) -> DataFrame:
    p = patches(flow.where(F.col("dx").isNotNull()).select("z", "gy", "gx"))
    small = p.groupBy("patch").agg(F.count("*").alias("n")).where(F.col("n") < least)
    gone = p.join(small, "patch", "left_semi").select("z", "gy", "gx", F.lit(True).alias("__gone"))
    out = flow.join(gone, ["z", "gy", "gx"], "left")
    return out.withColumns({c: F.when(F.col("__gone").isNull(), F.col(c)) for c in ("dx", "dy")}).drop("__gone")


def largest_patch(mask: DataFrame) -> DataFrame:
    """(z, patch, n) of the largest 4-connected part of each slice of mask (z, gy, gx); ties go to the first."""
    sizes = patches(mask).groupBy("z", "patch").agg(F.count("*").alias("n"))
    return sizes.groupBy("z").agg(F.max_by("patch", F.struct("n", -F.col("patch"))).alias("patch"), F.max("n").alias("n"))


def finite(flow: DataFrame, columns: tuple[str, ...] = ("dx", "dy")) -> DataFrame:
    """flow with NaN and infinite values null: what a correlation gives where nothing was measured."""
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    return flow.withColumns({c: F.when(~bad(c), F.col(c)) for c in columns})
