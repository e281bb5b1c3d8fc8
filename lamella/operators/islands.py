"""Runs of rows that belong together, intervals, neighbours in an order."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import graph

#: Keys of a block of like intervals; blocks of a bin that a task takes on either side, unless the bin has too many.
BLOCK, SHARE = 1024, 8


def islands(df: DataFrame, order: str, value: Column, by: list[str] | None = None, name: str = "island") -> DataFrame:
    """df with the number of its run (from 1): a new one where value changes from the row before in order."""
    w = Window.partitionBy(*(by or [])).orderBy(order)
    before = F.lag(value).over(w)
    changed = F.when(F.row_number().over(w) == 1, 1).when(~value.eqNullSafe(before), 1).otherwise(0)
    return df.withColumn("__new", changed).withColumn(name, F.sum("__new").over(w)).drop("__new")


def banded(df: DataFrame, order: str, value: Column, by: list[str], band: float, name: str = "island") -> DataFrame:
    """islands() where one group may hold most rows: the axis, a number that is unique in a group, is sorted in bands.

    A band's rows are numbered from its first; what a band starts with comes from
    a table with one row for each band, which holds the values at its ends. A
    null key is a group; rows with a null order come first, as one band.
    """
    d = df.withColumns({"__band": F.floor(F.col(order).cast("double") / band), "__value": value})
    within = Window.partitionBy(*by, "__band").orderBy(order)
    new = F.when(F.row_number().over(within) == 1, 0).when(~F.col("__value").eqNullSafe(F.lag("__value").over(within)), 1).otherwise(0)
    d = d.withColumn("__new", new).withColumn(name, F.sum("__new").over(within))
    ends = d.groupBy(*by, "__band").agg(
        F.coalesce(F.min_by(F.struct("__value"), order), F.first(F.struct("__value"))).alias("__first"),
        F.coalesce(F.max_by(F.struct("__value"), order), F.first(F.struct("__value"))).alias("__last"),
        F.sum("__new").alias("__inside"),
    )
    across = Window.partitionBy(*by).orderBy("__band")
    starts = F.when(F.row_number().over(across) == 1, 1).when(~F.col("__first").eqNullSafe(F.lag("__last").over(across)), 1).otherwise(0)
    ends = ends.withColumn("__starts", starts).withColumn("__upto", F.sum(F.col("__starts") + F.col("__inside")).over(across))
    keys = [*by, "__band"]
    ends = ends.select(*[F.col(k).alias(f"__of_{k}") for k in keys], (F.col("__upto") - F.col("__inside")).alias("__start"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    found = d.join(ends, same).withColumn(name, F.col(name) + F.col("__start"))
    return found.drop("__value", "__new", "__start", "__band", *[f"__of_{k}" for k in keys])


def membership(points: DataFrame, at: str, member: str) -> DataFrame:
    """(at, members): the sorted set of members present at each point."""
    return points.groupBy(at).agg(F.array_sort(F.collect_set(member)).alias("members"))


def overlapping(a: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """Pairs (key, other) of half-open intervals that overlap, key < other.

    Intervals that are alike go in blocks of their keys, and blocks are dealt to
    the bins of the median length that they touch; a pair of blocks counts in the
    bin of its common start. A bin of many blocks is a grid of tasks, each with a
    share of the blocks on either side. So what is shuffled grows with the
    intervals; pairs are made last, from two blocks at hand, in runs of one key.
    """
    width = F.greatest(F.lit(1), F.expr(f"percentile_approx({high} - {low}, 0.5)"))
    w = a.agg(width.cast("bigint").alias("w"))
    own = a.where(F.col(low) < F.col(high)).select(F.col(key).alias("key"), F.col(low).alias("lo"), F.col(high).alias("hi"))
    parts = own.groupBy("lo", "hi").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    block = F.pmod(F.xxhash64("key"), F.col("parts")).alias("part")
    blocks = own.join(parts, ["lo", "hi"]).groupBy("lo", "hi", block).agg(F.sort_array(F.collect_list("key")).alias("keys"))
    blocks = graph.checkpoint(blocks).crossJoin(F.broadcast(w))  # one row
    b = blocks.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / F.col("w")), F.floor((F.col("hi") - 1) / F.col("w")))))
    cores = a.sparkSession.sparkContext.defaultParallelism
    side = math.ceil(math.sqrt(4 * cores))
    sides = b.groupBy("bin").agg(F.least(F.lit(side), F.ceil(F.count("*") / SHARE)).cast("int").alias("sides"))
    dealt = b.join(sides, "bin").withColumn("own", F.pmod(F.xxhash64("lo", "hi", "part"), F.col("sides")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    x = dealt.select("bin", "w", F.col("own").alias("i"), every.alias("j"), F.col("lo").alias("al"), F.col("hi").alias("ah"), F.col("keys").alias("a"))
    y = dealt.select("bin", every.alias("i"), F.col("own").alias("j"), F.col("lo").alias("bl"), F.col("hi").alias("bh"), F.col("keys").alias("b"))
    start = F.greatest("al", "bl")
    # By number, as adaptive execution would join tasks by the bytes of blocks, which say little about their pairs.
    cell = (8 * cores, "bin", "i", "j")
    met = x.repartition(*cell).join(y.repartition(*cell), ["bin", "i", "j"]).where((F.col("al") < F.col("bh")) & (F.col("bl") < F.col("ah")) & (F.col("bin") == F.floor(start / F.col("w"))))
    met = met.select("a", "b", start.alias("from"), F.least("ah", "bh").alias("to"))
    pairs = met.select(F.explode("a").alias(key), "b", "from", "to").select(key, F.explode("b").alias("other"), "from", "to")
    return pairs.where(F.col(key) < F.col("other")).select(key, "other", "from", "to")


def last_valid(df: DataFrame, order: str, valid: Column, by: list[str] | None = None, name: str = "reference") -> DataFrame:
    """df with the order value of the last valid row before each."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(F.when(valid, F.col(order)), ignorenulls=True).over(w))


def fill_missing(df: DataFrame, order: str, value: str, by: list[str]) -> DataFrame:
    """df with value taken from the row before, else the row after, where it is null; `filled_from` says which."""
    before, after = beside(order, value, by)
    origin = F.when(F.col(value).isNotNull(), "own").when(before.isNotNull(), "previous").when(after.isNotNull(), "next")
    return df.select(*[c for c in df.columns if c != value], F.coalesce(F.col(value), before, after).alias(value), origin.alias("filled_from"))


def beside(order: str, value: str, by: list[str]) -> tuple[Column, Column]:
    """The value of the row before and of the row after, null at the ends."""
    w = Window.partitionBy(*by).orderBy(order)
    return F.lag(value).over(w), F.lead(value).over(w)


def ordered(df: DataFrame, by: list[str], offset: Column, name: str, place: str = "place") -> DataFrame:
    """df with each dataset's place (from 1) in its group: by its offset along z, then by name."""
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*by).orderBy(offset, name)))


def first_of(df: DataFrame, by: list[str], fits: Column, at: str, value: str, order: Column) -> DataFrame:
    """(by, first, value) of the rows that fit: the least ``at``, and the value of the row that comes first by the order."""
    return df.where(fits).groupBy(*by).agg(F.min(at).alias("first"), F.min_by(value, order).alias(value))


def clipped(df: DataFrame, by: list[str], at: str, reach: int) -> DataFrame:
    """df with [lo, hi): the window around each row's place, clipped to what its group covers."""
    ends = df.groupBy(*by).agg(F.min(at).alias("__lo"), (F.max(at) + 1).alias("__hi"))
    found = df.join(ends, by).withColumns({"lo": F.greatest(F.col(at) - reach, "__lo"), "hi": F.least(F.col(at) + reach, "__hi")})
    return found.drop("__lo", "__hi")
