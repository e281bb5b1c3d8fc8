"""As-of joins by union, sort and carry: one shuffle of both sides, linear in their rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def backward(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """left with the last row of right at or before it: columns right_on and carry, null if there is none."""
    return _carry(left, right, left_on, right_on, by or [], carry or [], True)


def forward(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """left with the first row of right at or after it."""
    return _carry(left, right, left_on, right_on, by or [], carry or [], False)


def _carry(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str], carry: list[str], back: bool) -> DataFrame:
    mine = F.struct(*[F.col(c) for c in left.columns])
    theirs = F.struct(F.col(right_on).alias(right_on), *[F.col(c) for c in carry])
    key = [F.col(c) for c in by]
    a = left.select(*key, F.col(left_on).alias("__at"), F.lit(1 if back else 0).alias("__side"), mine.alias("__l"))
    b = right.where(F.col(right_on).isNotNull()).select(*key, F.col(right_on).alias("__at"), F.lit(0 if back else 1).alias("__side"), theirs.alias("__r"))
    both = a.unionByName(b, allowMissingColumns=True)
    order: list[Column] = [F.col("__at"), F.col("__side")] if back else [F.desc("__at"), F.desc("__side")]
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__f", F.last("__r", ignorenulls=True).over(w)).where(F.col("__l").isNotNull())
    return found.select("__l.*", *[F.col("__f")[c].alias(c) for c in (right_on, *carry)])


def banded(left: DataFrame, right: DataFrame, left_on: str, right_on: str, band: float, back: bool = True, by: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """As-of join for large sides, or groups that may hold most rows: bands of the axis are sorted apart.

    Each band also gets, from a table with one row a band, the nearest row of
    right in the bands before (or after) it. A null left_on finds nothing.
    """
    by, carry, join = by or [], carry or [], backward if back else forward
    cut = lambda c: F.floor(F.col(c).cast("double") / band)
    r = right.where(F.col(right_on).isNotNull()).select(*by, cut(right_on).alias("__band"), right_on, *carry)
    found = [right_on, *carry]
    edge = r.groupBy(*by, "__band").agg((F.max_by if back else F.min_by)(F.struct(*found), right_on).alias("__edge"))
    bands = left.select(*by, cut(left_on).alias("__band")).distinct()
    near = bands.select(*by, "__band", (F.col("__band") + (-1 if back else 1)).alias("__near"))
    keys = [*by, "__band"]
    outer = join(near, edge.withColumnRenamed("__band", "__of"), "__near", "__of", by=by, carry=["__edge"])
    outer = outer.select(*[F.col(k).alias(f"__of_{k}") for k in keys], "__edge")
    inner = join(left.withColumn("__band", cut(left_on)), r, left_on, right_on, by=keys, carry=carry)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    here, some = F.col(right_on).isNotNull(), F.col(left_on).isNotNull()
    values = [F.when(some, F.when(here, F.col(c)).otherwise(F.col("__edge")[c])).alias(c) for c in found]
    return inner.join(outer, same, "left").select(*left.columns, *values)
