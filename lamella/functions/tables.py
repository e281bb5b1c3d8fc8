"""Table functions."""

from __future__ import annotations

from pyspark.sql.functions import udtf


@udtf(returnType="x int, v int")
class ExplodePixels:
    """The pixels of a line given as an array, background left out: SELECT * FROM ..., LATERAL explode_pixels(px)."""

    def eval(self, px: list[int]):
        for x, v in enumerate(px or ()):
            if v:
                yield x, v


def register(spark) -> None:
    """Make explode_pixels known to SQL."""
    spark.udtf.register("explode_pixels", ExplodePixels)
