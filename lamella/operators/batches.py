"""How much a Python worker gets at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch of images, features or blocks of vectors: a few rows of them, and one that is larger.
BYTES = 1 << 20
SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small(spark: SparkSession, size: int = BYTES) -> Iterator[None]:
    """Steps that run inside hand their Python workers batches of this size; the session's setting is restored.

    Spark's own limit of 64 MB is filled as tables grow, and a worker holds a
    batch, the next and what it makes of them.
    """
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, str(size))
    try:
        yield
    finally:
        spark.conf.set(SETTING, before)
