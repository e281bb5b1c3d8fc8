"""The catalogue: each query is a function of a table reader, with the same query for DuckDB if SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The pixel volume in DuckDB: a slice has 64 vectors as rows, a vector's components are its columns.
VOLUME = """V AS (
    SELECT (vec_id // 64)::INT AS z, (vec_id % 64)::INT AS y, x::INT AS x, floor((embedding[x + 1]::DOUBLE + 1) * 127.5)::INT AS v
    FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS x FROM embeddings)
)"""


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name; "{V}" in sql stands for the volume."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql.replace("{V}", VOLUME)
        return f

    return add
