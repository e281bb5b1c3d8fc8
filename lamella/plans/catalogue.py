"""All queries of the engine, by name."""

from . import graph_queries, image_queries, kernel_queries, system_queries, table_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
