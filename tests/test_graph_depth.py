"""Walks over graphs that are deeper than any fixed number of rounds."""

import pytest

from lamella.operators import graph


def test_rounds_that_run_out_are_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1, 1, 0) for i in range(6)], "u long, v long, dx long, dy long")
    near = graph.both_ways(chain)
    for walk in (lambda: graph.positions(chain, 0, 3), lambda: graph.levels(near, 0, 3), lambda: graph.paths(chain, 0, 3)):
        with pytest.raises(RuntimeError, match="not done"):
            walk()
