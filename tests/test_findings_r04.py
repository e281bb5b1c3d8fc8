"""What the findings of round 4 were about, on small tables."""

import numpy as np
from pyspark.sql import functions as F

from lamella.llm import jaccard
from lamella.operators import batches


def test_sets_reach_python_in_small_pieces(spark, monkeypatch):
    """chunks of about 1 MB in batches of 4 MB, however many texts there are; the session's setting is restored."""
    rng, found, real = np.random.default_rng(4), [], jaccard.partnered

    def partnered(chunks, *args):
        found.append((chunks.agg(F.max(F.length("raw"))).first()[0], int(spark.conf.get(batches.SETTING))))
        return real(chunks, *args)

    monkeypatch.setattr(jaccard, "partnered", partnered)
    texts = [" ".join(map(str, rng.integers(0, 1 << 30, 20_000))) for _ in range(12)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, texts[3]])], "doc_id long, text string").coalesce(1)
    got = {r.id: r.component_id for r in jaccard.near_sets(docs).collect()}
    assert got == {k: k for k in range(12)} | {12: 3}
    assert found[0][0] <= 1 << 20 and found[0][1] <= 4 << 20
    assert int(spark.conf.get(batches.SETTING)) == 16 << 20
