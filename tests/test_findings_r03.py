"""What a reviewer found in round 3, on inputs small enough for a test."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from lamella.operators import islands, scores
from lamella.plans import catalogue, graph_queries

EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def _volume(spark, folder, depths):
    """embeddings.parquet with the slices named, of 64 x 64 pixels; the tables that queries only take a session from are links."""
    rng = np.random.default_rng(1)
    rows = [(z * 64 + y, rng.uniform(-1, 1, 64).astype("f4").tolist(), 0) for z in depths for y in range(64)]
    spark.createDataFrame(rows, EMBEDDINGS).coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    (folder / "region.parquet").symlink_to("/root/testdata/sf0.001/region.parquet")


def _by_sql(name, folder, table):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    db.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    return sorted(map(tuple, db.execute(catalogue.ORACLES[name]).fetchall()))


def test_store_modes_of_a_deep_volume(spark, tmp_path):
    """slices from 1000 on stay apart from those that are appended at higher z."""
    _volume(spark, tmp_path, (0, 1, 2, 999, 1000, 1001, 1002))
    got = sorted(map(tuple, catalogue.QUERIES["store_modes"](spark, str(tmp_path)).select("z", "total").collect()))
    assert len(got) == 14
    assert got == _by_sql("store_modes", tmp_path, "embeddings")


def test_overlaps_of_one_bin_are_dealt_to_many_tasks(spark, monkeypatch):
    """intervals that all fall in one bin are met in a grid of tasks, from blocks, and each pair comes once."""
    monkeypatch.setattr(islands, "BLOCK", 4, raising=False)
    monkeypatch.setattr(islands, "SHARE", 2, raising=False)
    rows = [(k, k % 3, k % 3 + 40) for k in range(90)] + [(100, -70, 5), (101, 7, 7), (102, 39, 200), (103, None, 4), (104, 300, 301), (None, 0, 9)]
    spans = spark.createDataFrame(rows, "k int, lo long, hi long").coalesce(1)
    met = islands.overlapping(spans, "k", "lo", "hi")
    got = sorted((r.k, r.other, r["from"], r.to) for r in met.collect())
    known = [r for r in rows if None not in r and r[1] < r[2]]
    assert got == sorted((a, b, max(al, bl), min(ah, bh)) for a, al, ah in known for b, bl, bh in known if a < b and al < bh and bl < ah)
    assert met.select(F.spark_partition_id().alias("task")).distinct().count() > 4


def test_neighbours_come_in_small_batches(spark, monkeypatch):
    """a worker gets a few pairs of blocks, not as many as fill Spark's own limit; the session keeps its setting."""
    from lamella.operators import batches

    seen, write = [], scores.graph.checkpoint
    monkeypatch.setattr(scores.graph, "checkpoint", lambda df: seen.append(spark.conf.get(batches.SETTING)) or write(df))
    monkeypatch.setattr(scores, "BLOCK", 8)
    before = spark.conf.get(batches.SETTING)
    v = np.random.default_rng(2).normal(size=(50, 5))
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, vec array<double>")
    got = {r.q: (r.t1, r.t2) for r in scores.nearest_two(df, df, same=True).collect()}
    d = np.linalg.norm(v[:, None] - v[None], axis=2)
    np.fill_diagonal(d, np.inf)
    assert got == {k: tuple(d[k].argsort()[:2].tolist()) for k in range(50)}
    assert seen == [str(batches.BYTES)] and spark.conf.get(batches.SETTING) == before


def test_neighbours_of_a_query_are_found_once(spark):
    """the root and the degrees come from one search; both sides of it read the vectors once."""
    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 100")
    e = e.withColumn("embedding", F.udf(seen, "array<float>", useArrow=False)("embedding"))
    assert graph_queries.special_nodes_degree(lambda name: e).count() > 0
    assert read.value == 200


def test_two_nearest_of_a_block_are_exact():
    """single precision only proposes; ties, copies and vectors of unlike size count as by distance, and one that isn't finite takes no part."""
    v = np.random.default_rng(3).normal(size=(300, 16))
    v[40:80], v[100], v[101], v[102, 3] = v[0], v[100] * 1e9, v[101] * 1e-9, np.nan
    ids = np.arange(300)
    got = scores._two(ids, v, ids, v, True)
    want = []
    for k in np.flatnonzero(ids != 102):
        d = np.sqrt(((v[k] - v) ** 2).sum(1))
        d[k] = np.inf
        want += [(k, t, d[t]) for t in np.lexsort((ids, d))[:2]]
    assert list(got.itertuples(index=False, name=None)) == want


def test_tile_maps_are_made_in_small_batches(spark, tmp_path, monkeypatch):
    """images, features and pairs of tiles come to a worker a few at a time; the session keeps its setting."""
    from lamella.operators import batches, tilemaps

    seen, write = [], tilemaps.graph.checkpoint
    monkeypatch.setattr(tilemaps.graph, "checkpoint", lambda df: seen.append((spark.conf.get(batches.SETTING), set(df.columns))) or write(df))
    before = spark.conf.get(batches.SETTING)
    _volume(spark, tmp_path, (0, 1))
    got = catalogue.QUERIES["tile_grid_from_images"](spark, str(tmp_path))
    assert sorted(map(tuple, got.select("grp", "tileset", "ox", "oy").collect())) == _by_sql("tile_grid_from_images", tmp_path, "embeddings")
    for made in ("px", "vectors", "inliers", "dx"):  # tiles, features, matches, edges
        sizes = {size for size, columns in seen if made in columns and (made != "dx" or columns == {"u", "v", "dx", "dy"})}
        assert str(batches.BYTES) in sizes, made
    assert spark.conf.get(batches.SETTING) == before
