"""Stores, sources, documents, graphs, pipelines and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.functions import geometry, names
from lamella.kernels import resample
from lamella.operators import asof, graph, islands, progress, scores
from lamella.plans import align, stitch
from lamella.sources import configs, store, tiles
from lamella.streaming import arrivals

IMAGES = "z int, h int, w int, px binary"


def _images(spark, arrays, start=0):
    return spark.createDataFrame([(start + z, *a.shape, a.tobytes()) for z, a in enumerate(arrays)], IMAGES)


def _back(row):
    return np.frombuffer(row.px, np.uint8).reshape(row.h, row.w)


def test_store_round_trip(spark, tmp_path):
    path = str(tmp_path / "s")
    arrays = [tiles.texture((70, 90), k) for k in range(3)]
    store.write_chunks(store.cut(_images(spark, arrays), 32), path, "w-")
    with pytest.raises(Exception, match="(?i)exists"):
        store.write_chunks(store.cut(_images(spark, arrays), 32), path, "w-")
    chunks = store.open_chunks(spark, path)
    for r in store.read_window(chunks, (0, 3), size=32).collect():
        assert (_back(r) == arrays[r.z]).all()
    for r in store.read_window(chunks, (-5, 2), (10, 50), (-3, 40), size=32).collect():
        assert (_back(r) == arrays[r.z][10:50, :40]).all()
    other = [tiles.texture((70, 90), 9)]
    store.write_chunks(store.cut(_images(spark, other, 1), 32), path, "r+")
    got = {r.z: _back(r) for r in store.read_window(store.open_chunks(spark, path), (0, 9), size=32).collect()}
    assert (got[0] == arrays[0]).all() and (got[1] == other[0]).all() and (got[2] == arrays[2]).all()
    assert store.extent(store.open_chunks(spark, path)).first() == (3, 70, 90, 0)
    assert store.open_chunks(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    store.write_attributes(spark, path, {"a": [1, 2]})
    store.write_attributes(spark, path, {"b": {"c": 1}})
    assert store.read_attributes(spark, path) == {"a": [1, 2], "b": {"c": 1}}
    assert store.pyramid_path("/x/proj", 4.0) == "/x/4x_proj"


def test_masked_merge_is_idempotent(spark):
    old, new = tiles.texture((40, 40), 1), tiles.texture((30, 50), 2)
    mask = new > 128
    a = store.cut(_images(spark, [old]), 32)
    b = spark.createDataFrame([(0, 30, 50, new.tobytes(), mask.tobytes(), 5, 7)], IMAGES + ", mask binary, y0 int, x0 int")
    b = store.cut(b, 32)
    once = store.merge(a, b, 32)
    want = np.zeros((40, 57), np.uint8)
    want[:, :40] = old
    want[5:35, 7:57][mask] = new[mask]
    for got in (once, store.merge(once, b, 32)):
        r = store.read_window(got, (0, 1), size=32).first()
        assert (_back(r) == want).all()
    with pytest.raises(Exception, match="negative"):
        store.cut(spark.createDataFrame([(0, 1, 1, b"a", -1, 0)], IMAGES + ", y0 int, x0 int"), 32).count()


def _write_tiles(folder, slices, name="set_a", size=64, step=48, seed=0):
    d = folder / name
    d.mkdir(parents=True)
    (d / "meta.info").write_text("header\nPixel Size: 10 10 nm\n")
    for z in slices:
        whole = tiles.texture((step + size, step + size), seed + z)
        for ty in (0, 1):
            for tx in (0, 1):
                part = whole[ty * step : ty * step + size, tx * step : tx * step + size]
                (d / f"Tile_{tx + 1:03d}-{ty + 1:03d}_s{z:04d}.tif").write_bytes(tiles.encode(part))


def test_stitch_pipeline_and_resume(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    _write_tiles(source, [0, 1])
    _write_tiles(source, [2], "set_b")
    (source / "set_c").mkdir()
    (source / "set_c/meta.info").write_text("Pixel Size: 5 5 nm")
    s = stitch.prepare(spark, str(source), (10, 10), ["set"], {"set_a": False, "set_b": False}, out).orderBy("island").collect()
    assert [(r.stack, r.z_start, r.z_end, r.combined) for r in s] == [("01_set_a", 0, 1, False), ("02_set_b", 2, 2, False)]
    p = stitch.Stitch(overlap=16)
    stitch.run(spark, out, p)
    for name, zs in (("01_set_a", (0, 1)), ("02_set_b", (2,))):
        got = {r.z: _back(r) for r in store.read_window(store.open_chunks(spark, f"{out}/{name}"), (0, 9)).collect()}
        assert set(got) == set(zs)
        for z in zs:
            assert (got[z] == tiles.texture((112, 112), z)).mean() > 0.99
    log = progress.read(spark, f"{out}/progress").count()
    stitch.run(spark, out, p)
    assert progress.read(spark, f"{out}/progress").count() == log == 3


def test_missing_invert_flag_is_an_error(spark, tmp_path):
    _write_tiles(tmp_path / "in", [0])
    with pytest.raises(Exception, match="no invert flag"):
        stitch.prepare(spark, str(tmp_path / "in"), (10, 10), ["set"], {}, str(tmp_path / "out"))


def test_unreadable_tile_is_left_out(spark):
    files = spark.createDataFrame([("a", b"junk", True), ("b", tiles.encode(tiles.texture((5, 6))), True), ("c", None, False)], "path string, content binary, invert boolean")
    got = {r.path: r for r in tiles.load(files).collect()}
    assert got["a"].px is None and got["c"].px is None and (_back(got["b"]) == 255 - tiles.texture((5, 6))).all()


def test_synthetic_source(spark):
    spark.dataSource.register(tiles.SyntheticTiles)
    df = spark.read.format("synthetic_tiles").option("slices", 2).load()
    assert df.count() == 8
    whole = stitch.stitch(df.withColumn("stack", F.lit("s")), stitch.Stitch(overlap=16)).collect()
    assert len(whole) == 2 and all(abs(r.h - 112) <= 1 for r in whole)


def test_fuse(spark):
    big = tiles.texture((120, 160), 8)
    a, b = big[:, :100].copy(), big[:, 60:].copy()
    rows = [("a", 0, *a.shape, a.tobytes(), None), ("b", 0, *b.shape, b.tobytes(), None), ("a", 1, *a.shape, bytes(a.size), None)]
    got = stitch.fuse(spark.createDataFrame(rows, "stack string, z int, h int, w int, px binary, mask binary")).collect()
    assert len(got) == 1
    out = _back(got[0])
    assert abs(out.shape[0] - 120) <= 2 and abs(out.shape[1] - 160) <= 2
    assert np.abs(out[10:110, 10:150].astype(int) - big[10:110, 10:150]).mean() < 6
    spans = spark.createDataFrame([("a", 0, 5), ("b", 5, 9), ("c", 20, 22)], "stack string, z_start int, z_end int")
    assert {r.stack: r.component for r in stitch.fuse_groups(spans).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_align_recovers_shift_and_resumes(spark, tmp_path):
    base = tiles.texture((96, 96), 11, 3)
    shifts = [(0, 0), (2, 1), (0, 0), (-1, 2), (3, -2)]
    arrays = [resample.warp_affine(base, np.array([[1, 0, dx], [0, 1, dy]], float), base.shape) for dx, dy in shifts]
    arrays[2] = np.zeros_like(base)
    images = _images(spark, arrays).withColumn("dataset", F.lit("d"))
    p = align.Align(patch=32, stride=16)
    out = {r.z: r for r in align.align(images, p).collect()}
    assert set(out) == {0, 1, 3, 4} and out[3].reference == 1
    for r in out.values():
        assert np.abs(_back(r)[12:-12, 12:-12].astype(int) - base[12:-12, 12:-12]).mean() < 8
    where = str(tmp_path / "o")
    align.run(spark, images.where("z < 2"), where, p)
    align.run(spark, images, where, p)
    again = {r.z: r for r in spark.read.parquet(f"{where}/aligned").collect()}
    assert set(again) == set(out) and all(again[z].px == out[z].px for z in out)
    with pytest.raises(ValueError):
        align.run(spark, images, where, align.Align(patch=24))


def test_plan(spark):
    d = spark.createDataFrame([("a", 0, 5), ("b", 4, 9), ("c", 8, 12), ("b_c", 8, 9)], "name string, z0 int, z1 int")
    plan = align.plan(spark, d)
    assert plan["root_stack"] == "a" and plan["_config_version"] == "1.0"
    assert [p[0] for p in plan["paths"]][0] == "a" and plan["dataset_local_bounds"]["a"] == [0, 5]
    far = spark.createDataFrame([("a", 0, 5), ("z", 50, 60)], "name string, z0 int, z1 int")
    with pytest.raises(ValueError, match="connected"):
        align.plan(spark, far, spark.createDataFrame([], "u string, v string"))


def test_config_checks(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"dataset_name": "a", "dataset_path": "p"}))
    docs = configs.load(spark, str(tmp_path / "d.json"), configs.DATASET)
    assert {r.message for r in configs.missing(docs, configs.REQUIRED["dataset"]).collect()} == {f"missing field: {f}" for f in configs.REQUIRED["dataset"][2:]}
    plan = {"root_stack": "a", "paths": [["a", "b"]], "reverse_order": [], "dataset_local_bounds": {"a": [0, 1]}}
    (tmp_path / "p.json").write_text(json.dumps(plan))
    found = configs.check_plan(configs.load(spark, str(tmp_path / "p.json"), configs.PLAN), docs).collect()
    assert {(r.level, r.item) for r in found} == {("error", "b"), ("error", "a"), ("warning", "a")}
    assert configs.merged({"mesh": {"dt": 1, "k": 2}, "x": 3}, {"mesh": {"k": 5}, "y": 1}) == {"mesh": {"dt": 1, "k": 5}, "x": 3, "y": 1}


def test_tile_maps(spark, tmp_path):
    doc = {"combined": False, "z_start": 0, "z_end": 0, "tile_maps": {"3": {"(0, 1)": "p", "(1, 1)": "q"}}, "tile_maps_invert": {"(0, 1)": True}}
    (tmp_path / "s.json").write_text(json.dumps(doc))
    got = configs.tile_maps(configs.load(spark, str(tmp_path / "s.json"), configs.STACK)).collect()
    assert {(r.z, r.tx, r.ty, r.path, r.invert) for r in got} == {(3, 0, 1, "p", True), (3, 1, 1, "q", False)}


def test_names(spark):
    df = spark.createDataFrame([("x/Tile_003-002_s0001.tif",), ("Tile_03-02_s0001.tif",), ("other.tif",)], "p string")
    got = df.select(names.tile_x(F.col("p")), names.tile_y(F.col("p")), names.tile_slice(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(2, 1, 1), (2, 1, 1), (None, None, None)]
    one = spark.range(1)
    assert one.select(names.without_suffix(F.lit("data.zarr"), ".zarr"), names.zero_filled(F.lit(123), 2), names.number_label(F.lit(0.25), 2)).first() == ("data", "123", "0_25")
    assert one.select(geometry.pad_before(F.lit(-10)), geometry.pad_after(F.lit(-10)), geometry.pad_before(F.lit(5)), geometry.pad_after(F.lit(5))).first() == (10, 0, 0, 5)
    assert one.select(geometry.similarity(F.lit(0.0), F.lit(0.0)), geometry.similarity(F.lit(4.0), F.lit(1.0))).first() == (1.0, 0.25)


@pytest.mark.parametrize(("n", "inliers", "want"), [(20, 14, 1.0), (5, 5, 0.2625), (4, 0, 0.0), (3, 1, 0.0)])
def test_robustness_matches_kernel(spark, n, inliers, want):
    rows = [("g", 0.0, i < inliers) for i in range(n)]
    r = scores.robustness(spark.createDataFrame(rows, "g string, residual double, inlier boolean"), "g").first()
    assert r["index"] == pytest.approx(want) and r["robust"] == (want >= 0.45)


def test_nearest_two_with_ties(spark, monkeypatch):
    monkeypatch.setattr(scores, "BLOCK", 7)
    r = np.random.default_rng(3)
    v = np.round(r.normal(size=(60, 3)), 1)
    v[10:40] = v[5]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vec array<double>")
    got = {x.q: (x.t1, x.t2) for x in scores.nearest_two(df, df, same=True).collect()}
    for i in range(60):
        near = sorted((float(np.sqrt(((v[i] - v[j]) ** 2).sum())), j) for j in range(60) if j != i)
        assert got[i] == (near[0][1], near[1][1])
    one = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, vec array<double>")
    assert {(x.q, x.t1, x.t2) for x in scores.nearest_two(one, one, same=True).collect()} == {(1, 2, None), (2, 1, None)}


def test_asof_edges(spark):
    left = spark.createDataFrame([(1, 5), (2, 10), (3, 0), (4, None)], "id int, t int")
    right = spark.createDataFrame([(5, "a"), (9, "b"), (None, "x")], "u int, v string")
    got = {r.id: (r.u, r.v) for r in asof.backward(left, right, "t", "u", carry=["v"]).collect()}
    assert got == {1: (5, "a"), 2: (9, "b"), 3: (None, None), 4: (None, None)}
    got = {r.id: r.u for r in asof.forward(left.where("t is not null"), right, "t", "u").collect()}
    assert got == {1: 5, 2: None, 3: 5}
    for band in (1, 3, 100):
        got = {r.id: r.u for r in asof.banded(left.where("t is not null"), right.select("u"), "t", "u", band).collect()}
        assert got == {1: 5, 2: 9, 3: None}


def test_islands_and_intervals(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (9, "a"), (10, None), (11, None), (12, "a")], "z int, v string")
    assert [r.island for r in islands.islands(df, "z", F.col("v")).orderBy("z").collect()] == [1, 1, 1, 2, 2, 3]
    spans = spark.createDataFrame([(i, i * 3, i * 3 + 1 + i % 7) for i in range(40)] + [(99, 0, 500), (98, 5, 5)], "k int, lo int, hi int")
    got = {(r.k, r.other) for r in islands.overlapping(spans, "k", "lo", "hi").collect()}
    rows = [tuple(r) for r in spans.collect()]
    assert got == {(a, b) for a, la, ha in rows for b, lb, hb in rows if a < b and la < hb and lb < ha and la < ha and lb < hb}


def test_graph(spark):
    nodes = spark.range(60).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 52), (52, 50), (55, 55)], "u long, v long")
    got = {r.node: r.component for r in graph.components(nodes, edges).collect()}
    assert got[40] == 0 and got[52] == 50 and got[55] == 55
    fork = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (2, 4), (4, 5)], "u long, v long")
    assert sorted(tuple(r.path) for r in graph.paths(fork, 0).collect()) == [(0, 1, 2), (2, 3), (2, 4, 5)]


def test_progress(spark, tmp_path):
    path = str(tmp_path / "p")
    assert progress.read(spark, path).count() == 0
    done = spark.createDataFrame([(1, 0), (2, 1)], "global_slice int, local_slice int")
    progress.append(progress.entries(done, "c", "flow"), path)
    progress.append(progress.entries(done, "c", "mesh", ["local_slice"]), path)
    log = progress.read(spark, path)
    assert log.count() == 4 and progress.wiped(log, "c", "flow").count() == 2 and progress.wiped(log, "c").count() == 0
    assert progress.pending(done.withColumn("local_slice", F.col("local_slice") + 1), log, ["local_slice"]).count() == 1


def test_streams(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    slices = spark.createDataFrame([("d", 0, "2026-01-01 00:00:00"), ("d", 1, "2026-01-01 00:10:00"), ("d", 0, "2026-01-01 00:20:00")], "dataset string, z int, t string").withColumn("t", F.to_timestamp("t"))
    slices.write.parquet(source)
    stream = arrivals.new_files(spark, source, "dataset string, z int, t timestamp")
    for _ in range(2):
        arrivals.process(arrivals.once_each(stream, ["dataset", "z"], "t"), lambda b: b.withColumn("done", F.lit(True)), out, str(tmp_path / "log"), "s", str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 2 and progress.read(spark, str(tmp_path / "log")).count() == 2
    assert arrivals.counts(slices, "t", "dataset").first().n == 3
    assert arrivals.sessions(slices, "t", "dataset", "5 minutes").count() == 3
