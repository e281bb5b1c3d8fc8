"""Elastic seams, alignment at two scales and along a plan, overlap checks, and what happens after a crash."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.kernels import elastic, register, resample
from lamella.operators import progress
from lamella.operators import registration as reg
from lamella.plans import align, stitch
from lamella.sources.tiles import texture
from lamella.streaming import arrivals

IMAGES = "dataset string, z int, h int, w int, px binary"


def _bent(image, corner, shape, size=1.8):
    """A window of an image, bent smoothly by up to size pixels."""
    y, x = np.mgrid[: shape[0], : shape[1]].astype(float)
    f = np.stack([size * np.sin(y / 40), size * np.cos(y / 35)])
    wide = np.pad(image, 8, mode="reflect")
    return np.round(resample.sample(wide, y + corner[0] + 8 + f[1], x + corner[1] + 8 + f[0])).astype(np.uint8)


def test_seams_of_bent_tiles_agree():
    whole = texture((200, 360), 3, 3)
    a, b = whole[:, :200].copy(), _bent(whole, (0, 160), (200, 200))
    images, at, mesh = [a, b], [(0, 0), (0, 160)], register.Mesh(pull=1.0, spring=0.3)
    seams = elastic.Seams(32, 8)
    apart = elastic.measure(images, at, [(0, 1)], seams)
    assert np.hypot(*apart.shift).mean() > 1.3
    d, steps = elastic.relax(images, at, [(0, 1)], seams, mesh)
    assert 0 < steps < mesh.most and np.abs(d.mean(axis=(1, 2, 3))).max() < 1e-9
    _, mask, warped = elastic.render(images, at, d, 8, [(0, 0, 0, 4), (0, 0, 4, 0)], work=64)
    assert mask.mean() > 0.97
    left = register.flow(warped[0][0][:, 160:], warped[1][0][:, :40], 32, 8, 8)
    assert np.nanmean(np.hypot(left[0], left[1])) < 0.6  # under a pixel
    seam = lambda p, q: np.abs(p[20:180, 164:196].astype(int) - q[20:180, 4:36]).mean()
    assert seam(warped[0][0], warped[1][0]) < 0.4 * seam(a, b)


def test_elastic_stitching_scores_better():
    whole = texture((360, 360), 4, 3)
    tiles = {(x, y): _bent(whole, (y * 160, x * 160), (200, 200), 1.5 * (x != y)) for x in (0, 1) for y in (0, 1)}
    out, mask, score = stitch.stitch_slice(tiles, stitch.Stitch(overlap=40, patch=32, margin=4, mesh=register.Mesh(pull=1.0, spring=0.3)))
    assert mask.mean() > 0.97 and abs(out.shape[0] - 360) <= 4 and score is not None
    straight, _, _ = stitch.stitch_slice({k: whole[k[1] * 160 : k[1] * 160 + 200, k[0] * 160 : k[0] * 160 + 200] for k in tiles}, stitch.Stitch(overlap=40))
    assert straight.shape == whole.shape and (straight == whole).mean() > 0.99


def test_work_tiles_give_the_whole():
    image = texture((90, 70), 2)
    nodes = np.random.default_rng(1).normal(size=(2, 13, 10))
    assert (elastic.warp(image, nodes, 8, work=17) == elastic.warp(image, nodes, 8)).all()


def test_coarse_flow_reaches_further():
    big = texture((160, 160), 5, 4)
    moved = np.roll(big, (13, 0), (0, 1))
    p = align.Align(patch=16, stride=8, affine=False, min_ratio=1.4, max_deviation=0)
    near = align.flow_of(big, moved, align.Align(**{**p.__dict__, "coarse": 0}))
    both = align.flow_of(big, moved, p)
    hit = lambda f: (np.abs(f - np.array([0, 13])[:, None, None]).max(axis=0) < 1.5).mean()
    assert hit(near) == 0 and hit(both) > 0.3


def test_reconcile_is_the_relational_rule():
    a, b = np.full((2, 4, 4), np.nan), np.ones((2, 4, 4))
    a[:, 0, 0], a[0, 1, 1], b[:, 3, 3] = 5, 7, np.nan
    out = register.reconcile([a, b])
    assert (out[:, 0, 0] == 5).all() and (out[:, 1, 1] == 1).all() and np.isnan(out[:, 3, 3]).all()
    steep = register.reconcile([a, b], 2)
    assert np.isnan(steep[:, 0, 1]).all() and not np.isnan(steep[:, 2, 2]).any()
    few = np.full((2, 4, 4), np.nan)
    few[:, 0, :2], few[:, 2:, 2:] = 1, 1
    assert np.isnan(register.drop_small(few, 3)[:, 0]).all() and not np.isnan(register.drop_small(few, 3)[:, 2:, 2:]).any()


def test_two_nearest_in_blocks(monkeypatch):
    r = np.random.default_rng(2)
    q, t = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (r.normal(size=(37, 6)), r.normal(size=(53, 6))))
    monkeypatch.setattr(register, "MATCHED", 10)
    at, first, second = register.two_nearest(q, t)
    d = np.linalg.norm(q[:, None] - t[None], axis=2)
    order = np.sort(d, axis=1)
    assert (at == d.argmin(axis=1)).all() and np.allclose(first, order[:, 0]) and np.allclose(second, order[:, 1])


def test_masks_limit_the_features():
    image = texture((120, 120), 6, 3)
    mask = np.zeros(image.shape, bool)
    mask[:, 60:] = True
    places, _ = register.features(image, 1000, mask=mask)
    assert len(places) and (places[:, 0] >= 60).all()
    moved = np.roll(image, (4, 3), (0, 1))
    e = register.estimate(image, moved, reference_mask=mask, moving_mask=mask)
    assert e.robust and np.abs(e.matrix[:, 2] - [-3, -4]).max() < 0.5


def test_overlaps():
    big = texture((150, 200), 9, 3)
    a, b = big[:100, :120], big[30:150, 70:200]
    own, theirs = elastic.overlap(a, b, (70, 30))
    assert (own == theirs).all() and own.shape == (70, 50)
    back = elastic.overlap(b, a, (-70, -30))
    assert (back[0] == back[1]).all() and elastic.overlap(a, b, (500, 0)) is None
    wide, other = elastic.overlap(a, b, (70, 30), pad=5)
    assert wide.shape == (75, 55) and elastic.overlap(a, b, (70, 30), pad=5, same_shape=True)[0].shape == (75, 55) and other.shape == (75, 55)
    assert elastic.check_overlap(a, b, (70, 30)) == 1.0 and elastic.check_overlap(a, b, (500, 0)) == 0.0
    both = elastic.overlap_after(a, b, np.array([[1.0, 0, 70], [0, 1, 30]]))
    assert both[0].shape == both[1].shape and np.abs(both[0][2:-2, 2:-2].astype(int) - both[1][2:-2, 2:-2]).max() == 0
    assert 0 <= elastic.check_overlap(a, (b // 4).astype(np.uint8), (60, 20), threshold=1.1) <= 1


def test_plan_is_followed(spark, tmp_path):
    """Datasets with shifts of their own end up in place, each continued from the one before it, also downward."""
    base = texture((80, 80), 12, 3)
    shift = {"a": (0, 0), "b": (3, -2), "c": (-2, 3)}
    span = {"a": range(4, 7), "b": range(6, 9), "c": range(1, 5)}
    rows = []
    for name, zs in span.items():
        for z in zs:
            dx, dy = shift[name]
            own = resample.warp_affine(base, np.array([[1, 0, dx], [0, 1, dy]], float), base.shape)
            rows.append((name, z, *own.shape, own.tobytes()))
    images = spark.createDataFrame(rows, IMAGES)
    plan = {"root_stack": "a", "paths": [["a", "b"], ["a", "c"]], "reverse_order": [False, True]}
    assert align.schedule(plan) == [[("a", None, False)], [("b", "a", False), ("c", "a", True)]]
    p, where = align.Align(patch=32, stride=16), str(tmp_path / "o")
    align.run_plan(spark, images, plan, where, p)
    got = {(r.dataset, r.z): r for r in spark.read.parquet(f"{where}/aligned").collect()}
    assert set(got) == {(n, z) for n, zs in span.items() for z in zs}
    for r in got.values():
        out = np.frombuffer(r.px, np.uint8).reshape(r.h, r.w)
        assert np.abs(out[10:-10, 10:-10].astype(int) - base[10:-10, 10:-10]).mean() < 8
    assert [got["c", z].reference for z in (4, 3, 2, 1)] == [None, 4, 3, 2]
    assert align.is_done(spark, where, images)
    n = progress.read(spark, f"{where}/progress").count()
    align.run_plan(spark, images, plan, where, p)
    assert progress.read(spark, f"{where}/progress").count() == n == len(rows)


def test_crash_between_writing_and_logging(spark, tmp_path, monkeypatch):
    base = texture((48, 48), 1, 3)
    images = spark.createDataFrame([("d", z, *base.shape, base.tobytes()) for z in range(3)], IMAGES)
    p, where = align.Align(patch=16, stride=16, affine=False), str(tmp_path / "o")
    with monkeypatch.context() as m:
        m.setattr(progress, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            align.run(spark, images, where, p)
    assert not align.is_done(spark, where, images)
    align.run(spark, images, where, p)
    assert spark.read.parquet(f"{where}/aligned").count() == 3 and progress.read(spark, f"{where}/progress").count() == 3
    assert align.is_done(spark, where, images)


def test_replayed_batch_keeps_its_output(spark, tmp_path):
    """The commit of a batch is lost after it was logged: it comes again, and nothing is lost or doubled."""
    source, out, log, marks = (str(tmp_path / n) for n in ("in", "out", "log", "marks"))
    spark.createDataFrame([("d", z) for z in range(5)], "dataset string, z int").coalesce(1).write.parquet(source)

    def go():
        arrivals.process(arrivals.new_files(spark, source, "dataset string, z int"), lambda b: b, out, log, "copy", marks).awaitTermination()

    go()
    assert spark.read.parquet(out).count() == 5
    for f in (tmp_path / "marks/commits").iterdir():
        f.unlink()
    go()
    assert spark.read.parquet(out).count() == 5 and progress.read(spark, log).count() == 5


def test_fold_keeps_groups_apart(spark):
    rows = [(g, z, 1, 1, bytes([10 * z + k])) for k, g in enumerate("ab") for z in (3, 1, 2)] + [("a", 9, 1, 1, b"\0")]
    images = spark.createDataFrame(rows, "g string, z int, h int, w int, px binary")
    got = reg.fold(images, "g", lambda s, i: ((s or []) + [int(i[0, 0])], {"seen": str((s or []) + [int(i[0, 0])])}), "g string, z int, seen string", ignore=(2,))
    assert {(r.g, r.z): r.seen for r in got.collect()} == {("a", 1): "[10]", ("a", 3): "[10, 30]", ("b", 1): "[11]", ("b", 3): "[11, 31]"}


def test_rescale(spark):
    image = texture((40, 60), 3)
    images = spark.createDataFrame([(0, 40, 60, image.tobytes(), 0.5), (1, 40, 60, image.tobytes(), 1.0)], "z int, h int, w int, px binary, ratio double")
    got = {r.z: r for r in reg.rescale(images, "ratio").collect()}
    assert (got[0].h, got[0].w, got[1].h) == (20, 30, 40) and got[1].px == image.tobytes()
    assert got[0].px == resample.resample(image, 0.5).tobytes()


def test_stores_take_the_resolution_of_the_document(spark, tmp_path):
    assert stitch.geometry_of(spark, str(tmp_path))["resolution"] == [50, 10, 10]
    main = spark.createDataFrame([([30, 5, 5], [1, 2, 3])], "resolution array<int>, offset array<int>")
    main.write.json(f"{tmp_path}/config/main")
    assert stitch.geometry_of(spark, str(tmp_path)) == {"voxel_offset": [1, 2, 3], "resolution": [30, 5, 5], "offset": [30, 10, 15]}


def test_infinite_and_missing_vectors(spark):
    from lamella.operators import flow

    df = spark.createDataFrame([(1, float("nan"), 1.0), (2, float("inf"), 2.0), (3, None, float("-inf")), (4, 5.0, 6.0)], "k int, dx double, dy double")
    got = {r.k: (r.dx, r.dy) for r in flow.finite(df).collect()}
    assert got == {1: (None, 1.0), 2: (None, 2.0), 3: (None, None), 4: (5.0, 6.0)}
    assert flow.finite(df).where(F.col("dx").isNotNull()).count() == 1


def test_errors_in_optional_modules_show(monkeypatch):
    import __spark_entry__ as entry

    assert entry._optional("lamella.llm.none_such") is None

    def broken(name):
        raise ModuleNotFoundError("No module named 'xxhash'", name="xxhash")

    monkeypatch.setattr(entry, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        entry._optional("lamella.llm.queries")
