"""Datasets of unlike resolution in both pipelines, and the flag of an aligned store."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.kernels import resample
from lamella.operators import progress, registration
from lamella.plans import align, stitch
from lamella.sources import store
from lamella.sources.tiles import texture

IMAGES = "dataset string, z int, h int, w int, px binary, resolution double"


def _row(name, z, image, resolution):
    return name, z, *image.shape, image.tobytes(), float(resolution)


def _array(r):
    return np.frombuffer(r.px, np.uint8).reshape(r.h, r.w)


def test_a_plan_has_the_finest_resolution(spark):
    d = spark.createDataFrame([("a", 0, 5, 10), ("b", 4, 9, 20)], "name string, z0 int, z1 int, resolution int")
    assert align.plan(spark, d)["yx_target_resolution"] == [10, 10]
    assert align.plan(spark, d.drop("resolution"))["yx_target_resolution"] is None


def test_datasets_at_two_resolutions_align(spark, tmp_path):
    base = texture((96, 96), 13, 4)
    moved = resample.warp_affine(base, np.array([[1, 0, 4.0], [0, 1, -2.0]]), base.shape)
    rows = [_row("a", z, base, 10) for z in (0, 1)] + [_row("b", z, resample.resample(moved, 0.5), 20) for z in (1, 2, 3)]
    plan = {"root_stack": "a", "paths": [["a", "b"]], "reverse_order": [False], "yx_target_resolution": [10, 10]}
    where = str(tmp_path / "o")
    align.run_plan(spark, spark.createDataFrame(rows, IMAGES), plan, where, align.Align(patch=32, stride=16))
    got = {(r.dataset, r.z): _array(r) for r in spark.read.parquet(f"{where}/aligned").collect()}
    assert {k: v.shape for k, v in got.items()} == {k: base.shape for k in [("a", 0), ("a", 1), ("b", 1), ("b", 2), ("b", 3)]}
    # What coarser pixels leave of the image, where the finer ones are.
    blurred = resample.resample(resample.resample(base, 0.5), 2).astype(int)
    for z in (1, 2, 3):
        assert np.abs(got["b", z][12:-12, 12:-12] - blurred[12:-12, 12:-12]).mean() < 8
    assert store.read_attributes(spark, where)["resolution"] == [10, 10]
    with pytest.raises(Exception, match="finer"):
        registration.at_resolution(spark.createDataFrame(rows, IMAGES), 15).count()


def test_stacks_at_two_resolutions_fuse(spark):
    base = texture((96, 120), 14, 4)
    rows = [("a", 0, 96, 80, base[:, :80].tobytes(), 10.0), ("b", 0, 48, 40, resample.resample(base[:, 40:], 0.5).tobytes(), 20.0)]
    images = spark.createDataFrame(rows, "stack string, z int, h int, w int, px binary, resolution double").withColumn("mask", F.lit(None).cast("binary"))
    got = stitch.fuse(images, mesh=None, target=10).first()
    assert abs(got.w - 120) <= 1 and abs(got.h - 96) <= 1
    out = _array(got)[4:92, 4:116]
    assert np.abs(out.astype(int) - base[4:92, 4:116]).mean() < 8


def test_the_flag_comes_last(spark, tmp_path, monkeypatch):
    """A plan that breaks off after a round, or before its log, isn't done; nor is one with new slices."""
    base = texture((48, 48), 1, 3)
    rows = [_row(n, z, base, 10) for n, zs in (("a", (0, 1)), ("b", (1, 2))) for z in zs]
    images = spark.createDataFrame(rows, IMAGES).drop("resolution")
    plan = {"root_stack": "a", "paths": [["a", "b"]], "reverse_order": [False]}
    p, where = align.Align(patch=16, stride=16, affine=False), str(tmp_path / "o")
    run, seen = align.run, []

    def broken(*args, **options):
        if seen:
            raise RuntimeError("crash")
        seen.append(run(*args, **options))
        return seen[0]

    with monkeypatch.context() as m:
        m.setattr(align, "run", broken)
        with pytest.raises(RuntimeError, match="crash"):
            align.run_plan(spark, images, plan, where, p)
    assert progress.read(spark, f"{where}/progress").count() == 2 and not align.is_done(spark, where)
    align.run_plan(spark, images, plan, where, p)
    assert align.is_done(spark, where) and align.is_done(spark, where, images)
    more = images.unionByName(spark.createDataFrame([_row("b", 3, base, 10)], IMAGES).drop("resolution"))
    with monkeypatch.context() as m:
        m.setattr(progress, "append", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            align.run(spark, more, where, p)
    assert not align.is_done(spark, where)
    align.run(spark, more, where, p)
    assert align.is_done(spark, where, more)
