"""Flow and warp by work tiles against the kernels on whole slices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.kernels import elastic, register, resample
from lamella.operators import registration, worktiles
from lamella.plans import align
from lamella.sources import store
from lamella.sources.tiles import texture

IMAGES = "z int, h int, w int, px binary"


def _chunks(spark, arrays, size):
    rows = [(z, *a.shape, a.tobytes()) for z, a in arrays.items()]
    return store.cut(spark.createDataFrame(rows, IMAGES), size)


def _field(rows, z, names):
    rows = [r for r in rows if r.z == z]
    out = np.full((len(names), max(r.gy for r in rows) + 1, max(r.gx for r in rows) + 1), np.nan)
    for r in rows:
        out[:, r.gy, r.gx] = [np.nan if r[n] is None else r[n] for n in names]
    return out


def _image(rows, z, column="px", kind=np.uint8):
    rows = [r for r in rows if r.z == z]
    out = np.zeros((max(r.y0 + r.h for r in rows), max(r.x0 + r.w for r in rows)), kind)
    for r in rows:
        out[r.y0 : r.y0 + r.h, r.x0 : r.x0 + r.w] = np.frombuffer(r[column], kind).reshape(r.h, r.w)
    return out


@pytest.mark.parametrize(("chunk", "size", "before", "after"), [(20, 32, 5, 9), (50, 16, 40, 0), (64, 200, 3, 3)])
def test_windows(spark, chunk, size, before, after):
    a = {0: texture((70, 90)), 3: texture((33, 41), 1)}
    got = worktiles.windows(_chunks(spark, a, chunk), size, before, after).collect()
    assert {(r.z, r.ty, r.tx) for r in got} == {(z, y, x) for z, i in a.items() for y in range(-(-i.shape[0] // size)) for x in range(-(-i.shape[1] // size))}
    for r in got:
        y, x = max(0, r.ty * size - before), max(0, r.tx * size - before)
        want = a[r.z][y : (r.ty + 1) * size + after, x : (r.tx + 1) * size + after]
        assert (r.y0, r.x0, r.height, r.width) == (y, x, *a[r.z].shape)
        assert (np.frombuffer(r.px, np.uint8).reshape(r.h, r.w) == want).all()


@pytest.mark.parametrize(("chunk", "size", "patch", "stride"), [(40, 48, 32, 16), (64, 50, 24, 10), (30, 17, 32, 20)])
def test_flow_is_that_of_the_whole(spark, chunk, size, patch, stride):
    big = texture((150, 170), 3, 3)
    a, b = {1: big[5:125, 5:145], 2: big[:120, :140]}, {1: big[2:122, 9:149], 2: big[3:133, 1:131], 9: big[:40, :40]}
    a[2] = np.where(np.arange(140) < 60, 0, a[2]).astype(np.uint8)
    got = worktiles.flow(_chunks(spark, a, chunk), _chunks(spark, b, chunk + 7), patch, stride, 8, size).collect()
    assert {r.z for r in got} == {1, 2}
    for z in (1, 2):
        h, w = (min(m, n) for m, n in zip(a[z].shape, b[z].shape, strict=True))
        p, q = a[z][:h, :w], b[z][:h, :w]
        want = register.flow(p, q, patch, stride, 8, p > 0, q > 0)
        assert len([r for r in got if r.z == z]) == want[0].size
        assert np.allclose(_field(got, z, ("dx", "dy", "sharp", "ratio")), want, equal_nan=True)


@pytest.mark.parametrize(("chunk", "size", "stride", "first"), [(40, 32, 16, 8.0), (64, 50, 7, 0.0), (200, 33, 20, 12.5)])
def test_warp_is_that_of_the_whole(spark, chunk, size, stride, first):
    r = np.random.default_rng(5)
    a = {0: texture((101, 127), 4), 1: texture((60, 64), 5), 2: texture((30, 30), 6)}
    fields = {}
    for z in (0, 1):
        n = [int((m - first) // stride) + z for m in a[z].shape]
        fields[z] = r.normal(0, 4, (2, *n))
    fields[0][:, 2, 1] = np.nan
    rows = registration.field_rows
    table = spark.createDataFrame([tuple(None if v is None else v.item() if hasattr(v, "item") else v for v in x) for z, f in fields.items() for x in rows(z, f).itertuples(index=False)], "z int, gy int, gx int, dx double, dy double")
    got = worktiles.warp(_chunks(spark, a, chunk), table, stride, size, first).collect()
    for z in a:
        want = elastic.warp(a[z], fields[z], stride, first=first) if z in fields else a[z]
        have = elastic.warp(np.ones(a[z].shape, bool), fields[z], stride, first=first) if z in fields else np.ones(a[z].shape, bool)
        assert (_image(got, z) == want).mean() > 0.9999 and np.abs(_image(got, z).astype(int) - want).max() <= 1
        assert (_image(got, z, "mask", bool) == have).all()
        assert max(x.h for x in got) <= size and max(x.w for x in got) <= size


def _files(path):
    return {f.name for f in path.glob("**/*.parquet")}


def test_large_slices_align_and_resume(spark, tmp_path):
    """Slices end up on the first, an empty one is passed over; a second run adds only what is new, with the same result as one run."""
    base = texture((120, 140), 11, 3)
    shifts = {0: (0, 0), 1: (2, 1), 3: (4, -1), 4: (1, 3), 5: (-3, 5)}
    arrays = {z: resample.warp_affine(base, np.array([[1, 0, dx], [0, 1, dy]], float), base.shape) for z, (dx, dy) in shifts.items()} | {2: np.zeros_like(base)}
    source, out, once = (str(tmp_path / n) for n in ("in", "out", "once"))
    chunks = _chunks(spark, arrays, 64)
    store.write_chunks(chunks.where("z < 4"), source, "r+")
    p = align.Align(patch=32, stride=16, affine=False)
    align.run_large(spark, source, out, p, size=50)
    first = _files(tmp_path / "out/chunks")
    assert {r.z for r in store.open_chunks(spark, out).select("z").distinct().collect()} == {0, 1, 3}
    store.write_chunks(chunks.where("z >= 4"), source, "a")
    align.run_large(spark, source, out, p, size=50)
    assert first < _files(tmp_path / "out/chunks")
    align.run_large(spark, source, once, p, size=50)
    got = store.open_chunks(spark, out).collect()
    assert {r.z for r in got} == set(shifts) and max(r.h for r in got) == max(r.w for r in got) == 50
    whole = store.open_chunks(spark, once).collect()
    for z in shifts:
        assert (_image(got, z) == _image(whole, z)).all()
        assert np.abs(_image(got, z)[20:-20, 20:-20].astype(int) - base[20:-20, 20:-20]).mean() < 8
    with pytest.raises(ValueError, match="similarity"):
        align.run_large(spark, source, out, align.Align())


def test_stages_are_kept_by_their_parameters(spark, tmp_path, monkeypatch):
    """Another mesh makes meshes and slices anew, not the flow; another patch makes all; nothing new makes nothing."""
    base = texture((80, 80), 3, 3)
    arrays = {z: np.roll(base, z, 1) for z in range(3)}
    source, out = str(tmp_path / "in"), tmp_path / "out"
    store.write_chunks(_chunks(spark, arrays, 64), source, "r+")
    made = []
    for name in ("flow", "meshes", "warp"):
        f = getattr(worktiles, name)
        monkeypatch.setattr(worktiles, name, lambda *a, f=f, name=name, **k: made.append(name) or f(*a, **k))

    def run(**options):
        made.clear()
        align.run_large(spark, source, str(out), align.Align(**{"patch": 32, "stride": 16, "affine": False} | options), size=64)
        return list(made)

    assert run() == ["flow", "meshes", "warp"] and run() == []
    stiff = register.Mesh(most=100_000, spring=3.0)
    assert run(mesh=stiff) == ["meshes", "warp"] and run(mesh=stiff) == []
    assert run(min_ratio=1.3) == ["meshes", "warp"]
    assert run() == ["warp"]  # both stages are there, the slices were made with another mesh
    assert run(patch=24) == ["flow", "meshes", "warp"]
    # A run that breaks off while it renders is taken up there.
    with monkeypatch.context() as m:
        m.setattr(store, "write_chunks", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(stride=20)
    assert run(stride=20) == ["warp"]
    store.write_chunks(_chunks(spark, {-1: base}, 64), source, "a")
    with pytest.raises(ValueError, match="before those"):
        run()


def test_content_of_images(spark):
    cases = {b"": False, b"\0": False, b"\0" * 5000: False, b"\0\0\1\0": True, b"\xff\xfe": True, b"\0" * 100 + b"\x80" + b"\0" * 100: True, b" \t": True}
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(cases)], "i int, px binary")
    got = rows.select("i", registration.has_content(F.col("px")).alias("any")).collect()
    assert {r.i: r["any"] for r in got} == dict(enumerate(cases.values()))
