"""Tile maps from images: shuffled tilesets give back their grid, and the pipeline uses it."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.kernels import elastic, resample
from lamella.operators import graph, tilemaps
from lamella.plans import stitch
from lamella.sources import store, tiles

SIZE, STEP = 96, 64


def _grid(rows, columns, seed=0):
    """Tiles (y, x) of one image, each overlapping its neighbours by a third."""
    whole = tiles.texture(((rows - 1) * STEP + SIZE, (columns - 1) * STEP + SIZE), seed, 3)
    return whole, {(y, x): whole[y * STEP : y * STEP + SIZE, x * STEP : x * STEP + SIZE] for y in range(rows) for x in range(columns)}


def _frame(spark, rows):
    return spark.createDataFrame([(g, n, t, x, y, *i.shape, i.tobytes()) if i is not None else (g, n, t, x, y, None, None, None) for g, n, t, x, y, i in rows], "grp string, node string, tileset string, tx int, ty int, h int, w int, px binary")


def test_shuffled_tiles_give_back_their_grid(spark):
    """Each tile a tileset of its own, in random order; another group at once, and one tile of elsewhere."""
    rows, want = [], {}
    for group, shape in (("g", (3, 3)), ("h", (1, 3))):
        _, parts = _grid(*shape, seed=len(group) + shape[0])
        keys = sorted(parts)
        random.Random(2).shuffle(keys)
        for k, at in enumerate(keys):
            rows.append((group, f"{group}{k}", f"set{k}", 0, 0, parts[at]))
            want[group, f"set{k}"] = (at[1], at[0])
    rows.append(("g", "other", "other", 0, 0, tiles.texture((SIZE, SIZE), 99, 3)))
    rows.append(("h", "lost", "lost", 0, 0, None))
    got = tilemaps.grids(_frame(spark, rows).repartition(3)).collect()
    assert {(r.grp, r.tileset): (r.ox, r.oy) for r in got if (r.grp, r.tileset) in want} == want
    assert len({r.component for r in got if r.grp == "g" and r.tileset != "other"}) == 1 and len({r.component for r in got}) == 4


def test_tilesets_of_several_tiles(spark):
    """Two tilesets whose own numbers start anywhere: their tiles' matches agree on one relation."""
    _, parts = _grid(2, 4, seed=5)
    rows = [("g", f"l{y}{x}", "left", x + 3, y + 1, parts[y, x]) for y in (0, 1) for x in (0, 1)]
    rows += [("g", f"r{y}{x}", "right", x, y, parts[y, x + 2]) for y in (0, 1) for x in (0, 1)]
    got = {r.tileset: (r.ox, r.oy) for r in tilemaps.grids(_frame(spark, rows)).collect()}
    # The right one's tile (0, 0) stands at (2, 0) of the left one's (3, 1).
    assert (got["right"][0] - got["left"][0], got["right"][1] - got["left"][1]) == (5, 1)


def test_the_ladder_goes_on_and_turned_tiles_are_left_out(spark):
    whole, parts = _grid(1, 2, seed=8)
    turned = resample.rotate(whole, 12)[40 : 40 + SIZE, 40 : 40 + SIZE]
    rows = [("g", "a", "a", 0, 0, parts[0, 0]), ("g", "b", "b", 0, 0, parts[0, 1]), ("g", "c", "c", 0, 0, turned)]
    frame = _frame(spark, rows)
    # At a tenth nothing is left to match, so the next scale finds it.
    found = {(r.u, r.v): r for r in tilemaps.estimated(frame, (0.1, 1.0)).collect()}
    assert set(found) == {("a", "b")} and abs(found["a", "b"].dx - STEP) < 1 and abs(found["a", "b"].dy) < 1
    assert found["a", "b"].score > 0.95 and tilemaps.estimated(frame, (0.1,)).count() == 0
    assert any({r.u, r.v} & {"c"} for r in tilemaps.estimated(frame, (1.0,), rotation=30.0).collect())


def test_overlap_score_is_refined():
    """A place that is off by some pixels is registered once more; images that don't meet score 0."""
    _, parts = _grid(1, 2, seed=3)
    a, b = parts[0, 0], parts[0, 1]
    assert elastic.check_overlap(a, b, (STEP, 0)) > 0.99
    assert elastic.check_overlap(a, b, (STEP + 7, 5), threshold=1.0, scales=(1.0,)) > 0.9
    assert elastic.check_overlap(a, b, (500, 0)) == 0


def test_placed(spark):
    nodes = spark.createDataFrame([(c,) for c in "abcde"], "node string")
    edges = spark.createDataFrame([("a", "b", 5, -1), ("c", "b", 2, 2)], "u string, v string, dx long, dy long")
    got = {r.node: (r.component, r.tx, r.ty) for r in graph.placed(nodes, edges).collect()}
    assert got == {"a": ("a", 0, 3), "b": ("a", 5, 2), "c": ("a", 3, 0), "d": ("d", 0, 0), "e": ("e", 0, 0)}


@pytest.mark.parametrize("apart", [False, True])
def test_combined_stacks_are_stitched(spark, tmp_path, apart):
    """Two tilesets side by side, with the same tile numbers: one stack of one grid; or two stacks if they show unlike places."""
    for name, columns in (("set_a", (0, 1)), ("set_b", (2, 3))):
        d = tmp_path / "in" / name
        d.mkdir(parents=True)
        (d / "meta.info").write_text("Pixel Size: 10 10 nm\n")
        for z in (0, 1):
            _, parts = _grid(2, 4, seed=20 + z + 50 * (apart and name == "set_b"))
            for ty in (0, 1):
                for tx, column in enumerate(columns):
                    (d / f"Tile_{tx + 1:03d}-{ty + 1:03d}_s{z:04d}.tif").write_bytes(tiles.encode(parts[ty, column]))
    out = str(tmp_path / "out")
    s = stitch.prepare(spark, str(tmp_path / "in"), (10, 10), ["set"], {"set_a": False, "set_b": False}, out).orderBy("stack").collect()
    want = [("01_set_a", False), ("01_set_b", False)] if apart else [("01_set_a_set_b", True)]
    assert [(r.stack, r.combined) for r in s] == want and {(r.island, r.z_start, r.z_end) for r in s} == {(1, 0, 1)}
    docs = [json.loads(x.value) for x in spark.read.text(f"{out}/config/stacks").collect()]
    width = 2 if apart else 4
    assert all(set(m) == {f"({x}, {y})" for x in range(width) for y in (0, 1)} for d in docs for m in d["tile_maps"].values())
    if not apart:
        stitch.run(spark, out, stitch.Stitch(overlap=SIZE - STEP))
        for r in store.read_window(store.open_chunks(spark, f"{out}/01_set_a_set_b"), (0, 9)).collect():
            whole, _ = _grid(2, 4, seed=20 + r.z)
            got = np.frombuffer(r.px, np.uint8).reshape(r.h, r.w)
            assert got.shape == whole.shape and (got == whole).mean() > 0.99
    assert spark.read.text(f"{out}/config/stacks").select(F.count("*")).first()[0] == len(want)
