"""Kernels against known deformations, and fixed cases of the rules."""

import numpy as np
import pytest

from lamella.kernels import masks, register, resample
from lamella.sources.tiles import decode, encode, texture


def test_translation_and_flow():
    big = texture((160, 160), 1)
    a, b = big[20:120, 20:120], big[23:123, 16:116]  # b(x - (-4), y - 3): a(x) = b(x + (4, -3))
    f = register.flow(a, b, 40, 20, 10)
    assert np.nanmedian(f[0]) == pytest.approx(4, abs=0.3) and np.nanmedian(f[1]) == pytest.approx(-3, abs=0.3)


def test_flow_of_smooth_warp():
    big = texture((128, 128), 2, 3)
    y, x = np.mgrid[:128, :128].astype(float)
    field = np.stack([2 * np.sin(y / 30), 2 * np.cos(x / 30)])
    moved = resample.warp(big, field)  # moved(x) = big(x + field)
    f = register.flow(moved, big, 32, 16, 6)
    centre = np.arange(f.shape[1]) * 16 + 16
    want = field[:, centre][:, :, centre]
    d = register.clean(f, 1.1, 1.0)
    assert np.nanmedian(np.abs(d - want)) < 0.5


@pytest.mark.parametrize("angle", [0.0, 4.0, -7.0])
def test_similarity(angle):
    big = texture((200, 200), 3)
    a = np.deg2rad(angle)
    m = np.array([[np.cos(a), -np.sin(a), 5.0], [np.sin(a), np.cos(a), -3.0]])
    moved = resample.warp_affine(big, m, (200, 200))
    e = register.estimate(moved, big)
    assert e.robust and np.abs(e.matrix[:, :2] - m[:, :2]).max() < 0.01 and np.abs(e.matrix[:, 2] - m[:, 2]).max() < 0.7


def test_unmatched_images_are_not_robust():
    e = register.estimate(texture((120, 120), 4), texture((120, 120), 5))
    assert not e.robust


def test_relax_constant_and_energy():
    target = np.full((2, 6, 7), 2.5)
    d, _ = register.relax(target)
    assert np.abs(d - 2.5).max() < 0.05
    r = np.random.default_rng(0)
    target = r.normal(size=(2, 8, 8))
    target[:, 3, 3] = np.nan
    d, n = register.relax(target)
    m = register.Mesh()
    assert n < m.most and register.energy(d, target, m) <= register.energy(np.zeros_like(d), target, m)
    assert np.abs(register.forces(d, target, m)).max() < 2e-3


def test_invert_and_compose():
    y, x = np.mgrid[:40, :40].astype(float)
    f = np.stack([1.5 * np.sin(y / 8), np.cos(x / 9)])
    back = resample.compose(resample.invert(f), f)
    assert np.abs(back[:, 5:-5, 5:-5]).max() < 0.1


def test_resample():
    image = texture((20, 30))
    assert resample.resample(image, 1) is image and resample.resample(image, 0.5).shape == (10, 15)
    half = resample.resample(image.astype(float), 0.5)
    assert half == pytest.approx(image.reshape(10, 2, 15, 2).mean(axis=(1, 3)))
    assert resample.resample(image > 100, 0.5).dtype == bool
    with pytest.raises(ValueError):
        resample.resample(image, 0)
    assert resample.rotate(image, 90).shape == (30, 20) and (resample.rotate(image, 0) == image).all()


def test_canvas_has_no_negative_places():
    m, shape, offset = resample.canvas(np.array([[0, -1, 0.0], [1, 0, 0]]), (10, 20))
    assert shape == (20, 10) and offset == (10, 0) and m[0, 2] == 10


def test_masks():
    m = np.zeros((20, 20), bool)
    m[2:12, 2:12] = True
    m[5:8, 5:8] = False
    m[15:17, 15:17] = True
    numbers, n = masks.label(m)
    assert n == 2 and (masks.largest(m)[15:17, 15:17] == 0).all()
    assert masks.fill_holes(masks.largest(m))[2:12, 2:12].all()
    found = masks.foreground(np.where(m, 200, 10).astype(np.uint8), 100)
    assert found[6, 6] and not found[16, 16]
    snake = np.zeros((9, 9), bool)
    snake[::2] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    assert masks.label(snake)[1] == 1
    assert not masks.foreground(np.zeros((5, 5), np.uint8)).any()


def test_processing_chain():
    image = texture((40, 40))
    assert (masks.process(image, {"gaussian": {}, "invert": {}}) == masks.gaussian(255 - image)).all()
    with pytest.raises(KeyError):
        masks.process(image, {"nothing": {}})
    flat = np.full((40, 40), 100, np.uint8)
    assert masks.adaptive_equalize(flat).std() == 0 and masks.adaptive_equalize(image).std() > 0
    assert masks.equalize(image).max() == 255 and (masks.gaussian(flat) == 100).all()


@pytest.mark.parametrize(("n", "residuals", "want"), [(0, [], 0), (5, [], 0), (20, [0.0] * 14, 1.0), (5, [0.0] * 5, 0.2625), (3, [1.0], 0)])
def test_robustness_goldens(n, residuals, want):
    assert register.robustness(n, np.array(residuals)) == pytest.approx(want)


def test_tiff_round_trip():
    image = texture((7, 9))
    assert (decode(encode(image)) == image).all()
    with pytest.raises(ValueError):
        decode(b"nothing at all")


def test_place_tiles():
    big = texture((112, 112), 6)
    tiles = {(x, y): big[y * 46 : y * 46 + 64, x * 47 : x * 47 + 64] for x in (0, 1) for y in (0, 1)}
    offsets = register.coarse_offsets(tiles, 20, 8)
    at = register.place({k: v.shape for k, v in tiles.items()}, offsets, 20)
    assert at[1, 1] == pytest.approx((47, 46), abs=0.5)
