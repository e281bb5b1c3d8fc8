"""Resampling of arrays: bilinear and nearest, affine and along a displacement field.

Invalid values are NaN inside the kernels and become null at the table's edge.
Places outside an image read as 0.
"""

from __future__ import annotations

import numpy as np


def sample(image: np.ndarray, y: np.ndarray, x: np.ndarray, fill: float = 0.0) -> np.ndarray:
    """Bilinear values at real places; a place more than half a pixel outside gives fill."""
    h, w = image.shape
    inside = (y >= -0.5) & (y <= h - 0.5) & (x >= -0.5) & (x <= w - 0.5)
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = y - y0, x - x0
    image = image.astype(float)
    top = image[y0, x0] * (1 - fx) + image[y0, x1] * fx
    low = image[y1, x0] * (1 - fx) + image[y1, x1] * fx
    return np.where(inside, top * (1 - fy) + low * fy, fill)


def resample(image: np.ndarray, ratio: float) -> np.ndarray:
    """Scaled by ratio with pixel centres kept; a mask stays a mask; ratio 1 gives the image itself."""
    if ratio <= 0:
        raise ValueError(f"ratio must be positive: {ratio}")
    if ratio == 1:
        return image
    h, w = (max(1, round(n * ratio)) for n in image.shape)
    y, x = (np.arange(h) + 0.5) * image.shape[0] / h - 0.5, (np.arange(w) + 0.5) * image.shape[1] / w - 0.5
    out = sample(image, *np.meshgrid(y, x, indexing="ij"))
    if image.dtype == bool:
        return out >= 0.5
    return np.round(out).astype(image.dtype) if np.issubdtype(image.dtype, np.integer) else out.astype(image.dtype)


def warp_affine(image: np.ndarray, matrix: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The image moved by a 2 x 3 matrix (x, y order) onto a canvas of the given shape."""
    full = np.vstack([matrix, [0, 0, 1]])
    back = np.linalg.inv(full)
    y, x = np.mgrid[: shape[0], : shape[1]].astype(float)
    out = sample(image, back[1, 0] * x + back[1, 1] * y + back[1, 2], back[0, 0] * x + back[0, 1] * y + back[0, 2])
    return out >= 0.5 if image.dtype == bool else np.round(out).astype(image.dtype) if np.issubdtype(image.dtype, np.integer) else out


def rotate(image: np.ndarray, degrees: float) -> np.ndarray:
    """Rotated counter-clockwise about the centre on a canvas that holds all of it."""
    h, w = image.shape
    a = np.deg2rad(degrees)
    c, s = np.cos(a), np.sin(a)
    height, width = int(h * abs(c) + w * abs(s) + 1e-9), int(h * abs(s) + w * abs(c) + 1e-9)
    m = np.array([[c, s, 0.0], [-s, c, 0.0]])
    m[:, 2] = np.array([(width - 1) / 2, (height - 1) / 2]) - m[:, :2] @ np.array([(w - 1) / 2, (h - 1) / 2])
    return warp_affine(image, m, (height, width))


def canvas(matrix: np.ndarray, shape: tuple[int, int]) -> tuple[np.ndarray, tuple[int, int], tuple[int, int]]:
    """Matrix without negative places, the canvas's shape, and the (x, y) the reference has moved by."""
    h, w = shape
    corners = matrix[:, :2] @ np.array([[0, w, 0, w], [0, 0, h, h]]) + matrix[:, 2:]
    low = np.minimum(np.floor(corners.min(axis=1)), 0).astype(int)
    high = np.ceil(corners.max(axis=1)).astype(int)
    moved = matrix.copy()
    moved[:, 2] -= low
    return moved, (int(high[1] - low[1]), int(high[0] - low[0])), (int(-low[0]), int(-low[1]))


def upsample_field(field: np.ndarray, shape: tuple[int, int], scale: float) -> np.ndarray:
    """A coarse field (2, h, w) on a finer grid: places and values grow by 1 / scale."""
    y = np.linspace(0, field.shape[1] - 1, shape[0])
    x = np.linspace(0, field.shape[2] - 1, shape[1])
    at = np.meshgrid(y, x, indexing="ij")
    return np.stack([sample(c, *at) for c in field]) / scale


def compose(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The field x -> then(x) + first(x + then(x)); fields are (2, h, w) as dx, dy; the border carries on."""
    h, w = then.shape[1:]
    y, x = np.mgrid[:h, :w].astype(float)
    at = np.clip(y + then[1], 0, h - 1), np.clip(x + then[0], 0, w - 1)
    return then + np.stack([sample(c, *at) for c in first])


def invert(field: np.ndarray, rounds: int = 40, least: float = 1e-3) -> np.ndarray:
    """The field that undoes a smooth one, by fixed-point iteration."""
    h, w = field.shape[1:]
    y, x = np.mgrid[:h, :w].astype(float)
    out = -field.copy()
    for _ in range(rounds):
        at = np.clip(y + out[1], 0, h - 1), np.clip(x + out[0], 0, w - 1)
        new = -np.stack([sample(c, *at) for c in field])
        done = np.abs(new - out).max() < least
        out = new
        if done:
            break
    return out


def warp(image: np.ndarray, field: np.ndarray) -> np.ndarray:
    """The image seen through a field of full size: out(x) = image(x + field(x)), 0 outside and where the field is NaN."""
    y, x = np.mgrid[: image.shape[0], : image.shape[1]].astype(float)
    bad = np.isnan(field).any(axis=0)
    f = np.where(bad, 0, field)
    out = np.where(bad, 0, sample(image, y + f[1], x + f[0]))
    return out >= 0.5 if image.dtype == bool else np.round(out).astype(image.dtype) if np.issubdtype(image.dtype, np.integer) else out
