"""Elastic seams: tiles of one slice, or two overlapping images, deformed until they agree where they overlap.

Each tile has a mesh of nodes ``stride`` pixels apart; a node's displacement says
where on the canvas its content goes, beyond the tile's place. Correlation flow
over each seam tells for nodes of one tile where their content lies in the other;
a node is pulled to where its neighbour has moved that content, and springs hold
a tile together. All tiles relax at once, the targets being made anew from the
neighbours' meshes at every step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from . import masks, register, resample

Key = tuple[int, int]


@dataclass(frozen=True)
class Seams:
    """How seams are measured: patches and their distance, pixels searched, and what makes a vector trusted."""

    patch: int = 16
    stride: int = 8
    most: int | None = None
    min_ratio: float = 1.1
    min_sharp: float = 1.0
    max_deviation: float = 5.0
    min_patch: int = 2


def trusted_flow(reference: np.ndarray, moving: np.ndarray, s: Seams, reference_mask: np.ndarray | None = None, moving_mask: np.ndarray | None = None) -> np.ndarray:
    """(2, gy, gx) between two images of one shape; NaN where it isn't trusted or a connected part is small."""
    patch = min(s.patch, *reference.shape)
    raw = register.flow(reference, moving, patch, s.stride, patch // 2 if s.most is None else s.most, reference_mask, moving_mask)
    return register.drop_small(register.clean(raw, s.min_ratio, s.min_sharp, 0, s.max_deviation), s.min_patch)


def nodes_of(shape: tuple[int, int], stride: int) -> tuple[int, int]:
    """Nodes of a tile: at 0, stride, ... up to the first at or beyond its last pixel."""
    return tuple(-(-(n - 1) // stride) + 1 for n in shape)


@dataclass
class Pulls:
    """Nodes (tile, gy, gx) and what they are pulled to: the displacement of another tile at (other, y, x) in nodes, plus (dx, dy)."""

    node: np.ndarray  # 3 x n
    other: np.ndarray
    at: np.ndarray  # 2 x n
    shift: np.ndarray  # 2 x n

    def targets(self, d: np.ndarray) -> np.ndarray:
        """(2, tiles, gy, gx): the mean of a node's pulls; NaN where there is none."""
        top = np.array(d.shape[2:])[:, None] - 1
        at = np.clip(self.at, 0, top)
        low = np.minimum(np.floor(at).astype(int), np.maximum(top - 1, 0))
        f, high = at - low, np.minimum(low + 1, top)
        corner = lambda y, x: d[:, self.other, y, x]
        moved = (corner(low[0], low[1]) * (1 - f[1]) + corner(low[0], high[1]) * f[1]) * (1 - f[0]) + (corner(high[0], low[1]) * (1 - f[1]) + corner(high[0], high[1]) * f[1]) * f[0]
        total, n = np.zeros(d.shape), np.zeros(d.shape[1:])
        for c in (0, 1):
            np.add.at(total[c], tuple(self.node), moved[c] + self.shift[c])
        np.add.at(n, tuple(self.node), 1)
        return np.where(n > 0, total / np.maximum(n, 1), np.nan)


def measure(images: list[np.ndarray], at: list[tuple[int, int]], pairs: list[tuple[int, int]], s: Seams) -> Pulls:
    """Pulls over the seams of images at places (y, x), measured both ways for each pair."""
    node, other, places, shifts = [], [], [], []
    for a, b in [*pairs, *[(b, a) for a, b in pairs]]:
        (ya, xa), (yb, xb) = at[a], at[b]
        y0, x0 = max(ya, yb), max(xa, xb)
        y1, x1 = (min(at[a][k] + images[a].shape[k], at[b][k] + images[b].shape[k]) for k in (0, 1))
        # The crop starts on a node of a, so that patch centres fall on its nodes.
        half = min(s.patch, y1 - y0, x1 - x0) // 2
        y0, x0 = (o + -(-(v - o + half) // s.stride) * s.stride - half for v, o in ((y0, ya), (x0, xa)))
        if min(y1 - y0, x1 - x0) < 2 * half or half < 2:
            continue
        own, theirs = (images[k][y0 - y : y1 - y, x0 - x : x1 - x] for k, (y, x) in ((a, at[a]), (b, at[b])))
        f = trusted_flow(own, theirs, Seams(2 * half, s.stride, s.most, s.min_ratio, s.min_sharp, s.max_deviation, s.min_patch), own > 0, theirs > 0)
        gy, gx = np.nonzero(~np.isnan(f).any(axis=0))
        if not len(gy):
            continue
        dx, dy = f[:, gy, gx]
        py, px = y0 + half + gy * s.stride, x0 + half + gx * s.stride  # on the canvas
        node.append(np.stack([np.full(len(gy), a), (py - ya) // s.stride, (px - xa) // s.stride]))
        other.append(np.full(len(gy), b))
        places.append(np.stack([py + dy - yb, px + dx - xb]) / s.stride)
        shifts.append(np.stack([dx, dy]))
    join = lambda parts, n: np.concatenate(parts, axis=-1) if parts else np.zeros((n, 0) if n else 0, int)
    return Pulls(join(node, 3).astype(int), join(other, 0).astype(int), join(places, 2).astype(float), join(shifts, 2).astype(float))


def relax(images: list[np.ndarray], at: list[tuple[int, int]], pairs: list[tuple[int, int]], s: Seams, mesh: register.Mesh) -> tuple[np.ndarray, int]:
    """(2, tiles, gy, gx) of displacements of all tiles at rest, and the steps taken; the mean displacement is 0."""
    size = np.max([nodes_of(i.shape, s.stride) for i in images], axis=0)
    start = np.zeros((2, len(images), *size))
    pulls = measure(images, at, pairs, s)
    if not len(pulls.other):
        return start, 0
    d, steps = register.relax(pulls.targets(start), mesh, start, pulls.targets)
    return d - d.mean(axis=(1, 2, 3), keepdims=True), steps


def spread(nodes: np.ndarray, stride: int, box: tuple[slice, slice], first: float = 0.0) -> np.ndarray:
    """The field at the pixels of a box, from nodes that are ``stride`` apart, the first at pixel ``first``."""
    y, x = (np.clip((np.arange(b.start, b.stop) - first) / stride, 0, n - 1) for b, n in zip(box, nodes.shape[1:], strict=True))
    grid = np.meshgrid(y, x, indexing="ij")
    return np.stack([resample.sample(c, *grid) for c in nodes])


def boxes(shape: tuple[int, int], work: int) -> Iterator[tuple[slice, slice]]:
    for y in range(0, shape[0], work):
        for x in range(0, shape[1], work):
            yield slice(y, min(y + work, shape[0])), slice(x, min(x + work, shape[1]))


def warp(image: np.ndarray, nodes: np.ndarray, stride: int, work: int = 1024, first: float = 0.0) -> np.ndarray:
    """The image seen through a field given at nodes: out(x) = image(x + field(x)), a work tile at a time; 0 outside and where the field is NaN."""
    out = np.zeros(image.shape, image.dtype)
    whole = np.issubdtype(image.dtype, np.integer)
    for box in boxes(image.shape, work):
        f = spread(nodes, stride, box, first)
        y, x = np.meshgrid(*(np.arange(b.start, b.stop, dtype=float) for b in box), indexing="ij")
        bad = np.isnan(f).any(axis=0)
        f = np.where(bad, 0, f)
        got = np.where(bad, 0, resample.sample(image, y + f[1], x + f[0]))
        out[box] = got >= 0.5 if image.dtype == bool else np.round(got) if whole else got
    return out


def render(images: list[np.ndarray], at: list[tuple[int, int]], meshes: np.ndarray, stride: int, margins: list[tuple[int, int, int, int]], work: int = 1024) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Canvas, mask, and each tile warped with its mask; the first tile is painted last.

    margins (top, bottom, left, right) are cut off a warped tile, where its
    border would show.
    """
    h, w = (max(p[k] + i.shape[k] for p, i in zip(at, images, strict=True)) for k in (0, 1))
    canvas, mask, warped = np.zeros((h, w), images[0].dtype), np.zeros((h, w), bool), []
    for i, image in enumerate(images):
        n = nodes_of(image.shape, stride)
        back = resample.invert(meshes[:, i, : n[0], : n[1]] / stride) * stride
        warped.append((warp(image, back, stride, work), warp(np.ones(image.shape, bool), back, stride, work)))
    for i in reversed(range(len(images))):
        (own, have), (y, x), (top, bottom, left, right) = warped[i], at[i], margins[i]
        inner = np.zeros(own.shape, bool)
        inner[top : own.shape[0] - bottom, left : own.shape[1] - right] = True
        box = np.s_[y : y + own.shape[0], x : x + own.shape[1]]
        for use in (have & ~mask[box], have & inner):  # where nothing is yet, the margin is better than a gap
            canvas[box][use] = own[use]
            mask[box] |= use
    return canvas, mask, warped


def onto(reference: np.ndarray, reference_mask: np.ndarray, moving: np.ndarray, moving_mask: np.ndarray, s: Seams, mesh: register.Mesh) -> tuple[np.ndarray, np.ndarray]:
    """moving and its mask, of the reference's shape, deformed so that it agrees with the reference where both have pixels."""
    f = trusted_flow(reference, moving, s, reference_mask, moving_mask)
    if np.isnan(f).all():
        return moving, moving_mask
    patch = min(s.patch, *reference.shape)
    d, _ = register.relax(f, mesh)
    return warp(moving, d, s.stride, first=patch / 2), warp(moving_mask, d, s.stride, first=patch / 2)


def overlap(first: np.ndarray, second: np.ndarray, offset: tuple[float, float], rotation: float = 0.0, pad: int = 0, same_shape: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
    """The parts that two images share if the second, turned by rotation, lies at (x, y) of the first; None if they don't meet.

    pad widens the part on the side away from the seam; same_shape trims both
    to the smaller.
    """
    if rotation:
        second = resample.rotate(second, rotation)
    out = []
    for axis, o in ((0, offset[1]), (1, offset[0])):
        n, m = first.shape[axis], second.shape[axis]
        low, high = max(0, round(o)), min(n, m + round(o))
        if high - low < 1:
            return None
        out.append((max(0, low - pad), min(n, high + pad), max(0, low - round(o) - pad), min(m, high - round(o) + pad)))
    (y0, y1, v0, v1), (x0, x1, u0, u1) = out
    a, b = first[y0:y1, x0:x1], second[v0:v1, u0:u1]
    if same_shape:
        h, w = (min(p, q) for p, q in zip(a.shape, b.shape, strict=True))
        a, b = a[:h, :w], b[:h, :w]
    return a, b


def _alike(a: np.ndarray, b: np.ndarray) -> float:
    p, q = masks.sharpness(a)["laplacian"], masks.sharpness(b)["laplacian"]
    return 1.0 if max(p, q) == 0 else 1 - abs(p - q) / max(p, q)


def overlap_after(first: np.ndarray, second: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The parts that two images share once the second is moved onto the first by a 2 x 3 matrix: the box of what both cover."""
    moved, shape, (dx, dy) = resample.canvas(matrix, second.shape)
    own = resample.warp_affine(second, moved, shape)
    have = resample.warp_affine(np.ones(second.shape, bool), moved, shape)
    h, w = (max(a, b) for a, b in zip(shape, (first.shape[0] + dy, first.shape[1] + dx), strict=True))
    grow = lambda v, y, x: np.pad(v, ((y, h - y - v.shape[0]), (x, w - x - v.shape[1])))
    both = grow(np.ones(first.shape, bool), dy, dx) & grow(have, 0, 0)
    if not both.any():
        return None
    ys, xs = np.nonzero(both)
    box = np.s_[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1]
    return grow(first, dy, dx)[box], grow(own, 0, 0)[box]


def check_overlap(first: np.ndarray, second: np.ndarray, offset: tuple[float, float], rotation: float = 0.0, threshold: float = 0.5, scales: tuple[float, ...] = (0.3, 0.5), refine: bool = True) -> float:
    """How alike the edges of two images are where they overlap, 0 to 1; 0 if they don't.

    Under the threshold the overlap is registered once more, at the first of the
    scales that gives a transform.
    """
    parts = overlap(first, second, offset, rotation)
    if parts is None:
        return 0.0
    score = _alike(*parts)
    if not refine or score >= threshold:
        return score
    for scale in scales:
        e = register.estimate(*parts, scale, retry=False)
        if e.matrix is not None:
            again = overlap_after(*parts, e.matrix)
            return 0.0 if again is None else _alike(*again)
    return score
