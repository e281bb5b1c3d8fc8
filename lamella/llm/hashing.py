"""Rolling hashes of runs of units, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

_MULT = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(4)
def byte_hashes(seed: int) -> np.ndarray:
    """A 64-bit value for each byte."""
    return np.array([xxhash.xxh64_intdigest(bytes([b]), seed) for b in range(256)], np.uint64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_MULT), n, 1 << 64))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of n units at each place, by doubling."""
    out, length, size, block = None, 0, 1, h
    while True:
        if n & size:
            out, length = (block, size) if out is None else (out[: len(out) - size] * _power(size) + block[length:], length + size)
        size *= 2
        if size > n:
            return out
        half = size // 2
        block = block[: max(0, len(block) - half)] * _power(half) + block[half:]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


@lru_cache(2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**bits powers of the multiplier, and of its inverse."""
    one, n = np.ones(1, np.uint64), (1 << bits) - 1
    return tuple(np.multiply.accumulate(np.concatenate((one, np.full(n, x)))) for x in (_MULT, np.uint64(pow(int(_MULT), -1, 1 << 64))))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end) of unit values: prefix sums of value times power, shifted back to power zero."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, back = _powers(max(16, len(values).bit_length()))
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.multiply(values, power[: len(values)], out=sums[1:])
    np.cumsum(sums, out=sums)
    return mix((sums[ends] - sums[starts]) * back[starts])


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by a plain sort."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))[: len(x)]]


def grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values; which of them each value is; how often each is there."""
    order = np.argsort(x)
    x = x[order]
    new = np.concatenate(([True], x[1:] != x[:-1]))[: len(x)]
    of = np.empty(len(x), np.int64)
    of[order] = np.cumsum(new) - 1
    return x[new], of, np.bincount(of, minlength=int(new.sum()))
