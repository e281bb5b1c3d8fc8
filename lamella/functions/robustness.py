"""The robustness index of a set of matches, once for columns and for plain numbers."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

from pyspark.sql import functions as F

# Fixed values of the robustness index: weights of its four parts, its penalty, and the least index of a robust match.
PARTS, PENALTY, ROBUST = (0.25, 0.15, 0.35, 0.25), 0.3, 0.45


@dataclass(frozen=True)
class Numbers:
    """What the formulas need, on floats."""

    @staticmethod
    def case(pairs: list[tuple[bool, float]], other: float) -> float:
        return next((float(v) for on, v in pairs if on), float(other))

    @staticmethod
    def both(*conditions: bool) -> bool:
        return all(conditions)

    least, greatest, log = staticmethod(min), staticmethod(max), staticmethod(math.log)


@dataclass(frozen=True)
class Columns:
    """The same, on columns."""

    @staticmethod
    def case(pairs: list, other: Any):
        (on, value), *rest = pairs
        out = F.when(on, value)
        for on, value in rest:
            out = out.when(on, value)
        return out.otherwise(other)

    @staticmethod
    def both(*conditions):
        out = conditions[0]
        for c in conditions[1:]:
            out = out & c
        return out

    @staticmethod
    def least(*values):
        return F.least(*[F.lit(v) if isinstance(v, float) else v for v in values])

    @staticmethod
    def greatest(*values):
        return F.greatest(*[F.lit(v) if isinstance(v, float) else v for v in values])

    @staticmethod
    def log(value):
        return F.log(F.lit(value) if isinstance(value, float) else value)


def index(n, inliers, mean, share, tolerance: float, of: type[Numbers] | type[Columns]):
    """From matches, inliers, mean residual of those kept, and the share of them within the tolerance."""
    quantity = of.case([(n <= 5, n / 10), (n <= 20, 0.5 + (n - 5) / 30)], 0.8 + 0.2 * of.least(1.0, of.log(of.greatest(n - 19, 1.0)) / of.log(50.0)))
    r, t = inliers / n, tolerance
    proportion = of.case([(r >= 0.7, 1.0), (r >= 0.4, 0.6 + 0.4 * (r - 0.4) / 0.3), (r >= 0.2, 0.3 + 0.3 * (r - 0.2) / 0.2)], 0.3 * r / 0.2)
    fall = of.greatest(0.1, 0.2 - 0.1 * (mean - 2 * t) / t)
    quality = of.case([(mean <= 0.5 * t, 1.0), (mean <= t, 0.8 - 0.3 * (mean - 0.5 * t) / (0.5 * t)), (mean <= 2 * t, 0.5 - 0.3 * (mean - t) / t)], fall)
    consistency = of.case([(share >= 0.9, 1.0), (share >= 0.7, 0.8 + 0.2 * (share - 0.7) / 0.2), (share >= 0.5, 0.5 + 0.3 * (share - 0.5) / 0.2)], share)
    total = PARTS[0] * quantity + PARTS[1] * proportion + PARTS[2] * quality + PARTS[3] * consistency
    strong = of.both(n >= 10, inliers >= 6, mean <= 3 * t)
    return of.least(1.0, of.greatest(0.0, total * of.case([(strong, 1.0)], PENALTY)))
