"""Eigenvectors of symmetric 3 x 3 matrices, as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths below this share of the matrix's scale count as none.
FLAT = 1e-9


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def at(vector: Column) -> list[Column]:
    return [F.get(vector, F.lit(i)) for i in range(3)]


def bind(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed, and written down, once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def unit(vector: Column) -> Column:
    """The vector over its length; one of length 0 stays."""
    def scaled(v: Column) -> Column:
        size = F.sqrt(dot(at(v), at(v)))
        return F.transform(v, lambda c: c / F.when(size > 0, size).otherwise(1.0))

    return bind(vector, scaled)


def normal(a: Column, b: Column) -> Column:
    """The cross product of two vectors."""
    return bind(F.struct(a.alias("a"), b.alias("b")), lambda p: F.array(*cross(at(p["a"]), at(p["b"]))))


def turned(vector: Column) -> Column:
    """The vector or its opposite, so that its components add up to 0 or more."""
    return bind(vector, lambda v: F.transform(v, lambda c: c * F.when(v[0] + v[1] + v[2] < 0, -1.0).otherwise(1.0)))


def eigenvalues(m: Column) -> Column:
    """Largest to smallest, of ``m``: the array ``c00, c01, c02, c11, c12, c22``. By the cosine of a third of an angle."""
    c = [F.get(m, F.lit(i)) for i in range(6)]
    mean = (c[0] + c[3] + c[5]) / 3.0
    off = c[1] * c[1] + c[2] * c[2] + c[4] * c[4]
    d = [c[0] - mean, c[3] - mean, c[5] - mean]
    spread = F.sqrt((d[0] * d[0] + d[1] * d[1] + d[2] * d[2] + 2.0 * off) / 6.0)
    det = d[0] * (d[1] * d[2] - c[4] * c[4]) - c[1] * (c[1] * d[2] - c[4] * c[2]) + c[2] * (c[1] * c[4] - d[1] * c[2])
    ratio = F.greatest(F.least(det / (spread * spread * spread) / 2.0, F.lit(1.0)), F.lit(-1.0))
    angle = F.when(spread > 0, F.acos(ratio)).otherwise(0.0) / 3.0
    high, low = mean + 2.0 * spread * F.cos(angle), mean + 2.0 * spread * F.cos(angle + 2.0 * math.pi / 3.0)
    return F.array(high, 3.0 * mean - high - low, low)


def _kernel(m: Column, value: Column) -> Column:
    """A vector that ``m - value`` takes to 0: the longest cross product of two of its rows."""
    c = [F.get(m, F.lit(i)) for i in range(6)]
    rows = [[c[0] - value, c[1], c[2]], [c[1], c[3] - value, c[4]], [c[2], c[4], c[5] - value]]
    pairs = F.array(*[F.array(*cross(rows[i], rows[j])) for i, j in ((0, 1), (0, 2), (1, 2))])
    return F.array_max(F.transform(pairs, lambda p: F.struct(dot(at(p), at(p)).alias("size"), p.alias("v"))))


def _across(vector: Column) -> Column:
    """A unit vector at right angles to a unit vector: across the axis it is farthest from."""
    axes = [F.array(*[F.lit(float(i == k)) for k in range(3)]) for i in range(3)]

    def crossed(v: Column) -> Column:
        a = [F.abs(x) for x in at(v)]
        axis = F.when((a[0] <= a[1]) & (a[0] <= a[2]), axes[0]).when(a[1] <= a[2], axes[1]).otherwise(axes[2])
        return unit(normal(v, axis))

    return bind(vector, crossed)


def main_axes(m: Column) -> Column:
    """``(first, second)``: unit eigenvectors of the two largest eigenvalues of ``m`` (see ``eigenvalues``).

    The sign is such that a vector's components add up to 0 or more. Where the largest two are equal,
    the first is any in their plane, by a fixed rule; where the smallest two are, the second is; a
    multiple of the identity has the first two axes. Null if ``m`` has nulls or is not finite.
    """
    def solve(s: Column) -> Column:
        values, scale = s["values"], s["scale"]
        top, low = _kernel(s["m"], F.get(values, F.lit(0))), _kernel(s["m"], F.get(values, F.lit(2)))
        none = F.lit(FLAT) * scale * scale * FLAT * scale * scale  # sizes are squares of products of two rows
        return bind(F.struct(top.alias("top"), low.alias("low")), lambda k: _plane(k["top"], k["low"], none))

    c = [F.get(m, F.lit(i)) for i in range(6)]
    scale = F.sqrt(sum((x * x for x in c[1:]), c[0] * c[0]))
    good = ~F.exists(m, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(good, bind(F.struct(m.alias("m"), eigenvalues(m).alias("values"), scale.alias("scale")), solve))


def _plane(top: Column, low: Column, none: Column) -> Column:
    axes = [F.array(*[F.lit(float(i == k)) for k in range(3)]) for i in range(3)]
    first = F.when(top["size"] > none, unit(top["v"])).when(low["size"] > none, _across(unit(low["v"]))).otherwise(axes[0])

    def both(v: Column) -> Column:
        last = F.when(low["size"] > none, unit(low["v"])).when(top["size"] > none, _across(v)).otherwise(axes[2])
        return F.struct(turned(v).alias("first"), turned(unit(normal(last, v))).alias("second"))

    return bind(first, both)
