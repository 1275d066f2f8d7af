"""Geometric vectors held as arrays of double."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratiform.functions.text import once


def parsed(c: Column, size: int | None = None) -> Column:
    """Numbers of `[a, b]`, `(a, b)`, `a\\b`; null if one cannot be read or there are fewer than `size`."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)"), 1), lambda x: x.try_cast("double"))
    ok = (F.size(found) > 0) & F.forall(found, lambda x: x.isNotNull())
    return F.when(ok & (F.size(found) >= size) if size else ok, found)


def part(v: Column, i: int) -> Column:
    return F.try_element_at(v, F.lit(i))


def norm(v: Column, at: range) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [part(v, i) * part(v, i) for i in at]))


def standardised(v: Column, tolerance: float = 1e-6, decimals: int = 3) -> Column:
    """Both halves of a 6-vector normalised, tiny components zero, half-even rounded; anything invalid is null."""
    a, b = norm(v, range(1, 4)), norm(v, range(4, 7))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scale = 10.0**decimals

    def one(i: int) -> Column:
        x = part(v, i) / (a if i <= 3 else b)
        return F.when(F.abs(x) < tolerance, 0.0).otherwise(F.rint(x * scale) / scale)

    return F.when((F.size(v) == 6) & finite & (a >= tolerance) & (b >= tolerance), F.array(*map(one, range(1, 7))))


def normal(v: Column) -> Column:
    """The unit normal of the plane that a 6-vector spans; null if it spans none."""

    def cross(v: Column) -> Column:
        r, c = [part(v, i) for i in (1, 2, 3)], [part(v, i) for i in (4, 5, 6)]
        return F.array(r[1] * c[2] - r[2] * c[1], r[2] * c[0] - r[0] * c[2], r[0] * c[1] - r[1] * c[0])

    unit = lambda n: once(norm(n, range(1, 4)), lambda size: F.when(size > 0, F.transform(n, lambda x: x / size)))
    return once(v, lambda v: F.when(F.size(v) == 6, once(cross(v), unit)))


def plane(v: Column, threshold: float = 10.0) -> Column:
    """(plane, angle, axis): the axis nearest to the normal; OBL if the angle is over the threshold (a tie, within 1e-6 + 1e-5 of the threshold, is not)."""

    def named(n: Column, top: Column, angle: Column) -> Column:
        name = lambda *x: F.element_at(F.array(*map(F.lit, x)), F.array_position(n, top).cast("int"))
        tie = F.abs(angle - threshold) <= 1e-6 + 1e-5 * abs(threshold)
        kind = F.when((angle > threshold) & ~tie, "OBL").otherwise(name("SAG", "COR", "AX"))
        return F.struct(kind.alias("plane"), angle.alias("angle"), name("X", "Y", "Z").alias("axis"))

    of = lambda n: once(F.array_max(n), lambda top: once(F.degrees(F.acos(F.least(F.lit(1.0), top))), lambda angle: named(n, top, angle)))
    return once(F.transform(normal(v), F.abs), lambda n: F.when(n.isNotNull(), of(n)))


def coordinate(position: Column, orientation: Column, location: Column) -> Column:
    """Position along the normal, else the given location."""
    along = once(normal(orientation), lambda n: reduce(lambda a, b: a + b, [part(position, i) * part(n, i) for i in (1, 2, 3)]))
    return F.coalesce(along, location)


def slice_key(x: Column, tolerance: float) -> Column:
    return F.rint(x / tolerance).cast("long")
