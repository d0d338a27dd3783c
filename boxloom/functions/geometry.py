"""Line and segment expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column]


def line_degrees(dx: Column, dy: Column) -> Column:
    return F.when(dx == 0, F.lit(90.0)).otherwise(F.degrees(F.atan(F.try_divide(dy.cast("double"), dx))))


def axis(dx: Column, dy: Column) -> Column:
    """updown for a line strictly within 45 degrees of level, else leftright. Compared
    by lengths, so that exactly 45 degrees cannot fall on either side by rounding."""
    return F.when(F.abs(dy) < F.abs(dx), "updown").otherwise("leftright")


def vector_degrees(to: Point, start: Point) -> Column:
    return F.degrees(F.atan2((to[1] - start[1]).cast("double"), (to[0] - start[0]).cast("double")))


def ccw(a: Point, b: Point, c: Point) -> Column:
    return (c[1] - a[1]) * (b[0] - a[0]) > (b[1] - a[1]) * (c[0] - a[0])


def intersects(a: Point, b: Point, c: Point, d: Point) -> Column:
    """Segments ab and cd cross, by strict turns: touching ends follow the signs."""
    return (ccw(a, c, d) != ccw(b, c, d)) & (ccw(a, b, c) != ccw(a, b, d))


def line_through(p: Point, q: Point) -> tuple[Column, Column, Column]:
    """a, b, c of a x + b y + c = 0."""
    return p[1] - q[1], q[0] - p[0], p[0] * q[1] - q[0] * p[1]


def cross_point(p: Point, q: Point, r: Point, s: Point) -> Point:
    """Where the lines pq and rs meet; nulls if they are parallel."""
    (a0, b0, c0), (a1, b1, c1) = line_through(p, q), line_through(r, s)
    det = a0 * b1 - a1 * b0
    return F.try_divide((b0 * c1 - b1 * c0).cast("double"), det), F.try_divide((a1 * c0 - a0 * c1).cast("double"), det)


def direction(mid: Column, cross: Column, before: Column) -> Column:
    """down if the crossing lies before the point on its axis, up if after it; on the
    point itself, by the way it moved."""
    return F.when(cross < mid, "down").when(cross > mid, "up").when(mid < before, "up").otherwise("down")
