"""Boxes and points on the image plane, as column expressions.

A box is four columns ``x1, y1, x2, y2``; coordinates are integers in
``[0, scale)``. All rounding is half to even.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = Sequence[Column]


def columns(prefix: str = "") -> list[Column]:
    """The four columns of a box by prefix."""
    return [F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2")]


def area(b: Box) -> Column:
    return F.greatest(F.lit(0), b[2] - b[0]) * F.greatest(F.lit(0), b[3] - b[1])


def aspect(b: Box) -> Column:
    """The longer side over the shorter, sides taken as 1 at least."""
    w, h = F.greatest(F.lit(1), b[2] - b[0]), F.greatest(F.lit(1), b[3] - b[1])
    return F.greatest(w / h, h / w)


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 for an empty union."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when(union <= 0, F.lit(0.0)).otherwise(inter / union)


def containment(a: Box, b: Box) -> Column:
    """Intersection over the smaller area; 0 if that is empty."""
    small = F.least(area(a), area(b))
    return F.when(small <= 0, F.lit(0.0)).otherwise(intersection(a, b) / small)


def center(b: Box) -> tuple[Column, Column]:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def distance(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def box_in_bounds(b: Box, scale: int = 1000) -> Column:
    return (F.least(*b) >= 0) & (F.greatest(*b) < scale)


def point_in_bounds(u: Column, v: Column, scale: int = 1000) -> Column:
    return (u >= 0) & (u < scale) & (v >= 0) & (v < scale)


def representative_point(b: Box, u: Column, v: Column) -> tuple[Column, Column, Column]:
    """(u, v, method) of an object: its box's centre or its point; both at once, or neither, is an error."""
    boxed, pointed = b[0].isNotNull(), u.isNotNull()
    fail = F.raise_error(F.lit("an object needs either a box or a point"))
    cu, cv = center(b)

    def pick(x: Column, y: Column, kind: str) -> Column:
        return F.when(boxed & ~pointed, x).when(pointed & ~boxed, y).otherwise(fail.cast(kind))

    return (
        pick(cu.cast("double"), u.cast("double"), "double"),
        pick(cv.cast("double"), v.cast("double"), "double"),
        pick(F.lit("bbox_center"), F.lit("point_uv"), "string"),
    )


def normalize(pixel: Column, size: Column, scale: int = 1000) -> Column:
    """A pixel as an integer in ``[0, scale)``."""
    return F.greatest(F.lit(0), F.least(F.lit(scale - 1), F.bround(pixel / size * scale).cast("int")))


def denormalize(value: Column, size: Column, scale: int = 1000) -> Column:
    """The pixel of a normalised integer."""
    return F.bround(value / scale * size).cast("int")


def scale_length(value: float, scale: int) -> float:
    """A threshold given for scale 1000, at another scale."""
    return value * scale / 1000


def scale_area(value: float, scale: int) -> float:
    return value * (scale / 1000) ** 2


def sign(value: Column, dead_band: float) -> Column:
    """1 or -1 strictly beyond the dead band, else 0."""
    return F.when(value > dead_band, 1).when(value < -dead_band, -1).otherwise(0)
