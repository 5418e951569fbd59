"""Boxes, poses and cameras in space, as column expressions.

A matrix is a nested list of columns, ``m[row][column]``; a pose maps camera to
world. Angles are radians. A box is turned by its angles about the fixed z, x
and y axes in that order, so its rotation is ``Ry(c) Rx(b) Rz(a)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = Sequence[Column]
Matrix = Sequence[Vector]


def dot(u: Vector, v: Vector) -> Column:
    total = u[0] * v[0]
    for x, y in zip(u[1:], v[1:], strict=True):
        total = total + x * y
    return total


def minus(u: Vector, v: Vector) -> list[Column]:
    return [x - y for x, y in zip(u, v, strict=True)]


def norm(u: Vector) -> Column:
    return F.sqrt(dot(u, u))


def transpose(m: Matrix) -> list[list[Column]]:
    return [[m[i][j] for i in range(3)] for j in range(3)]


def apply(m: Matrix, v: Vector) -> list[Column]:
    return [dot(row, v) for row in m]


def matmul(a: Matrix, b: Matrix) -> list[list[Column]]:
    columns = transpose(b)
    return [[dot(row, c) for c in columns] for row in a]


def rotation(a: Column, b: Column, c: Column) -> list[list[Column]]:
    """``Ry(c) Rx(b) Rz(a)``."""
    sa, ca, sb, cb, sc, cc = F.sin(a), F.cos(a), F.sin(b), F.cos(b), F.sin(c), F.cos(c)
    return [
        [cc * ca + sc * sb * sa, sc * sb * ca - cc * sa, sc * cb],
        [cb * sa, cb * ca, -sb],
        [cc * sb * sa - sc * ca, sc * sa + cc * sb * ca, cc * cb],
    ]


def euler(m: Matrix) -> tuple[Column, Column, Column]:
    """The angles (a, b, c) of ``rotation``, for b within a quarter turn."""
    sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -m[1][2]))
    return F.atan2(m[1][0], m[1][1]), F.asin(sine), F.atan2(m[0][2], m[2][2])


def elementary(axis: str, angle: Column) -> list[list[Column]]:
    """The rotation about one axis."""
    s, c, zero, one = F.sin(angle), F.cos(angle), F.lit(0.0), F.lit(1.0)
    return {"X": [[one, zero, zero], [zero, c, -s], [zero, s, c]], "Y": [[c, zero, s], [zero, one, zero], [-s, zero, c]], "Z": [[c, -s, zero], [s, c, zero], [zero, zero, one]]}[axis]


def rotation_by(convention: str, angles: Vector) -> list[list[Column]]:
    """The product of elementary rotations about the three axes of a convention such as ``XYZ`` or ``ZXZ``."""
    first, second, third = (elementary(axis, a) for axis, a in zip(convention, angles, strict=True))
    return matmul(matmul(first, second), third)


def euler_by(convention: str, m: Matrix) -> tuple[Column, Column, Column]:
    """The angles of ``rotation_by``: three axes that differ, or the first again as the third; the middle one within its principal range."""
    if len(convention) != 3 or set(convention) - set("XYZ") or convention[1] in (convention[0], convention[2]):
        raise ValueError(f"{convention} is no convention of three axes")
    i, j, k = ("XYZ".index(axis) for axis in convention)
    clamp = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    if i != k:
        sign = 1 if (j - i) % 3 == 1 else -1
        return F.atan2(-sign * m[j][k], m[k][k]), F.asin(clamp(sign * m[i][k])), F.atan2(-sign * m[i][j], m[i][i])
    k = 3 - i - j
    sign = 1 if (j - i) % 3 == 1 else -1
    return F.atan2(m[j][i], -sign * m[k][i]), F.acos(clamp(m[i][i])), F.atan2(m[i][j], sign * m[i][k])


def corners(center: Vector, size: Vector, angles: Vector) -> list[list[Column]]:
    """The eight corners, signs of x slowest and of z fastest, from minus to plus."""
    m = rotation(*angles)
    out = []
    for sx in (-0.5, 0.5):
        for sy in (-0.5, 0.5):
            for sz in (-0.5, 0.5):
                turned = apply(m, [size[0] * sx, size[1] * sy, size[2] * sz])
                out.append([x + y for x, y in zip(center, turned, strict=True)])
    return out


def top(center: Vector, size: Vector, angles: Vector) -> Column:
    """The largest z of a box."""
    row = rotation(*angles)[2]
    return center[2] + (F.abs(row[0]) * size[0] + F.abs(row[1]) * size[1] + F.abs(row[2]) * size[2]) / 2


def volume(size: Vector) -> Column:
    return size[0] * size[1] * size[2]


def cam_to_world(pose: Matrix, translation: Vector, point: Vector) -> list[Column]:
    return [x + t for x, t in zip(apply(pose, point), translation, strict=True)]


def world_to_cam(pose: Matrix, translation: Vector, point: Vector) -> list[Column]:
    return apply(transpose(pose), minus(point, translation))


def box_to_camera(pose: Matrix, translation: Vector, center: Vector, angles: Vector) -> tuple[list[Column], tuple[Column, Column, Column]]:
    """A world box's centre and angles in the camera's frame."""
    turned = matmul(transpose(pose), rotation(*angles))
    return world_to_cam(pose, translation, center), euler(turned)


def backproject(u: Column, v: Column, depth: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> list[Column]:
    return [(u - cx) * depth / fx, (v - cy) * depth / fy, depth]


def project(point: Vector, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """The pixel of a camera point; null behind the camera."""
    ahead = F.when(point[2] > 0, point[2])
    return fx * point[0] / ahead + cx, fy * point[1] / ahead + cy


def field_of_view(size: Column, focal: Column) -> Column:
    """Degrees that ``size`` pixels see."""
    return F.degrees(2 * F.atan2(size, 2 * focal))


def pixel_intrinsics(m00: Column, m11: Column, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """(fx, fy, cx, cy) in pixels from the diagonal of a projection matrix."""
    return m00 * (width - 1) / 2, m11 * (height - 1) / 2, (width - 1) / 2, (height - 1) / 2


def planar_depth(distance: Column, x: Column, y: Column, focal: Column) -> Column:
    """Depth along the axis in whole millimetres from the distance along the ray; 0 where that is not a number."""
    z = distance * focal / norm([x, y, focal])
    return F.greatest(F.lit(0), F.least(F.lit(65535), F.floor(F.nanvl(F.coalesce(z, F.lit(0.0)), F.lit(0.0)) * 1000))).cast("int")


def flip_axes(m: Matrix, translation: Vector, scale: Column) -> tuple[list[list[Column]], list[Column]]:
    """A pose with its y and z axes turned round, and its translation scaled."""
    return [[row[0], -row[1], -row[2]] for row in m], [t * scale for t in translation]


def rotation_angle(a: Matrix, b: Matrix) -> Column:
    """Degrees between two rotations."""
    trace = dot([*a[0], *a[1], *a[2]], [*b[0], *b[1], *b[2]])
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))))


#: Where a record keeps an object's centre, in order of preference.
CENTERS = ("center_xyz_cam", "point_xyz_cam", "center_3d", "centroid_xyz_cam", "centroid")


def representative_center(json: Column) -> Column:
    """An object's centre from its JSON: the first field that is three numbers, else the first three of its world box."""
    found = [F.from_json(F.get_json_object(json, f"$.{name}"), "array<double>") for name in CENTERS]
    world = F.from_json(F.get_json_object(json, "$.obb_world"), "array<double>")
    three = [F.when((F.size(x) == 3) & ~F.exists(x, lambda v: v.isNull()), x) for x in found]
    return F.coalesce(*three, F.when(F.size(world) >= 3, F.slice(world, 1, 3)))
