"""Point clouds: nearest neighbours, outliers and hulls.

Points are rows (object, x, y, z). Range joins go through a grid, so each point
meets those of the 27 cells around it and no others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistaloom.functions import geometry3d as g

XYZ = ("x", "y", "z")


def _cell(c: str, size: float) -> Column:
    return F.floor(F.col(c) / size)


def pairs_within(a: DataFrame, b: DataFrame, radius: float, key: str = "object") -> DataFrame:
    """(a_key, a_x.., b_key, b_x.., distance) of points of ``a`` and ``b`` at most ``radius`` apart."""
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in (key, *XYZ)], *[_cell(c, radius).alias(f"_{c}") for c in XYZ])
    near = F.array(*[F.struct(*[(_cell(c, radius) + d).alias(f"_{c}") for c, d in zip(XYZ, step, strict=True)]) for step in np.ndindex(3, 3, 3)])
    # cells one to each side: steps 0 to 2, moved back by one
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in (key, *XYZ)], F.explode(near).alias("_n"))
    right = right.select(*[f"b_{c}" for c in (key, *XYZ)], *[(F.col("_n")[f"_{c}"] - 1).alias(f"_{c}") for c in XYZ])
    met = left.join(right, [f"_{c}" for c in XYZ]).drop(*[f"_{c}" for c in XYZ])
    met = met.withColumn("distance", g.norm(g.minus([F.col(f"a_{c}") for c in XYZ], [F.col(f"b_{c}") for c in XYZ])))
    return met.filter(F.col("distance") <= radius)


def nearest_within(a: DataFrame, b: DataFrame, keys: list[str], radius: float, carry: list[str]) -> DataFrame:
    """(keys, a_carry.., b_carry.., distance): each point of ``a`` with the nearest of ``b`` of the same keys, if one is at most ``radius`` away.

    Points meet in a grid of cells ``radius`` wide; of equally near ones the least in ``carry`` is taken.
    """
    cells = F.array(*[F.struct(*[F.lit(d - 1).alias(f"_{c}") for c, d in zip(XYZ, step, strict=True)]) for step in np.ndindex(3, 3, 3)])
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in (*carry, *XYZ)], F.explode(cells).alias("_s"))
    left = left.select("*", *[(F.floor(F.col(f"a_{c}") / radius) + F.col("_s")[f"_{c}"]).alias(f"_{c}") for c in XYZ]).drop("_s")
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in (*carry, *XYZ)], *[_cell(c, radius).alias(f"_{c}") for c in XYZ])
    d = g.norm(g.minus([F.col(f"a_{c}") for c in XYZ], [F.col(f"b_{c}") for c in XYZ]))
    met = left.join(right, [*keys, *[f"_{c}" for c in XYZ]]).withColumn("distance", d).filter(F.col("distance") <= radius)
    best = met.groupBy(*keys, *[f"a_{c}" for c in (*carry, *XYZ)]).agg(F.min(F.struct("distance", *[f"b_{c}" for c in carry])).alias("m"))
    return best.select(*keys, *[f"a_{c}" for c in carry], *[F.col("m")[f"b_{c}"].alias(f"b_{c}") for c in carry], "m.distance")


def min_distances(points: DataFrame, pairs: DataFrame, key: str = "object") -> DataFrame:
    """(a, b, distance) for object pairs (a, b): the least distance of their points; infinite if one has none.

    Only listed pairs meet, by equal keys; the minimum is aggregated before the shuffle.
    """
    p = points.select(F.col(key).alias("a"), *[F.col(c).alias(f"_a{c}") for c in XYZ])
    q = points.select(F.col(key).alias("b"), *[F.col(c).alias(f"_b{c}") for c in XYZ])
    d = g.norm(g.minus([F.col(f"_a{c}") for c in XYZ], [F.col(f"_b{c}") for c in XYZ]))
    best = pairs.join(p, "a").join(q, "b").groupBy("a", "b").agg(F.min(d).alias("distance"))
    return pairs.join(best, ["a", "b"], "left").withColumn("distance", F.coalesce("distance", F.lit(float("inf"))))


def keep_inliers(xyz: np.ndarray, neighbours: int, ratio: float) -> np.ndarray:
    """Which points have a mean distance to their nearest neighbours (themselves among them) below mean + ratio * deviation."""
    n = len(xyz)
    if n <= 1:
        return np.ones(n, bool)
    k = min(neighbours, n)
    mean = np.empty(n)
    for at in range(0, n, 256):
        part = xyz[at : at + 256]
        d = np.sqrt(((part[:, None, :] - xyz[None, :, :]) ** 2).sum(-1))
        mean[at : at + 256] = np.partition(d, k - 1, axis=1)[:, :k].mean(1)
    deviation = mean.std(ddof=1)
    return mean < mean.mean() + ratio * deviation if deviation > 0 else np.ones(n, bool)


def without_outliers(points: DataFrame, neighbours: int = 10, ratio: float = 2.0, key: str = "object") -> DataFrame:
    """Points without statistical outliers of their object; one object's points must fit a task."""
    rows = points.select(key, *XYZ)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return group[keep_inliers(group[list(XYZ)].to_numpy(float), neighbours, ratio)]

    return rows.groupBy(key).applyInPandas(run, rows.schema)


def hull_volume(xyz: np.ndarray) -> float:
    """The volume of the convex hull; 0 for flat or fewer than four points."""
    p = np.unique(xyz, axis=0)
    if len(p) < 4:
        return 0.0
    span = max(np.ptp(p, axis=0).max(), 1e-12)
    eps = 1e-9 * span
    i = 0
    j = int(np.argmax(((p - p[i]) ** 2).sum(1)))
    line = np.cross(p - p[i], p[j] - p[i])
    k = int(np.argmax((line**2).sum(1)))
    normal = np.cross(p[j] - p[i], p[k] - p[i])
    height = (p - p[i]) @ normal
    m = int(np.argmax(np.abs(height)))
    if np.linalg.norm(normal) < eps * span or abs(height[m]) < eps * np.linalg.norm(normal):
        return 0.0
    inside = p[[i, j, k, m]].mean(0)

    def face(a: int, b: int, c: int) -> tuple[int, int, int]:
        return (a, b, c) if np.cross(p[b] - p[a], p[c] - p[a]) @ (p[a] - inside) > 0 else (a, c, b)

    # each point that is outside waits at one face that it sees; only those of faces that go are looked at again
    corners = np.empty((64, 3), int)
    planes = np.empty((64, 4))
    alive = np.zeros(64, bool)
    waiting: dict[int, np.ndarray] = {}
    used = 0

    def add(new: list[tuple[int, int, int]], points: np.ndarray) -> None:
        nonlocal corners, planes, alive, used
        while used + len(new) > len(alive):
            corners, planes, alive = (np.concatenate([x, np.zeros_like(x)]) for x in (corners, planes, alive))
        at = np.arange(used, used + len(new))
        f = np.array(new)
        normal = np.cross(p[f[:, 1]] - p[f[:, 0]], p[f[:, 2]] - p[f[:, 0]])
        normal /= np.maximum(np.linalg.norm(normal, axis=1, keepdims=True), 1e-300)
        corners[at], planes[at, :3], planes[at, 3], alive[at] = f, normal, (p[f[:, 0]] * normal).sum(1), True
        used += len(new)
        if len(points):
            height = p[points] @ normal.T - planes[at, 3]
            best = height.argmax(1)
            out = height[np.arange(len(points)), best] > eps
            for k in np.unique(best[out]):
                waiting[int(at[k])] = points[out & (best == k)]

    add([face(i, j, k), face(i, j, m), face(i, k, m), face(j, k, m)], np.arange(len(p)))
    while waiting:
        f, points = next(iter(waiting.items()))
        q = int(points[(p[points] @ planes[f, :3]).argmax()])
        seen = np.flatnonzero(alive[:used] & (planes[:used, :3] @ p[q] - planes[:used, 3] > eps))
        gone = {e for t in corners[seen].tolist() for e in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0]))}
        again = np.concatenate([waiting.pop(int(t)) for t in seen if int(t) in waiting])
        alive[seen] = False
        add([(a, b, q) for a, b in gone if (b, a) not in gone], again[again != q])
    a, b, c = (p[corners[:used][alive[:used]][:, t]] - inside for t in range(3))
    return float((np.cross(a, b) * c).sum(1).sum() / 6)


def hull_volumes(points: DataFrame, key: str = "object") -> DataFrame:
    """(key, n, volume) of each object's convex hull."""
    kind = points.schema[key].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: [group[key].iloc[0]], "n": [len(group)], "volume": [hull_volume(group[list(XYZ)].to_numpy(float))]})

    return points.select(key, *XYZ).groupBy(key).applyInPandas(run, f"{key} {kind}, n long, volume double")


def in_box(point: g.Vector, center: g.Vector, size: g.Vector, angles: g.Vector, shrink: float = 1.0) -> Column:
    """Whether a point lies in a turned box, each side ``shrink`` of its length."""
    own = g.apply(g.transpose(g.rotation(*angles)), g.minus(point, center))
    near = [F.abs(x) <= s * shrink / 2 for x, s in zip(own, size, strict=True)]
    return near[0] & near[1] & near[2]
