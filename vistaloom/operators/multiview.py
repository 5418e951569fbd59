"""Scenes of several views: node identity, view pairs, diverse poses and walks.

Appearances are rows (scene, view, node, ...): node seen in view.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.operators import questions


def nodes(appearances: DataFrame, identity: list[str], order: str, first: list[str]) -> DataFrame:
    """(scene, identity, first columns from the first appearance, views) of each distinct node."""
    rows = appearances.groupBy("scene", *identity)
    return rows.agg(*[F.min_by(c, order).alias(c) for c in first], F.transform(F.array_sort(F.collect_list(F.struct(order, "view"))), lambda x: x["view"]).alias("views"))


def seen_often(appearances: DataFrame, least: int = 3) -> DataFrame:
    """(scene, node, n_views) of nodes in at least ``least`` views."""
    return appearances.groupBy("scene", "node").agg(F.countDistinct("view").alias("n_views")).filter(F.col("n_views") >= least)


def shared_views(appearances: DataFrame) -> DataFrame:
    """(scene, a, b, n) of view pairs that see a node in common, with how many."""
    rows = appearances.select("scene", "node", "view").distinct()
    a, b = (rows.select("scene", "node", F.col("view").alias(v)) for v in "ab")
    return a.join(b, ["scene", "node"]).filter("a < b").groupBy("scene", "a", "b").agg(F.count("*").alias("n"))


def unique_objects(appearances: DataFrame) -> DataFrame:
    """(scene, view, node) of nodes that no other view of the scene sees."""
    n = F.size(F.collect_set("view").over(Window.partitionBy("scene", "node")))
    return appearances.withColumn("_n", n).filter("_n = 1").select("scene", "view", "node").distinct()


def diverse(views: DataFrame, least_degrees: float = 15, least_distance: float = 0.0, most: int = 6) -> DataFrame:
    """Views of each scene taken greedily in order: each differs from all taken before by its angle or, if asked for, its place.

    Views are rows (scene, view, yaw, x, y, z); a scene's views go through one task.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        taken: list = []
        for v in group.sort_values("view").itertuples():
            if len(taken) == most:
                break
            if all(_differ(v, t, least_degrees, least_distance) for t in taken):
                taken.append(v)
        return pd.DataFrame([(v.scene, v.view, i) for i, v in enumerate(taken)], columns=["scene", "view", "rank"])

    return views.groupBy("scene").applyInPandas(run, "scene long, view long, rank int")


def _differ(v, t, degrees: float, distance: float) -> bool:
    turn = abs((v.yaw - t.yaw + 180) % 360 - 180)
    return turn >= degrees or (distance > 0 and math.dist((v.x, v.y, v.z), (t.x, t.y, t.z)) >= distance)


def chains(appearances: DataFrame, length: int, seed: int) -> DataFrame:
    """(scene, step, view, node): for each scene, a walk over views that share nodes, to ``length`` distinct nodes in as many distinct views.

    It starts at a drawn view; a step picks a drawn new node of the current view that a new view sees as well,
    and one such view, drawn too; the last step any new node. Scenes where the walk gets stuck give none. A step is
    two joins for all scenes at once, and the state has one row for each scene.
    """
    seen = appearances.select("scene", "view", "node").distinct()
    s = F.col("scene")
    first = F.struct(questions.draw(seed, s, F.lit("start"), F.col("view")), "view")
    walk = seen.groupBy("scene").agg(F.min(first)["view"].alias("at")).withColumn("views", F.array("at"))
    walk = walk.withColumn("nodes", F.array().cast(f"array<{seen.schema['node'].dataType.simpleString()}>"))
    here = seen.select("scene", F.col("view").alias("at"), "node")
    there = seen.select("scene", "node", F.col("view").alias("to"))
    for step in range(length):
        draw = questions.draw(seed, s, F.lit(step), F.lit("node"), F.col("node"))
        fresh = walk.join(here, ["scene", "at"]).filter(~F.array_contains("nodes", F.col("node")))
        if step == length - 1:
            best = F.min(F.struct(draw, "node", "views", "nodes"))
            walk = fresh.groupBy("scene").agg(best.alias("b")).select("scene", "b.views", F.array_append("b.nodes", F.col("b.node")).alias("nodes"))
            continue
        fresh = fresh.join(there, ["scene", "node"]).filter(~F.array_contains("views", F.col("to")))
        best = F.min(F.struct(draw, "node", questions.draw(seed, s, F.lit(step), F.lit("view"), F.col("to")), "to", "views", "nodes"))
        walk = fresh.groupBy("scene").agg(best.alias("b"))
        walk = walk.select("scene", F.col("b.to").alias("at"), F.array_append("b.views", F.col("b.to")).alias("views"), F.array_append("b.nodes", F.col("b.node")).alias("nodes"))
    return walk.select("scene", F.posexplode(F.arrays_zip(F.col("views").alias("view"), F.col("nodes").alias("node"))).alias("step", "x")).select("scene", "step", "x.view", "x.node")
