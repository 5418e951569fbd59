"""Relations between the objects of a sample.

Pairs are made by one equal-key self join with ``a.object_id < b.object_id``;
both sides are the same shuffle, which Spark reuses, and adaptive execution
splits samples that are too large. Known edges are taken out by an anti join
before any geometry is computed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry2d as g

IOU = 0.5
CONTAINED = 0.8
NEAR = 100
DEAD_BAND = 0.05


def pairs(objects: DataFrame, columns: list[str], key: str = "sample_id", order: str = "object_id") -> DataFrame:
    """(key, a_*, b_*) for every pair of a sample's rows, ``a`` first in the binary order of ``order``."""
    names = dict.fromkeys([order, *columns])
    a = objects.select(key, *[F.col(c).alias(f"a_{c}") for c in names])
    b = objects.select(key, *[F.col(c).alias(f"b_{c}") for c in names])
    return a.join(b, key).filter(F.col(f"a_{order}") < F.col(f"b_{order}"))


def with_points(objects: DataFrame) -> DataFrame:
    """``objects`` with their representative point ``pu``, ``pv`` and where it comes from, ``method``.

    Done for each object before pairing, it is done once rather than for every pair,
    and keeps what a pair evaluates small enough to be compiled.
    """
    point = [F.col(c).cast("double") if c in objects.columns else F.lit(None).cast("double") for c in ("u", "v")]
    u, v, method = g.representative_point(g.columns(), *point)
    return objects.withColumns({"pu": u, "pv": v, "method": method})


def image_pairs(objects: DataFrame, key: str = "sample_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Pairs with all that ``relation_2d`` reads, and the columns ``carry`` of both sides."""
    return pairs(with_points(objects), ["x1", "y1", "x2", "y2", "pu", "pv", "method", *carry], key)


def without_edges(candidates: DataFrame, edges: DataFrame, frame: str, key: str = "sample_id") -> DataFrame:
    """Pairs (anchor first) that no edge of the frame has; an edge the other way round does not count."""
    own = edges.filter(F.col("ref_frame") == frame).select(key, F.col("anchor_id").alias("a_object_id"), F.col("target_id").alias("b_object_id"))
    return candidates.join(own.distinct(), [key, "a_object_id", "b_object_id"], "left_anti")


def with_known(candidates: DataFrame, edges: DataFrame, frame: str, key: str = "sample_id") -> DataFrame:
    """Pairs with ``known``: whether an edge of the frame has them, anchor first."""
    own = edges.filter(F.col("ref_frame") == frame).select(key, F.col("anchor_id").alias("a_object_id"), F.col("target_id").alias("b_object_id")).distinct()
    return candidates.join(own.withColumn("known", F.lit(True)), [key, "a_object_id", "b_object_id"], "left").withColumn("known", F.coalesce("known", F.lit(False)))


def relation_2d(rows: DataFrame, scale: int = 1000, iou: float = IOU, contained: float = CONTAINED, near: float = NEAR) -> DataFrame:
    """Image-plane relations of ``image_pairs``, with ``reason`` where there is none.

    Adds outcome (the predicate or the reason), predicate, components, sign_right,
    sign_above and the evidence method, au, av, bu, bv, du, dv; each rounded by itself.
    """
    a, b = g.columns("a_"), g.columns("b_")
    rows = rows.withColumns({"_du": F.col("b_pu") - F.col("a_pu"), "_dv": F.col("b_pv") - F.col("a_pv"), "method": F.concat_ws("+", "a_method", "b_method")})
    du, dv = F.col("_du"), F.col("_dv")
    d = g.scale_length(near, scale)
    boxed = a[0].isNotNull() & b[0].isNotNull()
    reason = (
        F.when(boxed & (g.iou(a, b) > iou), "high_iou")
        .when(g.distance(du, dv) < d, "near_center")
        .when(boxed & (g.containment(a, b) >= contained), "containment")
        .when((F.abs(du) < d) & (F.abs(dv) < d), "tiny_delta")
    )
    side = F.when(F.abs(du) >= d, F.when(du > 0, "right").otherwise("left"))
    level = F.when(F.abs(dv) >= d, F.when(dv > 0, "below").otherwise("above"))
    both = F.col("reason").isNull() & side.isNotNull() & level.isNotNull()
    rows = rows.withColumn("reason", reason)
    rows = rows.withColumns(
        {
            "predicate": F.when(F.col("reason").isNull(), F.coalesce(side, level)),
            "components": F.when(both, F.array(side, level)),
            "sign_right": F.when(both, F.signum(du).cast("int")),
            "sign_above": F.when(both, (-F.signum(dv)).cast("int")),
            **{c: F.bround(F.col(f)).cast("int") for c, f in (("au", "a_pu"), ("av", "a_pv"), ("bu", "b_pu"), ("bv", "b_pv"), ("du", "_du"), ("dv", "_dv"))},
        }
    )
    rows = rows.withColumn("outcome", F.coalesce("predicate", "reason"))
    return rows.drop("_du", "_dv", "a_method", "b_method")


def signs_3d(dx: Column, dy: Column, dz: Column, dead_band: float = DEAD_BAND) -> dict[str, Column]:
    """Signs of right, above and front from an offset in camera axes (y down, z away)."""
    return {"sign_right": g.sign(dx, dead_band), "sign_above": g.sign(-dy, dead_band), "sign_front": g.sign(-dz, dead_band)}


def components_3d(right: Column, above: Column, front: Column) -> Column:
    """Ordered components front or behind, right or left, above or below."""

    def one(sign: Column, plus: str, minus: str) -> Column:
        return F.when(sign > 0, plus).when(sign < 0, minus)

    each = F.array(one(front, "front", "behind"), one(right, "right", "left"), one(above, "above", "below"))
    return F.filter(each, lambda x: x.isNotNull())


def predicate_of(components: Column) -> Column:
    """The first of front, right and above among the components, else their first."""
    return F.coalesce(*[F.when(F.array_contains(components, c), F.lit(c)) for c in ("front", "right", "above")], F.get(components, 0))


def relation_3d(rows: DataFrame, dead_band: float = DEAD_BAND) -> DataFrame:
    """Egocentric relations of pairs from camera-frame centres ``a_cx`` to ``b_cz``, with ``reason`` where there is none."""
    dx, dy, dz = (F.col(f"b_c{k}") - F.col(f"a_c{k}") for k in "xyz")
    known = reduce(lambda x, y: x & y, [F.col(f"{s}_c{k}").isNotNull() for s in "ab" for k in "xyz"])
    rows = rows.withColumns(signs_3d(dx, dy, dz, dead_band))
    flat = (F.col("sign_right") == 0) & (F.col("sign_above") == 0) & (F.col("sign_front") == 0)
    rows = rows.withColumn("reason", F.when(~known, "missing_3d_geometry").when(flat, "tiny_delta_3d"))
    parts = components_3d(F.col("sign_right"), F.col("sign_above"), F.col("sign_front"))
    rows = rows.withColumn("components", F.when(F.col("reason").isNull(), parts))
    return rows.withColumns(
        {
            "predicate": predicate_of(F.col("components")),
            "front_order": F.when(dz < 0, "target_closer").when(dz > 0, "anchor_closer").otherwise("tie"),
        }
    )


def conflicts_3d(edges: DataFrame, geometry: DataFrame, most: int = 20) -> DataFrame:
    """Annotated egocentric edges whose component set differs from the geometry's; the first ``most`` of each sample.

    ``edges``: (sample_id, pos, anchor_id, target_id, source, components); ``geometry``: relation_3d's rows.
    """
    own = geometry.filter("reason is null").select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), F.col("components").alias("inferred"))
    met = edges.filter(F.col("source").startswith("annotated")).join(own, ["sample_id", "anchor_id", "target_id"])
    differ = ~F.array_sort(F.array_distinct(F.coalesce("components", F.array().cast("array<string>")))).eqNullSafe(F.array_sort(F.array_distinct("inferred")))
    rank = F.row_number().over(Window.partitionBy("sample_id").orderBy("pos"))
    return met.filter(differ).withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def strip_computed(edges: DataFrame) -> DataFrame:
    """Edges that are not ours: image_plane edges go if their source is ``computed``, egocentric ones if it starts so."""
    source = F.coalesce("source", F.lit(""))
    ours = ((F.col("ref_frame") == "image_plane") & (source == "computed")) | ((F.col("ref_frame") == "egocentric") & source.startswith("computed"))
    return edges.filter(~F.coalesce(ours, F.lit(False)))


def with_relation_ids(edges: DataFrame, key: str = "sample_id") -> DataFrame:
    """Missing relation ids filled in list order (``pos``), numbered on from the largest ``relation#n`` of the sample."""
    number = F.regexp_extract("relation_id", r"^relation#(\d+)$", 1)
    sample = Window.partitionBy(key)
    top = F.coalesce(F.max(F.when(number != "", number.cast("long"))).over(sample), F.lit(-1))
    missing = F.col("relation_id").isNull() | (F.col("relation_id") == "")
    rank = F.row_number().over(Window.partitionBy(key, missing).orderBy("pos"))
    return edges.withColumn("relation_id", F.when(missing, F.concat(F.lit("relation#"), (top + rank).cast("string"))).otherwise(F.col("relation_id")))


def stats_2d(objects: DataFrame, derived: DataFrame) -> DataFrame:
    """(sample_id, n_in, n_kept, n_pairs, n_skipped, n_relations) from flagged objects, and derived pairs with ``known``: one pass over each."""
    n = objects.groupBy("sample_id").agg(F.count("*").alias("n_in"), F.count_if(F.col("reason").isNull()).alias("n_kept"))
    new = ~F.col("known")
    p = derived.groupBy("sample_id").agg(
        F.count_if(new).alias("n_pairs"), F.count_if(F.col("known")).alias("n_skipped"), F.count_if(new & F.col("reason").isNull()).alias("n_relations")
    )
    return n.join(p, "sample_id", "left").na.fill(0, ["n_pairs", "n_skipped", "n_relations"]).select("sample_id", "n_in", "n_kept", "n_pairs", "n_skipped", "n_relations")
