"""Rule cases of image-plane and egocentric relations, object filters and deduplication."""

import pytest

from vistaloom.operators import dedup, objects, relations

BOX = ["x1", "y1", "x2", "y2"]
DDL = "sample_id long, pos int, object_id string, x1 int, y1 int, x2 int, y2 int, u double, v double"


def pair(spark, a, b, scale=1000, ids=("a#0", "b#0")):
    def row(i, name, g):
        return (1, i, name, *(g if len(g) == 4 else [None] * 4), *(map(float, g) if len(g) == 2 else [None, None]))

    rows = spark.createDataFrame([row(0, ids[0], a), row(1, ids[1], b)], DDL)
    out = relations.relation_2d(relations.image_pairs(rows), scale=scale).collect()
    assert len(out) == 1
    return out[0]


@pytest.mark.parametrize(
    "a, b, outcome, components",
    [
        ((100, 100, 120, 140), (400, 100, 420, 140), "right", None),
        ((200, 300, 240, 360), (200, 50, 240, 90), "above", None),
        ((50, 50, 80, 80), (400, 200, 430, 230), "right", ["right", "below"]),
        ((100, 200, 150, 250), (300, 205, 350, 245), "right", None),
        ((100, 100, 130, 130), (300, 280, 330, 310), "right", ["right", "below"]),
        ((0, 0, 100, 100), (1, 1, 99, 99), "high_iou", None),
        ((0, 0, 900, 900), (10, 10, 110, 110), "containment", None),
        ((0, 0, 200, 200), (90, 90, 110, 110), "near_center", None),
        ((0, 0, 10, 10), (99, 99, 109, 109), "tiny_delta", None),
        ((100, 100), (400, 120), "right", None),
    ],
)
def test_rules_2d(spark, a, b, outcome, components):
    r = pair(spark, a, b)
    assert r.outcome == outcome and r.components == components
    if len(a) == 2:
        assert r.method == "point_uv+point_uv"


def test_anchor_is_the_smaller_id_and_scale_moves_thresholds(spark):
    r = pair(spark, (100, 100, 120, 140), (400, 100, 420, 140), ids=("z#0", "a#0"))
    assert (r.a_object_id, r.b_object_id, r.predicate) == ("a#0", "z#0", "left")
    assert pair(spark, (50, 50, 80, 80), (125, 50, 155, 80), scale=500).predicate == "right"


def test_box_and_point_is_an_error(spark):
    rows = spark.createDataFrame([(1, 0, "a", 0, 0, 9, 9, 1.0, 1.0)], DDL)
    with pytest.raises(Exception, match="box and a point"):
        objects.with_drop_reasons(rows).collect()


def test_known_edges_are_skipped_in_their_direction_alone(spark):
    rows = spark.createDataFrame([(1, i, n, i * 300, 0, i * 300 + 50, 50, None, None) for i, n in enumerate("abc")], DDL)
    edges = spark.createDataFrame([(1, "a", "b", "image_plane"), (1, "c", "b", "image_plane"), (1, "a", "c", "egocentric")], "sample_id long, anchor_id string, target_id string, ref_frame string")
    left = relations.without_edges(relations.pairs(rows, BOX), edges, "image_plane")
    assert sorted((r.a_object_id, r.b_object_id) for r in left.collect()) == [("a", "c"), ("b", "c")]


def test_object_filters(spark):
    rows = [
        (1, 0, "a", 10, 10, 10, 50, None, None),
        (1, 1, "b", -1, 0, 50, 50, None, None),
        (1, 2, "c", 0, 0, 100, 2, None, None),
        (1, 3, "d", None, None, None, None, 1500.0, 10.0),
        (1, 4, "e", None, None, None, None, None, None),
        (1, 5, "obj#10", 0, 0, 100, 100, None, None),
        (1, 6, "obj#2", 0, 0, 100, 100, None, None),
        (1, 7, "f", None, None, None, None, 3.0, 3.0),
        (1, 8, "g", 0, 0, 10, 10, None, None),
    ]
    got = {r.object_id: r.reason for r in objects.with_drop_reasons(spark.createDataFrame(rows, DDL), min_area_frac=0.5, max_objects=2).collect()}
    assert got == {"a": "geom_invalid", "b": "out_of_bounds", "c": "aspect_ratio", "d": "out_of_bounds", "e": "no_geometry", "obj#10": None, "obj#2": None, "f": "cap_exceeded", "g": "min_area_frac"}


def test_relations_3d(spark):
    ddl = "sample_id long, object_id string, cx double, cy double, cz double"
    rows = spark.createDataFrame([(1, "a", 0.0, 0.0, 2.0), (1, "b", 1.0, -1.0, 1.0), (1, "c", None, 0.0, 0.0), (1, "d", 0.01, 0.02, 2.0)], ddl)
    got = {(r.a_object_id, r.b_object_id): r for r in relations.relation_3d(relations.pairs(rows, ["cx", "cy", "cz"])).collect()}
    r = got["a", "b"]
    assert r.components == ["front", "right", "above"] and (r.sign_right, r.sign_above, r.sign_front) == (1, 1, 1) and r.front_order == "target_closer"
    assert got["a", "c"].reason == "missing_3d_geometry" and got["a", "d"].reason == "tiny_delta_3d"
    edges = spark.createDataFrame([(1, 0, "a", "b", "annotated_3d", ["left"]), (1, 1, "b", "d", "computed_3d", ["left"])], "sample_id long, pos int, anchor_id string, target_id string, source string, components array<string>")
    geometry = relations.relation_3d(relations.pairs(rows, ["cx", "cy", "cz"]))
    assert [(r.anchor_id, r.target_id) for r in relations.conflicts_3d(edges, geometry).collect()] == [("a", "b")]


def test_predicates_of_components(spark):
    from pyspark.sql import functions as F

    cases = {("behind", "right"): "right", ("behind", "left"): "behind", ("front", "left"): "front", ("left", "above"): "above"}
    for parts, want in cases.items():
        assert spark.range(1).select(relations.predicate_of(F.array(*map(F.lit, parts)))).first()[0] == want


def test_relation_ids(spark):
    rows = [(1, 0, None), (1, 1, "relation#4"), (1, 2, "own"), (1, 3, None), (2, 0, None)]
    got = relations.with_relation_ids(spark.createDataFrame(rows, "sample_id long, pos int, relation_id string"))
    assert sorted((r.sample_id, r.pos, r.relation_id) for r in got.collect()) == [(1, 0, "relation#5"), (1, 1, "relation#4"), (1, 2, "own"), (1, 3, "relation#6"), (2, 0, "relation#0")]


def test_dedup_and_queries(spark):
    ddl = "sample_id long, pos int, object_id string, phrase string, x1 int, y1 int, x2 int, y2 int"
    rows = spark.createDataFrame(
        [(1, 0, "a", "cup", 0, 0, 9, 9), (1, 1, "b", "cup", 0, 0, 9, 9), (1, 2, "c", "mug", 0, 0, 9, 9), (1, 3, "d", "", 0, 0, 9, 9), (1, 4, "a", "x", 5, 5, 9, 9), (1, 5, None, "y", 1, 1, 2, 2), (1, 6, "e", "n", None, 0, 9, 9)], ddl
    )
    assert sorted(r.object_id for r in dedup.dedup_objects(rows).collect()) == ["a", "c", "d", "e"]
    assert sorted(r.object_id for r in dedup.dedup_objects(rows, by_phrase=False).collect()) == ["a", "e"]
    assert dedup.dedup_objects(dedup.dedup_objects(rows)).count() == 4
    q = spark.createDataFrame([(1, "q0", ["b", "a", "a"], "b", 3), (1, "q1", ["b"], None, 1), (1, "q2", ["c", "b"], None, None)], "sample_id long, query_id string, candidates array<string>, gold string, count int")
    got = {r.query_id: (r.candidates, r.gold, r["count"]) for r in dedup.rewrite_queries(q, dedup.dedup_objects(rows)).collect()}
    assert got == {"q0": (["a"], "a", 1), "q2": (["c"], "c", None)}


@pytest.mark.parametrize("parts", [1, 13])
def test_pairs_do_not_depend_on_partitions(spark, sf_dir, parts):
    from vistaloom.plans import views

    rows = views.objects(spark, sf_dir).repartition(parts)
    n = {r.sample_id: r["count"] for r in rows.groupBy("sample_id").count().collect()}
    out = relations.relation_2d(relations.image_pairs(rows))
    assert out.count() == sum(k * (k - 1) // 2 for k in n.values())
    assert out.filter("outcome is null").count() == 0
