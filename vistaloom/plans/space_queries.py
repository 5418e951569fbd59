"""Geometry in space, point clouds, questions and views over the canonical views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vistaloom.functions import direction
from vistaloom.functions import geometry3d as g
from vistaloom.operators import multiview, points, qa_geometry, questions, relations, reshape, stats
from vistaloom.plans import relation_queries as rel
from vistaloom.plans import views
from vistaloom.plans.registry import Registry

query = Registry()
V = f"WITH {views.OBJECTS}"
VA = f"WITH {views.OBJECTS}, {views.APPEARANCES}"

#: Objects as turned boxes, in SQL.
BOXES = f"""{V}, v_box AS (SELECT *, l_quantity / 10 AS xl, p_size / 8.0::DOUBLE AS yl, (l_partkey % 7 + 1) / 4 AS zl, (l_partkey % 12) / 4 AS ta, (l_suppkey % 6) / 5 - 0.5::DOUBLE AS tb, (pos % 5) / 3 AS tc FROM v_object),
v_rot AS (SELECT *, cos(tc) * cos(ta) + sin(tc) * sin(tb) * sin(ta) AS r00, sin(tc) * sin(tb) * cos(ta) - cos(tc) * sin(ta) AS r01, sin(tc) * cos(tb) AS r02, cos(tb) * sin(ta) AS r10, cos(tb) * cos(ta) AS r11, -sin(tb) AS r12,
  cos(tc) * sin(tb) * sin(ta) - sin(tc) * cos(ta) AS r20, sin(tc) * sin(ta) + cos(tc) * sin(tb) * cos(ta) AS r21, cos(tc) * cos(tb) AS r22 FROM v_box)"""
_ZMAX = "cz + (abs(r20) * xl + abs(r21) * yl + abs(r22) * zl) / 2"


def boxes(spark, sf_dir):
    k = F.col("l_partkey")
    return views.objects(spark, sf_dir).withColumns(
        {
            "xl": F.col("l_quantity") / 10,
            "yl": F.col("p_size") / 8.0,
            "zl": (k % 7 + 1) / 4,
            "ta": (k % 12) / 4,
            "tb": (F.col("l_suppkey") % 6) / 5 - 0.5,
            "tc": (F.col("pos") % 5) / 3,
        }
    )


CENTER, SIZE, ANGLES = ("cx", "cy", "cz"), ("xl", "yl", "zl"), ("ta", "tb", "tc")


def _c(names):
    return [F.col(n) for n in names]


def _r(*columns):
    return [F.round(c, 6).alias(n) for n, c in columns]


@query(f"{BOXES} SELECT sample_id, pos, k, round(cx + r00 * sx * xl + r01 * sy * yl + r02 * sz * zl, 6) AS x, round(cy + r10 * sx * xl + r11 * sy * yl + r12 * sz * zl, 6) AS y, round(cz + r20 * sx * xl + r21 * sy * yl + r22 * sz * zl, 6) AS z FROM (SELECT *, unnest(range(0, 8)) AS k, unnest([-0.5, -0.5, -0.5, -0.5, 0.5, 0.5, 0.5, 0.5]) AS sx, unnest([-0.5, -0.5, 0.5, 0.5, -0.5, -0.5, 0.5, 0.5]) AS sy, unnest([-0.5, 0.5, -0.5, 0.5, -0.5, 0.5, -0.5, 0.5]) AS sz FROM v_rot)")
def box_corners(spark, sf_dir):
    """The corners of turned boxes."""
    rows = boxes(spark, sf_dir)
    each = F.array(*[F.struct(*[v.alias(n) for n, v in zip("xyz", p, strict=True)]) for p in g.corners(_c(CENTER), _c(SIZE), _c(ANGLES))])
    rows = rows.select("sample_id", "pos", F.posexplode(each).alias("k", "p"))
    return rows.select("sample_id", "pos", F.col("k").cast("long").alias("k"), *_r(("x", F.col("p.x")), ("y", F.col("p.y")), ("z", F.col("p.z"))))


@query(f"{BOXES} SELECT sample_id, pos, round({_ZMAX}, 6) AS z_max, round(xl * yl * zl, 6) AS volume, greatest(xl, yl, zl) AS extent FROM v_rot")
def box_zmax(spark, sf_dir):
    """Height, volume and largest extent of turned boxes."""
    return boxes(spark, sf_dir).select("sample_id", "pos", *_r(("z_max", g.top(_c(CENTER), _c(SIZE), _c(ANGLES))), ("volume", g.volume(_c(SIZE)))), F.greatest(*SIZE).alias("extent"))


@query(f"{BOXES} SELECT a.sample_id, a.object_id AS a, b.object_id AS b, CASE WHEN a.z > b.z THEN 'A' ELSE 'B' END AS higher FROM (SELECT *, {_ZMAX} AS z FROM v_rot) a JOIN (SELECT *, {_ZMAX} AS z FROM v_rot) b ON a.sample_id = b.sample_id AND a.object_id < b.object_id WHERE abs(a.z - b.z) > 1e-9")
def height_compare(spark, sf_dir):
    """Which object of a pair reaches higher."""
    rows = boxes(spark, sf_dir).withColumn("z", g.top(_c(CENTER), _c(SIZE), _c(ANGLES)))
    rows = relations.pairs(rows, ["z"]).filter(F.abs(F.col("a_z") - F.col("b_z")) > 1e-9)
    return rows.select("sample_id", F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"), questions.farther(F.col("a_z"), F.col("b_z")).alias("higher"))


@query(f"{BOXES} SELECT a.sample_id, a.object_id AS a, b.object_id AS b, a.xl * a.yl * a.zl > b.xl * b.yl * b.zl AS bigger, a.xl * a.yl * a.zl < b.xl * b.yl * b.zl AS smaller FROM v_box a JOIN v_box b ON a.sample_id = b.sample_id AND a.object_id < b.object_id")
def size_compare(spark, sf_dir):
    """Whether the first object of a pair is bigger, and whether smaller."""
    rows = relations.pairs(boxes(spark, sf_dir).withColumn("v", g.volume(_c(SIZE))), ["v"])
    return rows.select("sample_id", F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"), (F.col("a_v") > F.col("b_v")).alias("bigger"), (F.col("a_v") < F.col("b_v")).alias("smaller"))


@query(
    f"""{BOXES}, d AS (SELECT a.sample_id, a.object_id AS a, b.object_id AS b, sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2 + (a.cz - b.cz) ** 2) / ((greatest(a.xl, a.yl, a.zl) + greatest(b.xl, b.yl, b.zl)) / 2) AS ratio
FROM v_box a JOIN v_box b ON a.sample_id = b.sample_id AND a.object_id < b.object_id AND a.category <> b.category) SELECT sample_id, a, b, CASE WHEN ratio < 0.5 THEN 'next' ELSE 'far' END AS answer FROM d WHERE ratio < 0.5 OR ratio > 2"""
)
def proximity(spark, sf_dir):
    """Pairs of different tags that are next to each other or far apart."""
    rows = relations.pairs(boxes(spark, sf_dir).withColumn("extent", F.greatest(*SIZE)), [*CENTER, "extent", "category"]).filter("a_category != b_category")
    d = g.norm(g.minus(_c([f"a_{c}" for c in CENTER]), _c([f"b_{c}" for c in CENTER])))
    rows = rows.withColumn("answer", questions.proximity(d, F.col("a_extent"), F.col("b_extent"))).filter("answer is not null")
    return rows.select("sample_id", F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"), "answer")


def _pose(spark, sf_dir):
    """Objects with a camera pose of their own."""
    rows = boxes(spark, sf_dir)
    return rows, g.rotation(F.col("tc"), F.col("tb"), F.col("ta")), [F.col("xl"), F.col("yl"), F.col("zl")]


_POSE = f"""{BOXES}, v_pose AS (SELECT *, cos(ta) * cos(tc) + sin(ta) * sin(tb) * sin(tc) AS p00, sin(ta) * sin(tb) * cos(tc) - cos(ta) * sin(tc) AS p01, sin(ta) * cos(tb) AS p02, cos(tb) * sin(tc) AS p10, cos(tb) * cos(tc) AS p11, -sin(tb) AS p12,
  cos(ta) * sin(tb) * sin(tc) - sin(ta) * cos(tc) AS p20, sin(ta) * sin(tc) + cos(ta) * sin(tb) * cos(tc) AS p21, cos(ta) * cos(tb) AS p22 FROM v_rot)"""


@query(f"{_POSE} SELECT sample_id, pos, round(p00 * (cx - xl) + p10 * (cy - yl) + p20 * (cz - zl), 6) AS x, round(p01 * (cx - xl) + p11 * (cy - yl) + p21 * (cz - zl), 6) AS y, round(p02 * (cx - xl) + p12 * (cy - yl) + p22 * (cz - zl), 6) AS z FROM v_pose")
def world_to_cam(spark, sf_dir):
    """World points in camera frames."""
    rows, pose, t = _pose(spark, sf_dir)
    p = g.world_to_cam(pose, t, _c(CENTER))
    return rows.select("sample_id", "pos", *_r(*zip("xyz", p, strict=True)))


@query(f"{_POSE} SELECT sample_id, pos, round(p00 * cx + p01 * cy + p02 * cz + xl, 6) AS x, round(p10 * cx + p11 * cy + p12 * cz + yl, 6) AS y, round(p20 * cx + p21 * cy + p22 * cz + zl, 6) AS z FROM v_pose")
def cam_to_world(spark, sf_dir):
    """Camera points in the world."""
    rows, pose, t = _pose(spark, sf_dir)
    return rows.select("sample_id", "pos", *_r(*zip("xyz", g.cam_to_world(pose, t, _c(CENTER)), strict=True)))


@query(f"{BOXES} SELECT sample_id, pos, round((x1 - 320) * cz / 500, 6) AS x, round((y1 - 240) * cz / 510, 6) AS y, round(500 * cx / cz + 320, 6) AS u, round(510 * cy / cz + 240, 6) AS v FROM v_box WHERE cz > 0")
def backproject(spark, sf_dir):
    """Pixels to points, and points to pixels."""
    k = [F.lit(float(x)) for x in (500, 510, 320, 240)]
    p = g.backproject(F.col("x1"), F.col("y1"), F.col("cz"), *k)
    u, v = g.project(_c(CENTER), *k)
    return boxes(spark, sf_dir).filter("cz > 0").select("sample_id", "pos", *_r(("x", p[0]), ("y", p[1]), ("u", u), ("v", v)))


@query(f"{BOXES} SELECT sample_id, pos, round(degrees(2 * atan2(640, 2 * (100 + x1)::DOUBLE)), 6) AS fov FROM v_box")
def fov(spark, sf_dir):
    """Fields of view."""
    return boxes(spark, sf_dir).select("sample_id", "pos", F.round(g.field_of_view(F.lit(640), 100 + F.col("x1")), 6).alias("fov"))


@query(f"{BOXES} SELECT sample_id, pos, round(atan2(r10, r11), 6) AS a, round(asin(greatest(-1, least(1, -r12))), 6) AS b, round(atan2(r02, r22), 6) AS c, round(degrees(acos(greatest(-1, least(1, (r00 + r11 + r22 - 1) / 2)))), 5) AS turn FROM v_rot")
def euler_zxy(spark, sf_dir):
    """Angles back from rotations, and how far they turn."""
    m = g.rotation(*_c(ANGLES))
    one = [[F.lit(float(i == j)) for j in range(3)] for i in range(3)]
    a, b, c = g.euler(m)
    return boxes(spark, sf_dir).select("sample_id", "pos", *_r(("a", a), ("b", b), ("c", c)), F.round(g.rotation_angle(m, one), 5).alias("turn"))


@query(f"{BOXES} SELECT sample_id, pos, (1 + x1 / 100) * 639 / 2 AS fx, 639 / 2 AS px, greatest(0, least(65535, floor(cz * 500 / sqrt((x1 - 320)::DOUBLE * (x1 - 320) + (y1 - 240)::DOUBLE * (y1 - 240) + 500 * 500) * 1000)))::INT AS depth FROM v_box")
def intrinsics(spark, sf_dir):
    """Pixel intrinsics and planar depth."""
    rows = boxes(spark, sf_dir)
    fx, _, cx, _ = g.pixel_intrinsics(1 + F.col("x1") / 100, F.lit(1.0), F.lit(640), F.lit(480))
    depth = g.planar_depth(F.col("cz"), (F.col("x1") - 320).cast("double"), (F.col("y1") - 240).cast("double"), F.lit(500.0))
    return rows.select("sample_id", "pos", fx.alias("fx"), cx.alias("px"), depth.alias("depth"))


_ANGLE = "degrees(atan2(b.cx - a.cx, b.cy - a.cy))"


@query(
    f"""{V}, p AS (SELECT {_ANGLE} AS t FROM v_object a JOIN v_object b ON a.sample_id = b.sample_id AND a.object_id < b.object_id)
SELECT direction, count(*) AS n FROM (SELECT CASE WHEN t > 165 OR t <= -165 THEN 'back' WHEN t > -15 AND t <= 15 THEN 'front' WHEN t > 15 AND t <= 75 THEN 'front-right' WHEN t > 75 AND t <= 105 THEN 'right' WHEN t > 105 AND t <= 165 THEN 'back-right'
  WHEN t > -165 AND t <= -105 THEN 'back-left' WHEN t > -105 AND t <= -75 THEN 'left' ELSE 'front-left' END AS direction FROM p) GROUP BY direction"""
)
def compass_direction(spark, sf_dir):
    """Pairs by the compass direction between them."""
    rows = relations.pairs(views.objects(spark, sf_dir), ["cx", "cy"])
    d = direction.compass(F.col("b_cx") - F.col("a_cx"), F.col("b_cy") - F.col("a_cy"))
    return rows.groupBy(d.alias("direction")).agg(F.count("*").alias("n"))


def _cloud(spark, sf_dir):
    """Points of 16 objects from the first dimensions of the embeddings."""
    e = views.read(spark, sf_dir, "embeddings")
    return e.select((F.col("vec_id") % 16).alias("object"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])


_CLOUD = "v_point AS (SELECT vec_id % 16 AS object, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"
_DIST = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z))"


def _object_pairs(spark):
    ids = spark.range(16)
    return ids.select(F.col("id").alias("a"), F.explode(F.sequence(F.col("id") + 1, F.lit(16))).alias("b"))


@query(f"WITH {_CLOUD} SELECT a, b, round(coalesce(d, 'inf'::DOUBLE), 6) AS distance FROM (SELECT i AS a, unnest(range(i + 1, 17)) AS b FROM (SELECT unnest(range(0, 16)) AS i)) LEFT JOIN (SELECT p.object AS a, q.object AS b, min({_DIST}) AS d FROM v_point p JOIN v_point q ON p.object < q.object GROUP BY ALL) USING (a, b) WHERE b < 16")
def nn_distance(spark, sf_dir):
    """The least distance of every two point clouds."""
    rows = points.min_distances(_cloud(spark, sf_dir), _object_pairs(spark).filter("b < 16"))
    return rows.select("a", "b", F.round("distance", 6).alias("distance"))


@query(f"WITH {_CLOUD} SELECT p.object AS a, q.object AS b, count(*) AS n FROM v_point p JOIN v_point q ON p.object < q.object AND {_DIST} <= 0.05 GROUP BY ALL")
def points_within(spark, sf_dir):
    """How many points of two clouds correspond."""
    p = _cloud(spark, sf_dir)
    rows = points.pairs_within(p, p, 0.05).filter("a_object < b_object")
    return rows.groupBy(F.col("a_object").alias("a"), F.col("b_object").alias("b")).agg(F.count("*").alias("n"))


@query(f"WITH {_CLOUD}, d AS (SELECT p.object AS a, q.object AS b, min({_DIST}) AS d FROM v_point p JOIN v_point q ON p.object <> q.object GROUP BY ALL) SELECT x.b AS c, x.a AS a, y.a AS b, CASE WHEN x.d > y.d THEN 'A' ELSE 'B' END AS farther FROM d x JOIN d y ON x.b = y.b AND x.a < y.a")
def relative_distance(spark, sf_dir):
    """Which of two objects is farther from a third."""
    every = _object_pairs(spark).filter("b < 16")
    near = points.min_distances(_cloud(spark, sf_dir), every)
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance")).filter("distance < double('inf')")
    x = both.select("a", F.col("b").alias("c"), F.col("distance").alias("dx"))
    y = both.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("distance").alias("dy"))
    return x.join(y, "c").filter("a < b").select("c", "a", "b", questions.farther(F.col("dx"), F.col("dy")).alias("farther"))


@query(f"{V}, d AS (SELECT sample_id, object_id, sqrt(cx * cx + cy * cy + cz * cz) AS d FROM v_object) SELECT sample_id, min_by(object_id, (d, object_id)) AS closest, max_by(object_id, (d, object_id)) AS farthest FROM d GROUP BY sample_id")
def farthest_closest(spark, sf_dir):
    """The closest and the farthest object of each sample."""
    rows = views.objects(spark, sf_dir).withColumn("k", F.struct(g.norm(_c(CENTER)).alias("d"), "object_id"))
    return rows.groupBy("sample_id").agg(F.min("k")["object_id"].alias("closest"), F.max("k")["object_id"].alias("farthest"))


@query("SELECT l_suppkey, round(avg(d), 6) AS depth FROM (SELECT l_suppkey, l_extendedprice / 1000 AS d, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem WHERE l_extendedprice > 0) WHERE k <= greatest(1, trunc(n * 0.1)) GROUP BY l_suppkey")
def depth_top10(spark, sf_dir):
    """The mean of the nearest tenth of each object's depths."""
    rows = views.read(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_extendedprice") / 1000).alias("d"))
    return stats.shallow_mean(rows, ["l_suppkey"], "d").select("l_suppkey", F.round("mean", 6).alias("depth"))


@query(f"{V} SELECT sample_id, string_agg(object_id, ',' ORDER BY cz, object_id) AS near_to_far, CASE WHEN count(*) >= 2 THEN (list(object_id ORDER BY cz, object_id))[2] END AS second FROM v_object GROUP BY sample_id")
def depth_order(spark, sf_dir):
    """Objects from near to far, and the second nearest."""
    rows = views.objects(spark, sf_dir).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("cz", "object_id"))).alias("o"))
    return rows.select("sample_id", F.array_join("o.object_id", ",").alias("near_to_far"), F.get("o.object_id", F.lit(1)).alias("second"))


@query(f"{V} SELECT a.sample_id, a.object_id AS a, b.object_id AS b, CASE WHEN abs(a.d - b.d) < 0.08 THEN 'C' WHEN a.d < b.d THEN 'A' ELSE 'B' END AS nearer FROM (SELECT *, sqrt(cx * cx + cy * cy + cz * cz) AS d FROM v_object) a JOIN (SELECT *, sqrt(cx * cx + cy * cy + cz * cz) AS d FROM v_object) b ON a.sample_id = b.sample_id AND a.object_id < b.object_id")
def objcam_distance(spark, sf_dir):
    """Which object of a pair is nearer to the camera."""
    rows = relations.pairs(views.objects(spark, sf_dir).withColumn("d", g.norm(_c(CENTER))), ["d"])
    return rows.select("sample_id", F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"), questions.camera_answer(F.col("a_d"), F.col("b_d")).alias("nearer"))


_CAND = f"""{rel.R2[:-1]}, e AS (SELECT sample_id, a_id AS anchor_id, b_id AS target_id, predicate, parts, round_even(du, 0) AS du, round_even(dv, 0) AS dv, row_number() OVER (PARTITION BY sample_id ORDER BY a_id, b_id) AS pos FROM v_out WHERE reason IS NULL),
nm AS (SELECT sample_id, object_id, count(*) OVER (PARTITION BY sample_id, lower(regexp_replace(trim(phrase), '^(?:the|a|an)\\s+', '', 'i'))) = 1 AS uniq FROM v_object),
cand AS (SELECT e.*, CASE WHEN x.uniq AND y.uniq THEN 0 WHEN x.uniq OR y.uniq THEN 1 ELSE 2 END AS mark_tier FROM e JOIN nm x ON x.sample_id = e.sample_id AND x.object_id = anchor_id JOIN nm y ON y.sample_id = e.sample_id AND y.object_id = target_id)"""


def _candidates(spark, sf_dir):
    """Relations that can be asked about; what that takes to know of the objects travels through the pair join."""
    return questions.usable(asked_relations(spark, sf_dir))


def asked_relations(spark, sf_dir):
    """Relations with ``questions.ASKED`` of anchor and target, in the order of their ids."""
    rows = relations.relation_2d(relations.image_pairs(questions.named(views.objects(spark, sf_dir)), carry=questions.ASKED)).filter("reason is null")
    sides = [F.col(f"{s}_{c}").alias(f"{p}_{c}") for s, p in (("a", "anchor"), ("b", "target")) for c in questions.ASKED]
    rows = rows.select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "predicate", "components", "du", "dv", *sides)
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy("sample_id").orderBy("anchor_id", "target_id")))


@query(f"{_CAND} SELECT sample_id, anchor_id, target_id, mark_tier FROM cand")
def candidate_relations(spark, sf_dir):
    """Relations that can be asked about, with how many names need a mark."""
    return _candidates(spark, sf_dir).select("sample_id", "anchor_id", "target_id", "mark_tier")


@query(
    f"""{_CAND}, k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY mark_tier, pos) AS k FROM cand)
SELECT sample_id, anchor_id, target_id, CASE WHEN k <= 2 THEN 'single_axis' WHEN k <= 4 THEN 'full_sentence' ELSE 'judgment' END AS style FROM k WHERE k <= 6"""
)
def style_allocation(spark, sf_dir):
    """Which style each relation is used for."""
    rows = questions.allocated(_candidates(spark, sf_dir), {"single_axis": 2, "full_sentence": 2, "judgment": 2})
    return rows.select("sample_id", "anchor_id", "target_id", "style")


_U = "(('0x' || md5('{}|' || sample_id || '|' || anchor_id || '|' || target_id)[:13])::BIGINT / 4503599627370496)"


@query(
    f"""{_CAND}, u AS (SELECT *, {_U.format(7)} AS u, abs(du) AS a, abs(dv) AS b, split_part(parts, ',', 1) AS c1, split_part(parts, ',', 2) AS c2 FROM cand),
t AS (SELECT *, CASE WHEN parts IS NULL THEN predicate WHEN abs(a - b) / greatest(a, b) <= 0.2 THEN (CASE WHEN u < a / (a + b) THEN c1 ELSE c2 END) WHEN a >= b THEN c1 ELSE c2 END AS truth FROM u)
SELECT sample_id, anchor_id, target_id, truth, CASE WHEN truth IN ('left', 'right') THEN 'horizontal' ELSE 'vertical' END AS axis FROM t"""
)
def single_axis_truth(spark, sf_dir):
    """The axis and answer of single-axis questions."""
    u = questions.draw(7, F.col("sample_id"), F.col("anchor_id"), F.col("target_id"))
    truth = questions.single_axis_truth(F.col("components"), F.col("predicate"), F.col("du"), F.col("dv"), u)
    rows = _candidates(spark, sf_dir).withColumn("truth", truth)
    return rows.select("sample_id", "anchor_id", "target_id", "truth", questions.axis_of(F.col("truth")).alias("axis"))


@query(
    f"""{_CAND}, u AS (SELECT *, {_U.format(8)} AS u, coalesce(parts IS NOT NULL AND least(abs(du), abs(dv)) / greatest(abs(du), abs(dv)) >= 0.75, false) AS ok FROM cand),
m AS (SELECT *, u * (CASE WHEN ok THEN 1.0 ELSE 0.85 END)::DOUBLE AS w FROM u)
SELECT sample_id, anchor_id, target_id, ok AS partial, CASE WHEN w < 0.5 THEN 'incorrect' WHEN ok AND w < 0.65 THEN 'partial' ELSE 'correct' END AS mode FROM m"""
)
def judgment_answer(spark, sf_dir):
    """Which judgments may be partly right, and which statement is made."""
    u = questions.draw(8, F.col("sample_id"), F.col("anchor_id"), F.col("target_id"))
    rows = _candidates(spark, sf_dir).withColumn("partial", F.coalesce(questions.allows_partial(F.col("components"), F.col("du"), F.col("dv")), F.lit(False)))
    return rows.select("sample_id", "anchor_id", "target_id", "partial", questions.judgment_mode(F.col("partial"), u).alias("mode"))


@query(f"{V} SELECT sample_id, category, count(*)::VARCHAR AS answer, category || 's' AS plural FROM v_object GROUP BY ALL HAVING count(*) > 1")
def counting_answer(spark, sf_dir):
    """Counting questions and their answers."""
    rows = stats.duplicate_tags(views.objects(spark, sf_dir), "category")
    return rows.select("sample_id", "category", F.col("n").cast("string").alias("answer"), F.concat("category", F.lit("s")).alias("plural"))


@query(
    f"""{V}, c AS (SELECT sample_id, category, count(*) AS n FROM v_object GROUP BY ALL HAVING count(*) > 1), w AS (SELECT *, unnest(range(greatest(0, n - 5), n + 6)) AS x FROM c),
d AS (SELECT *, ('0x' || md5('3|' || sample_id || '|' || category || '|' || x)[:13])::BIGINT / 4503599627370496 AS d FROM w WHERE x <> n), r AS (SELECT *, row_number() OVER (PARTITION BY sample_id, category ORDER BY d, x) AS k FROM d)
SELECT sample_id, category, string_agg(x::VARCHAR, ',' ORDER BY k) AS wrong FROM r WHERE k <= 3 GROUP BY ALL"""
)
def wrong_counts(spark, sf_dir):
    """Three wrong counts for each counting question."""
    rows = stats.duplicate_tags(views.objects(spark, sf_dir), "category")
    return rows.select("sample_id", "category", F.array_join(questions.wrong_counts(F.col("n"), 3, F.col("sample_id"), F.col("category")), ",").alias("wrong"))


@query(f"{VA} SELECT scene, node, min_by(tag, (view, pos)) AS tag, string_agg(view::VARCHAR, ',' ORDER BY view, pos) AS views FROM v_app GROUP BY scene, node")
def node_identity(spark, sf_dir):
    """Distinct nodes of a scene with the views that see them."""
    rows = views.appearances(spark, sf_dir).withColumn("at", F.struct("view", "pos"))
    rows = rows.groupBy("scene", "node").agg(F.min_by("tag", "at").alias("tag"), F.array_sort(F.collect_list("at")).alias("v"))
    return rows.select("scene", "node", "tag", F.array_join("v.view", ",").alias("views"))


@query(f"{VA} SELECT scene, node, count(DISTINCT view) AS n_views FROM v_app GROUP BY ALL HAVING count(DISTINCT view) >= 2")
def view_count_having(spark, sf_dir):
    """Nodes that several views see."""
    return multiview.seen_often(views.appearances(spark, sf_dir), 2)


@query(f"{VA}, d AS (SELECT DISTINCT scene, p.tag AS node, view FROM v_app p) SELECT x.scene, x.view AS a, y.view AS b, count(*) AS n FROM d x JOIN d y ON x.scene = y.scene AND x.node = y.node AND x.view < y.view GROUP BY ALL")
def overlapping_views(spark, sf_dir):
    """View pairs that see something in common."""
    return multiview.shared_views(views.appearances(spark, sf_dir).withColumn("node", F.col("tag")))


_V_DRAW = "(('0x' || md5('5|' || scene || '|{}|' || {})[:13])::BIGINT / 4503599627370496)"


def _walk_sql() -> str:
    """Three steps of the walk, one table for each."""
    first, at = _V_DRAW.format("start", "view"), "list_contains"
    parts = [f"{VA}, s AS (SELECT DISTINCT scene, view, tag AS node FROM v_app)", f"w0 AS (SELECT scene, min_by(view, ({first}, view)) AS at, [min_by(view, ({first}, view))] AS views, []::VARCHAR[] AS nodes FROM s GROUP BY scene)"]
    for k in (0, 1):
        node, view = _V_DRAW.format(f"{k}|node", "node"), _V_DRAW.format(f"{k}|view", "to_")
        parts.append(f"c{k} AS (SELECT w.scene, a.node, b.view AS to_, views, nodes FROM w{k} w JOIN s a ON a.scene = w.scene AND a.view = w.at JOIN s b ON b.scene = w.scene AND b.node = a.node WHERE NOT {at}(nodes, a.node) AND NOT {at}(views, b.view))")
        parts.append(f"r{k} AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY {node}, node, {view}, to_) AS k FROM c{k})")
        parts.append(f"w{k + 1} AS (SELECT scene, to_ AS at, list_append(views, to_) AS views, list_append(nodes, node) AS nodes FROM r{k} WHERE k = 1)")
    node = _V_DRAW.format("2|node", "s.node").replace("|| scene", "|| s.scene")
    parts.append(f"r2 AS (SELECT s.scene, views, list_append(nodes, s.node) AS nodes, row_number() OVER (PARTITION BY s.scene ORDER BY {node}, s.node) AS k FROM w2 w JOIN s ON s.scene = w.scene AND s.view = w.at WHERE NOT {at}(nodes, s.node))")
    return ", ".join(parts) + " SELECT scene, (i - 1)::INT AS step, views[i] AS view, nodes[i] AS node FROM r2, (SELECT unnest([1, 2, 3]) AS i) WHERE k = 1"


@query(_walk_sql())
def view_chain(spark, sf_dir):
    """Walks over three views of each scene."""
    return multiview.chains(views.appearances(spark, sf_dir).select("scene", "view", F.col("tag").alias("node")), 3, seed=5)


@query(
    """WITH RECURSIVE v AS (SELECT o_custkey AS scene, o_orderkey AS view, (o_orderkey * 7 % 360)::DOUBLE AS yaw, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
g AS (SELECT scene, k, [view] AS views, [yaw] AS yaws FROM v WHERE k = 1 UNION ALL SELECT scene, k, CASE WHEN ok THEN list_append(views, view) ELSE views END, CASE WHEN ok THEN list_append(yaws, yaw) ELSE yaws END
  FROM (SELECT v.scene, v.k, v.view, v.yaw, g.views, g.yaws, len(g.yaws) < 6 AND len(list_filter(g.yaws, lambda y: abs((v.yaw - y + 540) % 360 - 180) < 15)) = 0 AS ok FROM g JOIN v ON v.scene = g.scene AND v.k = g.k + 1)),
e AS (SELECT scene, max_by(views, k) AS views FROM g GROUP BY scene)
SELECT scene, unnest(views) AS view, (generate_subscripts(views, 1) - 1)::INT AS rank FROM e"""
)
def pose_diversity(spark, sf_dir):
    """Views taken greedily for their angles."""
    o = views.read(spark, sf_dir, "orders")
    return multiview.diverse(o.select(F.col("o_custkey").alias("scene"), F.col("o_orderkey").alias("view"), (F.col("o_orderkey") * 7 % 360).cast("double").alias("yaw"), *[F.lit(0.0).alias(c) for c in "xyz"]))


@query(
    f"""WITH v_p AS (SELECT vec_id AS id, vec_id % 16 AS object, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
d AS (SELECT p.object, p.id, {_DIST} AS d, row_number() OVER (PARTITION BY p.object, p.id ORDER BY {_DIST}) AS k FROM v_p p JOIN v_p q ON p.object = q.object),
m AS (SELECT object, id, avg(d) AS m FROM d WHERE k <= 10 GROUP BY ALL), t AS (SELECT *, avg(m) OVER w AS mu, coalesce(stddev_samp(m) OVER w, 0) AS sd FROM m WINDOW w AS (PARTITION BY object))
SELECT object, count(*) AS n FROM t WHERE sd = 0 OR m < mu + 2 * sd GROUP BY object"""
)
def outlier_removal(spark, sf_dir):
    """Points that are left after outliers go, by object."""
    return points.without_outliers(_cloud(spark, sf_dir)).groupBy("object").agg(F.count("*").alias("n"))


@query()
def hull_volume(spark, sf_dir):
    """Convex hulls of point clouds."""
    return points.hull_volumes(_cloud(spark, sf_dir)).withColumn("volume", F.round("volume", 6))


@query(f"WITH {_CLOUD} SELECT object, count(*) FILTER (abs(x - 0.01) <= 0.045 AND abs(y) <= 0.09 AND abs(z + 0.01) <= 0.18) AS n_inside FROM v_point GROUP BY object")
def points_in_box(spark, sf_dir):
    """Points inside a shrunken box."""
    inside = points.in_box(_c("xyz"), [F.lit(0.01), F.lit(0.0), F.lit(-0.01)], [F.lit(0.1), F.lit(0.2), F.lit(0.4)], [F.lit(0.0)] * 3, 0.9)
    return _cloud(spark, sf_dir).groupBy("object").agg(F.count_if(inside).alias("n_inside"))


@query(f"{V} SELECT sample_id, min_by(object_id, (l_quantity * p_size, object_id)) AS smallest, max_by(object_id, (l_quantity * p_size, object_id)) AS biggest FROM v_object GROUP BY sample_id")
def size_extremes(spark, sf_dir):
    """The smallest and the biggest object of each sample."""
    rows = views.objects(spark, sf_dir).withColumn("k", F.struct((F.col("l_quantity") * F.col("p_size")).alias("v"), "object_id"))
    return rows.groupBy("sample_id").agg(F.min("k")["object_id"].alias("smallest"), F.max("k")["object_id"].alias("biggest"))


@query(f"WITH {_CLOUD}, d AS (SELECT object, sqrt(x * x + y * y + z * z) AS d FROM v_point), k AS (SELECT *, row_number() OVER (PARTITION BY object ORDER BY d) AS k, count(*) OVER (PARTITION BY object) AS n FROM d) SELECT object, round(avg(d), 6) AS near FROM k WHERE k <= greatest(1, trunc(n * 0.2)) GROUP BY object")
def closest20_distance(spark, sf_dir):
    """The mean of the nearest fifth of each cloud's distances to the camera."""
    rows = _cloud(spark, sf_dir).withColumn("d", g.norm(_c("xyz")))
    return stats.shallow_mean(rows, ["object"], "d", 0.2).select("object", F.round("mean", 6).alias("near"))


@query(f"{V}, k AS (SELECT sample_id, pos, category, row_number() OVER (PARTITION BY sample_id ORDER BY pos) AS k FROM v_object) SELECT x.sample_id, x.pos AS a, y.pos AS b FROM k x JOIN k y ON x.sample_id = y.sample_id AND x.pos < y.pos AND x.category <> y.category WHERE x.k <= 4 AND y.k <= 4")
def limited_pairs(spark, sf_dir):
    """Pairs of different tags among the first objects."""
    return reshape.limited_pairs(views.objects(spark, sf_dir).select("sample_id", "pos", "category"), 4)


@query(
    f"""{_CAND}, t AS (SELECT sample_id, CASE coalesce(parts, predicate) {" ".join(f"WHEN '{k}' THEN '{v[2]}'" for k, v in direction.DIRECTIONS.items())} END AS short, pos FROM e)
SELECT CASE WHEN pos % 4 = 0 THEN '(no relation)' WHEN pos % 5 = 0 THEN '(unknown relation)' ELSE short END AS direction, count(*) AS n FROM t GROUP BY ALL"""
)
def qa_directions(spark, sf_dir):
    """Questions by the direction of their relation."""
    rows = rel.derived(spark, sf_dir).filter("reason is null").select("sample_id", "a_object_id", "b_object_id", "predicate", "components")
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("sample_id").orderBy("a_object_id", "b_object_id")))
    edges = rows.withColumn("relation_id", F.concat(F.lit("relation#"), F.col("pos").cast("string")))
    own = F.when(F.col("pos") % 4 == 0, F.lit(None)).when(F.col("pos") % 5 == 0, "gone").otherwise(F.col("relation_id"))
    return qa_geometry.directions_of(edges.select("sample_id", own.alias("relation_id")), edges)


@query(f"{V} SELECT sample_id, category, count(*) AS n FROM v_object GROUP BY ALL HAVING count(*) > 1")
def counting_choice(spark, sf_dir):
    """Counting questions with options; each has its count among them."""
    rows = stats.duplicate_tags(views.objects(spark, sf_dir), "category")
    rows = qa_geometry.counting_choice(rows, 5)
    right = F.element_at("options", F.position(F.col("answer"), F.lit("ABCD")).cast("int"))
    return rows.filter(right == F.col("n")).select("sample_id", "category", "n")
