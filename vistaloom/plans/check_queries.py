"""Checks, adapters, extension points, pictures, masks, boxes and further questions over the canonical views."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from vistaloom.functions import geometry3d as g
from vistaloom.functions import text as t
from vistaloom.operators import adapters, boxes, images, multiview, objects, pictures, points, qa_geometry, relations, reshape, stats, validate
from vistaloom.plans import extend, metadata, views
from vistaloom.plans import relation_queries as rel
from vistaloom.plans import space_queries as space
from vistaloom.plans.question_queries import sql_draw, sql_fill
from vistaloom.plans.registry import Registry
from vistaloom.sources import sinks

query = Registry()
V, B = space.V, space.BOXES


# masks and pictures


def _masks(spark, sf_dir):
    """A mask of two runs, 25 pixels wide, for each object."""
    k = F.col("l_partkey")
    runs = F.array(
        F.struct(((k * 7) % 400).cast("int").alias("start"), (k % 30 + 1).cast("int").alias("length")), F.struct(((F.col("l_suppkey") * 11) % 400 + 450).cast("int").alias("start"), F.col("pos").cast("int").alias("length"))
    )
    return views.objects(spark, sf_dir).select("sample_id", "pos", "category", runs.alias("runs"), F.lit(25).alias("width"), F.lit(40).alias("height"), (F.col("l_quantity") / 50).alias("score"), F.col("p_size").alias("area"))


_PX = f"""{V}, m AS (SELECT sample_id, pos, category, (l_partkey * 7) % 400 AS s1, l_partkey % 30 + 1 AS n1, (l_suppkey * 11) % 400 + 450 AS s2, pos AS n2 FROM v_object),
px AS (SELECT sample_id, pos, category, p % 25 AS u, p // 25 AS v FROM (SELECT sample_id, pos, category, unnest(list_concat(range(s1, s1 + n1), range(s2, s2 + n2))) AS p FROM m))"""


@query(f"{_PX} SELECT sample_id, pos, min(u)::INT AS x1, min(v)::INT AS y1, max(u)::INT AS x2, max(v)::INT AS y2, count(*) AS area FROM px GROUP BY sample_id, pos")
def mask_boxes(spark, sf_dir):
    """Boxes and areas of run-length masks."""
    masks = _masks(spark, sf_dir)
    return images.mask_boxes(masks, images.pixels(masks, ["sample_id", "pos"], "runs", "width"), ["sample_id", "pos"])


@query(f"{V}, m AS (SELECT sample_id, pos, count(*) OVER (PARTITION BY sample_id) AS n FROM v_object WHERE l_quantity / 50 >= 0.6 AND p_size > 20) SELECT sample_id, pos FROM m WHERE n >= 2")
def mask_filter(spark, sf_dir):
    """Masks of enough score and area, in pictures that are left with two."""
    return images.keep_masks(_masks(spark, sf_dir), "score", "area", "sample_id").select("sample_id", "pos")


@query(
    f"""{_PX}, a AS (SELECT sample_id, pos, count(*) AS n FROM px GROUP BY ALL), o AS (SELECT x.sample_id, x.pos AS a, y.pos AS b, count(*) AS n FROM px x JOIN px y ON x.sample_id = y.sample_id AND x.category = y.category AND x.u = y.u AND x.v = y.v AND x.pos < y.pos GROUP BY ALL),
l AS (SELECT o.sample_id, CASE WHEN x.n >= y.n THEN o.b ELSE o.a END AS pos FROM o JOIN a x ON x.sample_id = o.sample_id AND x.pos = o.a JOIN a y ON y.sample_id = o.sample_id AND y.pos = o.b WHERE o.n / (x.n + 1e-6) > 0.3 OR o.n / (y.n + 1e-6) > 0.3)
SELECT sample_id, pos FROM v_object ANTI JOIN l USING (sample_id, pos)"""
)
def mask_merge(spark, sf_dir):
    """Masks that do not lose to another of their tag."""
    masks = _masks(spark, sf_dir)
    px = images.pixels(masks, ["sample_id", "pos"], "runs", "width")
    return images.merge_masks(masks, px, "sample_id", "pos", "category", 0.3).select("sample_id", "pos")


@query("WITH p AS (SELECT s_suppkey AS id, unnest(list_concat(range((s_suppkey * 7) % 50, (s_suppkey * 7) % 50 + s_suppkey % 9), range(60, 60 + s_nationkey))) AS p FROM supplier) SELECT id, count(*) AS n, min(p % 10)::INT AS u1, max(p // 10)::INT AS v2 FROM p GROUP BY id")
def mask_png(spark, sf_dir):
    """Masks as PNG files, and the pixels that those hold."""
    k = F.col("s_suppkey")
    runs = F.array(F.struct(((k * 7) % 50).cast("int").alias("start"), (k % 9).cast("int").alias("length")), F.struct(F.lit(60).alias("start"), F.col("s_nationkey").alias("length")))
    masks = views.read(spark, sf_dir, "supplier").select(k.alias("id"), runs.alias("runs"), F.lit(10).alias("width"), F.lit(9).alias("height"))
    px = pictures.pixel_table(pictures.mask_pictures(masks, "id"), "id").filter(F.col("values")[0] == 255)
    return px.groupBy("id").agg(F.count("*").alias("n"), F.min("u").alias("u1"), F.max("v").alias("v2"))


def _gray(key: str, height: int, width: int):
    """A task's function: a picture for each key whose pixels follow from key and place."""

    def run(batches):
        for b in batches:
            v, u = np.indices((height, width))
            content = [pictures.encode_png(((k * 7 + u + 3 * v) * 100 % 65536).astype(np.uint16)) for k in b[key]]
            yield pd.DataFrame({key: b[key], "content": content})

    return run


_DEPTH = "SELECT n_nationkey, u, v, ((n_nationkey * 7 + u + 3 * v) * 100 % 65536) / 1000 AS depth FROM nation, (SELECT unnest(range(0, 6)) AS u), (SELECT unnest(range(0, 4)) AS v)"


@query(f"WITH d AS ({_DEPTH}) SELECT n_nationkey, u::INT AS u, v::INT AS v, round(depth, 6) AS depth, round((u - 2) * depth / 50, 6) AS x, round((v - 1) * depth / 60, 6) AS y FROM d WHERE depth > 0 AND (u + v) % 2 = 0")
def depth_backprojection(spark, sf_dir):
    """Depth maps from picture files to points in the camera's frame, where a mask covers them."""
    files = views.read(spark, sf_dir, "nation").select("n_nationkey").mapInPandas(_gray("n_nationkey", 4, 6), "n_nationkey int, content binary")
    depth = images.depth_pixels(files.withColumn("depth_scale", F.lit(1000)), "n_nationkey")
    px = depth.filter("(u + v) % 2 = 0").select("n_nationkey", "u", "v")
    cloud = images.backprojected(depth, px, ["n_nationkey", "u", "v"], "n_nationkey", 50, 60, 2, 1)
    return cloud.select("n_nationkey", "u", "v", *[F.round(c, 6).alias(n) for n, c in (("depth", "z"), ("x", "x"), ("y", "y"))])


@query("SELECT n_nationkey, 60 AS width, 40 AS height, ((20 + n_nationkey % 8) * 20 - (16 + n_nationkey % 8) * 16)::BIGINT AS n_red FROM nation")
def picture_marks(spark, sf_dir):
    """Pictures with a box drawn, read again pixel by pixel."""
    files = views.read(spark, sf_dir, "nation").select("n_nationkey").mapInPandas(_gray("n_nationkey", 40, 60), "n_nationkey int, content binary")
    # 1000 / 60 and 1000 / 40 pixels: corners at (5, 10) and (24 + k % 8, 29)
    right = F.ceil((24 + F.col("n_nationkey") % 8) * 1000 / 60).cast("int")
    files = files.withColumns({"boxes": F.array(F.array(F.lit(84), F.lit(250), right, F.lit(725))), "colors": F.array(F.lit("red"))})
    drawn = pictures.render(files, "n_nationkey")
    red = pictures.pixel_table(drawn, "n_nationkey").filter(F.array_join("values", ",") == "255,0,0").groupBy("n_nationkey").agg(F.count("*").alias("n_red"))
    return drawn.select("n_nationkey", images.png_size(F.col("content")).alias("s")).select("n_nationkey", "s.width", "s.height").join(red, "n_nationkey")


@query("SELECT p_partkey, 518 AS width, least(518, greatest(14, (round_even(h * 518 / w / 14, 0) * 14)::INT)) AS height FROM (SELECT p_partkey, (p_partkey % 900 + 100)::DOUBLE AS w, (p_size * 20)::DOUBLE AS h FROM part)")
def model_sizes(spark, sf_dir):
    """Sizes that a model takes, in proportion and to a multiple of its step."""
    w, h = images.model_size((F.col("p_partkey") % 900 + 100).cast("double"), (F.col("p_size") * 20).cast("double"))
    return views.read(spark, sf_dir, "part").select("p_partkey", w.alias("width"), h.alias("height"))


@query(f"{V} SELECT sample_id, pos, round(x1 / 1000 * 640, 6) AS x1, round(y2 / 1000 * 480, 6) AS y2, greatest(2, round(480 * 0.004)::INT) AS line FROM v_object")
def mark_rectangles(spark, sf_dir):
    """Pixel rectangles and line widths of marks."""
    r = images.mark_rectangle([F.col(c) for c in ("x1", "y1", "x2", "y2")], F.lit(640), F.lit(480))
    return views.objects(spark, sf_dir).select("sample_id", "pos", r.alias("r")).select("sample_id", "pos", F.round("r.x1", 6).alias("x1"), F.round("r.y2", 6).alias("y2"), "r.line")


@query(f"{V} SELECT sample_id, pos, 0.9::DOUBLE AS score, 'offline' AS label FROM v_object")
def infer_offline(spark, sf_dir):
    """Rows through a model plug-in that needs no model."""
    rows = views.objects(spark, sf_dir).select("sample_id", "pos")
    return images.infer(rows, images.offline({"score": 0.9, "label": "offline"}), "sample_id long, pos int, score double, label string", parallel=4)


# geometry


@query(f"{B} SELECT sample_id, pos, round(ta, 6) AS a, round(tb, 6) AS b, round(tc, 6) AS c, round(ta, 6) AS d, round(tb + 1, 6) AS e, round(tc, 6) AS f FROM v_box")
def euler_any(spark, sf_dir):
    """Angles back from rotations by three different axes, and by a repeated one."""
    a, b, c = (F.col(x) for x in ("ta", "tb", "tc"))
    mixed, again = g.euler_by("XYZ", g.rotation_by("XYZ", (a, b, c))), g.euler_by("ZXZ", g.rotation_by("ZXZ", (a, b + 1, c)))
    return space.boxes(spark, sf_dir).select("sample_id", "pos", *[(F.round(x, 6) + 0.0).alias(n) for n, x in zip("abcdef", [*mixed, *again], strict=True)])


@query(f"{B} SELECT sample_id, pos, round(r00, 6) AS m00, round(-r01, 6) AS m01, round(-r22, 6) AS m22, round(cx * 0.5, 6) AS x, round(cz * 0.5, 6) AS z FROM v_rot")
def axis_flip(spark, sf_dir):
    """Poses with y and z turned round, and their translations scaled."""
    m, move = g.flip_axes(g.rotation(*space._c(space.ANGLES)), space._c(space.CENTER), F.lit(0.5))
    return space.boxes(spark, sf_dir).select("sample_id", "pos", *[(F.round(x, 6) + 0.0).alias(n) for n, x in (("m00", m[0][0]), ("m01", m[0][1]), ("m22", m[2][2]), ("x", move[0]), ("z", move[2]))])


@query(f"{V} SELECT sample_id, pos, CASE WHEN cz > 5 THEN round(500 * cx / cz + 320, 6) END AS u, CASE WHEN cz > 5 THEN round(510 * cy / cz + 240, 6) END AS v FROM (SELECT sample_id, pos, cx, cy, CASE WHEN cz > 5 THEN cz ELSE -cz END AS cz FROM v_object)")
def project_points(spark, sf_dir):
    """Points to pixels; what is behind the camera has none."""
    z = F.when(F.col("cz") > 5, F.col("cz")).otherwise(-F.col("cz"))
    u, v = g.project([F.col("cx"), F.col("cy"), z], *[F.lit(float(x)) for x in (500, 510, 320, 240)])
    return views.objects(spark, sf_dir).select("sample_id", "pos", F.round(u, 6).alias("u"), F.round(v, 6).alias("v"))


@query(f"{V} SELECT sample_id, pos, CASE WHEN pos % 6 = 0 THEN 0 ELSE greatest(0, least(65535, floor(cz * 300 / sqrt((x1 - 320)::DOUBLE * (x1 - 320) + (y1 - 240)::DOUBLE * (y1 - 240) + 90000) * 1000)))::INT END AS depth FROM v_object")
def planar_depth(spark, sf_dir):
    """Depth along the axis from distance along the ray; none where there is none."""
    d = F.when(F.col("pos") % 6 != 0, F.col("cz"))
    depth = g.planar_depth(d, (F.col("x1") - 320).cast("double"), (F.col("y1") - 240).cast("double"), F.lit(300.0))
    return views.objects(spark, sf_dir).select("sample_id", "pos", depth.alias("depth"))


@query(f"{V} SELECT sample_id, pos, CASE pos % 4 WHEN 0 THEN NULL WHEN 2 THEN cz ELSE cx END AS x, CASE pos % 4 WHEN 0 THEN NULL WHEN 2 THEN cx ELSE cy END AS y FROM v_object")
def center_3d(spark, sf_dir):
    """Centres of objects that keep them under different names, some in a box."""
    k = F.col("pos") % 4
    three = F.array("cx", "cy", "cz")
    json = F.to_json(
        F.struct(
            F.when(k == 0, F.array("cx", "cy")).when(k == 1, F.array("cx")).alias("center_xyz_cam"),
            F.when(k == 1, three).alias("center_3d"),
            F.when(k == 3, three).alias("centroid"),
            F.when(k == 2, F.array("cz", "cx", "cy", "cz", "cz", "cz", "cx", "cx", "cx")).alias("obb_world"),
        )
    )
    rows = views.objects(spark, sf_dir).withColumn("c", g.representative_center(json))
    return rows.select("sample_id", "pos", F.get("c", 0).alias("x"), F.get("c", 1).alias("y"))


@query(f"{B} SELECT sample_id, pos, round(r00 * (cx - xl) + r10 * (cy - yl) + r20 * (cz - zl), 6) AS x, 0.0::DOUBLE AS turn FROM v_rot")
def box_in_camera(spark, sf_dir):
    """World boxes seen from cameras that are turned as they are."""
    m = g.rotation(*space._c(space.ANGLES))
    center, angles = g.box_to_camera(m, space._c(space.SIZE), space._c(space.CENTER), space._c(space.ANGLES))
    return space.boxes(spark, sf_dir).select("sample_id", "pos", F.round(center[0], 6).alias("x"), (F.round(F.abs(angles[0]) + F.abs(angles[1]) + F.abs(angles[2]), 5) + 0.0).alias("turn"))


@query(
    f"""{B}, p AS (SELECT a.sample_id, a.object_id AS a, b.object_id AS b, greatest(0, abs(a.cx - b.cx) * 1.0137 - (a.xl + b.xl) / 2) AS dx, greatest(0, abs(a.cy - b.cy) * 0.9871 - (a.yl + b.yl) / 2) AS dy, greatest(a.xl, a.yl, b.xl, b.yl) AS longest
FROM v_box a JOIN v_box b ON a.sample_id = b.sample_id AND a.object_id < b.object_id) SELECT sample_id, a, b FROM p WHERE sqrt(dx * dx + dy * dy) < 0.5 * longest OR (dx = 0 AND dy = 0)"""
)
def footprints(spark, sf_dir):
    """Pairs of upright boxes whose footprints meet or nearly do."""
    # odd factors, so that no gap is just as long as the limit
    rows = space.boxes(spark, sf_dir).withColumns({a: F.lit(0.0) for a in space.ANGLES} | {"cx": F.col("cx") * 1.0137, "cy": F.col("cy") * 0.9871})
    rows = relations.pairs(boxes.with_corners(rows), ["corners"]).filter(boxes.footprints_near("a_corners", "b_corners"))
    return rows.select("sample_id", F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"))


@query(f"WITH {space._CLOUD} SELECT object, round(max(x) - min(x), 6) AS xl, round(max(y) - min(y), 6) AS yl, round(max(z) - min(z), 6) AS zl FROM v_point GROUP BY object")
def cloud_extents(spark, sf_dir):
    """Extents of point clouds along the axes."""
    return boxes.extent(space._cloud(spark, sf_dir)).select("object", *[F.round(c, 6).alias(c) for c in ("xl", "yl", "zl")])


@query(f"WITH {space._CLOUD} SELECT object, string_agg('v ' || printf('%.6f %.6f %.6f', x, y, z), chr(10) ORDER BY x, y, z) AS text FROM v_point GROUP BY object")
def cloud_text(spark, sf_dir):
    """Point clouds as OBJ text."""
    return sinks.point_cloud_text(space._cloud(spark, sf_dir))


@query(
    f"""{V}, p AS (SELECT sample_id AS pair, pos, cx AS x, cy AS y, cz AS z FROM v_object), d AS (SELECT a.pair, a.pos AS a, b.pos AS b, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d
  FROM p a JOIN p b ON a.pair = b.pair AND a.pos % 2 = 1 AND b.pos % 2 = 0) SELECT pair, a AS a_pos, min_by(b, (d, b)) AS b_pos, round(min(d), 6) AS distance FROM d WHERE d <= 2 GROUP BY pair, a"""
)
def nearest_points(spark, sf_dir):
    """Each point of one view with the nearest of the other, if it is near."""
    p = views.objects(spark, sf_dir).select(F.col("sample_id").alias("pair"), "pos", F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z"))
    rows = points.nearest_within(p.filter("pos % 2 = 1"), p.filter("pos % 2 = 0"), ["pair"], 2.0, ["pos"])
    return rows.withColumn("distance", F.round("distance", 6))


@query(f"{space.VA}, d AS (SELECT DISTINCT scene, view, node FROM v_app), n AS (SELECT scene, node, count(*) AS n FROM d GROUP BY ALL) SELECT scene, view, node FROM d JOIN n USING (scene, node) WHERE n = 1")
def unique_objects(spark, sf_dir):
    """Nodes that a single view of their scene sees."""
    return multiview.unique_objects(views.appearances(spark, sf_dir))


# records


def _lists(spark, sf_dir):
    rows = views.objects(spark, sf_dir).select("sample_id", "pos", "object_id", "category")
    return reshape.group_collect(rows, "sample_id", ["object_id", "category"], "pos").drop("_first")


@query(f"{V} SELECT sample_id, coalesce(string_agg(object_id, ',' ORDER BY pos) FILTER (pos % 3 <> 1), '') AS ids, coalesce(string_agg(category, ',' ORDER BY pos) FILTER (pos % 3 <> 1), '') AS tags FROM v_object GROUP BY sample_id")
def valid_flags(spark, sf_dir):
    """List columns without the elements whose flag is false."""
    rows = _lists(spark, sf_dir).withColumn("ok", F.transform("object_id", lambda x, i: i % 3 != 0))
    return objects.by_flags(rows, "ok", ["object_id", "category"]).select("sample_id", F.array_join("object_id", ",").alias("ids"), F.array_join("category", ",").alias("tags"))


@query(f"{V} SELECT sample_id FROM v_object GROUP BY sample_id HAVING count(*) >= 3 AND sample_id % 4 NOT IN (0, 1)")
def check_example(spark, sf_dir):
    """Rows in which every list is there, as long as the first, and long enough."""
    k = F.col("sample_id") % 4
    rows = _lists(spark, sf_dir).withColumn("category", F.when(k == 0, F.lit(None)).when(k == 1, F.slice("category", 1, 1)).otherwise(F.col("category")))
    # lists of one element are too short anyway
    return reshape.complete(rows, ["object_id", "category"], least=3).select("sample_id")


@query(
    f"""{V} SELECT sample_id, '[' || string_agg('{{"qa_id":"qa#' || (pos - 1) || '","question":"' || object_id || '","answer":"' || category || '","meta":"m"}}', ',' ORDER BY pos) || ']' AS items FROM v_object GROUP BY sample_id"""
)
def attach_qa(spark, sf_dir):
    """Question, answer and meta lists as numbered items."""
    items = reshape.attach_qa(F.col("object_id"), F.col("category"), F.transform("category", lambda c: F.lit("m")))
    return _lists(spark, sf_dir).select("sample_id", F.to_json(items).alias("items"))


@query(
    f"""{V}, r AS (SELECT sample_id, count(*) AS n FROM v_object GROUP BY ALL), e AS (SELECT sample_id, unnest(list_filter([CASE WHEN sample_id % 5 = 0 THEN 'dataset' END, CASE WHEN sample_id % 7 = 0 THEN 'sample' END, CASE WHEN sample_id % 6 = 0 THEN 'object_id' END, CASE WHEN sample_id % 11 = 0 AND n > 1 THEN 'duplicate object_id' END], lambda x: x IS NOT NULL)) AS error FROM r)
SELECT CASE WHEN sample_id % 7 <> 0 THEN 's' || sample_id END AS sample_id, error FROM e"""
)
def metadata_errors(spark, sf_dir):
    """What the strict schema finds missing or twice in nested records."""
    k = F.col("sample_id")
    ids = F.transform("object_id", lambda x, i: F.when((k % 6 == 0) & (i == 0), F.lit(None)).when((k % 11 == 0) & (i == 1) & (k % 6 != 0), F.get("object_id", 0)).when((k % 66 == 0) & (i == 1), F.lit(None)).otherwise(x))
    rows = _lists(spark, sf_dir).select(
        F.struct(F.when(k % 5 != 0, F.lit("d")).alias("name")).alias("dataset"),
        F.struct(F.when(k % 7 != 0, F.concat(F.lit("s"), k.cast("string"))).alias("sample_id")).alias("sample"),
        F.transform(ids, lambda x: F.struct(x.alias("object_id"), F.lit("c").alias("category"))).alias("objects"),
    )
    return validate.metadata_errors(rows)


@query("SELECT page_id FROM pages WHERE page_id % 7 = 3")
def missing_paths(spark, sf_dir):
    """Records whose file a listing lacks."""
    pages = views.read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("image"))
    listing = pages.filter("page_id % 7 != 3").select(F.col("image").alias("path"))
    return validate.missing_paths(pages, listing, "image", 1, most=1 << 30).select("page_id")


@query("SELECT doc_id FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 97 = 5 AND source IS NOT NULL)")
def complete_scenes(spark, sf_dir):
    """Frames of scenes in which no frame lacks a field."""
    frames = views.read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("scene_id"), F.when(F.col("doc_id") % 97 != 5, F.lit("x")).alias("pose"))
    return validate.complete_scenes(frames, ["pose"]).select("doc_id")


@query("SELECT o_orderkey, o_custkey * 2 AS twice FROM orders WHERE o_orderkey % 3 <> 1")
def record_transform(spark, sf_dir):
    """A row function that changes rows and drops some."""
    rows = views.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return extend.apply_rows(rows, lambda r, n: ({"o_orderkey": r["o_orderkey"], "twice": r["o_custkey"] * 2}, r["o_orderkey"] % 3 != 1), "o_orderkey long, twice long")


@query("SELECT c_custkey, unnest(range(0, c_custkey % 4)) AS k FROM customer")
def table_function(spark, sf_dir):
    """A table function of several rows for each input row, called from SQL."""
    extend.register_items(spark, "vl_items", lambda key: ((i,) for i in range(key % 4)), "k bigint")
    views.read(spark, sf_dir, "customer").select("c_custkey").createOrReplaceTempView("vl_customers")
    return spark.sql("select c_custkey, k from vl_customers, lateral vl_items(c_custkey)")


@query("SELECT o_orderkey, 'F' AS status, 1 AS step FROM orders WHERE o_orderstatus = 'F'")
def adapter_chain(spark, sf_dir):
    """Adapters by name, one after the other, with a check of what they leave."""
    extend.ADAPTERS["keep_status"] = lambda status: lambda rows: rows.filter(F.col("status") == status)
    chain = adapters.chain(extend.make_adapter("passthrough"), extend.make_adapter("keep_status", status="F"), lambda rows: rows.withColumn("step", F.lit(1)), required=["o_orderkey"], check_from=0)
    return chain(views.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")))


@query(
    f"""{V} SELECT sample_id AS record, 's' || sample_id AS sample, 'im/' || sample_id AS path, pos - 1 AS pos, CASE pos % 3 WHEN 0 THEN 'obj#' || (pos - 1) ELSE object_id END AS object_id, CASE pos % 2 WHEN 0 THEN category ELSE '' END AS category, CASE WHEN pos % 4 = 1 THEN cx END AS cx, CASE WHEN pos % 5 = 0 THEN x1 END AS x1 FROM v_object"""
)
def adapter_pictures(spark, sf_dir):
    """Records of pictures with 3D boxes that name their fields in different ways."""
    k = F.col("pos")
    given = F.to_json(
        F.struct(
            F.when(k % 3 == 1, F.col("object_id")).alias("annotation_id"),
            F.when(k % 3 == 2, F.col("object_id")).alias("id"),
            F.when(k % 2 == 0, F.col("category")).alias("category_name"),
            F.when(k % 4 == 1, F.array("cx", "cy", "cz")).alias("xyz_cam"),
            F.when(k % 5 == 0, F.array("x1", "y1", "x2", "y2")).otherwise(F.array("x1", "y1")).alias("bbox_xyxy_norm_1000"),
        )
    )
    items = views.objects(spark, sf_dir).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos", given.alias("o")))).alias("x"))
    value = F.concat(F.lit('{"image_id":"s'), F.col("sample_id").cast("string"), F.lit('","file_name":"im/'), F.col("sample_id").cast("string"), F.lit('","annotations":['), F.array_join(F.col("x.o"), ","), F.lit("]}"))
    rows = adapters.picture_objects(items.select(F.col("sample_id").alias("record"), value.alias("value")))
    return rows.select("record", F.col("sample_id").alias("sample"), "path", "pos", "object_id", "category", "cx", "x1")


@query(f"{V} SELECT sample_id, 'obj#' || pos AS made, CASE WHEN pos <= 2 THEN object_id END AS second FROM v_object WHERE pos <= 3")
def made_ids(spark, sf_dir):
    """Ids from a prefix and a number, and an element of a list that may not be there."""
    rows = views.objects(spark, sf_dir).filter("pos <= 3")
    few = F.array(F.lit("-"), F.lit("obj#0"), F.lit("obj#1"))
    return rows.select("sample_id", t.made_id(F.lit("obj"), F.col("pos")).alias("made"), F.get(few, F.col("pos")).alias("second"))


@query(
    rel.R2E[:-1]
    + f""", {rel._R3.split("v_edge AS", 1)[1].split("WHERE a.sample_id % 7 = 0),", 1)[1].strip().rstrip(",")},
big AS (SELECT *, count(*) OVER () AS all_n FROM v_object WHERE greatest((x2 - x1) / (y2 - y1), (y2 - y1) / (x2 - x1)) <= 12),
n2 AS (SELECT 'image_plane' AS ref_frame, 'computed' AS source, count(*) AS n FROM v_out o JOIN big a ON a.sample_id = o.sample_id AND a.object_id = a_id JOIN big b ON b.sample_id = o.sample_id AND b.object_id = b_id
  WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM v_edge e WHERE e.sample_id = o.sample_id AND anchor_id = a_id AND target_id = b_id AND ref_frame = 'image_plane' AND source <> 'computed')),
n3 AS (SELECT 'egocentric', 'computed_3d', count(*) FROM g3 ANTI JOIN (SELECT * FROM v_edge WHERE ref_frame = 'egocentric' AND NOT starts_with(source, 'computed')) USING (sample_id, anchor_id, target_id) WHERE reason IS NULL),
k AS (SELECT ref_frame, source, count(*) AS n FROM v_edge WHERE NOT (ref_frame = 'image_plane' AND source = 'computed') AND NOT (ref_frame = 'egocentric' AND starts_with(source, 'computed')) GROUP BY ALL)
SELECT ref_frame, source, sum(n)::BIGINT AS n FROM (SELECT * FROM n2 UNION ALL SELECT * FROM n3 UNION ALL SELECT * FROM k) GROUP BY ALL"""
)
def enrich_dispatch(spark, sf_dir):
    """Edges of both frames after enrichment, by frame and source."""
    o = views.objects(spark, sf_dir)
    none = F.lit(None)
    e = views.edges(spark, sf_dir).select("sample_id", F.col("pos").cast("int").alias("pos"), "anchor_id", "target_id", "ref_frame", none.cast("string").alias("predicate"), "components", "source", "relation_id", none.cast("int").alias("du"), none.cast("int").alias("dv"))
    m = metadata.enriched(metadata.Metadata(o.select("sample_id").distinct(), o, o.limit(0), e), relations_3d=True)
    return m.edges.groupBy("ref_frame", "source").agg(F.count("*").alias("n"))


# questions


def _ask(name: str, draw: str, **values: str) -> str:
    q, a = sql_fill(name, draw, **values)
    return f"{q} AS question, {a} AS answer"


@query(f"{V}, c AS (SELECT sample_id, category, count(*) AS n FROM v_object GROUP BY ALL HAVING count(*) > 1) SELECT sample_id, category, {_ask('counting.open', sql_draw(6, 'sample_id', 'category'), A='category || chr(115)', X='n::VARCHAR')} FROM c")
def counting_questions(spark, sf_dir):
    """Open counting questions with their texts."""
    rows = stats.duplicate_tags(views.objects(spark, sf_dir), "category")
    return qa_geometry.counting(rows, 6).select("sample_id", "category", "question", "answer")


_CHOICES = "array_to_string(list_transform(options, lambda x, i: 'ABCD'[i] || ': ' || x), chr(10))"


@query(
    f"""{V}, c AS (SELECT sample_id, category, count(*) AS n FROM v_object GROUP BY ALL HAVING count(*) > 1), w AS (SELECT *, unnest(range(greatest(0, n - 5), n + 6)) AS x FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY sample_id, category ORDER BY {sql_draw(5, "sample_id", "category", "x")}, x) AS k FROM w WHERE x <> n), p AS (SELECT sample_id, category, n, x FROM r WHERE k <= 3 UNION ALL SELECT sample_id, category, n, n FROM c),
o AS (SELECT sample_id, category, n, list(x ORDER BY {sql_draw(6, "sample_id", "category", "x")}, x) AS options FROM p GROUP BY ALL)
SELECT sample_id, category, {_ask('counting.choice', sql_draw(5, 'sample_id', 'category'), A='category || chr(115)', Y=_CHOICES, X="'ABCD'[list_position(options, n)]")} FROM o"""
)
def counting_options(spark, sf_dir):
    """Counting questions with four options and the letter of the right one."""
    rows = stats.duplicate_tags(views.objects(spark, sf_dir), "category")
    return qa_geometry.counting_choice(rows, 5).select("sample_id", "category", "question", "answer")


_LENGTH = "CASE WHEN {0} < 1 THEN printf('%.2f', round_even({0} * 100, 2)) || ' cm' ELSE printf('%.2f', round_even({0}, 2)) || ' m' END"


@query(
    f"""{V}, p AS (SELECT a.sample_id, a.object_id AS a, b.object_id AS b, sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2 + (a.cz - b.cz) ** 2) AS d FROM v_object a JOIN v_object b ON a.sample_id = b.sample_id AND a.object_id < b.object_id)
SELECT sample_id, a, b, {_ask('distance.absolute', '0', A='a', B='b', X=_LENGTH.format('d'))} FROM p"""
)
def distance_questions(spark, sf_dir):
    """How far apart the objects of a pair are."""
    rows = relations.pairs(views.objects(spark, sf_dir), ["cx", "cy", "cz"])
    d = g.norm(g.minus([F.col(f"a_{c}") for c in space.CENTER], [F.col(f"b_{c}") for c in space.CENTER]))
    rows = rows.select("sample_id", F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"), d.alias("distance"))
    return qa_geometry.absolute_distance(rows, 1).drop("distance")


@query(f"{B} SELECT sample_id, object_id, {_ask('size.absolute', '0', A='object_id', X=_LENGTH.format('greatest(xl, yl, zl) / 3'))} FROM v_box")
def extent_questions(spark, sf_dir):
    """How long an object's longest side is."""
    rows = space.boxes(spark, sf_dir).select("sample_id", "object_id", (F.greatest(*space.SIZE) / 3).alias("m"))
    return qa_geometry.extent(rows, 1, "object_id", "m").drop("m")


_BOX9 = "'[' || " + " || ', ' || ".join(f"printf('%.2f', round_even({c}, 2))" for c in ("cx", "cy", "cz", "xl", "yl", "zl")) + " || ']'"


@query(f"{B} SELECT sample_id, object_id, {_ask('grounding.boxes', '0', A='object_id', X=_BOX9)} FROM v_box")
def grounding_3d(spark, sf_dir):
    """Objects' 3D boxes to two decimals."""
    rows = space.boxes(spark, sf_dir).select("sample_id", "object_id", *space.CENTER, *space.SIZE)
    return qa_geometry.grounding(rows, 1, "object_id", [*space.CENTER, *space.SIZE]).select("sample_id", "object_id", "question", "answer")


@query(f"{V} SELECT sample_id, category, string_agg(x1 || ' ' || y1 || ' ' || x2 || ' ' || y2, ';' ORDER BY pos) AS boxes FROM v_object GROUP BY sample_id, category")
def tag_boxes(spark, sf_dir):
    """The boxes of each tag of a sample, in order."""
    rows = views.objects(spark, sf_dir).select("sample_id", "category", "pos", F.concat_ws(" ", *[F.col(c).cast("string") for c in ("x1", "y1", "x2", "y2")]).alias("box"))
    rows = rows.groupBy("sample_id", "category").agg(F.array_sort(F.collect_list(F.struct("pos", "box"))).alias("b"))
    return rows.select("sample_id", "category", F.array_join("b.box", ";").alias("boxes"))


@query(
    f"""SELECT page_id, 'Describe the scene.' || CASE WHEN {sql_draw(4, "page_id", "'objects'")} < 0.7 THEN ' Name the objects.' ELSE '' END || CASE WHEN {sql_draw(4, "page_id", "'layout'")} < 0.7 THEN ' Say where they are.' ELSE '' END AS prompt FROM pages"""
)
def caption_prompts(spark, sf_dir):
    """Prompts for captions of the modules that a draw keeps."""
    modules = {"scene": "Describe the scene.", "objects": "Name the objects.", "layout": "Say where they are."}
    return qa_geometry.caption_prompt(views.read(spark, sf_dir, "pages").select("page_id"), modules, 4, "page_id")


@query(f"{V}, k AS (SELECT sample_id, object_id, row_number() OVER (PARTITION BY sample_id ORDER BY l_quantity DESC, object_id) AS k FROM v_object) SELECT sample_id, object_id, k::INT AS rank FROM k WHERE k <= 2")
def sample_top(spark, sf_dir):
    """The two largest objects of each sample by quantity."""
    rank = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("l_quantity"), "object_id"))
    return views.objects(spark, sf_dir).withColumn("rank", rank).filter("rank <= 2").select("sample_id", "object_id", "rank")


@query()
def visible_boxes(spark, sf_dir):
    """Boxes of whose projection a tenth or more is in the picture; polygons have no SQL, a test compares them with shares known in advance."""
    rows = boxes.with_corners(space.boxes(spark, sf_dir).withColumn("cz", F.col("cz") + 12))
    return boxes.visible(rows, (500, 500), (320, 240), (640, 480)).select("sample_id", "pos", F.round("visible", 6).alias("visible"))
