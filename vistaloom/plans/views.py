"""Views of the provided tables in the shapes that the operators read, and the same views as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object for each line of an order (the sample): box from keys and quantity, centre from prices."""
    # the key has its final name before the window, so later joins on it need no other shuffle
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sample_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    order = Window.partitionBy("sample_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    pos = F.row_number().over(order)
    x1 = ((F.col("l_partkey") * 37) % 800).cast("int")
    y1 = ((F.col("l_suppkey") * 53 + F.col("l_linenumber") * 97) % 800).cast("int")
    wide = F.col("l_quantity").cast("int") * 4 * F.when(F.col("l_linenumber") == 7, 3).otherwise(1)
    return rows.select(
        "sample_id",
        pos.alias("pos"),
        F.concat(F.lit("obj#"), (pos - 1).cast("string")).alias("object_id"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("phrase"),
        x1.alias("x1"),
        y1.alias("y1"),
        F.least(F.lit(999), x1 + wide).alias("x2"),
        (y1 + 20 + ((F.col("l_partkey") % 13) * 12).cast("int")).alias("y2"),
        (F.round("l_extendedprice") % 1000 / 100).alias("cx"),
        (F.col("l_quantity") / 10).alias("cy"),
        (F.col("p_size") / 5.0).alias("cz"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "p_size",
    )


OBJECTS = """v_object AS (
SELECT l_orderkey AS sample_id, pos, 'obj#' || (pos - 1) AS object_id, p_type AS category, p_name AS phrase, x1, y1,
  least(999, x1 + l_quantity::INT * 4 * (CASE WHEN l_linenumber = 7 THEN 3 ELSE 1 END)) AS x2,
  y1 + 20 + ((l_partkey % 13) * 12)::INT AS y2, (round(l_extendedprice) % 1000) / 100 AS cx, l_quantity / 10 AS cy, p_size / 5.0::DOUBLE AS cz,
  l_partkey, l_suppkey, l_quantity, p_size
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax)::INT AS pos,
  ((l_partkey * 37) % 800)::INT AS x1, ((l_suppkey * 53 + l_linenumber * 97) % 800)::INT AS y1
  FROM lineitem JOIN part ON l_partkey = p_partkey))"""


def rough_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of which some have points, bad boxes or nothing at all."""
    k = F.col("l_partkey")
    rows = objects(spark, sf_dir)
    point, none = k % 11 == 3, k % 61 == 5
    gone = point | none
    rows = rows.withColumns({"u": F.when(point & ~none, F.col("x1") + F.when(k % 7 == 1, 400).otherwise(0)), "v": F.when(point & ~none & (k % 5 != 2), F.col("y1"))})
    x2 = F.when(k % 17 == 4, F.col("x1")).when(k % 19 == 6, F.col("x1") + 1).otherwise(F.col("x2"))
    x1 = F.when(k % 23 == 7, F.col("x1") - 60).otherwise(F.col("x1"))
    return rows.withColumns({c: F.when(~gone, v) for c, v in (("x2", x2), ("x1", x1), ("y1", F.col("y1")), ("y2", F.col("y2")))})


ROUGH = (
    OBJECTS
    + """, v_rough AS (SELECT sample_id, pos, object_id, category, phrase, l_partkey, l_suppkey,
  CASE WHEN NOT gone THEN (CASE WHEN l_partkey % 23 = 7 THEN x1 - 60 ELSE x1 END) END AS x1, CASE WHEN NOT gone THEN y1 END AS y1,
  CASE WHEN NOT gone THEN (CASE WHEN l_partkey % 17 = 4 THEN x1 WHEN l_partkey % 19 = 6 THEN x1 + 1 ELSE x2 END) END AS x2, CASE WHEN NOT gone THEN y2 END AS y2,
  CASE WHEN point AND NOT none_ THEN x1 + (CASE WHEN l_partkey % 7 = 1 THEN 400 ELSE 0 END) END AS u,
  CASE WHEN point AND NOT none_ AND l_partkey % 5 <> 2 THEN y1 END AS v
FROM (SELECT *, l_partkey % 11 = 3 AS point, l_partkey % 61 = 5 AS none_, l_partkey % 11 = 3 OR l_partkey % 61 = 5 AS gone FROM v_object))"""
)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known edges between neighbours in every seventh sample, of varied frame, source and id."""
    o = objects(spark, sf_dir).filter("sample_id % 7 = 0").select("sample_id", "pos", "object_id")
    b = o.select("sample_id", (F.col("pos") - 1).alias("pos"), F.col("object_id").alias("b"))
    k = (F.col("sample_id") + F.col("pos")) % 4
    a = o.join(b, ["sample_id", "pos"]).select(
        "sample_id",
        "pos",
        F.col("object_id").alias("anchor_id"),
        F.col("b").alias("target_id"),
        F.when(F.col("pos") % 2 == 1, "image_plane").otherwise("egocentric").alias("ref_frame"),
        F.when(k == 0, "imported").when(k == 1, "computed").when(k == 2, "annotated_3d").otherwise("computed_3d").alias("source"),
        F.when(k == 0, F.concat(F.lit("relation#"), (F.col("pos") * 3).cast("string"))).when(k == 1, F.lit("own")).alias("relation_id"),
        F.when(k == 2, F.array(F.lit("front"), F.lit("right"))).when(k == 3, F.array(F.lit("left"))).alias("components"),
    )
    return a


EDGES = """v_edge AS (SELECT a.sample_id, a.pos, a.object_id AS anchor_id, b.object_id AS target_id,
  CASE WHEN a.pos % 2 = 1 THEN 'image_plane' ELSE 'egocentric' END AS ref_frame,
  ['imported', 'computed', 'annotated_3d', 'computed_3d'][((a.sample_id + a.pos) % 4 + 1)::INT] AS source,
  CASE (a.sample_id + a.pos) % 4 WHEN 0 THEN 'relation#' || (a.pos * 3) WHEN 1 THEN 'own' END AS relation_id,
  CASE (a.sample_id + a.pos) % 4 WHEN 2 THEN ['front', 'right'] WHEN 3 THEN ['left'] END AS components
FROM v_object a JOIN v_object b ON a.sample_id = b.sample_id AND b.pos = a.pos + 1 WHERE a.sample_id % 7 = 0)"""


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query for each sample and category: candidates in order, gold and count set in some."""
    o = objects(spark, sf_dir)
    rows = o.groupBy("sample_id", "category").agg(F.array_sort(F.collect_list(F.struct("pos", "object_id"))).alias("x"))
    ids = F.transform("x", lambda v: v["object_id"])
    k = F.col("sample_id") % 3
    return rows.select(
        "sample_id",
        F.concat(F.lit("q#"), F.col("category")).alias("query_id"),
        ids.alias("candidates"),
        F.when(k != 0, F.element_at(ids, -1)).alias("gold"),
        F.when(k != 1, F.size(ids)).alias("count"),
    )


QUERIES = """v_query AS (SELECT sample_id, 'q#' || category AS query_id, list(object_id ORDER BY pos) AS candidates,
  CASE WHEN sample_id % 3 <> 0 THEN list(object_id ORDER BY pos)[-1] END AS gold, CASE WHEN sample_id % 3 <> 1 THEN count(*) END AS count
FROM v_object GROUP BY sample_id, category)"""


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, view, node, pos, tag, vx, vy, vz): customers as scenes, orders as views, parts as nodes, with node extents."""
    o = objects(spark, sf_dir)
    views = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("scene"))
    return o.join(views, "sample_id").select("scene", F.col("sample_id").alias("view"), F.col("l_partkey").alias("node"), "pos", F.col("category").alias("tag"), "cx", "cy", "cz", "p_size")


APPEARANCES = """v_app AS (SELECT o_custkey AS scene, sample_id AS view, l_partkey AS node, pos, category AS tag, cx, cy, cz, p_size
FROM v_object JOIN orders ON o_orderkey = sample_id)"""
