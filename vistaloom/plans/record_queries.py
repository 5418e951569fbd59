"""Records, validation, resuming and question items over the canonical views."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from vistaloom.functions import templates
from vistaloom.operators import relations, reshape, validate
from vistaloom.plans import relation_queries as rel
from vistaloom.plans import views
from vistaloom.plans.registry import Registry
from vistaloom.session import shared_folder
from vistaloom.sources import sinks
from vistaloom.streaming import ingest

query = Registry()
V = f"WITH {views.OBJECTS}"


@query("SELECT doc_id, 'missing ' || f AS error FROM documents, (VALUES ('id', 0), ('dataset', 1), ('scene_id', 2)) t(f, k) WHERE (doc_id + k) % 5 = 0")
def validate_schema(spark, sf_dir):
    """Fields that records lack."""
    k = F.col("doc_id")
    fields = [F.when((k + i) % 5 != 0, F.lit("x")).alias(f) for i, f in enumerate(("id", "dataset", "scene_id"))]
    rows = views.read(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct(*fields, F.lit(1).alias("more"))).alias("json"))
    return validate.schema_errors(rows, "json", "doc_id", ("id", "dataset", "scene_id"))


@query("SELECT 0 AS n_scenes, 0 AS n_frames WHERE false UNION ALL SELECT (SELECT count(*) FROM documents WHERE source <> 'src1')::BIGINT, (SELECT count(*) FROM documents)::BIGINT")
def validate_counts(spark, sf_dir):
    """Images that merged scenes lack."""
    frames = views.read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("scene_id"))
    scenes = reshape.merge_scenes(frames.withColumn("frame", F.col("doc_id")), "scene_id", ["frame"], "doc_id").filter("scene_id != 'src1'")
    return validate.count_errors(scenes, frames)


@query(
    f"""{V} SELECT sample_id, pos, e AS error FROM (SELECT sample_id, pos, unnest(list_filter([CASE WHEN l_partkey % 5 = 0 THEN 'depth_scale' END, CASE WHEN l_partkey % 7 = 0 THEN 'rotation' END, CASE WHEN l_partkey % 11 = 0 THEN 'box' END, CASE WHEN l_partkey % 13 = 0 THEN 'tags' END], lambda x: x IS NOT NULL)) AS e FROM v_object)"""
)
def validate_ranges(spark, sf_dir):
    """Values of frame records that are out of range."""
    k = F.col("l_partkey")
    one = [F.lit(float(i % 4 == 0)) for i in range(9)]
    rows = views.objects(spark, sf_dir).select(
        "sample_id",
        "pos",
        F.struct("sample_id", "pos").alias("key"),
        F.when(k % 5 == 0, 7).otherwise(1000).alias("depth_scale"),
        F.when(k % 7 == 0, F.array(*[F.lit(0.5)] * 9)).otherwise(F.array(*one)).alias("matrix"),
        F.array(F.lit(9), F.when(k % 11 == 0, 8).otherwise(9)).alias("boxes"),
        F.when(k % 13 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("tags"),
    )
    return validate.range_errors(rows, "key").select("key.sample_id", "key.pos", "error")


@query("SELECT 'f' || (o_orderkey % 10) AS file, o_orderkey AS line FROM orders WHERE o_orderkey % 10 <> 4 AND (o_orderkey % 10 >= 3 OR o_orderkey >= 1000)")
def checkpoint_resume(spark, sf_dir):
    """Records that the last run did not get to."""
    rows = views.read(spark, sf_dir, "orders").select(F.concat(F.lit("f"), (F.col("o_orderkey") % 10).cast("string")).alias("file"), F.col("o_orderkey").alias("line"))
    scoped = spark.createDataFrame([("f0", 1000, False), ("f1", 1000, False), ("f4", 0, True)], "file string, next_line long, done boolean")
    legacy = spark.createDataFrame([("f1", 5, True), ("f2", 1000, False)], "file string, next_line long, done boolean")
    return ingest.resumed(rows, ingest.merged_manifest(scoped, legacy)).select("file", "line")


@query(f"{V}, n AS (SELECT p_partkey, min(p_name) AS name FROM part WHERE p_partkey % 4 <> 0 GROUP BY ALL) SELECT sample_id, pos, coalesce(name, 'Unknown') AS label FROM v_object LEFT JOIN n ON l_partkey = p_partkey")
def label_lookup(spark, sf_dir):
    """Names of instances, the first one of each, with a default."""
    names = views.read(spark, sf_dir, "part").filter("p_partkey % 4 != 0").groupBy("p_partkey").agg(F.min("p_name").alias("name"))
    rows = views.objects(spark, sf_dir).join(names, F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows.select("sample_id", "pos", F.coalesce("name", F.lit("Unknown")).alias("label"))


@query("SELECT page_id, 'made' AS name, CASE WHEN page_id % 3 = 0 THEN 'v9' ELSE 'v0' END AS version, CASE WHEN page_id % 2 = 0 THEN url ELSE 'web' END AS source, CASE WHEN page_id % 3 = 0 THEN 'own' ELSE 'cc' END AS license FROM pages")
def inject_meta(spark, sf_dir):
    """Data set fields filled where records lack them."""
    k = F.col("page_id")
    meta = F.when(k % 3 == 0, F.create_map(F.lit("license"), F.lit("own")))
    null = F.lit(None).cast("string")
    d = F.struct(null.alias("name"), F.when(k % 3 == 0, "v9").alias("version"), null.alias("split"), null.alias("dataset_path"), F.when(k % 2 == 0, F.col("url")).otherwise(" ").alias("source"), meta.alias("meta"))
    rows = reshape.inject_dataset(views.read(spark, sf_dir, "pages").select("page_id", d.alias("dataset")), "made", "v0", "train", "/data", "web", {"license": "cc"})
    return rows.select("page_id", "dataset.name", "dataset.version", "dataset.source", F.col("dataset.meta")["license"].alias("license"))


@query("WITH RECURSIVE c AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source) AS k FROM documents GROUP BY source), f AS (SELECT k, n, 0::BIGINT AS chunk, n AS held FROM c WHERE k = 1 UNION ALL SELECT c.k, c.n, CASE WHEN f.held >= 120 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.held >= 120 THEN c.n ELSE f.held + c.n END FROM f JOIN c ON c.k = f.k + 1) SELECT chunk, count(*) AS n_scenes, sum(n)::BIGINT AS n FROM f GROUP BY chunk")
def scene_chunks(spark, sf_dir):
    """Chunks that hold whole scenes."""
    rows = views.read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("scene_id"))
    return sinks.scene_chunks(rows, 120).groupBy("chunk").agg(F.countDistinct("scene_id").alias("n_scenes"), F.count("*").alias("n"))


def _relations(spark, sf_dir):
    rows = rel.derived(spark, sf_dir).filter("reason is null").select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "predicate", "components", "du", "dv")
    return rows.withColumns({"pos": F.row_number().over(Window.partitionBy("sample_id").orderBy("anchor_id", "target_id")), "relation_id": F.lit(None).cast("string")})


@query(f"SELECT name, length(name) AS n FROM (VALUES {', '.join(repr((n,)).replace(',)', ')') for n in templates.REGISTRY)}) t(name)")
def template_registry(spark, sf_dir):
    """The registered templates."""
    return spark.createDataFrame([(n,) for n in templates.REGISTRY], "name string").withColumn("n", F.length("name").cast("long"))


@query("SELECT event_id, user_id, event_type FROM events")
def stream_ingest(spark, sf_dir):
    """Events through JSON lines and an incremental ingest, twice over, which must not repeat any."""
    folder = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    events = views.read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    half = F.col("event_id") % 2 == 0
    schema = "event_id long, user_id long, event_type string"
    for part, name in ((half, "a"), (~half, "b")):
        lines = events.filter(part).select(F.to_json(F.struct("*")).alias("value"))
        lines.write.option("compression", "none").text(f"{folder}/{name}")
        for _ in range(2):
            ingest.ingest(spark, f"{folder}/*", schema, f"{folder}-out", f"{folder}-checkpoint", lambda df: df.drop("file"))
    return spark.read.parquet(f"{folder}-out")
