"""Unnesting, grouping, packing, paging, statistics and set operations over the canonical views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vistaloom.operators import objects, ranking, reshape, stats
from vistaloom.plans import views
from vistaloom.plans.registry import Registry

query = Registry()
V = f"WITH {views.OBJECTS}"
VA = f"WITH {views.OBJECTS}, {views.APPEARANCES}"


def _lists(spark, sf_dir):
    """One row for each sample with its objects as lists."""
    rows = views.objects(spark, sf_dir).select("sample_id", "pos", "object_id", "category", "x1")
    return reshape.group_collect(rows, "sample_id", ["object_id", "category", "x1"], "pos").drop("_first")


@query(f"{V} SELECT sample_id, object_id, category, x1 FROM v_object")
def unnest_views(spark, sf_dir):
    """Lists to rows."""
    return reshape.unnest(_lists(spark, sf_dir), "object_id", ["category", "x1"])


@query(f"{V} SELECT sample_id, string_agg(object_id, ',' ORDER BY pos) AS ids, string_agg(category, ',' ORDER BY pos) AS tags, min_by(phrase, pos) AS phrase FROM v_object GROUP BY sample_id")
def group_collect(spark, sf_dir):
    """Rows to lists in order, other columns from the first row."""
    rows = views.objects(spark, sf_dir).select("sample_id", "pos", "object_id", "category", "phrase")
    out = reshape.group_collect(rows, "sample_id", ["object_id", "category"], "pos")
    return out.select("sample_id", F.array_join("object_id", ",").alias("ids"), F.array_join("category", ",").alias("tags"), "phrase")


@query("SELECT source AS scene_id, count(*) AS num_images, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS frames FROM documents WHERE doc_id % 9 <> 0 GROUP BY source")
def merge_scenes(spark, sf_dir):
    """Frames merged by scene; frames without one are left out."""
    frames = views.read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("scene_id"))
    out = reshape.merge_scenes(frames.withColumn("frame", F.col("doc_id").cast("string")), "scene_id", ["frame"], "doc_id")
    return out.select("scene_id", F.col("num_images").cast("long").alias("num_images"), F.array_join("frame", ",").alias("frames"))


@query(f"{V} SELECT sample_id::VARCHAR AS image, pos - 1 AS item, 'where is ' || object_id AS question, category AS answer FROM v_object")
def flatten_qa(spark, sf_dir):
    """Annotation lists to one row for each question."""
    rows = _lists(spark, sf_dir).withColumns({"image": F.col("sample_id").cast("string"), "question": F.transform("object_id", lambda x: F.concat(F.lit("where is "), x)), "answer": F.col("category")})
    return reshape.flatten_annotations(rows, ["question", "answer"])


@query(
    f"""{V} SELECT sample_id, '{{"sample_id":' || sample_id || ',"qa":[' || string_agg('{{"question":"' || object_id || '","answer":' || (CASE WHEN pos > 1 THEN '"' || category || '"' ELSE 'null' END) || ',"view":' || (CASE WHEN pos = 1 THEN (sample_id % 5)::VARCHAR ELSE 'null' END) || '}}', ',' ORDER BY pos) || ']}}' AS json
FROM (SELECT sample_id, pos, object_id, CASE WHEN pos > 1 THEN category END AS category FROM v_object) GROUP BY sample_id"""
)
def qa_bundle(spark, sf_dir):
    """Questions of a sample as one JSON line; short lists are filled with nulls."""
    rows = _lists(spark, sf_dir)
    answers = F.transform("category", lambda c, i: F.when(i > 0, c))
    rows = rows.select("sample_id", F.col("object_id").alias("question"), answers.alias("answer"), (F.col("sample_id") % 5).alias("view"))
    return reshape.qa_bundle(rows, "sample_id", ["question", "answer"], ["view"])


_ROWS = "v_row AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderkey % 50 AS n, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)"


def rows_in_order(spark, sf_dir):
    return views.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_orderkey") % 50).alias("n"))


@query(f"WITH {_ROWS} SELECT o_orderkey, rn, (rn - 1) // 1024 AS bundle_id FROM v_row")
def bundle_pack(spark, sf_dir):
    """Rows in global order, packed by 1024."""
    rows = ranking.bundled(rows_in_order(spark, sf_dir), 1024, 1, ["o_orderkey"])
    return rows.select("o_orderkey", "rn", "bundle_id")


@query(f"WITH {_ROWS} SELECT (rn - 1) // 112 AS bundle_id, count(*) AS n FROM v_row WHERE rn <= (SELECT count(*) - count(*) % 112 FROM v_row) GROUP BY ALL")
def bundle_tail_align(spark, sf_dir):
    """Bundle sizes after the tail is cut to a multiple."""
    return ranking.bundled(rows_in_order(spark, sf_dir), 112, 112, ["o_orderkey"]).groupBy("bundle_id").agg(F.count("*").alias("n"))


@query(f"WITH {_ROWS} SELECT o_orderkey, to_base64(o_orderpriority::BLOB) AS image_b64 FROM v_row WHERE rn > (SELECT count(*) - count(*) % 64 FROM v_row)")
def remainder_sidecar(spark, sf_dir):
    """Rows that alignment leaves over, with their content in base 64."""
    rows = ranking.bundled(rows_in_order(spark, sf_dir), 1024, 64, ["o_orderkey"], drop_tail=False).filter("remainder")
    return rows.select("o_orderkey", F.base64(F.col("o_orderpriority").cast("binary")).alias("image_b64"))


@query(
    f"""WITH {_ROWS}, b AS (SELECT *, (rn - 1) // 100 AS bundle_id, 'img/' || (o_orderkey % 37) || '.jpg' AS path, o_orderkey % 3 AS idx FROM v_row),
u AS (SELECT *, row_number() OVER (PARTITION BY bundle_id, path ORDER BY rn) AS use FROM b),
n AS (SELECT *, CASE WHEN use = 1 THEN path ELSE replace(path, '.jpg', '__r' || idx || '.jpg') END AS named FROM u),
k AS (SELECT *, row_number() OVER (PARTITION BY bundle_id, named ORDER BY rn) - 1 AS bump FROM n)
SELECT o_orderkey, bundle_id, CASE WHEN bump = 0 THEN named ELSE replace(named, '.jpg', '_' || bump || '.jpg') END AS unique_path FROM k"""
)
def path_disambiguate(spark, sf_dir):
    """Unique picture names within each bundle."""
    rows = rows_in_order(spark, sf_dir).withColumns({"path": F.concat(F.lit("img/"), (F.col("o_orderkey") % 37).cast("string"), F.lit(".jpg")), "idx": F.col("o_orderkey") % 3})
    rows = ranking.disambiguated(ranking.bundled(rows, 100, 1, ["o_orderkey"]), "path", "idx")
    return rows.select("o_orderkey", "bundle_id", "unique_path")


@query(f"WITH {_ROWS} SELECT rn - 1 AS line, o_orderkey, 120 < (SELECT count(*) - 1000 FROM v_row) AS has_more FROM v_row WHERE rn > 1000 AND rn <= 1120 AND n <> 0")
def paged_scan(spark, sf_dir):
    """One page of a file of lines, some of which are blank."""
    rows = ranking.numbered(rows_in_order(spark, sf_dir), ["o_orderkey"])
    lines = rows.select((F.col("rn") - 1).alias("line"), "o_orderkey", F.when(F.col("n") == 0, F.lit(" ")).otherwise(F.lit("x")).alias("value"))
    return ranking.page(lines, 1000, 120).select("line", "o_orderkey", "has_more")


@query("SELECT min(rn) - 1 AS line FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM events) WHERE event_id % 7 <> 0 AND user_id = 3")
def seek_key(spark, sf_dir):
    """The first line of a sample among lines of which some are no JSON."""
    rows = ranking.numbered(views.read(spark, sf_dir, "events").select("event_id", "user_id"), ["event_id"])
    good = F.to_json(F.struct(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("sample_id")).alias("sample")))
    lines = rows.select((F.col("rn") - 1).alias("line"), F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).otherwise(good).alias("value"))
    return ranking.seek(lines, "u3")


@query("SELECT count(*) AS n_lines, count(*) FILTER (trim(text) <> '') AS n_full FROM documents")
def count_lines(spark, sf_dir):
    """Lines and lines that are not blank."""
    return views.read(spark, sf_dir, "documents").agg(F.count("*").alias("n_lines"), F.count_if(F.trim("text") != "").alias("n_full"))


@query("SELECT o_custkey, string_agg((i * n // 8)::VARCHAR, ',' ORDER BY i) AS picked FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL), (SELECT unnest(range(0, 8)) AS i) WHERE n > 8 GROUP BY o_custkey")
def view_subsample(spark, sf_dir):
    """Evenly spread views of scenes with more than eight."""
    rows = views.read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 8")
    return rows.select("o_custkey", F.array_join(ranking.view_subsample(F.col("n"), 8), ",").alias("picked"))


_QA = f"""{V}, q AS (SELECT sample_id, pos, ['single_axis', 'full_sentence', 'judgment'][(pos - 1) % 3 + 1] AS qa_style, CASE WHEN sample_id % 11 = 0 THEN '' WHEN pos % 3 = 1 THEN 'MCQ' ELSE 'open_ended' END AS question_type, category AS task FROM v_object)"""


def questions(spark, sf_dir):
    k = F.col("pos") % 3
    return views.objects(spark, sf_dir).select(
        "sample_id",
        "pos",
        F.when(k == 1, "single_axis").when(k == 2, "full_sentence").otherwise("judgment").alias("qa_style"),
        F.when(F.col("sample_id") % 11 == 0, "").when(k == 1, "MCQ").otherwise("open_ended").alias("question_type"),
        F.col("category").alias("task"),
    )


@query(
    f"""{_QA}, d AS (SELECT 'qa_style' AS dimension, qa_style AS value FROM q UNION ALL SELECT 'question_type', CASE WHEN question_type = '' THEN '(missing)' ELSE question_type END FROM q UNION ALL SELECT 'task', task FROM q)
SELECT dimension, value, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY dimension), 4) AS percent FROM d GROUP BY dimension, value"""
)
def qa_stats(spark, sf_dir):
    """Questions by style, type and task with their shares."""
    return stats.shares(questions(spark, sf_dir), ["qa_style", "question_type", "task"])


@query("SELECT coalesce(file, '(total)') AS file, count(*) AS n_samples, sum(n)::BIGINT AS n_qa FROM (SELECT (conv_id % 4)::VARCHAR AS file, conv_id, count(*) FILTER (role = 'assistant') AS n FROM conversations GROUP BY ALL) GROUP BY ROLLUP (file)")
def training_stats(spark, sf_dir):
    """Samples and questions by file and in total."""
    rows = views.read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("roles"))
    return stats.training_stats(rows.withColumn("file", (F.col("conv_id") % 4).cast("string")), "file", "roles")


@query("SELECT event_type AS phase, count(*) AS n, round(sum(value), 4) AS total_s, round(1000 * avg(value), 4) AS mean_ms, round(100 * sum(value) / sum(sum(value)) OVER (), 4) AS percent FROM events GROUP BY event_type")
def phase_timing(spark, sf_dir):
    """Time by phase."""
    rows = stats.phase_timing(views.read(spark, sf_dir, "events"), "event_type", "value")
    return rows.select(F.col("event_type").alias("phase"), "n", *[F.round(c, 4).alias(c) for c in ("total_s", "mean_ms", "percent")])


@query(f"{V} SELECT phrase, count(*) AS n FROM v_object GROUP BY phrase ORDER BY n DESC, phrase LIMIT 50")
def top50_directions(spark, sf_dir):
    """The fifty most frequent phrases."""
    return stats.top(views.objects(spark, sf_dir), "phrase")


@query(f"{V} SELECT sample_id, pos, count(*) OVER (PARTITION BY sample_id, lower(regexp_replace(trim(phrase), '^(?:the|a|an)\\s+', '', 'i'))) AS name_count FROM v_object")
def name_counts(spark, sf_dir):
    """How many objects of the sample share each object's name."""
    from vistaloom.functions.text import name_key

    return stats.name_counts(views.objects(spark, sf_dir), name_key(F.col("phrase"))).select("sample_id", "pos", "name_count")


@query(f"{V} SELECT sample_id, category, count(*) AS n FROM v_object WHERE category <> 'PROMO' GROUP BY ALL HAVING count(*) > 1")
def duplicate_tags(spark, sf_dir):
    """Tags that a sample has more than once."""
    return stats.duplicate_tags(views.objects(spark, sf_dir), "category", without=["PROMO"])


@query(f"{V}, t AS (SELECT category AS path, 'bundle_' || (sample_id % 3) AS archive FROM v_object) SELECT path, string_agg(DISTINCT archive, ',' ORDER BY archive) AS archives FROM t GROUP BY path HAVING count(DISTINCT archive) > 1 ORDER BY path LIMIT 50")
def tar_overlap(spark, sf_dir):
    """Members that several archives hold."""
    rows = views.objects(spark, sf_dir).select(F.col("category").alias("path"), F.concat(F.lit("bundle_"), (F.col("sample_id") % 3).cast("string")).alias("archive"))
    return stats.archive_overlaps(rows, "path", "archive").select("path", F.array_join("archives", ",").alias("archives"))


@query("SELECT event_id, (props->>'k')::INT AS k FROM events")
def json_extract_props(spark, sf_dir):
    """A field of a JSON column."""
    return views.read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT id, kind FROM (SELECT c_custkey AS id, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier)")
def shard_union(spark, sf_dir):
    """Shards one after the other."""
    a = views.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"))
    b = views.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"))
    return a.unionByName(b)


@query(
    f"""{VA}, t AS (SELECT scene, view, list_sort(list(DISTINCT tag)) AS tags, row_number() OVER (PARTITION BY scene ORDER BY view) AS k FROM v_app GROUP BY scene, view),
p AS (SELECT a.scene, a.tags AS a, b.tags AS b FROM t a JOIN t b ON a.scene = b.scene AND a.k = 1 AND b.k = 2)
SELECT scene, array_to_string(list_filter(a, lambda x: NOT list_contains(b, x)), ',') AS only_first, array_to_string(list_filter(b, lambda x: NOT list_contains(a, x)), ',') AS only_second FROM p"""
)
def tags_except(spark, sf_dir):
    """Tags in only one of a scene's first two views."""
    rows = views.appearances(spark, sf_dir).groupBy("scene", "view").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("scene").orderBy("view"))).filter("k <= 2")
    pair = rows.groupBy("scene").agg(F.max(F.when(F.col("k") == 1, F.col("tags"))).alias("a"), F.max(F.when(F.col("k") == 2, F.col("tags"))).alias("b")).filter("b is not null")
    return pair.select("scene", F.array_join(F.array_except("a", "b"), ",").alias("only_first"), F.array_join(F.array_except("b", "a"), ",").alias("only_second"))


@query(f"{V}, k AS (SELECT sample_id, list(category ORDER BY pos) AS tags, list(object_id ORDER BY pos) AS ids FROM v_object WHERE category NOT IN ('PROMO', 'SMALL') GROUP BY sample_id) SELECT sample_id, array_to_string(tags, ',') AS tags, array_to_string(ids, ',') AS ids FROM k")
def background_filter(spark, sf_dir):
    """Objects without background tags; samples left with none go."""
    rows = objects.without_tags(_lists(spark, sf_dir), ["PROMO", "SMALL"], "category", ["object_id"])
    return rows.select("sample_id", F.array_join("category", ",").alias("tags"), F.array_join("object_id", ",").alias("ids"))


@query("SELECT p_partkey, regexp_matches(lower(p_name), 'red|orange|yellow|green|blue|purple|pink|brown|black|white|gray|grey|beige') AS is_color FROM part")
def color_tag_filter(spark, sf_dir):
    """Which names hold a colour word."""
    return views.read(spark, sf_dir, "part").select("p_partkey", objects.is_color_tag(F.col("p_name")).alias("is_color"))


@query(f"{V} SELECT sample_id, sub_task, repetition FROM (SELECT DISTINCT sample_id FROM v_object), (VALUES ('near', 0), ('near', 1), ('far', 0)) t(sub_task, repetition)")
def sub_task_dispatch(spark, sf_dir):
    """A row for each planned question."""
    return reshape.explode_counts(views.objects(spark, sf_dir).select("sample_id").distinct(), {"near": 2, "far": 1, "none": 0})


@query(f"WITH {_ROWS} SELECT o_orderstatus AS split, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM v_row) WHERE k <= 20 ORDER BY split, o_orderkey LIMIT 45")
def max_records(spark, sf_dir):
    """At most twenty rows of each split and forty-five in all."""
    rows = rows_in_order(spark, sf_dir).withColumnRenamed("o_orderstatus", "split")
    return ranking.limited(rows, 20, 45, "split", "o_orderkey").select("split", "o_orderkey")
