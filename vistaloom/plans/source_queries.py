"""Sources and sinks: tables written to the shared folder in each format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vistaloom.functions import text as t
from vistaloom.operators import ranking
from vistaloom.plans import browse, metadata, staged, views
from vistaloom.plans.registry import Registry
from vistaloom.session import shared_folder, writes
from vistaloom.sources import files, sinks, tar
from vistaloom.streaming import ingest

query = Registry()


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def scan_table(spark, sf_dir):
    """Two columns of the rows that a filter leaves; both reach the scan."""
    return views.read(spark, sf_dir, "orders").filter("o_orderstatus = 'F' and o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def scan_override(spark, sf_dir):
    """A dependency's own table read in place of the current one."""
    path = _folder(spark, "override")
    sinks.parquet(views.read(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select("s_suppkey", "s_name"), path)
    return files.override(spark, path)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def sink_batched(spark, sf_dir):
    """A table written in files of at most a thousand rows."""
    path = _folder(spark, "batched")
    sinks.parquet(views.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), path, per_file=1000)
    return spark.read.parquet(path)


@query("SELECT c_custkey % 7 AS shard, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer GROUP BY ALL")
def sink_sharded(spark, sf_dir):
    """Shards by a key as folders, read back with the key from the path."""
    path = _folder(spark, "sharded")
    rows = views.read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 7).alias("shard"))
    rows.write.partitionBy("shard").parquet(path)
    return spark.read.parquet(path).groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query("SELECT n_nationkey::BIGINT AS line, n_name FROM nation")
def record_lines(spark, sf_dir):
    """Lines of a file with their numbers."""
    path = _folder(spark, "lines")
    views.read(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name").write.text(path)
    return files.lines(spark, path).select("line", F.col("value").alias("n_name"))


@query("SELECT doc_id % 4 = 3 AS broken, CASE WHEN doc_id % 4 <> 3 THEN lang END AS lang, count(*) AS n, sum(CASE WHEN doc_id % 4 <> 3 THEN doc_id END)::BIGINT AS ids FROM documents GROUP BY ALL")
def jsonl_records(spark, sf_dir):
    """JSON lines, some of which are cut short, as records and a flag."""
    path = _folder(spark, "jsonl")
    sinks.jsonl(views.read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), path, ["doc_id"])
    lines = spark.read.text(path)
    cut = F.get_json_object("value", "$.doc_id").cast("long") % 4 == 3
    lines.select(F.when(cut, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")).alias("value")).write.text(f"{path}-cut")
    rows = files.jsonl(spark, f"{path}-cut", "doc_id long, lang string, n_chars long")
    whole = F.when(~F.col("broken"), F.col("record"))
    return rows.groupBy("broken", whole["lang"].alias("lang")).agg(F.count("*").alias("n"), F.sum(whole["doc_id"]).alias("ids"))


@query("SELECT r_regionkey, r_name, 0 AS line FROM region")
def json_files(spark, sf_dir):
    """One record for each JSON file."""
    path = _folder(spark, "json-files")
    rows = views.read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.to_json(F.struct("r_regionkey", "r_name")).alias("value"))
    rows.write.partitionBy("k").text(path)
    return files.json_files(spark, f"{path}/k=*", "r_regionkey int, r_name string").select("record.r_regionkey", "record.r_name", "line")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer")
def delimited(spark, sf_dir):
    """Tab-separated values with a header, as strings."""
    path = _folder(spark, "tsv")
    views.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).option("sep", "\t").csv(path)
    return files.delimited(spark, path, "\t")


def _sharded(spark, sf_dir, name):
    """Orders as JSON lines in shards of 400, every ninth line broken."""
    path = _folder(spark, name)
    rows = ranking.numbered(views.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])
    good = F.to_json(F.struct("o_orderkey", "o_custkey"))
    rows = rows.select(F.floor((F.col("rn") - 1) / 400).alias("bundle_id"), "rn", F.when(F.col("rn") % 9 == 0, F.lit("{oops")).otherwise(good).alias("value"))
    sinks.shards(rows, path)
    return path


@query("WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) SELECT o_orderkey, o_custkey FROM r WHERE rn % 9 <> 0")
def jsonl_tolerant(spark, sf_dir):
    """Records of a folder's JSON lines files; broken lines are passed over."""
    return files.tolerant(spark, _sharded(spark, sf_dir, "tolerant"), "o_orderkey long, o_custkey long")


@query("WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) SELECT ((rn - 1) // 400)::INT AS shard, count(*) AS n, max((rn - 1) % 400) AS last_line FROM r GROUP BY ALL")
def shard_discovery(spark, sf_dir):
    """Numbered shards by their names, with their lines."""
    return files.shards(spark, _sharded(spark, sf_dir, "shards")).groupBy("shard").agg(F.count("*").alias("n"), F.max("line").alias("last_line"))


@query("SELECT DISTINCT (s_suppkey % 5)::VARCHAR AS scene, s_nationkey::VARCHAR AS view FROM supplier WHERE s_suppkey % 5 <> 2")
def enumerate_frames(spark, sf_dir):
    """Frames by the paths of their files, without those of a scene that is done."""
    path = _folder(spark, "frames")
    rows = views.read(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 5).alias("scene"), F.col("s_nationkey").alias("view"), "s_name")
    rows.write.partitionBy("scene", "view").text(path)
    done = rows.filter("scene = 2").select(F.col("scene").cast("string").alias("scene"), F.col("view").cast("string").alias("view")).distinct()
    found = files.frames(spark, path, r"scene=(\d+)/view=(\d+)/part-[^/]*$", ["scene", "view"], done)
    return found.select("scene", "view").distinct()


def _page_bundles(spark, sf_dir, where="true"):
    """Pages in tar bundles of 64."""
    pages = views.read(spark, sf_dir, "pages").filter(where)
    rows = pages.select("page_id", F.concat(F.lit("p/"), (F.col("page_id") % 50).cast("string"), F.lit(".html")).alias("path"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("content"))
    packed = ranking.disambiguated(ranking.bundled(rows, 64, 1, ["page_id"]), "path", "page_id")
    return tar.bundles(packed.withColumn("row", F.to_json(F.struct("page_id", "unique_path"))))


_PAGE_ROWS = """r AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER (ORDER BY page_id) - 1 AS rn FROM pages)"""


@query(f"WITH {_PAGE_ROWS} SELECT rn // 64 AS bundle_id, count(*) AS n FROM r GROUP BY ALL")
def tar_bundles(spark, sf_dir):
    """Tar bundles with how many rows each holds."""
    return _page_bundles(spark, sf_dir).select("bundle_id", "n")


@query(f"WITH {_PAGE_ROWS} SELECT page_id, strlen(html)::BIGINT AS size, md5(html) AS content FROM r")
def tar_members(spark, sf_dir):
    """Pages through tar bundles and their index in a store, every row's path looked up among the members."""
    path = _folder(spark, "bundles")
    n = tar.export(_page_bundles(spark, sf_dir), path)
    found = tar.members(spark, [f"{path}/images/data_{i:06d}.tar" for i in range(n)])
    wanted = spark.read.text(f"{path}/jsonl").select(F.from_json("value", "page_id long, unique_path string").alias("r"), F.regexp_extract("_metadata.file_path", r"(data_\d+)", 1).alias("bundle"))
    wanted = wanted.select("r.page_id", F.col("r.unique_path").alias("path"), "bundle")
    met = wanted.join(found.withColumn("bundle", F.regexp_extract("tar", r"(data_\d+)", 1)), (F.col("path") == F.col("member")) & (wanted["bundle"] == F.regexp_extract("tar", r"(data_\d+)", 1)))
    return met.select("page_id", "size", F.md5("content").alias("content"))


@query(f"WITH {_PAGE_ROWS} SELECT md5(html) AS content, count(*) AS n FROM r GROUP BY ALL")
def tar_slices(spark, sf_dir):
    """Contents read by offset and size from the index files, without opening the archives."""
    path = _folder(spark, "slices")
    tar.export(_page_bundles(spark, sf_dir), path)
    index = spark.read.text(f"{path}/images/*_tarinfo.json", wholetext=True).select(F.regexp_replace("_metadata.file_path", r"_tarinfo\.json$", ".tar").alias("tar"), F.from_json("value", "map<string,struct<offset_data:long,size:long>>").alias("m"))
    rows = index.select("tar", F.explode("m").alias("member", "at")).select("tar", "at.offset_data", "at.size")
    return tar.slices(rows).groupBy(F.md5("content").alias("content")).agg(F.count("*").alias("n"))


@query(f"WITH {_PAGE_ROWS} SELECT rn // 64 AS bundle_id FROM r WHERE page_id < 100 GROUP BY ALL")
def sink_clear_previous(spark, sf_dir):
    """An export of fewer bundles into the same folder leaves none of the ones before."""
    path = _folder(spark, "cleared")
    tar.export(_page_bundles(spark, sf_dir), path)
    tar.export(_page_bundles(spark, sf_dir, "page_id < 100"), path)
    found = spark.read.format("binaryFile").load(f"{path}/images/*.tar").select("path")
    return found.select(F.regexp_extract("path", r"data_(\d+)", 1).cast("long").alias("bundle_id"))


@query(
    """WITH m(name) AS (VALUES ('a.jpg'), ('./b.jpg'), ('c/d.jpg'), ('e/f.jpg')), w(path) AS (VALUES ('a.jpg'), ('../b.jpg'), ('x/d.jpg'), ('f.jpg'), ('none.jpg'))
SELECT path, CASE path WHEN 'a.jpg' THEN 'a.jpg' WHEN '../b.jpg' THEN './b.jpg' WHEN 'x/d.jpg' THEN 'c/d.jpg' WHEN 'f.jpg' THEN 'e/f.jpg' END AS member FROM w"""
)
def tar_lookup(spark, sf_dir):
    """Members found under names that differ in dots, slashes and folders."""
    found = spark.createDataFrame([(m, "t") for m in ("a.jpg", "./b.jpg", "c/d.jpg", "e/f.jpg")], "member string, tar string")
    wanted = spark.createDataFrame([(p,) for p in ("a.jpg", "../b.jpg", "x/d.jpg", "f.jpg", "none.jpg")], "path string")
    return tar.lookup(wanted, found).select("path", "member")


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_custkey % 3 = 0 AND c_acctbal > 0 GROUP BY ALL")
def staged_plan(spark, sf_dir):
    """Two filters of one name and a choice of columns by a plan whose stages are stored and read back."""
    config = staged.load(
        f"""
output_dir: {_folder(spark, "staged")}
stages:
  prepare:
    filter: {{condition: "c_custkey % 3 = 0"}}
    filter: {{depends_on: prepare/filter, condition: "c_acctbal > 0"}}
  report:
    select: {{depends_on: "prepare/filter#2", columns: [c_nationkey]}}
"""
    )
    done = staged.run(spark, config, views.read(spark, sf_dir, "customer"))
    return done["report/select"].groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('prepare/filter', 'prepare/filter', NULL), ('prepare/filter#2', 'prepare/filter_dup1', 'prepare/filter'), ('report/select', 'report/select', 'prepare/filter#2')) t(ref, output, depends_on)")
def plan_steps(spark, sf_dir):
    """The refs, folders and dependencies of a plan in which a task comes twice."""
    stages = [("prepare", [("filter", {}), ("filter", {"depends_on": "prepare/filter"})]), ("report", [("select", {"depends_on": "prepare/filter#2"})])]
    steps = staged.plan({"output_dir": "o", "stages": stages})
    return spark.createDataFrame([(s.ref, s.output.removeprefix("o/"), s.depends_on) for s in steps], "ref string, output string, depends_on string")


@query("SELECT * FROM (VALUES ('count', 'counting', 3), ('depth', 'depth', 7)) t(name, type, n)")
def qa_task_registry(spark, sf_dir):
    """Enabled question tasks with their parameters, overrides first."""
    tasks = staged.qa_tasks("qa_tasks: {count: {type: counting, params: {n: 3}}, depth: {params: {n: 5}}, off: {enabled: false}}", {"depth": {"n": 7}})
    return spark.createDataFrame([(k, v["type"], v["params"]["n"]) for k, v in tasks.items()], "name string, type string, n int")


@query("SELECT * FROM (VALUES (0, 'd_000.jsonl'), (1, 'd_001.jsonl'), (2, 'd_002.jsonl'), (3, 'e_09.jsonl'), (4, 'e_10.jsonl'), (5, 'other')) t(k, path)")
def input_expand(spark, sf_dir):
    """Ranges in input names written out, in order and without repeats."""
    found = files.expand(["d_{000..2}.jsonl", "d_001.jsonl", "e_{10..9}.jsonl", "other", "other"])
    return spark.createDataFrame(list(enumerate(found)), "k int, path string")


@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/webp' WHEN 3 THEN 'image/gif' ELSE 'application/octet-stream' END AS mime FROM pages")
def mime_types(spark, sf_dir):
    """Types of files by their names."""
    k = F.col("page_id") % 5
    name = F.concat(F.col("url"), F.when(k == 0, ".JPG").when(k == 1, ".png").when(k == 2, ".WebP").when(k == 3, ".gif").otherwise(".bin"))
    return views.read(spark, sf_dir, "pages").select("page_id", t.mime(name).alias("mime"))


@query("SELECT count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM events")
def stream_export(spark, sf_dir):
    """A table of files through an export that is called once for what is new, and not again for nothing."""
    path = _folder(spark, "stream-export")
    events = views.read(spark, sf_dir, "events").select("event_id", "user_id")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1", None):
        if part:
            events.filter(part).write.mode("append").parquet(f"{path}/in")
        ingest.export(spark, f"{path}/in", f"{path}/check", lambda rows, n: rows.write.mode("append").parquet(f"{path}/out"))
    return spark.read.parquet(f"{path}/out").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark, sf_dir):
    """Events of a stream by hour and type; a far later event closes the last hour."""
    path = _folder(spark, "windows")
    events = views.read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(f"{path}/in")
    late = events.agg(F.max("ts").alias("t")).select((F.col("t") + F.expr("interval 30 days")).alias("ts"), F.lit(None).cast("string").alias("event_type"))
    counts = ingest.windowed_counts(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1000).parquet(f"{path}/in"), "ts", "event_type", "1 hour", "3650 days")

    def run():
        q = counts.writeStream.outputMode("append").format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    late.withColumn("ts", F.col("ts") + F.expr("interval 4000 days")).write.mode("append").parquet(f"{path}/in")
    run()
    return spark.read.schema("window_start timestamp, event_type string, n long").parquet(f"{path}/out").filter("event_type is not null").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _write_lines(rows, path: str) -> None:
    """Lines as compressed text, in files that a task reads in moments, and nothing else left on disk."""
    with writes(rows.sparkSession):
        rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 200_000).text(path)


#: Beyond so many objects a chain runs in so many slices of whole samples, so that it needs disk for the exchanges of one.
SLICED, SLICES = 5_000_000, 4


def _slices(spark, sf_dir) -> list:
    """What tells the samples of each slice; all samples are in one."""
    n = SLICES if views.read(spark, sf_dir, "lineitem").count() > SLICED else 1
    return [F.pmod(F.xxhash64("sample_id"), F.lit(n)) == k for k in range(n)] if n > 1 else [F.lit(True)]


def _chat(spark, sf_dir, samples=None):
    """Chat records of the objects, one for each sample, as JSON lines in the shared folder; of some ``samples`` only if a condition is given."""
    path = _folder(spark, "chat")
    o = views.objects(spark, sf_dir)
    o = o if samples is None else o.filter(samples)
    mark = F.concat(
        F.lit("<|object_ref_start|>"), "phrase", F.lit("<|object_ref_end|><|box_start|>("), F.col("x1").cast("string"), F.lit(","), F.col("y1").cast("string"), F.lit("),("), F.col("x2").cast("string"), F.lit(","), F.col("y2").cast("string"), F.lit(")<|box_end|>")
    )
    turns = o.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos", mark.alias("m")))).alias("x"))
    part = "struct<type:string,image:struct<type:string,format:string,relative_path:string,width:int,height:int>,text:struct<type:string,format:string,string:string>>"

    def says(text):
        return F.struct(F.lit("text").alias("type"), F.lit(None).alias("image"), F.struct(F.lit("text").alias("type"), F.lit("utf-8").alias("format"), text.alias("string")).alias("text")).cast(part)

    shows = F.struct(F.lit("image").alias("type"), F.struct(F.lit("relative_path").alias("type"), F.lit("image/jpeg").alias("format"), F.concat(F.lit("im/"), F.col("sample_id").cast("string"), F.lit(".jpg")).alias("relative_path"), F.lit(640).alias("width"), F.lit(480).alias("height")).alias("image"), F.lit(None).alias("text")).cast(part)
    user = F.struct(F.lit("user").alias("role"), F.array(shows, says(F.lit("what is there?"))).alias("content"))
    tells = F.struct(F.lit("assistant").alias("role"), F.transform("x", lambda m: says(m["m"])).alias("content"))
    record = F.to_json(F.struct(F.concat(F.lit("s"), F.col("sample_id").cast("string")).alias("id"), F.array(user, tells).alias("data")))
    _write_lines(turns.select(record.alias("value")), path)
    return metadata.from_chat(files.jsonl(spark, path, metadata.CHAT))


_UNIQUE = f"""WITH {views.OBJECTS}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, x1, y1, x2, y2, phrase ORDER BY pos) AS k FROM v_object) WHERE k = 1)"""
_AREA = "greatest(0, {0}.x2 - {0}.x1) * greatest(0, {0}.y2 - {0}.y1)"


@query(
    f"""{_UNIQUE}, f AS (SELECT * FROM o WHERE greatest((x2 - x1) / (y2 - y1), (y2 - y1) / (x2 - x1)) <= 12),
p AS (SELECT a.sample_id, (b.x1 + b.x2) / 2 - (a.x1 + a.x2) / 2 AS du, (b.y1 + b.y2) / 2 - (a.y1 + a.y2) / 2 AS dv, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS inter, {_AREA.format("a")} AS aa, {_AREA.format("b")} AS ab
  FROM f a JOIN f b ON a.sample_id = b.sample_id AND a.object_id < b.object_id),
r AS (SELECT sample_id, count(*) AS n FROM p WHERE inter / (aa + ab - inter) <= 0.5 AND sqrt(du * du + dv * dv) >= 100 AND inter / least(aa, ab) < 0.8 AND (abs(du) >= 100 OR abs(dv) >= 100) GROUP BY ALL)
SELECT 's' || o.sample_id AS sample_id, count(*) AS n_objects, count(*) AS n_queries, coalesce(any_value(r.n), 0) AS n_relations FROM o LEFT JOIN r USING (sample_id) GROUP BY o.sample_id"""
)
def metadata_chain(spark, sf_dir):
    """Chat lines to metadata, deduplicated and enriched, written as nested records and read back."""
    path = _folder(spark, "metadata")
    for samples in _slices(spark, sf_dir):
        m = metadata.enriched(metadata.deduplicated(_chat(spark, sf_dir, samples)))
        _write_lines(metadata.documents(m).select(F.col("json").alias("value")), path)
    got = spark.read.text(path).select(F.from_json("value", "sample struct<sample_id:string>, objects array<struct<object_id:string>>, queries array<struct<query_id:string>>, relations array<struct<relation_id:string>>").alias("r"))
    size = lambda c: F.greatest(F.size(F.coalesce(f"r.{c}", F.array())), F.lit(0)).cast("long").alias(f"n_{c}")
    return got.select("r.sample.sample_id", size("objects"), size("queries"), size("relations"))


@query(f"""WITH {views.OBJECTS} SELECT 'train' AS split, 'chat' AS dataset, 0 = 0 AS named, count(DISTINCT sample_id) AS n FROM v_object""")
def catalog_shards(spark, sf_dir):
    """Written records as an inspection page lists them: data set, split and lines."""
    path = _folder(spark, "catalog")
    m = _chat(spark, sf_dir)
    docs = metadata.documents(m).select(F.col("json").alias("value"))
    docs.write.text(f"{path}/chat/train/metadata_noqa")
    shards = browse.catalog(spark, path)
    lines = spark.read.text(f"{path}/chat/train/metadata_noqa").select(F.col("_metadata.file_path").alias("f"))
    counts = lines.groupBy(F.element_at(F.split("f", "/"), -1).alias("part")).agg(F.count("*").alias("n"))
    rows = shards.join(counts, "part").groupBy("dataset", "split").agg(F.bool_and(F.length("part") > 0).alias("named"), F.sum("n").alias("n"))
    return rows.select("split", "dataset", "named", "n")
