"""Strings, markers, adapters and chat over the canonical views."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaloom.functions import markers
from vistaloom.functions import text as t
from vistaloom.operators import adapters, chat
from vistaloom.plans import views
from vistaloom.plans.registry import Registry

query = Registry()
V = f"WITH {views.OBJECTS}"
O_S, O_E, B_S, B_E = "<|object_ref_start|>", "<|object_ref_end|>", "<|box_start|>", "<|box_end|>"


def marked_chat(spark, sf_dir):
    """(record, turn, text): a record for each sample; objects of a turn with one or two boxes, some invalid, and stray boxes."""
    o = views.objects(spark, sf_dir)

    def box(a, b, c, d):
        return F.concat(F.lit(B_S + "("), a.cast("string"), F.lit(","), b.cast("string"), F.lit("), ("), c.cast("string"), F.lit(","), d.cast("string"), F.lit(")" + B_E))

    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    ref = F.concat(F.lit(O_S + " "), F.col("phrase"), F.lit(" " + O_E))
    two = F.concat(box(x1, y1, x2, y2), F.when(F.col("pos") % 3 == 0, F.concat(F.lit("\n "), box(x2, y1, x1, y2))).when(F.col("pos") % 3 == 1, box(y1, y1, x2 + 0 * y2, F.lit(999))).otherwise(F.lit("")))
    stray = F.when(F.col("pos") % 4 == 0, F.concat(F.lit(" and "), box(x1, x1, y2, y2))).otherwise(F.lit(" ok "))
    none = F.when(F.col("pos") % 5 == 0, F.lit(" ")).otherwise(two)
    return o.select(F.col("sample_id").alias("record"), F.col("pos").alias("turn"), F.concat(ref, none, stray).alias("text"))


_BOX = "'<|box_start|>(' || {} || ',' || {} || '), (' || {} || ',' || {} || ')<|box_end|>'"
_CHAT = (
    views.OBJECTS
    + f""", v_chat AS (SELECT sample_id AS record, pos AS turn, '<|object_ref_start|> ' || phrase || ' <|object_ref_end|>' || CASE WHEN pos % 5 = 0 THEN ' ' ELSE {_BOX.format("x1", "y1", "x2", "y2")} ||
  CASE pos % 3 WHEN 0 THEN chr(10) || ' ' || {_BOX.format("x2", "y1", "x1", "y2")} WHEN 1 THEN {_BOX.format("y1", "y1", "x2", "999")} ELSE '' END END || CASE WHEN pos % 4 = 0 THEN ' and ' || {_BOX.format("x1", "x1", "y2", "y2")} ELSE ' ok ' END AS text
FROM v_object),
v_ref AS (SELECT record, turn, m[1] AS r, m[2] AS run FROM (SELECT record, turn, unnest(list_zip(regexp_extract_all(text, '<\\|object_ref_start\\|>(.*?)<\\|object_ref_end\\|>((?:\\s*<\\|box_start\\|>\\(\\s*\\d{{1,3}}\\s*,\\s*\\d{{1,3}}\\s*\\)\\s*,\\s*\\(\\s*\\d{{1,3}}\\s*,\\s*\\d{{1,3}}\\s*\\)<\\|box_end\\|>)*)', 1),
  regexp_extract_all(text, '<\\|object_ref_start\\|>(.*?)<\\|object_ref_end\\|>((?:\\s*<\\|box_start\\|>\\(\\s*\\d{{1,3}}\\s*,\\s*\\d{{1,3}}\\s*\\)\\s*,\\s*\\(\\s*\\d{{1,3}}\\s*,\\s*\\d{{1,3}}\\s*\\)<\\|box_end\\|>)*)', 2))) AS m FROM v_chat)),
v_box AS (SELECT record, turn, trim(r) AS ref, generate_subscripts(bs, 1) AS b, unnest(bs) AS bx FROM (SELECT record, turn, r, regexp_extract_all(run, '<\\|box_start\\|>.*?<\\|box_end\\|>') AS bs FROM v_ref) WHERE trim(r) <> ''),
v_num AS (SELECT record, turn, ref, b, n[1]::INT AS x1, n[2]::INT AS y1, n[3]::INT AS x2, n[4]::INT AS y2 FROM (SELECT *, regexp_extract_all(bx, '\\d{{1,3}}') AS n FROM v_box)),
v_gobj AS (SELECT *, 'obj#' || (row_number() OVER (PARTITION BY record ORDER BY turn, b) - 1) AS object_id FROM v_num WHERE x1 < x2 AND y1 < y2)"""
)


@query(f"WITH {_CHAT} SELECT record, turn, ref, string_agg(x1 || ' ' || y1 || ' ' || x2 || ' ' || y2, ';' ORDER BY b) AS boxes FROM v_num GROUP BY ALL")
def grounding_parse(spark, sf_dir):
    """References of marked text with the boxes that belong to them."""
    rows = marked_chat(spark, sf_dir).select("record", "turn", F.explode(markers.parse(F.col("text"))).alias("x"))
    return rows.select("record", "turn", "x.ref", F.array_join(F.transform("x.boxes", lambda b: F.array_join(b, " ")), ";").alias("boxes"))


def _boxes(spark, sf_dir):
    return adapters.grounding_boxes(marked_chat(spark, sf_dir), ["record"], "turn", "text")


@query(f"WITH {_CHAT} SELECT record, object_id, ref AS phrase, x1, y1, x2, y2 FROM v_gobj")
def grounding_objects(spark, sf_dir):
    """Objects of marked text."""
    return adapters.grounding_objects(_boxes(spark, sf_dir), ["record"])


@query(
    f"""WITH {_CHAT}, q AS (SELECT record, turn, ref, list(object_id ORDER BY b) AS ids FROM v_gobj GROUP BY ALL)
SELECT record, 'q#' || (row_number() OVER (PARTITION BY record ORDER BY turn) - 1) AS query_id, ref AS query_text, CASE WHEN len(ids) = 1 THEN 'single_instance_grounding' ELSE 'multi_instance_grounding' END AS query_type,
  array_to_string(ids, ',') AS candidates, len(ids)::INT AS count, CASE WHEN len(ids) = 1 THEN ids[1] END AS gold FROM q"""
)
def grounding_queries(spark, sf_dir):
    """Queries of marked text."""
    rows = adapters.grounding_queries(_boxes(spark, sf_dir), ["record"], "turn")
    return rows.withColumn("candidates", F.array_join("candidates", ","))


@query(
    f"""{V} SELECT sample_id AS record, 's' || sample_id AS sample, pos - 1 AS pos, CASE WHEN pos % 4 = 0 THEN 'obj#' || (pos - 1) ELSE object_id END AS object_id, CASE pos % 3 WHEN 0 THEN category WHEN 1 THEN phrase ELSE '' END AS category,
  CASE WHEN pos % 2 = 0 THEN cx END AS cx, CASE WHEN pos % 2 = 0 THEN cy END AS cy FROM v_object"""
)
def adapter_alias(spark, sf_dir):
    """3D source records that name their fields in different ways."""
    o = views.objects(spark, sf_dir)
    k = F.col("pos")
    given = F.to_json(
        F.struct(
            F.when(k % 4 == 1, F.col("object_id")).alias("id"),
            F.when(k % 4 == 2, F.col("object_id")).alias("instance_id"),
            F.when(k % 4 == 3, F.concat(F.lit(" "), F.col("object_id"))).alias("object_id"),
            F.when(k % 3 == 0, F.col("category")).otherwise(F.lit("  ")).alias("category"),
            F.when(k % 3 == 1, F.col("phrase")).alias("label"),
            F.when(k % 2 == 0, F.array("cx", "cy", "cz")).otherwise(F.array("cx", "cy")).alias("centroid"),
        )
    )
    items = o.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos", given.alias("o")))).alias("x"))
    value = F.concat(F.lit('{"scene_id":" s'), F.col("sample_id").cast("string"), F.lit('","instances":['), F.array_join(F.col("x.o"), ","), F.lit("]}"))
    rows = adapters.scene_objects(items.select(F.col("sample_id").alias("record"), value.alias("value")))
    return rows.select("record", F.col("sample_id").alias("sample"), "pos", "object_id", "category", "cx", "cy")


@query(f"{V} SELECT sample_id, pos, CASE WHEN pos % 3 = 0 THEN category WHEN pos % 7 = 1 THEN object_id ELSE trim(phrase) END AS name FROM v_object")
def display_name(spark, sf_dir):
    """The first name that is not blank."""
    k = F.col("pos")
    phrase = F.when(k % 3 == 0, F.lit(" ")).when(k % 7 == 1, F.lit(None).cast("string")).otherwise(F.col("phrase"))
    category = F.when(k % 3 == 0, F.col("category")).otherwise(F.lit(""))
    return views.objects(spark, sf_dir).select("sample_id", "pos", t.display_name(phrase, category, F.col("object_id")).alias("name"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN 'the object' ELSE 'the ' || p_name END AS np FROM part")
def np_normalize(spark, sf_dir):
    """Noun phrases with one determiner."""
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, F.concat(F.lit(" The  "), F.col("p_name"))).when(k == 1, F.concat(F.lit("an "), F.col("p_name"))).when(k == 2, F.col("p_name")).otherwise(F.lit(" a "))
    raw = F.when(k == 3, F.lit("  ")).otherwise(raw)
    return views.read(spark, sf_dir, "part").select("p_partkey", t.noun_phrase(raw).alias("np"))


@query("SELECT p_partkey, 'Is ' || p_name || ' (' || p_brand || ') near ' || p_brand || '? ' || upper(p_name[1]) || p_name[2:] || ' is.' AS text FROM part")
def template_fill(spark, sf_dir):
    """Templates with values in brackets and braces."""
    text = t.fill(F.lit("Is [A] ([B]) near [B]? {Name} is."), A=F.col("p_name"), B=F.col("p_brand"))
    return views.read(spark, sf_dir, "part").select("p_partkey", t.brace_format(text, name=F.col("p_name")).alias("text"))


@query(
    """SELECT doc_id, CASE WHEN strpos(p, 'Answer: ') > 0 THEN '<image><image>' || trim(p[:strpos(p, 'Answer: ') - 1]) END AS question, CASE WHEN strpos(p, 'Answer: ') > 0 THEN trim(p[strpos(p, 'Answer: ') + 8:]) END AS answer
FROM (SELECT doc_id, 'What is ' || lang || CASE WHEN doc_id % 5 = 0 THEN '' ELSE '? Answer: ' || source || ' Answer: ' || n_chars || ' ' END AS p FROM documents)"""
)
def split_qa(spark, sf_dir):
    """Prompts cut at their first answer mark."""
    p = F.concat(F.lit("What is "), F.col("lang"), F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("? Answer: "), F.col("source"), F.lit(" Answer: "), F.col("n_chars").cast("string"), F.lit(" "))))
    q, a = t.split_qa(p, F.lit(2))
    return views.read(spark, sf_dir, "documents").select("doc_id", q.alias("question"), a.alias("answer"))


@query(
    """WITH m AS (SELECT *, lead(role) OVER w AS r2, lead(text) OVER w AS t2, row_number() OVER w AS k FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, k AS at, md5(coalesce(text, '')) AS question, md5(CASE WHEN r2 = 'assistant' THEN t2 ELSE '' END) AS answer FROM m WHERE role = 'user'"""
)
def chat_turns(spark, sf_dir):
    """Questions and the answers right after them."""
    c = views.read(spark, sf_dir, "conversations")
    rows = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    at = F.filter(F.transform("m", lambda x, i: F.when(x["role"] == "user", i + 1)), lambda i: i.isNotNull())
    rows = rows.select("conv_id", F.explode(F.arrays_zip(at.alias("at"), chat.turns(F.col("m")).alias("x"))).alias("e"))
    return rows.select("conv_id", F.col("e.at").cast("long").alias("at"), F.md5(F.coalesce("e.x.question", F.lit(""))).alias("question"), F.md5("e.x.answer").alias("answer"))


def _visual(o):
    k = F.col("pos") % 4
    roles = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("target"))).otherwise(F.array(F.lit("target"), F.lit("anchor")))
    colors = F.when(k == 0, F.create_map().cast("map<string,string>")).when(k == 1, F.create_map(F.lit("target"), F.lit("red"))).otherwise(F.create_map(F.lit("target"), F.lit("blue"), F.lit("anchor"), F.lit("red")))
    n = F.when(k == 0, 0).when(k == 1, 1).otherwise(2)
    return o.withColumns({"roles": roles, "colors": colors, "n_marked": n})


_KEY = "CASE pos % 4 WHEN 0 THEN 'original' WHEN 1 THEN 'target#target:red#1' ELSE 'anchor,target#anchor:red,target:blue#2' END"


@query(f"{V} SELECT sample_id, pos, {_KEY} AS visual_key, sha256({_KEY})[:8] AS suffix FROM v_object")
def visual_key(spark, sf_dir):
    """Keys of the pictures that questions need."""
    key = t.visual_key(F.col("roles"), F.col("colors"), F.col("n_marked"))
    return _visual(views.objects(spark, sf_dir)).select("sample_id", "pos", key.alias("visual_key"), t.mark_suffix(key).alias("suffix"))


@query(f"{V} SELECT sample_id, {_KEY} AS visual_key, row_number() OVER (PARTITION BY sample_id ORDER BY min(pos)) - 1 AS grp, string_agg(object_id, ',' ORDER BY pos) AS items FROM v_object GROUP BY sample_id, visual_key")
def visual_groups(spark, sf_dir):
    """Questions by the picture they share."""
    items = _visual(views.objects(spark, sf_dir)).withColumns({"question": F.col("object_id"), "answer": F.col("category")})
    rows = chat.visual_groups(items, t.visual_key(F.col("roles"), F.col("colors"), F.col("n_marked")))
    return rows.select("sample_id", "visual_key", F.col("group").cast("long").alias("grp"), F.array_join(F.col("items.question"), ",").alias("items"))


@query(f"{V} SELECT DISTINCT {_KEY} AS visual_key, sha256({_KEY})[:12] AS long_suffix, sha256({_KEY})[:4] AS short_suffix FROM v_object")
def mark_suffix(spark, sf_dir):
    """Suffixes of bounded length."""
    key = t.visual_key(F.col("roles"), F.col("colors"), F.col("n_marked"))
    rows = _visual(views.objects(spark, sf_dir)).select(key.alias("visual_key")).distinct()
    return rows.select("visual_key", t.mark_suffix(F.col("visual_key"), 12).alias("long_suffix"), t.mark_suffix(F.col("visual_key"), 1).alias("short_suffix"))


_PATH = "CASE page_id % 3 WHEN 0 THEN '../' WHEN 1 THEN './/' ELSE '' END || replace(replace(url, ':', ''), '/', CASE WHEN page_id % 2 = 0 THEN chr(92) ELSE '//' END)"
_CLEAN = f"regexp_replace(regexp_replace(replace({_PATH}, chr(92), '/'), '/+', '/', 'g'), '^[./]+', '')"


def _paths(spark, sf_dir):
    u = F.replace(F.col("url"), F.lit(":"), F.lit(""))
    k = F.col("page_id")
    body = F.replace(u, F.lit("/"), F.when(k % 2 == 0, F.lit("\\")).otherwise(F.lit("//")))
    return views.read(spark, sf_dir, "pages").select("page_id", F.concat(F.when(k % 3 == 0, "../").when(k % 3 == 1, ".//").otherwise(""), body).alias("path"))


@query(f"SELECT page_id, {_CLEAN} AS path FROM pages")
def posix_path(spark, sf_dir):
    """Paths with single forward slashes."""
    return _paths(spark, sf_dir).select("page_id", t.posix_path(F.col("path")).alias("path"))


@query(f"SELECT page_id, regexp_replace({_CLEAN}, '\\.[^./]*$', '') || '_m' || sha256('k' || page_id)[:8] || '.jpg' AS path FROM pages")
def marked_path(spark, sf_dir):
    """Where marked copies go."""
    return _paths(spark, sf_dir).select("page_id", t.marked_path(F.col("path"), F.concat(F.lit("k"), F.col("page_id").cast("string"))).alias("path"))


_SAYS = """{"type":"text","text":{"type":"text","format":"utf-8","string":"' || %s || '"}}"""
_IMG = """CASE WHEN k = 1 THEN '{"type":"image","image":{"type":"relative_path","format":"image/jpeg","relative_path":"' || path || '","width":640,"height":480}},' ELSE '' END"""
_ROW = f"""'{{"meta_prompt":[""],"data":[' || string_agg('{{"role":"user","content":[' || {_IMG} || '{_SAYS % "object_id"}]}},{{"role":"assistant","content":[{_SAYS % "category"}]}}', ',' ORDER BY pos) || '],"id":""}}'"""


@query(
    f"""{V}, g AS (SELECT *, {_KEY} AS visual_key FROM v_object), h AS (SELECT *, CASE WHEN visual_key = 'original' THEN 'im/' || sample_id || '.jpg' ELSE 'im/' || sample_id || '_m' || sha256(visual_key)[:8] || '.jpg' END AS path,
  row_number() OVER (PARTITION BY sample_id, visual_key ORDER BY pos) AS k FROM g)
SELECT sample_id, path, {_ROW} AS row FROM h GROUP BY sample_id, visual_key, path"""
)
def training_row_json(spark, sf_dir):
    """Training rows as JSON."""
    items = _visual(views.objects(spark, sf_dir)).withColumns(
        {"question": F.col("object_id"), "answer": F.col("category"), "path": F.concat(F.lit("im/"), F.col("sample_id").cast("string"), F.lit(".jpg")), "width": F.lit(640), "height": F.lit(480)}
    )
    return chat.build_training_rows(items).select("sample_id", "path", "row")


@query(
    """SELECT p_partkey, replace(coalesce(list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(n, '[oO]bj', '', 'g'), '^_+|_+$', '', 'g'), '[0-9_]*[0-9][0-9_]*'), lambda x: regexp_replace(x, '[A-Z_]+$', '')), lambda x: x <> '')[-1], '').lower(), '_', ' ') AS name
FROM (SELECT p_partkey, 'Obj_' || p_partkey || '_' || replace(p_name, ' ', '_') || CASE p_partkey % 3 WHEN 0 THEN '_XA' WHEN 1 THEN '_7_B' ELSE '' END AS n FROM part)"""
)
def object_name_clean(spark, sf_dir):
    """Readable names of generated objects."""
    k = F.col("p_partkey")
    raw = F.concat(F.lit("Obj_"), k.cast("string"), F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.when(k % 3 == 0, "_XA").when(k % 3 == 1, "_7_B").otherwise(""))
    return views.read(spark, sf_dir, "part").select("p_partkey", t.clean_object_name(raw).alias("name"))


@query(
    f"""{V}, a AS (SELECT *, CASE WHEN (l_partkey + pos) % 6 = 0 THEN NULL WHEN (l_partkey + pos) % 6 = 1 THEN '' ELSE 'new ' || phrase END AS p, CASE WHEN (l_partkey + pos) % 6 = 2 THEN 'chair' END AS c, pos % 2 = 0 AS asked FROM v_object)
SELECT sample_id, object_id, CASE WHEN asked AND p IS NOT NULL THEN p ELSE phrase END AS phrase, CASE WHEN asked AND p IS NOT NULL THEN coalesce(c, category) ELSE category END AS category FROM a WHERE NOT asked OR p IS NULL OR p <> ''"""
)
def expression_refresh(spark, sf_dir):
    """Objects after a model's answers: blank phrases drop them, failed calls keep them."""
    o = views.objects(spark, sf_dir).select("sample_id", "pos", "object_id", "phrase", "category", "l_partkey")
    k = (F.col("l_partkey") + F.col("pos")) % 6
    body = F.to_json(F.struct(F.when(k == 1, "").otherwise(F.concat(F.lit(" new "), F.col("phrase"))).alias("phrase"), F.when(k == 2, " Chair ").alias("category")))
    answers = o.filter("pos % 2 = 0").select("sample_id", "object_id", F.when(k != 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).alias("answer"))
    return adapters.refresh_expressions(o, answers).select("sample_id", "object_id", "phrase", "category")


@query("SELECT p_partkey, CASE WHEN p_retailprice / 1000 < 1 THEN printf('%.2f', p_retailprice / 10) || ' cm' ELSE printf('%.2f', round_even(p_retailprice / 1000, 2)) || ' m' END AS text FROM part")
def length_text(spark, sf_dir):
    """Lengths in the unit that suits them."""
    value, unit = t.length_text(F.col("p_retailprice") / 1000)
    return views.read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", value, unit).alias("text"))
