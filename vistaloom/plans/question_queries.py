"""Question items with their texts, over the canonical views; the SQL fills the same templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vistaloom.functions import direction, templates
from vistaloom.functions import geometry3d as g
from vistaloom.functions.text import MARK_COLORS
from vistaloom.operators import qa_geometry, qa_items, questions, relations
from vistaloom.plans import relation_queries as rel
from vistaloom.plans import space_queries as space
from vistaloom.plans import views
from vistaloom.plans.registry import Registry

query = Registry()


def sql_draw(seed: int, *keys: str) -> str:
    """``questions.draw`` in SQL."""
    return f"(('0x' || md5('{seed}|' || {" || '|' || ".join(keys)})[:13])::BIGINT / 4503599627370496)"


def sql_fill(name: str, u: str, condition: str | None = None, **values: str) -> tuple[str, str]:
    """``templates.render`` in SQL."""

    def pick(pool: tuple[str, ...]) -> str:
        texts = ", ".join("'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for x in pool)
        out = f"([{texts}])[(floor({u} * {len(pool)}) + 1)::INT]"
        for key, value in values.items():
            out = f"replace({out}, '[{key}]', {value})"
        return out

    t = templates.REGISTRY[name]
    answer = pick(t.answers) if condition is None else f"CASE WHEN {condition} THEN {pick(t.true)} ELSE {pick(t.false)} END"
    return pick(t.questions), answer


def _words(i: int, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v[i]}'" for k, v in direction.DIRECTIONS.items()) + " ELSE 'near' END"


_KEYS = ("sample_id", "anchor_id", "target_id")
_NAME = "'the ' || trim(regexp_replace(trim({}), '^(?:the|a|an)\\s+', '', 'i'))"
_SAID = {"T": "tt", "R": "at_"}
_AXIS = sql_fill("rel2d.single_axis", "u6", A="CASE WHEN u5 < 0.5 THEN snd ELSE fst END", B="CASE WHEN u5 < 0.5 THEN fst ELSE snd END", X="truth", **_SAID)
_FULL = sql_fill("rel2d.full_sentence", "u6", X="phrase", **_SAID)
_JUDGED = sql_fill("rel2d.judgment", "u6", "mode = 'correct'", S="said", X="phrase", **_SAID)
_STYLED = [f"CASE style WHEN 'single_axis' THEN {_AXIS[i]} WHEN 'full_sentence' THEN {_FULL[i]} ELSE {_JUDGED[i]} END" for i in (0, 1)]


@query(
    f"""{rel.R2[:-1]}, e AS (SELECT sample_id, a_id AS anchor_id, b_id AS target_id, predicate, parts, round_even(du, 0) AS du, round_even(dv, 0) AS dv, row_number() OVER (PARTITION BY sample_id ORDER BY a_id, b_id) AS pos FROM v_out WHERE reason IS NULL),
nm AS (SELECT sample_id, object_id, {_NAME.format("phrase")} AS name, count(*) OVER (PARTITION BY sample_id, lower({_NAME.format("phrase")})) = 1 AS uniq FROM v_object),
cand AS (SELECT e.*, x.name AS an, y.name AS tn, x.uniq AS au, y.uniq AS tu, CASE WHEN x.uniq AND y.uniq THEN 0 WHEN x.uniq OR y.uniq THEN 1 ELSE 2 END AS mark_tier
  FROM e JOIN nm x ON x.sample_id = e.sample_id AND x.object_id = anchor_id JOIN nm y ON y.sample_id = e.sample_id AND y.object_id = target_id),
k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY mark_tier, pos) AS k FROM cand),
u AS (SELECT *, CASE WHEN k <= 2 THEN 'single_axis' WHEN k <= 4 THEN 'full_sentence' ELSE 'judgment' END AS style, {", ".join(f"{sql_draw(7 + i, *_KEYS)} AS u{i}" for i in range(7))}, abs(du) AS a, abs(dv) AS b,
  split_part(parts, ',', 1) AS c1, split_part(parts, ',', 2) AS c2 FROM k WHERE k <= 6),
r AS (SELECT *, CASE WHEN mark_tier = 0 THEN (CASE WHEN u0 >= 0.82 THEN [CASE WHEN u1 < 0.5 THEN 'anchor' ELSE 'target' END] ELSE []::VARCHAR[] END)
    ELSE list_filter([CASE WHEN NOT au THEN 'anchor' END, CASE WHEN NOT tu THEN 'target' END], lambda x: x IS NOT NULL) END AS roles,
  CASE WHEN parts IS NULL THEN predicate WHEN abs(a - b) / greatest(a, b) <= 0.2 THEN (CASE WHEN u3 < a / (a + b) THEN c1 ELSE c2 END) WHEN a >= b THEN c1 ELSE c2 END AS truth,
  coalesce(parts IS NOT NULL AND least(a, b) / greatest(a, b) >= 0.75, false) AS ok, {_words(0, "coalesce(parts, predicate)")} AS phrase, {_words(1, "coalesce(parts, predicate)")} AS opposite FROM u),
m AS (SELECT *, u4 * (CASE WHEN ok THEN 1.0 ELSE 0.85 END)::DOUBLE AS w, list_position(roles, 'anchor') AS ra, list_position(roles, 'target') AS rt FROM r WHERE len(roles) < 2 OR u2 < 0.1),
t AS (SELECT *, CASE WHEN w < 0.5 THEN 'incorrect' WHEN ok AND w < 0.65 THEN 'partial' ELSE 'correct' END AS mode,
  CASE WHEN coalesce(ra, 0) > 0 THEN an || ' in the ' || (['{MARK_COLORS[0]}', '{MARK_COLORS[1]}'])[ra] || ' box' ELSE an END AS at_, CASE WHEN coalesce(rt, 0) > 0 THEN tn || ' in the ' || (['{MARK_COLORS[0]}', '{MARK_COLORS[1]}'])[rt] || ' box' ELSE tn END AS tt,
  CASE WHEN truth IN ('left', 'right') THEN 'left' ELSE 'above' END AS fst, CASE WHEN truth IN ('left', 'right') THEN 'right' ELSE 'below' END AS snd FROM m),
s AS (SELECT *, CASE mode WHEN 'correct' THEN phrase WHEN 'partial' THEN {_words(0, "truth")} ELSE opposite END AS said FROM t)
SELECT sample_id, 'qa#' || (row_number() OVER (PARTITION BY sample_id ORDER BY list_position(['single_axis', 'full_sentence', 'judgment'], style), mark_tier, pos) - 1) AS qa_id, style,
  CASE WHEN style = 'single_axis' THEN 'MCQ' ELSE 'open_ended' END AS question_type, {_STYLED[0]} AS question, {_STYLED[1]} AS answer, 'relation#' || (pos - 1) AS relation_id, mark_tier, len(roles)::INT AS n_marked, pos::INT AS pos FROM s"""
)
def qa2d_items(spark, sf_dir):
    """Questions about image-plane relations."""
    rows = space.asked_relations(spark, sf_dir).withColumn("relation_id", F.lit(None).cast("string"))
    return qa_items.relation_2d(relations.with_relation_ids(rows), None, seed=7).drop("roles", "colors")


_FLIP = "list_concat([CASE c[1] " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in direction.FLIPS.items()) + " END], c[2:])"
_ATOMIC = sql_fill("rel3d.atomic", "u2", X="predicate", T="tn", R="an")
_WHOLE = sql_fill("rel3d.composite", "u2", X="array_to_string(c, ' and ')", T="tn", R="an")
_JUDGE3 = sql_fill("rel3d.judgment", "u2", "NOT flip", S=f"CASE WHEN flip THEN array_to_string({_FLIP}, ' and ') ELSE array_to_string(c, ' and ') END", T="tn", R="an")
_STYLED3 = [f"CASE style WHEN 'atomic' THEN {_ATOMIC[i]} WHEN 'composite' THEN {_WHOLE[i]} ELSE {_JUDGE3[i]} END" for i in (0, 1)]


@query(
    rel._R3[:-1]
    + f""", nm AS (SELECT sample_id, object_id, {_NAME.format("phrase")} AS name FROM v_object),
u AS (SELECT sample_id, anchor_id, target_id, predicate, c, {", ".join(f"{sql_draw(11 + i, *_KEYS)} AS u{i}" for i in range(3))} FROM g3 WHERE reason IS NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY u0, anchor_id, target_id) AS k, u1 < 0.5 AS flip FROM u),
q3 AS (SELECT k.*, CASE WHEN k <= 2 THEN 'atomic' WHEN k <= 4 THEN 'composite' ELSE 'judgment' END AS style, x.name AS an, y.name AS tn
  FROM k JOIN nm x ON x.sample_id = k.sample_id AND x.object_id = anchor_id JOIN nm y ON y.sample_id = k.sample_id AND y.object_id = target_id WHERE k <= 6)
SELECT sample_id, 'qa#' || (k - 1) AS qa_id, style, {_STYLED3[0]} AS question, {_STYLED3[1]} AS answer, anchor_id, target_id FROM q3"""
)
def qa3d_items(spark, sf_dir):
    """Questions about egocentric relations."""
    rows = relations.relation_3d(relations.pairs(questions.named(views.objects(spark, sf_dir)), ["cx", "cy", "cz", "name"])).filter("reason is null")
    rows = rows.select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "predicate", "components", F.col("a_name").alias("anchor_name"), F.col("b_name").alias("target_name"))
    return qa_items.relation_3d(rows, None, seed=11)


_ORDER = sql_fill("depth.order", sql_draw(3, "sample_id"), A="array_to_string(shuf3, ', ')", X="array_to_string(names, ', ')")
_NTH = sql_fill("depth.nth", "u", A="array_to_string(shuf4, ', ')", N="place::VARCHAR", X="names[place]")


@query(
    f"""{space.V}, n AS (SELECT sample_id, list(object_id ORDER BY cz, object_id) AS names, list(object_id ORDER BY {sql_draw(3, "sample_id", "object_id")}, object_id) AS shuf3, list(object_id ORDER BY {sql_draw(4, "sample_id", "object_id")}, object_id) AS shuf4,
  count(*) AS n, {sql_draw(4, "sample_id")} AS u, {sql_draw(5, "sample_id")} AS u5 FROM v_object GROUP BY sample_id HAVING count(*) > 1),
p AS (SELECT *, (CASE WHEN u < 0.4 THEN n WHEN u < 0.8 THEN 1 ELSE floor(u5 * n) + 1 END)::INT AS place FROM n)
SELECT sample_id, {_ORDER[0]} AS order_question, {_ORDER[1]} AS order_answer, place, {_NTH[0]} AS question, {_NTH[1]} AS answer FROM p"""
)
def depth_questions(spark, sf_dir):
    """Questions about the order in depth."""
    rows = views.objects(spark, sf_dir).groupBy("sample_id").agg(F.collect_list(F.struct(F.col("cz").alias("depth"), F.col("object_id").alias("name"))).alias("objects")).filter(F.size("objects") > 1)
    return qa_geometry.depth_nth(qa_geometry.depth_order(rows, 3).withColumnsRenamed({"question": "order_question", "answer": "order_answer"}), 4).drop("objects")


_BIG, _SMALL = sql_fill("size.bigger", "0", "av > bv", A="a", B="b"), sql_fill("size.smaller", "0", "av < bv", A="a", B="b")
_SIZE = [f"CASE WHEN {sql_draw(2, 'a', 'b')} < 0.5 THEN {_BIG[i]} ELSE {_SMALL[i]} END" for i in (0, 1)]
_CAMERA = sql_fill("distance.camera", "0", A="a", B="b", X="CASE WHEN abs(ad - bd) < 0.08 THEN 'about the same' WHEN ad < bd THEN a ELSE b END")
_COMPASS = """CASE WHEN t > 165 OR t <= -165 THEN 'back' WHEN t > -15 AND t <= 15 THEN 'front' WHEN t > 15 AND t <= 75 THEN 'front-right' WHEN t > 75 AND t <= 105 THEN 'right' WHEN t > 105 AND t <= 165 THEN 'back-right'
  WHEN t > -165 AND t <= -105 THEN 'back-left' WHEN t > -105 AND t <= -75 THEN 'left' ELSE 'front-left' END"""
_BEARING = sql_fill("views.direction", "0", D=f"({list(direction.COMPASS)})[turn + 1]", A="a", B="b", X=_COMPASS)


@query(
    f"""{space.BOXES}, o AS (SELECT *, xl * yl * zl AS v, sqrt(cx * cx + cy * cy + cz * cz) AS d FROM v_box),
p AS (SELECT a.sample_id, a.object_id AS a, b.object_id AS b, a.v AS av, b.v AS bv, a.d AS ad, b.d AS bd, b.cx - a.cx AS dx, b.cy - a.cy AS dy FROM o a JOIN o b ON a.sample_id = b.sample_id AND a.object_id < b.object_id),
r AS (SELECT *, floor({sql_draw(3, "a", "b")} * 8)::INT AS turn FROM p), w AS (SELECT *, degrees(atan2(dx, dy)) - 45 * turn AS t0 FROM r), z AS (SELECT *, CASE WHEN t0 <= -180 THEN t0 + 360 ELSE t0 END AS t FROM w)
SELECT sample_id, 'size' AS kind, a, b, {_SIZE[0]} AS question, {_SIZE[1]} AS answer FROM p UNION ALL SELECT sample_id, 'camera', a, b, {_CAMERA[0]}, {_CAMERA[1]} FROM p UNION ALL SELECT sample_id, 'bearing', a, b, {_BEARING[0]}, {_BEARING[1]} FROM z"""
)
def pair_questions(spark, sf_dir):
    """Questions about pairs: size, distance to the camera and bearing."""
    rows = relations.pairs(space.boxes(spark, sf_dir).withColumns({"v": g.volume(space._c(space.SIZE)), "d": g.norm(space._c(space.CENTER))}), ["v", "d", "cx", "cy"])
    rows = rows.withColumns({"a": F.col("a_object_id"), "b": F.col("b_object_id"), "dx": F.col("b_cx") - F.col("a_cx"), "dy": F.col("b_cy") - F.col("a_cy")})
    out = None
    for kind, made in (("size", qa_geometry.size(rows, 1)), ("camera", qa_geometry.camera_distance(rows, 2)), ("bearing", qa_geometry.bearing(rows, 3))):
        one = made.select("sample_id", F.lit(kind).alias("kind"), "a", "b", "question", "answer")
        out = one if out is None else out.unionByName(one)
    return out


_MATCHED = sql_fill("views.correspondence", "0", Y="array_to_string(list_transform(options, lambda x, i: 'ABCD'[i] || ': ' || x), chr(10))", X="'ABCD'[list_position(options, truth)]")


@query(
    f"""{space.V}, m AS (SELECT sample_id AS pair, x1 AS u, y1 AS v FROM v_object WHERE pos = 1), c AS (SELECT pair, u, v, x1 AS pu, y1 AS pv FROM m JOIN v_object ON sample_id = pair WHERE sqrt((x1 - u) * (x1 - u) + (y1 - v) * (y1 - v)) >= 20),
k AS (SELECT *, row_number() OVER (PARTITION BY pair, u, v ORDER BY {sql_draw(9, "pair", "pu", "pv")}, pu, pv) AS k FROM c),
w AS (SELECT pair, u, v, '(' || u || ', ' || v || ')' AS truth, list('(' || pu || ', ' || pv || ')') AS wrong FROM k WHERE k < 4 GROUP BY pair, u, v HAVING count(*) = 3),
x AS (SELECT pair, u, v, truth, unnest(list_concat([truth], wrong)) AS x FROM w), o AS (SELECT pair, u, v, truth, list(x ORDER BY {sql_draw(10, "pair", "x")}, x) AS options FROM x GROUP BY ALL)
SELECT pair, u, v, {_MATCHED[0]} AS question, {_MATCHED[1]} AS answer FROM o"""
)
def correspondences(spark, sf_dir):
    """Which pixel of another view shows a marked point."""
    rows = views.objects(spark, sf_dir).select(F.col("sample_id").alias("pair"), "pos", "x1", "y1")
    matches = rows.filter("pos = 1").select("pair", F.col("x1").alias("u"), F.col("y1").alias("v"))
    return qa_geometry.correspondence(matches, rows.select("pair", F.col("x1").alias("pu"), F.col("y1").alias("pv")), 9).drop("wrong", "options")
