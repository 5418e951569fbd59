"""Objects, relations and deduplication: queries over the canonical views, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.functions import direction
from vistaloom.functions import geometry2d as g
from vistaloom.operators import dedup, objects, relations
from vistaloom.plans import views
from vistaloom.plans.registry import Registry

query = Registry()
BOX = ["x1", "y1", "x2", "y2"]

_AREA = "greatest(0, {0}x2 - {0}x1) * greatest(0, {0}y2 - {0}y1)"
_INTER = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"
_PAIRS = f"""v_pair AS (SELECT a.sample_id, a.object_id AS a_id, b.object_id AS b_id, a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2,
  (b.x1 + b.x2) / 2 - (a.x1 + a.x2) / 2 AS du, (b.y1 + b.y2) / 2 - (a.y1 + a.y2) / 2 AS dv,
  {_INTER} AS inter, {_AREA.format("a.")} AS aa, {_AREA.format("b.")} AS ab
FROM v_object a JOIN v_object b ON a.sample_id = b.sample_id AND a.object_id < b.object_id)"""
_RULES = """v_rel AS (SELECT *, CASE WHEN aa + ab - inter > 0 AND inter / (aa + ab - inter) > 0.5 THEN 'high_iou' WHEN sqrt(du * du + dv * dv) < 100 THEN 'near_center'
  WHEN least(aa, ab) > 0 AND inter / least(aa, ab) >= 0.8 THEN 'containment' WHEN abs(du) < 100 AND abs(dv) < 100 THEN 'tiny_delta' END AS reason,
  CASE WHEN abs(du) >= 100 THEN (CASE WHEN du > 0 THEN 'right' ELSE 'left' END) END AS side,
  CASE WHEN abs(dv) >= 100 THEN (CASE WHEN dv > 0 THEN 'below' ELSE 'above' END) END AS lev FROM v_pair),
v_out AS (SELECT *, CASE WHEN reason IS NULL THEN coalesce(side, lev) END AS predicate, CASE WHEN reason IS NULL AND side IS NOT NULL AND lev IS NOT NULL THEN side || ',' || lev END AS parts FROM v_rel)"""
R2 = f"WITH {views.OBJECTS}, {_PAIRS}, {_RULES} "
R2E = f"WITH {views.OBJECTS}, {views.EDGES}, {_PAIRS}, {_RULES} "


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.relation_2d(relations.image_pairs(views.objects(spark, sf_dir)))


_PHRASE = "CASE coalesce(parts, predicate) " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in direction.DIRECTIONS.items()) + " ELSE 'near' END"
_OPPOSITE = "CASE coalesce(parts, predicate) " + " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in direction.DIRECTIONS.items()) + " ELSE 'near' END"
_SHORT = "CASE coalesce(parts, predicate) " + " ".join(f"WHEN '{k}' THEN '{v[2]}'" for k, v in direction.DIRECTIONS.items()) + " ELSE 'left' END"


@query(R2 + f"SELECT phrase, count(*) AS n, count(DISTINCT sample_id) AS n_samples FROM (SELECT sample_id, {_PHRASE} AS phrase FROM v_out WHERE reason IS NULL) GROUP BY phrase")
def rel2d_directions(spark, sf_dir):
    """Relations by direction phrase."""
    rows = derived(spark, sf_dir).filter("reason is null")
    rows = rows.select("sample_id", direction.phrase(F.col("components"), F.col("predicate")).alias("phrase"))
    return rows.groupBy("phrase").agg(F.count("*").alias("n"), F.countDistinct("sample_id").alias("n_samples"))


@query(R2 + "SELECT sample_id, a_id AS anchor_id, b_id AS target_id, predicate, coalesce(parts, '') AS components FROM v_out WHERE reason IS NULL")
def rel2d_edges(spark, sf_dir):
    """The image-plane relations of every pair."""
    rows = derived(spark, sf_dir).filter("reason is null")
    return rows.select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "predicate", F.coalesce(F.array_join("components", ","), F.lit("")).alias("components"))


@query(R2 + "SELECT coalesce(predicate, reason) AS outcome, count(*) AS n FROM v_out GROUP BY ALL")
def rel2d_drop_reasons(spark, sf_dir):
    """Every pair by its outcome."""
    return derived(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    R2
    + """SELECT sample_id, a_id AS anchor_id, b_id AS target_id, 'bbox_center+bbox_center' AS method, round_even((ax1 + ax2) / 2, 0)::INT AS au, round_even((ay1 + ay2) / 2, 0)::INT AS av,
  round_even((bx1 + bx2) / 2, 0)::INT AS bu, round_even((by1 + by2) / 2, 0)::INT AS bv, round_even(du, 0)::INT AS du, round_even(dv, 0)::INT AS dv,
  CASE WHEN parts IS NOT NULL THEN sign(du)::INT ELSE 0 END AS sign_right, CASE WHEN parts IS NOT NULL THEN -sign(dv)::INT ELSE 0 END AS sign_above FROM v_out WHERE reason IS NULL"""
)
def rel2d_evidence(spark, sf_dir):
    """What each relation was derived from."""
    rows = derived(spark, sf_dir).filter("reason is null").na.fill(0, ["sign_right", "sign_above"])
    return rows.select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "method", "au", "av", "bu", "bv", "du", "dv", "sign_right", "sign_above")


@query(
    R2E
    + """SELECT sample_id, a_id AS anchor_id, b_id AS target_id, coalesce(predicate, reason) AS outcome FROM v_out
WHERE NOT EXISTS (SELECT 1 FROM v_edge e WHERE e.sample_id = v_out.sample_id AND anchor_id = a_id AND target_id = b_id AND ref_frame = 'image_plane' AND source <> 'computed')"""
)
def rel2d_skip_existing(spark, sf_dir):
    """Pairs without an edge that was known before, and their outcome."""
    known = relations.strip_computed(views.edges(spark, sf_dir))
    rows = relations.without_edges(relations.image_pairs(views.objects(spark, sf_dir)), known, "image_plane")
    return relations.relation_2d(rows).select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "outcome")


@query(
    R2E
    + """, k AS (SELECT DISTINCT sample_id, anchor_id, target_id FROM v_edge WHERE ref_frame = 'image_plane' AND source <> 'computed'),
p AS (SELECT o.sample_id, count(*) FILTER (k.sample_id IS NULL) AS n_pairs, count(*) FILTER (k.sample_id IS NOT NULL) AS n_skipped, count(*) FILTER (k.sample_id IS NULL AND reason IS NULL) AS n_relations
  FROM v_out o LEFT JOIN k ON k.sample_id = o.sample_id AND anchor_id = a_id AND target_id = b_id GROUP BY o.sample_id)
SELECT o.sample_id, count(*) AS n_in, count(*) AS n_kept, coalesce(any_value(n_pairs), 0) AS n_pairs, coalesce(any_value(n_skipped), 0) AS n_skipped, coalesce(any_value(n_relations), 0) AS n_relations
FROM v_object o LEFT JOIN p USING (sample_id) GROUP BY o.sample_id"""
)
def rel2d_stats(spark, sf_dir):
    """Counts of each sample's enrichment."""
    flagged = objects.with_drop_reasons(views.objects(spark, sf_dir).select("sample_id", "pos", "object_id", *BOX), min_area=0)
    flagged = flagged.withColumn("reason", F.lit(None).cast("string"))
    pairs = relations.with_known(relations.image_pairs(flagged), relations.strip_computed(views.edges(spark, sf_dir)), "image_plane")
    return relations.stats_2d(flagged, relations.relation_2d(pairs))


_R3 = f"""WITH {views.OBJECTS}, {views.EDGES}, p AS (SELECT a.sample_id, a.object_id AS anchor_id, b.object_id AS target_id, b.cx - a.cx AS dx, b.cy - a.cy AS dy, b.cz - a.cz AS dz
  FROM v_object a JOIN v_object b ON a.sample_id = b.sample_id AND a.object_id < b.object_id),
s AS (SELECT *, CASE WHEN dx > 0.05 THEN 1 WHEN dx < -0.05 THEN -1 ELSE 0 END AS r, CASE WHEN -dy > 0.05 THEN 1 WHEN -dy < -0.05 THEN -1 ELSE 0 END AS u, CASE WHEN -dz > 0.05 THEN 1 WHEN -dz < -0.05 THEN -1 ELSE 0 END AS f FROM p),
v AS (SELECT *, list_filter([CASE WHEN f > 0 THEN 'front' WHEN f < 0 THEN 'behind' END, CASE WHEN r > 0 THEN 'right' WHEN r < 0 THEN 'left' END, CASE WHEN u > 0 THEN 'above' WHEN u < 0 THEN 'below' END], lambda x: x IS NOT NULL) AS c FROM s),
g3 AS (SELECT *, CASE WHEN len(c) = 0 THEN 'tiny_delta_3d' END AS reason, CASE WHEN list_contains(c, 'front') THEN 'front' WHEN list_contains(c, 'right') THEN 'right' WHEN list_contains(c, 'above') THEN 'above' ELSE c[1] END AS predicate FROM v)
"""


def geometry_3d(spark, sf_dir):
    return relations.relation_3d(relations.pairs(views.objects(spark, sf_dir), ["cx", "cy", "cz"]))


@query(_R3 + "SELECT sample_id, anchor_id, target_id, predicate, array_to_string(c, ',') AS components, r AS sign_right, u AS sign_above, f AS sign_front, CASE WHEN dz < 0 THEN 'target_closer' WHEN dz > 0 THEN 'anchor_closer' ELSE 'tie' END AS front_order FROM g3 WHERE reason IS NULL")
def rel3d_edges(spark, sf_dir):
    """The egocentric relations of every pair."""
    rows = geometry_3d(spark, sf_dir).filter("reason is null")
    return rows.select("sample_id", F.col("a_object_id").alias("anchor_id"), F.col("b_object_id").alias("target_id"), "predicate", F.array_join("components", ",").alias("components"), "sign_right", "sign_above", "sign_front", "front_order")


@query(_R3 + "SELECT coalesce(reason, predicate) AS outcome, count(*) AS n FROM g3 GROUP BY ALL")
def rel3d_drop_reasons(spark, sf_dir):
    """Every pair by its outcome in 3D."""
    return geometry_3d(spark, sf_dir).groupBy(F.coalesce("reason", "predicate").alias("outcome")).agg(F.count("*").alias("n"))


_KNOWN3 = "(SELECT DISTINCT sample_id, anchor_id, target_id FROM v_edge WHERE ref_frame = 'egocentric' AND NOT starts_with(source, 'computed'))"


@query(_R3 + f"SELECT coalesce(source, 'computed_3d') AS source, count(*) AS n FROM g3 LEFT JOIN (SELECT * FROM v_edge WHERE ref_frame = 'egocentric' AND NOT starts_with(source, 'computed')) USING (sample_id, anchor_id, target_id) WHERE source IS NOT NULL OR reason IS NULL GROUP BY ALL")
def rel3d_sources(spark, sf_dir):
    """Egocentric relations by where they come from."""
    known = relations.strip_computed(views.edges(spark, sf_dir)).filter("ref_frame = 'egocentric'")
    new = relations.without_edges(relations.pairs(views.objects(spark, sf_dir), ["cx", "cy", "cz"]), known, "egocentric")
    new = relations.relation_3d(new).filter("reason is null").select(F.lit("computed_3d").alias("source"))
    # known edges run from the smaller to the larger position, pairs from the smaller to the larger id
    own = known.filter("anchor_id < target_id").select("source")
    return new.unionByName(own).groupBy("source").agg(F.count("*").alias("n"))


@query(
    _R3
    + """SELECT sample_id, anchor_id, target_id, array_to_string(list_sort(coalesce(components, [])), ',') AS annotated, array_to_string(list_sort(c), ',') AS inferred
FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY pos) AS k FROM v_edge JOIN g3 USING (sample_id, anchor_id, target_id)
  WHERE starts_with(source, 'annotated') AND reason IS NULL AND list_sort(list_distinct(coalesce(components, []))) <> list_sort(list_distinct(c))) WHERE k <= 20"""
)
def rel3d_conflicts(spark, sf_dir):
    """Annotated edges that the geometry contradicts."""
    rows = relations.conflicts_3d(views.edges(spark, sf_dir), geometry_3d(spark, sf_dir))
    joined = lambda c: F.array_join(F.array_sort(F.coalesce(c, F.array().cast("array<string>"))), ",")
    return rows.select("sample_id", "anchor_id", "target_id", joined("components").alias("annotated"), joined("inferred").alias("inferred"))


@query(
    f"""WITH {views.OBJECTS}, {views.EDGES}, n AS (SELECT *, coalesce(max(CASE WHEN regexp_matches(relation_id, '^relation#[0-9]+$') THEN relation_id[10:]::BIGINT END) OVER (PARTITION BY sample_id), -1) AS top,
  row_number() OVER (PARTITION BY sample_id, relation_id IS NULL ORDER BY pos) AS k FROM v_edge)
SELECT sample_id, pos, CASE WHEN relation_id IS NULL THEN 'relation#' || (top + k) ELSE relation_id END AS relation_id FROM n"""
)
def relation_ids(spark, sf_dir):
    """Edges with every id filled."""
    return relations.with_relation_ids(views.edges(spark, sf_dir)).select("sample_id", "pos", "relation_id")


@query(f"WITH {views.OBJECTS}, {views.EDGES} SELECT ref_frame, source, count(*) AS n FROM v_edge WHERE NOT (ref_frame = 'image_plane' AND source = 'computed') AND NOT (ref_frame = 'egocentric' AND starts_with(source, 'computed')) GROUP BY ALL")
def strip_computed(spark, sf_dir):
    """Edges that were not computed here, by frame and source."""
    return relations.strip_computed(views.edges(spark, sf_dir)).groupBy("ref_frame", "source").agg(F.count("*").alias("n"))


_REASON = f"""CASE WHEN x1 IS NOT NULL THEN (CASE WHEN x2 <= x1 OR y2 <= y1 THEN 'geom_invalid' WHEN least(x1, y1, x2, y2) < 0 OR greatest(x1, y1, x2, y2) >= 1000 THEN 'out_of_bounds'
  WHEN {_AREA.format("")} < 1 THEN 'min_area' WHEN greatest(greatest(1, x2 - x1) / greatest(1, y2 - y1), greatest(1, y2 - y1) / greatest(1, x2 - x1)) > 12 THEN 'aspect_ratio' END)
  WHEN u IS NULL AND v IS NULL THEN 'no_geometry' WHEN u IS NULL OR v IS NULL THEN 'geom_invalid' WHEN u < 0 OR u >= 1000 OR v < 0 OR v >= 1000 THEN 'out_of_bounds' END"""


@query(f"WITH {views.ROUGH} SELECT sample_id, pos, coalesce({_REASON}, 'kept') AS reason FROM v_rough")
def obj_filter_reasons(spark, sf_dir):
    """Why each object is dropped."""
    rows = objects.with_drop_reasons(views.rough_objects(spark, sf_dir))
    return rows.select("sample_id", "pos", F.coalesce("reason", F.lit("kept")).alias("reason"))


@query(
    f"""WITH {views.ROUGH}, r AS (SELECT *, {_REASON} AS reason, {_AREA.format("")} AS area FROM v_rough), m AS (SELECT *, max(CASE WHEN reason IS NULL AND x1 IS NOT NULL THEN area END) OVER (PARTITION BY sample_id) AS top FROM r)
SELECT sample_id, pos FROM m WHERE reason IS NULL AND (x1 IS NULL OR area >= 0.25 * top)"""
)
def obj_min_area_frac(spark, sf_dir):
    """Objects of at least a quarter of the largest box of their sample."""
    return objects.kept(views.rough_objects(spark, sf_dir), min_area_frac=0.25).select("sample_id", "pos")


@query(
    f"""WITH {views.ROUGH}, r AS (SELECT *, {_REASON} AS reason, CASE WHEN x1 IS NULL THEN 0 ELSE {_AREA.format("")} END AS area FROM v_rough),
k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY area DESC, object_id, pos) AS k FROM r WHERE reason IS NULL) SELECT sample_id, object_id FROM k WHERE k <= 3"""
)
def obj_topk_cap(spark, sf_dir):
    """The three largest objects of each sample."""
    return objects.kept(views.rough_objects(spark, sf_dir), max_objects=3).select("sample_id", "object_id")


@query(f"WITH {views.OBJECTS} SELECT sample_id, pos, greatest(0, least(999, round_even(l_partkey / 333 * 1000, 0)::INT)) AS n FROM v_object")
def norm_coords(spark, sf_dir):
    """Pixels to normalised integers."""
    return views.objects(spark, sf_dir).select("sample_id", "pos", g.normalize(F.col("l_partkey"), F.lit(333)).alias("n"))


@query(f"WITH {views.OBJECTS} SELECT sample_id, pos, round_even(x1 / 1000 * 641, 0)::INT AS px, round_even(y2 / 1000 * 481, 0)::INT AS py FROM v_object")
def denorm_coords(spark, sf_dir):
    """Normalised integers to pixels."""
    return views.objects(spark, sf_dir).select("sample_id", "pos", g.denormalize(F.col("x1"), F.lit(641)).alias("px"), g.denormalize(F.col("y2"), F.lit(481)).alias("py"))


@query(R2 + "SELECT sample_id, a_id, b_id, round(inter / (aa + ab - inter), 6) AS iou, round(inter / least(aa, ab), 6) AS ioa FROM v_pair WHERE inter > 0")
def iou_ioa(spark, sf_dir):
    """Overlap of every pair of boxes that meet."""
    rows = relations.pairs(views.objects(spark, sf_dir), BOX)
    a, b = g.columns("a_"), g.columns("b_")
    rows = rows.filter(g.intersection(a, b) > 0)
    return rows.select("sample_id", F.col("a_object_id").alias("a_id"), F.col("b_object_id").alias("b_id"), F.round(g.iou(a, b), 6).alias("iou"), F.round(g.containment(a, b), 6).alias("ioa"))


def _coarse(spark, sf_dir):
    """Objects on a coarse grid, so that boxes repeat."""
    rows = views.rough_objects(spark, sf_dir)
    return rows.select("sample_id", "pos", "object_id", "phrase", *[(F.col(c) / 400).cast("int").alias(c) for c in BOX])


_COARSE = f"WITH {views.ROUGH}, c AS (SELECT sample_id, pos, object_id, phrase, trunc(x1 / 400)::INT AS x1, trunc(y1 / 400)::INT AS y1, trunc(x2 / 400)::INT AS x2, trunc(y2 / 400)::INT AS y2 FROM v_rough), "


@query(_COARSE + "d AS (SELECT *, row_number() OVER (PARTITION BY sample_id, x1, y1, x2, y2, phrase ORDER BY pos) AS k FROM c) SELECT sample_id, object_id FROM d WHERE k = 1 OR x1 IS NULL")
def dedup_bbox_phrase(spark, sf_dir):
    """The first object of each box and phrase."""
    return dedup.dedup_objects(_coarse(spark, sf_dir)).select("sample_id", "object_id")


@query(_COARSE + "d AS (SELECT *, row_number() OVER (PARTITION BY sample_id, x1, y1, x2, y2 ORDER BY pos) AS k FROM c) SELECT sample_id, object_id FROM d WHERE k = 1 OR x1 IS NULL")
def dedup_bbox(spark, sf_dir):
    """The first object of each box."""
    return dedup.dedup_objects(_coarse(spark, sf_dir), by_phrase=False).select("sample_id", "object_id")


@query(
    _COARSE
    + views.QUERIES
    + """, d AS (SELECT *, row_number() OVER (PARTITION BY sample_id, x1, y1, x2, y2 ORDER BY pos) AS k FROM c), o AS (SELECT sample_id, list(object_id) AS ids FROM d WHERE k = 1 OR x1 IS NULL GROUP BY sample_id),
r AS (SELECT q.*, list_filter(candidates, lambda x: list_contains(ids, x)) AS left_ FROM v_query q JOIN o USING (sample_id))
SELECT sample_id, query_id, array_to_string(left_, ',') AS candidates, CASE WHEN list_contains(left_, gold) THEN gold WHEN gold IS NOT NULL THEN left_[1] WHEN len(left_) = 1 THEN left_[1] END AS gold,
  CASE WHEN count IS NOT NULL THEN len(left_) ELSE -1 END AS count FROM r WHERE len(left_) > 0"""
)
def query_rewrite(spark, sf_dir):
    """Queries over the objects that deduplication left."""
    left = dedup.dedup_objects(_coarse(spark, sf_dir), by_phrase=False)
    rows = dedup.rewrite_queries(views.queries(spark, sf_dir), left)
    return rows.select("sample_id", "query_id", F.array_join("candidates", ",").alias("candidates"), "gold", F.coalesce("count", F.lit(-1)).cast("long").alias("count"))


@query(
    f"""WITH {views.OBJECTS}, m AS (SELECT a.sample_id, CASE WHEN {_AREA.format("a.")} < {_AREA.format("b.")} THEN a.pos ELSE b.pos END AS pos FROM v_object a JOIN v_object b ON a.sample_id = b.sample_id AND a.category = b.category AND a.pos < b.pos
  WHERE {_INTER} / least({_AREA.format("a.")}, {_AREA.format("b.")}) > 0.2)
SELECT sample_id, pos FROM v_object ANTI JOIN m USING (sample_id, pos)"""
)
def overlap_suppress(spark, sf_dir):
    """Boxes that do not lose to an overlapping box of their tag."""
    return dedup.suppress_overlaps(views.objects(spark, sf_dir).select("sample_id", "pos", "category", *BOX), most=0.2).select("sample_id", "pos")


@query(R2 + f"SELECT coalesce(parts, predicate) AS components, {_PHRASE} AS phrase, {_OPPOSITE} AS opposite, {_SHORT} AS short, count(*) AS n FROM v_out WHERE reason IS NULL GROUP BY ALL")
def direction_phrase(spark, sf_dir):
    """Words for every combination of components that occurs."""
    c, p = F.col("components"), F.col("predicate")
    rows = derived(spark, sf_dir).filter("reason is null")
    return rows.groupBy(F.coalesce(F.array_join(c, ","), p).alias("components"), direction.phrase(c, p).alias("phrase"), direction.opposite(c, p).alias("opposite"), direction.short_token(c, p).alias("short")).agg(F.count("*").alias("n"))


@query(_R3 + "SELECT array_to_string(c, ',') AS components, array_to_string(list_concat([CASE c[1] WHEN 'left' THEN 'right' WHEN 'right' THEN 'left' WHEN 'above' THEN 'below' WHEN 'below' THEN 'above' WHEN 'front' THEN 'behind' ELSE 'front' END], c[2:]), ',') AS flipped, count(*) AS n FROM g3 WHERE reason IS NULL GROUP BY ALL")
def rel3d_flip(spark, sf_dir):
    """3D components and what they flip to."""
    rows = geometry_3d(spark, sf_dir).filter("reason is null")
    c = F.col("components")
    return rows.groupBy(F.array_join(c, ",").alias("components"), F.array_join(direction.flip_first(c), ",").alias("flipped")).agg(F.count("*").alias("n"))
