"""Unnesting, packing, text, markers, points, questions, files, bundles, streams and staged plans."""

import itertools
import json
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from vistaloom.functions import direction, markers, templates
from vistaloom.functions import text as t
from vistaloom.operators import adapters, points, qa_items, questions, ranking, reshape
from vistaloom.plans import staged
from vistaloom.sources import files, sinks, tar
from vistaloom.streaming import ingest


def test_unnest_and_group_are_inverse(spark):
    rows = spark.createDataFrame([(2, ["a", "b"], [1, 2], "x"), (1, ["c"], [3], "y"), (3, [], [], "z")], "k int, tag array<string>, n array<int>, s string")
    flat = reshape.unnest(rows, "tag", ["n"])
    assert flat.columns == rows.columns and flat.count() == 3
    back = reshape.group_collect(flat.withColumn("pos", F.col("n")), "k", ["tag", "n"], "pos").orderBy("_first")
    assert [(r.k, r.tag, r.n, r.s) for r in back.collect()] == [(2, ["a", "b"], [1, 2], "x"), (1, ["c"], [3], "y")]
    with pytest.raises(ValueError, match="no such columns"):
        reshape.unnest(rows, "tag", ["nope"])
    with pytest.raises(Exception, match="differ in length"):
        reshape.unnest(rows.withColumn("n", F.array(F.lit(1))), "tag", ["n"]).collect()
    with pytest.raises(Exception, match="null k"):
        reshape.group_collect(flat.withColumns({"k": F.lit(None).cast("int"), "pos": F.col("n")}), "k", ["tag"], "pos").collect()


@pytest.mark.parametrize("n, per, align, bundles", [(5, 2, 1, [2, 2, 1]), (5, 4, 4, [4]), (4, 1, 1, [1, 1, 1, 1]), (3, 4, 4, [])])
def test_packing(spark, n, per, align, bundles):
    out = ranking.bundled(spark.range(n).repartition(3), per, align, ["id"]).groupBy("bundle_id").count().orderBy("bundle_id").collect()
    assert [r["count"] for r in out] == bundles
    with pytest.raises(ValueError):
        ranking.bundled(spark.range(3), 3, 2, ["id"])


def test_numbering_is_global(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert [r.rn - 1 for r in ranking.numbered(rows, ["x"]).orderBy("x").collect()] == list(range(1000))


def test_text(spark):
    def one(c):
        return spark.range(1).select(c).first()[0]

    assert one(t.clean_object_name(F.lit("Obj_12_office_chairA_7_XB"))) == "office chair"
    assert one(t.clean_object_name(F.lit("obj12"))) == ""
    assert one(t.noun_phrase(F.lit(" An  old chair"))) == "the old chair" and one(t.noun_phrase(F.lit(None).cast("string"))) == "the object"
    assert one(t.posix_path(F.lit("..\\a//b.png"))) == "a/b.png"
    assert one(t.marked_path(F.lit("a/b.c/d.png"), F.lit("original"))) == "a/b.c/d.png"
    assert one(t.marked_path(F.lit("a/b.c/d.png"), F.lit("k"))).startswith("a/b.c/d_m")
    key = lambda ids: one(t.visual_key(F.array(F.lit("target")), F.create_map(F.lit("target"), F.lit("red")), F.lit(1), ids))
    assert key(None) == "target#target:red#1" and key(F.array(F.lit("obj#3"))) == "target#target:red#1#obj#3"
    for parts in (["above", "left"], ["left", "above"]):
        assert one(direction.short_token(F.array(*map(F.lit, parts)), F.lit("left"))) == "upper left"
    assert [one(direction.compass(F.lit(x), F.lit(y))) for x, y in ((0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, -1.0), (-1.0, 0.0))] == ["front", "front-right", "right", "back", "left"]


def test_markers(spark):
    s, e, b, c = "<|object_ref_start|>", "<|object_ref_end|>", "<|box_start|>", "<|box_end|>"
    text = f"{b}(1,1),(2,2){c} {s} cup {e}{b}(1, 2),(3,4){c}\n{b}(5,6),(7,8){c} and {b}(9,9),(10,10){c} {s}none{e} x {b}(1,1),(2,2){c} {s} {e}{b}(1,1),(2,2){c}{s}two\nlines{e} {b}(4,4),(4,9){c}"
    got = spark.range(1).select(markers.parse(F.lit(text))).first()[0]
    assert [(r.ref, r.boxes) for r in got] == [("cup", [[1, 2, 3, 4], [5, 6, 7, 8]]), ("two\nlines", [[4, 4, 4, 9]])]
    turns = spark.createDataFrame([(1, 0, text), (1, 1, f"{s}cup{e}{b}(1,2),(3,4){c}")], "r int, turn int, text string")
    boxes = adapters.grounding_boxes(turns, ["r"], "turn", "text")
    assert [r.object_id for r in adapters.grounding_objects(boxes, ["r"]).orderBy("object_id").collect()] == ["obj#0", "obj#1", "obj#2"]
    q = {r.query_id: r for r in adapters.grounding_queries(boxes, ["r"], "turn").collect()}
    assert q["q#0"].candidates == ["obj#0", "obj#1"] and q["q#0"].gold is None and q["q#1"].gold == "obj#2"


def test_adapter_chains(spark):
    add = lambda c: lambda df: df.withColumn(c, F.lit(1))
    out = adapters.chain(adapters.passthrough, add("a"), add("b"), required=["a"], check_from=1)(spark.range(1))
    assert out.columns == ["id", "a", "b"]
    with pytest.raises(ValueError):
        adapters.chain(add("a"), required=["b"], check_from=0)(spark.range(1))
    with pytest.raises(TypeError):
        adapters.chain(lambda df: 1)(spark.range(1))


def test_points(spark):
    rng = np.random.default_rng(0)
    cube = np.array(list(np.ndindex(2, 2, 2)), float)
    cloud = np.concatenate([cube, rng.random((50, 3))])
    assert abs(points.hull_volume(cloud) - 1) < 1e-9 and points.hull_volume(cube[:4] * [1, 1, 0]) == 0 and points.hull_volume(cube[:1]) == 0
    for n in (5, 9, 14):  # every triple with all points on one side is a face
        few = rng.normal(size=(n, 3))
        mid, volume = few.mean(0), 0.0
        for i, j, k in itertools.combinations(range(n), 3):
            normal = np.cross(few[j] - few[i], few[k] - few[i])
            side = (few - few[i]) @ normal
            side[[i, j, k]] = 0
            if (side <= 0).all() or (side >= 0).all():
                volume += abs((few[i] - mid) @ normal) / 6
        assert abs(points.hull_volume(few) - volume) < 1e-9
    ball = rng.normal(size=(3000, 3))
    ball /= np.maximum(1, np.linalg.norm(ball, axis=1, keepdims=True))
    assert 4 < points.hull_volume(ball) < 4 * np.pi / 3
    xyz = np.concatenate([rng.normal(size=(200, 3)), [[50, 50, 50]]])
    keep = points.keep_inliers(xyz, 10, 2.0)
    assert not keep[-1] and keep.mean() > 0.9 and points.keep_inliers(xyz[:1], 10, 2.0).all()
    a = spark.createDataFrame([("a", *map(float, p)) for p in rng.random((40, 3))], "object string, x double, y double, z double")
    b = spark.createDataFrame([("b", *map(float, p)) for p in rng.random((40, 3))], "object string, x double, y double, z double")
    near = points.pairs_within(a, b, 0.2).count()
    xa, xb = (np.array([list(r)[1:] for r in d.collect()]) for d in (a, b))
    dist = np.sqrt(((xa[:, None] - xb[None]) ** 2).sum(-1))
    assert near == int((dist <= 0.2).sum())
    got = points.min_distances(a.union(b), spark.createDataFrame([("a", "b"), ("a", "none")], "a string, b string")).collect()
    got = {r.b: r.distance for r in got}
    assert abs(got["b"] - dist.min()) < 1e-12 and got["none"] == float("inf")


def _items(spark, sf_dir, parts):
    from vistaloom.operators import relations
    from vistaloom.plans import record_queries, views

    rows = relations.with_relation_ids(record_queries._relations(spark, sf_dir)).repartition(parts)
    return qa_items.relation_2d(rows, views.objects(spark, sf_dir), seed=7)


def test_question_items(spark, sf_dir):
    rows = _items(spark, sf_dir, 3).collect()
    assert rows == _items(spark, sf_dir, 3).collect() or sorted(map(str, rows)) == sorted(map(str, _items(spark, sf_dir, 9).collect()))
    assert len({(r.sample_id, r.relation_id) for r in rows}) == len(rows)
    for r in rows:
        assert r.question and r.answer and "[" not in r.question + r.answer
        assert (r.question_type == "MCQ") == (r.style == "single_axis") and r.n_marked == len(r.roles) == len(r.colors)
    with pytest.raises(ValueError):
        templates.render("rel2d.judgment", F.lit(0.5))
    options = questions.shuffled(F.array(*map(F.lit, "abcd")), 1, F.lit("k"))
    got = spark.range(1).select(options.alias("o"), questions.letter(options, F.lit("c")).alias("l")).first()
    assert sorted(got.o) == list("abcd") and got.o["ABCD".index(got.l)] == "c"


def test_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"data_{n:06d}.jsonl").write_text("".join(json.dumps({"sample": {"sample_id": f"s{n}{i}"}}) + "\n" + ("\n" if i == 1 else "") for i in range(3)))
    assert files.expand([f"{tmp_path}/data_{{2..000001}}.jsonl", f"{tmp_path}/*2.jsonl"]) == [f"{tmp_path}/data_000001.jsonl", f"{tmp_path}/data_000002.jsonl"]
    with pytest.raises(ValueError):
        files.checked([f"{tmp_path}/none", f"{tmp_path}/none"])
    rows = files.jsonl(spark, str(tmp_path), "sample struct<sample_id:string>", start={"data_000001.jsonl": 3})
    got = sorted((os.path.basename(r.file), r.line, r.record.sample.sample_id) for r in rows.collect())
    assert [x[1:] for x in got] == [(0, "s00"), (1, "s01"), (3, "s02"), (3, "s12"), (0, "s20"), (1, "s21"), (3, "s22")]
    assert files.shards(spark, str(tmp_path)).filter("shard = 2").count() == 4
    lines = files.lines(spark, f"{tmp_path}/data_000000.jsonl")
    assert [r.line for r in ranking.page(lines, 1, 2).collect()] == [1] and ranking.page(lines, 1, 2).first().has_more
    assert ranking.seek(lines, "s02").first().line == 3
    (tmp_path / "x_scenes.jsonl").write_text("{}\n")
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{oops\n')
    assert files.tolerant(spark, str(tmp_path), "a int").filter("a = 1").count() == 1


def test_bundles_round_trip(spark, tmp_path):
    rows = spark.range(7).select(F.col("id").alias("input_index"), F.concat(F.lit("im/"), (F.col("id") % 2).cast("string"), F.lit(".jpg")).alias("path"), F.encode(F.concat(F.lit("pix"), F.col("id").cast("string")), "utf-8").alias("content"))
    packed = ranking.disambiguated(ranking.bundled(rows, 4, 1, ["input_index"]))
    packed = packed.withColumn("row", F.to_json(F.struct("unique_path")))
    assert tar.export(tar.bundles(packed), str(tmp_path)) == 2
    seen = 0
    for n in range(2):
        index = json.loads((tmp_path / f"images/data_{n:06d}_tarinfo.json").read_text())
        raw = (tmp_path / f"images/data_{n:06d}.tar").read_bytes()
        for line in (tmp_path / f"jsonl/data_{n:06d}.jsonl").read_text().splitlines():
            at = index[json.loads(line)["unique_path"]]
            assert raw[at["offset_data"] :][: at["size"]].startswith(b"pix")
            seen += 1
    assert seen == 7
    paths = sorted(map(str, (tmp_path / "images").glob("*.tar")))
    found = tar.members(spark, paths)
    assert found.count() == 7
    with tarfile.open(paths[0]) as f:
        name = f.getnames()[0]
    wanted = spark.createDataFrame([(name,), ("./" + name,), ("other/" + name.split("/")[-1],), ("no.jpg",)], "path string")
    got = {r.path: r.member for r in tar.lookup(wanted, found).collect()}
    assert got == {name: name, "./" + name: name, "other/" + name.split("/")[-1]: name, "no.jpg": None}
    assert sorted(r.content for r in tar.slices(found.select("tar", "offset_data", "size")).collect()) == [f"pix{i}".encode() for i in range(7)]
    with pytest.raises(Exception, match="bytes at"):
        tar.slices(spark.createDataFrame([(paths[0], 10**7, 5)], "tar string, offset_data long, size long")).collect()


def test_scene_chunks_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(s, i) for s, n in (("a", 3), ("b", 1), ("c", 4), ("d", 1)) for i in range(n)], "scene_id string, i int")
    assert {r.scene_id: r.chunk for r in sinks.scene_chunks(rows, 4).select("scene_id", "chunk").distinct().collect()} == {"a": 0, "b": 0, "c": 1, "d": 2}
    sinks.parquet(rows, f"{tmp_path}/p", per_file=2)
    assert spark.read.parquet(f"{tmp_path}/p").count() == 9 and len([f for f in os.listdir(tmp_path / "p") if f.endswith(".parquet")]) >= 5
    sinks.jsonl(rows.withColumn("x", F.lit(None).cast("int")), f"{tmp_path}/j", ["scene_id", "i"])
    text = [x.value for x in spark.read.text(f"{tmp_path}/j").collect()]
    assert sorted(text)[0] == '{"scene_id":"a","i":0,"x":null}'
    cloud = spark.createDataFrame([("a", 0.0, 1.0, 2.0)], "object string, x double, y double, z double")
    assert sinks.point_cloud_text(cloud, form="ply").first().text.endswith("end_header\n0.000000 1.000000 2.000000")


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    os.makedirs(src)
    for n in range(3):
        with open(f"{src}/{n}.jsonl", "w") as f:
            f.write(f'{{"a": {n}}}\n\n{{"a": {n + 10}}}\n')
        ingest.ingest(spark, src, "a int", out, check)
        ingest.ingest(spark, src, "a int", out, check)
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == [0, 1, 2, 10, 11, 12]
    got = []
    for _ in range(2):
        ingest.export(spark, out, f"{check}2", lambda df, n: got.extend(r.a for r in df.collect()))
    assert sorted(got) == [0, 1, 2, 10, 11, 12]


def test_staged_plans(spark, tmp_path):
    config = staged.load(
        f"""
output_dir: {tmp_path}
stages:
  prepare_stage:
    flatten: {{anchor_col: tag, split_col_list: [n]}}
    filter: {{depends_on: flatten, condition: "n > 1"}}
    filter: {{depends_on: "prepare_stage/filter", condition: "n > 2"}}
"""
    )
    steps = staged.plan(config)
    assert [s.ref for s in steps] == ["prepare_stage/flatten", "prepare_stage/filter", "prepare_stage/filter#2"]
    assert steps[2].output.endswith("filter_dup1") and steps[2].depends_on == "prepare_stage/filter"
    rows = spark.createDataFrame([(["a", "b", "c"], [1, 2, 3])], "tag array<string>, n array<int>")
    done = staged.run(spark, config, rows)
    assert {k: v.count() for k, v in done.items()} == {"prepare_stage/flatten": 3, "prepare_stage/filter": 2, "prepare_stage/filter#2": 1}
    with pytest.raises(ValueError, match="may be any of"):
        staged.resolve("filter", steps)
    with pytest.raises(ValueError, match="must say"):
        staged.plan({"stages": {"s": {"flatten": {}, "select": {}}}})
    assert staged.qa_tasks("qa_tasks: {a: {params: {n: 1}}, b: {enabled: false}}", {"a": {"n": 2}}) == {"a": {"type": "a", "params": {"n": 2}}}
