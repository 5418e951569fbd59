"""Checks of frame and metadata records; each returns rows that say what is wrong."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that a frame record must have.
REQUIRED = ("id", "dataset", "scene_id", "image", "pose", "depth_map", "intrinsic", "depth_scale", "bboxes_3d_world_coords", "obj_tags", "axis_align_matrix")
DEPTH_SCALES = (1000, 4000)


def missing_fields(json: Column, required: tuple[str, ...] = REQUIRED) -> Column:
    """The required fields that a JSON record lacks, in order."""
    keys = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(x) for x in required]), keys)


def schema_errors(records: DataFrame, json: str, key: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """(key, error) for each missing field."""
    rows = records.select(key, F.explode(missing_fields(F.col(json), required)).alias("f"))
    return rows.select(key, F.concat(F.lit("missing "), F.col("f")).alias("error"))


def count_errors(scenes: DataFrame, frames: DataFrame, n: str = "num_images", key: str = "scene_id") -> DataFrame:
    """(scenes, frames) where the merged scenes do not hold as many images as there are frames with a scene; empty if all is well."""
    a = scenes.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n_scenes"))
    b = frames.filter(F.col(key).isNotNull()).agg(F.count("*").alias("n_frames"))
    return a.crossJoin(b).filter("n_scenes != n_frames")  # one row each


def range_errors(records: DataFrame, key: str) -> DataFrame:
    """(key, error) of records (depth_scale, matrix: 9 numbers of a rotation, boxes: number of parameters, tags) out of range."""
    m = [F.get("matrix", F.lit(i)) for i in range(9)]
    det = m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
    tests = {
        "depth_scale": ~F.col("depth_scale").isin(*DEPTH_SCALES),
        "rotation": F.coalesce(F.abs(det - 1) > 1e-3, F.lit(True)),
        "box": F.exists("boxes", lambda n: n != 9),
        "tags": F.size("boxes") != F.size("tags"),
    }
    errors = F.filter(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]), lambda x: x.isNotNull())
    return records.select(key, F.explode(errors).alias("error"))


def complete_scenes(frames: DataFrame, fields: list[str], key: str = "scene_id") -> DataFrame:
    """Frames of scenes in which no frame lacks a field."""
    full = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields])
    good = frames.groupBy(key).agg(F.bool_and(full).alias("_ok")).filter("_ok").select(key)
    return frames.join(good, key, "left_semi")


def missing_paths(records: DataFrame, listing: DataFrame, path: str, seed: int, most: int = 100) -> DataFrame:
    """Of at most ``most`` records, drawn by a hash, those whose file the listing (path) lacks."""
    some = records.orderBy(F.xxhash64(F.lit(seed), F.col(path)), path).limit(most)
    return some.join(listing.select(F.col("path").alias(path)).distinct(), path, "left_anti")


def metadata_errors(records: DataFrame) -> DataFrame:
    """(sample_id, error) of nested metadata records: what the strict schema requires."""
    objects = F.coalesce("objects", F.expr("cast(array() as array<struct<object_id:string,category:string>>)"))
    ids = F.transform(objects, lambda o: o["object_id"])
    tests = {
        "dataset": F.col("dataset.name").isNull(),
        "sample": F.col("sample.sample_id").isNull(),
        "object_id": F.exists(ids, lambda i: i.isNull()),
        "duplicate object_id": F.size(F.array_distinct(ids)) != F.size(ids),
    }
    errors = F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()]), lambda x: x.isNotNull())
    return records.select("sample.sample_id", F.explode(errors).alias("error"))
