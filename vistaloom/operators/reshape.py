"""Unnesting, grouping and nesting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def unnest(rows: DataFrame, anchor: str, lists: list[str]) -> DataFrame:
    """A row for each element of the list ``anchor``, split along with ``lists``; other columns repeat.

    A listed column that is absent, or as long as ``anchor`` nowhere, is an error,
    and a scalar anchor passes through. Empty lists give no row.
    """
    missing = [c for c in [anchor, *lists] if c not in rows.columns]
    if missing:
        raise ValueError(f"no such columns to unnest: {missing}")
    if not isinstance(rows.schema[anchor].dataType, ArrayType):
        return rows
    columns = list(dict.fromkeys([anchor, *lists]))
    same = reduce(lambda a, b: a & b, [F.size(c) == F.size(anchor) for c in columns])
    checked = F.when(same, F.arrays_zip(*columns)).otherwise(F.raise_error(F.lit("lists to unnest differ in length")))
    other = [c for c in rows.columns if c not in columns]
    each = rows.select(*other, F.explode(checked).alias("_e"))
    return each.select(*[F.col("_e")[c].alias(c) if c in columns else F.col(c) for c in rows.columns])


def group_collect(rows: DataFrame, key: str, lists: list[str], order: str) -> DataFrame:
    """One row for each key: ``lists`` collected in the order of ``order``, other columns from the first row, and ``_first`` to order groups by.

    A null key is an error. Positions travel with the values, so the result does not depend on the shuffle.
    """
    other = [c for c in rows.columns if c not in (key, order, *lists)]
    safe = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null {key}")).cast(rows.schema[key].dataType)).otherwise(F.col(key))
    item = F.struct(order, *lists)
    grouped = rows.withColumn(key, safe).groupBy(key).agg(
        F.array_sort(F.collect_list(item)).alias("_items"), F.min(order).alias("_first"), *[F.min_by(c, order).alias(c) for c in other]
    )
    for c in lists:
        grouped = grouped.withColumn(c, F.col("_items").getField(c))
    return grouped.drop("_items")


def merge_scenes(frames: DataFrame, key: str, lists: list[str], order: str) -> DataFrame:
    """Frames merged by scene with ``num_images``; frames without a scene are left out."""
    known = frames.filter(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))
    merged = group_collect(known, key, lists, order)
    return merged.withColumn("num_images", F.size(lists[0])).drop("_first")


def flatten_annotations(rows: DataFrame, keep: list[str], image: str = "image") -> DataFrame:
    """A row for each question: the lists ``keep`` (absent ones count as empty) must agree in length; ``image`` is always carried."""
    present = [c for c in keep if c in rows.columns]
    if not present:
        return rows.limit(0).select(image)
    sizes = [F.coalesce(F.size(c), F.lit(0)) if c in present else F.lit(0) for c in keep]
    same = reduce(lambda a, b: a & b, [s == sizes[0] for s in sizes])
    checked = F.when(same, F.arrays_zip(*present)).otherwise(F.raise_error(F.lit("annotation lists differ in length")))
    return rows.select(image, F.posexplode(checked).alias("_i", "_e")).select(image, F.col("_i").alias("item"), *[F.col("_e")[c].alias(c) for c in present])


def qa_bundle(rows: DataFrame, sample_id: str, lists: list[str], scalars: list[str] = ()) -> DataFrame:
    """(sample_id, json): questions zipped with nulls where a list is shorter; scalar columns with the first only."""

    def item(x: Column, i: Column) -> Column:
        fields = [x[c].alias(c) for c in lists] + [F.when(i == 0, F.col(c)).alias(c) for c in scalars]
        return F.struct(*fields)

    qa = F.transform(F.arrays_zip(*lists), item)
    return rows.select(sample_id, F.to_json(F.struct(F.col(sample_id), qa.alias("qa")), {"ignoreNullFields": "false"}).alias("json"))


def attach_qa(question: Column, answer: Column, meta: Column) -> Column:
    """Question, answer and meta lists as an array of items ``qa#i``."""
    zipped = F.arrays_zip(question.alias("question"), answer.alias("answer"), meta.alias("meta"))
    return F.transform(zipped, lambda x, i: F.struct(F.concat(F.lit("qa#"), i.cast("string")).alias("qa_id"), x["question"].alias("question"), x["answer"].alias("answer"), x["meta"].alias("meta")))


def explode_counts(rows: DataFrame, counts: dict[str, int]) -> DataFrame:
    """A row for each sub-task and repetition that ``counts`` plans; tasks of count 0 give none."""
    plan = [F.struct(F.lit(name).alias("sub_task"), F.lit(i).alias("repetition")) for name, n in counts.items() for i in range(n)]
    if not plan:
        return rows.limit(0).withColumns({"sub_task": F.lit(""), "repetition": F.lit(0)})
    return rows.withColumn("_p", F.explode(F.array(*plan))).select("*", "_p.sub_task", "_p.repetition").drop("_p")


def inject_dataset(rows: DataFrame, name: str, version: str, split: str, path: str, source: str | None = None, meta: dict[str, str] | None = None) -> DataFrame:
    """Defaults for the fields of the struct ``dataset``; what a record states stays, but for a blank source. ``meta`` adds the keys that a record lacks."""
    d = F.col("dataset")
    blank = d["source"].isNull() | (F.trim(d["source"]) == "")
    out = d.withField("name", F.coalesce(d["name"], F.lit(name))).withField("version", F.coalesce(d["version"], F.lit(version)))
    out = out.withField("split", F.coalesce(d["split"], F.lit(split))).withField("dataset_path", F.coalesce(d["dataset_path"], F.lit(path)))
    out = out.withField("source", F.when(blank, F.lit(source)).otherwise(d["source"]))
    if meta:
        given = F.create_map(*[F.lit(x) for pair in sorted(meta.items()) for x in pair])
        own = F.coalesce(d["meta"], F.create_map().cast("map<string,string>"))
        out = out.withField("meta", F.map_concat(F.map_filter(given, lambda k, v: ~F.map_contains_key(own, k)), own))
    return rows.withColumn("dataset", out)


def first_match(rows: DataFrame, table: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with the columns of the first row of ``table`` that has their key; nulls if there is none."""
    first = table.groupBy(key).agg(*[F.min_by(c, order).alias(c) for c in table.columns if c not in (key, order)])
    return rows.join(first, key, "left")


def complete(rows: DataFrame, lists: list[str], least: int = 1) -> DataFrame:
    """Rows in which every listed column is there, all are as long as the first, and that long at least."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.size(c) == F.size(lists[0])) for c in lists])
    return rows.filter(F.coalesce(ok & (F.size(lists[0]) >= least), F.lit(False)))


def limited_pairs(objects: DataFrame, most: int = 8, key: str = "sample_id", order: str = "pos", tag: str = "category") -> DataFrame:
    """(key, a, b): pairs of different tags among the first ``most`` objects of each sample, by position."""
    from pyspark.sql import Window

    rows = objects.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter(F.col("_k") <= most)
    a, b = (rows.select(key, F.col(order).alias(x), F.col(tag).alias(f"_{x}")) for x in "ab")
    return a.join(b, key).filter("a < b and _a != _b").select(key, "a", "b")
