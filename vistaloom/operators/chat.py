"""Chat records and training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vistaloom.functions import text as t


def turns(messages: Column, asks: str = "user", answers: str = "assistant") -> Column:
    """array<struct<question, answer>> of an array of (role, text): an ask and the answer right after it, ``""`` if there is none."""

    def pair(m: Column, i: Column) -> Column:
        after = F.get(messages, i + 1)
        answer = F.when(after["role"] == answers, after["text"]).otherwise(F.lit(""))
        return F.when(m["role"] == asks, F.struct(m["text"].alias("question"), answer.alias("answer")))

    return F.filter(F.transform(messages, pair), lambda x: x.isNotNull())


def visual_groups(items: DataFrame, key: Column, order: str = "pos", sample: str = "sample_id") -> DataFrame:
    """(sample, visual_key, first, items): a sample's questions by the picture they share, in the order of their first question."""
    rows = items.withColumn("visual_key", key)
    value = F.struct(F.col(order).alias("order"), "question", "answer")
    groups = rows.groupBy(sample, "visual_key").agg(F.min(order).alias("first"), F.array_sort(F.collect_list(value)).alias("items"))
    return groups.withColumn("group", F.row_number().over(Window.partitionBy(sample).orderBy("first", "visual_key")) - 1)


def training_row(path: Column, width: Column, height: Column, items: Column, record_id: Column | None = None) -> Column:
    """The JSON of a training row: user and assistant turns in order, the picture in the first user turn alone."""

    def part(value: Column) -> Column:
        text = F.struct(F.lit("text").alias("type"), F.lit("utf-8").alias("format"), value.alias("string"))
        return F.struct(F.lit("text").alias("type"), F.lit(None).cast(IMAGE).alias("image"), text.alias("text"))

    image = F.struct(
        F.lit("image").alias("type"),
        F.struct(F.lit("relative_path").alias("type"), F.lit("image/jpeg").alias("format"), path.alias("relative_path"), width.cast("int").alias("width"), height.cast("int").alias("height")).alias("image"),
        F.lit(None).cast(TEXT).alias("text"),
    )

    def both(x: Column, i: Column) -> Column:
        asked = F.array(part(x["question"]))
        user = F.struct(F.lit("user").alias("role"), F.when(i == 0, F.concat(F.array(image), asked)).otherwise(asked).alias("content"))
        return F.array(user, F.struct(F.lit("assistant").alias("role"), F.array(part(x["answer"])).alias("content")))

    data = F.flatten(F.transform(items, both))
    row = F.struct(F.array(F.lit("")).alias("meta_prompt"), data.alias("data"), F.coalesce(record_id, F.lit("")).alias("id") if record_id is not None else F.lit("").alias("id"))
    return F.to_json(row)


IMAGE = "struct<type:string,format:string,relative_path:string,width:int,height:int>"
TEXT = "struct<type:string,format:string,string:string>"


def build_training_rows(items: DataFrame, sample: str = "sample_id") -> DataFrame:
    """(sample, group, path, row) from questions (sample, pos, question, answer, path, width, height, roles, colors, n_marked)."""
    key = t.visual_key(F.col("roles"), F.col("colors"), F.col("n_marked"))
    pictures = items.groupBy(sample).agg(*[F.min_by(c, "pos").alias(c) for c in ("path", "width", "height")])
    groups = visual_groups(items, key, sample=sample).join(pictures, sample)
    groups = groups.withColumn("_to", t.marked_path(F.col("path"), F.col("visual_key")))
    row = training_row(F.col("_to"), F.col("width"), F.col("height"), F.col("items"))
    return groups.select(sample, "group", F.col("_to").alias("path"), row.alias("row"))
