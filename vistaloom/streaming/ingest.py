"""Incremental ingest: new files are read once, and a restart goes on where the last run stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream(spark: SparkSession, folder: str, schema: str, per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """(file, value, record) of a folder's JSON lines as they come, of files named by ``pattern`` alone if given; blank lines are passed over."""
    reader = spark.readStream
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    rows = reader.text(folder).select(F.col("_metadata.file_path").alias("file"), "value")
    return rows.filter(F.trim("value") != "").withColumn("record", F.from_json("value", schema))


def ingest(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Appends what is new in ``folder``, transformed, to the parquet table ``out`` and stops; each file counts once, also after a failure."""
    rows = transform(stream(spark, folder, schema).select("file", "record.*"))
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """(window_start, key, n) of an event stream; events later than ``late`` behind the newest are left out and state is dropped."""
    rows = events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("window_start"), key, "n")


def export(spark: SparkSession, table: str, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Calls ``write(rows, batch)`` for what a table of files gained since the last run; a batch that failed comes again under its number."""
    rows = spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def resumed(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records (file, line) at or beyond the next line that ``manifest`` (file, next_line, done) names; files that are done go."""
    m = manifest.select(F.md5("file").alias("_k"), "next_line", "done")
    rows = records.withColumn("_k", F.md5("file")).join(m, "_k", "left")
    return rows.filter(~F.coalesce("done", F.lit(False)) & (F.col("line") >= F.coalesce("next_line", F.lit(0)))).drop("_k", "next_line", "done")


def merged_manifest(scoped: DataFrame, legacy: DataFrame) -> DataFrame:
    """(file, next_line, done): the scoped checkpoint of a file, else the legacy one."""
    a = scoped.select("file", *[F.col(c).alias(f"_{c}") for c in ("next_line", "done")], F.lit(True).alias("_own"))
    both = a.join(legacy, "file", "full")
    pick = lambda c: F.when(F.col("_own"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return both.select("file", pick("next_line"), pick("done"))
