"""Reports over questions, relations, phases and archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket(value: Column, name: str = "(missing)") -> Column:
    return F.when(value.isNull() | (value == ""), F.lit(name)).otherwise(value)


def shares(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n, percent) for each dimension by one pass over the rows: each row is counted once for each dimension."""
    each = F.array(*[F.struct(F.lit(d).alias("dimension"), bucket(F.col(d).cast("string")).alias("value")) for d in dimensions])
    counts = rows.select(F.explode(each).alias("e")).groupBy("e.dimension", "e.value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("dimension").agg(F.sum("n").alias("_t"))
    return counts.join(F.broadcast(totals), "dimension").select("dimension", "value", "n", F.round(100 * F.col("n") / F.col("_t"), 4).alias("percent"))


def training_stats(rows: DataFrame, file: str, roles: str) -> DataFrame:
    """(file, n_samples, n_qa) with a total line: questions are assistant turns in the array ``roles``."""
    n = F.size(F.filter(roles, lambda r: r == "assistant"))
    return rows.rollup(file).agg(F.count("*").alias("n_samples"), F.sum(n).cast("long").alias("n_qa")).withColumn(file, F.coalesce(F.col(file).cast("string"), F.lit("(total)")))


def top(rows: DataFrame, key: str, n: int = 50) -> DataFrame:
    """The ``n`` most frequent keys, ties by key."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def phase_timing(phases: DataFrame, phase: str, seconds: str, wall: float | None = None) -> DataFrame:
    """(phase, n, total_s, mean_ms, percent of all phases or of ``wall``)."""
    sums = phases.groupBy(phase).agg(F.count("*").alias("n"), F.sum(seconds).alias("total_s"), (1000 * F.avg(seconds)).alias("mean_ms"))
    if wall is not None:
        return sums.withColumn("percent", 100 * F.col("total_s") / wall)
    every = sums.agg(F.sum("total_s").alias("_all"))
    return sums.crossJoin(F.broadcast(every)).withColumn("percent", 100 * F.col("total_s") / F.col("_all")).drop("_all")  # one row: the sum


def name_counts(objects: DataFrame, name: Column, key: str = "sample_id") -> DataFrame:
    """``objects`` with ``name_count``: how many of the sample share the name."""
    from pyspark.sql import Window

    return objects.withColumn("name_count", F.count("*").over(Window.partitionBy(key, name)))


def duplicate_tags(objects: DataFrame, tag: str, key: str = "sample_id", without: list[str] = ()) -> DataFrame:
    """(key, tag, n) of tags that a sample has more than once."""
    rows = objects.filter(~F.col(tag).isin(*without)) if without else objects
    return rows.groupBy(key, tag).agg(F.count("*").alias("n")).filter("n > 1")


def archive_overlaps(members: DataFrame, path: str, archive: str, most: int = 50) -> DataFrame:
    """(path, archives) of the first members that several archives hold."""
    found = members.groupBy(path).agg(F.array_sort(F.collect_set(archive)).alias("archives")).filter(F.size("archives") > 1)
    return found.orderBy(path).limit(most)


def shallow_mean(depths: DataFrame, keys: list[str], depth: str, share: float = 0.1) -> DataFrame:
    """(keys, mean): the mean of the ``max(1, int(share * n))`` smallest positive depths; ties do not matter to it."""
    from pyspark.sql import Window

    rows = depths.filter(F.col(depth) > 0)
    order = Window.partitionBy(*keys).orderBy(depth)
    rows = rows.withColumns({"_k": F.row_number().over(order), "_n": F.count("*").over(Window.partitionBy(*keys))})
    few = F.greatest(F.lit(1), (F.col("_n") * share).cast("int"))
    return rows.filter(F.col("_k") <= few).groupBy(*keys).agg(F.avg(depth).alias("mean"))
