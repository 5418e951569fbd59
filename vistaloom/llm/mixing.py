"""Mixing sources to target weights by a low-discrepancy schedule (native expressions only).

Slot ``i`` of the schedule sits at the golden-ratio point ``frac((i + 1/2) * phi)``
of the line of cumulative target shares, so every prefix of the schedule is
close to the targets. Slots are ranked within their source; rank ``r`` takes
block ``r mod n_blocks`` of the source, whose documents lie end to end in a
shuffled order that is cut into blocks of equal tokens. A document is taken by
as many words as the chosen blocks cover of it. The ranks of ``k`` slots are 0 to
``k - 1``, so they take the line ``k div n_blocks`` times and its first
``k mod n_blocks`` blocks once more; only ``k`` has to be counted. A source of
fewer than ``FEW`` blocks, too coarse for whole blocks to come near its target,
takes its target to the word from the same line.

Scale: blocks have at most ``BLOCK`` words, so the schedule grows with the input; its
slots are counted where they are made, by source, and never shuffled or ranked. Documents
are placed on their source's line by a two-level running sum (within short hash
ranges, then over the ranges), so no source is ever sorted in one task. The source
catalogue (one row for each distinct source) is numbered in one task.

Defined results: null text has size 0; a null source is a source of its own and
comes last; null doc_ids and repeated rows are rows of their own; sources without
words get target 0; an empty table gives an empty mix. Only doc_id, text and source are
read, so other columns clash with nothing; a row of the mix is told by doc_id, source and its text's hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaloom.llm.common import read, stored, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
#: Least slots of a schedule, and most words of a block.
SLOTS = 1 << 18
BLOCK = 32
#: Sources of fewer blocks take their target to the word.
FEW = 1024
BINS = 1024
RANGE_ROWS = 20_000
GOLDEN = 0.6180339887498949


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) with weight and target added.

    The shares of what is capped go to the rest by weight until nothing is above
    its cap; that is the level ``u`` with ``sum(min(cap, u * weight)) = share * sum(size)``,
    found in the order of ``cap / weight`` as the first level that its source's cap is not below.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.partitionBy(F.lit(0))
    full = Window.orderBy("_fills", F.col("source").isNull(), "source")
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    below = full.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(below), F.lit(0.0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    return (
        sources.withColumn("weight", weight)
        .withColumn("_cap", F.lit(most) * F.col("source_size"))
        .withColumn("_fills", F.col("_cap") / F.col("weight"))
        .withColumn("_level", left / rest)
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_fills"), F.struct("_fills", "source", "_level"))).over(every)["_level"])
        .withColumn("target", F.least("_cap", F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap"))))
        .drop("_cap", "_fills", "_level")
    )


def schedule(spark: SparkSession, aims: DataFrame, slots: int = SLOTS, bins: int = BINS) -> DataFrame:
    """(slot, source): which source each slot of the schedule draws from.

    Cumulative shares meet the points by bins of the unit line, an equal-key join;
    with as many bins as sources a point meets two of them on average.
    """
    before = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    share = F.col("target") / F.sum("target").over(Window.partitionBy(F.lit(0)))
    lines = (
        aims.filter("target > 0")
        .withColumn("share", share)
        .withColumn("low", F.coalesce(F.sum("share").over(before), F.lit(0.0)))
        .withColumn("high", F.coalesce(F.lead("low").over(Window.orderBy(F.col("source").isNull(), "source")), F.lit(2.0)))
        .select("source", "low", "high", F.explode(F.sequence(_bin(F.col("low"), bins), _bin(F.col("high"), bins))).alias("bin"))
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN % 1.0).alias("point"))
    drawn = points.withColumn("bin", _bin(F.col("point"), bins)).join(lines, "bin").filter("point >= low and point < high")
    return drawn.select("slot", "source")


def _bin(x: Column, bins: int) -> Column:
    return F.least(F.floor(x * bins), F.lit(bins - 1)).cast("int")


def placed(sized: DataFrame, n_rows: int) -> DataFrame:
    """Where each document starts on the shuffled token line of its source: ``_start``."""
    digits = max(1, math.ceil(math.log(max(1, n_rows / RANGE_ROWS), 16)))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = sized.withColumn("_key", key).withColumn("_range", F.substring("_key", 1, digits))
    before = Window.unboundedPreceding
    ranges = rows.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    sofar = F.sum("_words").over(Window.partitionBy("source").orderBy("_range").rowsBetween(before, -1))
    ranges = ranges.select(F.col("source").alias("_s"), F.col("_range").alias("_r"), F.coalesce(sofar, F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(before, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = rows.join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    return at.withColumn("_start", F.col("_base") + F.col("_inside")).drop("_key", "_range", "_inside", "_s", "_r", "_base")


def drawn(aims: DataFrame, total: int, slots: int = SLOTS, most_block: int = BLOCK, few: int = FEW) -> DataFrame:
    """``aims`` with what is drawn of each source's line: all of it ``_passes`` times and its first ``_rest`` words once more."""
    block = min(most_block, max(1, math.ceil(SHARE * total / slots)))
    bins = max(BINS, aims.count())
    counts = schedule(aims.sparkSession, aims, math.ceil(SHARE * total / block), bins).groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("_slots"))
    n_blocks = F.ceil(F.col("source_size") / block)
    k = F.least(F.coalesce("_slots", F.lit(0)), F.ceil(MOST * n_blocks))
    exact = F.lit(block > 1) & (n_blocks < few)
    line = F.when(exact, F.col("source_size")).otherwise(n_blocks)
    of = F.when(exact, F.round("target")).otherwise(k).cast("long")
    rest = F.least(F.col("_of") % F.col("_line") * F.when(exact, 1).otherwise(block), F.col("source_size"))
    met = aims.join(counts, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("_of", of).withColumn("_line", F.greatest(line, F.lit(1)).cast("long"))
    met = met.withColumn("_passes", F.floor(F.col("_of") / F.col("_line"))).withColumn("_rest", rest)
    return met.select("source", "source_size", "target", "_passes", "_rest")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def mix(documents: DataFrame, slots: int = SLOTS, most_block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, size, source, source_size, target, taken) of every row of ``documents`` (doc_id, text, source)."""
    size = F.when(F.col("text").isNull(), 0).otherwise(F.size(words(F.col("text")))).cast("long")
    sized = stored(documents.select("doc_id", text_hash(F.col("text")).alias("text_hash"), size.alias("size"), "source"), "mix-sizes")
    n_rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    aims = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    aims = stored(drawn(aims, total, slots, most_block), "mix-drawn").withColumnRenamed("source", "_s")
    more = F.least(F.greatest(F.col("_rest") - F.col("_start"), F.lit(0)), F.col("size"))
    return (
        placed(sized, n_rows)
        .join(aims, F.col("source").eqNullSafe(F.col("_s")))
        .select("doc_id", "text_hash", "size", "source", "source_size", "target", (F.col("_passes") * F.col("size") + more).cast("long").alias("taken"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_LINE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source,
  CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
k AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
f AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS fills FROM k),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM f WINDOW before AS (ORDER BY fills, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level FROM l WHERE level <= fills ORDER BY fills LIMIT 1),
a AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM v) * weight, cap)) AS target FROM l),
h AS (SELECT *, target / sum(target) OVER () AS share FROM a WHERE target > 0),
b AS (SELECT block, ceil(1.5 * words / block)::BIGINT AS n FROM (SELECT coalesce(sum(size), 0) AS words, least(32, greatest(1, ceil(1.5 * coalesce(sum(size), 0) / 262144)))::BIGINT AS block FROM d)),
i AS (SELECT *, coalesce(sum(share) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM h),
j AS (SELECT *, coalesce(lead(low) OVER (ORDER BY source NULLS LAST), 2) AS high FROM i),
p AS (SELECT slot, fmod((slot + 0.5::DOUBLE) * 0.6180339887498949::DOUBLE, 1) AS point FROM (SELECT unnest(range(0, n)) AS slot FROM b)),
o AS (SELECT j.source, source_size, row_number() OVER (PARTITION BY j.source ORDER BY slot) - 1 AS rank
  FROM p JOIN j ON point >= low AND point < high),
c AS (SELECT source, rank % ceil(source_size / block)::BIGINT AS block_no, count(*) AS times FROM o, b
  WHERE rank < 2 * ceil(source_size / block) AND (block = 1 OR ceil(source_size / block) >= 1024) GROUP BY ALL),
w AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
e AS (SELECT w.*, unnest(range(start // block, (start + size - 1) // block + 1)) AS block_no, block FROM w, b WHERE size > 0),
x AS (SELECT source, round(target)::BIGINT AS words, source_size FROM a, b WHERE block > 1 AND ceil(source_size / block) < 1024 AND source_size > 0),
t AS (SELECT r, sum((least(start + size, (e.block_no + 1) * block) - greatest(start, e.block_no * block)) * times) AS taken
  FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source AND e.block_no = c.block_no GROUP BY r
  UNION ALL SELECT r, size * (words // source_size) + greatest(0, least(size, words % source_size - start)) FROM w JOIN x ON w.source IS NOT DISTINCT FROM x.source)
"""
ORACLE = _LINE + """
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM w JOIN a ON w.source IS NOT DISTINCT FROM a.source LEFT JOIN t USING (r)
"""
