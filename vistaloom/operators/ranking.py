"""Numbering rows, packing them into bundles, and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: About how many rows one task sorts when rows are numbered, and how many cuts there are at most.
CHUNK_ROWS = 100_000
MOST_CUTS = 2048


def _cut(value: Column, cuts: list[float], low: int = 0) -> Column:
    """How many of the sorted ``cuts`` lie below a value, by bisection."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(value > F.lit(cuts[mid]), _cut(value, cuts[mid + 1 :], low + mid + 1)).otherwise(_cut(value, cuts[:mid], low))


def numbered(rows: DataFrame, order: list, name: str = "rn", chunk: Column | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``rows`` numbered from 1 in a global order, without sorting all in one task.

    ``chunk`` gives each row the number of a chunk that agrees with the order (rows
    of a smaller chunk come first); without it, chunks of about ``chunk_rows`` rows, ``MOST_CUTS`` at most, are cut at
    approximate quantiles of the first order column, which must be numeric then.
    Rows are numbered within their chunk and moved by the chunks' running counts.
    """
    if chunk is None:
        first = order[0] if isinstance(order[0], str) else None
        if first is None:
            raise ValueError("numbering by an expression needs a chunk column")
        chunks = min(MOST_CUTS, -(-rows.count() // chunk_rows))
        cuts = sorted(set(rows.approxQuantile(first, [i / chunks for i in range(1, chunks)], 1 / (4 * chunks)))) if chunks > 1 else []
        chunk = _cut(F.col(first).cast("double"), cuts)
    rows = rows.withColumn("_chunk", chunk)
    counts = rows.groupBy("_chunk").agg(F.count("*").alias("_n"))
    # one row for each chunk
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy(*order))
    out = rows.withColumn("_inside", inside).join(counts, "_chunk")
    return out.withColumn(name, F.col("_before") + F.col("_inside")).drop("_chunk", "_before", "_inside")


def bundled(rows: DataFrame, rows_per_part: int, align: int, order: list, drop_tail: bool = True, chunk: Column | None = None) -> DataFrame:
    """``rows`` in global order with ``bundle_id`` and ``rn``; ``remainder`` marks rows of the last bundle beyond a multiple of ``align``.

    With ``drop_tail`` those rows are left out.
    """
    if rows_per_part <= 0 or align <= 0 or rows_per_part % align:
        raise ValueError("rows_per_part and align must be positive, and one a multiple of the other")
    out = numbered(rows, order, chunk=chunk)
    total = rows.agg(F.count("*").alias("_total"))
    out = out.crossJoin(F.broadcast(total))  # one row: the count
    usable = F.col("_total") - F.col("_total") % align
    out = out.withColumns({"bundle_id": F.floor((F.col("rn") - 1) / rows_per_part).cast("long"), "remainder": F.col("rn") > usable}).drop("_total")
    return out.filter(~F.col("remainder")).drop("remainder") if drop_tail else out


def disambiguated(rows: DataFrame, path: str = "path", index: str = "input_index") -> DataFrame:
    """Second and later uses of a path in a bundle get ``__r{input_index}``, and ``_{n}`` where that repeats too."""
    rows = rows.withColumn("_use", F.row_number().over(Window.partitionBy("bundle_id", path).orderBy("rn")))
    stem, ext = F.regexp_replace(path, r"(\.[^./]*)$", ""), F.regexp_extract(path, r"(\.[^./]*)$", 1)
    named = F.when(F.col("_use") == 1, F.col(path)).otherwise(F.concat(stem, F.lit("__r"), F.col(index).cast("string"), ext))
    rows = rows.withColumn("_named", named)
    bump = F.row_number().over(Window.partitionBy("bundle_id", "_named").orderBy("rn")) - 1
    tail = F.concat(F.regexp_replace("_named", r"(\.[^./]*)$", ""), F.lit("_"), bump.cast("string"), ext)
    return rows.withColumn("unique_path", F.when(bump == 0, F.col("_named")).otherwise(tail)).drop("_use", "_named")


def view_subsample(n: Column, most: int = 400) -> Column:
    """The indices of at most ``most`` of ``n`` views, evenly spread."""
    even = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor(i * n / most).cast("int"))
    return F.when(n > most, even).when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def page(lines: DataFrame, offset: int, limit: int, index: str = "line", value: str = "value") -> DataFrame:
    """The lines ``[offset, offset + limit)`` that are not blank; blank lines count for the index. ``has_more`` tells if lines follow."""
    limit = max(1, min(200, limit))
    more = lines.filter(F.col(index) >= offset + limit).agg((F.count("*") > 0).alias("has_more"))
    own = lines.filter((F.col(index) >= offset) & (F.col(index) < offset + limit) & (F.trim(value) != ""))
    return own.crossJoin(F.broadcast(more))  # one row: whether lines follow


def seek(lines: DataFrame, sample_id: str, index: str = "line", value: str = "value") -> DataFrame:
    """The first line whose sample has the id; lines that are no JSON are passed over."""
    found = F.get_json_object(value, "$.sample.sample_id") == sample_id
    return lines.filter(found).agg(F.min(index).alias(index))


def limited(rows: DataFrame, per_split: int | None = None, total: int | None = None, split: str = "split", order: str = "rn") -> DataFrame:
    """At most ``per_split`` rows of each split and ``total`` of all, in order."""
    out = rows
    if per_split is not None:
        out = out.withColumn("_k", F.row_number().over(Window.partitionBy(split).orderBy(order))).filter(F.col("_k") <= per_split).drop("_k")
    return out.orderBy(split, order).limit(total) if total is not None else out
