"""Writing tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.sources import store


def parquet(rows: DataFrame, path: str, per_file: int | None = None) -> None:
    """Parquet, at most ``per_file`` rows in each file."""
    writer = rows.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", per_file) if per_file else writer).parquet(path)


def jsonl(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One JSON object a line, nulls kept; in order across the part files if ``order`` is given."""
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def shards(rows: DataFrame, folder: str, number: str = "bundle_id", order: str = "rn", value: str = "value") -> int:
    """Lines as ``data_NNNNNN.jsonl`` in a folder of a store, one file for each number, written by the tasks; returns how many files."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        n = int(group[number].iloc[0])
        store.write(f"{folder}/data_{n:06d}.jsonl", "".join(f"{x}\n" for x in group.sort_values(order)[value]).encode())
        return pd.DataFrame({"n": [n]})

    return rows.select(number, order, value).groupBy(number).applyInPandas(run, "n long").count()


def scene_chunks(rows: DataFrame, chunk_size: int, key: str = "scene_id") -> DataFrame:
    """``rows`` with ``chunk``: whole scenes in key order, a new chunk once one has at least ``chunk_size`` rows.

    Where a chunk ends depends on where the one before it ended, so the counts, one
    for each scene, run through one task as a sorted stream, in constant memory and
    with one step for each chunk; the rows themselves get their chunk by a join.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, held = 0, 0
        for b in batches:
            sums, out, at = np.cumsum(b["n"].to_numpy()), np.empty(len(b), np.int64), 0
            while at < len(b):
                before = sums[at - 1] if at else 0
                end = int(np.searchsorted(sums, before + chunk_size - held)) + 1
                out[at:end] = chunk
                if end > len(b):
                    held += int(sums[-1] - before)
                else:
                    chunk, held = chunk + 1, 0
                at = end
            yield pd.DataFrame({key: b[key], "chunk": out})

    folded = counts.repartition(1).sortWithinPartitions(key).mapInPandas(run, f"{key} {kind}, chunk long")
    return rows.join(folded, key)


def write_scene_chunks(rows: DataFrame, path: str, chunk_size: int, key: str = "scene_id") -> None:
    """Scene-complete chunks as one partition folder each."""
    scene_chunks(rows, chunk_size, key).repartition("chunk").sortWithinPartitions(key).write.mode("overwrite").partitionBy("chunk").parquet(path)


def point_cloud_text(points: DataFrame, key: str = "object", form: str = "obj") -> DataFrame:
    """(key, text): clouds as OBJ or ASCII PLY."""
    line = F.format_string(("v " if form == "obj" else "") + "%.6f %.6f %.6f", "x", "y", "z")
    rows = points.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("x", "y", "z", line.alias("l")))).alias("p"))
    body = F.array_join("p.l", "\n")
    if form == "obj":
        return rows.select(key, body.alias("text"))
    head = F.concat(F.lit("ply\nformat ascii 1.0\nelement vertex "), F.size("p").cast("string"), F.lit("\nproperty float x\nproperty float y\nproperty float z\nend_header\n"))
    return rows.select(key, F.concat(head, body).alias("text"))


def hub(path: str, name: str) -> None:
    """Publishing to a hub is left to its own tools."""
    raise NotImplementedError(f"upload {path} to {name} with the hub's own client")
