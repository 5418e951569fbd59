"""Tar bundles: a Python data source for reading, and bundle writing with an index."""

from __future__ import annotations

import io
import json
import re
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vistaloom.sources import store


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["paths"].split("\n")
        self.content = options.get("content", "true") == "true"

    def partitions(self):
        return [_Archive(p) for p in self.paths]

    def read(self, partition):
        with store.opened(partition.path) as file, tarfile.open(fileobj=file) as tar:
            for m in tar:
                if m.isfile():
                    yield partition.path, m.name, m.offset_data, m.size, tar.extractfile(m).read() if self.content else None


class TarSource(DataSource):
    """Format ``tar_members``: a row for each file of the archives in option ``paths`` (one a line), one partition for each archive."""

    @classmethod
    def name(cls):
        return "tar_members"

    def schema(self):
        return "tar string, member string, offset_data long, size long, content binary"

    def reader(self, schema):
        return _Reader(dict(self.options))


def members(spark: SparkSession, paths: list[str], content: bool = True) -> DataFrame:
    """(tar, member, offset_data, size, content) of the archives at paths or URIs."""
    spark.dataSource.register(TarSource)
    return spark.read.format("tar_members").option("paths", "\n".join(paths)).option("content", str(content).lower()).load()


def lookup(wanted: DataFrame, found: DataFrame, name: str = "path") -> DataFrame:
    """``wanted`` with the best member for each name: the very name, then without leading dots and slashes, then with ``./``, then by base name."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    keys = F.array(F.col(name), F.regexp_replace(name, "^[./]+", ""), F.concat(F.lit("./"), F.col(name)), F.concat(F.lit("\x00"), base(F.col(name))))
    left = wanted.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode(keys).alias("_rank", "_key"))
    right = found.withColumn("_keys", F.array(F.col("member"), F.concat(F.lit("\x00"), base(F.col("member")))))
    right = right.select("*", F.explode("_keys").alias("_key")).drop("_keys")
    met = left.join(right, "_key", "left")
    best = Window.partitionBy("_row").orderBy(F.col("member").isNull(), "_rank", "member", "tar")
    return met.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n", "_row", "_rank", "_key")


def slices(index: DataFrame) -> DataFrame:
    """``content`` of (tar, offset_data, size) rows read by position; a short read is an error."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    schema = StructType([*index.schema.fields, StructField("content", BinaryType())])

    def run(batches):
        for b in batches:
            out = []
            for r in b.itertuples():
                out.append(store.slice_of(r.tar, r.offset_data, r.size))
            yield b.assign(content=out)

    return index.mapInPandas(run, schema)


def bundle(rows: pd.DataFrame) -> tuple[bytes, str, str]:
    """(tar, index JSON, rows as JSON lines) of a bundle's rows (unique_path, content, row), in order."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for r in rows.itertuples():
            info = tarfile.TarInfo(r.unique_path)
            info.size = len(r.content)
            tar.addfile(info, io.BytesIO(r.content))
    out.seek(0)
    with tarfile.open(fileobj=out) as tar:
        index = {m.name: {"offset_data": m.offset_data, "size": m.size, "sparse": None} for m in tar}
    return out.getvalue(), json.dumps(index), "".join(r + "\n" for r in rows["row"])


def bundles(rows: DataFrame) -> DataFrame:
    """(bundle_id, n, tar, tarinfo, jsonl) of packed rows (bundle_id, rn, unique_path, content, row); a bundle must fit a task."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rn")
        tar, index, lines = bundle(group)
        return pd.DataFrame({"bundle_id": [group["bundle_id"].iloc[0]], "n": [len(group)], "tar": [tar], "tarinfo": [index], "jsonl": [lines]})

    columns = ["bundle_id", "rn", "unique_path", "content", "row"]
    return rows.select(*columns).groupBy("bundle_id").applyInPandas(run, "bundle_id long, n long, tar binary, tarinfo string, jsonl string")


def export(made: DataFrame, folder: str) -> int:
    """Writes bundles as ``images/data_N.tar``, ``images/data_N_tarinfo.json`` and ``jsonl/data_N.jsonl`` below a folder of a store; returns how many.

    The tasks that hold the bundles write them, under names of their own, so nothing goes
    through the driver and a lost task is simply run again. Bundles of an earlier export beyond the last one written go at last.
    """

    def run(batches):
        for b in batches:
            for r in b.itertuples():
                name = f"data_{r.bundle_id:06d}"
                store.write(f"{folder}/images/{name}.tar", bytes(r.tar))
                store.write(f"{folder}/images/{name}_tarinfo.json", r.tarinfo.encode())
                store.write(f"{folder}/jsonl/{name}.jsonl", r.jsonl.encode())
            yield pd.DataFrame({"bundle_id": b["bundle_id"]})

    written = made.select("bundle_id", "tar", "tarinfo", "jsonl").mapInPandas(run, "bundle_id long")
    n, last = written.agg(F.count("*"), F.coalesce(F.max("bundle_id"), F.lit(-1))).first()
    for kind in ("images", "jsonl"):
        for old in store.names(f"{folder}/{kind}", r"^data_\d+"):
            if int(re.search(r"\d+", old)[0]) > last:
                store.remove(f"{folder}/{kind}/{old}")
    return n
