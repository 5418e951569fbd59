"""Pieces that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.session import shared_folder

#: One word separator: the ASCII white space of the contracts.
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """The maximal runs of anything but ASCII white space; null for a null text."""
    return F.array_remove(F.split(text, SPACES), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as ``session.shared_folder`` finds it, also set as the checkpoint folder."""
    found = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    This cuts the lineage: what is read later survives any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Documents that go to Python at once; a batch holds their whole texts on both sides.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lowers the session's Arrow batch size to ``rows``: the default of 10,000 whole texts costs tens of MB for each task and side."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, rows)
