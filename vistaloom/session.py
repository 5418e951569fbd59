"""The session that the engine is tuned for."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Set only where the cluster has not chosen otherwise.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # the JVM does not compile methods beyond 8000 bytes: such a stage is faster as separate operators
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def session(name: str = "vistaloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: what ``spark.checkpoint.dir`` names.

    Where that is unset, a local session, whose executors are the driver, gets a
    new temporary folder; on a cluster no folder of one machine would do, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='vistaloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: For writes, whose results are read from elsewhere: Spark removes what a query has shuffled as soon as it ends, not
#: when the driver happens to collect its garbage; and stages stay within what the JVM compiles in any session.
WRITES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": DEFAULTS["spark.sql.codegen.hugeMethodLimit"]}


@contextmanager
def writes(spark: SparkSession) -> Iterator[None]:
    """The settings ``WRITES`` for what is written in here; the session's own hold again afterwards."""
    was = {k: spark.conf.get(k, None) for k in WRITES}
    try:
        for k, v in WRITES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
