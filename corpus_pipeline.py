"""The corpus pipeline: five operators of ``vistaloom.llm``, each over all that the one before it kept.

Every stage returns the columns of ``documents``; the last adds ``taken``, the
words that the mix takes of each document, and leaves out those it takes
nothing of. Each stage is written as a table in the shared folder and read
again, so a lost executor costs one stage's tasks at most.

Defined results: a null text has no words and is rejected by the quality rules; a
null doc_id or source is a value like any other; rows alike in doc_id and text are
one document from near-duplicates on; columns beyond those of ``documents`` pass
through, whatever they are called, but for ``taken``, which the last stage sets;
empty tables give an empty corpus, and an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm import decontam, mixing, quality, secrets, simhash
from vistaloom.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with ``taken``. Rows alike in doc_id, source and text, of which stages before this one leave one, share what is taken of them evenly."""
    plan = mixing.mix(docs.select("doc_id", "text", "source")).groupBy("doc_id", "source", "text_hash")
    plan = plan.agg(F.floor(F.avg("taken")).cast("long").alias("taken")).filter("taken > 0")
    plan = plan.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("text_hash").alias("h"), "taken")
    # the row travels in one column, so its names clash with nothing
    rows = docs.select("doc_id", "source", mixing.text_hash(F.col("text")).alias("own"), F.struct(*docs.columns).alias("row"))
    met = rows.join(plan, rows["doc_id"].eqNullSafe(F.col("d")) & rows["source"].eqNullSafe(F.col("s")) & (F.col("own") == F.col("h")))
    return met.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "taken"], "taken")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources", source_mixing),
]

#: Fingerprints and token counts have no SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
