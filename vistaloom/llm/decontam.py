"""Benchmark decontamination by a distributed positional inverted index (native expressions only).

``build_index`` stores one posting (document, position, term) for each training
token that is a term of the test set, and one end posting for each document at
the position of its word count. ``phrases`` then starts every test window from
its rarest terms: the postings of the rarest term, adjusted by its offset in
the item, are intersected with those of the second rarest, which leaves
(document, item, diagonal) candidates; only these are checked term by term, and
runs of consecutive matches as long as a window are exact phrase matches.
``proximity`` answers the looser question on the same index.

Scale: texts are tokenised once and never shuffled. Postings of common words
are stored but only read for documents that survived the intersection. The test
vocabulary is broadcast when it has at most ``BROADCAST_TERMS`` terms and joined
by a shuffle otherwise.

Defined results: null has no words and no hits; documents are keyed by doc_id
and a hash of the text, so null and repeated doc_ids are rows of their own (identical
rows share one result, given to each); items without words have no windows; several items of
one text all match; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaloom.llm.common import read, stored

WINDOW = 13
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Never a term: the end posting's word.
END = "\x00"
BROADCAST_TERMS = 1_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DOC = ["doc_id", "text_hash"]


def terms(text: Column) -> Column:
    """The words of a text in which A to Z, and no other letter, are lower-cased."""
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), BREAKS), "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, p, term, length) of every item word, and the vocabulary (term, term_id)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), terms(F.col("text")).alias("w")).filter(F.size("w") > 0)
    # texts of one item_id are told apart by their words
    items = items.select("item_id", F.xxhash64("w").alias("item_hash"), "w").distinct()
    each = items.select("item_id", "item_hash", F.least(F.size("w"), F.lit(WINDOW)).alias("length"), F.posexplode("w").alias("p", "term"))
    each = stored(each, "decontam-items")
    number = F.row_number().over(Window.orderBy("term"))
    vocabulary = each.select("term").distinct().select("term", number.cast("int").alias("term_id"))
    return each, stored(vocabulary, "decontam-terms")


def build_index(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The stored postings (doc_id, text_hash, pos, term_id); term_id 0 marks a document's end."""
    spark = documents.sparkSession
    end = spark.createDataFrame([(END, 0)], "term string, term_id int")
    small = vocabulary.count() <= BROADCAST_TERMS
    vocabulary = vocabulary.unionByName(end)
    words = F.concat(terms(F.col("text")), F.array(F.lit(END)))
    tokens = documents.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.posexplode(words).alias("pos", "term"))
    postings = tokens.join(F.broadcast(vocabulary) if small else vocabulary, "term")
    return stored(postings.select("doc_id", "text_hash", "pos", "term_id"), "decontam-postings")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def phrases(postings: DataFrame, items: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Every document word inside an occurrence of a window: (doc_id, text_hash, item_id, length, pos); length is the window's."""
    tokens = postings.filter("term_id > 0")
    counts = tokens.groupBy("term_id").agg(F.count("*").alias("n"))
    items = items.join(vocabulary, "term").join(counts, "term_id", "left").select("item_id", "item_hash", "p", "length", "term_id", F.coalesce("n", F.lit(0)).alias("n"))
    items = stored(items, "decontam-ranked")
    item = Window.partitionBy("item_id", "item_hash")
    # each window's words by how rare they are in training; windows with an unseen word cannot occur
    starts = items.withColumn("n_item", F.max("p").over(item) + 1).select(
        "*", F.explode(F.sequence(F.greatest(F.lit(0), F.col("p") - F.col("length") + 1), F.least(F.col("p"), F.col("n_item") - F.col("length")))).alias("s")
    )
    window = Window.partitionBy("item_id", "item_hash", "s")
    ranked = starts.withColumn("least", F.min("n").over(window)).filter("least > 0")
    ranked = ranked.withColumn("rank", F.row_number().over(window.orderBy("n", "term_id", "p")))
    pairs = ranked.groupBy("item_id", "item_hash", "s").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("p", "term_id"))).alias("a"), F.max(F.when(F.col("rank") == 2, F.struct("p", "term_id"))).alias("b")
    )
    pairs = pairs.select(
        "item_id", "item_hash", F.col("a.p").alias("p1"), F.col("a.term_id").alias("t1"), F.coalesce("b.p", "a.p").alias("p2"), F.coalesce("b.term_id", "a.term_id").alias("t2")
    ).distinct()
    pairs = stored(pairs, "decontam-pairs")
    first = tokens.join(pairs, F.col("term_id") == F.col("t1")).select(*DOC, "item_id", "item_hash", (F.col("pos") - F.col("p1")).alias("diagonal"), "p2", "t2")
    second = tokens.join(pairs.select("t2").distinct(), F.col("term_id") == F.col("t2"), "left_semi")
    second = second.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("at"), F.col("term_id").alias("t"))
    both = first.join(
        second,
        _same("doc_id", "d") & (F.col("text_hash") == F.col("h")) & (F.col("diagonal") + F.col("p2") == F.col("at")) & (F.col("t2") == F.col("t")),
        "left_semi",
    )
    survivors = stored(both.select(*DOC, "item_id", "item_hash", "diagonal").distinct(), "decontam-survivors")
    # term by term, in the surviving documents alone
    wanted = survivors.join(items.select("item_id", "item_hash", "p", "length", F.col("term_id").alias("t")), ["item_id", "item_hash"])
    wanted = wanted.withColumn("at", F.col("diagonal") + F.col("p"))
    alive = survivors.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct()
    near = tokens.join(alive, _same("doc_id", "d") & (F.col("text_hash") == F.col("h")), "left_semi")
    near = near.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "pos", "term_id").distinct()
    hits = wanted.join(near, _same("doc_id", "d") & (F.col("text_hash") == F.col("h")) & (F.col("at") == F.col("pos")) & (F.col("t") == F.col("term_id")))
    line = Window.partitionBy(*DOC, "item_id", "item_hash", "diagonal")
    run = F.col("p") - F.row_number().over(line.orderBy("p"))
    hits = hits.select(*DOC, "item_id", "item_hash", "diagonal", "p", "length", "pos", run.alias("run"))
    full = F.count("*").over(Window.partitionBy(*DOC, "item_id", "item_hash", "diagonal", "run")) >= F.col("length")
    return hits.withColumn("full", full).filter("full").select(*DOC, "item_id", "length", "pos")


def proximity(postings: DataFrame, vocabulary: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """(doc_id, text_hash, pos, other): occurrences of two test terms at most ``within`` words apart.

    Positions are cut into blocks of ``within`` words; a posting meets the postings of its own and the neighbouring blocks.
    """
    ids = {r.term: r.term_id for r in vocabulary.filter(F.col("term").isin(first, second)).collect()}
    own = postings.filter(F.col("term_id") == ids.get(first, -1)).select(*DOC, "pos", F.explode(F.array(*[F.floor(F.col("pos") / within) + k for k in (-1, 0, 1)])).alias("block"))
    other = postings.filter(F.col("term_id") == ids.get(second, -1)).select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("other"), F.floor(F.col("pos") / within).alias("b")
    )
    met = own.join(other, _same("doc_id", "d") & (F.col("text_hash") == F.col("h")) & (F.col("block") == F.col("b")))
    return met.filter((F.abs(F.col("pos") - F.col("other")) <= within) & (F.col("pos") != F.col("other"))).select(*DOC, "pos", "other")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document row (doc_id, text): (doc_id, text_hash, n_words, n_hit, n_items, items, contaminated, whole).

    ``contaminated``: hits reach a twentieth of the words. ``whole``: a window of ``WINDOW`` words, not
    merely an item of fewer, occurs.
    """
    items, vocabulary = windows(benchmark)
    postings = build_index(documents, vocabulary)
    hit = phrases(postings, items, vocabulary)
    words = hit.groupBy(*DOC, "pos").agg(F.lit(1).alias("one")).groupBy(*DOC).agg(F.count("*").alias("n_hit"))
    found = hit.groupBy(*DOC, "item_id").agg(F.max("length").alias("length")).groupBy(*DOC)
    found = found.agg(F.sort_array(F.collect_list("item_id")).alias("items"), (F.max("length") >= WINDOW).alias("whole"))
    words = words.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "n_hit")
    hits = found.join(words, _same("doc_id", "d") & (F.col("text_hash") == F.col("h"))).select("d", "h", "n_hit", "items", "whole")
    ends = postings.filter("term_id = 0").select(*DOC, F.col("pos").cast("long").alias("n_words"))
    rows = ends.join(hits, _same("doc_id", "d") & (F.col("text_hash") == F.col("h")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return rows.select(
        *DOC,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("whole", F.lit(False)).alias("whole"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark text, with the columns they came with.

    A whole window of ``WINDOW`` words is enough to drop a document, however long it is. Items of fewer
    words occur by chance in long texts, so they count only where hits reach a twentieth of the words.
    """
    bad = decontaminate(documents.select("doc_id", "text"), benchmark).filter("whole or contaminated")
    bad = bad.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct()
    # the row travels in one column, so its names clash with nothing
    rows = documents.select("doc_id", text_hash(F.col("text")).alias("own"), F.struct(*documents.columns).alias("row"))
    return rows.join(bad, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("own") == F.col("_h")), "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document against the whole benchmark."""
    found = decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark) WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, w[s : s + n - 1] AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM b)),
k AS (SELECT DISTINCT n FROM b),
g AS (SELECT r, n, s, w[s : s + n - 1] AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, k WHERE len(w) >= n)),
m AS (SELECT r, g.n, s, item_id FROM g JOIN q USING (n, g)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
i AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)
"""
