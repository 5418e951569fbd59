"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are sorted by the population counts of their parts and
cut into tiles of at most ``TILE``; a tile pair whose counts differ beyond the
radius in total, or summed over their octets, holds no link and is skipped, and every
other pair is compared in full by numpy exclusive-or and bit counts. Links of a
tile pair are united on the spot, so it emits at most one edge for each of its
fingerprints, never all pairs of a group; components are found by joins.

Scale: exact copies collapse to one fingerprint first. Texts are never
shuffled. The comparison is quadratic in the number of distinct fingerprints within reach,
which is what exactness by this method costs; tiles get narrower as the number
grows, so the share of pairs that are skipped rises. Tile pairs are independent
tasks of bounded memory.

Defined results: null and wordless texts have fingerprint zero and are linked
like any other; fewer words than a shingle are one shingle; repeated rows share
a result; null doc_ids are linked, but a component's id ignores them (null if
it has no other); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm.common import read, small_batches, stored
from vistaloom.llm.components import components

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 8192
ROWS = 32
#: Tile pairs that one task compares, about: as many tasks as the pairs ask for, at any size.
PAIRS_A_TASK = 64
SALTS = 32


def fingerprint(text: str | None, n: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) > n:
        starts, ends = starts[: len(words) - n + 1], ends[n - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    of = xxhash.xxh64_intdigest
    hashes = np.array([of(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def fingerprints(documents: DataFrame, n: int = SHINGLE, seed: int = SEED, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row (doc_id, text); fp is the fingerprint as a signed long. With ``hashed``, also the text's hash as _h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), n, seed) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["doc_id", "fp", "_h"][: b.num_columns])

    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    also = [text_hash(F.col("text")).alias("_h")] if hashed else []
    return documents.select("doc_id", "text", *also).mapInArrow(run, f"doc_id {kind}, fp long" + ", _h long" * hashed)


def octets(fp: np.ndarray) -> np.ndarray:
    """The population counts of the eight octets of each fingerprint."""
    return np.bitwise_count(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _count(fp: Column, low: int, width: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)))


def tiles(distinct: DataFrame, size: int = TILE) -> DataFrame:
    """(tile, low, high, box, data): tiles of distinct fingerprints with the range of their population counts and of each octet's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros(0, np.int64)

        def tile(fp: np.ndarray) -> pa.RecordBatch:
            each = octets(fp)
            total = each.sum(axis=1)
            row = {"low": int(total.min()), "high": int(total.max()), "box": [*each.min(axis=0).tolist(), *each.max(axis=0).tolist()], "data": fp.tobytes()}
            return pa.RecordBatch.from_pylist([row], pa.schema([("low", pa.int32()), ("high", pa.int32()), ("box", pa.list_(pa.int32())), ("data", pa.binary())]))

        for b in batches:
            rest = np.concatenate([rest, b.column(0).to_numpy()])
            while len(rest) >= size:
                yield tile(rest[:size])
                rest = rest[size:]
        if len(rest):
            yield tile(rest)

    fp = F.col("fp")
    order = [F.bit_count(fp), *[_count(fp, k, 16) for k in (0, 16, 32)], fp]
    spread = distinct.select("fp").repartitionByRange(*order).sortWithinPartitions(*order)
    cut = spread.mapInArrow(run, "low int, high int, box array<int>, data binary")
    return stored(cut.withColumn("tile", F.monotonically_increasing_id()), "simhash-tiles")


def _apart(a: str, b: str) -> Column:
    """A lower bound of the distance of two tiles: the sum of the gaps between their octets' ranges."""
    gaps = [F.greatest(F.lit(0), F.col(a)[k] - F.col(b)[k + 8], F.col(b)[k] - F.col(a)[k + 8]) for k in range(8)]
    return sum(gaps[1:], gaps[0])


def tile_pairs(cut: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(tile, other): the tile pairs, each tile with itself among them, that may hold a link."""
    meta = cut.select("tile", "low", "high", "box")
    left = meta.select(F.col("tile"), F.col("box"), F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius)).alias("count"))
    right = meta.select(F.col("tile").alias("other"), F.col("box").alias("box2"), F.explode(F.sequence("low", "high")).alias("count"))
    met = left.join(right, "count").filter("tile <= other")
    return met.filter(_apart("box", "box2") <= radius).select("tile", "other").distinct()


def united(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within ``radius`` between tiles ``a`` and ``b`` (within ``a`` if ``b`` is None)."""
    own = b is None
    whole = a if own else np.concatenate([a, b])
    other = a if own else b
    shift = 0 if own else len(a)
    label = np.arange(len(whole))
    wide = other.view(np.uint64)
    for at in range(0, len(a), ROWS):
        rows = a[at : at + ROWS].view(np.uint64)
        near = np.bitwise_count(rows[:, None] ^ wide[None, :]) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            reach = label[np.flatnonzero(near[i]) + shift]
            mine = label[at + i]
            roots = np.unique(reach[reach != mine])
            if len(roots):
                least = min(mine, roots[0])
                label[np.isin(label, [mine, *roots])] = least
    moved = np.flatnonzero(label != np.arange(len(whole)))
    return whole[moved], whole[label[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """(u, v): edges between distinct fingerprints whose components are those of all links."""
    cut = tiles(distinct, size)
    data = cut.select("tile", "data")
    pairs = stored(tile_pairs(cut, radius), "simhash-pairs")
    tasks = max(pairs.sparkSession.sparkContext.defaultParallelism * 4, pairs.count() // PAIRS_A_TASK)
    pairs = pairs.join(data, "tile").join(data.select(F.col("tile").alias("other"), F.col("data").alias("data2")), "other")
    pairs = pairs.select("tile", "other", "data", "data2").repartition(tasks, "tile", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, o, x, y in zip(*(batch.column(k) for k in range(4)), strict=True):
                a = np.frombuffer(x.as_py(), np.int64)
                b = None if t.as_py() == o.as_py() else np.frombuffer(y.as_py(), np.int64)
                u, v = united(a, b, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def _rooted(rows: DataFrame, first: Column, radius: int) -> DataFrame:
    """(fp, first, root) of every distinct fingerprint of ``rows`` (doc_id, fp, ...): an aggregate of its rows, and its component, null if it is linked to nothing."""
    distinct = stored(rows.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    roots = components(links(distinct, radius))
    return stored(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "simhash-roots")


def grouped(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row (doc_id, text)."""
    rows = stored(fingerprints(documents), "simhash-fingerprints")
    rooted = _rooted(rows, F.min("doc_id"), radius)
    alone = rooted.filter("root is null").select("fp", F.col("first").alias("component_id"))
    # a component may hold a third of all fingerprints: its rows meet its id by salt
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    linked = rooted.filter("root is not null").withColumn("_salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id")).select("root", "component_id", salts)
    named = alone.unionByName(linked.join(least, ["root", "_salt"]).select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each group: that with the least doc_id (nulls last), then the least hash of its text, then the least JSON of its columns. Columns stay.

    Rows go by (doc_id, text), so a doc_id that occurs with several texts, or a null one, loses no text that
    is in no other group; rows alike in both are one document.
    """
    rows = stored(fingerprints(documents, hashed=True), "simhash-fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_h")
    rooted = _rooted(rows, F.min(key), radius)
    chosen = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("x"))
    chosen = chosen.select(F.col("x.doc_id").alias("_c"), F.col("x._h").alias("_c_h"))
    keys = rows.groupBy("doc_id", "_h").agg(F.count("*").alias("_n"))
    keys = keys.join(chosen, F.col("doc_id").eqNullSafe(F.col("_c")) & (F.col("_h") == F.col("_c_h")), "left")
    # of a chosen document with one row nothing is to do
    odd = keys.filter(F.col("_c_h").isNull() | (F.col("_n") > 1)).select(F.col("doc_id").alias("_d"), F.col("_h").alias("_d_h"), F.col("_c_h").isNotNull().alias("_again"))
    odd = stored(odd, "simhash-odd")
    # the row travels in one column, so its names clash with nothing
    hashed = documents.select("doc_id", text_hash(F.col("text")).alias("_h"), F.struct(*documents.columns).alias("_row"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_d_h"))
    again = hashed.join(odd.filter("_again"), same, "left_semi").groupBy("doc_id", "_h").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return hashed.join(odd, same, "left_anti").select("_row.*").unionByName(again.select("_row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = grouped(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
