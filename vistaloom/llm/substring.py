"""Substring deduplication by De Bruijn compaction.

Every window of ``WINDOW`` words is an edge between its first and last
``WINDOW - 1`` words. Edges that start in two or more documents are kept, paths
of them that do not branch (no occurrence enters, leaves, starts or ends within)
are compacted to one unit, and the words of each unit's occurrences, taken at
their source coordinates, are compared by a 128-bit digest. A word goes if a unit
that covers it also occurs in a document with a smaller doc_id.

Layout. Documents are packed, words joined by one space, into compressed blocks
by a hash of doc_id and text, in a table bucketed by block: texts are shuffled once. The
other exchanges carry sorted hashes, four bytes each and eight more for a node's
neighbours, between blocks and hash ranges, and one bit for each as the answer. Blocks and ranges have a
bounded size, so their number grows with the input; a block sends each edge once,
so an edge that a third of all documents share is no heavier than any other.

Scale of the fingerprints: a range holds about ``RANGE_EDGES`` edges, told apart
by 40 bits beyond the range's own, so about one edge in a million is taken for a
repeat by chance at any size. Such an edge only makes a unit of one
occurrence: the digest decides what is removed. Neighbours are told apart by 64 bits; two that
were not would join paths that branch and lose a removal.

Defined results: null and wordless texts have no words; a null doc_id is neither
larger nor smaller than another, so such rows keep all and are no source;
repeated rows are the same document and keep what they share; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm.common import read, shared_dir, small_batches, stored

WINDOW = 13
BLOCK_CHARS = 8_000_000
PACK_CHARS = 32_000_000
RANGE_EDGES = 1 << 20
STEP = 1 << 20

_random = np.random.Generator(np.random.PCG64(20240229))
BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
BASE, BASE_INV = (np.uint64(x) for x in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _step_powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS["p"], _POWERS["q"] = _powers(BASE, STEP), _powers(BASE_INV, STEP)
    return _POWERS["p"], _POWERS["q"]


def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Position-free polynomial hashes of ``values[first : last]``: sums of value * base**offset."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(BASE, len(values)), out=total[1:])
    return (total[last] - total[first]) * _powers(BASE_INV, len(values) + 1)[first]


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``buffer[start : end]``, in steps of bounded memory."""
    p, q = _step_powers()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + STEP - 1, side="right")))
        high = ends[to - 1]
        part = BYTE[buffer[low:high]]
        if high - low <= STEP:
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * p[: len(part)], out=total[1:])
            out[at:to] = (total[ends[at:to] - low] - total[starts[at:to] - low]) * q[starts[at:to] - low]
        else:  # one word longer than a step
            out[at:to] = _sums(part, np.zeros(1, np.int64), np.array([high - low]))
        at = to
    return _mix(out ^ (ends - starts).astype(np.uint64))


class Groups:
    """Equal values of an array: the sorted distinct ones, and where each occurs."""

    def __init__(self, values: np.ndarray):
        self.order = np.argsort(values)
        values = values[self.order]
        self.head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
        self.distinct = values[self.head]
        self.size = np.diff(np.append(self.head, len(values)))

    def each(self, of: np.ndarray, reduce: np.ufunc) -> np.ndarray:
        """``of`` (alongside the values) reduced for each distinct value."""
        return reduce.reduceat(of[self.order], self.head) if len(self.head) else of[:0]

    def spread(self, flags: np.ndarray) -> np.ndarray:
        """A flag of each distinct value, at each place where it occurs."""
        out = np.empty(len(self.order), bool)
        out[self.order] = np.repeat(flags, self.size)
        return out


class Block:
    """The words of a block's documents and the hashes of their windows."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], window: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.texts = ids[order], [texts[i] for i in order]
        full = [t for t in self.texts if t]
        self.buffer = b" ".join(full) + b" " if full else b""
        raw = np.frombuffer(self.buffer, np.uint8)
        self.ends = np.flatnonzero(raw == 32)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        # word numbers at which documents start and end
        size = np.array([len(t) + 1 if t else 0 for t in self.texts], np.int64)
        stop = np.cumsum(size)
        self.last = np.searchsorted(self.ends, stop - 1, side="right") if len(stop) else stop
        self.last[stop == 0] = 0
        self.first = np.concatenate([[0], self.last[:-1]]).astype(np.int64) if len(stop) else stop
        self.n_words = self.last - self.first
        self.window = window
        self.doc = np.repeat(np.arange(len(self.ids)), self.n_words)
        words = word_hashes(raw, self.starts, self.ends)
        n = len(words)
        begin = np.arange(n)
        self.fits = begin + window <= self.last[self.doc]
        self.edges = _mix(_sums(words, begin, np.minimum(begin + window, n)))
        self.nodes = _mix(_sums(words, begin, np.minimum(begin + window - 1, n)) + np.uint64(1))
        self.at = np.flatnonzero(self.fits)
        self.groups = Groups(self.edges[self.at])

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """For each word, whether an edge starts there that also starts in another document, of this block or ``elsewhere``."""
        doc = self.ids[self.doc[self.at]]
        here = self.groups.each(doc, np.minimum) != self.groups.each(doc, np.maximum)
        out = np.zeros(len(self.edges), bool)
        out[self.at] = self.groups.spread(elsewhere | here)
        return out

    def junctions(self, repeated: np.ndarray) -> tuple[np.ndarray, Groups, np.ndarray]:
        """(positions, their nodes, the neighbour hash of each distinct node) of the nodes that touch a repeated edge.

        The neighbour hash is over 1 where every occurrence here has the same edge
        before and the same edge after, and at most 1 where a path starts, ends or branches.
        """
        n = len(repeated)
        same = np.zeros(n, bool)
        same[1:] = self.doc[1:] == self.doc[:-1] if n else same[1:]
        before = np.zeros(n, bool)
        before[1:] = repeated[:-1] & same[1:]
        at = np.flatnonzero((before | repeated) & (np.arange(n) + self.window - 1 <= self.last[self.doc]))
        pair = np.zeros(len(at), np.uint64)
        inner = before[at] & repeated[at]
        k = at[inner]
        pair[inner] = np.maximum(_mix(self.edges[k - 1] + _mix(self.edges[k])), np.uint64(2))
        nodes = Groups(self.nodes[at])
        low, high = nodes.each(pair, np.minimum), nodes.each(pair, np.maximum)
        return at, nodes, np.where((low == high) & (low > 1), low, np.uint64(1))

    def units(self, repeated: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) edge positions of the compacted paths' occurrences; ``breaks``: whether a path breaks before a position."""
        n = len(repeated)
        joined = np.zeros(n, bool)
        if n:
            joined[1:] = repeated[1:] & repeated[:-1] & (self.doc[1:] == self.doc[:-1]) & ~breaks[1:]
        first = np.flatnonzero(repeated & ~joined)
        end = np.zeros(n, bool)
        end[:-1] = ~joined[1:]
        end[-1:] = True
        return first, np.flatnonzero(repeated & end)

    def digests(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """128-bit digests of the words that the units cover."""
        a, b = self.starts[first].tolist(), self.ends[last + self.window - 1].tolist()
        return [hashlib.blake2b(self.buffer[x:y], digest_size=16).digest() for x, y in zip(a, b, strict=True)]


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def short(values: np.ndarray, bits: int) -> np.ndarray:
    """The 40 bits of a hash after its first ``bits``."""
    return (values << np.uint64(bits)) >> np.uint64(24)


def pack(values: np.ndarray) -> bytes:
    """Sorted 40-bit values as counts by their first 8 bits and the other 32 bits of each."""
    counts = np.bincount((values >> np.uint64(32)).astype(np.int64), minlength=256).astype("<u4")
    return counts.tobytes() + values.astype("<u4").tobytes()


def unpack(data: bytes) -> np.ndarray:
    counts = np.frombuffer(data, "<u4", 256)
    high = np.repeat(np.arange(256, dtype=np.uint64) << np.uint64(32), counts)
    return high | np.frombuffer(data, "<u4", offset=1024).astype(np.uint64)


def ranges(values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of the sorted hashes by their first ``bits``."""
    if not bits:
        if len(values):
            yield 0, 0, len(values)
        return
    top = values >> np.uint64(64 - bits)
    head = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]])) if len(top) else []
    for a, b in zip(head, [*head[1:], len(top)], strict=True):
        yield int(top[a]), int(a), int(b)


def blocks_of(documents: DataFrame, n_blocks: int) -> DataFrame:
    """The documents (doc_id, text) packed by block, as a table bucketed by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for block, rows in held.items():
                sink = pa.BufferOutputStream()
                table = pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.large_binary())})
                with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(table)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
            held.clear()

        for b in batches:
            for block, doc, text in zip(*(b.column(k) for k in range(3)), strict=True):
                words = b" ".join((text.as_py() or "").encode().split())
                held.setdefault(block.as_py(), []).append((doc.as_py(), words))
                size += len(words)
                if size >= PACK_CHARS:
                    yield from flush()
                    size = 0
        yield from flush()

    spark = documents.sparkSession
    small_batches(spark)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks))
    packed = documents.select(block.alias("block"), "doc_id", "text").mapInArrow(run, "block long, data binary")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n_blocks, 100_000))
    name = f"substring_blocks_{uuid.uuid4().hex}"
    writer = packed.repartition(buckets, "block").write.bucketBy(buckets, "block").option("compression", "uncompressed")
    writer.option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    blocks = spark.table(name)
    blocks.schema  # noqa: B018  resolved, it needs the catalog's entry no more; the files are the shared folder's
    spark.sql(f"DROP TABLE {name}")
    return blocks


def load(table: pa.Table, window: int) -> Block:
    ids, texts = [], []
    for data in table.column("data"):
        part = pa.ipc.open_stream(data.as_py()).read_all()
        ids.append(part.column("id").to_numpy())
        texts += part.column("text").to_pylist()
    return Block(np.concatenate(ids) if ids else np.zeros(0, np.int64), texts, window)


MESSAGE = "range int, block long, data binary"
ANSWER = "block long, kind int, range int, data binary, source long"


def _messages(rows: list[tuple]) -> pa.Table:
    kind = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
    return pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], kind)


def _answers(rows: list[tuple]) -> pa.Table:
    kind = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()), ("data", pa.binary()), ("source", pa.int64())])
    return pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], kind)


def _bits(answers: pa.Table, kind: int, sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """One flag for each sorted hash, from the answers to what was sent of it."""
    data = {r: d for k, r, d in zip(*(answers.column(c).to_pylist() for c in ("kind", "range", "data")), strict=True) if k == kind}
    out = np.zeros(len(sorted_hashes), bool)
    for r, a, b in ranges(sorted_hashes, bits):
        out[a:b] = np.unpackbits(np.frombuffer(data[r], np.uint8), count=b - a).astype(bool)
    return out


def send_edges(blocks: DataFrame, window: int, bits: int) -> DataFrame:
    def run(key, table):
        e = load(table, window).groups.distinct
        return _messages([(r, key[0].as_py(), pack(short(e[a:b], bits))) for r, a, b in ranges(e, bits)])

    return blocks.groupBy("block").applyInArrow(run, MESSAGE)


def answer_edges(messages: DataFrame) -> DataFrame:
    """Which of the edges sent also came from another block."""

    def run(key, table):
        sent = [(b.as_py(), unpack(d.as_py())) for b, d in zip(table.column("block"), table.column("data"), strict=True)]
        every = np.sort(np.concatenate([v for _, v in sent]))
        twice = every[1:][every[1:] == every[:-1]]
        return _answers([(b, 1, key[0].as_py(), np.packbits(member(v, twice)).tobytes(), None) for b, v in sent])

    return messages.groupBy("range").applyInArrow(run, ANSWER)


def send_nodes(blocks: DataFrame, answers: DataFrame, window: int, bits: int) -> DataFrame:
    def run(key, table, own):
        block = load(table, window)
        _, nodes, pairs = block.junctions(block.repeated(_bits(own, 1, block.groups.distinct, bits)))
        node = nodes.distinct
        return _messages([(r, key[0].as_py(), pack(short(node[a:b], bits)) + pairs[a:b].astype("<u8").tobytes()) for r, a, b in ranges(node, bits)])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, MESSAGE)


def answer_nodes(messages: DataFrame) -> DataFrame:
    """At which of the nodes sent a path starts, ends or branches in any block."""

    def run(key, table):
        sent = []
        for b, d in zip(table.column("block"), table.column("data"), strict=True):
            d = d.as_py()
            n = (len(d) - 1024) // 12
            sent.append((b.as_py(), unpack(d[: 1024 + 4 * n]), np.frombuffer(d, "<u8", offset=1024 + 4 * n)))
        node, pair = (np.concatenate([x[k] for x in sent]) for k in (1, 2))
        groups = Groups(node)
        low, high = groups.each(pair, np.minimum), groups.each(pair, np.maximum)
        broken = groups.distinct[(low <= 1) | (low != high)]
        return _answers([(b, 2, key[0].as_py(), np.packbits(member(v, broken)).tobytes(), None) for b, v, _ in sent])

    return messages.groupBy("range").applyInArrow(run, ANSWER)


def _units(table: pa.Table, own: pa.Table, window: int, bits: int) -> tuple[Block, np.ndarray, np.ndarray, list[bytes]]:
    block = load(table, window)
    repeated = block.repeated(_bits(own, 1, block.groups.distinct, bits))
    at, nodes, _ = block.junctions(repeated)
    breaks = np.zeros(len(repeated), bool)
    breaks[at] = nodes.spread(_bits(own, 2, nodes.distinct, bits))
    first, last = block.units(repeated, breaks)
    return block, first, last, block.digests(first, last)


def send_units(blocks: DataFrame, answers: DataFrame, window: int, bits: int) -> DataFrame:
    """(block, unit, source): each block's units by the digest of their words, and the least doc_id that has them."""
    kind = pa.schema([("block", pa.int64()), ("unit", pa.binary()), ("source", pa.int64())])

    def run(key, table, own):
        block, first, _, digests = _units(table, own, window, bits)
        least: dict[bytes, int] = {}
        for d, doc in zip(digests, block.ids[block.doc[first]].tolist(), strict=True):
            least[d] = min(doc, least.get(d, doc))
        return pa.Table.from_pydict({"block": [key[0].as_py()] * len(least), "unit": list(least), "source": list(least.values())}, kind)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, "block long, unit binary, source long")


def answer_units(units: DataFrame) -> DataFrame:
    """For each block's unit that another block has too, the least doc_id of all."""
    every = units.groupBy("unit").agg(F.min("source").alias("least"), F.count("*").alias("n")).filter("n > 1")
    met = units.join(every, "unit").filter("least < source")
    return met.select("block", F.lit(3).alias("kind"), F.lit(0).alias("range"), F.col("unit").alias("data"), F.col("least").alias("source"))


def covered(block: Block, first: np.ndarray, last: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """For each word, whether a removed unit covers it."""
    step = np.zeros(len(block.starts) + 1, np.int64)
    np.add.at(step, first[gone], 1)
    np.add.at(step, last[gone] + block.window, -1)
    return np.cumsum(step[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (start, end) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"


def cut(blocks: DataFrame, answers: DataFrame, window: int, bits: int) -> DataFrame:
    """The result for each document of the blocks."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", span), ("kept_text", pa.string())])

    def run(key, table, own):
        block, first, last, digests = _units(table, own, window, bits)
        source = {d: s for k, d, s in zip(*(own.column(c).to_pylist() for c in ("kind", "data", "source")), strict=True) if k == 3}
        doc = block.ids[block.doc[first]].tolist()
        for d, i in zip(digests, doc, strict=True):
            source[d] = min(i, source.get(d, i))
        gone = np.array([source[d] < i for d, i in zip(digests, doc, strict=True)], bool)
        mask = covered(block, first, last, gone)
        rows = []
        for i, text in enumerate(block.texts):
            a, b = int(block.first[i]), int(block.last[i])
            own_mask = mask[a:b]
            low, high = runs(own_mask)
            if len(low):
                x, y = runs(~own_mask)
                text = b" ".join(block.buffer[block.starts[a + s] : block.ends[a + e - 1]] for s, e in zip(x.tolist(), y.tolist(), strict=True))
            spans = [{"start": s, "end": e} for s, e in zip(low.tolist(), high.tolist(), strict=True)]
            rows.append({"doc_id": int(block.ids[i]), "n_words": b - a, "n_removed": int(own_mask.sum()), "spans": spans, "kept_text": text.decode()})
        return pa.Table.from_pylist(rows, kind)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, RESULT)


def _whole(documents: DataFrame) -> DataFrame:
    """The result of rows that keep all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [(t.as_py() or "").encode().split() for t in b.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_words": pa.array([len(w) for w in words], pa.int64()), "kept_text": pa.array([b" ".join(w).decode() for w in words], pa.string())})

    out = documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, kept_text string")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return out.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), none.alias("spans"), "kept_text")


def deduplicate(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text) of every row (doc_id, text).

    ``spans`` are the removed word ranges (end exclusive); ``kept_text`` has the other words, joined by one space.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = documents.filter("doc_id is not null")
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(chars / BLOCK_CHARS))
    bits = max(0, math.ceil(math.log2(max(1, chars / 6 / RANGE_EDGES))))
    blocks = blocks_of(named, n_blocks)
    repeats = stored(answer_edges(send_edges(blocks, window, bits)), "substring-edges")
    breaks = stored(answer_nodes(send_nodes(blocks, repeats, window, bits)), "substring-nodes")
    answers = repeats.unionByName(breaks)
    units = stored(send_units(blocks, answers, window, bits), "substring-units")
    sources = stored(answer_units(units), "substring-sources")
    return cut(blocks, answers.unionByName(sources), window, bits).unionByName(_whole(documents.filter("doc_id is null")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document."""
    out = deduplicate(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT r, i, doc_id > min(doc_id) OVER (PARTITION BY g) AS gone FROM g),
x AS (SELECT r, list(DISTINCT i + k) AS p FROM m, (SELECT unnest(range(0, 13)) AS k) WHERE gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda v, i: p IS NULL OR NOT list_contains(p, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""
