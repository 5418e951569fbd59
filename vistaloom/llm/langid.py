"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on the driver,
from a bounded sample of labelled rows: at most ``PER_LANGUAGE`` (and ``MOST_WINDOWS`` in all) windows of
``WINDOW`` characters of each language, drawn by a hash of doc_id. It labels every byte position of a
whole lower-cased text; a document's probabilities are the mean over the positions of
letters. Texts are cut into pieces of ``PIECE`` bytes that run side by side, so
a batch has bounded memory whatever the length of its texts.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is
everything where no row is labelled; rows with a null doc_id count as held out;
repeated rows each get a result; an empty table gives an empty one. Only ``text`` is
an input of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaloom.llm.common import read, small_batches

FOLDS = 5
PER_LANGUAGE = 800
#: Languages that are learned at most, the most frequent ones, and windows of all of them: they bound what the driver and a broadcast hold (13 MB of text).
MOST_LANGUAGES = 1000
MOST_WINDOWS = 50_000
WINDOW = 256
HIDDEN = 8
PIECE = 128
BATCH = 4096
UPDATES = 500
TRAIN_BATCH = 128
#: Lengths of the pieces that updates take in turn; short ones teach short texts.
TRAIN_STEPS = (80, 32, 12)
RATE = 0.02
SEED = 11
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Positions that count: bytes of letters, which are a to z and everything beyond ASCII.
COUNTS = np.array([97 <= b <= 122 or b >= 128 for b in range(256)], np.float32)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray, k: int) -> tuple:
    """One step of a gated recurrent unit from the input's part ``x`` and the state ``h``: (state, z and r, n, what r gates)."""
    a = h @ u
    zr = _sigmoid(x[:, : 2 * k] + a[:, : 2 * k])
    n = np.tanh(x[:, 2 * k :] + zr[:, k:] * a[:, 2 * k :])
    return n + zr[:, :k] * (h - n), zr, n, a[:, 2 * k :]


@dataclass
class Network:
    """Weights by name: ``xf``/``xb`` (bytes to gates), ``uf``/``ub`` (state to gates), ``v``, ``c`` (states to languages)."""

    languages: list[str]
    weights: dict[str, np.ndarray]
    hidden: int = HIDDEN

    @classmethod
    def new(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        make = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        k, m = hidden, len(languages)
        w = {"xf": make(256, 3 * k), "xb": make(256, 3 * k), "uf": make(k, 3 * k), "ub": make(k, 3 * k), "v": make(2 * k, m), "c": np.zeros(m, np.float32)}
        return cls(languages, w, hidden)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for pieces ``x`` (batch, steps) of languages ``y``, by backpropagation through time."""
        w, k = self.weights, self.hidden
        size, steps = x.shape
        runs = {}
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            h = np.zeros((size, k), np.float32)
            run = {}
            for t in order:
                before = h
                h, zr, n, a = _step(w["x" + d][x[:, t]], h, w["u" + d], k)
                run[t] = (before, h, zr, n, a)
            runs[d] = run
        states = np.stack([np.concatenate([runs["f"][t][1], runs["b"][t][1]], 1) for t in range(steps)])
        logits = states @ w["v"] + w["c"]
        p = np.exp(logits - logits.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        rows = np.arange(size)
        loss = float(-np.log(p[:, rows, y] + 1e-9).mean())
        out = p.copy()
        out[:, rows, y] -= 1
        out /= size * steps
        g = {name: np.zeros_like(v) for name, v in w.items()}
        g["v"] = np.einsum("tbi,tbj->ij", states, out)
        g["c"] = out.sum((0, 1))
        back = out @ w["v"].T
        for d, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
            part = slice(0, k) if d == "f" else slice(k, 2 * k)
            dh = np.zeros((size, k), np.float32)
            for t in order:
                before, _, zr, n, a = runs[d][t]
                z, r = zr[:, :k], zr[:, k:]
                dh = dh + back[t][:, part]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (before - n) * z * (1 - z)
                dr = dn * a * r * (1 - r)
                gates = np.concatenate([dz, dr, dn], 1)
                inner = np.concatenate([dz, dr, dn * r], 1)
                np.add.at(g["x" + d], x[:, t], gates)
                g["u" + d] += before.T @ inner
                dh = dh * z + inner @ w["u" + d].T
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, updates: int = UPDATES, seed: int = SEED) -> Network:
        """Adam over random batches that hold every language alike, of long and short pieces in turn."""
        rng = np.random.default_rng(seed)
        first = {n: np.zeros_like(v) for n, v in self.weights.items()}
        second = {n: np.zeros_like(v) for n, v in self.weights.items()}
        groups = [np.flatnonzero(y == i) for i in range(len(self.languages))]
        for i in range(1, updates + 1):
            steps = min(TRAIN_STEPS[i % len(TRAIN_STEPS)], x.shape[1])
            pick = np.array([rng.choice(groups[j % len(groups)]) for j in range(TRAIN_BATCH)])
            at = rng.integers(0, x.shape[1] - steps + 1)
            _, g = self.gradients(x[pick, at : at + steps], y[pick])
            norm = float(np.sqrt(sum((v * v).sum() for v in g.values())))
            rate = RATE * (1 - 0.9 * i / updates)
            for n, v in g.items():
                v = v / max(1.0, norm)
                first[n] = 0.9 * first[n] + 0.1 * v
                second[n] = 0.99 * second[n] + 0.01 * v * v
                self.weights[n] -= (rate * first[n] / (1 - 0.9**i) / (np.sqrt(second[n] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pieces: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(step, probabilities of each piece's byte at that step) for pieces (batch, steps), last step first."""
        w, k = self.weights, self.hidden
        size, steps = pieces.shape
        columns = np.ascontiguousarray(pieces.T)
        forward = np.empty((steps, size, k), np.float32)
        h = np.zeros((size, k), np.float32)
        for t in range(steps):
            h = _step(w["xf"][columns[t]], h, w["uf"], k)[0]
            forward[t] = h
        h = np.zeros((size, k), np.float32)
        for t in range(steps - 1, -1, -1):
            h = _step(w["xb"][columns[t]], h, w["ub"], k)[0]
            logits = forward[t] @ w["v"][:k] + h @ w["v"][k:] + w["c"]
            p = np.exp(logits - logits.max(1, keepdims=True))
            yield t, p / p.sum(1, keepdims=True)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """For each text, the mean probabilities over its letters' positions (zero without any)."""
        total = np.zeros((len(texts), len(self.languages)))
        counted = np.zeros(len(texts))
        buffer, owner, filled = np.full((BATCH, PIECE), 32, np.uint8), np.zeros(BATCH, np.int64), 0

        def run(n: int) -> None:
            x, own = buffer[:n], owner[:n]
            sums = np.zeros((n, len(self.languages)), np.float32)
            for t, p in self.label(x):
                sums += p * COUNTS[x[:, t]][:, None]
            np.add.at(total, own, sums)
            np.add.at(counted, own, COUNTS[x].sum(1))

        for i, text in enumerate(texts):
            raw = np.frombuffer(text, np.uint8)
            for at in range(0, len(raw), PIECE):
                piece = raw[at : at + PIECE]
                buffer[filled, : len(piece)] = piece
                buffer[filled, len(piece) :] = 32
                owner[filled] = i
                filled += 1
                if filled == BATCH:
                    run(BATCH)
                    filled = 0
        if filled:
            run(filled)
        return total / np.maximum(counted, 1)[:, None]


def sample(documents: DataFrame, per_language: int = PER_LANGUAGE, window: int = WINDOW) -> list[tuple[str, str]]:
    """(lang, window of text) of the training folds: at most ``per_language`` rows of each language, by a hash of doc_id.

    Languages are counted first, and a hash then lets, before any shuffle, through about four times as
    many rows as are wanted, so the ranking sees few rows whatever the input.
    """
    rows = documents.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    per_language = max(1, min(per_language, MOST_WINDOWS // max(1, counts.count())))
    counts = counts.select("lang", F.least(F.lit(1.0), F.lit(4.0 * per_language) / F.col("n")).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    rows = rows.join(F.broadcast(counts), "lang").filter((draw < F.col("rate")) & F.col("text").isNotNull())
    key = F.xxhash64(F.lit(SEED), "doc_id", "text")
    at = F.pmod(key, F.greatest(F.lit(1), F.length("text") - window + 1)).cast("int") + 1
    rows = rows.select("lang", key.alias("key"), F.substring("text", at, F.lit(window)).alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "part"))
    rows = rows.withColumn("rank", rank).filter(F.col("rank") <= per_language)
    return [(r.lang, r.part) for r in rows.orderBy("lang", "rank").collect()]


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, updates: int = UPDATES) -> Network | None:
    """The network trained on a bounded sample of (doc_id, text, lang); None if no row has a language."""
    rows = [(lang, part.lower().encode()) for lang, part in sample(documents, per_language) if LETTER.search(part)]
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    x = np.full((len(rows), WINDOW), 32, np.uint8)
    for i, (_, part) in enumerate(rows):
        # short texts are repeated, so that every position has something to learn from
        raw = (part + b" ") * (WINDOW // (len(part) + 1) + 1)
        x[i] = np.frombuffer(raw[:WINDOW], np.uint8)
    y = np.array([languages.index(lang) for lang, _ in rows])
    return Network.new(languages).train(x, y, updates)


def predict(documents: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row (doc_id, text)."""
    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(1)]
            known = [network is not None and bool(LETTER.search(t)) for t in texts]
            names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            at = [i for i, k in enumerate(known) if k]
            if at:
                p = network.pooled([texts[i].lower().encode() for i in at])
                names[at] = np.array(network.languages, object)[p.argmax(1)]
                score[at] = np.clip(p.max(1), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predict(documents, fit(documents))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
