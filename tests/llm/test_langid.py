import zlib

import numpy as np

from vistaloom.llm import langid


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = langid.Network.new(["a", "b", "c"], hidden=3)
    net.weights = {n: v.astype(np.float64) for n, v in net.weights.items()}
    x, y = rng.integers(97, 105, (4, 6)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, g = net.gradients(x, y)
    for name, w in net.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape) if name[0] != "x" else (int(x[0, 2]), int(rng.integers(0, 9)))
            keep, e = w[at], 1e-4
            w[at] = keep + e
            up = net.gradients(x, y)[0]
            w[at] = keep - e
            down = net.gradients(x, y)[0]
            w[at] = keep
            assert abs((up - down) / (2 * e) - g[name][at]) < 2e-4, (name, at)


def test_pooling_covers_whole_texts():
    net = langid.Network.new(["a", "b"])
    parts = [b"abc " * 100, b"", b"x", b"zzz yyy " * 4000]
    got = net.pooled(parts)
    for text, row in zip(parts, got, strict=True):
        total, n = np.zeros(2), 0
        for at in range(0, len(text), langid.PIECE):
            piece = np.frombuffer(text[at : at + langid.PIECE].ljust(langid.PIECE), np.uint8)[None]
            for t, p in net.label(piece):
                c = langid.COUNTS[piece[0, t]]
                total, n = total + p[0] * c, n + c
        assert np.allclose(row, total / max(n, 1), atol=1e-4)


def test_held_out_accuracy(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in langid.query(spark, folder).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(want)
    held = [i for i in want if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in want)
    assert np.mean([got[i].lang_pred == want[i] for i in held]) >= 0.95


def test_defined_cases(make):
    ddl = "doc_id long, text string, lang string"
    rows = [(1, None, "en"), (2, "12 34 !", "en"), (None, "abc", "en"), (2, "12 34 !", None)]
    docs = make(rows, ddl)
    got = langid.predict(docs, langid.fit(docs, updates=2)).collect()
    assert len(got) == 4 and all(r.lang_pred == "und" and r.score == 0 for r in got)
    assert langid.fit(make([], ddl)) is None
    assert langid.predict(make([], ddl), None).count() == 0
    # columns of other names, and one word of a million letters beside short texts
    rows = [(k, t, "a" if k % 2 else "b", "x", 1, "y") for k, t in enumerate(["der die das und", "the and of to"] * 20 + ["x" * 1_000_000, "é"])]
    docs = make(rows, ddl + ", key string, rank int, part string")
    got = langid.predict(docs, langid.fit(docs, updates=30)).collect()
    assert len(got) == 42 and all(r.lang_pred in "ab" and 0 < r.score <= 1 for r in got)


def test_the_sample_is_bounded(make, monkeypatch):
    monkeypatch.setattr(langid, "MOST_WINDOWS", 12)
    docs = make([(k, f"text number {k}", f"l{k % 6}") for k in range(200)], "doc_id long, text string, lang string")
    rows = langid.sample(docs)
    assert len(rows) <= 12 and len({lang for lang, _ in rows}) == 6
