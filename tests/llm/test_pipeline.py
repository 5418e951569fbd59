import re

import corpus_pipeline
from test_decontam import words as item_words
from test_mixing import slow_targets
from test_quality import slow_repeat
from test_simhash import slow_components, slow_fingerprint

from vistaloom.llm import secrets


def slow_keeps(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars, upper = sum(map(len, w)), sum(c.isupper() for c in t)
    return not (
        len(w) < 50
        or 100 * slow_repeat(t) > 50 * len(w)
        or 10 * len(re.findall(r"[#*$%&|<>]", t)) > len(w)
        or not 2 * len(w) <= chars <= 14 * len(w)
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or 10 * upper > 4 * chars
        or 10 * t.count("!") > 3 * len(w)
        or 10 * sum(bool(re.match(r"\s*[-*•‣·]", x)) for x in lines) > 9 * len(lines)
        or 10 * sum(bool(re.search(r"(\.\.\.|…)\s*$", x)) for x in lines) > 3 * len(lines)
    )


def slow_hits(items, text):
    w, hit, whole = item_words(text), set(), False
    for v in items:
        n = min(13, len(v))
        grams = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)} if n else set()
        for s in range(len(w) - n + 1):
            if tuple(w[s : s + n]) in grams:
                hit |= set(range(s, s + n))
                whole |= n == 13
    return whole or bool(hit) and 20 * len(hit) >= len(w)


def redacted(text):
    out, at, end = "", 0, -1
    for a, k, b in secrets.spans(text):
        if a >= end:
            out += text[at:a] + f"<{secrets.KINDS[k]}>"
        at = end = max(end, b)
    return out + text[at:]


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    items = [item_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {i: r.text for i, r in rows.items() if slow_keeps(r.text)}
    kept = [want]
    ids = sorted(want)
    label = slow_components([slow_fingerprint(want[i]) for i in ids])
    kept.append({ids[c]: want[ids[c]] for c in set(label)})
    kept.append({i: t for i, t in kept[-1].items() if not slow_hits(items, t)})
    kept.append({i: redacted(t) for i, t in kept[-1].items()})
    assert len(kept[0]) > len(kept[1]) > len(kept[2]) > 20
    for (name, stage), expect in zip(corpus_pipeline.STAGES, kept, strict=False):
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id: r.text for r in docs.collect()} == expect, name
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in kept[-1].items()}
    total, taken = {}, {}
    for i, n in size.items():
        total[rows[i].source] = total.get(rows[i].source, 0) + n
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect():
        assert r.text == kept[-1][r.doc_id] and 0 < r.taken <= 2 * size[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in slow_targets(total).items():
        assert abs(taken.get(s, 0) - t) <= 3 + 0.01 * t


def test_pipeline_on_odd_rows(spark, make, tmp_path):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"word{i} and" for i in range(60))
    rows = [(1, None, None, None, None), (None, good, "en", None, 3), (2, good, "en", None, 3), (2, good, "en", None, 3), (3, "", "x", "y", 0)]
    make(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    make([(None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in got] == [2]


def test_pipeline_on_empty_tables(spark, make, tmp_path):
    make([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    make([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "taken"] and got.count() == 0


def test_pipeline_with_columns_that_clash(spark, make, tmp_path):
    names = ["taken", "_size", "_d", "_s", "_n", "_h", "_row", "size", "target", "text_hash", "fp", "root", "term", "pos", "whole", "spans"]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    text = lambda k: " ".join(f"w{k}x{i} and" for i in range(60))
    rows = [((1 << 60) + k if k % 3 else None, text(k), "en", ["a", None][k % 2], 3, *range(len(names))) for k in range(8)]
    make(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    make([(1, "some item words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(got.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", *names])
    by = {r.text: r for r in got.collect()}
    for r in rows:
        if r[1] in by:
            assert by[r[1]].doc_id == r[0] and by[r[1]].source == r[3] and by[r[1]].whole == names.index("whole")
    assert len(by) >= 6 and all(0 < r.taken <= 240 for r in by.values())
