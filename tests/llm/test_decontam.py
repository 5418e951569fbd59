import hashlib
import re

from vistaloom.llm import decontam

LONG = " ".join(f"t{i}" for i in range(20))
ITEMS = [
    (1, LONG),
    (2, "Short Item here"),
    (10, "the the the the the the the the the the the the the the"),
    (3, None),
    (4, " .,- "),
    (5, LONG.upper()),
    (6, "É é x"),
    (7, "unseen word"),
]
TEXTS = [
    None,
    "",
    "x " + LONG + " y " + " ".join(f"t{i}" for i in range(5, 20)),
    " ".join(f"T{i}" for i in range(3, 16)),
    "a b t0 t1 t2 t3 t4 t5 t6 t7 t8 t9 t10 t11",
    "short, item... HERE short item x",
    "the " * 40,
    "the " * 12 + "é x É é x",
    "filler " * 400 + LONG,
    ("the end " + LONG + " ") * 200,
    "filler " * 900 + LONG + " more" * 900,
    "filler " * 900 + "short item here" + " more" * 900,
]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def slow(text):
    w, hit, found, whole = words(text), set(), set(), False
    for i, t in ITEMS:
        v = words(t)
        n = min(13, len(v))
        grams = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)} if n else set()
        for s in range(len(w) - n + 1):
            if tuple(w[s : s + n]) in grams:
                hit |= set(range(s, s + n))
                found.add(str(i))
                whole |= n == 13
    row = len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)
    return row, whole


def test_equals_plain_search(make, spark, tmp_path):
    rows = [(i, t, "e") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "e"), (None, TEXTS[3], "e"), (3, "other", "e")]
    make(rows, "doc_id long, text string, term string").write.parquet(f"{tmp_path}/documents.parquet")
    make(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontam.query(spark, str(tmp_path)).collect()
    assert sorted(map(repr, (tuple(r)[1:] for r in got))) == sorted(repr(slow(t)[0]) for _, t, _ in rows)
    assert {r.doc_id: tuple(r)[1:] for r in got}[2] == slow(TEXTS[2])[0]
    docs = make(rows, "doc_id long, text string, term string")
    kept = decontam.clean(docs, make(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.text for r in kept.collect()))) == sorted(repr(t) for _, t, _ in rows if not slow(t)[0][4] and not slow(t)[1])
    # a window in a long text goes, a short item in a long text stays
    assert not slow(TEXTS[10])[0][4] and slow(TEXTS[10])[1] and slow(TEXTS[11])[0][1] and not slow(TEXTS[11])[0][4]
    assert TEXTS[10] not in {r.text for r in kept.collect()} and TEXTS[11] in {r.text for r in kept.collect()}


def test_empty_tables(make):
    ddl = "doc_id long, text string"
    items = "item_id long, text string"
    assert decontam.decontaminate(make([], ddl), make(ITEMS, items)).count() == 0
    (r,) = decontam.decontaminate(make([(1, "a b")], ddl), make([], items)).collect()
    assert (r.n_words, r.n_hit, r.contaminated) == (2, 0, False)


def test_proximity(make):
    items, vocabulary = decontam.windows(make([(1, "alpha beta")], "item_id long, text string"))
    index = decontam.build_index(make([(1, "alpha x x beta x x x x alpha")], "doc_id long, text string"), vocabulary)
    got = decontam.proximity(index, vocabulary, "alpha", "beta", 3).collect()
    assert [(r.pos, r.other) for r in got] == [(0, 3)]
