import random
import re

import numpy as np
import xxhash

from vistaloom.llm import simhash


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def texts(seed=3):
    rng = random.Random(seed)
    out = [None, "", " \n", "One", "one two three", "a\x0bB c d É é", "x " * 5000]
    for _ in range(30):
        words = [rng.choice("abcdefghij") * rng.randint(1, 5) + rng.choice("ÀÉxyz") for _ in range(rng.randint(5, 300))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 6)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "new"
            out.append(" ".join(copy))
    return out


def slow_components(fps):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_fingerprints_by_hand():
    for t in texts():
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_components_by_hand(make):
    ts = texts()
    rows = [(i, t, 1) for i, t in enumerate(ts)]
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.grouped(make(rows, "doc_id long, text string, fp int")).collect()}
    fps = [slow_fingerprint(t) for t in ts]
    assert got == {i: (f, c) for i, (f, c) in enumerate(zip(fps, slow_components(fps), strict=True))}
    kept = simhash.deduplicate(make(rows, "doc_id long, text string, fp int"))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(slow_components(fps)))


def test_small_tiles_find_the_same_links(make):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63, 200, dtype=np.int64)
    near = [int(x) ^ (1 << int(k)) for x in base[:100] for k in rng.integers(0, 62, 4)]
    fps = sorted({*base.tolist(), *near})
    from vistaloom.llm.components import components

    got = {r.node: r.root for r in components(simhash.links(make([(x,) for x in fps], "fp long"), size=16)).collect()}
    label = slow_components([x % (1 << 64) for x in fps])
    want = {x: fps[c] for x, c in zip(fps, label, strict=True) if label.count(c) > 1}
    assert got == want


def test_nulls_ties_and_empty(make):
    ddl = "doc_id long, text string"
    rows = [(None, "a b"), (5, "a b"), (5, "a b"), (None, "only"), (9, None)]
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.grouped(make(rows, ddl)).collect())
    assert got == sorted([("None", "5"), ("5", "5"), ("5", "5"), ("None", "None"), ("9", "9")])
    assert simhash.grouped(make([], ddl)).count() == 0


def test_deduplicate_goes_by_row(make):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (None, a), (None, b), (None, b), (2, c), (2, a), (3, c)]
    got = simhash.deduplicate(make(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, a), (None, b), (2, c)]))
    rows = [(3, b), (5, a), (5, b), (7, c), (7, c)]
    got = simhash.deduplicate(make(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted([(3, b), (5, a), (7, c)])
    rows = [(7, c, "y"), (7, c, "x"), (7, c, None), (None, None, "z"), (None, "", "z")]
    got = simhash.deduplicate(make(rows, "doc_id long, text string, _h string")).collect()
    assert len(got) == 2 and {r.text for r in got} in ({c, None}, {c, ""})
    assert simhash.deduplicate(make([], "doc_id long, text string")).count() == 0
