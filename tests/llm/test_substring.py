import random
import re

import numpy as np
import pytest

from vistaloom.llm import substring


def slow(rows, window=13):
    """(doc_id, n_words, n_removed, kept) of each row by plain dictionaries."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        if i is not None:
            for s in range(len(w) - window + 1):
                g = tuple(w[s : s + window])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, w in split:
        gone = {s + k for s in range(len(w) - window + 1) if i is not None and least[tuple(w[s : s + window])] < i for k in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "é", "x" * rng.randint(1, 9), str(rng.randint(0, 60)), "İ", "\xa0"])
    base = [[word() for _ in range(rng.randint(0, 120))] for _ in range(25)]
    rows = [(None, " ".join(base[3])), (None, None), (7, None), (8, ""), (9, " \t\n\x0b")]
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            b = list(rng.choice(base))
            if rng.random() < 0.4 and b:
                b[rng.randrange(len(b))] = "edit"
            a = rng.randint(0, len(b))
            parts += b[a : a + rng.randint(0, 60)] + [word() for _ in range(rng.randint(0, 5))]
        rows.append((rng.randint(0, 10**6) * rng.choice([1, -1]), rng.choice([" ", "\n", "  "]).join(parts)))
    rows += rows[-10:]
    rows += [(10**7 + i, rows[20][1]) for i in range(40)] + [(5 * 10**7, "loop " * 3000), (6 * 10**7, "loop " * 200)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_dictionaries(make, seed, monkeypatch):
    if seed == 2:  # many ranges
        monkeypatch.setattr(substring, "RANGE_EDGES", 40)
    rows = corpus(seed)
    table = make([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.deduplicate(table).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, slow(rows)))


def test_spans_name_what_is_removed(make):
    text = " ".join(f"w{i}" for i in range(40))
    out = substring.deduplicate(make([(1, text), (2, "a b " + text + " c")], "doc_id long, text string"))
    got = {r.doc_id: r for r in out.collect()}
    assert [tuple(s) for s in got[2].spans] == [(2, 42)] and got[2].kept_text == "a b c" and not got[1].spans


def test_empty(make):
    assert substring.deduplicate(make([], "doc_id long, text string")).count() == 0


def test_packing_is_exact():
    v = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    s = substring.short(v, 3)
    for _, a, b in substring.ranges(v, 3):
        assert (substring.unpack(substring.pack(s[a:b])) == s[a:b]).all() and (np.diff(s[a:b].astype(np.int64)) >= 0).all()


def test_words_longer_than_a_step(monkeypatch):
    monkeypatch.setattr(substring, "STEP", 64)
    substring._POWERS.clear()
    words = ["a" * 300, "b", "cd" * 20, "e" * 64, "b", "a" * 300]
    buffer = np.frombuffer((" ".join(words) + " ").encode(), np.uint8)
    ends = np.flatnonzero(buffer == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    h = substring.word_hashes(buffer, starts, ends)
    substring._POWERS.clear()
    assert h[0] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 4
