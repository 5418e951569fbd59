from collections import Counter

import pytest
from pyspark.sql import functions as F

from vistaloom.llm import quality

TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "a b c",
    "a b c a b c",
    "a b a b a b a",
    "x y z w x y z\nx y z w x y z\n\n",
    "# $ é b \x0b q",
    " ".join(f"w{i % 97}" for i in range(30000)),
]


def slow_repeat(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    c = Counter(zip(w, w[1:], w[2:]))
    return len({i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for k in range(3)})


def test_repeat_words_as_by_hand(make):
    rows = make([(i, t) for i, t in enumerate(TEXTS)] + [(3, "one")], "doc_id long, text string")
    got = quality.ledger(rows).select("doc_id", f"{quality.LEDGER}.n_repeat_words").collect()
    assert len(got) == len(TEXTS) + 1
    assert {r[0]: r[1] for r in got} == {i: slow_repeat(t) for i, t in enumerate(TEXTS)}


def test_policies_and_ablation(make):
    clean = "\n".join(" ".join(f"Word{i}x{j} and" for i in range(12)) for j in range(6))
    rows = make(
        [(1, clean, "a"), (2, clean.upper(), "b"), (3, "short", None), (4, None, None), (5, "spam ham " * 60, "c")],
        "doc_id long, text string, n_words string",
    )
    led = quality.ledger(rows)
    assert [r.doc_id for r in quality.keep(rows).collect()] == [1]
    assert quality.keep(rows).columns == rows.columns
    assert sorted(r.doc_id for r in led.filter(quality.passes("base")).collect()) == [1, 2]
    got = {(r.policy, r.rule): (r.n_failed, r.n_only) for r in quality.ablation(led).collect()}
    assert got["v2", "few_words"] == (2, 2) and got["v2", "capitals"] == (1, 1) and got["base", "repeated_trigrams"] == (1, 1)


def test_empty_table(make):
    assert quality.keep(make([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("policy", quality.POLICIES)
def test_masks_hold_known_bits(policy):
    assert quality.mask(policy) < 1 << len(quality.RULES)
