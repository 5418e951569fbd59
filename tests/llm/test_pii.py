import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from vistaloom.llm import pii

P = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    return sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(s[::-1])) % 10 == 0


def slow_base(text):
    out = []
    for rank, (kind, p) in enumerate(P.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(len(x.lstrip('0')) < 4 and int(x) <= 255 for x in m[0].split('.')),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


TEXTS = [
    None,
    "",
    "a@b.c",
    "é mail me: x.y+z@mail-3.example.com, or a@b.c_d@e.f now",
    "@a.b a@ b@c b@c. b@c.d..e",
    "10.0.0.255 1.2.3.256 1.2.3.4.5.6.7.8 0001.02.3.4 99999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111x 4111111111111112 12  34",
    "+1 (017) 555-7713 +49 30 1234567890 +1 +123456789012345678 ++12345 67890)",
    "call 555-123-4567 or (212) 555-0199 now",
    "5" * 50000 + "." + "1.1.1 " + "x" * 50000 + "@" + "y.z" * 3000,
    "4111 1111 1111 1111 " * 3000,
    "card: 4111 1111 1111 1111, or 4111111111111112 or 1 or 4111-1111-1111-1111x",
]


def test_base_spans_equal_plain_patterns(spark, make, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a@b.c", "y"), (None, "a@b.c", "y"), (2, "other +1 (017) 555-7713", "z")]
    make(rows, "doc_id long, text string, kind string").write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = sorted((-1 if i is None else i, hashlib.sha256(slow_base(t).encode()).hexdigest()) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.base_sha256) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[6].n_card == 0 and by[11].n_card == 2 and by[0].spans == ""
    assert "tel:5:17" in by[8].spans


def test_reliable_labelers_get_weight():
    patterns = [("tel", True, (1, 2, 1, 1), 900), ("tel", False, (0, 2, 0, 0), 100), ("tel", True, (1, 2, 0, 0), 5)]
    share, rel = pii.reliabilities(patterns)
    assert pii.posterior(share, rel, "tel", True, (1, 2, 1, 1)) > 0.9 > 0.2 > pii.posterior(share, rel, "tel", False, (0, 2, 0, 0))


def drawn_patterns(reliable, n=4000, seed=1):
    """Votes of four labelers over base and loose candidates; labeler j is right with probability ``reliable[j]``."""
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(n):
        truth = rng.random() < 0.6
        votes = tuple(int(truth) if rng.random() < r else 1 - int(truth) for r in reliable)
        kind = rng.choice(["card", "tel", "ssn"])
        counts[kind, truth if kind == "card" else votes[0] == 1, votes] += 1
    return [(k, ok, v, c) for (k, ok, v), c in sorted(counts.items())]


def test_a_bad_labeler_loses_weight_on_data():
    def gain(rel, j):  # what a vote for personal data adds to the log odds
        return math.log(rel[j][1][0] / rel[j][1][1])

    for bad in range(4):
        reliable = [0.9] * 4
        reliable[bad] = 0.5
        _, rel = pii.reliabilities(drawn_patterns(reliable))
        assert abs(gain(rel, bad)) < 0.3, (bad, gain(rel, bad))
        assert all(gain(rel, j) > 1.5 for j in range(4) if j != bad)
        # reliabilities are near those that the data was drawn with
        for j, r in enumerate(reliable):
            assert abs(rel[j][1][0] - r) < 0.05 and abs(rel[j][0][1] - r) < 0.05


def test_iban_check(make):
    rows = [("DE89 3704 0044 0532 0130 00", 1), ("GB82 WEST 1234 5698 7654 32", 1), ("GB82 WEST 1234 5698 7654 33", 0), ("FR1420041010050500013M02606", 1), ("DE89370400440532013001", 0)]
    got = make([(m, "iban", v) for m, v in rows], "m string, kind string, v int").select(pii.shaped(F.col("kind"), F.col("m")).cast("int").alias("g"), "v").collect()
    assert all(r.g == r.v for r in got)


def test_loose_spans_overlap_nothing(make):
    spans = [(1, 7, "ssn", 0, 11), (1, 7, "tel", 4, 16), (1, 7, "iban", 12, 30), (1, 7, "card", 28, 40), (1, 7, "tel", 50, 60), (1, 7, "mail", 50, 62), (2, 7, "tel", 4, 16)]
    rows = make([(*s, True, 0.9) for s in spans], "doc_id long, text_hash long, kind string, start long, end long, ok boolean, p double")
    got = sorted((r.doc_id, r.kind, r.start, r.end) for r in pii.accepted(rows).collect())
    # the IBAN meets a card, the first number wins over the second, and of two that start together the earlier kind
    assert got == [(1, "card", 28, 40), (1, "ssn", 0, 11), (1, "tel", 50, 60), (2, "tel", 4, 16)]


def test_recall_and_precision_of_loose_spans(spark, make, tmp_path):
    """Planted numbers with and without a word that gives them away, among numbers that look like them."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    digits = lambda n: "".join(str(rng.randint(0, 9)) for _ in range(n))

    def iban(right):
        bban = digits(18)
        check = 98 - int(bban + "131400") % 97
        return f"DE{check if right else (check + 11) % 90 + 7:02d}{bban}"

    def planted(kind):
        return {
            "tel": (f"call {rng.randint(2, 9)}{digits(2)}-{digits(3)}-{digits(4)}", 5),
            "ssn": (f"social security number {rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", 23),
            "iban": (f"account {iban(True)}", 8),
            "mail": (f"contact {word()} [at] {word()} [dot] com", 8),
        }[kind]

    texts, want = [], []
    for i in range(800):
        lead = " ".join(word() for _ in range(rng.randint(1, 30))) + " "
        kind = rng.choice(["tel", "ssn", "iban", "mail", "none", "bad"])
        if kind == "none":
            texts.append(lead + "mail a@b.com or 10.0.0.1 or +1 212 555 0123 4")
            want.append(None)
        elif kind == "bad":
            texts.append(lead + rng.choice([f"invoice {rng.randint(0, 1)}{digits(2)}-{digits(3)}-{digits(4)}", f"order {iban(False)}", f"version 000-{rng.randint(10, 99)}-{digits(4)}"]))
            want.append("")
        else:
            body, at = planted(kind)
            texts.append(lead + body)
            want.append(f"{kind}:{len(lead) + at}:{len(lead) + len(body)}")
    make(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spans for r in pii.query(spark, str(tmp_path)).collect()}
    found = sum(w in got[i].split(",") for i, w in enumerate(want) if w)
    false = sum(bool(got[i]) for i, w in enumerate(want) if w == "")
    assert found >= 0.95 * sum(bool(w) for w in want) and false <= 0.1 * want.count("")


def test_empty(spark, make, tmp_path):
    make([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert pii.query(spark, str(tmp_path)).count() == 0
