"""Personal data by weak supervision (native expressions only).

Candidates are the spans of strict base patterns (e-mail, IPv4 address, card,
international phone) and of looser ones (national phone, spelled-out e-mail,
IBAN, social security number). Four labelers vote on each candidate: format
(checksums, ranges and shapes), gazetteer (known domains, prefixes, country codes),
context (trigger words to the left) and boundary (what touches the span).
Expectation-maximisation over the counts of vote patterns estimates each
labeler's reliability. Base candidates, personal if they pass their pattern's own check,
anchor the two classes; since that check and the format labeler look at the same thing, the
format labeler is estimated against what the other labelers say instead. The posteriors
are the soft labels of the final span
classifier, a naive Bayes model over votes, length and context features, which
decides on the loose spans. Base spans always stay; loose spans overlap neither them nor
each other, the one that starts first (then the earlier kind) winning.

Scale: documents are read twice and never shuffled; what is shuffled are
candidates. The driver sees two tables of bounded size: counts by vote pattern
(at most kinds * 2 * 3**4 rows) and counts by feature (a fixed feature space).
Positions come from gap lengths, so a text with many spans costs in proportion.

Defined results: a null text is empty and has no spans; rows are keyed by
doc_id and a hash of the text, so null and repeated doc_ids each get their
own spans; offsets count code points; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaloom.llm.common import read, stored

BASE = ("email", "ip", "card", "phone")
LOOSE = ("tel", "mail", "iban", "ssn")
KINDS = BASE + LOOSE

#: Leftmost non-overlapping patterns. Possessive loops and ``\G`` (start only where the run of the first
#: class starts, or where the last match ended) find the same spans as the plain patterns without trying a run again.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "tel": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])",
    "mail": r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Labelers' word lists, fixed values.
DOMAINS = r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"
COUNTRIES = r"^(AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"
ISSUERS = r"^(4|5[1-5]|2[2-7]|34|37|6011|65|35)"
TRIGGER = {
    "email": r"(?i)(e-?mail|contact|mailto|write|reach)\W{0,4}(\w+\W+){0,2}$",
    "ip": r"(?i)(ip|host|server|address|from|client)\W{0,4}$",
    "card": r"(?i)(card|visa|mastercard|credit|payment|account)\W{0,4}(\w+\W+){0,2}$",
    "phone": r"(?i)(phone|tel|call|mobile|fax|cell)\W{0,4}(\w+\W+){0,2}$",
    "tel": r"(?i)(phone|tel|call|mobile|fax|cell)\W{0,4}(\w+\W+){0,2}$",
    "mail": r"(?i)(e-?mail|contact|write|reach)\W{0,4}(\w+\W+){0,2}$",
    "iban": r"(?i)(iban|account|bank|transfer)\W{0,4}(\w+\W+){0,2}$",
    "ssn": r"(?i)(ssn|social|security|insurance)\W{0,4}(\w+\W+){0,2}$",
}
AGAINST = r"(?i)(version|release|build|isbn|order|invoice|figure|section|table|page|id|no|nr)\W{0,3}$"
CONTEXT = 40
LABELERS = ("v_format", "v_gazetteer", "v_context", "v_boundary")
FORMAT = 0
ROUNDS = 25
PRIOR = 0.7
ANCHOR = 0.98


def _guard(kind: str, text: Column) -> Column:
    """A cheap necessary condition of the pattern."""
    tests = {
        "email": text.contains("@"),
        "phone": text.contains("+"),
        "mail": text.rlike(r"(?i)[\[(]at[\])]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    }
    return tests.get(kind, text.rlike(PATTERN[kind]))


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    each = F.split(F.reverse(digits), "")
    add = F.transform(
        each,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(add, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, m: Column) -> Column:
    """The format check of a match."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "ip", m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(kind == "card", F.when((n >= 14) & (n <= 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(kind == "phone", (n >= 10) & (n <= 15))
        .when(kind == "ssn", ~m.rlike(r"^(000|666|9)|-00-|-0000$"))
        .when(kind == "tel", ~digits.rlike("^[01]"))
        .otherwise(F.lit(True))
    )


def _mod97(m: Column) -> Column:
    """Whether an IBAN passes its check: the first four characters last, letters as 10 to 35, the number is 1 modulo 97."""
    bare = F.regexp_replace(m, r"[^A-Z0-9]", "")
    turned = F.concat(F.substring(bare, 5, 1 << 20), F.substring(bare, 1, 4))

    def step(a: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + letter) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def shaped(kind: Column, m: Column) -> Column:
    """The format labeler: whether a match looks like its kind beyond its pattern."""
    return (
        F.when(kind == "email", m.rlike(r"^[^.].*[^.@]@.*\.[A-Za-z]{2,24}$"))
        .when(kind == "mail", m.rlike(r"[A-Za-z]{2,24}$"))
        .when(kind == "iban", _mod97(m))
        .otherwise(valid(kind, m))
    )


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def candidates(documents: DataFrame) -> DataFrame:
    """One row for each match of any pattern: (doc_id, text_hash, kind, start, end, m, before, after)."""
    rows = documents.select("doc_id", _key(F.col("text")).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))

    def found(kind: str) -> Column:
        gaps, hits = F.split("text", PATTERN[kind], -1), F.regexp_extract_all("text", F.lit(PATTERN[kind]), F.lit(0))
        # gap i ends where match i starts
        each = F.transform(
            F.arrays_zip(gaps.alias("g"), F.concat(hits, F.array(F.lit(""))).alias("m"), F.concat(F.slice(gaps, F.lit(2), F.size(gaps)), F.array(F.lit(""))).alias("r")),
            lambda x: F.struct(
                F.lit(kind).alias("kind"),
                F.length(x["g"]).alias("gap"),
                x["m"].alias("m"),
                F.substring(x["g"], -CONTEXT, CONTEXT).alias("before"),
                F.substring(x["r"], 1, 8).alias("after"),
            ),
        )
        return F.when(_guard(kind, F.col("text")), each)

    lists = F.filter(F.array(*[found(k) for k in KINDS]), lambda x: x.isNotNull())
    pieces = rows.select("doc_id", "text_hash", F.explode(lists).alias("list")).dropDuplicates(["doc_id", "text_hash", "list"])
    pieces = pieces.select("doc_id", "text_hash", F.posexplode("list").alias("i", "x")).select("doc_id", "text_hash", "i", "x.*")
    sofar = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("m")).over(sofar)
    return (
        pieces.withColumn("end", end)
        .withColumn("start", F.col("end") - F.length("m"))
        .filter(F.col("m") != "")
        .drop("i", "gap")
    )


def voted(rows: DataFrame) -> DataFrame:
    """Candidates with ``ok``, their pattern's own check, and the votes of the labelers: 1 personal, 0 not, 2 abstains."""
    m, kind, before = F.col("m"), F.col("kind"), F.col("before")
    digits = F.regexp_replace(m, "[^0-9]", "")
    trigger = reduce(lambda a, k: a.when(kind == k, before.rlike(TRIGGER[k])), KINDS[1:], F.when(kind == KINDS[0], before.rlike(TRIGGER[KINDS[0]])))
    known = (
        F.when(kind.isin("email", "mail"), m.rlike(DOMAINS))
        .when(kind == "ip", ~m.rlike(r"^0*(0|127|22[4-9]|2[3-5][0-9])\."))
        .when(kind == "card", digits.rlike(ISSUERS))
        .when(kind == "iban", m.rlike(COUNTRIES))
    )
    touched = before.rlike(r"[\p{L}\p{N}]$") | F.col("after").rlike(r"^[\p{L}\p{N}]")
    return (
        rows.withColumn("ok", valid(kind, m))
        .withColumn("v_format", F.when(shaped(kind, m), 1).otherwise(0))
        .withColumn("v_gazetteer", F.when(known, 1).when(~known, 0).otherwise(2))
        .withColumn("v_context", F.when(trigger, 1).when(before.rlike(AGAINST), 0).otherwise(2))
        .withColumn("v_boundary", F.when(touched, 0).otherwise(1))
    )


def reliabilities(patterns: list[tuple], rounds: int = ROUNDS) -> tuple[dict, list]:
    """Dawid-Skene by expectation-maximisation over (kind, ok, votes, count) rows.

    Returns the share of personal data by kind, and for each labeler
    P(vote | personal), P(vote | not), smoothed. The table has at most
    kinds * 2 * 3**labelers rows, whatever the corpus.
    """
    start = {1: (0.7, 0.2), 0: (0.1, 0.6), 2: (0.2, 0.2)}
    share = {k: PRIOR for k, _, _, _ in patterns}
    rel = [dict(start) for _ in LABELERS]
    for _ in range(rounds):
        yes = [posterior(share, rel, k, ok, v) for k, ok, v, _ in patterns]
        unseen = [posterior(share, rel, k, None, v, without=FORMAT) for k, _, v, _ in patterns]
        for k in share:
            own = [(p, n) for p, (kk, _, _, n) in zip(yes, patterns, strict=True) if kk == k]
            share[k] = (sum(p * n for p, n in own) + PRIOR) / (sum(n for _, n in own) + 1)
        pos = sum(p * r[3] for p, r in zip(yes, patterns, strict=True))
        neg = sum((1 - p) * r[3] for p, r in zip(yes, patterns, strict=True))
        for j in range(len(LABELERS)):
            if j == FORMAT:
                rel[j] = _regressed([(p, v[j], n) for p, (_, _, v, n) in zip(unseen, patterns, strict=True)], start)
                continue
            for vote, (p0, q0) in start.items():
                p = sum(w * n for w, (_, _, v, n) in zip(yes, patterns, strict=True) if v[j] == vote)
                q = sum((1 - w) * n for w, (_, _, v, n) in zip(yes, patterns, strict=True) if v[j] == vote)
                rel[j][vote] = ((p + 10 * p0) / (pos + 10), (q + 10 * q0) / (neg + 10))
    return share, rel


def _regressed(rows: list[tuple], start: dict) -> dict:
    """P(vote | personal) and P(vote | not) of a labeler that had no part in the probabilities ``p`` of (p, vote, count) rows.

    Given ``p`` such a labeler votes with probability ``a p + b (1 - p)``; a and b are the least squares over all
    rows. Plain averages weighted by p would draw them together.
    """
    prior = 10
    pp = sum(n * p * p for p, _, n in rows) + prior
    qq = sum(n * (1 - p) ** 2 for p, _, n in rows) + prior
    pq = sum(n * p * (1 - p) for p, _, n in rows)
    out = {}
    for vote, (p0, q0) in start.items():
        pv = sum(n * p for p, v, n in rows if v == vote) + prior * p0
        qv = sum(n * (1 - p) for p, v, n in rows if v == vote) + prior * q0
        det = pp * qq - pq * pq
        out[vote] = tuple(min(0.995, max(0.005, x)) for x in ((pv * qq - qv * pq) / det, (qv * pp - pv * pq) / det))
    a, b = (sum(x[i] for x in out.values()) for i in (0, 1))
    return {v: (x / a, y / b) for v, (x, y) in out.items()}


def posterior(share: dict, rel: list, kind: str, ok: bool | None, votes: tuple, without: int | None = None) -> float:
    """P(personal | votes), of all labelers but one. Where ``ok`` is given, a base pattern's own check settles its kind, which anchors the two classes."""
    if kind in BASE and ok is not None:
        return ANCHOR if ok else 1 - ANCHOR
    least, most = 1e-6, 1 - 1e-6
    at = min(most, max(least, share[kind]))
    p = math.log(at) + sum(math.log(rel[j][v][0]) for j, v in enumerate(votes) if j != without)
    q = math.log(1 - at) + sum(math.log(rel[j][v][1]) for j, v in enumerate(votes) if j != without)
    return 1 / (1 + math.exp(max(-700, min(700, q - p))))


def _features() -> Column:
    """The features of a span: a fixed space of strings."""
    digits = F.length(F.regexp_replace("m", "[^0-9]", ""))
    word = F.regexp_extract("before", r"(\w+)\W*$", 1)
    return F.array(
        *[F.concat(F.col("kind"), F.lit(f":{v}="), F.col(v).cast("string")) for v in LABELERS],
        F.concat(F.lit("length="), F.least(F.lit(12), F.floor(F.length("m") / 4)).cast("string")),
        F.concat(F.lit("digits="), F.floor(4 * digits / F.length("m")).cast("string")),
        F.concat(F.lit("word="), F.pmod(F.hash(F.lower(word)), F.lit(64)).cast("string")),
    )


def classified(rows: DataFrame) -> DataFrame:
    """Voted candidates with ``p``, the final classifier's probability of personal data."""
    counts = rows.groupBy("kind", "ok", *LABELERS).count().collect()
    patterns = [(r[0], r[1], tuple(r[2:6]), r[6]) for r in counts]
    if not patterns:
        return rows.withColumn("p", F.lit(0.0))
    share, rel = reliabilities(patterns)
    soft = F.create_map(*[x for k, ok, v, _ in patterns for x in (F.lit(f"{k}{int(ok)}{''.join(map(str, v))}"), F.lit(posterior(share, rel, k, ok, v)))])
    rows = rows.withColumn("_soft", soft[F.concat("kind", F.col("ok").cast("int").cast("string"), *[F.col(v).cast("string") for v in LABELERS])])
    each = rows.select("_soft", F.explode(_features()).alias("f")).groupBy("f").agg(F.sum("_soft").alias("p"), F.sum(1 - F.col("_soft")).alias("q"))
    table = each.collect()
    pos = sum(posterior(share, rel, k, ok, v) * n for k, ok, v, n in patterns)
    neg = sum(n for _, _, _, n in patterns) - pos
    weight = {r.f: math.log((r.p + 1) / (pos + 2)) - math.log((r.q + 1) / (neg + 2)) for r in table}
    weights = F.create_map(*[x for f, w in sorted(weight.items()) for x in (F.lit(f), F.lit(w))])
    score = F.aggregate(F.transform(_features(), lambda f: F.coalesce(weights[f], F.lit(0.0))), F.lit(math.log((pos + 1) / (neg + 1))), lambda a, x: a + x)
    return rows.withColumn("p", 1 / (1 + F.exp(-score))).drop("_soft")


def accepted(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """Base spans that pass their check, and the loose ones that the classifier accepts and that overlap no span before them."""
    base = F.col("kind").isin(*BASE)
    rows = rows.filter((base & F.col("ok")) | (~base & (F.col("p") >= least)))
    doc = Window.partitionBy("doc_id", "text_hash")
    order = doc.orderBy("start", F.when(base, 0).otherwise(1), "end", "kind")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    rows = rows.withColumn("_free", free).filter(base | F.col("_free")).drop("_free").select("doc_id", "text_hash", "kind", "start", "end")
    loose = rows.filter(~base)
    # loose spans that overlap in a chain are walked through in order; a chain is a few spans long
    upto = F.max("end").over(doc.orderBy("start", _rank(), "end").rowsBetween(Window.unboundedPreceding, -1))
    chain = F.sum(F.when(F.coalesce(upto, F.lit(0)) <= F.col("start"), 1).otherwise(0)).over(doc.orderBy("start", _rank(), "end").rowsBetween(Window.unboundedPreceding, 0))
    loose = loose.withColumn("_upto", upto).withColumn("_chain", chain.cast("long")).drop("_upto")
    spans = loose.groupBy("doc_id", "text_hash", "_chain").agg(F.array_sort(F.collect_list(F.struct("start", _rank().alias("rank"), "end", "kind"))).alias("_all"))
    picked = F.aggregate("_all", F.filter("_all", lambda x: F.lit(False)), lambda got, x: F.when((F.size(got) > 0) & (F.get(got, F.size(got) - 1)["end"] > x["start"]), got).otherwise(F.array_append(got, x)))
    loose = spans.select("doc_id", "text_hash", F.explode(picked).alias("x")).select("doc_id", "text_hash", "x.kind", "x.start", "x.end")
    return rows.filter(base).unionByName(loose)


def _rank() -> Column:
    """A kind's place among all kinds."""
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))


def detect(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans, base): arrays of (start, rank, end, kind) by start and rank, for texts with spans."""
    rows = stored(voted(candidates(documents)), "pii-candidates")
    spans = accepted(classified(rows))
    item = F.struct("start", _rank().alias("rank"), "end", "kind")
    both = spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(item)).alias("spans"))
    return both.withColumn("base", F.filter("spans", lambda x: x["rank"] <= len(BASE)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect(documents).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "spans", "base")
    rows = documents.select("doc_id", _key(F.col("text")).alias("_k"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_h")), "left")

    def named(spans: str) -> Column:
        each = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.coalesce(F.array_join(each, ","), F.lit(""))

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("base", lambda x: x["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *[count(k) for k in BASE], F.sha2(named("base"), 256).alias("base_sha256"), named("spans").alias("spans"))
