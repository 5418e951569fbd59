"""Quality rules as a bitmask ledger (native expressions only).

``ledger`` measures every document once and evaluates every rule once: bit
``k`` of ``fail_bits`` says that rule ``k`` failed. The ledger is stored in the shared
folder. A policy is a set of rules,
so any policy, old or new, is applied to the stored ledger with one bitwise and
(``passes``), and what each rule removes, alone or at all, comes from one small
aggregate over the distinct bit patterns (``ablation``); neither measures a text again.

Defined results: a null or empty text has no words, so it fails ``few_words``;
repeated rows each get their own ledger row; an empty table gives an empty
ledger; other columns pass through, and cannot clash, since everything that is
computed sits in one struct column whose name is a parameter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm.common import let, read, stored, words

LEDGER = "_quality_ledger"

#: Rule name -> failure test over the measurements. The order fixes the bit; new rules go last.
RULES = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_trigrams": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 14 * m["n_words"]),
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "capitals": lambda m: 10 * m["n_upper"] > 4 * m["word_chars"],
    "exclamations": lambda m: 10 * m["n_exclaim"] > 3 * m["n_words"],
    "bullets": lambda m: 10 * m["n_bullets"] > 9 * m["n_lines"],
    "ellipses": lambda m: 10 * m["n_ellipses"] > 3 * m["n_lines"],
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}

#: Policies by version; a version never changes once it has been used.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_trigrams"),
    "v1": ("few_words", "repeated_trigrams", "symbols", "word_length", "duplicate_lines"),
    "v2": tuple(RULES),
}


def mask(policy: str) -> int:
    return reduce(int.__or__, (BIT[name] for name in POLICIES[policy]), 0)


def repeat_words(w: Column, n: int = 3) -> Column:
    """Words in ``n``-word windows found twice or more in the array ``w``.

    Windows are compared by a 64-bit hash within one text. The hashes are sorted
    with their positions, equal neighbours mark positions, and the marked
    positions, sorted again, are joined to a length: each adds what the one
    before it does not cover.
    """
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(w) - n),
        lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(n)]).alias("h"), i.alias("i")),
    )

    def covered(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
        )
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("c"), F.lit(-n).alias("last")),
            lambda a, i: F.struct((a["c"] + F.least(F.lit(n), i - a["last"])).alias("c"), i.alias("last")),
            lambda a: a["c"],
        )

    return F.when(F.size(w) > n, let(F.sort_array(hashed), covered)).otherwise(0)


def measures(text: Column) -> Column:
    """All measurements of a text, as one struct of longs."""

    def of(x: Column) -> Column:
        w, t, marks = x["w"], x["t"], x["marks"]

        def parts(lines: Column) -> Column:
            found = {
                "n_words": F.size(w),
                "word_chars": F.length(F.array_join(w, "")),
                "n_symbols": F.length(F.regexp_replace(marks, r"[^#*$%&|<>]+", "")),
                "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
                "n_repeat_words": repeat_words(w),
                "n_lines": F.size(lines),
                "n_upper": F.length(F.regexp_replace(marks, r"[^\p{Lu}]+", "")),
                "n_exclaim": F.length(F.regexp_replace(marks, r"[^!]+", "")),
                "n_bullets": F.size(F.filter(lines, lambda v: v.rlike(r"^\s*[-*•‣·]"))),
                "n_ellipses": F.size(F.filter(lines, lambda v: v.rlike(r"(\.\.\.|…)\s*$"))),
            }
            return F.struct(*[v.cast("long").alias(k) for k, v in found.items()])

        return let(F.filter(F.split(t, "\n"), lambda v: v.rlike(r"[^\x20\x09-\x0D]")), parts)

    t = F.coalesce(text, F.lit(""))
    marks = F.regexp_replace(t, r"[^!#*$%&|<>\p{Lu}]+", "")
    return let(F.struct(words(t).alias("w"), t.alias("t"), marks.alias("marks")), of)


def ledger(documents: DataFrame, text: str = "text", name: str = LEDGER) -> DataFrame:
    """``documents`` and a struct column ``name``: the measurements and ``fail_bits``.

    The rules read measurements that are bound within one expression, so a filter
    on the ledger that the optimizer moves below it still measures a text once.
    """

    def judged(m: Column) -> Column:
        bits = [F.when(test(m), F.lit(BIT[rule])).otherwise(F.lit(0)).cast("long") for rule, test in RULES.items()]
        return m.withField("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))

    return documents.withColumn(name, let(measures(F.col(text)), judged))


def stored_ledger(documents: DataFrame, text: str = "text", name: str = LEDGER) -> DataFrame:
    """``ledger``, written to the shared folder and read back."""
    return stored(ledger(documents, text, name), "quality-ledger")


def passes(policy: str, name: str = LEDGER) -> Column:
    """Whether a document of the ledger meets the policy."""
    return F.col(name)["fail_bits"].bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, name: str = LEDGER) -> DataFrame:
    """For each policy and rule of it: documents that fail the rule, and that fail nothing else of the policy.

    The ledger is first counted by bit pattern (at most 2 to the number of rules
    rows), so no policy reads the documents again.
    """
    patterns = rows.groupBy(F.col(name)["fail_bits"].alias("bits")).agg(F.count("*").alias("n"))
    spark = rows.sparkSession
    wanted = [(p, r, mask(p), BIT[r]) for p, rules in POLICIES.items() for r in rules]
    table = spark.createDataFrame(wanted, "policy string, rule string, policy_mask long, rule_bit long")
    failing = F.col("bits").bitwiseAND(F.col("policy_mask"))
    return (
        patterns.join(F.broadcast(table), F.col("bits").bitwiseAND(F.col("rule_bit")) != 0)
        .groupBy("policy", "rule")
        .agg(F.sum("n").alias("n_failed"), F.sum(F.when(failing == F.col("rule_bit"), F.col("n")).otherwise(0)).alias("n_only"))
    )


def keep(documents: DataFrame, policy: str = "v2") -> DataFrame:
    """The documents that meet the policy, with the columns they came with."""
    return stored_ledger(documents).filter(passes(policy)).drop(LEDGER)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger of all documents, without their texts."""
    return stored(ledger(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", LEDGER), "quality-ledger")


def ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy removes of all documents, and removes alone."""
    return ablation(_measured(spark, sf_dir))


def query(spark: SparkSession, sf_dir: str, policy: str = "v2") -> DataFrame:
    """Measurements, base verdict, verdict of the policy and failure bits of every document."""
    rows = _measured(spark, sf_dir)
    base = ~passes("base")
    m = F.col(LEDGER)
    return rows.select(
        "doc_id",
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base.alias("base_failed"),
        (~base & passes(policy)).alias("kept"),
        m["fail_bits"].alias("fail_bits"),
    )


_SPLIT = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_MEASURED = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {_SPLIT.format("text")} AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c FROM p WHERE i + 2 <= len(w)),
x AS (SELECT DISTINCT r, i + k AS i FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1),
n AS (SELECT r, count(*) AS n FROM x GROUP BY r),
m AS (SELECT w.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
  len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n.n, 0) AS n_repeat_words, len(l) AS n_lines,
  len(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, len(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclaim,
  len(list_filter(l, lambda v: regexp_matches(v, '^\s*[-*•‣·]'))) AS n_bullets,
  len(list_filter(l, lambda v: regexp_matches(v, '(\.\.\.|…)\s*$'))) AS n_ellipses
  FROM w LEFT JOIN n USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 8 ELSE 0 END)
  + (CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END) + (CASE WHEN 10 * n_upper > 4 * word_chars THEN 32 ELSE 0 END)
  + (CASE WHEN 10 * n_exclaim > 3 * n_words THEN 64 ELSE 0 END) + (CASE WHEN 10 * n_bullets > 9 * n_lines THEN 128 ELSE 0 END)
  + (CASE WHEN 10 * n_ellipses > 3 * n_lines THEN 256 ELSE 0 END) AS bits FROM m)
"""
ORACLE = _MEASURED + """SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS fail_bits FROM b
"""
_SETS = ", ".join(f"('{policy}', '{rule}', {mask(policy)}, {BIT[rule]})" for policy, rules in POLICIES.items() for rule in rules)
ABLATION = (
    _MEASURED
    + f"""SELECT policy, rule, count(*) AS n_failed, count(*) FILTER ((bits & policy_mask) = rule_bit) AS n_only
FROM b JOIN (VALUES {_SETS}) p(policy, rule, policy_mask, rule_bit) ON (bits & rule_bit) <> 0 GROUP BY policy, rule"""
)
