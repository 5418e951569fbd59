"""Secret scans with a token-efficiency test.

Three base patterns (assignments, access keys, long hex runs) are found as
stated, and every other long string of key characters is judged by how badly a
public byte-level vocabulary compresses it: words cost few tokens, random
strings cost about one token for every character or two. Known digests (hex of
a digest's length), UUIDs, numbers and names in mixed case are excluded first; plain
words, also joined by punctuation, are judged by their letters, in lower case by a
stricter ratio. The parts of a string between ``/ . = - _``, runs
of short parts, the whole string and what base spans leave of it are each judged,
and the smallest random ones are reported.

The vocabulary is a rank file whose path is a parameter; its default is the one that the
installed module ``public_tokenizers`` holds.

Defined results: a null text is empty and has no spans; null and repeated doc_ids
each get their own row, ids unchanged; offsets count code points; texts of any length are scanned whole;
an empty table gives an empty result; ``redact`` keeps every other column.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm.common import read, small_batches

KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
#: What a string of key characters is cut into.
WORD = re.compile(r"[A-Za-z0-9+]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
#: At most so many characters for each token make a string random.
MOST_CHARS_PER_TOKEN = 2.0
#: The same for strings of lower-case words, which have rare real words among them.
MOST_LOWER = 1.7
#: Plain words of fewer letters together are not judged.
LEAST_LETTERS = 12
VOCABULARY = "byte_bpe_50k.tiktoken"


@functools.cache
def encoding(path: str | None = None):
    """The tiktoken encoding of a rank file (default: the installed public one); one for each Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_digest(s: str) -> bool:
    return bool(len(s) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s) or UUID.fullmatch(s))


def is_plain(s: str) -> bool:
    """Whether a string has the shape of names, paths, versions or words joined by punctuation."""
    parts = [p for p in re.split(r"[^A-Za-z0-9]+", s) if p]
    return all(p.isdigit() or re.fullmatch(r"[A-Za-z]?[a-z]+\d{0,4}|[A-Z]+\d{0,4}|v?\d+|([A-Z][a-z]+)+\d{0,4}", p) for p in parts)


def base_spans(text: str, longest: int) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; ``longest``: of the words of the text."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if longest >= 24:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def is_random(s: str, most: float, path: str | None) -> bool:
    """Whether a string of 16 characters or more is no digest and has too few characters a token; of plain words the letters alone count."""
    if len(s) < 16 or is_digest(s):
        return False
    runs = [s]
    if is_plain(s):
        runs = re.findall(r"[A-Za-z]+", s)
        if sum(map(len, runs)) < LEAST_LETTERS or any(re.fullmatch(r"([A-Z][a-z]+){2,}", r) for r in runs):
            return False
        most = most if all(map(str.isupper, runs)) else min(most, MOST_LOWER)
    return sum(map(len, runs)) <= most * sum(len(encoding(path).encode_ordinary(r)) for r in runs)


def random_parts(s: str, most: float, path: str | None) -> list[tuple[int, int]]:
    """(start, end) of the smallest random parts of a string of key characters, in order.

    Words of 16 characters or more are judged alone. Shorter ones are judged with
    as many of those behind them as make 16; where they overlap they are one part.
    The whole string is judged only if none of its parts is random.
    """
    if len(s) < 16:
        return []
    uuids = [m.span() for m in UUID.finditer(s)]
    found: list[tuple[int, int]] = []
    short: list[tuple[int, int]] = []

    def join() -> None:
        j = 0
        for i, (a, _) in enumerate(short):
            j = max(i, j)
            while j < len(short) and short[j][1] - a < 16:
                j += 1
            if j == len(short):
                break
            b = short[j][1]
            if is_random(s[a:b], most, path):
                if found and found[-1][1] > a:
                    a = found.pop()[0]
                found.append((a, b))
        short.clear()

    u = 0
    for m in WORD.finditer(s):
        a, b = m.span()
        while u < len(uuids) and uuids[u][1] <= a:
            u += 1
        inside = u < len(uuids) and uuids[u][0] < b
        if b - a < 16 and not inside:
            short.append((a, b))
            continue
        join()
        if not inside and is_random(m[0], most, path):
            found.append((a, b))
    join()
    if not found and not uuids:
        whole = s.strip(".=-")
        a = s.find(whole)
        if is_random(whole, most, path):
            found.append((a, a + len(whole)))
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans as their disjoint unions."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def outside(start: int, end: int, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What sorted disjoint ``cuts`` leave of ``start`` to ``end``."""
    edges = [start, *(x for c in cuts for x in c), end]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]


def token_spans(text: str, taken: list[tuple[int, int, int]], most: float, path: str | None) -> list[tuple[int, int, int]]:
    """Random strings that the spans ``taken`` do not hold whole. Both run in order, so many spans cost in proportion."""
    found = []
    held = merged(sorted((a, b) for a, _, b in taken))
    at = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(held) and held[at][1] <= start:
            at += 1
        if at < len(held) and held[at][0] <= start and end <= held[at][1]:
            continue
        stop = at
        while stop < len(held) and held[stop][0] < end:
            stop += 1
        cuts = [(max(a, start), min(b, end)) for a, b in held[at:stop]]
        longer, k = [], 0
        for w in WORD.finditer(m[0]) if cuts else ():  # a longer key around a base span
            a, b = start + w.start(), start + w.end()
            while k < len(cuts) and cuts[k][1] <= a:
                k += 1
            partly = k < len(cuts) and cuts[k][0] < b and not (cuts[k][0] <= a and b <= cuts[k][1])
            if partly and is_random(w[0], most, path):
                longer.append((a, b))
        found += [(a, 3, b) for a, b in longer]
        rest = outside(start, end, merged(sorted(cuts + longer)))
        found += [(x + a, 3, x + b) for x, y in rest for a, b in random_parts(text[x:y], most, path)]
    return found


def spans(text: str | None, most: float = MOST_CHARS_PER_TOKEN, path: str | None = None) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end) of a text, by start and then kind."""
    text = text or ""
    long = [w for w in text.split() if len(w) >= 16]
    found = base_spans(text, max(map(len, long), default=0))
    if long:
        found += token_spans(text, found, most, path)
    return sorted(found)


def named(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(documents: DataFrame, most: float = MOST_CHARS_PER_TOKEN, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_token, base_sha256, spans) of every row (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: list[list[int]] = [[], [], [], []]
            base, every = [], []
            for text in b.column(1):
                found = spans(text.as_py(), most, vocabulary)
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in found))
                base.append(hashlib.sha256(named([x for x in found if x[1] < 3]).encode()).hexdigest())
                every.append(named(found))
            columns = [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(every, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "n_token", "base_sha256", "spans"])

    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_token long, base_sha256 string, spans string"
    return documents.select("doc_id", "text").mapInArrow(run, ddl)


def redact(documents: DataFrame, text: str = "text", most: float = MOST_CHARS_PER_TOKEN, vocabulary: str | None = None) -> DataFrame:
    """``documents`` with every span replaced by its kind; overlapping spans are replaced together. No row is dropped."""

    def clean(t: str | None) -> str | None:
        found = spans(t, most, vocabulary)
        if not found:
            return t
        out, at, end = [], 0, -1
        for a, k, b in found:
            if a >= end:
                out += [t[at:a], f"<{KINDS[k]}>"]
            at = end = max(end, b)
        return "".join([*out, t[at:]])

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(clean)

    small_batches(documents.sparkSession)
    return documents.withColumn(text, cleaned(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    found = scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_token")
