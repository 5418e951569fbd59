"""Main text of web pages by a suffix array over each host's pages.

Pages are cut into blocks, each with what its markup says: inside a declared
article, main, plain, or boilerplate (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments, hidden parts). The token streams of a host's
pages are concatenated and their suffixes sorted by the first ``LEAST`` tokens; that is as
deep as a repeat has to be long, so the windows of equal prefixes cover together
what all maximal repeats of ``LEAST`` tokens or more cover. Two kinds of windows
are boilerplate: those that start outside declared articles on two distinct pages
or more, and those that start inside them on over half of a host's distinct pages
(``NOTICE_PAGES`` at least). A block's markup and its cover decide together: main and
plain blocks lose what the first kind covers and keep their unique runs, however
short; an article's block goes if windows of the second kind cover all of it;
boilerplate markup goes.

Scale: pages are cut into blocks where they are read and only the blocks' text is
shuffled, compressed, by host. A host larger than ``PART_CHARS`` is split by page into parts of
about that size, so no task gathers a whole hot host. What is in articles on over half of the host's
pages is so on over half of some part's, so parts nominate such windows, few as they
are. A host without a nomination and without undecided (main or plain) text loses
nothing, and its texts are written where its pages are read. Of any other host all parts count what is
nominated, and exchange 64-bit hashes of their windows outside articles by hash range if it has
undecided text. The result is the same for any size of parts.

Defined results: null and empty pages have no text; pages without a URL form one
host; copies of a page count as one page and so are no evidence against each
other; repeated rows each get a result; an empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaloom.llm.common import read, small_batches, stored

LEAST = 8
NOTICE_PAGES = 5
PART_CHARS = 1_000_000
MOST_BROADCAST = 100_000
#: MAIN is declared main text outside an article element: a place for headers, but coverage decides.
ARTICLE, PLAIN, BOILER, MAIN = 0, 1, 2, 3

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*)>""", re.S
)
ATTRIBUTE = re.compile(r"""([A-Za-z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Fixed values of HTML: elements whose content is no markup, without content, and that start a block.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element that such a tag closes first.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Boilerplate by element, and by the parts of a class, id or role.
BOILER_TAGS = {"nav", "footer", "aside", "form", "menu", "button", "select", "noscript", "template", "svg", "dialog", "head", "object", "canvas", "audio", "video"}
BOILER_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer menu nav navbar navigation "
    "newsletter notice notices pagination popup promo promoted related reply replies share sharing sidebar skyscraper social sponsor sponsored subscribe subscription toolbar widget".split()
)
ARTICLE_NAMES = {"articlebody", "article-body", "article-content", "post-content", "entry-content", "story-body", "main-content"}


def _kind(tag: str, attributes: str, within: int) -> int:
    """What an element's own markup makes of its content, inside content of kind ``within``."""
    if within == BOILER or tag in BOILER_TAGS or (tag == "header" and within not in (ARTICLE, MAIN)):
        return BOILER
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return ARTICLE if tag == "article" else MAIN if tag == "main" and within == PLAIN else within
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return BOILER
    names = [x for k in ("class", "id", "role") for x in found.get(k, "").split()]
    parts = {p for x in names for p in re.split(r"[-_:]+", x)}
    if parts & BOILER_NAMES or ("header" in parts and within not in (ARTICLE, MAIN)):
        return BOILER
    if tag == "article":
        return ARTICLE
    if within == PLAIN and (tag == "main" or "main" in found.get("role", "") or found.get("itemprop") == "articlebody" or ARTICLE_NAMES & set(names)):
        return MAIN
    return within


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, kind) of the page's blocks, in order, without empty ones."""
    page = page or ""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []
    kind, at = PLAIN, 0

    def flush() -> None:
        if text:
            words = entities.unescape("".join(text)).split()
            if words:
                out.append((" ".join(words), kind))
            text.clear()

    def back(n: int) -> None:
        nonlocal kind
        del stack[n:]
        kind = stack[-1][1] if stack else PLAIN

    while m := TAG.search(page, at):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        closing, attributes = m[1] or m[4], (m[3] or m[6] or "")
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if closing:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == tag:
                    if stack[n][1] != (stack[n - 1][1] if n else PLAIN) or kind != stack[n][1]:
                        flush()
                    back(n)
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            stack.append((tag, BOILER))
            continue
        closes = CLOSES.get(tag) or ({"p"} if tag in BLOCK else None)
        if closes:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] in closes:
                    back(n)
                    break
                if stack[n][0] in BLOCK:
                    break
        inner = _kind(tag, attributes, kind)
        if inner != kind:
            flush()
        stack.append((tag, inner))
        kind = inner
    text.append(page[at:])
    flush()
    return out


def ranked(values: np.ndarray) -> np.ndarray:
    """The number of each value among the sorted distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(values) else 0
    return out


def suffix_ranks(tokens: np.ndarray, length: int) -> np.ndarray:
    """The order of each suffix of ``tokens`` by its first ``length`` tokens (a power of two), by prefix doubling."""
    rank = ranked(tokens)
    step = 1
    while step < length:
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:] + 1 if len(rank) > step else after[:-step]
        rank = ranked(rank * (rank.max(initial=0) + 2) + after)
        step *= 2
    return rank


def repeats(tokens: np.ndarray, page: np.ndarray, outside: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rank of each suffix by its first ``least`` tokens, and of each rank on how many pages it starts inside articles, and outside."""
    rank = suffix_ranks(tokens, least)
    array = np.argsort(rank, kind="stable")  # pages ascend within a rank, as they do in the stream

    def pages(at: np.ndarray) -> np.ndarray:
        r, p = rank[at], page[at]
        new = np.ones(len(at), bool)
        new[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1])
        return np.bincount(r[new], minlength=rank.max(initial=-1) + 1)

    return rank, pages(array[~outside[array]]), pages(array[outside[array]])


def spread(bad: np.ndarray, least: int) -> np.ndarray:
    """For each token, whether one of the substrings that start where ``bad`` is true covers it."""
    step = np.zeros(len(bad) + least + 1, np.int64)
    at = np.flatnonzero(bad)
    np.add.at(step, at, 1)
    np.add.at(step, at + least, -1)
    return np.cumsum(step[: len(bad)]) > 0


def covered(tokens: np.ndarray, page: np.ndarray, outside: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """For each token, whether a window that repeats outside articles covers it, and whether one in the articles of most pages does.

    ``page``: an ascending number of each token's page; ``outside``: whether it is outside declared
    articles. A separator, its number below zero, ends each page, so a window that
    runs past its page is on no other.
    """
    rank, inside, beyond = repeats(tokens, page, outside, least)
    n_pages = len(np.unique(page))
    # what repeats outside articles covers nothing of one, and the other way round
    return spread((beyond >= 2)[rank] & outside, least), spread(notices(inside, n_pages)[rank] & ~outside, least)


def notices(n: np.ndarray, n_pages: int) -> np.ndarray:
    """Whether what is on ``n`` of a host's distinct pages is on most of them."""
    return (n >= NOTICE_PAGES) & (2 * n > n_pages)


def streamed(cut: list[list[tuple[str, int]]]) -> tuple:
    """The token stream of pages cut into blocks: tokens, page and outside as for ``covered``, each page's spans, and the words by number."""
    ids: dict[str, int] = {}
    number: dict[str, int] = {}
    stream, page, outside = [], [], []
    starts: list[list[tuple[int, int]]] = []
    for n, page_blocks in enumerate(cut):
        key = "\n".join(t for t, _ in page_blocks)
        first = number.setdefault(key, n)
        if first != n:  # a copy is the same page
            starts.append(starts[first])
            continue
        own = []
        for text, kind in page_blocks:
            words = text.split(" ")
            own.append((len(stream), len(stream) + len(words)))
            stream += [ids.setdefault(w, len(ids)) for w in words]
            page += [n] * len(words)
            outside += [kind != ARTICLE] * len(words)
        starts.append(own)
        stream.append(-1 - n)
        page.append(n)
        outside.append(False)
    return np.array(stream, np.int64), np.array(page, np.int64), np.array(outside, bool), starts, list(ids)


def written(cut: list[list[tuple[str, int]]], starts: list[list[tuple[int, int]]], repeated: np.ndarray, common: np.ndarray) -> list[str]:
    """The text that stays of each page, given what is covered in either way."""
    out = []
    for page_blocks, spans in zip(cut, starts, strict=True):
        kept = []
        for (text, kind), (a, b) in zip(page_blocks, spans, strict=True):
            if kind == BOILER:
                continue
            if kind == ARTICLE:
                if not common[a:b].all():
                    kept.append(text)
                continue
            gone = repeated[a:b]
            if not gone.any():
                kept.append(text)
            elif not gone.all():
                kept.append(" ".join(w for w, g in zip(text.split(" "), gone, strict=True) if not g))
        out.append("\n\n".join(kept))
    return out


def cut_texts(cut: list[list[tuple[str, int]]], least: int = LEAST) -> list[str]:
    """The main text of each page of one whole host, the pages cut into blocks."""
    tokens, page, outside, starts, _ = streamed(cut)
    return written(cut, starts, *covered(tokens, page, outside, least))


def host_texts(pages: list[str | None], least: int = LEAST) -> list[str]:
    """The main text of each page of one whole host."""
    return cut_texts([blocks(p) for p in pages], least)


def window_hashes(tokens: np.ndarray, page: np.ndarray, words: list[str], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each token: the 64-bit hash of the ``least`` tokens from it, the same in every part, and whether they lie in its page."""
    n = max(0, len(tokens) - least + 1)
    of = np.array([xxhash.xxh64_intdigest(w.encode()) for w in words] or [0], np.uint64)[np.maximum(tokens, 0)]
    hashes, valid = np.zeros(len(tokens), np.uint64), np.zeros(len(tokens), bool)
    h = np.zeros(n, np.uint64)
    for k in range(least):
        h = (h ^ of[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    hashes[:n] = h
    last = slice(least - 1, least - 1 + n)
    valid[:n] = (page[:n] == page[last]) & (tokens[last] >= 0)
    return hashes, valid


def nominated(cut: list[list[tuple[str, int]]], least: int = LEAST) -> tuple[np.ndarray, int]:
    """The hashes of the windows that start in articles on over half of a part's distinct pages, and how many pages it has."""
    tokens, page, outside, _, words = streamed(cut)
    rank, inside, _ = repeats(tokens, page, outside, least)
    n_pages = len(np.unique(page))
    hashes, valid = window_hashes(tokens, page, words, least)
    return np.unique(hashes[valid & (2 * inside > n_pages)[rank]]), n_pages


def told(cut: list[list[tuple[str, int]]], asked: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Of a part: (hash, pages) of the distinct windows outside articles, and (hash, pages) of those of ``asked`` that it has inside."""
    tokens, page, outside, _, words = streamed(cut)
    rank, inside, beyond = repeats(tokens, page, outside, least)
    hashes, valid = window_hashes(tokens, page, words, least)
    first = np.full(len(inside), -1)
    first[rank[valid]] = np.flatnonzero(valid)
    found = first[(first >= 0) & (beyond > 0)]
    wanted = first[(first >= 0) & (inside > 0)]
    wanted = wanted[np.isin(hashes[wanted], asked)]
    return hashes[found], beyond[rank[found]].astype(np.int32), hashes[wanted], inside[rank[wanted]].astype(np.int32)


def answered(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Of each part's (hash, pages): the hashes that are on two pages or more of all parts, which share no page."""
    hashes = np.concatenate([p[0] for p in parts])
    found, which = np.unique(hashes, return_inverse=True)
    bad = np.bincount(which, np.concatenate([p[1] for p in parts]), len(found)) >= 2
    ends = np.cumsum([len(p[0]) for p in parts])[:-1]
    return [p[0][b] for p, b in zip(parts, np.split(bad[which], ends), strict=True)]


def part_texts(cut: list[list[tuple[str, int]]], repeated: np.ndarray, common: np.ndarray, least: int = LEAST) -> list[str]:
    """The main text of each page of a part, given the hashes of the host's windows that are boilerplate in either way."""
    tokens, page, outside, starts, words = streamed(cut)
    hashes, valid = window_hashes(tokens, page, words, least)
    return written(cut, starts, *(spread(valid & np.isin(hashes, x) & at, least) for x, at in ((repeated, outside), (common, ~outside))))


def _packed(page_blocks: list[tuple[str, int]], press: zstandard.ZstdCompressor) -> bytes:
    return press.compress("\n".join(f"{kind}{text}" for text, kind in page_blocks).encode())  # a block's text has no line end


def _unpacked(bodies: list[bytes]) -> list[list[tuple[str, int]]]:
    open_ = zstandard.ZstdDecompressor().decompress
    texts = (open_(b).decode() for b in bodies)
    return [[(x[1:], int(x[0])) for x in t.split("\n")] if t else [] for t in texts]


def _pages(page_id: list, url: list, texts: list[str]) -> pa.Table:
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    return pa.Table.from_pydict({"page_id": page_id, "url": url, "text": texts}, kind)


def _hashes(column: pa.ChunkedArray) -> np.ndarray:
    """The hashes in a column of byte strings."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), np.uint64)


def extract(pages: DataFrame, least: int = LEAST, part_chars: int = PART_CHARS) -> DataFrame:
    """(page_id, url, text) of every row (page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    sizes = rows.groupBy("host").agg(F.sum(F.length("html")).alias("chars")).filter(F.col("chars") > part_chars)
    large = stored(sizes.select("host", F.ceil(F.col("chars") / part_chars).alias("parts")), "html-hosts")
    n_large = large.limit(MOST_BROADCAST + 1).count()
    large = F.broadcast(large) if n_large <= MOST_BROADCAST else large

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for b in batches:
            cut = [blocks(t.as_py()) for t in b.column(2)]
            key = [xxhash.xxh64_intdigest("\n".join(t for t, _ in x).encode()) >> 1 for x in cut]
            body = pa.array([_packed(x, press) for x in cut], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(key, pa.int64()), body], ["page_id", "url", "host", "key", "body"])

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["\n\n".join(t for t, kind in blocks(page.as_py()) if kind != BOILER) for page in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    def whole(table: pa.Table) -> pa.Table:
        return _pages(*(table.column(k).to_pylist() for k in ("page_id", "url")), cut_texts(_unpacked(table.column("body").to_pylist()), least))

    def parsed(rows: DataFrame) -> DataFrame:
        return rows.select("page_id", "url", "html", "host").mapInArrow(parse, "page_id long, url string, host string, key long, body binary")

    def split(rows: DataFrame) -> DataFrame:
        # copies of a page have one key, so parts share no page
        return parsed(rows).join(large, "host").withColumn("part", F.expr("key % parts"))

    small_batches(pages.sparkSession)
    out = "page_id long, url string, text string"
    if not n_large:
        return parsed(rows).groupBy("host").applyInArrow(whole, out)
    small, rows = rows.join(large, "host", "left_anti"), rows.join(large, "host", "left_semi")

    def survey(table: pa.Table) -> pa.Table:
        cut = _unpacked(table.column("body").to_pylist())
        found, n_pages = nominated(cut, least)
        unsure = any(kind in (PLAIN, MAIN) for x in cut for _, kind in x)
        kind = pa.schema([("host", pa.string()), ("of", pa.int64()), ("unsure", pa.bool_()), ("nominated", pa.binary())])
        return pa.Table.from_pylist([{"host": table.column("host")[0].as_py(), "of": n_pages, "unsure": unsure, "nominated": found.tobytes()}], kind)

    surveyed = stored(split(rows).groupBy("host", "part").applyInArrow(survey, "host string, of long, unsure boolean, nominated binary"), "html-survey")
    hosts = surveyed.groupBy("host").agg(F.sum("of").alias("of"), F.max("unsure").alias("ask"), F.array_distinct(F.flatten(F.collect_set(_split_hashes("nominated")))).alias("asked"))
    hosts = stored(hosts.filter(F.col("ask") | (F.size("asked") > 0)), "html-asked")
    quiet = rows.join(hosts.select("host"), "host", "left_anti").select("page_id", "url", "html").mapInArrow(plain, out)
    done = parsed(small).groupBy("host").applyInArrow(whole, out).unionByName(quiet)
    if not hosts.count():
        return done

    def pack(table: pa.Table) -> pa.Table:
        row = {k: table.column(k)[0].as_py() for k in ("host", "part", "parts")} | {k: table.column(k).to_pylist() for k in ("page_id", "url", "body")}
        lists = {"page_id": pa.list_(pa.int64()), "url": pa.list_(pa.string()), "body": pa.list_(pa.binary())}
        return pa.Table.from_pylist([row], pa.schema(list(({"host": pa.string(), "part": pa.int64(), "parts": pa.int64()} | lists).items())))

    packed = "host string, part long, parts long, page_id array<long>, url array<string>, body array<binary>"
    packs = stored(split(rows.join(hosts.select("host"), "host", "left_semi")).groupBy("host", "part").applyInArrow(pack, packed), "html-parts")
    heard = "host string, range long, part long, hashes binary, pages binary"

    def tell(table: pa.Table, info: pa.Table) -> pa.Table:
        kind = pa.schema([("host", pa.string()), ("range", pa.int64()), ("part", pa.int64()), ("hashes", pa.binary()), ("pages", pa.binary())])
        if not table.num_rows or not info.num_rows:
            return pa.Table.from_pylist([], kind)
        asked = np.frombuffer(b"".join(info.column("asked")[0].as_py()), np.uint64)
        outside, n_outside, wanted, n_wanted = told(_unpacked(table.column("body")[0].as_py()), asked, least)
        name, part, parts = (table.column(k)[0].as_py() for k in ("host", "part", "parts"))
        rows = []
        if info.column("ask")[0].as_py():
            at = ((outside >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(at, kind="stable")
            ranges, start = np.unique(at[order], return_index=True)
            for r, h, n in zip(ranges.tolist(), *(np.split(x[order], start[1:]) for x in (outside, n_outside)), strict=False):
                rows.append({"host": name, "range": r, "part": part, "hashes": h.tobytes(), "pages": n.tobytes()})
        # counts of what was nominated go to a range of their own
        rows.append({"host": name, "range": -1, "part": part, "hashes": wanted.tobytes(), "pages": n_wanted.tobytes()})
        return pa.Table.from_pylist(rows, kind)

    def answer(table: pa.Table) -> pa.Table:
        parts = list(zip(*([np.frombuffer(x.as_py(), d) for x in table.column(k)] for k, d in (("hashes", np.uint64), ("pages", np.int32))), strict=True))
        bad = pa.array([x.tobytes() for x in answered(parts)], pa.binary())
        return pa.Table.from_arrays([table.column("host"), table.column("part"), bad], ["host", "part", "bad"])

    def settle(table: pa.Table) -> pa.Table:
        hashes = _hashes(table.column("hashes"))
        n = np.frombuffer(b"".join(table.column("pages").to_pylist()), np.int32)
        found, which = np.unique(hashes, return_inverse=True)
        bad = found[notices(np.bincount(which, n, len(found)), table.column("of")[0].as_py())]
        return pa.table({"host": [table.column("host")[0].as_py()], "common": pa.array([bad.tobytes()], pa.binary())})

    def rest(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _pages([], [], [])
        texts = part_texts(_unpacked(table.column("body")[0].as_py()), _hashes(answers.column("bad")), _hashes(answers.column("common")), least)
        return _pages(table.column("page_id")[0].as_py(), table.column("url")[0].as_py(), texts)

    info = packs.select(F.col("host").alias("h"), F.col("part").alias("p")).join(hosts, F.col("h") == F.col("host")).select("h", "p", "ask", "asked").groupBy("h", "p")
    said = stored(packs.groupBy("host", "part").cogroup(info).applyInArrow(tell, heard), "html-told")
    bad = said.filter("range >= 0").groupBy("host", "range").applyInArrow(answer, "host string, part long, bad binary").filter(F.length("bad") > 0)
    common = said.filter("range < 0 and length(hashes) > 0").join(hosts.select("host", "of"), "host")
    common = common.groupBy("host").applyInArrow(settle, "host string, common binary").filter(F.length("common") > 0)
    none = F.lit(None).cast("binary")
    every = packs.select(F.col("host").alias("h"), F.col("part").alias("p")).join(common, F.col("h") == F.col("host")).select("h", "p", none.alias("bad"), "common")
    answers = bad.select(F.col("host").alias("h"), F.col("part").alias("p"), "bad", none.alias("common")).unionByName(every)
    return done.unionByName(packs.groupBy("host", "part").cogroup(answers.groupBy("h", "p")).applyInArrow(rest, out))


def _split_hashes(column: str) -> Column:
    """The 8-byte pieces of a byte string."""
    n = (F.octet_length(column) / 8).cast("int")
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.col(column), (i - 1) * 8 + 1, F.lit(8)))
    return F.when(n > 0, each).otherwise(F.array().cast("array<binary>"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
