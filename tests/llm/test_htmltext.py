import random

import numpy as np

from vistaloom.llm import htmltext

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";x(1)</script></head><body>
<header>Site head</header><nav><ul><li><a href="/a>b">Home<li>More</ul></nav><!-- ad <p>no</p> --><div class="ad">Buy now</div>
<article><h1>A &lt;b&gt;&nbsp;title&#33;</h1><p><b>One
 two<br>three<p class="cookie-notice">We use cookies<p>Four &amp;amp; <i>fi</i>ve</p><form><p>Your name</p></form>
<div id="comments"><p>First!</p></div></article><footer>&copy; me</footer></body></html>"""


def test_markup():
    assert htmltext.host_texts([PAGE]) == ["A <b> title!\n\nOne two three\n\nFour &amp; five"]
    assert htmltext.host_texts([None, "", "<p>", "just text", "<div>a<div>b</div>c</div>"]) == ["", "", "", "just text", "a\n\nb\n\nc"]
    assert htmltext.host_texts(["<article><p>a" + "<b>" * 3000 + "x</article><p>" + "<" * 50000]) != []


def test_pages_of_the_table(spark, sf_dir):
    import html
    import re

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in htmltext.query(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id].text == "\n\n".join(p for p in parts if p) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_repeated_plain_runs_go_and_unique_ones_stay():
    notice = "this site is the property of nobody and everybody at once"
    pages = [f"<p>{notice}</p><p>unique{n} words{n} of{n} page{n}</p><p>u{n} v{n} w{n} x{n} y{n} z{n} q{n} r{n} s{n} t{n} o{n} m{n} {notice}</p>" for n in range(3)]
    got = htmltext.host_texts(pages)
    for n, text in enumerate(got):
        assert text == f"unique{n} words{n} of{n} page{n}\n\nu{n} v{n} w{n} x{n} y{n} z{n} q{n} r{n} s{n} t{n} o{n} m{n}"
    shared = [f"<article><p>{notice}</p><p>x{n}</p></article>" for n in range(3)]
    assert htmltext.host_texts(shared) == [f"{notice}\n\nx{n}" for n in range(3)]
    copies = [pages[0], pages[0]]
    assert htmltext.host_texts(copies)[0].startswith(notice)


def slow_covered(tokens, page, outside, least):
    at = {}
    for i in range(len(tokens)):
        at.setdefault(tuple(tokens[i : i + least]), []).append(i)
    repeated, common = [False] * len(tokens), [False] * len(tokens)
    for own in at.values():
        n = len({page[i] for i in own if not outside[i]})
        for bad, marks, out in ((len({page[i] for i in own if outside[i]}) > 1, repeated, True), (n >= 5 and 2 * n > len(set(page)), common, False)):
            for i in own if bad else ():
                if outside[i] == out:
                    marks[i : i + least] = [True] * len(marks[i : i + least])
    return repeated, common


def test_covered_by_hand():
    rng = random.Random(4)
    for k in range(40):
        pages = [[rng.randint(0, 1 + k % 2) for _ in range(rng.randint(0, 25))] for _ in range(9)]
        tokens, page, outside = [], [], []
        for n, p in enumerate(pages):
            tokens += [*p, -1 - n]
            page += [n] * (len(p) + 1)
            outside += [rng.random() < 0.6 for _ in p] + [False]
        got = htmltext.covered(np.array(tokens), np.array(page), np.array(outside), 4)
        assert [x.tolist() for x in got] == list(slow_covered(tokens, page, outside, 4))


def slow_texts(pages, least=8):
    """The texts of one host's pages, token by token."""
    cut = [htmltext.blocks(p) for p in pages]
    seen, tokens, page, outside, spans = {}, [], [], [], []
    for n, blocks in enumerate(cut):
        key = str([t for t, _ in blocks])
        spans.append([])
        if key in seen:
            spans[n] = spans[seen[key]]
            continue
        seen[key] = n
        for text, kind in blocks:
            words = text.split(" ")
            spans[n].append(len(tokens))
            tokens += words
            page += [n] * len(words)
            outside += [kind != htmltext.ARTICLE] * len(words)
        tokens.append(("end", n))
        page.append(n)
        outside.append(False)
    repeated, common = slow_covered(tokens, page, outside, least)
    out = []
    for blocks, starts in zip(cut, spans, strict=True):
        kept = []
        for (text, kind), a in zip(blocks, starts, strict=True):
            words = text.split(" ")
            if kind == htmltext.ARTICLE:
                words = [] if all(common[a : a + len(words)]) else words
            elif kind == htmltext.BOILER:
                words = []
            else:
                words = [w for i, w in enumerate(words) if not repeated[a + i]]
            kept += [" ".join(words)] if words else []
        out.append("\n\n".join(kept))
    return out


def generated(seed, n):
    """Pages of three hosts: articles, main and plain blocks with passages that repeat in and outside articles."""
    rng = random.Random(seed)
    text = lambda k: " ".join(f"w{rng.randint(0, 5000)}" for _ in range(k))
    notices = [text(rng.randint(6, 14)) for _ in range(15)]
    common = text(11)
    rows = []
    for i in range(n):
        parts = [f"<nav>{notices[0]}</nav>"]
        for _ in range(rng.randint(1, 5)):
            tag = rng.choice(["article", "div", "main", "section"])
            parts.append(f"<{tag}><p>{text(rng.randint(1, 20))} {rng.choice(notices)}</p><p>{rng.choice(notices)} {text(2)}</p><p>{text(9)}</p></{tag}>")
        if i % 10 < 7:
            parts.insert(rng.randint(0, len(parts)), f"<article><p>{text(5)}</p><p>{common}</p></article>")
        rows.append((i, f"http://{rng.choice(['Big', 'big', 'BIG', 'mid', 'small'])}.example/{i}", "".join(parts)))
    return rows + [(n, *rows[1][1:]), (n + 1, rows[1][1], f"<i></i>{rows[1][2]}"), (n + 2, "http://big.example/", None)]


def test_query_equals_brute_force_for_any_part_size(make):
    rows = generated(7, 60)
    hosts = {}
    for i, url, page in rows:
        hosts.setdefault(url.split("/")[2].lower(), []).append((i, page))
    want = {i: t for own in hosts.values() for (i, _), t in zip(own, slow_texts([p for _, p in own]), strict=True)}
    pages = make([(*r, 0) for r in rows], "page_id long, url string, html string, part int")
    for size in (10**9, 3000, 400):
        assert {r.page_id: r.text for r in htmltext.extract(pages, part_chars=size).collect()} == want, size
    # without the array these pages keep their notices
    plain = {i: "\n\n".join(t for t, k in htmltext.blocks(p) if k != htmltext.BOILER) for i, _, p in rows}
    assert sum(plain[i] != want[i] for i in want) > 50


def test_notices_on_most_pages_leave_articles():
    notice = "please read our terms before you share any of this"
    pages = [f"<article><p>own{n} text</p>" + f"<p>{notice}</p>" * (n < 6) + f"<p>end{n} {notice}</p></article>" for n in range(9)]
    assert htmltext.host_texts(pages) == [f"own{n} text\n\nend{n} {notice}" for n in range(9)]
    pages = [f"<article><p>own{n} text</p>" + f"<p>{notice}</p>" * (n < 4) + "</article>" for n in range(9)]
    assert htmltext.host_texts(pages) == [f"own{n} text" + f"\n\n{notice}" * (n < 4) for n in range(9)]


def test_defined_cases(make):
    ddl = "page_id long, url string, html string, host int"
    rows = [(1, None, "<p>a</p>", 1), (1, None, "<p>a</p>", 1), (None, "http://x/", None, 1)]
    got = sorted(map(repr, (tuple(r) for r in htmltext.extract(make(rows, ddl), part_chars=5).collect())))
    assert got == sorted(map(repr, [(1, None, "a"), (1, None, "a"), (None, "http://x/", "")]))
    assert htmltext.extract(make([], ddl)).count() == 0


def test_mostly_covered_blocks_keep_their_own_words():
    notice = " ".join(f"notice{i}" for i in range(31))
    own = [" ".join(f"own{n}x{i}" for i in range(29)) for n in range(3)]
    assert htmltext.host_texts([f"<p>{notice} {x}</p>" for x in own]) == own
    assert htmltext.host_texts([f"<p>{notice} last{n}</p><p>{notice}</p>" for n in range(3)]) == [f"last{n}" for n in range(3)]


def test_coverage_decides_in_main_outside_articles():
    notice = "this site is the property of nobody and everybody at once"
    for tag in ("main", 'div class="post-content"', 'div role="main"'):
        pages = [f"<{tag}><header><h1>head{n}</h1></header><p>{notice}</p><p>own{n}</p><article><p>kept{n}</p></article></{tag.split()[0]}>" for n in range(3)]
        assert htmltext.host_texts(pages) == [f"head{n}\n\nown{n}\n\nkept{n}" for n in range(3)]
