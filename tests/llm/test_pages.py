"""WARC bundles, URL rules and page texts."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from tests.llm.helpers import empty, prose
from tidemark.llm import html_text, seekable, url_rules, warc
from tidemark.llm.common import open_uri, scratch_path

PAGES = "page_id long, url string, html string"


def pages(spark, rows, extra=""):
    names = [x for x in extra.split(",") if x]
    return spark.createDataFrame([(*r, *([None] * len(names))) for r in rows], PAGES + ("," + extra if extra else ""))


LONG = "<p>" + "é" * 60 + "</p>"
ARCHIVE = [(3, "http://a/\r\nX: y", LONG), (1, "http://b", LONG), (2, None, LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "n", LONG), (8, "u", "x" * 300_000), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (1, "http://b", LONG), (None, None, "z" * 200)]


def test_warc_round_trip(spark):
    bundles = warc.write_bundles(pages(spark, ARCHIVE, "digest string, payload string, first string"), scratch_path(spark, "w"))
    got = sorted((tuple(r)[:1] + tuple(r)[2:6] + (r.payload and bytes(r.payload),) for r in warc.read_bundles(bundles).collect()), key=str)
    want = []
    for page_id, _, html in ARCHIVE:
        data = (html or "").encode()
        same = [i for i, _, h in ARCHIVE if (h or "").encode() == data and i is not None]
        revisit = len(data) >= 100 and same and page_id != min(same)
        want.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None, None if revisit else data or b""))
    assert got == sorted(((*w[:5], w[5] if w[5] else (None if w[5] is None else b"")) for w in want), key=str)


def test_warc_random_access(spark):
    rows = [(i, f"http://h/{i}", prose(400, i)) for i in range(300)]
    bundles = warc.write_bundles(pages(spark, rows).coalesce(1), scratch_path(spark, "w"))
    bundles.cache()
    some = warc.read_bundles(bundles, wanted=[17, 250]).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {i: h for i, _, h in rows if i in (17, 250)}
    with open_uri(bundles.first().uri) as handle:
        frames, _ = seekable.read_tables(handle)
        assert len(frames) > 1 and all(f.full < 2 * warc.FRAME_BYTES for f in frames)


def test_warc_empty(spark):
    assert warc.read_bundles(warc.write_bundles(empty(spark, PAGES), scratch_path(spark, "w"))).count() == 0


URLS = [
    "http://a.org/x", "http://org/x", "http://org", "http://aorg/x", "HTTP://WWW.Example.ORG/es/1?x", "https://example.org/es", "https://m.example.org/es/", "https://example.org/en/1", "https://example.org/en/123#f", "https://example.org/en/2",
    "http://x.com/fr/", "http://x.com/FR/", "http://com/de/q", "http://x.com/de", "http://xcom/de/", "ftp://y.net/casino/", "ftp://casino.net/?casino", "http://casinos.net/", "http://x.org/casino/", "no scheme org/x", None, "", "://org/a", "http://", "http://a?b://org/x", "http://a#/org/", "http://u@b.org:80/x",
    "http://x.com/a.com/fr/", "http://x.net/example.org/es/", "http://é.org/ü/\n?x",
]


def rule_of(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = []
    for r in url_rules.LISTED:
        h, _, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r.name), r.name, r.verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    bad = re.search(r"(^|[./_-])(adserver|casino|doubleclick|login|porn|tracker|xxx)($|[./_-])", host + path)
    return host, path, None, "block" if bad else "allow"


def test_url_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, "http://a.org/x", None), (0, "http://a.org/x", None)]
    out = url_rules.judge(pages(spark, rows, "host string, path string, key string, rule string, verdict string, token string"), url_rules.LISTED + url_rules.PATTERNS)
    assert sorted((tuple(r)[:5] for r in out.collect()), key=str) == sorted(((i, *rule_of(u)) for i, u, _ in rows), key=str)


def test_url_rules_without_literals_and_ties(spark):
    rules = [url_rules.Rule("block", r"\d{4}", ()), url_rules.Rule("block", "^a", ("a",)), url_rules.Rule("allow", "^a", ("a",))]
    rows = [(1, "http://x/2024", None), (2, "http://a/", None), (3, "http://b/", None)]
    out = {r.page_id: (r.verdict, r.pattern) for r in url_rules.judge(pages(spark, rows), rules).collect()}
    assert out == {1: ("block", r"\d{4}"), 2: ("block", "^a"), 3: ("allow", None)}


def test_url_rules_use_no_python(spark, capsys):
    url_rules.judge(pages(spark, [(1, "http://a.org/x", None)]), url_rules.LISTED).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_url_rules_empty(spark):
    assert url_rules.judge(empty(spark, PAGES), url_rules.LISTED).count() == 0


def article(body: str, around: str = "") -> str:
    return f'<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu words</a></li></ul></nav><!-- ad 1 --><div class="ad">buy</div>{around}<article>{body}</article><footer>&copy; x</footer></body></html>'


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_article_text(spark):
    rows = [
        (1, "http://h/1", article("<h1>A &amp;\n B</h1><p>one  <b>two</b>&nbsp;three<br>four<p>five<ul><li>x</li></ul>")),
        (2, "http://h/2", article('<header><h1>T</h1></header><p>text</p><aside>side</aside><div class="share-bar">s</div><form><input>f</form><p>end</p><section id="comments"><p>hi</p></section>')),
        (3, "http://h/3", None), (4, None, ""), (5, "odd", "just text &lt;b&gt; a < b"), (6, "http://h/6", "<article><p>open <b>never closed<p>next"),
        (7, "http://h/7", article("<p>1 < 2</p><script>if (a < b) { '</p>' }</script><p data-x='a > b'>q</p><textarea>no</textarea>")),
        (1, "http://h/1", "<main><p>again</p></main>"),
    ]
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(pages(spark, rows, "text string, host string, kinds string, page_key string")).collect())
    want = [(1, "A & B\none two three four\nfive\nx"), (1, "again"), (2, "T\ntext\nend"), (3, ""), (4, ""), (5, "just text <b> a < b"), (6, "open never closed\nnext"), (7, "1 < 2\nq")]
    assert got == [(i, t, len(t)) for i, t in want]


def plain(i: int, common: str) -> str:
    return f"<body><div><p>{common}</p><div>{prose(30, 50 + i)}</div><p>{common} last{i} words{i}</p></div></body>"


@pytest.mark.parametrize("group", [4, 1000])
def test_repeated_runs_go_where_markup_decides_nothing(spark, monkeypatch, group):
    """With one page in most groups as with one group: shared runs are found across."""
    monkeypatch.setattr(html_text, "GROUP_PAGES", group)
    common = prose(20, 7)
    rows = [(i, "http://h/p", plain(i, common)) for i in range(12)] + [(90, "http://other/p", plain(90, common))]
    rows.append((91, "http://h/p", article(f"<p>{common}</p>")))  # an article keeps what others repeat
    got = texts(html_text.extract(pages(spark, rows)))
    for i in range(12):
        assert got[i] == f"{prose(30, 50 + i)}\nlast{i} words{i}"
    assert got[90] == f"{common}\n{prose(30, 140)}\n{common} last90 words90"  # alone on its host
    assert got[91] == common


@pytest.mark.parametrize("group", [4, 1000])
def test_articles_are_in_the_streams(spark, monkeypatch, group):
    """Blocks of articles go by their runs, however these are cut into blocks; and what
    articles hold counts where markup decides nothing."""
    monkeypatch.setattr(html_text, "GROUP_PAGES", group)
    a, b, teaser = prose(12, 7), prose(14, 8), prose(15, 9)
    rows = [(i, "http://news/", article(f"<h1>{prose(9, 100 + i)}</h1>" + (f"<p>{a}</p><div>{b}</div>" if i % 2 else f"<p>{a} {b}</p>") + f"<p>{b} last{i}</p>")) for i in range(8)]
    rows.append((20, "http://front/", f"<body><div>{teaser}</div><div>{prose(9, 300)}</div></body>"))
    rows += [(21 + i, "http://front/", article(f"<p>{prose(9, 400 + i)}</p>" + (f"<p>{teaser}</p>" if i < 1 else ""))) for i in range(9)]
    got = texts(html_text.extract(pages(spark, rows)))
    for i in range(8):
        assert got[i] == f"{prose(9, 100 + i)}\n{b} last{i}"
    assert got[20] == prose(9, 300)
    assert got[21] == f"{prose(9, 400)}\n{teaser}"


def texts_by_brute_force(rows: list[tuple]) -> dict[int, str]:
    """Runs as tuples of words, each page's beside every other's."""
    text, run = html_text.TEXT, html_text.RUN
    cut = {i: (url, tuple(html_text.blocks(html))) for i, url, html in rows}

    def places(some):
        tokens, owner = [], []
        for j, (k, t) in enumerate(some):
            words = ([None] if j and (k == text) != (some[j - 1][0] == text) else []) + t.split(" ")
            tokens, owner = tokens + words, owner + [j] * len(words)
        return tokens, owner, {x: tuple(tokens[x : x + run]) for x in range(len(tokens) - run + 1) if None not in tokens[x : x + run]}

    out = {}
    for i, (url, some) in cut.items():
        others = {y for u, y in cut.values() if u == url}
        n = len(others)
        needed, articles = max(-(-n // 10), 2), max(-(-n // 2), min(n, 5), 3)
        tokens, owner, runs = places(some)
        told = [(o, {r for x, r in p.items()}, {r for x, r in p.items() if y[o[x]][0] == text}) for y in others for _, o, p in [places(y)]]
        gone = set()
        for x, r in runs.items():
            inside = some[owner[x]][0] == text
            if sum(r in (c if inside else b) for _, b, c in told) >= (articles if inside else needed):
                gone |= set(range(x, x + run))
        lines = []
        for j, (k, t) in enumerate(some):
            mine = [x for x, o in enumerate(owner) if o == j and tokens[x] is not None]
            left = [tokens[x] for x in mine if x not in gone]
            if k == text and left and sum((text, t) in y for y in others) < articles:
                lines.append(t)
            if k == html_text.OPEN and left:
                lines.append(" ".join(left))
        out[i] = "\n".join(lines)
    return out


@pytest.mark.parametrize("group", [3, 1000])
def test_texts_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(html_text, "GROUP_PAGES", group)
    rng = np.random.default_rng(5)
    said = [prose(int(n), 900 + i) for i, n in enumerate(rng.integers(1, 14, 12))]
    rows = []
    for i in range(60):
        body = "".join(f"<{tag}>{' '.join(said[int(x) % 12] if x < 40 else prose(6, 1000 + 60 * i + int(x)) for x in rng.integers(0, 44, int(rng.integers(1, 4))))}</{tag}>" for tag in rng.choice(["p", "div", "li", "nav", "article", "article"], 6))
        rows.append((i, f"http://h{i % 3 if i < 50 else i % 5 + 9}/", body))
    rows += [(100 + i, url, html) for i, url, html in rows[:20]]
    got = texts(html_text.extract(pages(spark, rows).repartition(3)))
    want = texts_by_brute_force(rows)
    assert got == want
    assert sum(len(x) for x in got.values()) < 0.9 * sum(len(t) for _, _, html in rows for k, t in html_text.blocks(html) if k != html_text.REJECTED)


def test_shared_runs_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(50):
        tokens, page = rng.integers(0, 3, 120), np.sort(rng.integers(0, 5, 120))
        want = [any((tokens[i : i + 4] == tokens[j : j + 4]).all() and page[i] != page[j] for j in range(117)) if i < 117 else False for i in range(120)]
        got = html_text.shared_runs(np.r_[tokens, -1, -2, -3, -4], np.r_[page, [9] * 4], 4)[:120]
        assert list(got[:117]) == want[:117]


def test_page_texts_empty(spark):
    assert html_text.extract(empty(spark, PAGES)).count() == 0


@pytest.mark.parametrize(
    "html",
    [
        '<body class="post has-sidebar"><p>text</p></body>', '<body class="no-sidebar"><p>text</p></body>', '<article class="post comments-open"><p>text</p></article>', '<main class="with-sidebar"><p>text</p></main>',
        '<article class="entry header-fixed"><p>text</p></article>', '<body class="sidebar"><article id="comments"><p>text</p></article></body>', '<div class="has-sidebar unrelated"><p>text</p></div>', '<div data-id="ad" data-role="banner"><p>text</p></div>', '<div title="see class=ad"><p>text</p></div>',
        '<article><p class="notice">gone<p>text</article>', '<article><ul><li class="share">gone<li>text</ul></article>', '<article><p class="ad">gone<div>text</div></article>', '<article><table><tr class="ad"><td>gone<tr><td>text</table></article>', '<article><dl><dt class="ad">gone<dd>text</dl></article>',
        '<article><ul><li class="ad">gone<ul><li>gone</ul>gone<li>text</ul></article>', '<article><div class="top-banner">gone</div><div class="share-bar">gone</div><div class="x AD">gone</div><div id="comments-list">gone</div><nav>gone</nav><p>text</article>',
    ],
)
def test_names_and_open_elements(html):
    assert [t for k, t in html_text.blocks(html) if k != html_text.REJECTED] == ["text"]


@pytest.mark.parametrize("group", [4, 1000])
def test_copies_and_rare_quotes_stay(spark, monkeypatch, group):
    """Copied pages without an article keep their texts, as does a paragraph that two
    of many pages quote; what every page holds goes, in articles as whole blocks."""
    monkeypatch.setattr(html_text, "GROUP_PAGES", group)
    menu, quote, notice = prose(20, 7), prose(30, 8), prose(12, 9)
    rows = [(i, f"http://copy/{i}", f"<body><p>{prose(40, 70)}</p><p>{prose(30, 71)}</p></body>") for i in range(3)]
    rows += [(10 + i, f"http://h/{i}", f"<body><p>{menu}</p><div>{prose(30, 100 + i)}</div>{f'<p>{quote}</p>' if i < 2 else ''}</body>") for i in range(30)]
    rows += [(50 + i, f"http://news/{i}", article(f"<p>{prose(20, 200 + i)}</p><p>{notice}</p>" + (f"<p>{quote}</p>" if i < 2 else "") + f"<p>{notice} last{i}</p>")) for i in range(8)]
    rows += [(60 + i, f"http://two/{i}", article(f"<p>{prose(20, 300 + i)}</p><p>{notice}</p>")) for i in range(2)]
    rows += [(70 + i, "http://mixed/", f"<body><article><p>{prose(20, 400 + i)}</p><p>{notice}</p></article><p>{prose(9, 500 + i)}</p></body>") for i in range(6)]
    got = texts(html_text.extract(pages(spark, rows)))
    assert len(got) == len(rows)
    for i in range(3):
        assert got[i] == f"{prose(40, 70)}\n{prose(30, 71)}"
    for i in range(30):
        assert got[10 + i] == prose(30, 100 + i) + (f"\n{quote}" if i < 2 else "")
    for i in range(8):
        assert got[50 + i] == prose(20, 200 + i) + (f"\n{quote}" if i < 2 else "") + f"\n{notice} last{i}"
    for i in range(2):
        assert got[60 + i] == f"{prose(20, 300 + i)}\n{notice}"
    for i in range(6):
        assert got[70 + i] == f"{prose(20, 400 + i)}\n{prose(9, 500 + i)}"
