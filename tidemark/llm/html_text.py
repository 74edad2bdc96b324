"""Main text of web pages, with boilerplate found by suffix arrays per host.

A page is cut into blocks (paragraphs, headings, list items, ...) in page order.
Some blocks are decided by their markup: what stands in ``<article>`` or
``<main>`` is text; scripts, styles, menus, headers, footers, sidebars, forms and
elements whose class, id or role is a name of adverts, notices, comments and the like
are not, in an article neither; such a name never rejects a whole page, main or
article. End tags that HTML lets a page leave out are put in. The token streams of all
blocks, articles and what markup rejects included, are concatenated page by page for each
host, and a suffix array of that string counts on how many distinct pages every run of
``RUN`` tokens stands, and in how many articles. No run goes over the edge of an article.
Tokens covered by runs that at least ``SHARE`` of the host's distinct pages hold, and two
pages, are boilerplate; the other runs of undecided blocks are kept as text. Pages
of a host with the same blocks are one page, so copies take nothing from each other.

In an article only whole blocks go: those that stand in the articles of
``ARTICLE_SHARE`` of the host's distinct pages, and of ``ARTICLES`` pages (of all, if a
host has fewer, but three at least), and those whose tokens are all covered by runs that
stand in so many articles. A sentence that some articles share is text in all of them.

A host's pages may be a third of all. They are dealt out over groups of about
``GROUP_PAGES`` pages and ``GROUP_CHARS`` characters, each with its own suffix array. A run
that a share of the host's pages holds is held by that share of the pages of some group:
such runs are the candidates. Their pages are then counted over the whole host by the
hashes of the runs, so pages of different groups count together.

Defined results: a null html is empty and gives the empty text; a null or odd url
has the empty host; pages of a host with equal blocks count as one page for sharing, and
every row gets its text; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import batches, materialize, partition_id, rows_of, text_or_empty
from tidemark.llm.url_rules import host_and_path

RUN = 8
GROUP_PAGES, GROUP_CHARS = 250, 8_000_000
MET = 1_000_000  # contents that a task of the cutting remembers
SHARE, ARTICLE_SHARE, ARTICLES = 0.1, 0.5, 5

#: Markup, comment, or text up to the next markup.
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/]?[A-Za-z][^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*>|<[!?][^>]*>|[^<]+|<", re.S)
TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
#: name and value of an attribute, in order, so that no value is read as a name
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMING = {"class", "id", "role"}
SPACE = re.compile(r"\s+")

#: Fixed values of HTML: elements whose content is no markup, that have no content, and that start a block.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements that an end tag may leave open.
OPTIONAL_END = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot", "b", "i", "em", "strong", "span", "a", "u", "font", "small"}
#: Start tags that end an open element: which ones, and the elements that hide them.
HIDES = {"table", "button", "section", "article", "main", "aside", "nav", "header", "footer", "form", "blockquote", "figure", "fieldset", "body", "html"}
ENDS_P = BLOCK - {"body", "caption", "head", "html", "option", "select", "tbody", "td", "tfoot", "th", "thead", "tr"}
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, HIDES | {"ul", "ol", "menu"}),
    **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, HIDES | {"dl"})),
    **dict.fromkeys(("td", "th"), ({"td", "th"}, {"table", "tr"})),
    "tr": ({"tr"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot"}, {"table"})),
    "option": ({"option"}, {"select"}),
}
HIDES_P = {"button", "caption", "td", "th", "table", "body", "html"}
#: Rejected elements, and names in class, id or role that reject any element but those of KEPT: a listed
#: word, also in the plural or with words before or after it that only say where it stands or what it holds.
BAD_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset"}
KEPT = {"html", "body", "main", "article"}
_WORDS = r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|promos|promotions?|related|replies|reply|respond|share|sharing|sidebar|signup|social|sponsor|sponsors|sponsored|subscribe|toolbar|widget)"
_BEFORE = r"(?:(?:site|page|global|main|top|bottom|left|right|upper|lower|primary|secondary|mobile|sticky|article|post|entry|wp|js)[-_]+)"
_AFTER = r"(?:[-_]+(?:area|bar|block|box|button|buttons|container|content|group|holder|icons|inner|item|items|label|links?|list|outer|overlay|panel|posts|section|slot|text|thread|title|top|unit|widget|wrap|wrapper|\d+))"
BAD_NAME = re.compile(rf"{_BEFORE}{{0,2}}{_WORDS}(?:[-_]+{_WORDS})*{_AFTER}{{0,2}}", re.I)
GOOD_TAGS = {"article", "main"}

TEXT, REJECTED, OPEN = 1, 0, 2


def rejected_by_name(piece: str, tag: str) -> bool:
    """Whether a start tag's whole class, id or role names reject its element."""
    if tag in KEPT:
        return False
    for name, a, b, c in ATTRIBUTE.findall(piece, len(tag) + 1):
        if name.lower() in NAMING and any(BAD_NAME.fullmatch(word) for word in (a or b or c).split()):
            return True
    return False


def open_before(stack: list[tuple[str, int, int]], names: set[str], hides: set[str]) -> int | None:
    """The place in the stack of the innermost open element of these names, if none hides it."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in names:
            return i
        if stack[i][0] in hides:
            return None
    return None


def blocks(page: str) -> list[tuple[int, str]]:
    """(TEXT, REJECTED or OPEN, text) of a page's non-empty blocks, in order."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int, int]] = []  # tag, rejecting elements and articles from the root to here
    bad = good = 0
    raw = ""  # the raw element that the pieces are in

    def close() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(held))).strip() if held else ""
        held.clear()
        if text:
            out.append((REJECTED if bad else TEXT if good else OPEN, text))

    for match in PIECE.finditer(page):
        piece = match[0]
        if piece[0] != "<" or piece == "<":
            if not raw:
                held.append(piece)
            continue
        tag = TAG.match(piece)
        if tag is None:
            continue
        end, name = tag[1], tag[2].lower()
        if raw:
            if end and name == raw:
                raw = ""
            continue
        if not end and name in RAW:
            raw = "" if piece.endswith("/>") else name
            continue
        if name in BLOCK:
            close()
        elif name == "br":
            held.append(" ")
        if not end:
            for names, hides in ([({"p"}, HIDES_P)] if name in ENDS_P else []) + ([ENDS[name]] if name in ENDS else []):
                i = open_before(stack, names, hides)
                if i is not None:
                    _, bad, good = stack[i]
                    del stack[i:]
        if name in VOID or piece.endswith("/>"):
            continue
        if not end:
            stack.append((name, bad, good))
            if name in BAD_TAGS and not (name == "header" and good) or rejected_by_name(piece, name):
                bad += 1
            elif name in GOOD_TAGS:
                good += 1
            continue
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                _, bad, good = stack[i]
                del stack[i:]
                break
            if stack[i][0] not in OPTIONAL_END and name in OPTIONAL_END:
                break  # a stray end tag does not close what holds it
    close()
    return out


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` tokens at least, and their ranks by
    them, by prefix doubling."""
    n, reach = len(tokens), 1
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    while reach < depth:
        step = min(reach, depth - reach)
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64)
        reach += step
    return np.argsort(rank, kind="stable"), rank


def pages_of_ranks(rank: np.ndarray, page: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place, on how many distinct pages its rank stands among the places ``at``."""
    pages = int(page.max()) + 1
    met = np.unique(rank[at] * pages + page[at]) // pages
    return np.bincount(met, minlength=int(rank.max()) + 1)[rank]


def pages_of_runs(tokens: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """On how many distinct pages the ``length`` tokens from each place occur.
    Separators (negative, all unequal) lie between articles and the rest, and pages."""
    if len(tokens) < length:
        return np.zeros(len(tokens), dtype=np.int64)
    return pages_of_ranks(suffix_array(tokens, length)[1], page, np.arange(len(tokens)))


def shared_runs(tokens: np.ndarray, page: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` tokens from each place occur on two distinct pages."""
    return pages_of_runs(tokens, page, length) > 1


def covered(shared: np.ndarray, length: int) -> np.ndarray:
    """Tokens that some shared run of ``length`` covers."""
    edge = np.zeros(len(shared) + length + 1, dtype=np.int64)
    at = np.flatnonzero(shared)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge)[: len(shared)] > 0


def stream_of(kinds: list[int], texts: list[str]) -> tuple[list[str | None], list[int]]:
    """A page's tokens with the number of their block; None where an article's text
    and other blocks meet and at the end."""
    tokens: list[str | None] = []
    owner: list[int] = []
    for i, (kind, text) in enumerate(zip(kinds, texts, strict=True)):
        if i and (kind == TEXT) != (kinds[i - 1] == TEXT):
            tokens.append(None)
            owner.append(-1)
        words = text.split(" ")
        tokens += words
        owner += [i] * len(words)
    return [*tokens, None], [*owner, -1]


class TokenIds(dict):
    """Token to hash, each worked out once; None, a gap, is negative."""

    def __missing__(self, word: str | None) -> int:
        self[word] = found = -1 if word is None else xxhash.xxh64_intdigest(word) >> 1
        return found


def ids_of(tokens: list[str | None], known: TokenIds) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))


def whole_runs(ids: np.ndarray) -> np.ndarray:
    """Whether the ``RUN`` tokens from each place have no gap among them. The last token is one."""
    return np.convolve(ids < 0, np.ones(RUN, dtype=int))[RUN - 1 :] == 0


def run_hashes(ids: np.ndarray) -> np.ndarray:
    """A hash of the ``RUN`` tokens from each place."""
    n = len(ids) - RUN + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(RUN if n > 0 else 0):
        h = (h ^ ids[j : j + n].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


PAGES = "page_id long, url string, host string, content binary, kinds array<int>, texts array<string>, lines array<long>, row long, first boolean, chars long"
LOCAL = "host string, hashes array<long>, others array<long>"
HITS = "row long, host string, hashes array<long>, inside array<boolean>"
PAGE = ["host", "content"]


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def cut_pages(pages: DataFrame) -> DataFrame:
    """Every page cut into blocks. ``first``: no earlier row of its task has the host and
    the blocks, so copies beside each other are shuffled once."""
    html = text_or_empty("html")
    host, _ = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), "html")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("content", pa.binary()), ("kinds", pa.list_(pa.int32())), ("texts", pa.list_(pa.string())), ("lines", pa.list_(pa.int64())), ("row", pa.int64()), ("first", pa.bool_()), ("chars", pa.int64())])
        met: set[bytes] = set()

        def cut() -> Iterator[tuple]:
            row = partition_id() << 40
            for batch in parts:
                for page_id, url, host, page in rows_of(batch):
                    some = blocks(page)
                    content = xxhash.xxh3_128_digest("\n".join(f"{k}{t}" for k, t in some))
                    lines = sorted({line_hash(t) for k, t in some if k == TEXT})
                    key = xxhash.xxh3_128_digest(content + host.encode())
                    first = key not in met
                    if len(met) == MET:
                        met.clear()
                    met.add(key)
                    yield page_id, url, host, content, [k for k, _ in some], [t for _, t in some], lines, row, first, sum(len(t) for _, t in some)
                    row += 1

        yield from batches(cut(), schema, 512)

    return materialize(rows.mapInArrow(run, PAGES), "html-pages", "zstd")


def hosts(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per host how many of its ``n`` distinct pages make a run and an article's block
    boilerplate (host, n, parts, opens, needed, articles); and the blocks that do (host, gone)."""
    contents = materialize(cut.where("first").select(*PAGE, "lines", "chars", F.array_contains("kinds", OPEN).alias("open")).dropDuplicates(PAGE), "html-contents", "zstd")
    share, half = F.ceil(F.col("n") * SHARE), F.ceil(F.col("n") * ARTICLE_SHARE)
    sizes = contents.groupBy("host").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.max("open").alias("opens"))
    parts = F.greatest(F.ceil(F.col("n") / GROUP_PAGES), F.ceil(F.col("chars") / GROUP_CHARS)).cast("int")
    sizes = sizes.select("host", "n", parts.alias("parts"), "opens", F.greatest(share, F.lit(2)).alias("needed"), F.greatest(half, F.least("n", F.lit(ARTICLES)), F.lit(3)).alias("articles"))
    sizes = materialize(sizes, "html-hosts")
    lines = contents.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages"))
    lines = lines.where("pages > 2").join(sizes.select("host", "articles"), "host").where("pages >= articles")
    # At most 1 / ARTICLE_SHARE times as many blocks as an article has reach the share.
    return sizes, materialize(lines.groupBy("host").agg(F.collect_list("line").alias("gone")), "html-lines")


def packed(rows: DataFrame) -> DataFrame:
    """``kinds`` and ``texts`` as one compressed column ``blocks``, for shuffles."""
    schema = StructType([f for f in rows.schema if f.name not in ("kinds", "texts")]).add("blocks", "binary")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in parts:
            found = zip(*(batch.column(c).to_pylist() for c in ("kinds", "texts")), strict=True)
            pressed = pa.array([press.compress("\n".join(f"{k}{t}" for k, t in zip(kinds, texts, strict=True)).encode()) for kinds, texts in found], pa.binary())
            yield batch.drop_columns(["kinds", "texts"]).append_column("blocks", pressed)

    return rows.mapInArrow(run, schema)


def unpacked(blocks: bytes) -> tuple[list[int], list[str]]:
    lines = zstandard.decompress(blocks).decode().split("\n")
    return [int(x[0]) for x in lines if x], [x[1:] for x in lines if x]


def runs_in_groups(cut: DataFrame, sizes: DataFrame) -> DataFrame:
    """A suffix array for each group of a host's pages: per group, the hashes of the runs
    that may be boilerplate of the host, and the ``others``: rows that repeat a page.

    A group with m of the host's n pages asks for the share m / n of the pages needed, as
    some group of the host must reach that. Runs of undecided blocks matter only to hosts
    that have such blocks."""
    dealt = packed(cut.where("first").select(*PAGE, "row", "kinds", "texts")).join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("content"), "parts").cast("int"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["content", "row"])
        again = group.duplicated("content")
        host, n, needed, articles, opens = (group[c].iloc[0] for c in ("host", "n", "needed", "articles", "opens"))
        others, group, known = group["row"][again], group[~again], TokenIds()
        ids, owners, inside = [], [], []
        for p, (kinds, texts) in enumerate(map(unpacked, group["blocks"])):
            tokens, owner = stream_of(kinds, texts)
            ids.append(ids_of(tokens, known))
            owners.append(np.full(len(tokens), p))
            inside.append(np.array([*(k == TEXT for k in kinds), False])[owner])
        stream, page, inside = np.concatenate(ids), np.concatenate(owners), np.concatenate(inside)
        gaps = stream < 0
        stream[gaps] = -np.arange(1, gaps.sum() + 1)
        whole = np.flatnonzero(whole_runs(stream))
        rank = suffix_array(stream, RUN)[1]
        share = lambda least: -(-int(least) * len(group) // int(n))
        told = pages_of_ranks(rank, page, np.flatnonzero(inside))[whole] >= share(articles)
        if opens:
            told |= pages_of_ranks(rank, page, np.arange(len(rank)))[whole] >= share(needed)
        return pd.DataFrame([(host, np.unique(run_hashes(stream)[whole[told]]), others.to_numpy())], columns=["host", "hashes", "others"])

    return materialize(dealt.groupBy("host", "part").applyInPandas(run, LOCAL), "html-local")


def runs_of(kinds: list[int], texts: list[str], known: TokenIds) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A page's tokens and the numbers of their blocks (-1: a gap); the places of its
    runs, their hashes and whether they stand in an article."""
    tokens, owner = stream_of(kinds, texts)
    ids, owner = ids_of(tokens, known), np.array(owner)
    places = np.flatnonzero(whole_runs(ids))
    return tokens, owner, places, run_hashes(ids)[places], (np.array(kinds, dtype=int) == TEXT)[owner[places]]


def hits(rows: DataFrame) -> DataFrame:
    """Per row (.., runs) those of the runs that its page holds, and whether in its article."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages() -> Iterator[tuple]:
            for batch in parts:
                known = TokenIds()
                for row, host, kinds, texts, runs in rows_of(batch):
                    _, _, _, hashes, inside = runs_of(kinds, texts, known)
                    found = np.isin(hashes, np.array(runs, dtype=np.int64))
                    held = np.unique(hashes[found])
                    yield row, host, held, np.isin(held, hashes[found & inside])

        yield from batches(pages(), pa.schema([("row", pa.int64()), ("host", pa.string()), ("hashes", pa.list_(pa.int64())), ("inside", pa.list_(pa.bool_()))]), 512)

    return rows.select("row", "host", "kinds", "texts", "runs").mapInArrow(run, HITS)


def boilerplate(cut: DataFrame, sizes: DataFrame) -> DataFrame:
    """The hashes of a host's boilerplate runs anywhere and in articles: (host, runs, article_runs)."""
    local = runs_in_groups(cut, sizes)
    wanted = local.select("host", F.explode("hashes").alias("hash")).distinct().groupBy("host").agg(F.collect_list("hash").alias("runs"))
    found = hits(cut.where("first").join(materialize(wanted, "html-candidates"), "host")).join(local.select(F.explode("others").alias("row")), "row", "left_anti")
    found = found.select("host", F.explode(F.arrays_zip("hashes", "inside")).alias("r")).groupBy("host", F.col("r.hashes").alias("hash"))
    found = found.agg(F.count("*").alias("pages"), F.count_if("r.inside").alias("inside")).join(sizes, "host")
    # collect_list leaves nulls out
    runs, inside = F.when(F.col("opens") & (F.col("pages") >= F.col("needed")), F.col("hash")), F.when(F.expr("inside >= articles"), F.col("hash"))
    found = found.groupBy("host").agg(F.collect_list(runs).alias("runs"), F.collect_list(inside).alias("article_runs"))
    return materialize(found.where("size(runs) + size(article_runs) > 0"), "html-common")


def left_texts(rows: DataFrame) -> DataFrame:
    """Texts of the pages without their hosts' boilerplate: (.., runs, article_runs, gone) to text."""

    def text_of(kinds: list[int], texts: list[str], runs: list[int], article_runs: list[int], dropped: set[int], known: TokenIds) -> str:
        kept = {i: [t] for i, (k, t) in enumerate(zip(kinds, texts, strict=True)) if k == TEXT and not (dropped and line_hash(t) in dropped)}
        if not (runs or article_runs):
            return "\n".join(t for i, (k, t) in enumerate(zip(kinds, texts, strict=True)) if k == OPEN or i in kept)
        tokens, owner, places, hashes, inside = runs_of(kinds, texts, known)
        starts = np.zeros(len(tokens), dtype=bool)
        starts[places] = np.where(inside, np.isin(hashes, np.array(article_runs, dtype=np.int64)), np.isin(hashes, np.array(runs, dtype=np.int64)))
        gone = covered(starts, RUN)
        left = np.bincount(owner[(owner >= 0) & ~gone], minlength=len(kinds))
        kept = {i: t for i, t in kept.items() if left[i]}
        for token, block, drop in zip(tokens, owner.tolist(), gone, strict=True):
            if token is not None and kinds[block] == OPEN and not drop:
                kept.setdefault(block, []).append(token)
        return "\n".join(" ".join(kept[i]) for i in sorted(kept))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages() -> Iterator[tuple]:
            for batch in parts:
                known = TokenIds()
                for page_id, url, kinds, texts, runs, article_runs, gone in rows_of(batch):
                    yield page_id, url, text_of(kinds, texts, runs or [], article_runs or [], set(gone or []), known)

        yield from batches(pages(), pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())]), 512)

    return rows.select("page_id", "url", "kinds", "texts", "runs", "article_runs", "gone").mapInArrow(run, "page_id long, url string, text string")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    cut = cut_pages(pages)
    sizes, lines = hosts(cut)
    out = left_texts(cut.join(boilerplate(cut, sizes), "host", "left").join(lines, "host", "left"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
