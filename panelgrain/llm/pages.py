"""Main text of web pages: blocks from the markup, boilerplate voted by a suffix array of each host's pages."""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, table, written

# Element names of HTML by what they mean for the text.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CHROME = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "svg", "math", "canvas", "audio", "video", "object", "map", "datalist"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav",
    "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
MAIN = {"article", "main"}
# A class, id or role with one of these words marks an element that is not the article.
NOT_ARTICLE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "notification", "overlay", "pagination", "popup", "promo", "related", "replies", "search", "share", "sharing",
    "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=\s|=|/|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
PART = re.compile(r"[A-Za-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

# Pages of one host that are held together; a repeat is this many words at least, on this many pages.
GROUP, LEAST_WORDS, LEAST_PAGES = 512, 5, 3
# A repeat is on one in so many of the host's distinct pages at least; it goes where so many tenths of a block are repeats.
ONE_IN, TENTHS = 1024, 9


def _marked(attributes: str) -> bool:
    if HIDDEN.search(attributes):
        return True
    for groups in NAMES.findall(attributes):
        words = PART.findall(CAMEL.sub(" ", "".join(groups)))
        if any(w.lower() in NOT_ARTICLE for w in words):
            return True
    return False


def blocks(page: str) -> tuple[list[str], list[str], list[str]]:
    """The text blocks of a page in three lists: inside an article or main element, undecided, and chrome.

    White space inside a block is one blank; character references are decoded; empty blocks are left out.
    """
    found: tuple[list[str], list[str], list[str]] = ([], [], [])
    text: list[str] = []
    depth, kind = 0, 1  # open article or main elements
    skip: list[str] = []  # open elements inside a chrome element, the chrome element first
    at, size = 0, len(page)
    lowered = None

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                found[2 if skip else kind].append(" ".join(words))

    while at < size:
        match = TAG.search(page, at)
        if match is None:
            text.append(page[at:])
            break
        if match.start() > at:
            text.append(page[at : match.start()])
        at = match.end()
        name = match.group(2)
        if name is None:
            if match.group(0).startswith("<![CDATA["):
                text.append(html.escape(match.group(0)[9:-3]))
            continue
        name, closing = name.lower(), match.group(1) == "/"
        if name in RAW and not closing:
            lowered = page.lower() if lowered is None else lowered
            end = lowered.find(f"</{name}", at)
            if end < 0:
                break
            close = page.find(">", end)
            at = size if close < 0 else close + 1
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK:
            flush()
        if closing:
            if name in skip:
                last = len(skip) - 1 - skip[::-1].index(name)
                if last == 0:
                    flush()
                del skip[last:]
            elif not skip and name in MAIN and depth:
                depth -= 1
                kind = 0 if depth else 1
            continue
        if name in VOID:
            continue
        if skip:
            # An article starts anew even if a menu before it was never closed; a paragraph ends at the next block.
            if name in MAIN and not depth and skip[0] in ("nav", "menu", "header") and not _marked(match.group(3)):
                flush()
                skip.clear()
            elif name in BLOCK and skip == ["p"]:
                flush()
                skip.clear()
            else:
                if not match.group(3).endswith("/") and not (name == "p" and skip[-1] == "p"):
                    skip.append(name)
                continue
        if name in CHROME or (name not in ("html", "body") and match.group(3) and _marked(match.group(3))):
            if not match.group(3).endswith("/"):
                flush()
                skip.append(name)
        elif name in MAIN:
            depth += 1
            kind = 0
    flush()
    return found


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes, and how many tokens each shares with the one before it."""
    n = len(tokens)
    if n == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    levels, step = [rank], 1
    while True:
        follow = np.full(n, -1, dtype=np.int64)
        follow[: max(0, n - step)] = rank[step:]
        order = np.lexsort((follow, rank))
        new = np.concatenate(([0], np.cumsum((rank[order][1:] != rank[order][:-1]) | (follow[order][1:] != follow[order][:-1]))))
        if new[-1] == n - 1 or step >= n:
            break
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        levels.append(rank)
        step *= 2
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left < n) & (right < n)
        same = np.zeros(n - 1, dtype=bool)
        same[inside] = levels[k][left[inside]] == levels[k][right[inside]]
        # A rank of level k stands for 2 ** k tokens, or for all that is left; separators make the latter unequal.
        shared[1:][same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    return order, shared


def token_hashes(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash of each token; tokens hold no blank."""
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(" ".join(tokens).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    blanks = np.flatnonzero(data == 32)
    return K.span_hash(K.prefix_hash(K.BYTE_VALUES[data]), np.concatenate(([0], blanks + 1)), np.concatenate((blanks, [len(data)])))


def _indexed(streams: list[list[str | None]], least_words: int):
    """The words' numbers, the tokens of all streams in a row (no two ends are equal), the page of each, their suffixes in order, and
    which of these begin with the same `least_words` tokens: a number for each, and the first of each number."""
    number: dict[str, int] = {}
    flat = []
    for stream in streams:
        for t in (*stream, None):
            flat.append(-1 - len(flat) if t is None else number.setdefault(t, len(number)))
    tokens, page = np.array(flat, dtype=np.int64), np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    order, shared = suffix_array(tokens)
    new = shared < least_words
    new[:1] = True
    return number, tokens, page, order, np.cumsum(new) - 1, order[new]


def _names(number: dict[str, int], tokens: np.ndarray, first: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places in `first` have `least_words` tokens before the block's end, and a hash of these tokens."""
    ends = np.concatenate(([0], np.cumsum(tokens < 0)))
    whole = first + least_words <= len(tokens)
    whole[whole] = ends[first[whole] + least_words] == ends[first[whole]]
    hashes = np.zeros(len(tokens), dtype=np.uint64)
    hashes[tokens >= 0] = token_hashes(list(number))[tokens[tokens >= 0]]
    names = np.zeros(len(first), dtype=np.int64)
    names[whole] = K.gram_hash(hashes, least_words)[first[whole]].view(np.int64)
    return whole, names


def repeated(
    streams: list[list[str | None]], least_words: int = LEAST_WORDS, least_pages: int = LEAST_PAGES, texts: list[int] | None = None, known: np.ndarray | None = None
) -> list[np.ndarray]:
    """For each page's token stream, which tokens lie in a substring of `least_words` that `least_pages` distinct pages have; None ends a block.

    Pages of equal `texts` count as one. With `known` (hashes of substrings of `least_words` tokens) these are the
    repeats, whatever the streams at hand hold.
    """
    number, tokens, page, order, run, first = _indexed(streams, least_words)
    covered = np.zeros(len(tokens) + 1, dtype=np.int64)
    if len(order):
        if known is None:
            owner = np.unique(page if texts is None else np.array(texts, dtype=np.int64)[page], return_inverse=True)[1]
            pairs = np.unique(run * len(streams) + owner[order])
            found = np.bincount(pairs // len(streams), minlength=run[-1] + 1) >= least_pages
        else:
            whole, names = _names(number, tokens, first, least_words)
            found = whole & np.isin(names, known)
        start = order[found[run]]
        np.add.at(covered, start, 1)
        np.add.at(covered, np.minimum(start + least_words, len(tokens)), -1)
    inside = np.cumsum(covered[:-1]) > 0
    ends = np.cumsum([len(s) + 1 for s in streams])
    return [inside[e - len(s) - 1 : e - 1] for e, s in zip(ends.tolist(), streams, strict=True)]


def entries(streams: list[list[str | None]], least_words: int = LEAST_WORDS) -> list[np.ndarray]:
    """For each page's token stream, the hashes of the distinct substrings of `least_words` that one suffix array of all streams finds in it."""
    number, tokens, page, order, run, first = _indexed(streams, least_words)
    whole, names = _names(number, tokens, first, least_words)
    kept = whole[run]
    pairs = np.unique(page[order][kept] * (len(first) + 1) + run[kept])
    at = np.searchsorted(pairs, np.arange(len(streams) + 1) * (len(first) + 1))
    return np.split(names[pairs % (len(first) + 1)], at[1:-1]) if len(streams) else []


def _text_key(main: list[str], rest: list[str], chrome: list[str]) -> int:
    """A hash of a page's text: without chrome, unless chrome is all it has."""
    text = "\n".join((*main, "", *rest)) if main or rest else "\n".join(("", "", *chrome))
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _keys(batches):
    """(host, key) of every page; key is the same for pages of equal text."""
    for batch in batches:
        keys = [_text_key(*blocks(page.as_py())) for page in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], names=["host", "key"])


def _streams(rest: list[str], chrome: list[str]) -> list[str | None]:
    """The words of a page's blocks outside articles, None after each block."""
    return [w for b in (*rest, *chrome) for w in (*b.split(" "), None)]


def _windows(batches):
    """(host, key, windows) of every page: its entries of LEAST_WORDS tokens in the suffix array of its host's pages at hand, outside articles."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            keys, pages, windows = [], {}, [None] * part.num_rows
            for k, (host, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                main, rest, chrome = blocks(text)
                keys.append(_text_key(main, rest, chrome))
                pages.setdefault(host, []).append((k, _streams(rest, chrome)))
            for own in pages.values():
                for (k, _), found in zip(own, entries([s for _, s in own]), strict=True):
                    windows[k] = found
            offsets = np.concatenate(([0], np.cumsum([len(w) for w in windows])))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.int64()), K.lists(K.gathered(windows, np.int64), offsets)], names=["host", "key", "windows"])


def _parse(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            main, rest, chrome, keys = [], [], [], []
            for page in part.column(3).to_pylist():
                a, b, c = blocks(page)
                main.append("\n".join(a) if a else None)
                rest.append(b)
                chrome.append(c)
                keys.append(_text_key(a, b, c))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), part.column(4), part.column(5), pa.array(main, pa.string()), pa.array(rest, pa.list_(pa.string())), pa.array(chrome, pa.list_(pa.string())), pa.array(keys, pa.int64())],
                names=["page_id", "url", "host", "part", "large", "main", "rest", "chrome", "key"],
            )


def _main_texts(rows: list[dict], known: np.ndarray | None = None) -> pa.RecordBatch:
    """One group of pages of a host: what is marked as article stays; undecided blocks go where repeats cover them, but for a tenth.

    A host of one group counts its repeats here; for larger ones `known` has those of the whole host.
    """
    streams = [_streams(r["rest"], r["chrome"]) for r in rows]
    keys = [r["key"] for r in rows]
    marks = repeated(streams, LEAST_WORDS, max(LEAST_PAGES, -(-len(set(keys)) // ONE_IN)), keys, known)
    out, seen = [], []
    for r, mark in zip(rows, marks, strict=True):
        seen.append(int(mark.sum()))
        if r["main"] is not None:
            out.append(r["main"])
            continue
        kept, at = [], 0
        for block in r["rest"]:
            words = block.split(" ")
            here = mark[at : at + len(words)]
            at += len(words) + 1
            own = block if 10 * int(here.sum()) < TENTHS * len(words) else " ".join(w for w, m in zip(words, here.tolist(), strict=True) if not m)
            if own:
                kept.append(own)
        out.append("\n".join(kept))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r["page_id"] for r in rows], pa.int64()),
            pa.array([r["url"] for r in rows], pa.string()),
            pa.array(out, pa.string()),
            pa.array([len(t) for t in out], pa.int64()),
            pa.array(seen, pa.int64()),
        ],
        names=["page_id", "url", "text", "n_chars", "n_repeated"],
    )


def _vote(batches):
    """Rows come by group, a large host's repeats before its pages."""
    group, known, key, large = [], [], None, False
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            for row in batch.slice(i, 256).to_pylist():
                now = row["host"], row["part"]
                if now != key:
                    if group:
                        yield _main_texts(group, np.array(known, dtype=np.int64) if large else None)
                    group, known, key = [], [], now
                if row["known"] is not None:
                    known.append(row["known"])
                else:
                    group.append(row)
                    large = row["large"]
    if group:
        yield _main_texts(group, np.array(known, dtype=np.int64) if large else None)


def host_repeats(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """(host, part, known): the repeats of each host of `groups`, for each of its groups.

    A suffix array of each 256 pages at hand finds the distinct five-word substrings outside articles; their hashes name
    them, by which the arrays of a host are merged. A page whose text has n equal ones counts as 1 / n, so a sum is the number
    of distinct pages.
    """
    many = pages.join(groups.select("host"), "host").select("host", "html")
    keys = written(many.mapInArrow(_keys, "host string, key long").groupBy("host", "key").agg(F.count("*").alias("same")), "texts")
    least = keys.groupBy("host").agg(F.greatest(F.lit(LEAST_PAGES), F.ceil(F.count("*") / ONE_IN)).alias("least"))
    windows = many.mapInArrow(_windows, "host string, key long, windows array<long>").join(keys.where("same > 1"), ["host", "key"], "left")
    each = windows.select("host", F.explode("windows").alias("known"), (F.lit(1.0) / F.coalesce("same", F.lit(1))).alias("weight"))
    found = each.groupBy("host", "known").agg(F.round(F.sum("weight"), 3).alias("pages")).join(least, "host").where("pages >= least")
    found = written(found.select("host", "known"), "repeats")
    return found.join(groups, "host").select("host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"), "known")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_repeated for every row of pages.

    Blocks come from the markup: menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles, comments and hidden elements are chrome, by element name or by a word of class, id, role or label. If a page
    has an article or main element, the blocks inside it are its text, whole. For other pages the
    host's pages decide: the token streams of all blocks outside articles are concatenated and a suffix array
    finds substrings of five words or more on three distinct pages or more, and on one in 1024 of the host's;
    pages of equal text count as one. Where they cover nine tenths of a block or more they are removed and the
    words between them stay; other blocks, such as sentences with a common phrase, stay whole.
    n_repeated counts a page's words that such substrings cover, chrome included.

    A host with over 512 pages is split by a hash into groups of about 512, so a host with a third of all pages
    takes as many tasks as it needs. Its repeats are counted over the whole host before, by suffix arrays of its pages as they lie, whose
    entries are added up, and sent to every group: groups bound memory and decide nothing. Null html counts as empty, a null url
    as one host; rows that share a page_id each get a result. Extra columns are not read. An empty table
    gives no rows.
    """
    address = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1))
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", address.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    groups = source.groupBy("host").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("groups"))
    groups = written(groups.where("groups > 1"), "hosts")
    dealt = source.join(groups, "host", "left").select("page_id", "url", "host", "html", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("groups", F.lit(1))).alias("part"), F.col("groups").isNotNull().alias("large"))
    shape = "page_id long, url string, host string, part long, large boolean, main string, rest array<string>, chrome array<string>, key long"
    parsed = dealt.mapInArrow(_parse, shape)
    every = parsed.unionByName(host_repeats(source, groups), allowMissingColumns=True)
    every = every.repartition("host", "part").sortWithinPartitions("host", "part", F.col("known").isNull(), "page_id", "url")
    return every.mapInArrow(_vote, "page_id long, url string, text string, n_chars long, n_repeated long")


@query("op7_main_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
