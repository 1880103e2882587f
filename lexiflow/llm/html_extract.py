"""HTML extraction: main text by markup, and a host suffix array for unmarked text.

A page is read into blocks in page order, each in one of three zones:

* ``main``: inside an article or main element, or, on a page with neither, inside an element whose class
  or id says content. Kept. Copies of one article on several pages of a host are content, so repetition
  never removes main text;
* ``chrome``: menus, headers, footers, sidebars, notices, adverts, forms and reader comments, by
  element, role or class name. Dropped, but a class alone is weak evidence: a main element inside such a
  wrapper is main text, and an article or content class inside it, or text of the main region inside it, is
  used if the page has no better main region;
* ``plain``: text without either mark. On a page with a main region it is furniture and
  dropped; on a page without one it is the only text there is, and the suffix array
  decides.

The suffix array takes the token streams of all blocks, main text too, of all pages of every host. Pages of a host with
the same blocks count as one, for main text also those with the same main text. They are dealt to shards of bounded size, and each shard
sorts the suffixes of its streams: suffixes with ``RUN`` tokens of one block in common are one substring, those with a whole block
and its end mark in common one block. What stands on at least ``MIN_SHARE`` of a shard's pages is a candidate (what
stands on that share of a host's pages does so in one of its shards at least), and all shards of the host count the candidates'
pages. Repeated substrings, and blocks shorter than a run, are boilerplate from ``MIN_PAGES`` distinct pages and ``MIN_SHARE`` of the
host's pages on. Covered stretches of plain blocks are cut out and the unique runs stay; a covered stretch of
``LONG_BLOCK`` tokens or more is text that several pages carry, and stays as well. Main text asks for more: only a whole block goes
(a notice or advert without any mark inside the article), if runs on ``MAIN_PAGES`` distinct main texts, and ``MIN_SHARE`` of them, cover all of it, it is
shorter than ``LONG_BLOCK``, and what goes is less than half of the page's main text, so no copy of an article is cut down.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.joins import broadcast_if_small, key_table_bytes
from lexiflow.session import materialize, materialize_measured

#: a plain block is boilerplate from so many distinct pages of its host on, if they are also this share of them
MIN_PAGES = 3
MIN_SHARE = 0.5
#: a whole block of main text is boilerplate from so many distinct main texts of its host on, if they are also that share
MAIN_PAGES = 6
#: a stretch of so many tokens is text, however often it occurs
LONG_BLOCK = 50
#: most tasks that the shards are dealt to
MAX_TASKS = 10_000
#: tokens of the shortest repeated substring that is cut out of a longer block
RUN = 8
SHARD_TOKENS = 250_000

# Element and class names.
# elements whose content is no markup: only their own end tag ends them
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
SKIPPED = RAW | {"head", "noscript", "template", "svg", "object", "math", "canvas", "audio", "video", "select"}
CHROME = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button"}
MAIN = {"article", "main"}
CONTAINERS = CHROME | MAIN | {"div", "section", "body", "html", "ul", "ol", "dl", "table", "tbody", "thead",
                              "tr", "td", "th", "fieldset", "figure", "details", "center", "span"}
BLOCKS = (CONTAINERS - {"span"}) | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre",
                                    "blockquote", "hr", "figcaption", "caption", "address", "summary",
                                    "legend", "hgroup", "title", "option"}
# Whole class names. Layout names are also given to wrappers of the page; the others never to the article.
_BEFORE = (r"(?:(?:site|page|main|global|top|bottom|left|right|primary|secondary|sub|blog|entry|post|article|story|wp|"
           r"block|user|reader|cookies?|gdpr|social|share|sharing|email|google|sticky|fixed|mobile|desktop)[_-])*")
_AFTER = (r"(?:[_-](?:links?|buttons?|btns?|bar|list|box|menu|nav|area|section|container|wrapper|wrap|banner|notice|"
          r"icons?|forms?|popup|modal|items?|block|inner|title|text|widgets?|slot|unit|label|overlay|posts?|articles?|"
          r"stories|body|thread|respond|reply|media|top|bottom|left|right|primary|secondary|\d+))*")
_LAYOUT = (r"banner|notices?|sidebar|menu|navbar|nav|navigation|breadcrumbs?|footer|header|masthead|popup|modal|widget|"
           r"toolbar|pagination")
_ASIDE = (r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|comments?|share|sharing|social|related|newsletter|"
          r"subscribe|subscription")
LAYOUT_CLASS = re.compile(rf"(?:^|\s){_BEFORE}(?:{_LAYOUT}){_AFTER}(?=$|\s)", re.IGNORECASE)
ASIDE_CLASS = re.compile(rf"(?:^|\s){_BEFORE}(?:{_ASIDE}){_AFTER}(?=$|\s)", re.IGNORECASE)
# "header" in a class inside the article means the article's own heading
HEADING_CLASS = re.compile(rf"(?:^|\s){_BEFORE}(?:header|masthead){_AFTER}(?=$|\s)", re.IGNORECASE)
# Inside the main region a class name is weaker still: these only, and words about cookies only with a kind of box.
_REGION = (r"ads?|advert\w*|sponsor\w*|comments?|share|sharing|social|related|newsletter|subscribe|"
           r"(?:cookies?|gdpr|consent)[_-](?:banner|notice|bar|popup|modal|overlay|consent)")
REGION_CLASS = re.compile(rf"(?:^|\s){_BEFORE}(?:{_REGION}){_AFTER}(?=$|\s)", re.IGNORECASE)
_FURNITURE = r"sidebar|menu|navbar|nav|navigation|breadcrumbs?|footer|popup|modal|widget|toolbar|pagination"
FURNITURE_CLASS = re.compile(rf"(?:^|\s){_BEFORE}(?:{_FURNITURE}){_AFTER}(?=$|\s)", re.IGNORECASE)
MAIN_CLASS = re.compile(
    r"(?:^|\s)(?:(?:main|page|post|entry|article|story)[_-])?(?:content|article|main|post|entry|story)"
    r"(?:[_-](?:content|body|text))?(?:$|\s)", re.IGNORECASE)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)")
_NO_DISPLAY = re.compile(r"style\s*=\s*[\"'][^\"']*display\s*:\s*none", re.IGNORECASE)
CHROME_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
               "alert", "menu", "menubar"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    # quotes count only after an equals sign; an attribute part never goes back, so a tag without end costs one pass
    r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:=\s*+"[^"]*"|=\s*+'[^']*'|[^<>])*+)>""", re.DOTALL)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE) for tag in RAW}
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in SKIPPED}
_TITLE = re.compile(r"<title[^>]*>([^<]*)", re.IGNORECASE)
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)

JOIN = "\n\n"


def _zone_of(tag: str, attrs: str, inside: str) -> str:
    """Zone of an element's content, given the zone around it.

    Besides main, plain and chrome: ``content`` by class; ``layout`` and ``aside`` for chrome by class, ``form`` inside a
    form that may be wrapped around the page, ``inner`` for a
    layout class inside a main region; ``held`` for an article inside ``layout``, ``last`` for one inside ``aside``
    or a chrome element, ``weak`` for a content class inside ``layout``; ``gone`` for what is not shown.
    """
    if inside == "gone":
        return inside
    by_class = inside in ("layout", "aside", "inner")
    region = inside in ("main", "content", "held", "last", "weak")
    role, names = "", []
    if attrs:
        if tag not in ("body", "html") and tag not in MAIN and (
                _HIDDEN.search(_QUOTED.sub("", attrs)) or _NO_DISPLAY.search(attrs)):
            return "gone"
        for m in _ATTR.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                role = value.lower()
            else:
                names.append(value)
    if inside == "chrome":
        return "last" if tag in MAIN or role in MAIN else inside
    if tag in CHROME and not (tag == "header" and region):
        return "form" if tag == "form" and inside in ("plain", "form") else "chrome"
    if tag in ("body", "html"):
        return inside
    if tag in MAIN or role in MAIN:
        if tag == "main" or role == "main" or not (by_class or inside == "weak"):
            return inside if inside in ("held", "last") and tag != "main" and role != "main" else "main"
        return {"layout": "held", "weak": "held", "aside": "last", "inner": "inner"}[inside]
    if role in CHROME_ROLE:
        return "chrome"
    if region:
        if any(REGION_CLASS.search(v) for v in names):
            return "aside"
        if any(FURNITURE_CLASS.search(v) for v in names):
            return "inner"
        return inside
    if any(ASIDE_CLASS.search(v) for v in names):
        return "aside"
    if any(LAYOUT_CLASS.search(HEADING_CLASS.sub(" ", v) if by_class else v) for v in names):
        return inside if by_class else "layout"
    if inside in ("plain", "layout", "form") and any(MAIN_CLASS.search(v) for v in names):
        return "weak" if inside == "layout" else "content"
    return inside


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(zone, text) of every block with text, in page order; zones main, chrome and plain."""
    blocks = _raw_blocks(page)
    size: dict[str, int] = {}
    for z, t, _ in blocks:
        size[z] = size.get(z, 0) + len(t)
    # text of a page with a main region that is neither main nor chrome is furniture; an article wrapped in chrome by
    # class, or text so wrapped in the main region, is main text only if there is none of the better kinds
    best = next((z for z in ("main", "held", "content", "inner", "plain", "form", "weak", "last") if z in size), "plain")
    if best == "main" and size.get("content", 0) > 2 * size["main"]:
        best = "content"  # the articles are teasers beside the content
    if best in ("plain", "form"):
        return [("plain" if z == best else "chrome", t) for z, t, _ in blocks]
    out = [("main" if z == best else "chrome", t) for z, t, _ in blocks]
    first = next(i for i, (z, _) in enumerate(out) if z == "main")
    if first and blocks[first - 1][0] == "plain" and blocks[first - 1][2] == "h1" and "h1" not in {
            tag for z, _, tag in blocks if z == best}:
        # the page's own heading may stand just before its article
        title = _TITLE.search(page)
        if title and blocks[first - 1][1] in " ".join(html.unescape(title[1]).split()):
            out[first - 1] = ("main", blocks[first - 1][1])
    return out


def _raw_blocks(page: str) -> list[tuple[str, str, str]]:
    """(zone, text, tag) of every block with text; the tag is that of its heading, if it began with one."""
    blocks: list[tuple[str, str, str]] = []
    stack: list[tuple[str, str, int]] = []  # open containers: (tag, zone around it, blocks before it)
    is_open: dict[str, int] = {}  # containers of a tag on the stack, so that stray end tags cost nothing
    endless: set[str] = set()  # skipped tags that no end tag follows any more
    parts: list[str] = []
    at, zone, skip = 0, "plain", ""
    own = ""  # zone of the open paragraph, heading or item, if its attributes give it another one
    heading = ""

    def close_block() -> None:
        nonlocal own, heading
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append((own or zone, text, heading))
            parts.clear()
        own = heading = ""

    def unclosed(left: list[tuple[str, str, int]]) -> None:
        """An article inside a chrome element that never ended was not meant to be in it."""
        for tag, around, before in left:
            if tag in CHROME and around != "chrome":
                blocks[before:] = [("held" if z == "last" else z, t, h) for z, t, h in blocks[before:]]

    place = 0
    while m := _MARKUP.search(page, place):
        place = m.end()
        if not skip and m.start() > at:
            parts.append(page[at:m.start()])
        if not skip:
            at = m.end()
        if m[2] is None:
            continue
        tag, closing, empty = m[2].lower(), m[1] == "/", m[3].endswith("/")
        if tag in RAW and not closing and not empty:
            end = _RAW_END[tag].search(page, place)
            place = end.end() if end else len(page)
            if not skip:
                at = place
                if tag in BLOCKS:
                    close_block()
                parts.append(" ")
            continue
        if skip:
            # inside a skipped element only its own end counts
            if closing and tag == skip:
                skip, at = "", m.end()
            elif skip == "head" and not closing and tag == "body":
                skip, at = "", m.end()
                stack.append((tag, zone, len(blocks)))
                is_open[tag] = is_open.get(tag, 0) + 1
            continue
        if tag in SKIPPED and not closing:
            if not empty and tag not in endless:
                parts.append(" ")
                if tag == "head" or _END[tag].search(page, place):
                    skip = tag
                else:
                    endless.add(tag)
            continue
        if tag in BLOCKS:
            close_block()
            if tag == "h1" and not closing:
                heading = tag
            if not closing and m[3] and tag not in CONTAINERS and _zone_of(tag, m[3], zone) in (
                    "chrome", "aside", "layout", "inner", "gone"):
                own = _zone_of(tag, m[3], zone)
        elif tag == "br":
            parts.append(" ")
        if tag in CONTAINERS and not empty:
            if not closing:
                inner = _zone_of(tag, m[3], zone)
                if inner != zone:
                    close_block()
                stack.append((tag, zone, len(blocks)))
                is_open[tag] = is_open.get(tag, 0) + 1
                zone = inner
            elif is_open.get(tag):
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                if stack[i][1] != zone:
                    close_block()
                unclosed(stack[i + 1:])
                zone = stack[i][1]
                for name, _, _ in stack[i:]:
                    is_open[name] -= 1
                del stack[i:]
    if not skip and at < len(page):
        # an unfinished tag at the very end is markup, not text
        rest = page[at:]
        cut = rest.rfind("<")
        if cut >= 0 and re.match(r"</?[a-zA-Z!]", rest[cut:]) and ">" not in rest[cut:]:
            rest = rest[:cut]
        parts.append(rest)
    close_block()
    unclosed(stack)
    return blocks


def _digest(blocks: list[tuple[str, str]]) -> str:
    return hashlib.blake2b("\x00".join(z + t for z, t in blocks).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _parse(batches):
    """Per page the kept blocks (``text``) and the others (``side``), joined by two line ends, which no block holds.

    ``content`` names all blocks, ``article`` the main ones (or all), ``fresh`` is the first row of a content in this task.
    """
    seen: set[tuple[str | None, str]] = set()
    kinds = (pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.bool_())
    for batch in batches:
        columns = [[] for _ in kinds]
        for page, host in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            got = page_blocks(page or "")
            main = [b for b in got if b[0] == "main"]
            content = _digest(got)
            for column, value in zip(columns, (
                    JOIN.join(t for z, t in got if z != "chrome"), JOIN.join(t for z, t in got if z == "chrome"),
                    bool(main), content, _digest(main) if main else content,
                    sum(t.count(" ") + 2 for _, t in got), (host, content) not in seen), strict=True):
                column.append(value)
            seen.add((host, content))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(3),
             *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
            names=["page_id", "url", "host", "text", "side", "has_main", "content", "article", "n", "fresh"])


def _blocks_of(packed: bytes) -> list[str]:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True).decode()
    return [t for t in raw.split(JOIN) if t]


def _packed(batches):
    """Text and side of every page as compressed bytes, for the shuffle."""
    for batch in batches:
        raw = [f"{text}{JOIN}{side}".encode() for text, side in zip(
            batch.column("text").to_pylist(), batch.column("side").to_pylist(), strict=True)]
        # the length comes first, as unpacking has to know it
        packed = [len(r).to_bytes(8, "little") + pa.compress(r, codec="zstd", asbytes=True) for r in raw]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("host", "shard", "content", "article")],
                                          pa.array(packed, pa.binary())],
                                         names=["host", "shard", "content", "article", "packed"])


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Suffix array of an integer sequence by prefix doubling; a round sorts only what is not yet in its place."""
    n = len(tokens)
    token = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    bits = int(token.max(initial=1)).bit_length()
    k = 62 // bits
    key = np.zeros(n, np.int64)
    for i in range(k):  # as many tokens as one number holds
        key <<= bits
        key[:max(n - i, 0)] |= token[i:]
    order = np.argsort(key)
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    members, key = order, key[order]
    while len(slots):
        # a suffix ranks by the first place of those that are equal so far
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[members] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        tied = ~first | ~np.concatenate([first[1:], [True]])
        slots, members = slots[tied], members[tied]
        after = members + k
        key = rank[members] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by_key = np.argsort(key)
        members, key = members[by_key], key[by_key]
        order[slots] = members
        k *= 2
    return order


def common_prefixes(tokens: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, counted up to ``most``."""
    n = len(tokens)
    out = np.zeros(n, np.int64)
    alive = np.arange(1, n)
    for depth in range(most):
        a, b = order[alive - 1] + depth, order[alive] + depth
        ok = (a < n) & (b < n)
        alive, a, b = alive[ok], a[ok], b[ok]
        alive = alive[tokens[a] == tokens[b]]
        out[alive] += 1
        if not len(alive):
            break
    return out


class Shard:
    """Token streams of one shard of a host; every block ends with its own end mark."""

    def __init__(self, rows: list[str], blocks: list[list[tuple[str, str]]], articles: list[str] | None = None):
        words: dict[str, int] = {}
        stream: list[int] = []
        self.spans: list[tuple[str, int, int, int]] = []  # (page content, block number, first, last + 1)
        mark = 0
        for row, page in zip(rows, blocks, strict=True):
            for i, (_, text) in enumerate(page):
                at = len(stream)
                stream += [words.setdefault(w, len(words) + 1) for w in text.split(" ")]
                self.spans.append((row, i, at, len(stream)))
                stream.append(mark)
        self.tokens = np.array(stream, np.int64)
        self.names = [""] + list(words)
        #: the main text (or page) that a row counts as for main text
        self.articles = dict(zip(rows, articles or rows, strict=True))


def _word_hashes(shard: Shard) -> np.ndarray:
    """64-bit hash of every token of the stream, the same in all shards; 0 for end marks."""
    of_word = np.array([0] + [xxhash.xxh64_intdigest(w, 1) or 1 for w in shard.names[1:]], np.uint64)
    return of_word[shard.tokens]


def _block_hashes(shard: Shard) -> np.ndarray:
    """64-bit hash of every block that is shorter than a run; 0 for the others."""
    return np.array([xxhash.xxh64_intdigest(" ".join(shard.names[t] for t in shard.tokens[a:b]), 1) or 1
                     if b - a < RUN else 0 for _, _, a, b in shard.spans], np.uint64).view(np.int64)


def _run_hashes(shard: Shard) -> np.ndarray:
    """64-bit hash of the ``RUN`` tokens from every position on; 0 where the block ends before."""
    words = _word_hashes(shard)
    n = len(words)
    out = np.zeros(n, np.uint64)
    if n < RUN:
        return out.view(np.int64)
    h = np.zeros(n - RUN + 1, np.uint64)
    for i in range(RUN):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:n - RUN + 1 + i]
        h ^= h >> np.uint64(29)
    out[:len(h)] = np.maximum(h, 1)
    out[~_run_starts(shard)] = 0
    return out.view(np.int64)


def _run_starts(shard: Shard) -> np.ndarray:
    """Positions whose next ``RUN`` tokens belong to one block."""
    ok = np.zeros(len(shard.tokens), bool)
    for _, _, a, b in shard.spans:
        if b - a >= RUN:
            ok[a:b - RUN + 1] = True
    return ok


def _page_of_position(shard: Shard, articles: bool = False) -> np.ndarray:
    """Number of the page, or of its article, that every position belongs to."""
    page = pd.factorize(np.array([shard.articles[row] if articles else row for row, _, _, _ in shard.spans], object))[0]
    return np.repeat(page, [b - a + 1 for _, _, a, b in shard.spans])


def _distinct_pages(group: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Per row the number of different pages of its group."""
    if not len(group):
        return np.empty(0, np.int64)
    width = int(page.max()) + 1
    classes, pages = np.unique(np.unique(group * width + page) // width, return_counts=True)
    return pages[np.searchsorted(classes, group)]


def repeated_substrings(shard: Shard, article_runs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """By the suffix array of the shard: (pages of the run from every position on, pages of every block).

    A run is the next ``RUN`` tokens, if they belong to one block (else 0 pages). Only blocks shorter than a
    run are counted as blocks (else 0). ``article_runs`` is filled with the different articles of every run.
    """
    n = len(shard.tokens)
    runs, blocks = np.zeros(n, np.int64), np.zeros(len(shard.spans), np.int64)
    if not n:
        return runs, blocks
    order = suffix_array(shard.tokens)
    lcp = common_prefixes(shard.tokens, order, RUN)
    page = _page_of_position(shard)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    at = np.flatnonzero(_run_starts(shard))
    # suffixes between two drops of the common prefix below the length are one class
    classes = np.cumsum(lcp < RUN)[rank[at]]
    runs[at] = _distinct_pages(classes, page[at])
    if article_runs is not None:
        article_runs[at] = _distinct_pages(classes, _page_of_position(shard, articles=True)[at])
    first = np.array([a for _, _, a, _ in shard.spans])
    # a block must be followed by its end mark in the other place as well
    need = np.array([b - a + 1 for _, _, a, b in shard.spans])
    for k in np.unique(need[need <= RUN]):
        of = np.flatnonzero(need == k)
        blocks[of] = _distinct_pages(np.cumsum(lcp < k)[rank[first[of]]], page[first[of]])
    return runs, blocks


def _candidates(min_share: float):
    """Hashes of the substrings and blocks on at least ``min_share`` of a shard's pages or articles, and on how many."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shard = _shard_of(pdf)
        articles = np.zeros(len(shard.tokens), np.int64)
        runs, blocks = repeated_substrings(shard, articles)
        pages = np.concatenate([runs, blocks])
        articles = np.concatenate([articles, np.zeros_like(blocks)])
        often = (pages > 0) & ((pages >= min_share * pdf["content"].nunique())
                               | (articles >= min_share * pdf["article"].nunique()))
        hashes = np.concatenate([_run_hashes(shard), _block_hashes(shard)]) if often.any() else np.zeros(len(often), np.int64)
        hashes, first = np.unique(hashes[often], return_index=True)
        return pd.DataFrame({"host": pd.Series([key[0]] * len(hashes), dtype=object),
                             "shard": np.full(len(hashes), key[1], np.int32), "hash": hashes,
                             "pages": pages[often][first], "articles": articles[often][first]})

    return run


def _count_candidates(key: tuple, pages: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
    """On how many pages and articles of this shard every wanted hash stands."""
    found = pd.DataFrame({c: np.empty(0, np.int64) for c in ("hash", "pages", "articles")})
    if len(pages) and len(wanted):
        shard = _shard_of(pages)
        runs, blocks = _run_hashes(shard), _block_hashes(shard)
        first = np.array([a for _, _, a, _ in shard.spans], np.int64)
        h = np.concatenate([runs, blocks])
        keep = (h != 0) & np.isin(h, wanted["hash"].to_numpy(np.int64))
        hashes, index, of = np.unique(h[keep], return_index=True, return_inverse=True)
        counts = []
        for by_article in (False, True):
            page = _page_of_position(shard, by_article)
            counts.append(_distinct_pages(of, np.concatenate([page, page[first]])[keep])[index])
        # short blocks are never cut out of main text
        is_run = np.concatenate([np.ones(len(runs), bool), np.zeros(len(blocks), bool)])[keep][index]
        found = pd.DataFrame({"hash": hashes, "pages": counts[0], "articles": np.where(is_run, counts[1], 0)})
    found.insert(0, "host", pd.Series([key[0]] * len(found), dtype=object))
    return found


def _shard_of(pdf: pd.DataFrame) -> Shard:
    pdf = pdf.drop_duplicates("content").sort_values("content")
    return Shard(pdf["content"].tolist(), [[("", t) for t in _blocks_of(p)] for p in pdf["packed"]],
                 pdf["article"].tolist())


def unique_runs(text_tokens: list[str], starts: np.ndarray) -> list[str]:
    """The tokens of one block without the stretches covered by boilerplate runs that begin at ``starts``."""
    covered = np.zeros(len(text_tokens) + 1, np.int64)
    covered[starts] += 1
    covered[starts + RUN] -= 1
    inside = np.cumsum(covered)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    gone = np.zeros(len(text_tokens), bool)
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        if b - a < LONG_BLOCK:
            gone[a:b] = True
    return [w for w, g in zip(text_tokens, gone.tolist(), strict=True) if not g]


def page_text(blocks: list[str], main: bool, cut: np.ndarray) -> list[str]:
    """The kept blocks of a page without boilerplate, given its hashes; ``main``: they are main text."""
    shard = Shard([""], [[("", text) for text in blocks]])
    known, short = np.isin(_run_hashes(shard), cut), np.isin(_block_hashes(shard), cut)
    left = [" ".join(unique_runs(text.split(" "), np.flatnonzero(known[a:b])))
            for text, (_, _, a, b) in zip(blocks, shard.spans, strict=True)]
    if not main:
        return [text for text, drop in zip(left, short.tolist(), strict=True) if text and not drop]
    lost = sum(b - a for text, (_, _, a, b) in zip(left, shard.spans, strict=True) if not text)
    if 2 * lost >= sum(b - a for _, _, a, b in shard.spans):
        return blocks
    return [whole for whole, text in zip(blocks, left, strict=True) if text]


def _kept_text(batches):
    for batch in batches:
        texts = []
        for text, main, cut in zip(*[batch.column(k).to_pylist() for k in ("text", "has_main", "cut")], strict=True):
            texts.append(JOIN.join(page_text(text.split(JOIN), main, np.array(cut, np.int64))) if text else "")
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def _host(url: str):
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#:]*)", 1)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            shard_tokens: int = SHARD_TOKENS, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per page: id, url, ``text`` (blocks joined by two line ends), ``n_chars`` (code points).

    The blocks of every page go once to the suffix arrays, copies once per task. A host with more than ``shard_tokens``
    tokens is cut into shards by page; its shards are read again, to be counted, only if one of them has a candidate. The
    text is put together where the page is; only pages of hosts with boilerplate meet its hashes.

    Defined cases: a null or empty page has empty text; a null url is a host of its own (the empty
    one); repeated rows come out as often as they went in, and count as one page; an empty table
    gives an empty result; a null id is kept; other columns are not read.
    """
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    id_type = dict(src.dtypes)["page_id"]
    parsed = materialize(src.withColumn("host", _host("url")).mapInArrow(
        _parse, f"page_id {id_type}, url string, host string, text string, side string, has_main boolean, "
                "content string, article string, n long, fresh boolean"), "pages", compression="zstd")
    fresh = parsed.where("fresh")
    hosts, m = materialize_measured(
        fresh.groupBy("host", "article", "content").agg(F.max("n").alias("n"))
        .groupBy("host", "article").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n"))
        .groupBy("host").agg(
            F.sum("pages").alias("host_pages"), F.count(F.lit(1)).alias("host_articles"),
            F.greatest(F.lit(1), F.ceil(F.sum("n") / F.lit(shard_tokens))).cast("int").alias("shards")), "host_sizes",
        {"rows": F.count(F.lit(1)), "shards": F.sum("shards"), "chars": F.sum(F.octet_length("host").cast("long"))})
    hosts = broadcast_if_small(hosts, known_rows=m["rows"], known_bytes=key_table_bytes(m["rows"], 1, m["chars"]))
    # a shard is seconds of work, so tasks are dealt by shards and not by bytes
    tasks = max(1, min(m["shards"], MAX_TASKS))

    def dealt(of: DataFrame) -> DataFrame:
        return (fresh.where(F.col("n") > 0).join(of, "host")
                .withColumn("shard", F.pmod(F.xxhash64("article"), F.col("shards")).cast("int"))
                .select("host", "shard", "content", "article", "text", "side")
                .mapInArrow(_packed, "host string, shard int, content string, article string, packed binary")
                .repartition(tasks, "host", "shard").groupBy("host", "shard"))

    # a host of fewer than min_pages different pages has no boilerplate
    found = materialize(dealt(hosts.where(F.col("host_pages") >= min_pages)).applyInPandas(
        _candidates(min_share), "host string, shard int, hash long, pages long, articles long"), "candidates")
    found = found.join(hosts, "host")
    sharded = found.where(F.col("shards") > 1)
    many = broadcast_if_small(materialize(sharded.select("host", "shards").distinct(), "sharded_hosts"))
    wanted = sharded.select(
        "host", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "hash").distinct()
    counted = (dealt(many).cogroup(wanted.groupBy("host", "shard"))
               .applyInPandas(_count_candidates, "host string, hash long, pages long, articles long")
               .groupBy("host", "hash").agg(F.sum("pages").alias("pages"), F.sum("articles").alias("articles"))
               .join(hosts, "host"))
    counts = ["host", "hash", "pages", "host_pages", "articles", "host_articles"]
    share = F.lit(min_share)
    known = (counted.select(*counts).unionByName(found.where(F.col("shards") == 1).select(*counts)).select(
        "host", "hash",
        ((F.col("pages") >= min_pages) & (F.col("pages") >= F.col("host_pages") * share)).alias("plain"),
        ((F.col("articles") >= MAIN_PAGES) & (F.col("articles") >= F.col("host_articles") * share)).alias("main"))
        .where(F.col("plain") | F.col("main")))
    boilerplate, m = materialize_measured(
        known.groupBy("host").agg(F.collect_list(F.when(F.col("plain"), F.col("hash"))).alias("cut"),
                                  F.collect_list(F.when(F.col("main"), F.col("hash"))).alias("cut_main")),
        "boilerplate", {"rows": F.count(F.lit(1)), "hashes": F.sum((F.size("cut") + F.size("cut_main")).cast("long"))})
    boilerplate = broadcast_if_small(boilerplate, known_rows=m["rows"],
                                     known_bytes=key_table_bytes(m["rows"], 3, 8 * m["hashes"]))
    rows = parsed.join(boilerplate, "host", "left")
    cut = F.when(F.col("has_main"), F.col("cut_main")).otherwise(F.col("cut"))
    judged = (rows.where(F.size(cut) > 0).select("page_id", "url", "text", "has_main", cut.alias("cut"))
              .mapInArrow(_kept_text, f"page_id {id_type}, url string, text string"))
    untouched = rows.where(F.coalesce(F.size(cut), F.lit(0)) <= 0).select("page_id", "url", "text")
    return (untouched.unionByName(judged)
            .select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text",
                    F.char_length("text").cast("long").alias("n_chars")))
