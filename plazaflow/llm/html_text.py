"""Main text of a page by the distribution of its lines.

Markup is stripped into lines, one per block, without menus, footers, forms and the like. Each line
has the length of its text in links and outside of them; a heading's links count as text. Both are
summed over sliding windows of lines. The text dives where a window holds more link text than other
text and surges where it does not. In a dive the lines that are mostly links go; lines of other text
stay wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 3
# Element names of the HTML standard by their role.
RAW = frozenset("script style noscript template textarea svg math iframe object select option title".split())
BOILERPLATE = frozenset("nav header footer aside form menu".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Kinds of elements that may hold the article, the surest first; an element with a name of _CONTENT is of the last.
ARTICLE, MAIN, NAMED = KINDS = (4, 2, 1)
_CONTENT = re.compile(r"(?:(?:page|site|blog|news)-)?(?:article|content|main|post|entry|story)(?:-?(?:body|content|text|main))?")
# Whole names in class, id or role that name what is not content.
_ROLES = re.compile(
    r"(?:(?:site|page|main|global|primary|secondary|top|bottom|left|right|mobile|sub|post|article|entry)-)?"
    r"(?:ads?|adverts?|advertisements?|advertising|adsbygoogle|banners?|sponsor|sponsors|sponsored|promos?|promotions?|nav|navs|navbar|navigation|menus?|"
    r"menubar|breadcrumbs?|sidebars?|side-bar|footer|header|masthead|topbar|comments?|disqus|replies|respond|notices?|cookies?|consent|gdpr|popups?|"
    r"modals?|newsletters?|subscribe|signup|share|sharing|social|related|widgets?|login|search|pager|pagination|complementary|contentinfo|alerts?|"
    r"copyright|toolbars?|skip-?link)"
    r"(?:-(?:area|bar|body|box|buttons|container|content|form|icons|inner|items?|links?|list|menu|notice|nav|posts|section|slot|thread|unit|wrap|wrapper))?")
# An article's own header holds its title.
_HEADERS = frozenset("header post-header article-header entry-header".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|"
    r"<[A-Za-z][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_SPACE = re.compile(r"\s+")


def _tokens(attrs: str) -> list[str]:
    """The whole names in class, id and role."""
    return [t for m in _ATTR.finditer(attrs) if m[1].lower() in ("class", "id", "role")
            for t in (m[2] or m[3] or m[4] or "").lower().replace("_", "-").split()]


def _is_hidden(name: str, attrs: str) -> bool:
    keys = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _ATTR.finditer(attrs)]
    return any(key == "hidden" or key == "aria-hidden" and value == "true" and name not in INLINE for key, value in keys)


def _has_role(name: str, attrs: str, inside: int) -> bool:
    """Whether a name says that the element is not content; an article is one unless it stands in another, such as a comment."""
    if name in ("html", "body", "main") or name in HEADINGS or name == "article" and not inside & ARTICLE or not attrs or attrs.isspace():
        return False
    return any(_ROLES.fullmatch(t) and not (t in _HEADERS and inside & (ARTICLE | MAIN)) for t in _tokens(attrs))


def _container(name: str, attrs: str) -> int:
    if name in ("article", "main"):
        return ARTICLE if name == "article" else MAIN
    return NAMED if name in ("div", "section", "td") and any(_CONTENT.fullmatch(t) for t in _tokens(attrs)) else 0


def _after_inline(html: str, at: int, name: str) -> int:
    """Where the inline element opened before `at` ends; `at` itself if it is never closed."""
    depth = 1
    for m in re.compile(rf"<(/?){name}\b[^>]*>", re.I).finditer(html, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return at


def _without(lines: list[tuple[str, int, int, bool]], named: list[tuple[int, int, int]], landmarks: int) -> list[tuple[str, int, int, bool]]:
    """Lines without the elements whose names make them boilerplate, except those around the page's text.

    Such an element holds most of the text and an article, main or h1 of the page; on a page that has none of these, nine tenths of the text.
    """
    if not named:
        return lines
    before = np.concatenate([[0], np.cumsum([len(x[0]) for x in lines], dtype=np.int64)])
    edges = np.zeros(len(lines) + 1, np.int64)
    for start, end, own in named:
        size = before[end] - before[start]
        if 2 * size > before[-1] and own or not landmarks and 10 * size >= 9 * before[-1]:
            continue
        edges[start] += 1
        edges[end] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    return [x for x, g in zip(lines, gone) if not g]


def page_lines(html: str) -> list[tuple[str, int, int, bool]]:
    """(text, length of it in links, kinds of containers around it, in an h1) for each line that is not surely boilerplate."""
    lines: list[tuple[str, int, int, bool]] = []
    named: list[tuple[int, int, int]] = []  # first line, end and landmarks of each element that its names make boilerplate
    buffer: list[str] = []
    linked: list[str] = []  # what of the buffer stands in links
    link = 0  # open elements around the open link and the link itself; 0 without one
    # name, is boilerplate, kinds of containers up to here, first line and landmarks before if its names make it boilerplate
    open_: list[tuple[str, bool, int, tuple[int, int] | None]] = []
    dead, inside, at, landmarks = 0, 0, 0, 0

    def add(piece: str) -> None:
        buffer.append(piece)
        if link:
            linked.append(piece)

    def flush() -> None:
        if buffer:
            text = _SPACE.sub(" ", unescape("".join(buffer))).strip()
            in_links = len(_SPACE.sub(" ", unescape("".join(linked))).strip()) if linked else 0
            buffer.clear()
            linked.clear()
            if text and not dead:
                block = open_[-1][0] if open_ else ""
                lines.append((text, 0 if block in HEADINGS else min(in_links, len(text)), inside, block == "h1"))

    def leave(upto: int) -> None:
        nonlocal dead, inside, link
        if upto < link - 1:
            link = 0  # never closed
        while len(open_) > upto:
            _, own, _, role = open_.pop()
            dead -= own
            if role:
                named.append((role[0], len(lines), landmarks - role[1]))
            inside = open_[-1][2] if open_ else 0

    n = len(html)
    while at < n:
        cut = html.find("<", at)
        if cut < 0:
            add(html[at:])
            break
        if cut > at:
            add(html[at:cut])
        m = _TOKEN.match(html, cut)
        if m is None:  # a bare <
            add("<")
            at = cut + 1
            continue
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in RAW:
            if not m["end"]:
                if name not in INLINE:
                    flush()
                close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else n
            continue
        if name in INLINE:
            # an inline advert or hidden note is skipped up to its end tag; other inline markup has no effect
            if not m["end"] and name not in VOID and m["attrs"].strip() and (_is_hidden(name, m["attrs"]) or _has_role(name, m["attrs"], inside)):
                at = _after_inline(html, at, name)
            elif name == "a":
                follows = None if m["end"] or not _HREF.search(m["attrs"]) else _LINK.search(html, at)
                link = len(open_) + 1 if follows and follows[1] else 0
            continue
        flush()
        if m["end"]:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    leave(i)
                    break
            continue
        if name in VOID:
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and open_ and open_[-1][0] == name:
            leave(len(open_) - 1)  # these end where the next one starts
        own = name in BOILERPLATE and not (name == "header" and inside & (ARTICLE | MAIN)) or _is_hidden(name, m["attrs"])
        role = not own and not dead and _has_role(name, m["attrs"], inside)
        dead += own
        inside |= _container(name, m["attrs"])
        if name in ("article", "main", "h1") and not dead and not role:
            landmarks += name != "article" or not any(_ROLES.fullmatch(t) for t in _tokens(m["attrs"]))  # a comment may be an article too
        open_.append((name, own, inside, (len(lines), landmarks) if role else None))
    flush()
    leave(0)
    return _without(lines, named, landmarks)


def main_text(html: str | None, window: int = WINDOW) -> str:
    """The lines of text and what stands between surge and dive of the window sums, within the surest kind of container with half of the content.

    A page that is all links has no text to tell from them, so its lines stay.
    """
    lines = page_lines(html) if html else []
    if not lines:
        return ""
    links = np.array([x[1] for x in lines], np.int64)
    plain = np.array([len(x[0]) for x in lines], np.int64) - links
    inside = np.array([x[2] for x in lines], np.int64)
    size = plain if plain.any() else links
    bound = next((k for k in KINDS if 2 * size[inside & k > 0].sum() >= size.sum()), 0)
    kept = np.ones(len(lines), bool)
    if bound:
        # a title may stand before its main or named element; an article has its own
        kept = (inside & bound > 0) | (np.array([x[3] for x in lines]) if bound != ARTICLE else False)
    lines, links, plain = [x for x, k in zip(lines, kept) if k], links[kept], plain[kept]
    if len(lines) >= window and plain.any():
        dive = np.convolve(links - plain, np.ones(window, np.int64), "valid") > 0  # of the lines i .. i+window-1
        dived = np.convolve(dive, np.ones(window, np.int64)) > 0
        lines = [x for x, d, of_links in zip(lines, dived, links > plain) if not (d and of_links)]
    return "\n".join(x[0] for x in lines)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page; null or empty html gives an empty text.

    Rows may repeat and ids may be null; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
