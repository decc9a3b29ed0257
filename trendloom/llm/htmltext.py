"""Main text of web pages by line-block distribution.

A page's markup is stripped into blocks, one line each. Lines of menus, headers, footers, sidebars, notices, adverts,
forms, reader comments and the like are taken out of the sequence, and so are lines outside the article where a page
marks one. Lengths (without what is inside links) are summed over sliding windows of lines; the surge is where the sums
pass a bound, the dive is where they fall to it again, and the run between them that holds the most text is the main one.
Other runs join it if they stand in the same box of the page, or hold a share of its text; lines between the first surge
and the last dive are kept, as are headings and lines of the same box next to them. Lines of a marked article count as
long enough each, so there surge and dive fall on its first and last line, whatever their length.

Nulls, empties: null or empty html gives an empty text; a page without an article is judged by its lines alone;
unclosed tags, stray quotes and tags cut off at the end are taken as browsers do; repeated rows give repeated results;
a null page_id or url is an ordinary value; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import small_batches


@dataclass(frozen=True)
class HtmlParams:
    #: Lines of one window, and the sum of lengths above which a text goes on.
    window: int = 3
    min_sum: int = 40
    #: Shorter lines at either end are navigation or a notice, unless they are headings or stand in the text's own box.
    edge_chars: int = 20
    #: Another run of at least this percentage of the main one's text belongs to it.
    run_percent: int = 20


#: Element names by their part in a page.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "xmp"}
DROPPED = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "canvas", "object", "audio", "video"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = {"p", "div", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "section", "article", "main", "blockquote", "pre", "figure", "figcaption", "address", "hr", "body", "html", "center", "details", "summary", "fieldset", "legend", "hgroup"} | HEADINGS | DROPPED
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Parts of a class, id or role that mark a box as no part of the article wherever they stand in it,
ALWAYS = {"advert", "advertisement", "ads", "adsense", "breadcrumb", "breadcrumbs", "comments", "contentinfo", "cookie", "cookies", "disqus", "masthead", "navbar", "navigation", "newsletter", "pagination", "sidebar"}
#: only if nothing but these and
ALONE = {"ad", "advertising", "banner", "comment", "complementary", "consent", "footer", "header", "hidden", "login", "menu", "modal", "nav", "notice", "pager", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar"}
#: names of boxes stand in it,
BOX = {"area", "articles", "bar", "block", "bottom", "box", "buttons", "container", "content", "form", "global", "icons", "item", "items", "left", "links", "list", "main", "message", "page", "panel", "posts", "primary", "right", "secondary", "section", "site", "slot", "thread", "top", "unit", "widget", "wrap", "wrapper"}
#: and not after a word that says it is missing or beside it.
WITH = {"no", "has", "with", "without", "not"}
_ATTRS = r"(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$)|[^\s>]++)?+)?+|=[^\s/>=]*+)*+"
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|$))|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</(?![a-zA-Z])[^>]+(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)(" + _ATTRS + r")(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++))?+)?+")
_PART = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


def _is_boilerplate(name: str, attrs: str) -> bool:
    if name in DROPPED:
        return True
    if not attrs.strip():
        return False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role") and name not in ("body", "html", *MAIN):
            for token in value.split():
                parts = _PART.findall(token)
                told = set(parts) & (ALWAYS | ALONE)
                if told and not (set(parts) & WITH) and (told & ALWAYS or set(parts) <= ALONE | BOX):
                    return True
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True
    return False


@dataclass(frozen=True)
class Line:
    text: str
    boilerplate: bool
    article: bool
    heading: bool
    #: Characters outside links.
    plain: int
    #: Number of the block around the line's own, 0 for none and for the page's body.
    box: int


def lines(page: str) -> list[Line]:
    """The page's blocks that have a text, in order."""
    out: list[Line] = []
    open_tags: list[tuple[str, bool, bool, int]] = []  # name, boilerplate here or above, article here or above, number
    parts: list[str] = []
    linked = opened = 0
    low = page.lower()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                boxes = [t for t in open_tags if t[0] in BLOCKS]
                box = boxes[-2] if len(boxes) > 1 else ("", False, False, 0)
                up = open_tags[-1] if open_tags else ("", False, False, 0)
                out.append(Line(text, up[1], up[2], bool(boxes) and boxes[-1][0] in HEADINGS, max(0, len(text) - linked), 0 if box[0] in ("body", "html") else box[3]))
        linked = 0

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        parts.append(page[at : m.start()] if m else page[at:])
        if any(t[0] == "a" for t in open_tags[-4:]):
            linked += len(parts[-1])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if m[1]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    # an inline end tag doesn't close blocks
                    if name in BLOCKS or all(t[0] not in BLOCKS for t in open_tags[i:]):
                        del open_tags[i:]
                    break
            continue
        if name in VOID:
            continue
        if name == "p" or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            while open_tags and open_tags[-1][0] not in BLOCKS:
                open_tags.pop()  # inline elements left open end with their block
            if open_tags and open_tags[-1][0] == name:
                open_tags.pop()
        up = open_tags[-1] if open_tags else ("", False, False, 0)
        opened += 1
        open_tags.append((name, up[1] or _is_boilerplate(name, m[3] or ""), up[2] or name in MAIN, opened))
        if name in RAW:
            end = low.find(f"</{name}", at)
            at = len(page) if end < 0 else end
            parts.clear()
    flush()
    return out


def runs_between(size: np.ndarray, window: int, least: int) -> list[tuple[int, int]]:
    """[surge, dive) of each run of lines whose window (a line and the next ones) sums to more than least."""
    total = np.concatenate([[0], np.cumsum(np.concatenate([size, np.zeros(window - 1, np.int64)]))])
    dense = total[window:] - total[:-window] > least
    edges = np.flatnonzero(np.diff(np.concatenate([[False], dense, [False]]).astype(np.int8)))
    out: list[tuple[int, int]] = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        end = min(b + window - 1, len(size))  # a window reaches over the lines after its first
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((a, end))
    return out


def main_text(page: str | None, p: HtmlParams) -> str:
    """The lines between surge and dive, two line feeds between them."""
    if not page:
        return ""
    own = [x for x in lines(page) if not x.boilerplate]
    marked = any(x.article for x in own)
    own = [x for x in own if x.article or not marked]
    if not own:
        return ""
    size = np.array([max(len(x.text), p.min_sum + 1) if marked else x.plain for x in own], np.int64)
    runs = runs_between(size, p.window, p.min_sum) or runs_between(np.array([len(x.text) for x in own], np.int64), p.window, 0)
    weight = [int(size[a:b].sum()) for a, b in runs]
    main = max(range(len(runs)), key=lambda k: (weight[k], -k))
    longest = lambda k: own[max(range(*runs[k]), key=lambda i: (size[i], -i))]
    box = longest(main).box
    joined = [r for k, r in enumerate(runs) if marked or (box and longest(k).box == box) or 100 * weight[k] >= p.run_percent * weight[main]]
    first, end = joined[0][0], joined[-1][1]
    stays = lambda x: marked or len(x.text) >= p.edge_chars or x.heading or (box and x.box == box)
    while first < end - 1 and not stays(own[first]):
        first += 1
    while end - 1 > first and not stays(own[end - 1]):
        end -= 1
    while first and (own[first - 1].heading or (box and own[first - 1].box == box)):
        first -= 1
    while end < len(own) and box and own[end].box == box:
        end += 1
    return "\n\n".join(x.text for x in own[first:end])


def extract(pages: DataFrame, params: HtmlParams | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages(page_id, url, html)."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType

    p = params or HtmlParams()
    small_batches(pages.sparkSession)
    schema = pages.select("page_id", "url").schema.add("text", StringType()).add("n_chars", LongType())

    def run(batches):
        for batch in batches:
            texts = [main_text(x, p) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f.name for f in schema.fields])

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
