"""Main text of web pages by line-block distribution.

1. Markup is stripped into lines: a line is the text of one block element, its character
   references decoded and its white space made into single spaces. Comments, scripts,
   styles and other raw elements leave nothing.
2. Every line has a length. Lines in menus, headers, footers, sidebars, notices, adverts,
   forms and reader comments (known by element, role, class or id), count as blank, and
   ``WINDOW`` blank lines stand wherever such a part, or an ``article`` or ``main`` element, begins or ends.
3. Lengths are added up over sliding windows of ``WINDOW`` lines. Where the sums rise
   from zero is a surge, where they fall back to zero is a dive; the lines between the two are a segment.
4. Kept are the segments of ``main`` elements, else of ``article`` elements. A page with
   neither keeps the segments that surge to at least ``SURGE_SHARE`` of the highest
   window and are not mostly links, and those that lie in the same element as a line of these.
   Short lines within a segment always stay.

Pages are read whole, one at a time, whatever their length; a task holds one batch of them.

Cases: null and empty pages, and pages of nothing but such parts, have an empty text. Text without
any markup is its own main text. Elements that are never closed end with their parents; a tag that is cut off at the
end of the page leaves nothing. ``br`` is white space; a table row is one line. Repeated rows are extracted each.
Rows without a page_id are extracted as well. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfline.llm.words import slices

#: Lines of a window.
WINDOW = 3
#: On pages without ``main`` and ``article``, segments must reach this share of the highest window.
SURGE_SHARE = 0.2
#: There, segments with a larger share of their text in links are lists of links.
LINK_SHARE = 0.5

# Elements of HTML by their role here.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th".split())
AROUND_ELEMENTS = frozenset(
    "nav footer aside form search menu dialog button select datalist object template svg canvas audio video map".split()
)
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
AROUND_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar sidebars aside widget widgets "
    "notice notices alert cookie cookies consent gdpr disclaimer popup modal overlay newsletter subscribe subscription signup login "
    "search share sharing social related recommended comment comments commentlist respond replies disqus pagination pager toolbar "
    "copyright banner".split()
)
#: A paragraph ends where one of these begins, also without its end tag.
ENDS_PARAGRAPH = BLOCKS - {"body", "caption", "head", "html", "legend", "option", "optgroup", "summary", "tbody", "tfoot", "thead", "tr"}

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_NEGATED = frozenset("has with without no not".split())
_BLANKS = re.compile(r"\s+")

OTHER, ARTICLE, MAIN = range(3)


class _Element:
    __slots__ = ("name", "around", "zone", "number", "in_link")

    def __init__(self, name: str, around: bool, zone: int, number: int, in_link: bool):
        self.name, self.around, self.zone, self.number, self.in_link = name, around, zone, number, in_link


def _is_around(name: str, attributes: str, zone: int) -> bool:
    """Whether an element lies around the main text."""
    if name in AROUND_ELEMENTS or (name == "header" and zone == OTHER):
        return True
    if not attributes or name in ("body", "html"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "hidden":
            return True
        if key == "role":
            if value.strip().lower() in AROUND_ROLES:
                return True
            continue
        for one in value.split():
            parts = [p.lower() for p in _NAME_PARTS.findall(one)]
            for i, part in enumerate(parts):
                if part in AROUND_NAMES and not (i and parts[i - 1] in _NEGATED):
                    # the heading of an article is often named after the header that it is
                    if not (part == "header" and zone != OTHER):
                        return True
    return False


class Lines:
    """Lines of a page: text, counted length, length of links, zone, and the element that holds it."""

    def __init__(self, html: str):
        self.rows: list[tuple[str, int, int, int, int]] = []
        self._text: list[str] = []
        self._link_chars = 0
        self._open = [_Element("", False, OTHER, 0, False)]
        self._made = 0
        self._read(html)
        self._end_line()

    def _end_line(self) -> None:
        if self._text:
            line = _BLANKS.sub(" ", "".join(self._text)).strip()
            if line:
                top = self._open[-1]
                held = next((e for e in reversed(self._open) if e.name not in ENDS_PARAGRAPH or e.name in ("div", "section", "article", "main")), top)
                self.rows.append((line, 0 if top.around else len(line), min(self._link_chars, len(line)), top.zone, held.number))
            self._text.clear()
        self._link_chars = 0

    def _gap(self) -> None:
        self.rows += [("", 0, 0, OTHER, -1)] * WINDOW

    def _say(self, text: str) -> None:
        text = unescape(text)
        self._text.append(text)
        if self._open[-1].in_link:
            self._link_chars += len(text.strip())

    def _begin(self, name: str, attributes: str) -> None:
        if name in ENDS_PARAGRAPH:
            self._close("p", {"button", "caption", "object", "table", "td", "template", "th"})
        if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self._close(name, {"ul", "ol", "menu", "dl", "table", "select"})
        above = self._open[-1]
        zone = MAIN if name == "main" or re.search(r"\brole\s*=\s*[\"']?main\b", attributes) else ARTICLE if name == "article" else OTHER
        around = above.around or _is_around(name, attributes, max(zone, above.zone))
        if name in BLOCKS:
            self._end_line()
        self._made += 1
        new = _Element(name, around, max(zone, above.zone), self._made, above.in_link or name == "a")
        if new.around != above.around or new.zone != above.zone:
            self._end_line()
            self._gap()
        self._open.append(new)

    def _pop(self) -> None:
        gone = self._open[-1]
        if gone.name in BLOCKS:
            self._end_line()
        below = self._open[-2]
        if gone.around != below.around or gone.zone != below.zone:
            self._end_line()
            self._gap()
        self._open.pop()

    def _close(self, name: str, within: set[str] = frozenset()) -> None:
        """Close the innermost element of that name and what is open in it; ``within`` ends the search."""
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k].name == name:
                while len(self._open) > k:
                    self._pop()
                return
            if self._open[k].name in within:
                return

    def _read(self, html: str) -> None:
        at = 0
        while (found := _MARKUP.search(html, at)) is not None:
            if found.start() > at:
                self._say(html[at : found.start()])
            at = found.end()
            if (name := found[2] or found[5]) is None:
                continue
            name, ends, attributes = name.lower(), found[1] or found[4], found[3] or found[6] or ""
            if name in BLOCKS and (name in VOID or ends):
                self._end_line()
            if name in SPACES:
                self._text.append(" ")
            if ends:
                self._close(name)
            elif name in RAW:
                # its content is no markup; without an end it reaches to the end of the page
                end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                at = len(html) if end is None else end.start()
            elif name not in VOID and not (attributes.endswith("/") and name in ("svg", "path", "use")):
                self._begin(name, attributes)
        self._say(html[at:])


def segments(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(first line, end, highest window) between each surge of the window sums and the dive after it."""
    sums = [0, *accumulate(lengths), *[0] * 0]
    found, first, last, high = [], None, 0, 0
    for i, length in enumerate(lengths):
        window = sums[i + 1] - sums[max(0, i + 1 - WINDOW)]  # the window that ends at this line
        if window and first is None:
            first, high = i, 0
        if window:
            high = max(high, window)
            if length:
                last = i
        elif first is not None:
            found.append((first, last + 1, high))
            first = None
    if first is not None:
        found.append((first, last + 1, high))
    return found


def main_lines(html: str | None) -> list[str]:
    """Lines of the main text of one page, in page order."""
    rows = Lines(html or "").rows
    counted = [r[1] for r in rows]
    zones = {rows[i][3] for i, n in enumerate(counted) if n}
    if not zones:
        return []
    best = max(zones)
    found = segments([n if rows[i][3] == best else 0 for i, n in enumerate(counted)])
    if best == OTHER:
        prose = [s for s in found if sum(rows[i][2] for i in range(*s[:2]) if counted[i]) <= LINK_SHARE * sum(counted[s[0] : s[1]])]
        highest = max((s[2] for s in prose), default=0)
        kept = {s for s in prose if s[2] >= SURGE_SHARE * highest}
        holders = {rows[i][4] for s in kept for i in range(*s[:2]) if counted[i]}
        found = [s for s in found if s in kept or any(rows[i][4] in holders for i in range(*s[:2]) if counted[i])]
    return [rows[i][0] for s in found for i in range(*s[:2]) if counted[i] and rows[i][3] == best]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", 1 << 21):
        lines = [main_lines(h) for h in batch.column("html").to_pylist()]
        texts = ["\n".join(x) for x in lines]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("page_id", "url")),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(x) for x in lines], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars", "n_blocks"],
        )


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) and n_blocks of every row of ``pages`` (page_id, url, html)."""
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long"
    )
