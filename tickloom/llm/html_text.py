"""Main text of HTML pages from parser events and smoothed text-to-tag ratios.

The standard library's streaming parser turns a page into lines: runs of text between
block-level tags, each with the number of tags in it and the element that holds it. Menus,
footers, sidebars, forms, scripts, notices, adverts and comment sections are told by tag, role
and the words of class and id; their lines count as having no text.

A name alone hides an element if all its words say so and one of them can mean nothing else
(``cookie-notice``, not ``notice``; not the id of a section of the article), or outside the article or main element of a page that has
one. Otherwise its head, the last telling word, must say so (``related-posts``, not
``related-work``; on pages without such an element any word does), and its lines must agree:
half of its text is in links or in lines that the ratios below put with the rest. Headings and
paragraphs are never hidden by their id.

Each line's ratio of characters to tags is smoothed by a Gaussian along the page, and two
means split the ratios into content and the rest. The region that holds the content is then
the article that has at least half of it, else the main element, else the innermost container
that has nearly all of it. All lines of the region come out, short ones too, in page order.

* A null or empty page, or one without any text of its own, gives an empty text.
* White space in a block becomes one space; blocks are joined by one space.
* A header within the article keeps its headings. Unclosed and misnested tags are tolerated.
* Repeated rows are extracted alike; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import each

SIGMA = 1.0
INNERMOST_SHARE = 0.97

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr nobr".split()
)
_HIDDEN = set(
    "head title script style noscript template svg math iframe object embed canvas audio video "
    "nav footer aside form button select option textarea input label fieldset datalist dialog menu".split()
)
_HIDDEN_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
_HIDDEN_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored "
    "sponsors promo promos promotion banner sidebar sidebars nav navbar navigation menu menus "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments respond disqus reply replies pagination pager toolbar copyright "
    "widget widgets teaser teasers outbrain taboola paywall alert".split()
)
_HIDDEN_NAMES = {"header", "site-header", "page-header", "top-header", "global-header"}
_NEVER_BY_NAME = {"html", "body", "main", "article"}
_NEGATED = {"no", "without", "has", "with", "hide", "is"}
_WRAPPING = {"wrap", "wrapper", "layout", "container", "body", "page"}
_CLOSED_BY_NEXT = {"li", "dd", "dt", "tr", "td", "th", "p", "option"}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words that also name parts of an article.
_AMBIGUOUS = set(
    "alert banner comment consent copyright login menu menus modal notice notices navigation overlay "
    "promotion recommendations recommended related replies reply respond share sharing social "
    "subscription toolbar widget widgets".split()
)
# Words that say how an element is built, not what it holds.
_STRUCTURAL = set(
    "area bar block box button buttons col column icon icons inner item items left link links list "
    "outer post posts right row section slot stories top bottom unit".split()
)
# What a name says: nothing, a word of it, its head, all of it.
_NOTHING, _WORD, _HEAD, _ALL = range(4)


def _named_hidden(names: str) -> int:
    """How surely a class or id says that the element is not part of the article."""
    found = _NOTHING
    for name in names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if not _NEGATED.isdisjoint(words) or not _WRAPPING.isdisjoint(words):
            continue
        if name.lower() in _HIDDEN_NAMES:
            return _ALL
        if _HIDDEN_WORDS.isdisjoint(words):
            continue
        telling = [w for w in words if w not in _STRUCTURAL and not w.isdigit()]
        if _HIDDEN_WORDS.issuperset(telling) and not _AMBIGUOUS.issuperset(telling):
            return _ALL
        found = max(found, _HEAD if telling[-1] in _HIDDEN_WORDS else _WORD)
    return found


class _Doubt:
    """An element that its name may hide: what it says, where it is and what it holds."""

    def __init__(self, says: int, inside: bool, line: int, size: int, linked: int) -> None:
        self.says, self.inside = says, inside
        self.lines = self.size = self.linked = None
        self.start = (line, size, linked)

    def end(self, line: int, size: int, linked: int) -> None:
        self.lines = range(self.start[0], line)
        self.size, self.linked = size - self.start[1], linked - self.start[2]


class _Lines(HTMLParser):
    """Collects lines: text, tags, element number, hidden.

    ``hidden`` tells which start tags in doubt, by number, are hidden; others are shown.
    """

    def __init__(self, hidden: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden, self.start_tags = hidden, 0
        self.doubts: dict[int, _Doubt] = {}
        # Elements in doubt that are open: (tag, depth of open elements around it, doubt).
        self.doubtful: list[tuple[str, int, _Doubt]] = []
        self.size = self.linked = 0
        self.in_link = self.has_region = False
        self.parents, self.tags = [-1], ["#root"]
        # Open elements: (tag, number, hidden, header of an article).
        self.open: list[tuple[str, int, bool, bool]] = [("#root", 0, False, False)]
        self.lines: list[tuple[str, int, int, bool]] = []
        self.parts: list[str] = []
        self.tag_count = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of no known kind is skipped like a comment; the library's parser fails at it."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tag_count:
            _, number, hidden, _ = self.open[-1]
            self.lines.append((text, self.tag_count, number, hidden))
        self.parts, self.tag_count = [], 0

    def _totals(self) -> tuple[int, int, int]:
        return len(self.lines), self.size, self.linked

    def _settle(self, depth: int) -> None:
        """End the doubts about elements that held what was open below ``depth``."""
        while self.doubtful and self.doubtful[-1][1] >= depth:
            self.doubtful.pop()[2].end(*self._totals())

    def _hides(self, tag: str, attrs: list) -> bool:
        if tag in _HIDDEN:
            return True
        if not attrs:
            return False
        named = {k: v or "" for k, v in attrs}
        if "hidden" in named or named.get("aria-hidden") == "true":
            return True
        if named.get("role", "").lower() in _HIDDEN_ROLES:
            return True
        if "style" in named and re.search(r"display\s*:\s*none", named["style"], re.I):
            return True
        if tag in _NEVER_BY_NAME:
            return False
        says = _named_hidden(named.get("class", ""))
        by_id = _NOTHING if tag == "p" or tag in _HEADINGS else _named_hidden(named.get("id", ""))
        if not says and not by_id:
            return False
        inside = any(t in ("article", "main") for t, *_ in self.open)
        if inside and tag == "section":  # such ids are often made from headings
            by_id = min(by_id, _HEAD)
        says = max(says, by_id)
        if says == _ALL:
            return True
        if inside and says == _WORD:
            return False
        self.doubts[self.start_tags] = _Doubt(says, inside, *self._totals())
        return self.start_tags in self.hidden

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.start_tags += 1
        if tag in _VOID:
            if tag in ("br", "hr"):
                self.end_line()
            self.tag_count += 1
            return
        if tag == "a":
            self.in_link = True
        self.has_region = self.has_region or tag in ("article", "main")
        hides = self._hides(tag, attrs)
        doubt = self.doubts.get(self.start_tags)
        if tag in _INLINE and not hides:
            if doubt:
                self.doubtful.append((tag, len(self.open), doubt))
            self.tag_count += 1
            return
        self.end_line()
        self.tag_count += 1
        if tag in _CLOSED_BY_NEXT and self.open[-1][0] == tag:
            self.open.pop()
            self._settle(len(self.open))
        elif self.open[-1][0] == "p" and tag not in _INLINE:
            self.open.pop()
            self._settle(len(self.open))
        if doubt:
            doubt.start = self._totals()
            self.doubtful.append((tag, len(self.open), doubt))
        _, above, hidden, header = self.open[-1]
        if tag == "header":
            in_article = any(t in ("article", "main") for t, *_ in self.open)
            hides, header = True, in_article and not hidden
        elif tag in _HEADINGS and header:
            hides = hidden = False
        self.parents.append(above)
        self.tags.append(tag)
        self.open.append((tag, len(self.tags) - 1, hidden or hides, header))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), 0)
        if tag not in _INLINE or at:
            self.end_line()
        self.tag_count += 1
        if at:
            del self.open[at:]
            self._settle(at)
        elif self.doubtful and self.doubtful[-1][:2] == (tag, len(self.open)):
            self.doubtful.pop()[2].end(*self._totals())
        if tag == "a":
            self.in_link = False

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if not self.open[-1][2]:
            size = len("".join(data.split()))
            self.size += size
            self.linked += size * self.in_link


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian average along the lines; ends are extended by zeros."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The middle between two means of the values' logarithms; 0 where all are alike."""
    logs = np.log1p(values)
    low, high = logs.min(), logs.max()
    if high - low < 1e-9:
        return 0.0
    for _ in range(50):
        cut = (low + high) / 2
        below, above = logs[logs < cut], logs[logs >= cut]
        new = (below.mean() if len(below) else low, above.mean() if len(above) else high)
        if new == (low, high):
            break
        low, high = new
    return float(np.expm1((low + high) / 2))


def _region(page: _Lines, mass: np.ndarray) -> int:
    """The element that holds the content; ``mass`` is each element's share, children's included."""
    articles = [i for i, t in enumerate(page.tags) if t == "article" and mass[i] >= 0.5]
    if articles:
        return articles[0]
    mains = [i for i, t in enumerate(page.tags) if t == "main" and mass[i] >= 0.5]
    if mains:
        return mains[0]
    children: dict[int, list[int]] = {}
    for i, above in enumerate(page.parents):
        children.setdefault(above, []).append(i)
    at = 0
    while True:
        best = max(children.get(at, []), key=lambda i: (mass[i], -i), default=None)
        if best is None or mass[best] < INNERMOST_SHARE or page.tags[best] in _CLOSED_BY_NEXT | _HEADINGS:
            return at
        at = best


def _parsed(html: str, hidden: frozenset[int] = frozenset()) -> _Lines:
    page = _Lines(hidden)
    page.feed(html)
    page.close()
    page.end_line()
    page._settle(0)
    return page


def _judged(page: _Lines, shown: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of lines, smoothed ratios, and which lines are content."""
    size = np.array([len(t) for t, *_ in page.lines], dtype=float) * shown
    tags = np.array([n for _, n, _, _ in page.lines], dtype=float)
    ratios = smoothed(size / np.maximum(tags, 1.0))
    return size, ratios, shown & (ratios >= threshold(ratios[shown]))


def _shown(page: _Lines) -> np.ndarray:
    return np.array([bool(t) and not hidden for t, _, _, hidden in page.lines], dtype=bool)


def _hidden_by_name(page: _Lines) -> frozenset[int]:
    """The start tags in doubt that are hidden: where the text of their lines agrees."""
    shown, hidden, open_ = _shown(page), set(), []
    for number, doubt in page.doubts.items():
        if page.has_region and not doubt.inside:
            hidden.add(number)
            shown[doubt.lines.start : doubt.lines.stop] = False
        else:
            open_.append((number, doubt))
    if not open_ or not shown.any():
        return frozenset(hidden)
    size, _, content = _judged(page, shown)
    for number, doubt in open_:
        part = slice(doubt.lines.start, doubt.lines.stop)
        if 2 * doubt.linked >= doubt.size or 2 * (size * content)[part].sum() < size[part].sum():
            hidden.add(number)
    return frozenset(hidden)


def main_text(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    page = _parsed(html)
    if page.doubts:
        hidden = _hidden_by_name(page)
        page = _parsed(html, hidden) if hidden else page
    lines, shown = page.lines, _shown(page)
    if not shown.any():
        return ""
    size, _, content = _judged(page, shown)
    mass = np.zeros(len(page.tags))
    element = np.array([e for _, _, e, _ in lines])
    np.add.at(mass, element, size * content)
    for i in range(len(mass) - 1, 0, -1):  # children come after their parents
        mass[page.parents[i]] += mass[i]
    region = _region(page, mass / max(mass[0], 1.0))
    inside = np.zeros(len(mass), dtype=bool)
    inside[region] = True
    for i in range(region + 1, len(mass)):
        inside[i] = inside[page.parents[i]]
    return " ".join(t for (t, _, e, _), ok in zip(lines, shown) if ok and inside[e])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in each(batch.column("html"))]
        n = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), n],
            ["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
