"""The main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines, one for each block of text, with the number
of tags in it and the element that holds it. Lines inside elements that are never article text (menus, headers,
footers, side bars, forms, scripts, notices, adverts, reader comments, by their tag, role, class or id) have
ratio 0. The ratios of text to tags are smoothed over neighbouring lines; lines over the threshold between the
two clusters of ratios are content. The article or main element around most of the content text, or else the
smallest element that holds all of it, is the content region: its lines, short ones as well, are the text.

A class or id condemns by the thing that it names (`sidebar`, `site-header`, `cookie-notice`), not by a word in it
(`has-sidebar`, `share-enabled`). Names that may as well be a subject (`market-share`, an id `login`) condemn only
what is no prose: less than half of its text is over the threshold. Headings, table cells and inline elements are
not judged by name, paragraphs and list items by class only. A form, and an element condemned by name, that holds
most of the content is kept, unless there is an article or main element with content beside it.

A page is one row and is worked on by itself; there is no shuffle.

Defined results: null and empty pages, and pages without article text, give the empty text; elements left open
end where their parent ends; a br is white space; repeated rows give repeated results; null ids and urls are
passed on; extra columns are not read; pages of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import words as W

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split())
_HOLDER = frozenset("html body main article section div td center blockquote".split())
_NEVER = frozenset(
    "aside button canvas datalist dialog footer head header iframe input label menu nav noscript object select "
    "script style svg template textarea".split())
_NEVER_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
_NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo promoted promotion related replies reply share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar widget".split())
#: what an opening tag ends, up to the nearest of the second set
_ENDS = {
    "p": ({"p"}, {"div", "td", "li", "section", "article", "main", "body", "blockquote"}),
    "li": ({"li"}, {"ul", "ol", "menu"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: blocks end an open paragraph
_ENDS_P = _BLOCK - {"html", "head", "body", "title", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
_NAME = re.compile(r"[a-z]+")
#: first words that tell the state of an element, and last words that leave the naming to the first
_STATES = frozenset(
    "can disable disabled enable enabled has have hide is no non not off on show supports when with without".split())
_PARTS = frozenset(
    "area bar block bottom box btn button buttons col column container content form group holder icon icons inner item "
    "items left link links list message notice outer panel right row section slot thread title toggle top unit wrap "
    "wrapper zone".split())


#: last words that may as well name a subject, first words that say they do not, and wrappers of an article's title
_WEAK = frozenset(
    "ad banner consent header login menu modal popup promotion related reply replies share sharing social subscription "
    "toolbar widget".split())
_SITES = frozenset("article entry global main mobile nav page post site sticky story top user".split())
_TITLED = frozenset("article card chapter content entry heading post section story table title".split())
#: not judged by class or id, and judged by class only
_UNNAMED = frozenset(
    "h1 h2 h3 h4 h5 h6 td th a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong "
    "sub sup time tt u var".split())
_BY_CLASS = frozenset("p li dd dt pre blockquote figcaption".split())


def _condemns(token: str, attribute: str) -> int:
    """Whether a class or id names what is never article text, by its last word or the first before a mere part:
    0 no, 1 only if it is no prose, 2 yes."""
    words = _NAME.findall(token)
    if not words or len(words) > 1 and words[0] in _STATES:
        return 0
    while len(words) > 1 and words[-1] in _PARTS and words[-1] not in _NEVER_WORDS:
        words.pop()
    last, before = words[-1], words[:-1]
    if last not in _NEVER_WORDS:
        return 0
    if last == "header" and before and before[-1] in _TITLED:
        return 0
    if last not in _WEAK:
        return 2
    known = any(w in _NEVER_WORDS or w in _SITES for w in before)
    return 2 if known or not before and attribute == "class" else 1


class _Lines(HTMLParser):
    """The lines of a page: (text, tags, holder, content or not); holders: parent and tag of each."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, holder, never
        self.named: list[int] = []  # of each open element: the innermost mark around it, or -1
        self.marks: list[int] = []  # the same of each line
        self.marked: list[tuple[int, int]] = []  # of each mark: the mark around it, and how much it condemns
        self.holders: list[tuple[int, str]] = [(-1, "html")]
        self.lines: list[tuple[str, int, int, bool]] = []
        self.parts: list[str] = []
        self.tags = 0

    def _never(self, tag: str, attrs) -> bool:
        if tag in ("html", "body", "main", "article"):
            return False
        if tag in _NEVER:
            return True
        for name, value in attrs:
            if value and name in ("class", "id", "role", "aria-label"):
                names = _NAME.findall(value.lower())
                if name == "role" and not _NEVER_ROLES.isdisjoint(names):
                    return True
            if name in ("hidden",) or name == "aria-hidden" and value == "true":
                return True
        return False

    @staticmethod
    def _named(tag: str, attrs) -> int:
        """How much the tag form, or else a class or id, condemns."""
        if tag == "form":
            return 2
        if tag in ("html", "body", "main", "article") or tag in _UNNAMED:
            return 0
        judged = ("class",) if tag in _BY_CLASS else ("class", "id")
        return max((_condemns(token, name) for name, value in attrs if value and name in judged
                    for token in value.lower().split()), default=0)

    def _line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, holder, never = self.open[-1] if self.open else ("", 0, False)
            self.lines.append((text, self.tags, holder, not never))
            self.marks.append(self.named[-1] if self.open else -1)
        self.parts, self.tags = [], 0

    def _close(self, tag: str, up_to: frozenset[str] | set[str] = frozenset()) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                self._line()
                del self.open[i:], self.named[i:]
                return
            if name in up_to:
                return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in _ENDS:
            for name in _ENDS[tag][0]:
                self._close(name, _ENDS[tag][1])
        elif tag in _ENDS_P:
            self._close("p", _ENDS["p"][1])
        if tag in _BLOCK:
            self._line()
            self.tags = 1
        if tag in _VOID:
            return
        _, holder, never = self.open[-1] if self.open else ("", 0, False)
        if never and tag in ("h1", "h2") and any(t == "article" for t, _, _ in self.open):
            # the heading of an article may stand in a header element of the article
            never = not all(t == "header" or not n for t, _, n in self.open)
        if tag in _HOLDER:
            self.holders.append((holder, tag))
            holder = len(self.holders) - 1
        mark = self.named[-1] if self.open else -1
        level = self._named(tag, attrs)
        if level:
            self.marked.append((mark, level))
            mark = len(self.marked) - 1
        self.named.append(mark)
        self.open.append((tag, holder, never or self._never(tag, attrs)))

    def handle_startendtag(self, tag, attrs):
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        elif tag in _BLOCK:
            self._line()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "p" and not any(t == "p" for t, _, _ in self.open):
            self._line()
        elif tag in _BLOCK or any(t == tag for t, _, _ in self.open[-8:]):
            self._close(tag) if tag in _BLOCK else self._inline(tag)

    def _inline(self, tag: str) -> None:
        """An inline end tag closes its element, but no block around it."""
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                outside = self.named[i - 1] if i else -1
                if self.open[i][2] or self.named[i] != outside:  # text of a never element is no part of the line around it
                    self._line()
                del self.open[i:], self.named[i:]
                return
            if name in _BLOCK:
                return

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        self.parts.append(data)


def _smoothed(ratios: list[float], radius: int = 2) -> list[float]:
    kernel = [math.exp(-(d * d) / 2) for d in range(-radius, radius + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(kernel[d + radius], ratios[i + d]) for d in range(-radius, radius + 1) if 0 <= i + d < len(ratios)]
        out.append(sum(k * r for k, r in near) / sum(k for k, _ in near))
    return out


def _threshold(values: list[float]) -> float:
    """The border of two clusters of the values: half-way between their means, from the extremes on."""
    low, high = min(values), max(values)
    for _ in range(30):
        border = (low + high) / 2
        below, above = [v for v in values if v < border], [v for v in values if v >= border]
        new = (sum(below) / len(below) if below else low, sum(above) / len(above) if above else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _ratios(lines: list[tuple[str, int, int, bool]]) -> tuple[list[float], float]:
    """The smoothed ratios of text to tags, and the border over which a line is content."""
    smooth = _smoothed([len(text) / max(1, tags) if good else 0.0 for text, tags, _, good in lines])
    return smooth, _threshold(smooth)


def _judged(page: _Lines) -> list[tuple[str, int, int, bool]]:
    """The lines less those condemned by name or as forms; what holds most of the content is not condemned."""
    if not page.marked or not any(good for *_, good in page.lines):
        return page.lines
    smooth, border = _ratios(page.lines)
    inside = [False] * len(page.holders)  # an article or main element
    for h, (parent, tag) in enumerate(page.holders):
        inside[h] = tag in ("article", "main") or parent >= 0 and inside[parent]
    weight, everything = [0] * len(page.marked), [0] * len(page.marked)
    for (text, _, _, good), value, mark in zip(page.lines, smooth, page.marks):
        if good and mark >= 0:
            everything[mark] += len(text)
            weight[mark] += len(text) if value >= border else 0
    for m in range(len(page.marked) - 1, -1, -1):  # marks come before those inside them
        around = page.marked[m][0]
        if around >= 0:
            weight[around] += weight[m]
            everything[around] += everything[m]
    # of each mark: condemned by itself; prose under a name that may be a subject is not
    bad = [level == 2 or 2 * weight[m] < everything[m] for m, (_, level) in enumerate(page.marked)]

    def condemned() -> list[bool]:
        out: list[bool] = []
        for m, (around, _) in enumerate(page.marked):
            out.append(bad[m] or around >= 0 and out[around])
        return out

    out = condemned()
    over = [(len(text), holder, mark) for (text, _, holder, good), value, mark in zip(page.lines, smooth, page.marks)
            if good and value >= border]
    total = sum(n for n, _, _ in over)
    if not any(inside[holder] and (mark < 0 or not out[mark]) for _, holder, mark in over):
        bad = [b and 2 * weight[m] <= total for m, b in enumerate(bad)]
        out = condemned()
    return [(text, tags, holder, good and (mark < 0 or not out[mark]))
            for (text, tags, holder, good), mark in zip(page.lines, page.marks)]


def _region(lines: list[tuple[str, int, int, bool]], holders: list[tuple[int, str]]) -> set[int]:
    """The holder that the content is in, with all holders inside it."""
    smooth, border = _ratios(lines)
    weight, total = [0] * len(holders), 0
    everything = [0] * len(holders)
    for (text, _, holder, good), value in zip(lines, smooth):
        if good:
            everything[holder] += len(text)
            if value >= border:
                weight[holder] += len(text)
                total += len(text)
    if not total:
        weight, total = list(everything), sum(everything)
    for h in range(len(holders) - 1, 0, -1):  # parents come before their children
        weight[holders[h][0]] += weight[h]
        everything[holders[h][0]] += everything[h]
    best = max(h for h in range(len(holders)) if weight[h] >= 0.6 * total)
    at, around = best, None
    while at >= 0:
        if holders[at][1] == "article" or holders[at][1] == "main" and around is None:
            around = at
            if holders[at][1] == "article":
                break
        at = holders[at][0]
    if around is not None:
        best = around
    else:  # all content, and a heading or a lead beside it, belongs to the article
        while weight[best] < total:
            best = holders[best][0]
        while holders[best][0] > 0 and holders[holders[best][0]][1] not in ("html", "body") and \
                everything[best] >= 0.65 * everything[holders[best][0]]:
            best = holders[best][0]
    inside = {best}
    for h in range(best + 1, len(holders)):
        if holders[h][0] in inside:
            inside.add(h)
    return inside


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by empty lines."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page._line()
    lines = _judged(page)
    if not any(good for *_, good in lines):
        return ""
    inside = _region(lines, page.holders)
    return "\n\n".join(text for text, _, holder, good in lines if good and holder in inside)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.portions(batches, "html"):
        texts = [main_text(html) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(_rows, "page_id long, url string, text string, n_chars long")
