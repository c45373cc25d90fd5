"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams tags and text; block tags cut them into lines. Each line's ratio of text to tags
is smoothed with a Gaussian over its neighbours, and a threshold between the two clusters of smoothed ratios selects
lines. The selected lines choose content regions, from the page inwards: an article or main with a selected line is
one; so is a container that consists for at least half of selected text, as do the containers in it, and holds neither menus nor the like; other
containers are looked into. There a line follows its own ratio, what stands between the title or first selected line
and the last one stays, and what is mostly links goes. Short lines inside a region stay.

Left out before are only elements whose tag says so (scripts, forms, menus, footers, asides, headers outside an article)
and those whose class, id or role says nothing else (:func:`marked`: ``ad`` or ``site-header``, not ``ad-hoc`` or
``related-work``). Such a name doesn't count where the ratios disagree: where the element holds nearly all
selected text (HOLDS) of a page without an article or main, unless it says comments. A form or nav that holds nearly all
of a page's text (a body in one form, a nav that was never closed) is judged like such a name too.

Elements may be nested as deep as a page likes, and a declaration that is none ends where browsers let it end: time grows with the
page, and no page ends the job.

Defined results: null or empty html gives an empty text. White space inside a block is one space, blocks are joined by a
newline, nothing else is dropped or cut off. Unclosed and stray tags are allowed. Repeated rows get equal texts.
Extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

#: HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th img".split())
APART = frozenset(
    "head title script style noscript template nav footer aside form menu dialog select option textarea input iframe object svg canvas audio video".split()
)
#: Of these the ones that may hold a whole page: by mistake, where one isn't closed, or by an old habit.
WRAPPING = frozenset("form nav".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REGIONS = frozenset("article main section div td body html".split())
LAYOUT = frozenset("page html body".split())
#: Words in class and id, and roles, of what isn't the article; those of reader comments.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond".split())
APART_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs consent cookie cookies "
    "footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notification overlay pagination pager popup promo promoted "
    "recommended related share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Words that say where or how such an element stands; a name with any other word doesn't count.
PLACE_WORDS = frozenset(
    "aside area article articles bar block bottom box body btn button buttons col column container content desktop fixed floating form global group holder icons inner item items label left "
    "link links list main media mobile outer page panel placeholder post posts primary right row secondary section site slot sticky stories text thread top unit wrap wrapper zone".split()
)
APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
_WORDS = re.compile(r"[a-z0-9]+")
#: A closing p is implied by these.
_ENDS_P = BLOCK - {"html", "body"}

SIGMA = 2.0
#: The clusters count as two where the mean of one is this many times that of the other.
APART_BY = 2.0
HOLDS = 0.9
#: Characters outside links from which a form or nav with HOLDS of all text is taken for the page's wrapper.
WRAPPED = 200


@functools.lru_cache(1 << 16)
def marked(names: str) -> str:
    """What a class or id says of its element: ``comments``, ``apart`` or nothing.

    A name counts if it has a word of APART_WORDS and no word beyond these, PLACE_WORDS and numbers.
    """
    out = ""
    for name in names.lower().split():
        words = [w for w in _WORDS.findall(name) if not w.isdigit()]
        if any(w in APART_WORDS for w in words) and all(w in APART_WORDS or w in PLACE_WORDS for w in words):
            out = "comments" if out == "comments" or any(w in COMMENT_WORDS for w in words) else "apart"
    return out


class Line:
    """A line of a page; ``apart``: left out by a tag; ``marks``: the marked elements around it."""

    __slots__ = ("pieces", "tags", "region", "apart", "marks", "linked", "pressed", "heading")

    def __init__(self, pieces: list[str], region: int, apart: bool, marks: tuple[int, ...], heading: str):
        self.pieces, self.tags, self.region, self.apart, self.marks, self.heading = pieces, 1, region, apart, marks, heading
        self.linked = self.pressed = 0  # characters in links and in buttons


class Lines(HTMLParser):
    """The lines of a page; ``open`` is the line that further text joins."""

    def __init__(self, wrapping: bool = False):
        """``wrapping``: forms and navs are judged by the ratios, as elements with such names are."""
        super().__init__(convert_charrefs=True)
        self.wrapping = wrapping
        self.lines: list[Line] = []
        self.stack: list[tuple[str, int, tuple[int, ...]]] = []  # element, 1 within a form or nav and 2 within others of APART, the marked elements around
        self.many: Counter[str] = Counter()  # open elements by name
        self.headings: list[str] = []  # open ones
        self.regions: list[tuple[str, int]] = [("page", -1)]  # (element, outer region)
        self.named = [False]  # whether a region is in an article or main
        self.marked: list[str] = []  # what each marked element says
        self.inside = [0]
        self.open: Line | None = None
        self.lost = 0  # characters outside links that a form or nav alone leaves out

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A declaration of no known kind ends at the next sign of its end, as browsers read it; the parser gives up at some."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return len(self.rawdata) if end < 0 else end + 1

    def _apart(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _says(self, tag: str, attrs: list) -> str:
        """What the names of an element say; a heading's are made of its own text."""
        if tag in HEADINGS or tag in ("body", "html", "main"):
            return ""
        out = ""
        for k, v in attrs:
            if v and k in ("class", "id"):
                out = max(out, marked(v))  # comments goes before apart by its order
            elif v and k == "role" and v.lower() in APART_ROLES:
                out = out or "apart"
        if tag == "header" and not self.many["article"] and not self.many["main"] or tag in WRAPPING:
            out = out or "apart"
        return "" if tag == "article" and out == "apart" else out

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self._void(tag)
            return
        if tag in _ENDS_P and self.many["p"]:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == "p":
                    self._close(k)
                    break
                if self.stack[k][0] in BLOCK:
                    break
        apart, marks = self.stack[-1][1:] if self.stack else (0, ())
        if tag in ("article", "main") and not any(self.marked[m] == "comments" for m in marks):
            marks = ()  # an advert or notice that was never closed, or a wrapper
        if apart < 2:
            own = 0 if tag not in APART else 2 if tag not in WRAPPING else 0 if self.wrapping else 1
            apart = max(apart, own, 2 * any(k == "hidden" for k, _ in attrs))
        if not apart:
            if says := self._says(tag, attrs) if attrs or tag == "header" or tag in WRAPPING else "":
                marks = (*marks, len(self.marked))
                self.marked.append(says)
        self.stack.append((tag, apart, marks))
        self.many[tag] += 1
        if tag in HEADINGS:
            self.headings.append(tag)
        if tag in REGIONS:
            self.regions.append((tag, self.inside[-1]))
            self.named.append(self.named[self.inside[-1]] or tag in ("article", "main"))
            self.inside.append(len(self.regions) - 1)
        if tag in BLOCK:
            self.open = None
        elif tag in SPACED and self.open:
            self.open.pieces.append(" ")
        self._count()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self._void(tag)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def _void(self, tag: str) -> None:
        if tag in BLOCK:
            self.open = None
        elif tag in SPACED and self.open:
            self.open.pieces.append(" ")
        self._count()

    def handle_endtag(self, tag: str) -> None:
        if self.many[tag]:
            k = len(self.stack) - 1
            while self.stack[k][0] != tag:
                k -= 1
            self._close(k)
        self._count()

    def _close(self, k: int) -> None:
        for tag, *_ in self.stack[k:]:
            self.many[tag] -= 1
            if tag in HEADINGS:
                self.headings.pop()
            if tag in REGIONS:
                self.inside.pop()
            if tag in BLOCK:
                self.open = None
            elif tag in SPACED and self.open:
                self.open.pieces.append(" ")
        del self.stack[k:]

    def _count(self) -> None:
        if self.lines:
            (self.open or self.lines[-1]).tags += 1

    def handle_data(self, data: str) -> None:
        if self._apart():
            if not self.lines or not self.lines[-1].apart:
                self.lines.append(Line([], self.inside[-1], True, (), ""))
            if self._apart() == 1 and not self.many["a"]:
                self.lost += len("".join(data.split()))
            return
        if self.open:
            self.open.pieces.append(data)
        elif data.strip():
            marks = self.stack[-1][2] if self.stack else ()
            self.open = Line([data], self.inside[-1], False, marks, self.headings[0] if self.headings else "")
            self.lines.append(self.open)
        if self.open:
            size = len("".join(data.split()))
            self.open.linked += size if self.many["a"] else 0
            self.open.pressed += size if self.many["button"] else 0


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """A Gaussian average of each ratio and its neighbours."""
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weights


def threshold(values: np.ndarray) -> float:
    """Between the two clusters of the values, 2-means in one dimension; their least value where the clusters are close."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        under, over = values[values <= cut], values[values > cut]
        if not len(over) or not len(under):
            break
        new = float(under.mean()), float(over.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high >= APART_BY * low else float(values.min())


def selected(sizes: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines the smoothed ratios of text to tags select; a line without text never is."""
    if not sizes.any():
        return np.zeros(len(sizes), bool)
    even = smoothed(sizes / tags)
    return (even >= threshold(even)) & (sizes > 0)


class Tally:
    """What stands in a region: its parts in order, selected and all text, and whether there are menus or the like."""

    __slots__ = ("parts", "text", "chosen", "linked", "layout")

    def __init__(self):
        self.parts: list[tuple[bool, int]] = []  # (is it a line, its number)
        self.text = self.chosen = self.linked = 0
        self.layout = False


def content(page: Lines, sizes: np.ndarray, out: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which lines are in content regions; ``out``: lines left out before."""
    tallies = [Tally() for _ in page.regions]
    placed = [False] * len(tallies)
    placed[0] = True
    for i, line in enumerate(page.lines):
        k, new = line.region, []
        while not placed[k]:
            placed[k] = True
            new.append(k)
            k = page.regions[k][1]
        for inner in reversed(new):  # outer regions have been placed
            tallies[page.regions[inner][1]].parts.append((False, inner))
        t = tallies[line.region]
        t.parts.append((True, i))
        if out[i]:
            t.layout = True
        else:
            t.text += int(sizes[i])
            t.chosen += int(sizes[i]) * bool(chosen[i])
            t.linked += line.linked
    for k in range(len(tallies) - 1, 0, -1):  # an inner region has the greater number
        t, around = tallies[k], tallies[page.regions[k][1]]
        around.text, around.chosen, around.linked = around.text + t.text, around.chosen + t.chosen, around.linked + t.linked
        around.layout = around.layout or t.layout
    keep = np.zeros(len(page.lines), bool)

    def mostly_links(linked: int, text: int) -> bool:
        return text > 0 and 2 * linked > text

    def whole(k: int) -> None:
        inner = [k]
        while inner:
            for is_line, j in tallies[inner.pop()].parts:
                if is_line:
                    keep[j] = not out[j]
                else:
                    inner.append(j)

    def look(k: int) -> None:
        t, tag = tallies[k], page.regions[k][0]
        if not t.chosen:
            return
        if tag in ("article", "main"):
            whole(k)
            return
        parts = [tallies[j] for is_line, j in t.parts if not is_line]
        if tag not in LAYOUT and not t.layout and all(2 * x.chosen >= x.text and not mostly_links(x.linked, x.text) for x in [t, *parts]):
            whole(k)
            return
        holds = [bool(chosen[j]) if is_line else tallies[j].chosen > 0 for is_line, j in t.parts]
        first, last = holds.index(True), len(holds) - 1 - holds[::-1].index(True)
        first = next((at for at, (is_line, j) in enumerate(t.parts[:first]) if is_line and not out[j] and page.lines[j].heading == "h1"), first)  # an article starts with its title
        for at, (is_line, j) in enumerate(t.parts):
            if is_line:
                title = bool(page.lines[j].heading) and at <= last
                keep[j] = not out[j] and (bool(chosen[j]) or first < at < last or title) and not mostly_links(page.lines[j].linked, int(sizes[j]))
            elif holds[at]:
                waiting.append(j)
            elif first < at < last and not mostly_links(tallies[j].linked, tallies[j].text):
                whole(j)

    waiting = [0]  # regions may be nested as deep as a page likes
    while waiting:
        look(waiting.pop())
    return keep


def extract(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    page = parsed(html)
    kept = _extracted(page)
    if page.lost >= WRAPPED and page.lost > HOLDS * (page.lost + len("".join(kept.split()))):
        return _extracted(parsed(html, wrapping=True))
    return kept


def parsed(html: str, wrapping: bool = False) -> Lines:
    page = Lines(wrapping)
    page.feed(html)
    page.close()
    return page


def _extracted(page: Lines) -> str:
    if not page.lines:
        return ""
    texts = [" ".join("".join(x.pieces).split()) for x in page.lines]
    sizes = np.array([len(t) for t in texts])
    tags = np.array([x.tags for x in page.lines])
    out = np.array([x.apart or 0 < len("".join(t.split())) == x.pressed for x, t in zip(page.lines, texts, strict=True)])
    if page.marked:
        # a name says apart only where the ratios agree: no advert or header holds nearly all that they select
        first = selected(np.where(out, 0, sizes), tags)
        held = np.zeros(len(page.marked), np.int64)
        named = False
        for x, n, c in zip(page.lines, sizes, first, strict=True):
            for m in x.marks:
                held[m] += n * c
            named = named or bool(c) and not x.marks and page.named[x.region]
        counts = [says == "comments" or named or held[m] <= HOLDS * (sizes * first).sum() for m, says in enumerate(page.marked)]
        out |= np.array([any(counts[m] for m in x.marks) for x in page.lines])
    sizes = np.where(out, 0, sizes)
    keep = content(page, sizes, out, selected(sizes, tags))
    return "\n".join(t for t, k in zip(texts, keep, strict=True) if k and t)


SCHEMA = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, in place: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html", 1 << 20):
                texts = [extract(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, SCHEMA)
