"""Main text of web pages by tag ratios.

Parser events are turned into lines, one for each block element. A line's ratio of text to tags is smoothed over
its neighbours with a Gaussian; two clusters of the smoothed ratios of all lines give a threshold. It decides

* which regions of the page count: those with a line of prose (not mostly links) that reaches it;
* whether the page's articles stand for all of it: only if they outweigh the prose beside them;
* which lines of links go: those inside a region that counts which do not reach it;
* whether a part of an article whose name only may mean something else (related, search, share) is content.

Menus, headers, footers, sidebars, notices, adverts, forms and comments that their elements' names, roles and classes
tell never count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices

#: Gaussian over so many lines on each side, with this deviation.
REACH, DEVIATION = 2, 1.0

BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav noscript ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
#: Elements whose text is never content.
OUTSIDE = frozenset("aside button datalist dialog embed fieldset footer form iframe label legend menu nav noscript object optgroup option select svg template textarea title".split())
RAW = frozenset(("script", "style"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold a region's lines together.
MAIN, SECTIONS = frozenset(("article", "main")), frozenset(("section", "div", "td", "body"))
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of an element's class or id that mark what is not content.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|bread\w*|byline|comment|comments|comment-?list|consent|cookie|cookies|disqus|disclaimer|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|notification|outbrain|overlay|pager|pagination|paywall|popup|promo\w*|related|replies|reply|respond|search|share|sharing|sidebar|side-?bar|signup|site-?header|social|sponsor\w*|subscribe|taboola|toolbar|topbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Of these, words that may also name a part of an article; and how much of the article's text such a part has at least.
DOUBTFUL = re.compile(r"^(?:related|search|share|sharing|social|widget)$", re.IGNORECASE)
LEAST_PART = 0.1
#: Share of a line's text in links from which it is a line of links; of a doubtful part's text up to which it is prose.
LINKS, FEW_LINKS = 0.5, 0.25
COMMENTS = re.compile(r"comment|disqus|repl|respond|discussion", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


class Line(NamedTuple):
    text: str
    tags: int
    region: int
    #: Characters in links.
    linked: int = 0

    def of_links(self) -> bool:
        return self.linked >= LINKS * len(self.text)


class _Lines(HTMLParser):
    """Lines of what may be content."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.texts: list[str] = []
        self.linked = 0
        self.in_link = False
        self.tags = 0
        self.open: list[tuple[str, int]] = []  # elements and the region around them
        self.region = 0
        self.regions = 0
        self.mains: set[int] = set()
        self.doubtful: set[int] = set()
        self.outside: list[tuple[str, bool]] = []  # open elements from the first that is not content on

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.texts)).strip()
        if text:
            self.lines.append(Line(text, self.tags, self.region, self.linked))
            self.tags = 0
        self.texts.clear()
        self.linked = 0

    def marked(self, tag: str, attrs) -> str | None:
        """Why an element is not content: a word, or None."""
        if tag in OUTSIDE:
            return tag
        if tag == "header":
            return None if self.region in self.mains else tag
        for name, value in attrs:
            if value:
                if name in ("class", "id") and tag not in ("body", "html") and (found := MARKED.search(value)):
                    return found[0]
                if name == "role" and value.lower() in ROLES or name == "aria-hidden" and value == "true":
                    return value
            elif name == "hidden":
                return name
        return None

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if tag in VOID:
            return
        if self.outside:
            if tag in MAIN and not any(c for _, c in self.outside):
                self.outside.clear()  # what was left open before does not hold the article
            else:
                self.outside.append((tag, False))
                return
        if tag == "a":
            self.in_link = True
        why = self.marked(tag, attrs)
        if why is not None and tag in SECTIONS and self.region in self.mains and DOUBTFUL.match(why.strip(" \t\n_-")):
            self.open.append((tag, self.region))
            self.regions += 1
            self.region = self.regions
            self.mains.add(self.region)
            self.doubtful.add(self.region)
            return
        if why is not None:
            self.outside.append((tag, bool(COMMENTS.search(why))))
            return
        if tag in MAIN or tag in SECTIONS:
            self.open.append((tag, self.region))
            if self.region not in self.mains:
                self.regions += 1
                self.region = self.regions
                if tag in MAIN:
                    self.mains.add(self.region)

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if tag == "a" or tag in BLOCKS:
            self.in_link = False
        if self.outside:
            for k in range(len(self.outside) - 1, -1, -1):
                if self.outside[k][0] == tag:
                    del self.outside[k:]
                    return
            if not any(t == tag for t, _ in self.open):
                return
            self.outside.clear()  # an element around it ends
        if tag in MAIN or tag in SECTIONS:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self.region = self.open[k][1]
                    del self.open[k:]
                    return

    def handle_data(self, data):
        if not self.outside and self.cdata_elem is None:
            self.texts.append(data)
            if self.in_link:
                self.linked += len(data.strip())


def smoothed_ratios(lines: list[Line]) -> np.ndarray:
    """Text to tag ratios of the lines, smoothed; the page's ends count what is there."""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / DEVIATION) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel, "full")[REACH : REACH + len(ratios)]
    return np.convolve(ratios, kernel, "full")[REACH : REACH + len(ratios)] / weights


def threshold(ratios: np.ndarray) -> float:
    """Halfway between the means of two clusters of the ratios; 0 if they do not stand apart."""
    low, high = ratios.min(), ratios.max()
    if high <= 2 * low:
        return 0.0
    while True:
        middle = (low + high) / 2
        below, above = ratios[ratios < middle], ratios[ratios >= middle]
        if not len(below) or not len(above) or (below.mean(), above.mean()) == (low, high):
            return middle
        low, high = below.mean(), above.mean()


def chosen_lines(lines: list[Line], mains: set[int], doubtful: set[int]) -> list[Line]:
    """The lines of content; ``mains`` are the regions of articles, ``doubtful`` those of them that may be none."""
    if not lines:
        return []
    ratios = smoothed_ratios(lines)
    least = threshold(ratios)
    prose = [ratio >= least and not line.of_links() for line, ratio in zip(lines, ratios, strict=True)]
    # An article says itself that it is one: text beside it is not content, unless its prose outweighs the article.
    inside = [line.region in mains for line in lines]
    article = sum(len(line.text) for line, main in zip(lines, inside, strict=True) if main and line.region not in doubtful)
    beside = sum(len(line.text) for line, main, reads in zip(lines, inside, prose, strict=True) if reads and not main)
    if article and article >= beside:
        kept = [k for k, main in enumerate(inside) if main]
        lines = [lines[k] for k in kept]
        if len(kept) < len(ratios):  # what is beside the article says nothing about its lines
            ratios = smoothed_ratios(lines)
            least = threshold(ratios)
            prose = [ratio >= least and not line.of_links() for line, ratio in zip(lines, ratios, strict=True)]
    counts = {line.region for line, reads in zip(lines, prose, strict=True) if reads}
    if not counts:  # links are all there is
        counts = {line.region for line, ratio in zip(lines, ratios, strict=True) if ratio >= least}
        return [line for line in lines if line.region in counts and line.region not in doubtful]
    for region in counts & doubtful:
        size = sum(len(line.text) for line in lines if line.region == region)
        linked = sum(line.linked for line in lines if line.region == region)
        if size < LEAST_PART * article or linked > FEW_LINKS * size:
            counts.discard(region)
    return [
        line
        for line, ratio in zip(lines, ratios, strict=True)
        if line.region in counts and (ratio >= least or not line.of_links())
    ]


def main_text(html: str) -> str:
    """The blocks of the page's content regions, in order, joined by one space."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return " ".join([line.text for line in chosen_lines(parser.lines, parser.mains, parser.doubtful)])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text. Null and empty pages, and those without text, give an empty text.

    A page is read whole, broken markup included; repeated rows are read alike; other columns are
    ignored; an empty table gives an empty one.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(h) if h else "" for h in part.column("html").to_pylist()]
                yield as_batch(schema, part.column("page_id"), part.column("url"), texts)

    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string")
