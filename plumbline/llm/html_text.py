"""Main text of web pages from parser events, text-to-tag ratios and a clustered threshold.

The standard library's streaming parser turns a page into lines: a line ends where a block element
starts or ends. A line's ratio is its characters over the tags met on it; lines in elements that
are never content (menus, forms, adverts, comments and the like, by element, role, class or id)
have ratio zero. Ratios are smoothed over neighbouring lines with a Gaussian and parted into two
clusters by the threshold halfway between the clusters' means. Lines above it are content, and
choose what is taken whole, other lines included. Where most of their characters stand in ``article``
or ``main`` elements, these are the regions: each with a line above the threshold by its own ratio too,
not by its neighbours' alone. An article in an article is part of it; one in ``main`` is a region of its
own, and with it go the lines that ``main`` has outside its articles. Elsewhere it is the content lines
and, with all in them, the containers that have such a line; of ``body`` itself only its own lines and
its lists, quotes, tables and figures, as the rest is the whole page. Never-content lines stay out
everywhere.

What classes, ids, roles and ``form`` say of an element is doubtful, since pages are wrapped in forms and
bodies named after what they lack. A class counts where its name ends in such a word (``left-sidebar``), or
begins with one and ends in a word for a container (``comment-list``), not where it denies or describes
(``no-sidebar``, ``comments-open``); never on ``html``, ``body``, ``main`` and ``article``; and an element
that has most of the page's text and its heading, article or main element, or a form that has nearly all of
the text, is none.

Character references are decoded by the parser; white space in a line becomes one blank. A page takes
time in proportion to its length, whatever tags it leaves open or closes without need.

Defined cases: a null or empty page, and one without text, gives the empty text; unclosed and
stray tags are forgiven as browsers do for paragraphs and list items; marked sections and other
declarations are passed over up to their ``>`` (or, unclosed, to the end of the page); bytes that are no
UTF-8 become U+FFFD; repeated rows each give a row; an empty table gives none; only the named columns
are read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import kind, map_batches

SIGMA = 2.0

#: Fixed names of HTML: elements without an end tag, elements that break a line.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody tfoot thead title tr ul".split()
)
#: Elements whose text is never content.
NEVER = frozenset(
    "applet audio button canvas datalist dialog footer form head iframe input map math menu nav "
    "noscript object optgroup option script select style svg template textarea title video aside".split()
)
#: Elements inside which a paragraph or list item stays open until its container ends.
CONTAINER = BLOCK - frozenset("p li dt dd option h1 h2 h3 h4 h5 h6".split())
REGION = frozenset(("article", "main"))
#: The page itself, and what belongs to the text around it wherever it stands.
PAGE = frozenset(("", "html", "body"))
FLOW = frozenset("blockquote details dl figure ol pre table ul".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
#: Words in a class or id that mark what is not content, wherever it stands.
MARKS = frozenset(
    "ad ads advert advertisement advertisements advertising adverts aside banner banners breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies discussion disqus gdpr login "
    "menu menus modal nav navbar navigation newsletter notice notices overlay pagination pager popup "
    "promo promotion promotions recommended related replies reply respond share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Words that do so outside articles only: an article may have a header of its own.
OUTER = frozenset("footer header masthead copyright topbar".split())
#: Last words of a name that begins with a mark, and first words of a name that only tells of one.
CARRIERS = frozenset(
    "area bar block blocks body bottom box button buttons card cards col column container footer form "
    "group header holder icons inner item items left link links list main outer panel placeholder posts right row "
    "section slot strip text thread toggle top unit wrap wrapper".split()
)
DENIALS = frozenset("has hide is no not show with without".split())
#: Elements whose own class or role never makes them anything else.
SURE = REGION | {"html", "body"}
#: A marked element with its heading or region and so much of the text is none; nor is a form without either
#: that has nearly all of it and more text than fields have.
MOST, NEARLY_ALL, FORM_TEXT = 0.5, 0.9, 500
#: Never content whatever it holds.
CERTAIN = -1

_NAME = re.compile(r"[a-z]+|[A-Z](?:[a-z]+|[A-Z]*(?![a-z]))")


def marked(name: str, marks: frozenset[str]) -> bool:
    """Whether a class or id says that its element is something that the marks name."""
    words = [w.lower() for w in _NAME.findall(name)]
    if not words or words[0] in DENIALS:
        return False
    return words[-1] in marks or (words[0] in marks and words[-1] in CARRIERS) or "".join(words) in marks


class Lines(HTMLParser):
    """Collects the lines of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: open elements: name, CERTAIN or number of the mark or 0, number of the region or 0, number of the container
        self.open: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]
        #: places among them of each name, and of all containers
        self.places: dict[str, list[int]] = {}
        self.barriers: list[int] = []
        self.parts: list[str] = []
        self.tags = 0
        #: of each container its name and the one around it; of each region whether an article, and the one around it
        self.containers: list[tuple[str, int]] = [("", 0)]
        self.regions: list[tuple[bool, int]] = [(False, 0)]
        #: of each marked element the one around it, whether it is a form, and whether it has a heading or region
        self.marks: list[tuple[int, bool]] = [(0, False)]
        self.heads: list[bool] = [False]
        #: text, tags, CERTAIN or mark, region, container
        self.lines: list[tuple[str, int, int, int, int]] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, mark, region, container = self.open[-1]
            self.lines.append((text, self.tags, mark, region, container))
            self.tags = 0
        self.parts = []

    def _close(self, names: tuple[str, ...], bounded: bool) -> None:
        """Ends the last open element of these names, if ``bounded`` only inside the last container."""
        at = max((self.places[n][-1] for n in names if self.places.get(n)), default=0)
        if not at or (bounded and self.barriers and self.barriers[-1] > at):
            return
        while len(self.open) > at:
            name = self.open.pop()[0]
            self.places[name].pop()
            if self.barriers and self.barriers[-1] == len(self.open):
                self.barriers.pop()

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCK
        if block:
            self.end_line()
            if tag in ("li", "dt", "dd", "option"):
                self._close(("dt", "dd") if tag in ("dt", "dd") else (tag,), True)
            self._close(("p",), True)
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "wbr", "hr", "img", "input"):
                self.parts.append("" if tag == "wbr" else " ")
            return
        if tag in ("td", "th"):
            self.parts.append(" ")
        _, mark, region, container = self.open[-1]
        if mark != CERTAIN:
            given = dict(attrs)
            if tag in NEVER and tag != "form" or (tag == "header" and not region) or self._hidden(given):
                mark = CERTAIN
            elif tag == "form" or (tag not in SURE and self._marked(given, region)):
                self.marks.append((mark, tag == "form"))
                self.heads.append(False)
                mark = len(self.marks) - 1
            if mark > 0 and (tag == "h1" or tag in REGION):
                self.heads[mark] = True
        if tag in CONTAINER:
            self.containers.append((tag, container))
            container = len(self.containers) - 1
        if tag in REGION and not self.regions[region][0]:
            self.regions.append((tag == "article", region))
            region = len(self.regions) - 1
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in CONTAINER:
            self.barriers.append(len(self.open))
        self.open.append((tag, mark, region, container))

    def _hidden(self, attrs: dict) -> bool:
        if "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        return "display:none" in (attrs.get("style") or "").replace(" ", "").lower()

    def _marked(self, attrs: dict, region: int) -> bool:
        if (attrs.get("role") or "").lower() in ROLES:
            return True
        marks = MARKS if region else MARKS | OUTER
        return any(marked(n, marks) for n in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split())

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in ("td", "th"):
            self.parts.append(" ")
        # an inline end tag does not reach over a block
        self._close((tag,), tag not in BLOCK)

    def handle_data(self, data):
        if self.open[-1][0] not in ("script", "style"):
            self.parts.append(data)

    # Where markup is not closed, what the parser takes for it runs to the page's end, as in browsers:
    # it is looked for once, not again from each place where some begins.

    def parse_comment(self, i, report=True):
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def parse_html_declaration(self, i):
        """Comments as the parser takes them; of all other declarations nothing is used."""
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def parse_pi(self, i):
        return len(self.rawdata) if i > self.last else super().parse_pi(i)

    def parse_starttag(self, i):
        return len(self.rawdata) if i > self.last else super().parse_starttag(i)

    def parse_endtag(self, i):
        return len(self.rawdata) if i > self.last else super().parse_endtag(i)

    def page(self, html: str) -> list[tuple[str, int, bool, int, int]]:
        """The lines: text, tags, never content, region, container."""
        self.rawdata, self.last = html, html.rfind(">")
        self.close()
        self.end_line()
        sizes = [0] * len(self.marks)
        for text, _, mark, _, _ in self.lines:
            if mark != CERTAIN:
                sizes[mark] += len(text)
        total = sum(sizes)
        for mark in range(len(self.marks) - 1, 0, -1):  # a mark stands behind the one around it
            around = self.marks[mark][0]
            sizes[around] += sizes[mark] if around else 0
            self.heads[around] |= self.heads[mark]
        void = [True] * len(self.marks)  # the mark and those around it say nothing
        for mark in range(1, len(self.marks)):
            around, form = self.marks[mark]
            wraps = self.heads[mark] and sizes[mark] > MOST * total
            wraps |= form and sizes[mark] > max(NEARLY_ALL * total, FORM_TEXT)
            void[mark] = void[around] and wraps
        return [
            (text, tags, mark == CERTAIN or not void[mark], region, container)
            for text, tags, mark, region, container in self.lines
        ]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends the weights are shared among the lines there are."""
    reach = int(np.ceil(3 * sigma))
    x = np.arange(-reach, reach + 1)
    weights = np.exp(-(x**2) / (2 * sigma**2))
    n = len(ratios)
    total = np.convolve(ratios, weights)[reach : reach + n]
    return total / np.convolve(np.ones(n), weights)[reach : reach + n]


def threshold(values: np.ndarray) -> float:
    """Halfway between the means of two clusters, from the middle of the range until it rests."""
    at = (values.min() + values.max()) / 2
    for _ in range(100):
        high = values >= at
        if high.all() or not high.any():
            break
        new = (values[high].mean() + values[~high].mean()) / 2
        if new == at:
            break
        at = new
    return at


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The content lines of a page, joined by line breaks."""
    parser = Lines()
    lines = parser.page(html) if html else []
    if not any(not never for _, _, never, _, _ in lines):
        return ""
    ratios = np.array(
        [0.0 if never else len(text) / max(1, tags) for text, tags, never, _, _ in lines]
    )
    smooth = smoothed(ratios, sigma)
    open_ = np.array([not never for _, _, never, _, _ in lines])
    least = threshold(smooth)
    content = (smooth >= least) & open_
    if not content.any():  # the smooth peak lies on lines that are never content
        content = open_ & (smooth >= smooth[open_].max())
    strong = content & (ratios >= least)
    if not strong.any():
        strong = content
    regions = np.array([region for *_, region, _ in lines])
    containers = np.array([c for *_, c in lines])
    sizes = np.array([len(text) for text, *_ in lines])
    if 2 * sizes[strong & (regions > 0)].sum() >= sizes[strong].sum():
        taken = set(regions[strong & (regions > 0)].tolist())
        for region in list(taken):
            while (region := parser.regions[region][1]) and region not in taken:
                taken.add(region)
        chosen = open_ & np.isin(regions, list(taken))
    else:
        whole = np.zeros(len(parser.containers), bool)
        whole[containers[strong]] = True
        for c, (name, around) in enumerate(parser.containers):
            whole[c] |= whole[around] and (name in FLOW or parser.containers[around][0] not in PAGE)
        chosen = open_ & (content | whole[containers])
    return "\n".join(lines[i][0] for i in np.flatnonzero(chosen))


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", sigma: float = SIGMA
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    schema = T.StructType(
        [
            T.StructField("page_id", kind(pages, key)),
            T.StructField("url", kind(pages, url)),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def make():
        def work(batch):
            texts = [main_text(h.as_py(), sigma) for h in batch.column(2)]
            return {
                "page_id": batch.column(0),
                "url": batch.column(1),
                "text": texts,
                "n_chars": [len(t) for t in texts],
            }

        return work

    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html")
    )
    return map_batches(rows, make, schema)
