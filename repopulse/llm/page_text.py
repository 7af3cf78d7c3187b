"""Main text of HTML pages by minimum-cut labelling of their text blocks.

A page is parsed into text blocks with the elements around them. A linear classifier gives each
block a leaning towards content or boilerplate, which becomes its capacity to one of the
terminals. Neighbours in page order and neighbours in the document tree are joined by edges, the
heavier the more of their ancestors they share. The minimum cut separates content from boilerplate.

Pages are independent: one scan, no shuffle. A null or empty page has an empty text. A page of any
length is taken whole, by one task, in time about proportional to its length: an element sums up what
the elements around it say, so a block only looks at its innermost one, and the cut folds chains.
Broken markup never fails: unclosed and unopened tags are tolerated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.min_cut import label

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text.
SILENT = frozenset("script style head noscript template svg math canvas object iframe audio video map".split())
#: A tag that opens closes these, if they are still open, up to the nearest element of _SCOPE.
CLOSES = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
} | {tag: {"p"} for tag in BLOCKS - {"p", "li", "dt", "dd", "tr", "td", "th", "option", "body", "html"}}
_SCOPE = frozenset("table ul ol dl div article section main nav aside form header footer body html blockquote select".split())
_TURNS = _SCOPE.union(*CLOSES.values())

#: Leanings of the classifier, in capacity units: positive towards content.
BOILERPLATE_TAGS = {"nav": -60, "footer": -60, "aside": -60, "form": -60, "menu": -60, "button": -60, "select": -60,
                    "dialog": -60, "search": -60, "textarea": -60, "label": -60, "header": -60}
CONTENT_TAGS = {"article": 12, "main": 8, "blockquote": 3, "p": 4, "pre": 3}
NAMED_BOILERPLATE = -50
NAMED_CONTENT = 6
#: Words in a class, id or role that mark boilerplate, and content.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner banners breadcrumb breadcrumbs comment comments "
    "commentlist complementary contentinfo consent cookie cookies disclaimer discussion disqus feedback footer footers gdpr "
    "header masthead menu menus modal nav navbar navigation newsletter notice notices notification outbrain overlay pager "
    "pagination popup popups promo promos promoted promotion recommended related replies reply respond search share sharing "
    "sidebar sidebars signup skip social sponsor sponsored subscribe subscription taboola teaser toolbar topbar widget widgets "
    "alert login".split()
)
#: Of these, words that may as well describe a layout around the article ("with-sidebar").
LAYOUT_NAMES = frozenset(
    "banner footer footers header masthead menu menus modal nav navbar navigation overlay sidebar sidebars toolbar topbar widget widgets".split()
)
CONTENT_NAMES = frozenset("article articlebody content entry maincontent main post postbody story storybody text".split())
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")
SMOOTH_MOST = 6


class _Element:
    """An open element, with what it and the elements around it say together."""

    __slots__ = (
        "best", "boilerplate", "content", "depth", "forms", "heading", "in_article", "in_link", "layout", "minus", "number", "parent", "tag", "turn",
    )

    def __init__(self, tag: str, number: int, named: int, parent: _Element | None) -> None:
        self.tag, self.number, self.parent = tag, number, parent
        if parent is None:
            self.depth = self.boilerplate = self.forms = self.best = 0
            self.minus = self.layout = self.content = self.heading = self.in_article = self.in_link = False
            self.turn: _Element | None = None
            return
        article = tag in ("article", "main")
        if tag in ("html", "body"):
            named = 0
        self.depth = parent.depth + 1
        # Names: boilerplate; words of a layout, from the innermost article on; content.
        self.minus = parent.minus or named == -1
        self.layout = named == -2 or (parent.layout and not article)
        self.content = parent.content or named == 1
        # Tags: an article's own head is no boilerplate, and neither is a form around the whole page.
        own = BOILERPLATE_TAGS.get(tag, 0) if tag != "form" and not (tag == "header" and parent.in_article) else 0
        self.boilerplate = parent.boilerplate + own
        self.forms = (0 if article else parent.forms) + (tag == "form")
        self.best = max(parent.best, CONTENT_TAGS.get(tag, 0))
        self.heading = parent.heading or tag in HEADINGS
        self.in_article = parent.in_article or article
        self.in_link = parent.in_link or tag == "a"
        #: The nearest element around, or this one, that an opening tag may close or that shields those above it.
        self.turn = self if tag in _TURNS else parent.turn

    @property
    def named(self) -> int:
        """What a block in it is called: -1 boilerplate, 1 content, else 0."""
        return -1 if self.minus or self.layout else int(self.content)


@dataclass
class Block:
    text: str
    inner: _Element
    linked: float


def _named(attrs: list[tuple[str, str | None]]) -> int:
    """-1 if an element calls itself boilerplate, -2 if by words of a layout only, 1 if content, else 0."""
    found = 0
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return -1
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return -1
        if name in ("class", "id", "role", "itemprop") and value:
            words = {w.lower() for w in _NAME_PARTS.findall(value)} | {value.lower().replace("-", "").replace("_", "")}
            if words & CONTENT_NAMES and not words & {"comment", "comments", "related", "sidebar", "ad", "ads", "footer", "nav"}:
                found = found or 1
            elif words & BOILERPLATE_NAMES:
                if words & (BOILERPLATE_NAMES - LAYOUT_NAMES):
                    return -1
                found = -2
    return found


class _Parser(HTMLParser):
    """Collects text blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[_Element] = [_Element("", 0, 0, None)]
        self._places: dict[str, list[int]] = {}
        self._made = 0
        self._silent = 0
        self._pieces: list[str] = []
        self._linked = 0

    def _flush(self) -> None:
        if self._pieces:
            text = _SPACE.sub(" ", "".join(self._pieces)).strip()
            if text:
                self.blocks.append(Block(text, self.open[-1], self._linked / len(text)))
            self._pieces, self._linked = [], 0

    def _close(self, depth: int) -> None:
        """Close the elements from a depth on; the root has depth 0 and stays."""
        for element in self.open[depth:]:
            self._silent -= element.tag in SILENT
            self._places[element.tag].pop()
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self._flush()
            self._close(1 + sum(e.tag == "html" for e in self.open[1:2]))
        if tag in BLOCKS:
            self._flush()
            closing = CLOSES.get(tag, ())
            turn = self.open[-1].turn
            while turn is not None and (turn.tag in closing or turn.tag not in _SCOPE):
                # Only inline elements lie between; what may be closed further up is found too.
                if turn.tag in closing:
                    self._close(turn.depth)
                turn = turn.parent.turn
        elif tag == "br":
            self._pieces.append(" ")
        if tag in VOID:
            return
        self._made += 1
        self._places.setdefault(tag, []).append(len(self.open))
        self.open.append(_Element(tag, self._made, _named(attrs) if attrs else 0, self.open[-1]))
        self._silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "object", "iframe", "canvas", "script", "template"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        places = self._places.get(tag)
        if not places:
            return
        if tag not in BLOCKS:
            # An inline element is not closed beyond a scope.
            shield = max((self._places[t][-1] for t in _SCOPE if self._places.get(t)), default=0)
            if shield > places[-1]:
                return
        self._close(places[-1])

    def handle_data(self, data: str) -> None:
        if not self._silent:
            self._pieces.append(data)
            if self.open[-1].in_link:
                self._linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._flush()


def blocks_of(html: str) -> list[Block]:
    parser = _Parser()
    parser.feed(html)
    parser.close()
    return parser.blocks


def leaning(block: Block) -> int:
    """The classifier: what a block's tags, names, links and length say, summed up."""
    inner = block.inner
    score = inner.boilerplate + BOILERPLATE_TAGS["form"] * inner.forms + inner.best
    score += {-1: NAMED_BOILERPLATE, 0: 0, 1: NAMED_CONTENT}[inner.named]
    if block.linked > 0.5 and not inner.in_article:
        score -= 12
    if inner.heading:
        score += 2
    words = block.text.count(" ") + 1
    score += 6 if words >= 25 else 2 if words >= 8 else -1
    return score - 1


def _apart(a: _Element, b: _Element) -> int:
    """Steps between two elements of the tree; those at ``SMOOTH_MOST`` or further count as that far."""
    steps = 0
    while a is not b and steps < SMOOTH_MOST:
        if a.depth >= b.depth:
            a, b = b, a
        b, steps = b.parent, steps + 1
    return steps


def main_blocks(blocks: list[Block]) -> list[bool]:
    """Whether each block is content."""
    edges, last_in = [], {}

    def join(a: int, b: int) -> None:
        edges.append((a, b, SMOOTH_MOST - _apart(blocks[a].inner, blocks[b].inner)))

    for k, block in enumerate(blocks):
        if k:
            join(k - 1, k)
        parent = block.inner.parent.number if block.inner.parent else 0
        if parent in last_in and last_in[parent] != k - 1:
            join(last_in[parent], k)
        last_in[parent] = k
    return label([leaning(b) for b in blocks], [e for e in edges if e[2]])


def extract(html: str | None) -> str:
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, keep in zip(blocks, main_blocks(blocks), strict=True) if keep)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; n_chars counts code points."""
    source = pages.select("page_id", "url", F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [extract(h) for h in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:2])
    return source.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
