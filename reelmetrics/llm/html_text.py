"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each is described by its word count and link
density, those of the blocks before and after it, and the kind of element it stands in; a
decision tree grown from a small labelled table tells which blocks are the article's.

Whether an element stands beside the article is first guessed from its tag and names, and taken
back where the page says otherwise: where everything that is marked as an article lies inside
such elements, or, on pages without such a mark, where one of them holds most of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelmetrics.llm.common import pieces
from reelmetrics.llm.trees import Node, grow, predict

# Elements that part blocks, elements whose content is no text, and elements kept track of.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select noframes".split())
TRACKED = frozenset(
    "article aside body button dialog div dl fieldset figure footer form head header html main menu nav ol section span table title ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements, and words of class and id names, beside the article.
BESIDE = frozenset("aside button dialog footer form head menu nav title".split())
BESIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner bottom breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice outbrain overlay pagination pager popup "
    "promo promotion recommended related replies reply share sharing sidebar signup social sponsor sponsored subscribe taboola tags "
    "teaser toolbar topbar widget".split()
)
# Names that stay beside the article whatever they hold.
OTHERS_NAMES = frozenset("comment comments consent cookie cookies disqus gdpr modal popup related recommended replies reply sidebar".split())
ARTICLE_NAMES = frozenset("article articlebody content entry main post postbody story".split())
NAME = re.compile(r"[A-Za-z][^\s/>]*")
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
HIDDEN = re.compile(r"""\shidden(?=[\s>/=]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# The labelled table. A block is described by its words and link density, those of the blocks
# before and after it, whether an element beside the article holds it, whether the article's
# does, and whether it is a heading. Within such elements the neighbours say nothing, so these
# blocks are crossed with every neighbour: (words, links, beside, article, heading, label).
NEIGHBOURS = ((0, 0.0), (2, 1.0), (9, 0.0), (60, 0.0))
IN_ELEMENTS = (
    *((words, 0.0, 0, 1, 0, 1) for words in (1, 2, 3, 5, 9, 18, 40, 84, 150)),
    *((words, links, 0, 1, 0, 1) for words in (6, 18, 40) for links in (0.1, 0.3, 0.5)),
    *((words, 0.0, 0, 1, 1, 1) for words in (1, 4, 12)),
    *((words, links, 0, 1, 0, 0) for words in (1, 3, 7, 15) for links in (0.9, 1.0)),
    *((words, links, 1, article, 0, 0) for words in (1, 3, 8, 20, 40, 90, 150) for links in (0.0, 0.2, 1.0) for article in (0, 1)),
    *((words, 0.0, 1, article, 1, 0) for words in (1, 4, 12) for article in (0, 1)),
)
# Pages without telling elements: long blocks with few links, and what stands between them:
# (words, links, words before, links before, words after, links after, heading, label).
IN_THE_OPEN = (
    (70, 0.0, 8, 0.0, 55, 0.0, 0, 1), (55, 0.05, 70, 0.0, 40, 0.0, 0, 1), (40, 0.0, 55, 0.05, 25, 0.0, 0, 1), (25, 0.1, 40, 0.0, 62, 0.0, 0, 1),
    (12, 0.0, 62, 0.0, 48, 0.0, 0, 1), (4, 0.0, 48, 0.0, 75, 0.0, 0, 1), (8, 0.0, 2, 1.0, 70, 0.0, 1, 1), (5, 0.0, 75, 0.0, 38, 0.0, 1, 1),
    (38, 0.2, 5, 0.0, 30, 0.0, 0, 1), (30, 0.0, 38, 0.2, 6, 1.0, 0, 1), (19, 0.0, 30, 0.0, 26, 0.0, 0, 1), (6, 0.0, 26, 0.0, 80, 0.0, 0, 1),
    (1, 0.0, 44, 0.0, 39, 0.0, 0, 1), (90, 0.0, 2, 1.0, 3, 1.0, 0, 1), (45, 0.0, 0, 0.0, 0, 0.0, 0, 1), (33, 0.1, 3, 1.0, 60, 0.0, 0, 1),
    (2, 1.0, 0, 0.0, 2, 1.0, 0, 0), (3, 1.0, 2, 1.0, 1, 1.0, 0, 0), (4, 0.0, 3, 1.0, 2, 1.0, 0, 0), (6, 1.0, 30, 0.0, 5, 1.0, 0, 0),
    (9, 0.8, 6, 1.0, 7, 0.9, 0, 0), (7, 0.0, 5, 1.0, 4, 0.0, 0, 0), (3, 0.0, 4, 0.0, 2, 0.0, 0, 0), (2, 0.0, 3, 0.0, 0, 0.0, 0, 0),
    (18, 0.0, 40, 0.0, 6, 0.0, 0, 1), (9, 0.0, 36, 0.0, 8, 0.0, 0, 1), (22, 0.0, 9, 0.0, 12, 0.0, 0, 1), (14, 0.0, 21, 0.0, 11, 0.0, 0, 1),
    (14, 0.0, 30, 0.0, 28, 0.0, 0, 1), (14, 0.0, 30, 0.9, 28, 0.9, 0, 0), (10, 0.0, 24, 0.05, 33, 0.0, 0, 1), (10, 0.0, 24, 0.8, 33, 1.0, 0, 0),
    (16, 0.1, 22, 0.0, 26, 0.1, 0, 1), (16, 0.1, 22, 0.9, 26, 0.8, 0, 0), (7, 0.0, 40, 0.0, 35, 0.0, 1, 1), (7, 0.0, 40, 0.9, 35, 0.9, 1, 0),
    (5, 0.0, 6, 1.0, 3, 1.0, 1, 0), (30, 0.9, 4, 0.0, 28, 0.8, 0, 0), (18, 0.7, 30, 0.9, 5, 1.0, 0, 0), (1, 0.0, 2, 0.0, 3, 1.0, 0, 0),
)


def labelled() -> tuple[np.ndarray, np.ndarray]:
    rows = [(w, l, *before, *after, beside, article, heading, y) for w, l, beside, article, heading, y in IN_ELEMENTS for before in NEIGHBOURS for after in NEIGHBOURS]
    rows += [(*shape, 0, 0, heading, y) for *shape, heading, y in IN_THE_OPEN]
    data = np.array(rows, float)
    return data[:, :-1], data[:, -1]


class Element:
    """A tracked element: whether it seems to stand beside the article (``surely``: by more than
    its name), whether it is marked as the article, and the words it holds."""

    __slots__ = ("article", "beside", "surely", "tag", "words")

    def __init__(self, tag: str, beside: bool, surely: bool, article: bool):
        self.tag, self.beside, self.surely, self.article = tag, beside, surely, article
        self.words = 0


class Block:
    """A run of text. ``within`` holds the tracked elements it stands in, the outermost first."""

    __slots__ = ("heading", "linked", "parts", "within", "words")

    def __init__(self, within: tuple[Element, ...], heading: bool):
        self.parts: list[str] = []
        self.within, self.heading = within, heading
        self.words = self.linked = 0

    @property
    def beside(self) -> bool:
        return any(e.beside for e in self.within)

    @property
    def article(self) -> bool:
        return any(e.article for e in self.within)


def tag_end(html: str, at: int, quotes: dict[str, bool]) -> int:
    """The place of the > that ends the tag, quoted ones passed over; -1 if there is none.

    ``quotes`` remembers a quote that is never closed, so that a page is read in linear time.
    """
    begin = at
    while (end := html.find(">", at)) >= 0:
        opened = ""
        for c in html[begin:end]:
            if opened:
                opened = "" if c == opened else opened
            elif c in "\"'":
                opened = c
        if not opened or not quotes.get(opened, True):
            return end
        close = html.find(opened, end)
        if close < 0:
            quotes[opened] = False
            return end
        begin = at = close + 1
    return -1


def kind_of(tag: str, attributes: str, in_article: bool) -> Element:
    """What the tag and its attributes say of an element."""
    beside = tag in BESIDE or (tag == "header" and not in_article)
    surely = beside and tag not in ("form", "header")
    article = tag in ("article", "main")
    if attributes:
        for _, value in ATTRIBUTE.findall(attributes):
            names = {w.lower() for w in WORDS.findall(value)}
            beside |= bool(names & BESIDE_NAMES) and not names & ARTICLE_NAMES or names == {"complementary"}
            surely |= bool(names & OTHERS_NAMES) and not names & ARTICLE_NAMES or names == {"complementary"}
            article |= bool(names & ARTICLE_NAMES)
        hidden = bool(HIDDEN.search(attributes))
        beside, surely = beside | hidden, surely | hidden
    if tag in ("body", "html"):
        beside = surely = article = False
    return Element(tag, beside, surely, article and not beside)


def reconsider(found: list[Block]) -> None:
    """Take back what was guessed of elements that hold the article.

    The text of a page whose marked articles all lie in elements that only seem to stand beside
    it is the longest of these articles; on a page without a mark, elements that hold more than
    half of the words outside links (of text that doesn't surely stand beside) are no side matter.
    """
    if any(b.article and not b.beside for b in found):
        return
    total = 0
    for block in found:
        if not any(e.surely for e in block.within):
            total += block.words - block.linked
            for e in set(block.within):
                e.words += block.words - block.linked
    marked = [b for b in found if b.article and not any(e.surely for e in b.within)]
    if marked:
        main = max((e for b in marked for e in b.within if e.article), key=lambda e: e.words)
        for block in marked:
            if main in block.within:
                for e in block.within[: block.within.index(main)]:
                    e.beside = False
        return
    for block in found:
        for e in block.within:
            if e.beside and not e.surely and 2 * e.words > total:
                e.beside = False


def blocks(html: str) -> list[Block]:
    """The flat text blocks of a page, in order; broken markup is read as browsers do."""
    out: list[Block] = []
    stack: list[Element] = []
    current: Block | None = None
    heading, links, at, n = False, 0, 0, len(html)
    quotes: dict[str, bool] = {}
    lower = html.lower() if len(html.lower()) == n else html

    def say(text: str) -> None:
        nonlocal current
        if current is None:
            if not text.strip():
                return
            current = Block(tuple(stack), heading)
            out.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text.split())

    while at < n:
        open_ = html.find("<", at)
        if open_ < 0:
            say(unescape(html[at:]))
            break
        if open_ > at:
            say(unescape(html[at:open_]))
        if html.startswith("<!--", open_):
            end = html.find("-->", open_ + 4)
            at = n if end < 0 else end + 3
            continue
        closing = html.startswith("/", open_ + 1)
        name = NAME.match(html, open_ + 1 + closing)
        if not name:
            if html.startswith(("<!", "<?", "</"), open_):
                end = html.find(">", open_)
                at = n if end < 0 else end + 1
            else:
                say("<")
                at = open_ + 1
            continue
        tag = name[0].lower()
        end = tag_end(html, name.end(), quotes)
        if end < 0:
            break
        at = end + 1
        attributes = html[name.end() : end]
        if not closing and tag in RAW and not attributes.endswith("/"):
            close = lower.find(f"</{tag}", at)
            gone = n if close < 0 else lower.find(">", close)
            at = n if gone < 0 else gone + (gone < n)
            if tag in BLOCKS:
                current = None
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag in BLOCKS:
            current = None
        if tag in HEADINGS:
            heading = not closing
        elif tag in BLOCKS and not closing:
            heading = False
        if tag in TRACKED:
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            elif tag not in EMPTY and not attributes.endswith("/"):
                stack.append(kind_of(tag, attributes, any(e.article for e in stack)))
                if tag in BLOCKS:
                    links = 0
    return out


def tree(depth: int = 8) -> Node:
    """The classifier, grown from the labelled table."""
    return grow(*labelled(), depth, 1)


def main_text(html: str, classifier: Node) -> str:
    """The article's blocks, white space made single and trimmed, one to a line."""
    found = []
    for block in blocks(html):
        words = "".join(block.parts).split()
        if words:
            block.words = len(words)
            found.append((block, " ".join(words)))
    reconsider([b for b, _ in found])
    size = [(b.words, min(1.0, b.linked / b.words)) for b, _ in found]
    kept = []
    for i, (block, text) in enumerate(found):
        before, after = size[i - 1] if i else (0, 0.0), size[i + 1] if i + 1 < len(size) else (0, 0.0)
        if predict(classifier, (*size[i], *before, *after, block.beside, block.article, block.heading)) >= 0.5:
            kept.append(text)
    return "\n".join(kept)


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """page_id, url, text (the main text, empty if none) and n_chars of every row.

    Null html is empty; ids and urls are passed on, nulls and repeated rows too. Other columns
    are not read, and nothing is shuffled.
    """
    classifier = tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            text = pa.array([main_text(h or "", classifier) for h in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text], ["page_id", "url", "text"])

    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").alias("html"))
    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
