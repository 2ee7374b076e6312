"""The main text of web pages, from text blocks and the blocks beside them."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.trees import Node, grown

#: Elements that begin and end a block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text of the page.
SILENT_TAGS = frozenset(
    "script style head title noscript template svg math iframe object canvas audio video map "
    "select datalist button textarea option".split()
)
#: Silent elements that hold until their own end tag, whatever stands in them.
_RAW_TAGS = frozenset("script style textarea".split())
#: Silent elements that may stand in one another.
_NESTED_TAGS = frozenset("svg math object canvas audio video map template".split())
#: Elements that begin the text of a page, whatever was left open before them.
_TEXT_STARTS = frozenset("body article main".split())
BOILERPLATE_TAGS = frozenset("nav aside footer form menu dialog".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words of a class, id or role that mark what is not part of the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disqus footer footers gdpr login masthead menu menus "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion recommended related reply replies respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets "
    "alert contentinfo complementary dialog form hidden discussion".split()
)
#: Marks that hold for articles inside them too: comments, menus and teasers.
_FIRM_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense comment comments discussion disqus hidden menu menus "
    "nav navbar navigation promo promoted promotion recommended related replies reply respond sponsor sponsored".split()
)
_FIRM_TAGS = frozenset("nav aside menu".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_END_TAG = re.compile(r"</(template|noscript)\b", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: int
    marked: int
    heading: int
    wrapper: int = 0


@dataclass
class _Open:
    tag: str
    article: bool
    marked: bool
    firm: bool = False
    wrapper: int = 0


@dataclass
class _State:
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)


class _Flattener(HTMLParser):
    """Cuts a page into flat blocks; each knows the containers it stood in.

    A silent element without its end tag ends where the text has to go on: ``head`` at the
    body or the first block, others (but for script, style and textarea) at the end tag of
    an element open around them or at the next body, article or main. A template or
    noscript may hold articles, so these end it only if none of its end tags is left.
    """

    def __init__(self, html: str = "") -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._open: list[_Open] = [_Open("", False, False)]
        self._silent = ""
        #: What is open inside the silent element.
        self._inside: list[str] = []
        self._ends_left = Counter(tag.lower() for tag in _END_TAG.findall(html))
        self._wrappers = 0
        self._links = 0
        self._heading = 0
        self._now = _State()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._silent and self._still_silent(tag):
            return
        if tag == "br":
            self._add(" ")
        if tag == "body":
            self.end_block()
            return
        if tag in SILENT_TAGS:
            if tag == "head" or tag in BLOCK_TAGS:
                self.end_block()
            self._silent = tag
            return
        if tag == "a":
            self._links += 1
        if tag in BLOCK_TAGS:
            self.end_block()
            self._heading += tag in _HEADINGS
        if tag in BLOCK_TAGS or tag == "span":
            self._enter(tag, dict(attrs))

    def _still_silent(self, tag: str) -> bool:
        """Whether the start of ``tag`` leaves the silent element open."""
        closing = {self._silent, *self._inside} & set(self._ends_left)
        if self._silent in _RAW_TAGS:
            return True
        if tag in _TEXT_STARTS and (tag == "body" or not any(self._ends_left[t] > 0 for t in closing)):
            self._loud()
            return False
        if self._silent == "head" and tag in BLOCK_TAGS - {"html"} and SILENT_TAGS.isdisjoint(self._inside):
            self._loud()
            return False
        if tag == self._silent and tag not in _NESTED_TAGS:
            self._inside.clear()
        elif tag not in VOID_TAGS:
            self._inside.append(tag)
        return True

    def _loud(self) -> None:
        self._silent = ""
        self._inside.clear()

    def _still_silent_after(self, tag: str) -> bool:
        """Whether the end of ``tag`` was inside the silent element or its own."""
        if tag in self._inside:
            del self._inside[len(self._inside) - 1 - self._inside[::-1].index(tag) :]
            return True
        if tag == self._silent:
            self._loud()
            return True
        around = any(opened.tag == tag for opened in self._open) or (tag == "a" and self._links > 0)
        if self._silent in _RAW_TAGS or not around:
            return True
        self._loud()
        return False

    def _enter(self, tag: str, attrs: dict[str, str | None]) -> None:
        if tag in VOID_TAGS or tag == "html":
            return
        outer = self._open[-1]
        if tag == "p":  # a paragraph ends where the next one begins
            self._leave("p", within=BLOCK_TAGS - {"p"})
            outer = self._open[-1]
        named = " ".join(attrs.get(name) or "" for name in ("class", "id", "role"))
        tokens = {token.lower() for token in _TOKEN.findall(named)}
        hidden = (
            "hidden" in attrs
            or attrs.get("aria-hidden") == "true"
            or bool(_HIDING.search(attrs.get("style") or ""))
        )
        marked = tag in BOILERPLATE_TAGS or bool(tokens & MARKS) or hidden
        # The header of a page is boilerplate, that of an article is its headline.
        marked = marked or (tag == "header" and not outer.article)
        # A mark on a wrapper, such as "with-sidebar", ends at the article in it.
        article = tag in ("article", "main") and not marked and not outer.firm
        firm = outer.firm or hidden or tag in _FIRM_TAGS or bool(tokens & _FIRM_MARKS)
        wrapper = 0 if article or firm else outer.wrapper
        if marked:
            # Only a mark in a name, or a form, may be that of a wrapper of the whole text.
            named_only = tag == "form" or tag not in BOILERPLATE_TAGS | {"header"}
            self._wrappers += 1
            wrapper = self._wrappers if named_only and not firm else 0
        self._open.append(
            _Open(tag, outer.article or article, marked or (outer.marked and not article), firm, wrapper)
        )

    def _leave(self, tag: str, within: frozenset[str] | None = None) -> None:
        for place in range(len(self._open) - 1, 0, -1):
            if self._open[place].tag == tag:
                del self._open[place:]
                return
            if within and self._open[place].tag in within:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._silent:
            return
        if tag == "br":
            self._add(" ")
        elif tag in BLOCK_TAGS:
            self.end_block()

    def handle_endtag(self, tag: str) -> None:
        if tag in self._ends_left:
            self._ends_left[tag] -= 1
        if self._silent and self._still_silent_after(tag):
            return
        if tag == "a":
            self._links = max(0, self._links - 1)
        if tag in BLOCK_TAGS:
            self.end_block()
            if tag in _HEADINGS:
                self._heading = max(0, self._heading - 1)
        if tag in BLOCK_TAGS or tag == "span":
            self._leave(tag)

    def handle_data(self, data: str) -> None:
        if not self._silent:
            self._add(data)

    def _add(self, data: str) -> None:
        self._now.parts.append(data)
        if self._links:
            self._now.links.append(data)

    def end_block(self) -> None:
        words = "".join(self._now.parts).split()
        if words:
            linked = len(" ".join(self._now.links).split())
            here = self._open[-1]
            self.blocks.append(
                Block(
                    " ".join(words),
                    len(words),
                    min(linked, len(words)),
                    int(here.article),
                    int(here.marked),
                    int(self._heading > 0),
                    here.wrapper,
                )
            )
        self._now = _State()


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in order; a tag that the end cuts off is no text."""
    flat = _Flattener(html)
    flat.feed(_CUT_TAG.sub("", html))
    flat.close()
    flat.end_block()
    return flat.blocks


def features(blocks: list[Block]) -> list[list[float]]:
    """Marked, in an article, heading; words and link density of a block and of both neighbours;
    and the share of the page's words in the marked wrapper around the block, if no article is told apart."""
    told = any(b.article and not b.marked for b in blocks)
    total = sum(b.words for b in blocks)
    within: Counter[int] = Counter()
    for b in blocks:
        within[b.wrapper] += b.words
    shape = [(float(b.words), b.linked / b.words) for b in blocks]
    edge = (0.0, 0.0)
    return [
        [float(b.marked), float(b.article), float(b.heading), *shape[i], *(shape[i - 1] if i else edge),
         *(shape[i + 1] if i + 1 < len(shape) else edge),
         within[b.wrapper] / total if b.wrapper and not told else 0.0]
        for i, b in enumerate(blocks)
    ]


#: Labelled by hand, without a marked wrapper: marked, article, heading, words, link density, words and link
#: density of the block before, of the block after, and whether it is main text.
LABELLED = """
1 0 0   1 1.0   0 0.0   1 1.0  0
1 0 0   2 1.0   1 1.0   3 1.0  0
1 0 0   8 0.0   4 1.0   6 0.0  0
1 0 0  40 0.0   3 1.0  60 0.0  0
1 0 0  90 0.1  70 0.0   9 0.0  0
1 1 0   4 1.0  80 0.0  90 0.0  0
1 1 0  35 0.0  60 0.0  50 0.0  0
1 1 0  12 0.5  20 0.0   3 1.0  0
1 1 1   2 0.0  50 0.0  30 0.0  0
1 0 1   2 0.0   9 0.0   4 1.0  0
1 0 1   5 0.0   0 0.0  30 0.0  0
1 1 0 120 0.0  30 0.0  15 0.0  0
0 1 1   3 0.0   6 0.0  50 0.0  1
0 1 1  12 0.0   4 1.0  18 0.0  1
0 1 1   6 1.0   4 1.0  70 0.0  1
0 1 0   1 0.0  60 0.0  45 0.0  1
0 1 0   2 0.0  12 0.0   3 0.0  1
0 1 0   5 0.0  80 0.0   8 0.0  1
0 1 0  18 0.0   9 0.0  75 0.0  1
0 1 0  60 0.0  40 0.0  90 0.0  1
0 1 0 150 0.1  30 0.0  20 0.0  1
0 1 0  30 0.4  50 0.0  60 0.0  1
0 1 0   3 1.0  50 0.0  60 0.0  1
0 1 0   9 1.0  44 0.0  25 0.0  1
0 1 0  70 0.0  55 0.0   7 0.0  1
0 1 0   4 0.0   5 0.0   4 0.5  1
0 0 0   1 1.0   0 0.0   1 1.0  0
0 0 0   1 1.0   2 1.0   1 1.0  0
0 0 0   3 1.0   2 1.0   5 1.0  0
0 0 0   6 0.9   3 1.0  20 0.0  0
0 0 0  10 0.8  40 0.0   4 1.0  0
0 0 0  15 0.6   8 0.7   9 0.9  0
0 0 0  28 0.7  12 0.8   6 1.0  0
0 0 0   2 0.0   1 1.0   1 1.0  0
0 0 0   4 0.0   2 1.0   3 1.0  0
0 0 0   5 0.0   0 0.0   2 1.0  0
0 0 0   3 0.0   6 0.9   0 0.0  0
0 0 0  12 0.0  70 0.0  50 0.0  1
0 0 0  20 0.0  12 0.0  30 0.0  1
0 0 0  45 0.1   8 0.0  40 0.0  1
0 0 0  80 0.0  40 0.0  25 0.1  1
0 0 0 120 0.2  15 0.0  90 0.0  1
0 0 0  35 0.0   4 1.0  60 0.0  1
0 0 0  26 0.0  30 0.0   3 1.0  1
0 0 0   6 0.0  40 0.0  55 0.0  1
0 0 0   2 0.0  35 0.0  28 0.0  1
0 0 0   9 0.0  22 0.0   0 0.0  1
0 0 1   4 0.0   3 1.0  40 0.0  1
0 0 1   8 0.0   0 0.0  60 0.0  1
0 0 1   6 0.0  50 0.0  45 0.0  1
0 0 1   2 0.0  60 0.0   3 1.0  0
0 0 1   3 0.0   2 1.0   2 1.0  0
0 0 0   1 1.0   1 1.0  40 0.0  0
0 0 0   2 1.0   9 0.9  80 0.0  0
0 0 0   3 0.9   2 1.0  30 0.0  0
0 0 0   5 1.0   0 0.0  50 0.0  0
0 0 0  50 0.0  30 0.0   1 1.0  1
0 0 0  40 0.0   1 1.0  30 0.0  1
0 0 0  90 0.0   1 1.0   1 1.0  1
0 0 0  33 0.1   2 1.0  12 0.9  1
0 1 0   1 0.0   3 1.0   3 1.0  1
0 1 0   2 0.0   2 1.0   5 0.0  1
0 1 0   2 0.0   7 0.0   2 1.0  1
0 1 0   7 0.0   3 1.0   1 1.0  1
0 1 0  14 0.0   2 1.0   9 0.0  1
0 1 0  14 0.0   9 0.0   3 1.0  1
0 1 0  25 0.0   1 1.0   1 1.0  1
0 1 0  60 0.0   2 1.0   2 1.0  1
0 1 0   1 1.0   2 1.0   2 1.0  1
0 1 0   2 1.0   9 0.0   1 1.0  1
0 1 0   4 1.0   1 1.0   8 0.0  1
0 1 0  16 1.0   2 1.0   2 1.0  1
0 1 1   2 0.0   2 1.0   2 1.0  1
0 1 1   5 0.0   2 1.0  40 0.0  1
1 0 0   1 0.0   8 0.0   8 0.0  0
1 0 0   3 0.0  60 0.0  30 0.0  0
1 0 0  12 0.0  60 0.0  30 0.0  0
1 0 0  25 0.0  40 0.0  40 0.0  0
1 0 0  26 0.0   1 1.0   1 1.0  0
1 0 0  60 0.0  60 0.0  60 0.0  0
1 0 0 150 0.0  20 0.0  90 0.0  0
1 0 0  40 0.0  40 0.0   3 1.0  0
1 1 0   2 0.0  30 0.0  30 0.0  0
1 1 0  22 0.0   2 1.0   2 1.0  0
1 1 0  30 0.0  30 0.0  30 0.0  0
1 1 0  70 0.0  40 0.0  50 0.0  0
1 1 1   4 0.0  20 0.0  20 0.0  0
1 0 1   4 0.0  20 0.0  40 0.0  0
"""


#: Shares of a page's words: a wrapper with that much is the page's layout, so its blocks
#: are labelled like those without a mark; one with less is what its mark says.
_LAYOUT_SHARES, _PART_SHARES = (0.6, 0.75, 0.95), (0.05, 0.2, 0.4)


def trained_tree() -> Node:
    rows, labels = [], []
    for line in LABELLED.strip().splitlines():
        *row, label = (float(x) for x in line.split())
        rows.append([*row, 0.0])
        labels.append(int(label))
        if row[:2] == [0.0, 0.0]:
            for share in _LAYOUT_SHARES + _PART_SHARES:
                rows.append([1.0, *row[1:], share])
                labels.append(int(label) if share in _LAYOUT_SHARES else 0)
    return grown(rows, labels)


def main_text(html: str | None, tree: Node) -> str:
    if not html:
        return ""
    blocks = blocks_of(html)
    kept = [b.text for b, row in zip(blocks, features(blocks), strict=True) if tree.of(row)]
    return "\n\n".join(kept)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``.

    The text is that of the blocks that the tree takes for the article, in page
    order, apart by an empty line. NULL, empty and textless pages give an empty
    text; a page that breaks off is read as far as it goes. No page is lost; other
    columns pass through.
    """
    tree = trained_tree()

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, tree), na_action=None)

    others = [name for name in pages.columns if name not in (html, "text", "n_chars")]
    found = pages.select(*others, text_of(F.col(html)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
