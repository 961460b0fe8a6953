"""Main text of web pages by site style trees.

The pages of a host are merged: elements with the same path of styles (tag and class from the root down) are one style node. Pages
of a host with the same text (all of it but declared menus and the like) count as one page. Over the ``m`` pages that have a node, a
content feature (the text of an element there) held by ``c`` pages has entropy log_m c, and the node's content importance is one
minus the mean entropy: what repeats on every page is worth nothing. Its presentation importance is the entropy of the sequences of
children it has on different pages. Both are weighed into one importance; branches whose importance (raised by ``MAIN_RAISE`` inside
an article or main element) is below ``THRESHOLD`` are removed from each page. The outermost article or main never falls with a branch
above it, nor does one inside it but by its own score, and where nothing in them would be left all their text stays. A node on fewer
than ``LEAST_PAGES`` pages of its host has no importance for want of evidence, and stays.

What elements declare comes first. Menus, footers, forms and other elements that are never the article are left out, and so are
those whose class, id or role names adverts, comments and the like. A class that names a place (header, sidebar, search) may be
that of a layout around the article, so it only casts doubt: on a page with an article (or main) all text comes from articles,
on any other from the whole page, and in both cases from what is doubted least. Classes of html and body count for nothing, and
neither does a word after one of layout ("with-sidebar").

Blocks of the remaining text are joined by an empty line, white space in a block is one space, character references are decoded.
A null or empty page has the empty text. Broken markup is read as far as it goes. A null url is a host of its own.

Only hashes are gathered by host, each combined before the shuffle; a page's text never leaves its row. The removed nodes of a host go
back to its pages by a join whose small side is broadcast if its measured size is small. Repeated rows have a text each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillmetrics.llm.common import checkpointed

LEAST_PAGES = 5
THRESHOLD = 0.3
PRESENTATION_WEIGHT = 0.1
MAIN_RAISE = 0.1
MOST_BROADCAST_BYTES = 32 << 20

# A quoted value may hold the sign that ends a tag; a quote that is not closed, or not after "=", is a sign like others.
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL,
)
CLASSES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
INLINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr br".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
ENDS_ITSELF = {"li": "li", "tr": "tr", "td": "td", "th": "th", "dt": "dt", "dd": "dd", "option": "option"}
# What elements say about themselves.
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select menu dialog".split()) | RAW
# Words in classes, ids and roles: of what is never the article, and of what may also name the layout that holds it.
FOREIGN_WORDS = frozenset(
    "ad ads advert adverts advertisement comment comments consent cookie cookies newsletter popup promo related sponsor "
    "sponsored subscribe".split()
)
PLACE_WORDS = frozenset(
    "alert banner breadcrumb breadcrumbs complementary contentinfo dialog footer header masthead menu modal nav navbar "
    "navigation notice search share sidebar social toolbar widget".split()
)
BOILERPLATE_WORDS = FOREIGN_WORDS | PLACE_WORDS
MAIN_TAGS = frozenset(("article", "main"))
# Words of layout: what follows them is beside the element, not the element.
LAYOUT_WORDS = frozenset("has with no without show hide hidden off".split())


class Element:
    __slots__ = ("tag", "key", "dropped", "doubted", "main", "faded", "children", "texts")

    def __init__(self, tag: str, key: int, dropped: bool, doubted: int, main: bool, faded: bool):
        # Dropped by its tag or one around it, doubted by so many classes around it, faded by the tree.
        self.tag, self.key, self.dropped, self.doubted, self.main, self.faded = tag, key, dropped, doubted, main, faded
        self.children: list[str] = []
        self.texts: list[str] = []


def _key(text: str) -> int:
    from xxhash import xxh64_intdigest

    number = xxh64_intdigest(text)
    return number - (1 << 64) if number >> 63 else number


class Page:
    """One walk over a page: blocks with the style nodes above them, and the features of every element."""

    def __init__(self, html: str, removed: frozenset[int] = frozenset()):
        self.removed = removed
        self.blocks: list[tuple[Element, str]] = []  # the element a text is in, text
        self.features: set[tuple[int, bool, int, int]] = set()  # node, inside main, content, children
        self.parts: list[str] = []
        self.stack = [Element("", 0, False, 0, False, False)]
        self._walk(html)

    def text(self) -> str:
        """The blocks of the articles, or of the whole page where it has none; of these, what classes doubt least."""
        inside = [entry for entry in self.blocks if entry[0].main]
        chosen = inside or self.blocks
        doubts = {top.doubted for top, _ in chosen}
        if not inside and 0 not in doubts and len(doubts) < 2:
            return ""  # a page that is all menu, or the like
        chosen = [(top, text) for top, text in chosen if top.doubted == min(doubts)]
        left = [text for top, text in chosen if not top.faded]
        return "\n\n".join(left if left or not inside else [text for _, text in chosen])

    def whole(self) -> int:
        """The hash of all text but that of declared boilerplate."""
        return _key("\n".join(text for top, text in self.blocks if not top.doubted))

    def _flush(self) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            self.parts = []
            if text:
                top = self.stack[-1]
                self.blocks.append((top, text))
                top.texts.append(text)

    def _open(self, tag: str, attributes: str) -> None:
        above = self.stack[-1]
        style, words = tag, ()
        if attributes and "=" in attributes:
            found = [a or b or c for a, b, c in CLASSES.findall(attributes)]
            if found:
                style = f"{tag}.{' '.join(found)}"
                words = re.split(r"[\s_-]+", " ".join(found).lower())
        above.children.append(style)
        key = _key(f"{above.key}/{style}")
        words = [word for before, word in zip(("", *words), words) if before not in LAYOUT_WORDS]
        foreign, place = not FOREIGN_WORDS.isdisjoint(words), not PLACE_WORDS.isdisjoint(words)
        declared = tag in MAIN_TAGS or ("main" in words and not foreign and not place)
        dropped = above.dropped or tag in BOILERPLATE_TAGS or (tag == "header" and not above.main)
        doubted = above.doubted
        if tag not in ("html", "body"):
            # Of an outermost article a class says little; one within another may be a comment on it.
            dropped |= foreign and (above.main or tag not in MAIN_TAGS)
            doubted += foreign or place
        main = above.main or (declared and not dropped)
        faded = key in self.removed
        if not (declared and main):
            faded |= above.faded
        elif not above.main:
            faded = False
        self.stack.append(Element(tag, key, dropped, doubted, main, faded))

    def _close(self) -> None:
        element = self.stack.pop()
        if not element.dropped and not element.doubted:
            # Blocks within count as a part of the elements around them by their hash alone.
            whole = _key("\n".join(element.texts))
            self.features.add((element.key, element.main, whole, _key(" ".join(element.children))))
            if element.texts:
                self.stack[-1].texts.append(str(whole))

    def _pop_to(self, tag: str, stop: frozenset[str] = frozenset()) -> None:
        for place in range(len(self.stack) - 1, 0, -1):
            if self.stack[place].tag == tag:
                while len(self.stack) > place:
                    self._close()
                return
            if self.stack[place].tag in stop:
                return

    def _walk(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = TAG.search(html, at)
            start = m.start() if m else size
            if start > at and not self.stack[-1].dropped:
                self.parts.append(html[at:start])
            if not m:
                break
            at = m.end()
            tag = m.group(2)
            if not tag:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag == "br":
                    self.parts.append(" ")
                continue
            self._flush()
            if m.group(1):
                self._pop_to(tag, MAIN_TAGS if tag == "p" else frozenset())
                continue
            if tag in CLOSES_PARAGRAPH:
                self._pop_to("p", frozenset(("article", "main", "div", "td", "li", "body")))
            if tag in ENDS_ITSELF:
                self._pop_to(ENDS_ITSELF[tag], frozenset(("ul", "ol", "table", "dl", "select", "tr" if tag in ("td", "th") else "")))
            if tag in VOID:
                continue
            self._open(tag, m.group(3))
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else size
                self._close()
        self._flush()
        while len(self.stack) > 1:
            self._close()


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def importances(pages: DataFrame, least_pages: int = LEAST_PAGES, weight: float = PRESENTATION_WEIGHT) -> DataFrame:
    """``host``, ``node``, ``inside`` (an article or main), ``importance`` of the style nodes on ``least_pages`` pages or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, found = [], [], []
            for k, html in enumerate(batch.column(1).to_pylist()):
                if html:
                    page = Page(html)
                    features = sorted(page.features)
                    rows += [k] * len(features)
                    texts += [page.whole()] * len(features)
                    found += features
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            columns = [pa.array([feature[k] for feature in found], kind) for k, kind in enumerate(kinds)]
            hosts = batch.column(0).take(pa.array(rows, pa.int32()))
            names = ["host", "page", "node", "inside", "content", "children"]
            yield pa.RecordBatch.from_arrays([hosts, pa.array(texts, pa.int64()), *columns], names=names)

    # Pages of one text are one page, whatever their number.
    found = (
        pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string"))
        .mapInArrow(run, "host string, page long, node long, inside boolean, content long, children long")
        .groupBy("host", "page", "node", "inside", "content")
        .agg(F.min("children").alias("children"))
    )
    held = checkpointed(found.groupBy("host", "node", "inside", "content", "children").agg(F.count(F.lit(1)).alias("c")))
    content = held.groupBy("host", "node", "inside", "content").agg(F.sum("c").alias("c"))
    contents = content.groupBy("host", "node", "inside").agg(
        F.sum("c").alias("m"), F.count(F.lit(1)).alias("features"), F.sum(F.log("c")).alias("logs")
    )
    style = held.groupBy("host", "node", "children").agg(F.sum("c").alias("c"))
    styles = style.groupBy("host", "node").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("styles"), F.sum(F.col("c") * F.log("c")).alias("weighted")
    )
    many = F.col("m") >= least_pages
    of_content = 1 - F.col("logs") / F.col("features") / F.log("m")
    of_styles = (F.log("n") - F.col("weighted") / F.col("n")) / F.log("n")
    both = contents.where(many).join(styles, ["host", "node"])
    importance = F.when(F.col("styles") > 1, weight * of_styles + (1 - weight) * of_content).otherwise(of_content)
    return both.select("host", "node", "inside", importance.alias("importance"))


def removed_nodes(
    pages: DataFrame, least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD, weight: float = PRESENTATION_WEIGHT
) -> DataFrame:
    """``host``, ``node`` of the style nodes whose score is below the threshold."""
    score = F.col("importance") + F.when(F.col("inside"), F.lit(MAIN_RAISE)).otherwise(F.lit(0.0))
    return importances(pages, least_pages, weight).where(score < threshold).select("host", "node")


def main_texts(pages: DataFrame, least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every page."""
    removed = checkpointed(
        removed_nodes(pages, least_pages, threshold)
        .groupBy(F.col("host").alias("its_host"))
        .agg(F.collect_list("node").alias("removed"))
    )
    size = removed.agg(F.sum(F.size("removed") + 4)).first()[0] or 0
    if 8 * size <= MOST_BROADCAST_BYTES:
        removed = F.broadcast(removed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                Page(html, frozenset(removed or ())).text() if html else ""
                for html, removed in zip(*(batch.column(k).to_pylist() for k in (2, 3)))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return (
        pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
        .join(removed, _host(F.col("url")) == F.col("its_host"), "left")
        .select("page_id", "url", "html", "removed")
        .mapInArrow(run, f"page_id {kind}, url string, text string")
    )
