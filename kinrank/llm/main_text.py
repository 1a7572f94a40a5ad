"""The main text of web pages: markup says what it can, a host's repetitions say the rest.

A page is read into blocks of text, each of which lies in content (an article, a main
element), in a part that is no main text by its kind (menu, header, footer, sidebar, notice,
advert, form, reader comments), or in neither. What content elements hold is main text even
where pages share it: shared passages are no boilerplate. All other words of a page are its
token stream.

The streams of a host's pages are concatenated, and a suffix array over them brings equal
stretches of ``REPEAT`` words together; a stretch on ``PAGES`` or more distinct pages covers
its words. (A word is inside a longer repeated substring exactly if such a stretch covers
it, so suffixes need to be sorted no further.) In a page without content elements, blocks
that are covered by half are boilerplate and go, and unique runs stay.

A host is dealt in parts of bounded size, each with a suffix array of its own. Each array
gives one row for each distinct stretch with the number of pages, so that a stretch on all
pages of a large host is a few rows when the parts' counts are added.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.session import written

# Words of a repeated stretch, a power of two, and distinct pages of a host that must hold it.
REPEAT, PAGES = 8, 3
# Parts that a host's pages are dealt to, and words of one suffix array.
PARTS, WORDS = 64, 1 << 20

# Elements by what they mean for a page's text.
CONTENT = {"article", "main"}
NOISE = {"nav", "aside", "footer", "form", "dialog", "menu"}
# Their text is no text of the page; that of the raw ones is not even markup.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
HIDDEN = RAW | {
    "head", "noscript", "template", "svg", "math", "object", "canvas", "audio", "video", "map",
    "select", "button", "datalist", "option",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | CONTENT | NOISE | {
    "html", "body", "head", "p", "div", "section", "header", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre",
    "table", "caption", "thead", "tbody", "tfoot", "tr", "figure", "figcaption", "address", "details",
    "summary", "fieldset", "legend", "hr", "center", "hgroup", "search",
}
# Cells stand beside each other in one block, with white space between.
SPACED = {"br", "td", "th", "img"}
# An element that opens closes open ones of these names, up to the boundary elements.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
# Words in class, id and role that name the parts which are no main text.
PARTS_BY_NAME = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "banner", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "pager",
    "pagination", "sidebar", "complementary", "widget", "widgets", "footer", "contentinfo", "masthead", "topbar",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter",
    "subscribe", "signup", "login", "search", "share", "sharing", "social", "related", "recommended", "comment",
    "comments", "commentlist", "disqus", "replies", "respond", "toolbar", "skip", "dialog", "alert", "alertdialog",
}
HEADERS_BY_NAME = {"header", "siteheader", "pageheader"}
CONTENT_BY_NAME = {"main", "article", "articlebody"}
COMMENTS_BY_NAME = {"comment", "comments", "commentlist", "disqus", "replies", "respond"}

_NAMES = re.compile("[a-z]+")
_WORD = re.compile(r"\S+")


def _names(attributes: list[tuple[str, str | None]]) -> tuple[set[str], set[str]]:
    """The words of class and id, and those of role and itemprop."""
    kinds, roles = set(), set()
    for name, value in attributes:
        if name in ("class", "id"):
            # Both 'cookie-notice' and 'cookieNotice' are two words.
            kinds.update(_NAMES.findall(re.sub("([a-z])([A-Z])", r"\1 \2", value or "").lower()))
        elif name in ("role", "itemprop"):
            roles.update(_NAMES.findall((value or "").lower()))
    return kinds, roles


@dataclass
class Element:
    tag: str
    # 'content', 'noise', 'open' or 'hidden'; where comments begin, content inside is noise, too.
    zone: str
    sealed: bool
    in_header: bool = False


@dataclass
class Page:
    """``blocks``: zone and text of each block in page order."""

    blocks: list[tuple[str, str]] = field(default_factory=list)

    @property
    def content(self) -> list[str] | None:
        """The blocks of content elements, or None where the page has none with text."""
        return [text for zone, text in self.blocks if zone == "content"] or None


class PageReader(HTMLParser):
    """Reads pages as browsers do in the main: end tags may lack, names may cross."""

    def __init__(self):
        super().__init__(convert_charrefs=True)

    def read(self, page: str) -> Page:
        self.reset()
        self.page, self.stack, self.pieces = Page(), [Element("", "open", False)], []
        self.feed(page)
        self.close()
        self._end_block()
        return self.page

    def _end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            self.page.blocks.append((self.stack[-1].zone, text))

    def _zone(self, tag: str, attributes: list[tuple[str, str | None]]) -> Element:
        above = self.stack[-1]
        if above.zone == "hidden" or tag in HIDDEN or any(name == "hidden" for name, _ in attributes):
            return Element(tag, "hidden", True)
        kinds, roles = _names(attributes) if attributes else (set(), set())
        sealed = above.sealed or bool(kinds & COMMENTS_BY_NAME)
        if sealed or tag in ("html", "body"):
            return Element(tag, "noise" if sealed else above.zone, sealed)
        if tag in CONTENT or roles & CONTENT_BY_NAME:
            return Element(tag, "content", False)
        if tag in NOISE or (kinds | roles) & PARTS_BY_NAME and tag not in HEADINGS:
            return Element(tag, "noise", False)
        if tag == "header" or kinds & HEADERS_BY_NAME:
            # An article's own header holds its headings; a page's header is none of its text.
            return Element(tag, "noise", False, in_header=above.zone == "content")
        if above.in_header:
            return Element(tag, "content" if tag in HEADINGS else "noise", False, in_header=tag not in HEADINGS)
        return Element(tag, above.zone, False)

    def _close_down_to(self, place: int) -> None:
        if any(e.tag in BLOCKS for e in self.stack[place:]):
            self._end_block()
        del self.stack[place:]

    def handle_starttag(self, tag, attributes):
        if tag in SPACED:
            self.pieces.append(" ")
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            return
        if tag in BLOCKS:
            self._end_block()
            # A paragraph, and a heading, ends where the next block begins.
            for place in range(len(self.stack) - 1, 0, -1):
                open_tag = self.stack[place].tag
                if open_tag == "p" or open_tag in HEADINGS and tag != "p":
                    del self.stack[place:]
                    break
                if open_tag in BLOCKS:
                    break
        if tag in CONTENT:
            # No article stands inside a menu: its end tag is missing.
            for place in range(1, len(self.stack)):
                if self.stack[place].tag == "nav":
                    self._close_down_to(place)
                    break
        if tag in CLOSES:
            names, bounds = CLOSES[tag]
            for place in range(len(self.stack) - 1, 0, -1):
                if self.stack[place].tag in bounds:
                    break
                if self.stack[place].tag in names:
                    self._close_down_to(place)
                    break
        element = self._zone(tag, attributes)
        if element.zone != self.stack[-1].zone and tag not in BLOCKS and element.zone != "hidden":
            self._end_block()
        self.stack.append(element)

    def handle_startendtag(self, tag, attributes):
        # HTML knows no empty tags: only void elements end themselves.
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag):
        for place in range(len(self.stack) - 1, 0, -1):
            if self.stack[place].tag == tag:
                parts = self.stack[place].zone != self.stack[place - 1].zone and self.stack[place].zone != "hidden"
                if tag in BLOCKS or parts or any(e.tag in BLOCKS for e in self.stack[place:]):
                    self._end_block()
                del self.stack[place:]
                return
        if tag in BLOCKS:
            self._end_block()
        elif tag in SPACED:
            self.pieces.append(" ")

    def parse_marked_section(self, i, report=1):
        # A comment up to the next '>', as in browsers.
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def handle_data(self, data):
        if self.stack[-1].zone != "hidden":
            self.pieces.append(data)


def _host(url: Column) -> Column:
    """The host of a URL in lower case; of anything else, the part before a slash."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))


def read_pages(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, host, digest, main, open, words, owner``.

    ``main`` has the blocks of content elements, or is null; then ``open`` has the blocks
    that are no main text by neither kind nor name. ``words`` hashes the token stream, and
    ``owner`` tells for each word the place of its block in ``open``, or -1.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, hashes = PageReader(), {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [_streams(reader, hashes, text or "") for text in part.column("html").to_pylist()]
                digests = [
                    hashlib.blake2b(f"{host}\n{text or ''}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    for host, text in zip(*(part.column(c).to_pylist() for c in ("host", "html")), strict=True)
                ]
                main, open_, words, owner = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("page_id", "url", "host")),
                        pa.array(digests, pa.binary()),
                        pa.array(main, pa.list_(pa.string())),
                        pa.array(open_, pa.list_(pa.string())),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(owner, pa.list_(pa.int32())),
                    ],
                    names=["page_id", "url", "host", "digest", "main", "open", "words", "owner"],
                )

    frame = pages.select("page_id", "url", _host(F.col("url")).alias("host"), "html")
    kind = dict(frame.dtypes)["page_id"]
    return frame.mapInArrow(
        rows,
        f"page_id {kind}, url string, host string, digest binary, main array<string>, open array<string>, "
        "words array<bigint>, owner array<int>",
    )


def _streams(reader: PageReader, hashes: dict[str, int], text: str):
    page = reader.read(text)
    main = page.content
    if len(hashes) > 500_000:
        hashes.clear()
    open_, words, owner = [], [], []
    for zone, block in page.blocks:
        if zone == "content":
            continue
        own = -1
        if main is None and zone == "open":
            own = len(open_)
            open_.append(block)
        for word in block.split():
            if word not in hashes:
                digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                hashes[word] = int.from_bytes(digest, "little", signed=True)
            words.append(hashes[word])
            owner.append(own)
    return main, open_, words, owner


def suffix_order(words: np.ndarray, page: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of concatenated pages in the order of their first ``length`` words, a power of two, and
    their ranks: equal ones share a rank. Suffixes that leave their page first are left out."""
    _, rank = np.unique(words, return_inverse=True)
    step = 1
    while step < length:
        # Prefix doubling: two ranks of ``step`` words make one of twice as many.
        pairs = rank[:-step].astype(np.int64) * len(words) + rank[step:] if len(rank) > step else rank[:0]
        _, rank = np.unique(pairs, return_inverse=True)
        step *= 2
    whole = np.flatnonzero(page[: len(rank)] == page[length - 1 : length - 1 + len(rank)])
    order = whole[np.argsort(rank[whole], kind="stable")]
    return order, rank[order]


_FACTORS = np.random.default_rng(20_240_301).integers(1, 2**62, REPEAT, dtype=np.int64).astype(np.uint64) * 2 + 1


def _stretch_key(words: np.ndarray, at: np.ndarray, host: int) -> np.ndarray:
    total = np.full(len(at), host, dtype=np.uint64)
    for k in range(REPEAT):
        total = (total ^ words[at + k].view(np.uint64)) * _FACTORS[k]
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def _stretches(host: str, streams: list[tuple[bytes, np.ndarray, bool]]) -> pa.RecordBatch:
    """One row per distinct stretch of the given pages of one host: on how many pages, and where in those
    pages whose blocks are still open."""
    words = np.concatenate([s for _, s, _ in streams])
    page = np.repeat(np.arange(len(streams)), [len(s) for _, s, _ in streams])
    starts = np.cumsum([0, *(len(s) for _, s, _ in streams)])
    open_ = np.array([o for _, _, o in streams], dtype=bool)
    order, rank = suffix_order(words, page, REPEAT)
    first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(order) else np.zeros(0, np.int64)
    group = np.cumsum(np.concatenate([[0], rank[1:] != rank[:-1]])) if len(order) else np.zeros(0, np.int64)
    # Equal suffixes stay in the order of pages, so a page's first one counts it.
    new_page = np.ones(len(order), dtype=np.int64)
    new_page[1:] = (group[1:] != group[:-1]) | (page[order[1:]] != page[order[:-1]])
    counts = np.bincount(group, weights=new_page, minlength=len(first)).astype(np.int64)
    name = int.from_bytes(hashlib.blake2b(host.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    kept = open_[page[order]]
    sizes = np.bincount(group[kept], minlength=len(first))
    places = pa.StructArray.from_arrays(
        [
            pa.array([streams[p][0] for p in page[order[kept]]], pa.binary()),
            pa.array((order[kept] - starts[page[order[kept]]]).astype(np.int32)),
        ],
        names=["digest", "at"],
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(_stretch_key(words, order[first], name)),
            pa.array(counts),
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), places),
        ],
        names=["key", "pages", "places"],
    )


def _flush(host: str, held: list) -> Iterator[pa.RecordBatch]:
    if held:
        found = _stretches(host, held)
        for start in range(0, found.num_rows, 10_000):
            yield found.slice(start, 10_000)


def repeated_stretches(read: DataFrame) -> DataFrame:
    """``key, pages, places``: per part of a host its distinct stretches, after suffix arrays.

    Pages with the same host and markup count once, so copies of a page do not make it boilerplate.
    """
    distinct = read.groupBy("digest").agg(
        F.first("host").alias("host"), F.first("words").alias("words"), F.first(F.col("main").isNull()).alias("open")
    )
    part = F.pmod(F.xxhash64("digest"), F.lit(PARTS))
    dealt = distinct.repartition("host", part).sortWithinPartitions("host", "digest")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, held, size = None, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("host", "digest", "open")]
            streams = batch.column("words")
            for k, (of, digest, open_) in enumerate(zip(*columns, strict=True)):
                if of != host or size >= WORDS:
                    yield from _flush(host, held)
                    host, held, size = of, [], 0
                words = streams[k].values.to_numpy()
                held.append((digest, words, open_))
                size += len(words)
        yield from _flush(host, held)

    return dealt.mapInArrow(rows, "key bigint, pages bigint, places array<struct<digest:binary,at:int>>")


def covered_places(stretches: DataFrame) -> DataFrame:
    """``digest, at``: where in pages with open blocks a repeated stretch begins."""
    stretches = written(stretches)
    # One row per stretch and part of a host: added up, never collected.
    repeated = stretches.groupBy("key").agg(F.sum("pages").alias("on")).filter(F.col("on") >= PAGES).select("key")
    places = stretches.filter(F.size("places") > 0).join(repeated, "key").select(F.explode("places").alias("p"))
    return places.groupBy("p.digest").agg(F.collect_set("p.at").alias("at"))


def _unique_blocks(blocks: list[str], owner: np.ndarray, at: list[int]) -> list[str]:
    """The blocks of which less than half is covered."""
    edges = np.zeros(len(owner) + 1, dtype=np.int64)
    places = np.array(at, dtype=np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, np.minimum(places + REPEAT, len(owner)), -1)
    covered, mine = np.cumsum(edges[:-1]) > 0, owner >= 0
    sizes = np.bincount(owner[mine], minlength=len(blocks))
    hidden = np.bincount(owner[mine], weights=covered[mine], minlength=len(blocks))
    return [b for b, n, c in zip(blocks, sizes, hidden, strict=True) if 2 * c < n]


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    ``text`` joins the blocks of main text in page order by an empty line; character references
    are decoded and white space in a block is one space. It is empty where a page has no main
    text or its html is null or empty. ``n_chars`` counts code points.

    Pages are taken whole. A null url is a host of its own name, the empty one. Null ids stay.
    Rows that repeat an id count each; pages with the same host and html get the same text and
    count once as evidence. Other columns are ignored; no rows give no rows.
    """
    read = written(read_pages(pages))
    # Written, so that a small one is known to be small; only pages with open blocks wait for it.
    covered = written(covered_places(repeated_stretches(read)))
    columns = ["page_id", "url", "main", "open", "owner", "at"]
    settled = read.filter("main IS NOT NULL").withColumn("at", F.lit(None).cast("array<int>"))
    waiting = read.filter("main IS NULL").join(
        covered.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left"
    )
    joined = settled.select(*columns).unionByName(waiting.select(*columns))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = [batch.column(c) for c in ("main", "open", "owner", "at")]
            for main, open_, owner, at in zip(*columns, strict=True):
                blocks = main.as_py()
                if blocks is None:
                    blocks = open_.as_py()
                    if at.is_valid:
                        blocks = _unique_blocks(blocks, owner.values.to_numpy(), at.as_py())
                found.append("\n\n".join(blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array(list(map(len, found)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = dict(read.dtypes)["page_id"]
    return joined.mapInArrow(
        rows, f"page_id {kind}, url string, text string, n_chars bigint"
    )
