"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements of one path of tags, classes
and ids, which hold the same kinds of children, are one node of the tree. A
node's importance is the mean entropy, over the distinct pages that hold it, of
what it contains and of how its children are laid out: the same on every page is
0, different on every page is 1. A node on few pages of its host has the
importance that it has over all hosts, if enough of them have it.

Two kinds of branches are removed from each page: those of low importance, which
are template; and sections (``SECTIONS``) far less important than the best one
beside them, such as menus and adverts, whose words change on every page while
their layout does not.

The elements' own declarations are the prior. What its tag declares to be a
menu, footer, form, script and so on has importance 0; articles, and what stands
in them without a name of its own, 1, so that an article which many pages of a
host share is not taken for template. A block whose class, id or role names it
so (sidebar, notice, advert, comments) keeps a part of its importance: it is
noise unless it differs nearly throughout on enough pages of the host. Beside an
article, a section has to show that it is as important, on pages of its host."""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.tables import written

#: Share of content, against layout, in a node's importance.
CONTENT_SHARE = 0.5
LEAST_IMPORTANCE = 0.1
#: A section is noise below this share of the importance of the best beside it.
LEAST_SHARE = 0.75
#: Share of its importance that an element keeps which is named as noise, and the
#: content entropy that it needs.
NAMED_SHARE = 0.8
LEAST_NAMED_ENTROPY = 0.9
#: A node on fewer distinct pages of a host says nothing about the host's
#: template; on fewer hosts, nothing about others.
LEAST_PAGES = 5
LEAST_HOSTS = 5
#: Up to so many verdicts are broadcast (8 bytes each); beyond, pages are shuffled to theirs.
MOST_SHARED = 1 << 20

# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template textarea title xmp noembed noframes svg annotation annotation-xml".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    optgroup option p pre section summary table caption tbody td tfoot th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = frozenset("ul ol dl table select article section div body html".split())
NOISE_TAGS = frozenset("head nav aside form button select option dialog menu footer input label fieldset audio video object canvas".split())
#: Elements without a meaning of their own, which are compared with each other.
SECTIONS = frozenset("div section center".split())
#: What these are called never makes them noise.
CONTENT_TAGS = frozenset("html body main article".split())
NOISE_WORDS = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside
    ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
    consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe
    subscription signup login share sharing social comment comments commentlist disqus respond reply replies
    related recommended recommendations widget widgets toolbar pagination pager copyright disclaimer
    contentinfo complementary search form skip""".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?>[^\"'>]+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_BEGUN = re.compile(r"<[a-zA-Z/!?]")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


class Node:
    """An open element. ``path`` names it and those it stands in; ``key``, known when
    it ends, the node of the style tree. ``named`` are the elements named as noise
    that it stands in (itself included), ``hinted`` tells whether any has a name
    with a word for noise in it."""

    __slots__ = ("tag", "path", "noise", "article", "sure", "began", "as_noise", "named", "hinted", "children", "key")

    def __init__(self, tag: str, path: int, noise: bool, article: bool, sure: bool, began: int, as_noise: bool = False,
                 named: tuple[Node, ...] = (), hinted: bool = False):
        self.tag, self.path, self.noise, self.article, self.sure, self.began = tag, path, noise, article, sure, began
        self.as_noise, self.named, self.hinted = as_noise, (*named, self) if as_noise else named, hinted
        self.children: list[str] = []
        self.key = path

    @property
    def compared(self) -> bool:
        return self.tag in SECTIONS or self.tag in ("article", "main") or self.as_noise


class Block(NamedTuple):
    pieces: list[str]
    within: tuple[Node, ...]  # the block elements that it stands in
    noise: bool
    article: bool


class Occurrence(NamedTuple):
    """An element of a page: its node, the path above it, its blocks, and so on."""

    key: int
    above: int
    began: int
    ended: int
    layout: int
    sure: bool
    named: bool
    compared: bool


def _describe(tag: str, attributes: str, above: Node) -> tuple[str, bool, bool, bool, bool]:
    """The name that counts for the path; whether it is declared noise; whether
    it is named as noise; whether it is declared an article; whether its names
    have a word for noise in them."""
    named = " ".join(v.strip("\"'") for _, v in _NAMED.findall(attributes)) if attributes else ""
    words = set(_WORD.findall(_CAMEL.sub(" ", named).lower())) if named else set()
    noise = tag in NOISE_TAGS or bool(attributes) and _HIDDEN.search(attributes) is not None
    as_noise = False
    if named and tag not in CONTENT_TAGS:  # a whole name, not some word in it
        for name in named.split():
            own = set(_WORD.findall(_CAMEL.sub(" ", name).lower()))
            as_noise |= bool(own) and (own <= NOISE_WORDS or own == {"header"} and not above.article)
    if not above.article and tag == "header":
        noise = True
    article = tag in ("article", "main") or "main" in words and "role" in attributes.lower() or "articleBody" in attributes
    hinted = tag not in CONTENT_TAGS and not words.isdisjoint(NOISE_WORDS)
    return _DIGITS.sub("0", f"{tag}.{named}") if named else tag, noise, as_noise, article, hinted


class Page:
    """One pass over the html: blocks of text, each with the block elements that it
    stands in; and the elements as occurrences of style nodes."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.nodes: list[Occurrence] = []
        self._stack = [Node("", 0, False, False, True, 0)]
        self._block: list[str] | None = None
        at = 0
        n = html.rfind(">") + 1  # no tag ends beyond
        rest = html[n:]
        while at < n:
            m = _TOKEN.search(html, at, n)
            if m is None:
                self._text(html[at:n])
                break
            if m.start() > at:
                self._text(html[at: m.start()])
            at = m.end()
            closing, tag, attributes, odd, odd_attributes = m.groups()
            if closing:
                self._close(closing.lower())
            elif m.group().startswith("<!--") and not m.group().endswith("-->"):
                rest = ""  # a comment that never ends
            elif tag or odd:
                name = (tag or odd).lower()
                if name in RAW and not (attributes or odd_attributes or "").endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                    at, rest = (end.end(), rest) if end else (n, "")
                else:
                    self._open(name, attributes if tag else odd_attributes)
        if rest:  # up to a tag or comment that never ends
            unfinished = _BEGUN.search(rest)
            rest = rest[: unfinished.start()] if unfinished else rest
            if rest:
                self._text(rest)
        while len(self._stack) > 1:
            self._pop()

    def _text(self, raw: str) -> None:
        top = self._stack[-1]
        home = next((x for x in reversed(self._stack) if x.tag in BLOCK), self._stack[0])
        if top.noise and not home.noise:  # inline noise within a block
            return
        if self._block is None:
            if raw.isspace():
                return
            self._block = []
            self.blocks.append(Block(self._block, tuple(x for x in self._stack if x.tag in BLOCK), home.noise, top.article))
            home.children.append("#")
        self._block.append(unescape(raw) if "&" in raw else raw)

    def _open(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._block = None
            elif tag == "br" and self._block is not None:
                self._block.append(" ")
            return
        if tag in BLOCK:
            self._block = None
            self._imply(tag)
        above = self._stack[-1]
        above.children.append(tag)
        name, noise, as_noise, article, hinted = _describe(tag, attributes, above)
        block = tag in BLOCK
        path = xxhash.xxh64_intdigest(name.encode(), above.path) if block else above.path
        noise = noise or above.noise or as_noise and not block
        article = article or above.article
        sure = noise or not as_noise and tag in ("html", "body") or not as_noise and article and (name == tag or not above.article)
        self._stack.append(Node(tag, path, noise, article, sure, len(self.blocks), as_noise and block, above.named, hinted or above.hinted))

    def _imply(self, tag: str) -> None:
        ends = CLOSES.get(tag, set()) | {"p"}
        for k in range(len(self._stack) - 1, 0, -1):
            here = self._stack[k].tag
            if here in ends:
                while len(self._stack) > k:
                    self._pop()
                return
            if here in SCOPE or here in BLOCK and not ends - {"p"}:
                return

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._block = None
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k].tag == tag:
                while len(self._stack) > k:
                    self._pop()
                return
            if tag not in BLOCK and self._stack[k].tag in BLOCK:
                return

    def _pop(self) -> None:
        x = self._stack.pop()
        if x.tag in BLOCK:
            above = next((y.path for y in reversed(self._stack) if y.tag in BLOCK), 0)
            kinds = sorted({c for c in x.children if c in BLOCK or c == "#"})
            x.key = xxhash.xxh64_intdigest(" ".join(kinds).encode(), x.path)
            layout = xxhash.xxh64_intdigest(" ".join(x.children).encode())
            self.nodes.append(Occurrence(x.key, above, x.began, len(self.blocks), layout, x.sure, x.as_noise, x.compared))

    def style_nodes(self) -> dict[int, tuple[int, int, int, bool, bool, bool]]:
        """By key: the path above the node; hashes of its content and its layout on
        this page; sure if the prior settles its importance; whether it is named as
        noise, and whether it is compared with those beside it."""
        made: dict[int, list] = {}
        digests = [xxhash.xxh64_digest("".join(x.pieces)) for x in self.blocks]
        for x in self.nodes:
            one = made.setdefault(x.key, [x.above, xxhash.xxh64(), xxhash.xxh64(), True, False, False])
            one[1].update(b"".join(digests[x.began:x.ended]) + b"\n")
            one[2].update(x.layout.to_bytes(8, "little"))
            one[3:] = one[3] and x.sure, one[4] or x.named, one[5] or x.compared
        return {k: (above, c.intdigest(), s.intdigest(), *flags) for k, (above, c, s, *flags) in made.items()}

    def text(self, low: set[int] = frozenset(), high: set[int] = frozenset()) -> str:
        """The blocks that are left without noise, the low branches, and those
        named as noise that aren't ``high``. If the page has an article, those
        outside are left only in a section that is high and has no name for noise."""
        some = any(x.article for x in self.blocks if not x.noise)

        def stays(x: Block) -> bool:
            home = x.within[-1] if x.within else None
            if x.noise or home and not (low.isdisjoint(y.key for y in x.within) and high.issuperset(y.key for y in home.named)):
                return False
            if x.article or not some:
                return True
            section = next((y for y in x.within if y.compared), None)
            return section is not None and not home.hinted and section.key in high

        lines = (" ".join("".join(x.pieces).split()) for x in self.blocks if stays(x))
        return "\n\n".join(x for x in lines if x)


_MASK = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _occurrences(source: DataFrame) -> DataFrame:
    """host, page, path, above, content, layout, sure, named, compared of the distinct
    pages of ``source`` (host, page, html). ``path`` is the node's key."""
    schema = "host string, page long, path long, above long, content long, layout long, sure boolean, named boolean, compared boolean"
    kinds = [pa.string(), *[pa.int64()] * 5, *[pa.bool_()] * 3]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                rows: list[tuple] = []
                for host, page, html in zip(*(x.to_pylist() for x in batch.slice(a, 512).columns)):
                    rows += [(host, page, _signed(p), _signed(above), _signed(c), _signed(s), *flags)
                             for p, (above, c, s, *flags) in Page(html).style_nodes().items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(kinds), kinds)],
                                                 ["host", "page", "path", "above", "content", "layout", "sure", "named", "compared"])

    source = source.select("host", "page", "html").filter("html is not null and html <> ''")
    return written(source.mapInArrow(run, schema).distinct(), "nodes")


def _measured(seen: DataFrame, scope: list[str]) -> DataFrame:
    """scope, path, above, pages, sure, named, compared, content_entropy and
    importance of each node within a scope. Counts are combined before each
    shuffle, so a host of any size is one sum."""
    node = [*scope, "path"]
    flags = [F.max("above").alias("above"), F.every("sure").alias("sure"), F.some("named").alias("named"),
             F.some("compared").alias("compared")]

    def entropy(what: str) -> DataFrame:
        counts = seen.groupBy(*node, what).agg(F.count(F.lit(1)).alias("n"), *flags)
        parts = counts.groupBy(*node).agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"), *flags)
        m = F.col("pages")
        flat = F.when(m > 1, (m * F.log(m) - F.col("nlogn")) / (m * F.log(m))).otherwise(F.lit(1.0))
        return parts.withColumn(f"{what}_entropy", flat).drop("nlogn")

    both = entropy("content").join(entropy("layout").select(*node, "layout_entropy"), node)
    own = CONTENT_SHARE * F.col("content_entropy") + (1 - CONTENT_SHARE) * F.col("layout_entropy")
    return both.withColumn("importance", own).drop("layout_entropy")


def _tree(seen: DataFrame) -> DataFrame:
    """What ``style_tree`` returns, from the nodes' occurrences."""
    own = written(_measured(seen, ["host"]), "hosts")
    shared = own.groupBy("path").agg(F.count(F.lit(1)).alias("hosts")).filter(F.col("hosts") >= LEAST_HOSTS)
    others = _measured(seen, []).join(shared, "path").filter(F.col("pages") >= LEAST_PAGES) \
        .select("path", F.col("importance").alias("shared_importance"))
    few = F.col("pages") < LEAST_PAGES
    few_pages = own.filter(few).join(others, "path", "left").withColumn("evidence", F.when(F.col("shared_importance").isNotNull(), "hosts")) \
        .withColumn("importance", F.coalesce("shared_importance", "importance")).drop("shared_importance")
    nodes = written(own.filter(~few).withColumn("evidence", F.lit("pages")).unionByName(few_pages), "tree")
    best = nodes.filter("compared and evidence is not null").groupBy("host", "above").agg(F.max("importance").alias("best"))
    weight = F.when(F.col("named"), NAMED_SHARE).otherwise(1.0)
    share = F.when(F.col("compared"), weight * F.col("importance") / F.greatest("best", F.lit(1e-9)))
    template = F.col("importance") < LEAST_IMPORTANCE
    beaten = F.coalesce(share < LEAST_SHARE, F.lit(False)) | F.col("named") & (F.col("content_entropy") < LEAST_NAMED_ENTROPY)
    verdict = F.when(F.col("evidence").isNull(), None) \
        .when(template | beaten, F.when(~F.col("sure"), "low")) \
        .when(F.col("compared") & (F.col("evidence") == "pages"), "high")
    return nodes.join(best, ["host", "above"], "left") \
        .select("host", "path", "pages", "sure", "named", "importance", verdict.alias("verdict"))


def style_tree(pages: DataFrame) -> DataFrame:
    """From pages (host, html): host, path, pages, importance, sure, named and verdict
    (low, high or null) for every node of each host's merged tree. Pages of equal
    html count once."""
    return _tree(_occurrences(pages.select(F.coalesce("host", F.lit("")).alias("host"), F.xxhash64("html").alias("page"), "html")))


def _shared(verdicts: DataFrame) -> Callable[[str, Page], tuple[set[int], set[int]]]:
    """The verdicts on a page's nodes from sorted marks of (host, node), broadcast."""
    marked = verdicts.select(F.xxhash64("host").bitwiseXOR(F.col("path")).alias("mark"), (F.col("verdict") == "low").alias("low")).toArrow()
    marks, is_low = (marked.column(k).to_numpy() for k in (0, 1))
    held = verdicts.sparkSession.sparkContext.broadcast(tuple(np.sort(marks[x].view(np.uint64)) for x in (is_low, ~is_low)))

    def of(host: str, page: Page) -> tuple[set[int], set[int]]:
        keys = np.array(list({x.key for x in page.nodes}), np.uint64)
        marks = keys ^ np.uint64(xxhash.xxh64_intdigest(host, 42))

        def known(table: np.ndarray) -> set[int]:
            if not len(table):
                return set()
            at = np.minimum(np.searchsorted(table, marks), len(table) - 1)
            return set(keys[table[at] == marks].tolist())

        low, high = held.value
        return known(low), known(high)

    return of


def extract(pages: DataFrame, host: F.Column, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html",
            most_shared: int = MOST_SHARED) -> DataFrame:
    """``keep`` and ``text``: the main text of each page's whole html.

    Blocks (the standard's block elements) have their character references
    decoded and white space made single spaces, and are joined by two line
    feeds. A null or empty html, and a page without main text, has an empty
    text; a html of any length is read whole. Null hosts are one host; repeated
    rows are extracted each; columns of clashing names play no part; an empty
    table gives no rows."""
    source = pages.select(*keep, F.coalesce(host, F.lit("")).alias("__host"), F.xxhash64(F.col(html)).alias("__page"),
                          F.col(html).alias("__html"))
    seen = _occurrences(source.select(F.col("__host").alias("host"), F.col("__page").alias("page"), F.col("__html").alias("html")))
    verdicts = written(_tree(seen).filter("verdict is not null").select("host", "path", "verdict"), "verdicts")
    schema = source.select(*keep, F.lit("").alias("text")).schema
    shared = _shared(verdicts) if verdicts.count() <= most_shared else None
    if shared:
        joined = source.select(*keep, "__host", "__html")
    else:
        # a page meets the verdicts on its own nodes only; written, so that the join has a
        # shuffle of its own on either side, of which Spark splits a crowded one
        sets = [F.collect_set(F.when(F.col("verdict") == x, F.col("path"))) for x in ("low", "high")]
        own = written(seen.select("host", "page", "path").join(verdicts, ["host", "path"])
                      .groupBy(F.col("host").alias("__host"), F.col("page").alias("__page")).agg(F.array(*sets).alias("__sets")), "own")
        joined = source.join(own, ["__host", "__page"], "left").select(*keep, "__sets", "__html")

    def text(held, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        return page.text(*(shared(held, page) if shared else ({x & _MASK for x in y} for y in held or ((), ()))))

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts = [text(*x) for x in zip(*(part.column(k).to_pylist() for k in (-2, -1)))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(texts, pa.string())], schema.names)

    return joined.mapInArrow(run, schema)
