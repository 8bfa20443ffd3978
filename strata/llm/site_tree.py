"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: elements with the same path of tags and classes are one node
of the site's tree. Pages of a host whose blocks are equal count as one, so that copies of an article
do not make its node look like furniture. For a node on m such pages, the importance of its presentation is the entropy (log m)
of the child sequences it is seen with, and that of its content one less the mean entropy of its
texts over the pages: what every page repeats tells nothing. Branches of low importance are removed
from each page.

Entropy can't see menus or adverts whose words differ on every page, sites with one page, or
articles that several pages carry. So the importance of a node whose element or class says what it is
is given: 0 for menus, headers, footers, sidebars, notices, adverts, forms and comments, 1 for the
article. An element or role of an article outranks words of noise in its own class and around it, and a whole name
of the article those beside it; a name says noise by its last word only (site-footer, ad-box; not
category-social-media or ad-free). Entropy decides the rest on every page, inside the article too: what
the site's articles repeat, like share bars and calls to subscribe, goes. An article's headings stay, and
so does an article of which entropy would take more than half, as a copied one. Pages of a host whose
articles have one longest block count as one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, stored

# Elements of HTML by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output progress q "
    "ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr".split()
)
NOISE_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe object svg math select button textarea head menu dialog "
    "canvas audio video title noembed noframes xmp map datalist".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar widget widgets footer header masthead cookie cookies consent gdpr notice notices popup modal "
    "newsletter subscribe subscription share sharing social related recommended comment comments reply replies respond "
    "disqus disclaimer paywall topbar sidenav subnav topnav navmenu submenu menubar adbox adslot adsense login signup search pagination pager toolbar skip copyright alert".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())
#: A name with one of these, like no-sidebar or comments-closed, tells a state of the page.
STATE_WORDS = frozenset("no has have with without".split())
#: A name that starts with one of these, like category-social or tag-notice, tells what the text is about.
TOPIC_WORDS = frozenset("category cat tag type format topic term status author".split())
#: What may stand behind the word that says what an element is, like ad-box or related-posts.
PART_WORDS = frozenset(
    "area bar block body bottom box btn button buttons col column container content count counts form group holder icon icons inner "
    "item items left link links list main me news outer page panel post posts primary region right row section secondary slot stories story "
    "text this title top unit us videos wrap wrapper zone article articles js".split()
)
#: Elements named so are never put back where a page would be left without text.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot adsense sponsor sponsored menu nav navbar navigation topbar sidenav subnav "
    "topnav navmenu submenu menubar breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr login signup search pagination pager toolbar".split()
)
COMMENT_STATES = frozenset("open opened close closed enabled disabled allowed on off".split())
#: Share of the text outside noise that the article must hold to be taken alone.
FAIR_SHARE = 0.25
#: Share of an article's text that must be left by the tree; of copied articles less would be.
LEFT_SHARE = 0.5
MAIN_WORDS = frozenset("article content main post entry story".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: An open element of the first kind is closed by the start of one of the second.
CLOSES = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
        "h6 header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody"]),
    "th": frozenset(["td", "th", "tr", "tbody"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Nothing outside these is closed by a start inside them.
SCOPES = frozenset("html body article aside section div main nav table td th ul ol dl form footer header blockquote".split())

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)")
_WORDS = re.compile(r"[a-z]+")


@dataclass
class _Open:
    """An open element: its node of the site tree, and what its surroundings say about text in it."""

    tag: str
    path: int
    main: bool = False
    noise: bool = False
    hard: bool = False  # noise that no element inside can undo
    heading_only: bool = False  # the header of an article: its headings alone count
    commented: bool = False  # hard noise for no other reason than one element named as comments
    held: int = 0  # the article element, by its place, that one element named as comments is or holds
    heading: bool = False  # a heading, or in one
    soft: int = 0  # the outermost element that is noise by its name alone, by its place; 0: none, or noise for good


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _noise_word(words: list[str]) -> str | None:
    """The word of noise that a name says its element is: its last word, but for words of parts behind it."""
    if not words or STATE_WORDS.intersection(words) or len(words) > 1 and words[0] in TOPIC_WORDS:
        return None
    if COMMENT_STATES.intersection(words) and COMMENT_WORDS.intersection(words):
        return None
    for word in reversed(words):
        if word in NOISE_WORDS:
            return word
        if word not in PART_WORDS:
            return None
    return None


def _opened(parent: _Open, tag: str, attributes: str, place: int) -> _Open:
    words: list[str] = []
    said: set[str] = set()  # words of noise that its names say it is
    whole = False  # a name that is a word of the article
    role, hidden = "", False
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name = (m.group(1) or "").lower()
            value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
            if name in ("class", "id"):
                words += _WORDS.findall(value)
                for token in value.split() if tag not in ("html", "body") else ():
                    named = _WORDS.findall(token)
                    whole |= len(named) == 1 and named[0] in MAIN_WORDS
                    if (word := _noise_word(named)) is not None:
                        said.add(word)
            elif name == "role":
                role = value.strip()
            elif name == "hidden" or m.group(5) or name == "aria-hidden" and value == "true":
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
    path = _hash(f"{parent.path}>{tag}.{' '.join(words)}")
    node = _Open(tag, path, parent.main, parent.noise, parent.hard, parent.heading_only, parent.commented, parent.held, parent.heading, parent.soft)
    article = tag in ("article", "main") or role in ("main", "article")
    comments = bool(COMMENT_WORDS.intersection(said))
    main_named = tag in ("div", "section", "td") and (whole or bool(MAIN_WORDS.intersection(words)) and not said)
    # Beside a name of the article, like post or content, names of noise do not count.
    says_noise = role in NOISE_ROLES or bool(said) and not article and not (whole and main_named)
    if tag in NOISE_TAGS or hidden:
        node.noise = node.hard = True
        node.commented, node.soft = False, 0
    elif comments and (not article or parent.hard or parent.held):
        node.noise = node.hard = True
        node.commented, node.soft = not (parent.hard or parent.held), 0
    elif article and (comments or parent.commented):
        node.main, node.noise, node.hard, node.commented, node.held = True, False, False, False, place
    elif not article and (tag == "header" or "header" in said) and parent.main and not parent.noise:
        node.heading_only = True
    elif says_noise or tag == "header":
        named_only = tag != "header" and role not in NOISE_ROLES and not FURNITURE_WORDS.intersection(said)
        node.soft = (parent.soft or place) if named_only and (parent.soft or not parent.noise) else 0
        node.noise = True
    elif article or main_named:
        node.main, node.noise, node.soft = True, node.hard, 0
    if tag in HEADINGS:
        node.heading_only, node.heading = False, True
    return node


def leaves(page: str | None) -> Iterator[tuple[str, _Open, tuple[int, ...]] | tuple[None, _Open, tuple[str, ...]]]:
    """(text, element, block) of every piece of text in page order; (None, element, child tags) as elements close.

    Pieces with equal blocks belong to one block of text.
    """
    if not page:
        return
    stack, children, block, at = [_Open("", 0)], [[]], 0, 0
    opened: Counter[str] = Counter()  # how many elements of a name are open
    marks: list[int] = []  # where the open elements stand that a start can close, or that end its search

    def close():
        node = stack.pop()
        opened[node.tag] -= 1
        if marks and marks[-1] == len(stack):
            marks.pop()
        return None, node, tuple(children.pop())

    for m in _MARKUP.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            yield page[at : m.start()], stack[-1], block
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        if m.group(1) or m.group(4):  # an end tag
            if tag == "br":
                yield " ", stack[-1], block
            elif opened[tag] > 0:
                block += tag not in INLINE
                while stack[-1].tag != tag:
                    yield close()
                yield close()
            continue
        if m.end() == len(page) and page[-1] != ">":
            continue  # a tag that the page's end cuts off
        if tag in INLINE:
            if tag == "br":
                yield " ", stack[-1], block
                continue
        else:
            block += 1
            for k in reversed(marks):
                if tag in CLOSES.get(stack[k].tag, ()):
                    while len(stack) > k:
                        yield close()
                    break
                if stack[k].tag in SCOPES:
                    break
        node = _opened(stack[-1], tag, m.group(3) or m.group(6) or "", m.end())
        children[-1].append(tag)
        if tag in VOID:
            continue
        if tag in SCOPES or tag in CLOSES:
            marks.append(len(stack))
        opened[tag] += 1
        stack.append(node)
        children.append([])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?|\Z", re.IGNORECASE).search(page, at)
            at = end.end()
            yield close()
            block += 1
    if at < len(page):
        yield page[at:], stack[-1], block
    while stack:
        yield close()


def _squeezed(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _blocks(page: str | None) -> list[tuple[str, _Open]]:
    """(text, element) of every block with text outside noise; a block that spans inline elements is one.

    An article in an element named as comments is the page's if it is the only one there and none is elsewhere.
    """
    blocks = [(text, node) for raw, node in _raw_blocks(page) if (text := _squeezed(raw))]
    if len({node.held for _, node in blocks if node.held}) > 1 or any(node.main and not node.held for _, node in blocks):
        return [(text, node) for text, node in blocks if not node.held]
    return blocks


def _put_back(page: str | None) -> list[str]:
    """The blocks of the largest branch that is noise by its name alone, the first of equals; furniture stays out."""
    branches: dict[int, list[str]] = {}
    for raw, node in _raw_blocks(page, lambda node: node.noise and node.soft and not node.hard):
        if text := _squeezed(raw):
            branches.setdefault(node.soft, []).append(text)
    return max(branches.values(), key=lambda texts: sum(map(len, texts)), default=[])


def _raw_blocks(page: str | None, wanted: Callable[[_Open], bool] = lambda node: not node.noise) -> Iterator[tuple[str, _Open]]:
    held: list[str] = []
    first, last = None, None
    for text, node, block in leaves(page):
        if text is None or node.heading_only or not wanted(node):
            continue
        if block != last and held:
            yield "".join(held), first
            held = []
        if not held:
            first = node
        held.append(text)
        last = block
    if held:
        yield "".join(held), first


def nodes(page: str | None) -> tuple[int, set[tuple[int, int, int]]]:
    """The page's body; (path, 0, style) and (path, 1, text) of its elements outside noise, each once.

    The body is a hash of the article's longest block, so that near copies have one too; without an article, of all blocks.
    """
    styles: dict[int, list[str]] = {}
    for text, node, tags in leaves(page):
        if text is None and not node.noise and not node.held and node.tag:
            styles.setdefault(node.path, []).append(" ".join(k for k, _ in _runs(tags)))
    out = {(path, 0, _hash("|".join(k for k, _ in _runs(seen)))) for path, seen in styles.items()}
    found = _blocks(page)
    blocks = [(node.path, _hash(text)) for text, node in found]
    longest = max((text for text, node in found if node.main), key=len, default=None)
    body = _hash(repr(blocks) if longest is None else longest)
    return body, out | {(path, 1, text) for path, text in blocks}


def _runs(items) -> Iterator[tuple[str, int]]:
    last = None
    for item in items:
        if item != last:
            yield item, 1
        last = item


def main_text(page: str | None, removed: frozenset[int] = frozenset()) -> str:
    """The article's blocks, joined by two line feeds; without an article, all blocks but noise; `removed` nodes go from both.

    An article keeps its headings, and all of its blocks if less than LEFT_SHARE of its text would be left.
    If the article's blocks hold less than FAIR_SHARE of the text that is left with them, they are
    only some of them. If every block with text would be removed, none is; if names leave no text at all,
    the largest branch named as noise is put back, but for menus, headers, footers, forms, adverts and comments.
    """
    blocks = _blocks(page)
    whole = [text for text, node in blocks if node.main]
    article = [text for text, node in blocks if node.main and (node.heading or node.path not in removed)]
    copied = sum(map(len, article)) < LEFT_SHARE * sum(map(len, whole))
    if copied:
        article = whole
    left = [text for text, node in blocks if node.path not in removed or node.main and (copied or node.heading)]
    if article and sum(map(len, article)) >= FAIR_SHARE * sum(map(len, left)):
        return "\n\n".join(article)
    return "\n\n".join(left or [text for text, _ in blocks] or _put_back(page))


def host(url_col: str = "url"):
    """Host of a URL in lower case; NULL or odd URLs share the empty host, which is never merged."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def site_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of every node of every host's merged tree outside noise.

    `pages` counts distinct bodies: pages of a host with equal blocks, or one longest block of their articles,
    are one, with the least of their styles. Node rows are counted by value before nodes are, so a host with a third of all pages is spread.
    """

    def make():
        def each(batch: pa.RecordBatch) -> pa.Table:
            rows: list[list] = [[], [], [], [], []]
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                body, found = nodes(page)
                for node in found:
                    for column, value in zip(rows, (name, body, *node), strict=True):
                        column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            return pa.table({n: pa.array(v, k) for n, v, k in zip(("host", "body", "path", "kind", "value"), rows, kinds, strict=True)})

        return each

    rows = by_batch(pages.where("host <> ''").select("host", "html"), make, "host string, body long, path long, kind int, value long")
    once = rows.groupBy("host", "body", "path", "kind", F.when(F.col("kind") == 1, F.col("value")).alias("text")).agg(F.min("value").alias("value"))
    counts = once.groupBy("host", "path", "kind", "value").agg(F.count("*").cast("double").alias("c"))
    style, content = F.col("kind") == 0, F.col("kind") == 1
    sums = counts.groupBy("host", "path").agg(
        F.sum(F.when(style, F.col("c"))).alias("pages"),
        F.sum(F.when(style, F.col("c") * F.ln("c"))).alias("styles"),
        F.sum(F.when(content, F.col("c"))).alias("texts"),
        F.sum(F.when(content, F.col("c") * F.ln("c"))).alias("repeats"),
    )
    log_m = F.ln("pages")
    presentation = F.when(F.col("pages") <= 1, 1.0).otherwise(1 - F.col("styles") / (F.col("pages") * log_m))
    words = F.when(F.col("pages") <= 1, 1.0).otherwise(1 - F.col("repeats") / (F.col("texts") * log_m))
    importance = F.when(F.col("texts").isNull(), presentation).otherwise(0.1 * presentation + 0.9 * words)
    return sums.select("host", "path", "pages", importance.alias("importance"))


def extract(pages: DataFrame, threshold: float = 0.3, least_pages: int = 3) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages`.

    Nodes on at least `least_pages` distinct bodies of a host with an importance under `threshold` are
    removed, from articles too, but not all text of a page (see main_text). NULL, empty and unreadable html gives an empty text. Repeated
    rows are answered alike, and count for the tree once. Pages whose URL has no host belong to no tree. Other columns are not read.
    """
    rows = pages.select(F.col("page_id"), F.col("url"), F.col("html").cast("string").alias("html"), host().alias("host"))
    low = site_tree(rows).where((F.col("pages") >= least_pages) & (F.col("importance") < threshold)).select("host", "path")
    low = stored(low, "site-tree")
    read = stored(_read(rows, dict(pages.dtypes)), "site-pages")
    done = read.where("blocks is null").select("page_id", "url", "text")

    # Which of a page's own nodes are removed: rows of host and path, no list of a host's. They are
    # written, so that Spark knows how few they are and does not shuffle the texts for them.
    open_ = read.where("blocks is not null")
    own = open_.select("host", "page", F.explode(F.array_distinct(F.col("blocks.path"))).alias("path"))
    gone = own.join(low, ["host", "path"]).groupBy("host", "page").agg(F.collect_set("path").alias("gone"))
    found = open_.join(stored(gone, "site-gone"), ["host", "page"], "left").withColumn("gone", F.expr("coalesce(gone, array())"))

    def size(blocks):
        return F.expr(f"aggregate({blocks}, 0L, (n, b) -> n + length(b.text))")

    found = found.withColumn("whole", F.expr("filter(blocks, b -> b.main)"))
    found = found.withColumn("article", F.expr("filter(whole, b -> b.heading or not array_contains(gone, b.path))"))
    found = found.withColumn("copied", size("article") < LEFT_SHARE * size("whole"))
    found = found.withColumn("article", F.when(F.col("copied"), F.col("whole")).otherwise(F.col("article")))
    found = found.withColumn("left", F.expr("filter(blocks, b -> not array_contains(gone, b.path) or b.main and (copied or b.heading))"))
    fair = (size("article") >= FAIR_SHARE * size("`left`")) & (F.size("article") > 0)
    found = found.withColumn("best", F.when(fair, F.col("article")).when(F.size("left") > 0, F.col("left")).otherwise(F.col("blocks")))
    text = F.array_join(F.transform("best", lambda b: b["text"]), "\n\n")
    every = done.unionByName(found.select("page_id", "url", text.alias("text")))
    return every.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _read(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(page_id, url, host, page, text, blocks): the blocks outside noise, of which the site's tree decides, or the text of pages without any."""

    def make():
        kind = pa.list_(pa.struct([("path", pa.int64()), ("main", pa.bool_()), ("heading", pa.bool_()), ("text", pa.string())]))

        def each(batch: pa.RecordBatch) -> pa.Table:
            texts, blocks = [], []
            for page in batch.column("html").to_pylist():
                found = _blocks(page)
                texts.append(None if found else "\n\n".join(_put_back(page)))
                blocks.append([{"path": node.path, "main": node.main, "heading": node.heading, "text": text} for text, node in found] or None)
            kept = {c: batch.column(c) for c in ("page_id", "url", "host", "page")}
            return pa.table(kept | {"text": pa.array(texts, pa.string()), "blocks": pa.array(blocks, kind)})

        return each

    keyed = rows.withColumn("page", F.md5(F.col("html").cast("binary")))
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, host string, page string, text string, blocks array<struct<path: long, main: boolean, heading: boolean, text: string>>"
    return by_batch(keyed.select("page_id", "url", "host", "page", "html"), make, schema)
