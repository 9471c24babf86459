"""Operator 6: main text of web pages by removal of site templates.

A page is parsed once.  Every element with text that doesn't go by its own markup
gets a hash of its tags and text, inside and outside of articles; Spark counts for each host on how many of its
different pages a hash occurs.  Elements that recur on at least `share` of a
host's pages, and on `least` of them, or, where no article is marked, on `many`,
are the site's template and are deleted, with all that is in them.  Pages of one
host with the same content count as one page, and templates that together hold
most of a page, as the paragraphs that near copies share, stay.

What is no article by its own markup goes whatever the counts say: scripts,
styles, form controls, navigation, headers and footers of the page, asides,
reader comments, and elements whose class, id or role names a menu, sidebar,
notice or advert; but a form, or an element of such a name, that holds most of
the page's text is its content.  If the page marks its article (article, main,
role=main), that is what remains.

Counting aggregates before the shuffle, so a host with a third of all pages
sends one row a task and hash.  A page keeps its blocks of text and for each
element the blocks in it; templates come back to it by a join on host and hash,
and the page is not parsed again.

Defined results: null html is empty and gives an empty text; a null url belongs
to the host ''; a page with no text gives ''; tags that never close end with
their parent; very long and very deep pages are read whole; repeated rows stay
repeated; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import materialise, tidied

#: A template stands on so many pages of a host, and on such a share of them, or on many.
LEAST_PAGES, SHARE, MANY_PAGES = 10, 0.2, 500
#: Templates that hold more than these shares of a marked article's text, or of an unmarked page's, are kept.
ARTICLE_LOSS, PAGE_LOSS = 0.3, 0.9
#: Pages parsed at once.
ROWS = 500

# HTML elements by how they take part.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video"}
DROPPED = RAW | {"head", "nav", "aside", "form", "button", "select", "textarea", "dialog", "menu", "label", "input", "fieldset", "footer"}
#: Dropped outside a marked article; inside one it holds the title.
EDGES = {"header"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SCOPES = {"p": {"div", "article", "section", "td", "th", "li", "body", "blockquote", "main"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select", "datalist"}}
KEPT = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
# Words in class, id or role that name what is no article; those of reader comments count on articles too.
NOISE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "promo", "promotion", "sponsor", "sponsored", "sponsors", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "sidebar", "sidebars", "aside", "complementary", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "searchbox", "share", "sharing", "social", "related", "recommended", "recommendations", "footer", "header", "masthead", "copyright", "contentinfo", "toolbar", "pagination", "pager", "widget", "skip", "form"}
COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies"}
NAMES = re.compile(r"[^\s_-]+")
MARKED = re.compile(r"(?:^|\s)main(?:$|\s)", re.I)
#: An element that is noise by its name only, or a form, counts as content if it holds more than this share of the page's text.
MOST = 0.5


class Node:
    __slots__ = ("tag", "noise", "named", "article", "parts")

    def __init__(self, tag: str, noise: bool = False, named: bool = False, article: bool = False) -> None:
        self.tag, self.noise, self.named, self.article, self.parts = tag, noise, named, article, []


class Tree(HTMLParser):
    """A tolerant tree of elements and decoded text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.stack = [self.root]
        self.open: Counter = Counter()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for closed in CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set()):
            self._close(closed, SCOPES.get(closed, set()))
        if tag == "body":
            self._close("head", set())
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden", "itemprop")} if attrs else {}
        marked = tag in ("article", "main") or bool(MARKED.search(given.get("role", ""))) or given.get("itemprop") == "articleBody"
        noise, named = tag in DROPPED or "hidden" in given or given.get("aria-hidden") == "true", tag == "form"
        if given and not noise and (tag not in KEPT or tag == "article"):
            words = {w.lower() for k in ("class", "id", "role") if k in given for w in NAMES.findall(given[k])}
            noise = not words.isdisjoint(COMMENTS)
            if not noise and tag != "article" and not words.isdisjoint(NOISE):
                noise = named = True
        node = Node(tag, noise, named, marked and not noise)
        self.stack[-1].parts.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in RAW:
            self._cut(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        self._close(tag, set())

    def _close(self, tag: str, scopes: set[str]) -> None:
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._cut(i)
                return
            if self.stack[i].tag in scopes or (self.stack[i].tag in ("article", "main", "body", "table") and tag in INLINE | {"p", "li"}):
                return

    def _cut(self, i: int) -> None:
        for node in self.stack[i:]:
            self.open[node.tag] -= 1
        del self.stack[i:]

    def handle_data(self, data: str) -> None:
        self.stack[-1].parts.append(data)


def parsed(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    _reconsider(tree.root)
    return tree.root


def nodes_below(top: Node, noise: bool = True) -> list[Node]:
    """top and all elements below it, parents before children; without noise what is noise is left out with all in it."""
    order, stack = [], [top]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [p for p in reversed(node.parts) if isinstance(p, Node) and (noise or not p.noise)]
    return order


def _reconsider(root: Node) -> None:
    """What is noise by its name only, or a form, is content if it holds most of the text outside other noise."""
    order = nodes_below(root)
    if not any(n.named for n in order):
        return
    size: dict[int, int] = {}
    for node in reversed(order):
        own = sum(len(p) - p.count(" ") - p.count("\n") if isinstance(p, str) else size[id(p)] for p in node.parts)
        size[id(node)] = 0 if node.noise and not node.named else own
    for node in order:  # from the outside in: what lies in noise goes anyway
        if node.named and size[id(node)] > MOST * size[id(root)]:
            node.noise = False


def content(root: Node) -> tuple[list[Node], bool]:
    """The outermost marked articles that are no noise, or else the root; and whether they were marked."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.article:
            found.append(node)
        elif not node.noise:
            stack += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return (found, True) if found else ([root], False)


def visible(node: Node, within: bool) -> bool:
    return not node.noise and (within or node.tag not in EDGES)


def digests(nodes: list[Node]) -> dict[int, bytes]:
    """The hash of each element's tags and text, for those of the given ones (parents first) with text in them."""
    own: dict[int, bytes] = {}
    for node in reversed(nodes):
        h, full = blake2b(node.tag.encode(), digest_size=8), False
        for p in node.parts:
            if isinstance(p, Node):
                if id(p) in own:
                    h.update(own[id(p)])
                    full = True
            elif words := p.split():
                h.update(" ".join(words).encode("utf-8", "surrogatepass"))
                full = True
        if full:
            own[id(node)] = h.digest()
    return own


def blocks_of(root: Node) -> tuple[list[str], list[tuple[int, int, int]], bool]:
    """(texts of the content's blocks in page order; (hash, first block, end) of every element that holds some; marked).

    Elements outside a marked article are listed too, without blocks: they count
    as their site's.  What goes by its own markup is not: no count changes that.
    """
    tops, marked = content(root)
    every = nodes_below(root, noise=False)
    hashes = digests(every)
    blocks: list[str] = []
    current: list[str] = []
    spans: dict[int, tuple[int, int]] = {}

    def flush() -> None:
        if words := "".join(current).split():
            blocks.append(" ".join(words))
        current.clear()

    for top in tops:
        stack: list[Node | str | tuple[Node, int]] = [top]
        while stack:
            part = stack.pop()
            if isinstance(part, tuple):  # a block element ends
                flush()
                if len(blocks) > part[1]:
                    spans[id(part[0])] = part[1], len(blocks)
            elif isinstance(part, str):
                current.append(part)
            elif part is top or visible(part, marked):
                if part.tag not in INLINE:
                    flush()
                    stack.append((part, len(blocks)))
                stack += reversed(part.parts)
        flush()
    nodes = []
    for node in every:
        if id(node) in hashes and node.tag not in INLINE and node.tag not in ("html", "body", "#root") and not any(node is t for t in tops):
            nodes.append((int.from_bytes(hashes[id(node)], "little", signed=True), *spans.get(id(node), (-1, -1))))
    return blocks, nodes, marked


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def main_text(pages: DataFrame, least: int = LEAST_PAGES, share: float = SHARE, many: int = MANY_PAGES) -> DataFrame:
    """page_id, url, text, n_chars, n_templates (elements deleted as their site's) of every page."""
    keyed = pages.select("page_id", "url", "html", F.xxhash64(host_of(F.col("url"))).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                size, out, parts, sizes = batch.num_rows, [], [], [0]
                for html in batch.column("html").to_pylist():
                    blocks, nodes, marked = blocks_of(parsed(html or ""))
                    parts += nodes
                    sizes.append(len(parts))
                    same = blake2b(b"".join(h.to_bytes(8, "little", signed=True) for h, _, _ in nodes), digest_size=8)
                    same.update("\n".join(blocks).encode("utf-8", "surrogatepass"))
                    out.append((blocks, marked, int.from_bytes(same.digest(), "little", signed=True)))
                texts, marks, contents = zip(*out, strict=True)
                fields = zip(*parts, strict=True) if parts else ([], [], [])
                held = pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(fields, (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["hash", "first", "end"])
                columns = [pa.array(list(texts), pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), held), pa.array(marks, pa.bool_()), pa.array(contents, pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(range(row, row + size), pa.int64()), *batch.select(["page_id", "url", "host"]).columns, *columns], ["row", "page_id", "url", "host", "blocks", "nodes", "marked", "content"])
                row += size

    rows = materialise(keyed.mapInArrow(tidied(run), "row long, page_id long, url string, host long, blocks array<string>, nodes array<struct<hash:long,first:int,end:int>>, marked boolean, content long"), "pages")
    # distinct contents of a host: copies of a page count once
    of_hosts = rows.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = rows.select("host", "content", F.explode(F.array_distinct(F.transform("nodes", lambda n: n["hash"]))).alias("hash")).distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    recurring = counts.join(of_hosts, "host").select("host", "hash", (F.col("n") >= share * F.col("pages")).alias("common"), (F.col("n") >= many).alias("often")).where("common or often")
    recurring = materialise(recurring, "templates")
    inside = rows.select("row", "host", "marked", F.explode(F.filter("nodes", lambda n: n["first"] >= 0)).alias("n")).select("row", "host", "marked", "n.*")
    # within a marked article only what a share of all pages holds is the site's
    hits = inside.join(recurring, ["host", "hash"]).where("common or not marked").groupBy("row").agg(F.collect_list(F.struct("first", "end")).alias("gone"))
    hits = materialise(hits, "hits")  # written first: where few pages hold templates, Spark sees that before it deals out texts
    hit = rows.select("row", "page_id", "url", "marked", "blocks").join(hits, "row", "left")
    at = F.transform("blocks", lambda b, i: F.struct(b.alias("b"), F.exists("gone", lambda g: (g["first"] <= i) & (i < g["end"])).alias("gone")))
    hit = hit.withColumn("at", F.when(F.col("gone").isNotNull(), at))
    size = lambda which: F.aggregate(F.filter("at", which), F.lit(0), lambda acc, x: acc + F.length(x["b"]))
    lost, held = size(lambda x: x["gone"]), size(lambda x: ~x["gone"])
    # templates that hold too much of a page are no templates but its story, as near copies share it
    acts = F.coalesce(lost <= F.when(F.col("marked"), ARTICLE_LOSS).otherwise(PAGE_LOSS) * (lost + held), F.lit(False))
    kept = F.when(acts, F.transform(F.filter("at", lambda x: ~x["gone"]), lambda x: x["b"])).otherwise(F.col("blocks"))
    out = hit.select("page_id", "url", F.array_join(kept, " ").alias("text"), F.when(acts, F.size("gone")).otherwise(0).cast("long").alias("n_templates"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_templates")
