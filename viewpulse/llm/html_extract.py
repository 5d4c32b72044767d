"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: nodes with the same path of element names and classes are one style node. For each,
Spark counts over the host's pages how its contents and its children's signatures are distributed. The entropy of either,
relative to that of as many pages that all differ, is the node's importance: what says the same on every page is not the
article. Branches of low importance are cut from each page; copies of a page count once.

Entropy alone keeps what differs from page to page without being the article (menus with links by topic, rotating adverts),
and small sites give it too little to go by. So elements that say by name, role or class that they are menus, notices,
adverts, comments and the like are cut first, and only what is left is judged. All that survives is the text: pages put
theirs in any element, and an <article> may be a teaser or an introduction.

Counts travel as hashes. A host may have any number of pages: style nodes are counted by (host, node, value) with partial
sums, and a page meets the nodes it loses in a join by (host, node), which adaptive execution can split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.shipping import in_arrow
from viewpulse.sources.tables import settle

MIN_PAGES = 5
MIN_IMPORTANCE = 0.25
CONTENT_WEIGHT = 0.8

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that begin a block of their own.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
HIDDEN = frozenset("audio button canvas datalist head iframe input math noscript object script select style svg template textarea title video".split())
CUT_TAGS = frozenset("aside dialog footer form menu nav search".split())
CUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disqus disclaimer discussion feedback footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager "
    "pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription teaser toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag closes if it is open inside the named limits.
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    def words(self) -> set[str]:
        named = " ".join(_CAMEL.sub(" ", self.attrs.get(a, "")) for a in ("class", "id"))
        return set(_SPLIT.split(named.lower())) - {""}

    def is_comment(self) -> bool:
        """An article that is a reader's comment has the very word as a class; "comments-open" speaks of the page."""
        return self.tag == "article" and bool(set(self.attrs.get("class", "").lower().split()) & COMMENT_WORDS)

    def signature(self) -> str:
        return ".".join([self.tag, *sorted(self.attrs.get("class", "").split())])


class Tree(HTMLParser):
    """A forgiving DOM: open elements are closed where HTML implies it, stray end tags are ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html")

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and (tag == "html" or any(n.tag == "body" for n in self._open())):
            return
        if tag in BLOCK:
            self._close({"p"}, {"table", "td", "th", "button", "article", "section", "div", "li", "blockquote"})
        if tag in ("article", "main"):
            self._close({"nav"}, set())
        if tag in _CLOSED_BY:
            self._close(*_CLOSED_BY[tag])
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self._open()):
            self._close({tag}, set())
        elif tag == "br":
            self.at.children.append(Node("br", {}, self.at))

    def handle_data(self, data):
        self.at.children.append(data)

    def _open(self) -> Iterator[Node]:
        node = self.at
        while node is not self.root:
            yield node
            node = node.parent

    def _close(self, tags: set[str], limits: set[str]) -> None:
        for node in self._open():
            if node.tag in tags:
                self.at = node.parent
                return
            if node.tag in limits:
                return


def parse(html: str | None) -> Node:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def elements(root: Node) -> Iterator[tuple[Node, str]]:
    """Every element below `root` with its style path, in page order."""
    stack = [(c, "") for c in reversed(root.children) if isinstance(c, Node)]
    while stack:
        node, above = stack.pop()
        path = f"{above}/{node.signature()}"
        yield node, path
        stack += [(c, path) for c in reversed(node.children) if isinstance(c, Node)]


def _wrappers(root: Node) -> set[int]:
    """Elements around the page's article or first heading; their class words speak of the page's layout."""
    found: set[int] = set()
    for node, _ in elements(root):
        if node.tag in ("article", "main", "h1") and not node.is_comment():
            above = node.parent
            while above is not None and id(above) not in found:
                found.add(id(above))
                above = above.parent
    return found


def _within(node: Node, tags: frozenset[str] | set[str]) -> bool:
    above = node.parent
    while above is not None:
        if above.tag in tags:
            return True
        above = above.parent
    return False


def says_noise(node: Node, wrapper: bool) -> bool:
    """True if the element's name, role, class or style tells that it is not part of an article."""
    if node.tag in HIDDEN or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true" or _NONE.search(node.attrs.get("style", "")):
        return True
    words = node.words()
    if node.tag in ("article", "main", "body", "html"):
        return node.is_comment()
    if wrapper:
        return node.tag in CUT_TAGS - {"form"} and not node.tag == "aside"
    if node.tag in HEADINGS:
        return False
    if node.tag == "header":
        return not _within(node, {"article"})
    return node.tag in CUT_TAGS or node.attrs.get("role", "").lower() in CUT_ROLES or bool(words & CUT_WORDS)


def prune(root: Node, low: set[int] | frozenset[int] = frozenset()) -> None:
    """Cut branches that say they are noise, and those whose style path is in `low`."""
    around = _wrappers(root)
    stack = [(root, "")]
    while stack:
        node, above = stack.pop()
        kept: list[Node | str] = []
        for child in node.children:
            if isinstance(child, Node):
                path = f"{above}/{child.signature()}"
                if says_noise(child, id(child) in around) or (low and _hash(path) in low):
                    # What stood on either side stays apart, as it was on the page.
                    kept.append(Node("hr" if child.tag in BLOCK else "br", {}, node))
                    continue
                stack.append((child, path))
            kept.append(child)
        node.children = kept


def blocks(root: Node) -> list[str]:
    """Texts of the blocks below `root`, with single spaces, in page order."""
    out: list[str] = []
    words: list[str] = []

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = [root]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            words.append(item)
        elif item.tag in BLOCK:
            flush()
            stack.append(None)
            stack += reversed(item.children)
        else:
            # A line break and a table cell separate words.
            gap = [" "] if item.tag in ("br", "td", "th") else []
            stack += gap
            stack += reversed(item.children)
            stack += gap
    flush()
    return out


def main_text(html: str | None, low: set[int] | frozenset[int] = frozenset()) -> str:
    root = parse(html)
    prune(root, low)
    return "\n\n".join(blocks(root))


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def style_nodes(html: str | None) -> tuple[int, dict[int, tuple[int, int]]]:
    """Hash of the page's remaining text; by style path, hashes of its content and of its children's signatures."""
    root = parse(html)
    prune(root)
    contents: dict[str, list[str]] = {}
    children: dict[str, list[str]] = {}
    for node, path in elements(root):
        if node.tag in BLOCK and node.tag not in ("html", "body"):
            contents.setdefault(path, []).extend(blocks(node))
            children.setdefault(path, []).append(",".join(c.signature() for c in node.children if isinstance(c, Node)))
    nodes = {_hash(p): (_hash("\n".join(t)), _hash("|".join(children[p]))) for p, t in contents.items() if t}
    return _hash("\n".join(blocks(root))), nodes


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for page, html_hash, host, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "html_hash", "host", "html")), strict=True):
            text, nodes = style_nodes(html)
            rows += [(page, html_hash, host, text, path, content, shape) for path, (content, shape) in nodes.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
        names = ["page_id", "html_hash", "host", "text", "path", "content", "shape"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h, frozenset(low or ())) for h, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True)]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; "" if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def importance(nodes: DataFrame) -> DataFrame:
    """host, path, pages, importance of every style node, over pages that differ.

    Entropy of the contents and of the shapes, each divided by the logarithm of the number of pages, weighed together.
    """
    seen = nodes.select("host", "text", "path", "content", "shape").distinct()
    values = seen.select("host", "path", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("content", "shape")])))
    counted = values.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n"))

    def spread(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n") * F.log("n")).otherwise(0.0)).alias(f"{kind}_sum")

    pages = F.sum(F.when(F.col("kind") == "content", F.col("n")).otherwise(0)).alias("pages")
    sums = counted.groupBy("host", "path").agg(pages, spread("content"), spread("shape"))

    def entropy(kind: str) -> Column:
        return F.when(F.col("pages") > 1, 1 - F.col(f"{kind}_sum") / (F.col("pages") * F.log("pages"))).otherwise(1.0)

    weighed = CONTENT_WEIGHT * entropy("content") + (1 - CONTENT_WEIGHT) * entropy("shape")
    return sums.select("host", "path", "pages", weighed.alias("importance"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """page_id, url, text, n_chars of every page, in one row each.

    Style nodes of fewer than `min_pages` different pages, and pages without a host, are not judged by entropy. Null or empty
    html, or html without a text that survives, gives "". Rows without `page_id` and repeated rows each get their row. Broken
    markup is read as browsers would in the main; text is never cut short. Other columns are ignored; an empty table gives no
    rows.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", F.xxhash64("url", "html").alias("html_hash"))
    sited = rows.withColumn("host", host_of(F.col("url"))).filter("host <> ''").select("page_id", "html_hash", "host", "html")
    schema = "page_id long, html_hash long, host string, text long, path long, content long, shape long"
    nodes = settle(in_arrow(sited, _nodes, schema))
    dull = settle(importance(nodes).filter((F.col("pages") >= min_pages) & (F.col("importance") < min_importance)).select("host", "path"))
    lost = nodes.join(dull, ["host", "path"]).groupBy("page_id", "html_hash").agg(F.collect_set("path").alias("low"))
    lost = lost.select(F.col("page_id").alias("_id"), F.col("html_hash").alias("_hash"), "low")
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("html_hash") == F.col("_hash"))
    return in_arrow(rows.join(lost, same, "left").select("page_id", "url", "html", "low"), _texts, "page_id long, url string, text string, n_chars long")
