"""The main text of web pages: what varies between the pages of a host, in the container or articles that hold it."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import quoted, slices, whole, with_columns
from minelark.plans.lineage import settle

MIN_PAGES = 4
CONSTANT_SHARE = 0.8
MAIN_SHARE = 0.7
MAX_DEPTH = 256  # what is nested deeper becomes neighbours, as in browsers

# fixed values: elements of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li listing main menu nav ol p pre section summary table caption tbody thead tfoot tr td th ul".split()
)
TEXT_BLOCK = set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption".split())
CONTAINER = BLOCK - TEXT_BLOCK
DROPPED = set(
    "head nav footer aside form script style title noscript template iframe object svg canvas button select input textarea menu dialog "
    "embed audio video map noembed noframes xmp".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# fixed values: words in class names and ids that mark what is not the article
REMARK_WORDS = set("comment comments disqus respond replies ad ads advert adverts advertisement advertisements sponsor sponsored".split())
DROPPED_WORDS = set(
    "promo banner cookie cookies consent gdpr notice notices newsletter subscribe signup sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs footer masthead related recommended recommendations share sharing social toolbar popup modal login search widget "
    "pagination pager header topbar".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_NAME_PARTS = re.compile(r"[A-Za-z]+")


class Node:
    """An element: its tag, the words of its class and id, its children (elements and strings)."""

    __slots__ = ("tag", "names", "hidden", "role", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children = tag, []
        self.names, self.hidden, self.role = frozenset(), False, ""
        if attributes and "=" in attributes or "hidden" in attributes:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            words = _NAME_PARTS.findall(f"{found.get('class', '')} {found.get('id', '')}")
            self.names, self.role = frozenset(w.lower() for w in words), found.get("role", "").strip().lower()
            style = found.get("style", "").replace(" ", "").lower()
            self.hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    @property
    def key(self) -> str:
        return f"{self.tag}.{'.'.join(sorted(self.names))}"


def parse(html: str) -> Node:
    """The tree of a page. Comments, declarations and unclosed or stray tags are borne; the time is that of one scan."""
    root = Node("html")
    stack, at, size = [root], 0, len(html)
    lowered, beyond = None, 0
    while at < size:
        start = html.find("<", at)
        if start < 0:
            stack[-1].children.append(unescape(html[at:]))
            break
        if start > at:
            stack[-1].children.append(unescape(html[at:start]))
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(html, start) or _LOOSE_TAG.match(html, start)
        if not m:
            stack[-1].children.append("<")
            at = start + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if beyond:
                beyond -= 1
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in ("html", "body"):
            if tag == "html" or any(n.tag == "body" for n in stack):
                continue
        elif tag in BLOCK:
            close(stack, {"p"}, {"button", "td", "th", "table", "caption"})
        if tag in CLOSED_BY:
            close(stack, CLOSED_BY[tag], SCOPE[tag])
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in RAW:
            if lowered is None:
                lowered = html.lower() if len(html.lower()) == size else re.sub("[A-Z]", lambda x: x[0].lower(), html)
            end = lowered.find(f"</{tag}", at)
            at = size if end < 0 else end
        elif tag not in VOID and not m[3].endswith("/"):
            if len(stack) < MAX_DEPTH:
                stack.append(node)
            else:
                beyond += 1
    return root


def close(stack: list[Node], tags: set[str], scope: set[str]) -> None:
    """Close the innermost open element of these tags, unless one of ``scope`` stands in between."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in scope:
            return


def sizes(node: Node, out: dict[int, tuple[int, bool]]) -> tuple[int, bool]:
    """Per element, by identity, the characters of its text and whether it holds an article."""
    n, article = 0, node.tag in ("article", "main")
    for child in node.children:
        if isinstance(child, Node):
            if child.tag not in DROPPED:
                more, inside = sizes(child, out)
                n, article = n + more, article or inside
        else:
            n += len(child)
    out[id(node)] = n, article
    return n, article


def boilerplate(node: Node, in_main: bool, held: dict[int, tuple[int, bool]], total: int) -> bool:
    """Whether an element is, by its tag, role or names, no part of an article."""
    if node.tag in DROPPED or node.hidden or node.role in DROPPED_ROLES:
        return True
    n, article = held.get(id(node), (0, False))
    large = 2 * n > total
    if node.tag in ("body", "main", "article"):
        return node.tag == "article" and not large and bool(node.names & REMARK_WORDS)
    if article:
        return False
    if node.names & REMARK_WORDS:
        return True
    if large:
        return False
    if node.tag == "header":
        return not in_main
    named = node.names & DROPPED_WORDS
    return bool(named - {"header"} if in_main else named)


class Page:
    """A parsed page without its boilerplate, and its blocks of text by element."""

    def __init__(self, html: str):
        self.root = parse(html)
        self.held: dict[int, tuple[int, bool]] = {}
        self.total = sizes(self.root, self.held)[0]

    def kept(self, node: Node, in_main: bool) -> list[Node]:
        return [c for c in node.elements() if not boilerplate(c, in_main, self.held, self.total)]

    def blocks(self, node: Node, in_main: bool = True) -> list[tuple[Node, str]]:
        """The blocks below an element in page order: text up to the next block's bounds, with the element it stands in."""
        out: list[tuple[Node, str]] = []
        open_: list[str] = []

        def flush(owner: Node) -> None:
            text = " ".join("".join(open_).split())
            if text:
                out.append((owner, text))
            open_.clear()

        def walk(node: Node, owner: Node, in_main: bool) -> None:
            in_main = in_main or node.tag in ("article", "main")
            for child in node.children:
                if not isinstance(child, Node):
                    open_.append(child)
                elif child.tag == "br":
                    open_.append(" ")
                elif boilerplate(child, in_main, self.held, self.total):
                    if child.tag in BLOCK:
                        flush(owner)
                elif child.tag in BLOCK:
                    flush(owner)
                    walk(child, child, in_main)
                    flush(child)
                else:
                    walk(child, owner, in_main)

        walk(node, node, in_main)
        flush(node)
        return out


def block_print(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def page_prints(html: str) -> list[int]:
    """The prints of the different blocks of a page, as they read in its main text and outside."""
    page = Page(html)
    return list({block_print(text) for in_main in (False, True) for _, text in page.blocks(page.root, in_main)})


def is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or node.role == "main"


class Wrapper:
    """What is known of a host: the prints of its template blocks, as a string of numbers."""

    def __init__(self, data: str | None):
        self.template = frozenset(int(n) for n in (data or "").split())

    def main(self, page: Page) -> list[Node]:
        """The innermost container with all of the varying text.

        If it has articles as children, or the articles below it hold ``MAIN_SHARE`` of its varying text, they are the
        main text, all of them; an article is not looked into.
        """
        own: defaultdict[int, int] = defaultdict(int)
        for owner, text in page.blocks(page.root, False):
            own[id(owner)] += len(text) * (block_print(text) not in self.template)
        varying: dict[int, int] = {}

        def add(node: Node, in_main: bool) -> int:
            in_main = in_main or node.tag in ("article", "main")
            varying[id(node)] = own[id(node)] + sum(add(c, in_main) for c in page.kept(node, in_main))
            return varying[id(node)]

        add(page.root, False)
        node = page.root
        while varying[id(node)]:
            below = page.kept(node, False)
            direct = any(is_article(c) and varying[id(c)] for c in below)
            inner = [c for c in below if c.tag in CONTAINER and varying[id(c)] == varying[id(node)]]
            if direct or not inner:
                articles = outermost(page, node)
                if direct or sum(varying[id(c)] for c in articles) >= MAIN_SHARE * varying[id(node)]:
                    return articles
                break
            node = inner[0]
        return [node]

    def text(self, html: str) -> str:
        """The main text of a page: the varying blocks of its main container or articles."""
        page = Page(html)
        main = self.main(page)
        in_main = main[0].tag not in ("html", "body")
        texts = [text for node in main for _, text in page.blocks(node, in_main)]
        return "\n\n".join(text for text in texts if block_print(text) not in self.template)


def outermost(page: Page, node: Node) -> list[Node]:
    """The outermost articles outside boilerplate."""
    out: list[Node] = []
    for child in page.kept(node, False):
        out += [child] if is_article(child) else outermost(page, child)
    return out


def host(url: Column) -> Column:
    """The host of a URL in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def prints_of(html: Column) -> Column:
    @arrow_udf("array<bigint>")
    def prints(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([page_prints(page) for some in slices(column) for page in some], pa.list_(pa.int64()))

    return prints(html)


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` of the hosts that have template: blocks that at least ``CONSTANT_SHARE`` of their pages hold.

    All different pages of a host count, and from ``MIN_PAGES`` pages with a block on it may be template. Pages are told
    apart by digest; blocks are counted by partial sums, so a host with a third of all pages costs no more than others.
    A block without a print stands for its page.
    """
    rows = pages.select("host", F.xxhash64("html").alias("page"), prints_of(F.col("html")).alias("prints"))
    rows = rows.groupBy("host", "page").agg(F.first("prints").alias("prints"))
    each = rows.select("host", F.explode(F.array_append("prints", F.lit(None).cast("long"))).alias("print"))
    counts = settle(each.groupBy("host", "print").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_PAGES))
    totals = counts.where(F.col("print").isNull()).select("host", F.col("n").alias("total"))
    frequent = counts.where(F.col("print").isNotNull()).join(totals, "host").where(F.col("n") >= CONSTANT_SHARE * F.col("total"))
    template = F.sort_array(F.collect_list("print"))
    return frequent.groupBy("host").agg(F.concat_ws(" ", F.transform(template, lambda n: n.cast("string"))).alias("wrapper"))


def texts_of(html: Column, wrapper: Column) -> Column:
    @arrow_udf("string")
    def extract(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known: dict[str | None, Wrapper] = {}
        for column, wrapped in columns:
            names, out = iter(wrapped.to_pylist()), []
            for some in slices(column):
                for page in some:
                    data = next(names)
                    if data not in known:
                        if len(known) >= 256:
                            known.clear()
                        known[data] = Wrapper(data)
                    out.append(known[data].text(page))
            yield pa.array(out, pa.string())

    return extract(html, wrapper)


def extract_text(pages: DataFrame) -> DataFrame:
    """Add ``text``, the main text of each page, and ``n_chars``, its code points, to the columns of ``pages`` but ``html``.

    Blocks have white space turned into single spaces and are joined by two line feeds. Null or empty html: empty text.
    Null ``url``, or one without a host: such pages share a wrapper. Repeated rows each get their text. Columns of the
    added names give way; names starting with ``_hx_`` are reserved.

    Pages are read twice: for the counts of their blocks, and for the texts. The template of each host is stored; its join
    to the pages broadcasts it if the stored table is small.
    """
    others = [c for c in pages.columns if c.lower() not in ("html", "text", "n_chars")]
    pages = pages.select(*quoted(others), whole(F.col("html")).alias("_hx_html"), host(F.col("url")).alias("_hx_host"))
    known = settle(wrappers(pages.select(F.col("_hx_host").alias("host"), F.col("_hx_html").alias("html"))))
    known = known.withColumnsRenamed({"host": "_hx_key", "wrapper": "_hx_wrapper"})
    met = pages.join(known, F.col("_hx_host") == F.col("_hx_key"), "left")
    done = with_columns(met, {"text": texts_of(F.col("_hx_html"), F.col("_hx_wrapper"))})
    done = done.drop(*[c for c in done.columns if c.startswith("_hx_")])
    return with_columns(done, {"n_chars": F.char_length("text").cast("long")})
