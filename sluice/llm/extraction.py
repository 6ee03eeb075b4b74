"""Main text of web pages by removing what a site repeats on its pages."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices, text_of
from sluice.session import stage

#: a subtree is part of the site's template if this many different pages of a host have it,
#: and at least this share of them
MIN_PAGES, MIN_SHARE = 5, 0.05
#: on pages without a main part, the share for subtrees with words outside links
TEXT_SHARE = 0.5
WORD = re.compile(r"[^\W\d_]{2,}")
#: fixed values: elements without an end tag, without text, that begin a block of text
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math canvas iframe object audio video select option datalist textarea button".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
#: elements that are never the text of an article
CHROME = frozenset("nav footer aside form menu dialog header".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: words in the class or id of such parts
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe "
    "subscription signup login share sharing social related recommended comments comment respond replies pagination pager "
    "widget toolbar skip legal copyright disclaimer".split()
)
#: elements whose start ends an open paragraph, and those whose start ends an open one of their kind
CLOSES_P = BLOCKS - frozenset("li dd dt td th tr tbody thead tfoot caption body html summary legend".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: what keeps an end of one kind from reaching further out
FENCES = {"li": frozenset("ul ol menu dir".split()), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"]), "option": frozenset(["select"])}
#: inside main parts, the elements that may be template although they have words: whole blocks, no headings or cells
WHOLE = BLOCKS - frozenset("h1 h2 h3 h4 h5 h6 hgroup li dd dt td th tr tbody thead tfoot caption figcaption legend article main body".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "mark", "words", "hidden")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []
        self.mark = b""
        self.words = 0
        #: what the attributes say, once it has been asked for
        self.hidden: bool | None = None


class Tree(HTMLParser):
    """A tree of elements and texts; tags left open are closed as browsers do."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.path = [self.root]

    def updatepos(self, i: int, j: int) -> int:
        # nobody asks for line numbers
        return j

    def _close(self, at: int) -> None:
        del self.path[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            for i in range(len(self.path) - 1, 0, -1):
                if self.path[i].tag == "p":
                    self._close(i)
                    break
                if self.path[i].tag in BLOCKS:
                    break
        if tag in SAME:
            for i in range(len(self.path) - 1, 0, -1):
                if self.path[i].tag in SAME[tag]:
                    self._close(i)
                    if tag != "tr":
                        break
                elif self.path[i].tag in FENCES[tag]:
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.path[-1].children.append(node)
        if tag not in VOID:
            self.path.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.path[-1].tag == tag and tag in ("svg", "path"):
            self.path.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.path) - 1, 0, -1):
            if self.path[i].tag == tag:
                self._close(i)
                return

    def handle_data(self, data: str) -> None:
        self.path[-1].children.append(data)


def tree(html: str) -> Node:
    parser = Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def _order(root: Node) -> list[Node]:
    """All elements, parents before their children; no recursion, as pages may nest deeply."""
    found = [root]
    for node in found:
        found += [c for c in node.children if isinstance(c, Node)]
    return found


def set_marks(root: Node) -> None:
    """A hash of each subtree: its tag, the texts and the marks of its children in order."""
    for node in reversed(_order(root)):
        content = [node.tag.encode()]
        for child in node.children:
            if isinstance(child, Node):
                content.append(b"<" + child.mark)
            elif text := " ".join(child.split()):
                content.append(b">" + text.encode("utf-8", "surrogatepass") + b"\0")
        node.mark = hashlib.blake2b(b"".join(content), digest_size=8).digest()


def _named(node: Node) -> bool:
    words = re.split(r"[^a-z0-9]+", f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower())
    return not NAMES.isdisjoint(words)


def unwanted(node: Node, in_main: bool) -> bool:
    """Whether an element is no part of an article by its kind, role or name."""
    if node.tag in SILENT:
        return True
    if node.tag in CHROME:
        # the heading of an article may stand in a header of its own
        return not (node.tag == "header" and in_main)
    if node.hidden is None:
        node.hidden = bool(node.attrs) and _hidden(node)
    return node.hidden


def _hidden(node: Node) -> bool:
    """Whether the role, the style or a name keep an element out of an article."""
    if node.attrs.get("role", "").lower() in ROLES or "hidden" in node.attrs or node.attrs.get("aria-hidden", "") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", node.attrs.get("style", ""), re.I):
        return True
    return node.tag not in ("html", "body", "main", "article") and node.tag not in TEXT and _named(node)


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or ("role" in node.attrs and node.attrs["role"].lower() in ("main", "article"))


def main_parts(root: Node) -> list[Node]:
    """The outermost article elements that are not in an unwanted one, else main elements, else the page."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if unwanted(node, inside):
            continue
        kind = "article" if node.tag == "article" or node.attrs.get("role", "").lower() == "article" else "main" if _is_main(node) else None
        if kind:
            found[kind].append(node)
        if kind != "article":
            todo.extend((c, inside or kind is not None) for c in reversed(node.children) if isinstance(c, Node))
    return found["article"] or found["main"] or [root]


def set_words(root: Node) -> None:
    """The number of words below each element that stand outside links and silent elements."""
    for node in reversed(_order(root)):
        node.words = 0
        if node.tag != "a" and node.tag not in SILENT:
            node.words = sum([c.words if isinstance(c, Node) else len(WORD.findall(c)) for c in node.children])


def set_compared(root: Node, template: frozenset[bytes]) -> None:
    """Marks and words of the elements that ``main_text`` compares with the template; others have no mark, or their own.

    Inside a main part these are containers without words outside links, and
    blocks if the template has any.  A page without main parts is compared whole.
    """
    parts = main_parts(root)
    if parts[0] is root or any(len(mark) > 8 for mark in template):
        set_marks(root)
        set_words(root)
        return
    for part in parts:
        containers = [n for n in _order(part)[1:] if n.tag in BLOCKS and n.tag not in TEXT]
        if containers:
            set_words(part)
            if not all(n.words for n in containers):
                set_marks(part)


def _kept(node: Node) -> bool:
    """Whether an element inside a main part is its text: text blocks, inline elements, containers with words outside links."""
    return node.tag in TEXT or node.tag not in BLOCKS or node.words > 0


def candidates(root: Node) -> dict[bytes, bool]:
    """Marks of the subtrees that a template may consist of; true if it takes TEXT_SHARE of the pages.

    Inside the main parts of a page only containers without words of their
    own, as lists of links, are candidates: pages may quote one passage, and
    copies of a page share all their text.  A page without main parts gives
    no such sign; there a subtree with words has to recur on a large share of
    the pages, and one with half of the page's words or more is no candidate.
    """
    parts = main_parts(root)
    inside = {id(n) for part in parts if part is not root for n in _order(part)}
    found: dict[bytes, bool] = {}
    for node in _order(root)[1:]:
        if node.tag in ("html", "body", "head") or node.tag in SILENT or _is_main(node):
            continue
        if id(node) in inside and _kept(node) and not unwanted(node, True):
            continue
        much = parts[0] is root and node.words > 0 and not unwanted(node, False)
        if much and 2 * node.words >= root.words:
            continue
        found[node.mark] = found.get(node.mark, False) or much
    return found


#: stands before the mark of a block with words inside a main part; alone, the pages themselves
INNER = b"\x01"


def text_blocks(root: Node, n_words: int) -> list[Node]:
    """Blocks with words inside the main parts, outer before inner ones, each of under half of the page's words.

    A page without main parts has none.
    """
    found: list[Node] = []
    todo = [c for part in main_parts(root) if part is not root for c in part.children]
    for node in todo:
        if isinstance(node, str) or unwanted(node, True):
            continue
        if node.tag in WHOLE and 0 < 2 * node.words < n_words:
            found.append(node)
        todo.extend(node.children)
    return found


def recurring_blocks(root: Node, template: frozenset[bytes]) -> set[int]:
    """The blocks (by identity) that are the site's; none if they are half of the page's words or more.

    Copies of one page with small changes share most of their text, so
    what they share is theirs and stays.
    """
    if not any(len(mark) > 8 for mark in template):
        return set()
    n_words = len(WORD.findall(main_text(root, frozenset())))
    found, inside, words = set(), set(), 0
    for node in text_blocks(root, n_words):
        if id(node) not in inside and INNER + node.mark in template:
            found.add(id(node))
            inside.update(map(id, _order(node)))
            words += node.words
    return found if 2 * words < n_words else set()


def page_sketch(words: list[str]) -> bytes:
    """The least hash of three words in a row: nearly always the same for copies with small changes."""
    whole = " ".join(words).encode()
    found = whole.split(b" ")
    runs = map(b" ".join, zip(found, found[1:], found[2:])) if len(found) > 2 else [whole]
    return min(map(zlib.crc32, runs)).to_bytes(4, "big")


def main_text(root: Node, template: frozenset[bytes]) -> str:
    """Blocks of the main parts, without unwanted and template subtrees."""
    recurring = recurring_blocks(root, template)
    blocks: list[str] = []
    held: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(held).split())
        if text:
            blocks.append(text)
        held.clear()

    for part in main_parts(root):
        todo: list = [part]
        while todo:
            item = todo.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                held.append(item)
            else:
                if item is not part and (unwanted(item, True) or id(item) in recurring or (item.mark in template and not _is_main(item) and (part is root or not _kept(item)))):
                    held.append(" ")
                    continue
                if item.tag == "br":
                    held.append(" ")
                if item.tag in BLOCKS:
                    end_block()
                    todo.append(None)
                todo.extend(reversed(item.children))
        end_block()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; an address without one has the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, mark): subtrees that recur on many different pages of a host.

    Pages are told apart by the hash of their whole tree, so copies of one
    page do not make its parts a template.  A subtree counts once a page;
    counts are summed per task before they meet.

    Blocks with words inside main parts (mark after INNER) are judged more
    strictly, as pages quote each other: there a sketch tells pages apart, so
    copies with small changes count once; a block has to be on TEXT_SHARE of
    the host's pages, and so on at least half of the hosts that have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            hosts, marks, whole, much = [], [], [], []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                root = tree(html)
                set_marks(root)
                set_words(root)
                found = candidates(root)
                # the page itself counts under an empty mark
                page = hashlib.blake2b(b"".join(n.mark for n in main_parts(root)), digest_size=8).digest()
                for mark in (b"", *found):
                    much.append(found.get(mark, False))
                    hosts.append(host)
                    marks.append(mark)
                    whole.append(page)
                words = WORD.findall(main_text(root, frozenset()).lower())
                sketch = page_sketch(words)
                for mark in {INNER, *(INNER + n.mark for n in text_blocks(root, len(words)))}:
                    much.append(False)
                    hosts.append(host)
                    marks.append(mark)
                    whole.append(sketch)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(marks, pa.binary()), pa.array(whole, pa.binary()), pa.array(much, pa.bool_())], ["host", "mark", "page", "much"])

    slim = pages.select(host_of(F.col("url")).alias("host"), text_of("html").alias("html"))
    seen = slim.mapInArrow(run, "host string, mark binary, page binary, much boolean")
    # one row for each different page of a host and subtree
    seen = seen.groupBy("host", "mark", "page").agg(F.max("much").alias("much"))
    counted = seen.groupBy("host", "mark").agg(F.count("*").alias("n"), F.max("much").alias("much"))
    counted = stage(counted.where(f"n >= {min_pages} OR length(mark) = 9"), "subtrees")
    pages_of = counted.where("length(mark) = 0").select("host", F.col("n").alias("pages"))
    share = F.when(F.col("much"), max(min_share, TEXT_SHARE)).otherwise(min_share)
    outer = counted.where("length(mark) = 8").join(pages_of, "host").where(F.col("n") >= share * F.col("pages"))
    return outer.select("host", "mark").unionByName(_inner_templates(counted, min_pages))


def _inner_templates(counted: DataFrame, min_pages: int) -> DataFrame:
    """(host, mark) of blocks inside main parts; a hot mark is one row for each host that has it."""
    blocks = counted.where("length(mark) = 9").select("host", "mark", "n")
    pages_of = counted.where("length(mark) = 1").select("host", F.col("n").alias("pages"))
    often = blocks.where(f"n >= {min_pages}").join(pages_of, "host").where(F.col("n") >= TEXT_SHARE * F.col("pages"))
    often = stage(often.select("host", "mark"), "text-blocks")
    at_all = blocks.join(often.select("mark").distinct(), "mark", "left_semi").groupBy("mark").agg(F.count("*").alias("hosts"))
    own = often.groupBy("mark").agg(F.count("*").alias("often")).join(at_all, "mark").where("2 * often >= hosts")
    return often.join(own.select("mark"), "mark").select("host", "mark")


def extracted(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text of every row.

    The text is empty for null and empty pages and for those without an
    article.  A block inside main parts that is the site's goes, unless such
    blocks hold half of the page's words.  Rows of one page_id are extracted one by one.
    """
    found = stage(templates(pages, min_pages, min_share), "templates")
    # a host's template: no more subtrees than min_share allows on its pages
    lists = found.groupBy("host").agg(F.collect_set("mark").alias("template"))
    lists = stage(lists.withColumnRenamed("host", "_host"), "template-lists")
    slim = pages.select("page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html"), host_of(F.col("url")).alias("host"))
    joined = slim.join(lists, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = []
            for html, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist()):
                root = tree(html)
                marks = frozenset(template or ())
                if marks:
                    set_compared(root, marks)
                texts.append(main_text(root, marks))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    return joined.mapInArrow(run, schema)
