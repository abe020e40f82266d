"""Main text of web pages, with the site's template removed.

The subtree of every element is hashed by its tags and text. Hashes are counted
per host in Spark; subtrees that recur on several pages of their host are the
site's template and are deleted. What a page marks as its article is its text
whole, whatever recurs in it: sentences and copies of articles recur as well.
What elements say themselves not to be text of the article goes too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import durable

# Elements without content, and elements whose content is no markup (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
# Elements that begin a block of text of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
# Start tags that end an open p.
ENDS_P = BLOCKS - frozenset("body caption dd dt head html li tbody td tfoot th thead tr".split())
# Start tags that end an open element of the same kind, up to its list or table.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
MAIN = frozenset(("article", "main"))
# Elements, roles and words of class and id that are not the article's text.
NOT_TEXT = RAW | frozenset("head nav header footer aside form button select template svg canvas object audio video dialog menu".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
NOT_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb"
    " breadcrumbs header masthead footer sidebar aside cookie cookies consent notice gdpr popup modal overlay"
    " comment comments disqus share sharing social newsletter subscribe subscription signup related recommended"
    " widget toolbar pagination pager skip".split()
)
# First words of class names that tell of the layout around an element and not of itself, as in no-sidebar.
MODIFIERS = frozenset("no not without with has have hide hides show shows is".split())
# What of NOT_WORDS and NOT_TEXT an article may use for its own head.
IN_ARTICLE = frozenset(("header", "banner", "masthead"))

# Digests of pages to be cleaned up to which they are broadcast (some 20 MB); beyond, the pages are shuffled to them.
BROADCAST_DIGESTS = 1_000_000

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_WORD = re.compile(r"[a-z]+")


def _words(value: str) -> set[str]:
    """Words of a class or id, without the names that begin with a modifier."""
    names = (_WORD.findall(x) for x in value.split())
    return {w for name in names if not (len(name) > 1 and name[0] in MODIFIERS) for w in name}


@dataclass
class Node:
    tag: str
    attributes: str = ""
    parts: list = field(default_factory=list)  # nodes and texts
    digest: int = 0
    has_main: bool = False  # is a main element that counts or has one in it; nothing deletes it


def parse(source: str) -> Node:
    """The element tree of a page. Unknown, stray and missing end tags are as harmless as in a browser."""
    root = Node("#root")
    stack = [root]
    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if found is None:
            stack[-1].parts.append(source[at:])
            break
        if found.start() > at:
            stack[-1].parts.append(source[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            _close(stack, tag)
            continue
        if tag in ENDS_P:
            _close(stack, "p", ("table", "td", "th", "button", "#root"))
        if tag in SIBLINGS:
            for other in SIBLINGS[tag][0]:
                _close(stack, other, SIBLINGS[tag][1])
        node = Node(tag, found[3])
        stack[-1].parts.append(node)
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            node.parts.append(source[at : close.start() if close else end])
            at = close.end() if close else end
            continue
        stack.append(node)
    return root


def _close(stack: list[Node], tag: str, within: tuple[str, ...] = ()) -> None:
    """Close the innermost open ``tag`` and all in it; not beyond an element of ``within``."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in within:
            return


def walk(root: Node) -> Iterator[tuple[Node, bool, bool]]:
    """(node, whether it is entered or left, whether it lies in a main element), without recursion."""
    stack = [(root, True, False)]
    while stack:
        node, enters, inside = stack.pop()
        yield node, enters, inside
        if enters:
            stack.append((node, False, inside))
            own = inside or node.tag in MAIN
            stack += [(x, True, own) for x in reversed(node.parts) if isinstance(x, Node)]


def hash_subtrees(root: Node) -> None:
    """A digest per element of its tag, the digests of its children and its text, white space aside."""
    for node, enters, _ in walk(root):
        if not enters:
            own = xxhash.xxh64(node.tag)
            for part in node.parts:
                own.update(part.digest.to_bytes(8, "little") if isinstance(part, Node) else " ".join(part.split()))
            node.digest = own.intdigest()


def says_no(node: Node, inside: bool) -> bool:
    """Whether an element is not article text by its name, role, class or id."""
    return _surely_no(node, inside) or _maybe_no(node, inside)


def _surely_no(node: Node, inside: bool) -> bool:
    """By name, role or for being hidden: main elements in it are not the page's."""
    if node.tag in NOT_TEXT and node.tag != "form" and not (inside and node.tag in IN_ARTICLE):
        return True
    if not node.attributes or node.tag in ("html", "body", *MAIN):
        return False
    for m in _ATTRIBUTE.finditer(node.attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and (set(_WORD.findall(value)) - (IN_ARTICLE if inside else frozenset()) - {"form"}) & NOT_ROLES:
            return True
    return False


def _maybe_no(node: Node, inside: bool) -> bool:
    """By class or id, or as a form: it may as well be laid around the whole page."""
    if node.tag == "form":
        return True
    if not node.attributes or node.tag in ("html", "body", *MAIN):
        return False
    for m in _ATTRIBUTE.finditer(node.attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        words = _words(value) - (IN_ARTICLE if inside else frozenset())
        if words & (NOT_WORDS if name in ("class", "id") else frozenset(("form",)) if name == "role" else frozenset()):
            return True
    return False


def find_main(root: Node) -> None:
    """Set ``has_main``: by main elements that no element around them says no to.

    One in an element that may be no text by its class, or in a form, counts
    if it alone has more text than all that is left without it.
    """
    doubtful: list[list[Node]] = []
    # (node, whether entered, inside a main element, doubt)
    stack: list[tuple[Node, bool, bool, bool]] = [(root, True, False, False)]
    path: list[Node] = []
    while stack:
        node, enters, inside, doubt = stack.pop()
        if not enters:
            path.pop()
            continue
        if _surely_no(node, inside):
            continue
        path.append(node)
        doubt = doubt or _maybe_no(node, inside)
        if node.tag in MAIN:
            if not doubt:
                for x in path:
                    x.has_main = True
            else:
                doubtful.append(list(path))
                stack.append((node, False, inside, doubt))
                continue
        own = inside or node.tag in MAIN
        stack.append((node, False, inside, doubt))
        stack += [(x, True, own, doubt) for x in reversed(node.parts) if isinstance(x, Node)]
    if doubtful:
        sizes = [len(_text(x[-1], set(), True, False)) for x in doubtful]
        best = max(range(len(sizes)), key=sizes.__getitem__)
        if sizes[best] > len(_text(root, set(), False, root.has_main)):
            for x in doubtful[best]:
                x.has_main = True


def candidates(root: Node) -> set[int]:
    """Digests of the subtrees with text that may be template: all outside main elements that hold none.

    Sets ``has_main`` of the root.
    """
    hash_subtrees(root)
    find_main(root)
    found: set[int] = set()
    filled: dict[int, bool] = {}
    for node, enters, _ in walk(root):
        if not enters:
            own = any(filled[id(x)] if isinstance(x, Node) else x.strip() for x in node.parts)
            filled[id(node)] = bool(own) and node.tag not in RAW
    stack = [root]
    while stack:
        node = stack.pop()
        if not filled[id(node)] or node.tag in MAIN and node.has_main:
            continue
        if not node.has_main and node.tag not in ("#root", "html", "body"):
            found.add(node.digest)
        stack += [x for x in node.parts if isinstance(x, Node)]
    return found


def extract(root: Node, template: set[int]) -> str:
    """Text blocks of the page in order, one per line, without template and other elements that are no text.

    Of a page with main elements only those count, and all of them.
    ``template`` has digests, so the tree is hashed where it is not empty.
    """
    if template:
        hash_subtrees(root)
    find_main(root)
    return _text(root, template, False, root.has_main)


def _text(root: Node, template: set[int], within: bool, has_main: bool) -> str:
    blocks: list[list[str]] = [[]]
    # (node or text or block end, inside a main element)
    stack: list = [(root, within)]
    while stack:
        part, inside = stack.pop()
        if part is None:
            blocks.append([])
        elif isinstance(part, str):
            if inside or not has_main:
                blocks[-1].append(part)
        elif part.tag == "br":
            blocks[-1].append(" ")
        elif not part.has_main and (says_no(part, inside) or not inside and part.digest in template):
            continue
        else:
            own = inside or part.tag in MAIN and (part.has_main or not has_main)
            if part.tag in BLOCKS:
                blocks.append([])
                stack.append((None, own))
            stack += [(x, own) for x in reversed(part.parts)]
    texts = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def subtree_hashes(source: Column) -> Column:
    """What ``candidates`` finds of a page, and whether it has main elements."""

    @F.arrow_udf("digests array<long>, has_main boolean")
    def of_pages(pages: pa.Array) -> pa.Array:
        digests, mains = [], []
        for page in pages:
            root = parse(page.as_py() or "")
            digests.append([_signed(h) for h in candidates(root)])
            mains.append(root.has_main)
        return pa.StructArray.from_arrays(
            [pa.array(digests, pa.list_(pa.int64())), pa.array(mains, pa.bool_())], ["digests", "has_main"]
        )

    return of_pages(source)


def main_text(source: Column, template: Column) -> Column:
    """Text of a page without the subtrees whose digests ``template`` has."""

    @F.arrow_udf("string")
    def of_pages(pages: pa.Array, templates: pa.Array) -> pa.Array:
        found = []
        for page, own in zip(pages, templates, strict=True):
            digests = {h & (1 << 64) - 1 for h in own.as_py() or ()}
            found.append(extract(parse(page.as_py() or ""), digests))
        return pa.array(found, pa.string())

    return of_pages(source, template)


def host_of(url: str) -> Column:
    """Host of a url in lower case, without user and port; the empty string if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_pages(
    pages: DataFrame, source: str = "html", url: str = "url", page_id: str = "page_id", least_pages: int = 5
) -> DataFrame:
    """``pages`` with the column main_text added (one of that name is replaced).

    A subtree is template where at least ``least_pages`` pages of its host
    hold it outside their main elements. It is deleted from pages without main
    elements; of the others the main elements are the text, whole. Null and
    empty pages have empty text. Pages of one id are one page for the counts
    and each get their text; null ids and urls are values like others (a null
    url has the host ''). Pages of any length are parsed as a whole, each by
    one task, and a host of any size is only counted. An empty table gives an
    empty result.

    Counts are summed before the shuffle. Pages meet their template digests by
    a broadcast up to BROADCAST_DIGESTS of them, beyond by a shuffle with the
    same rows.
    """
    hosts = pages.select(F.col(page_id).alias("id"), host_of(url).alias("host"), F.col(source).alias("page"))
    told = durable(hosts.select("host", "id", subtree_hashes(F.col("page")).alias("told")))
    # Rows of an id that repeats count its different digests once; all others are counted as they are.
    again = told.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("again_id"))
    marked = told.join(again, told["id"].eqNullSafe(F.col("again_id")), "left_semi")
    rest = told.join(again, told["id"].eqNullSafe(F.col("again_id")), "left_anti")
    digest = F.explode("told.digests").alias("digest")
    once = marked.select("host", digest, "id").distinct().select("host", "digest")
    counts = rest.select("host", digest).unionByName(once).groupBy("host", "digest").agg(F.count("*").alias("n"))
    template = durable(
        counts.where(F.col("n") >= least_pages).select(F.col("host").alias("t_host"), F.col("digest").alias("t_digest"))
    )
    # Only pages without main elements are cleaned.
    seen = told.where(~F.col("told.has_main")).select("host", "id", digest)
    same = (F.col("host") == F.col("t_host")) & (F.col("digest") == F.col("t_digest"))
    held = durable(
        seen.join(template, same, "left_semi").groupBy(F.col("id").alias("held_id")).agg(F.collect_set("digest").alias("held_digests"))
    )
    n = held.agg(F.sum(F.size("held_digests"))).first()[0] or 0
    if n <= BROADCAST_DIGESTS:
        held = F.broadcast(held)
    names = [c for c in pages.columns if c != "main_text"]
    found = F.struct(*[pages[c] for c in names]).alias("kept")
    named = pages.select(found, pages[page_id].alias("page_key"), pages[source].alias("page_source"))
    joined = named.join(held, F.col("page_key").eqNullSafe(F.col("held_id")), "left")
    return joined.select("kept.*", main_text(F.col("page_source"), F.col("held_digests")).alias("main_text"))
