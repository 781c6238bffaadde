"""Main text of web pages by removal of site templates.

Every page is read into a tree.  The subtrees of its elements are hashed, and Spark counts for each
host the pages on which a hash occurs.  A subtree that recurs on at least ``MIN_PAGES`` pages with
different contents of their own is part of the site's template and is cut out, however large the host is;
so are elements that are no main text by their kind or by the words of their class, id or role.  Of what
is left, the article (else the main element, else the body) gives the blocks of text.

A page's own content is its main text without the subtrees that ``MIN_PAGES`` rows of the host have.  So
copies of a page count once, also if the boilerplate around them rotates, and keep their text.

Prose is never cut for recurring: paragraphs, headings, list items, quotes, tables and preformatted text inside
an article stay even if many pages share them, and an article or main element itself stays.  Outside of
articles all elements with text can be cut, but an inline element only if no text stands beside it and it is not
inside prose (else it is words of a sentence), and table cells only with their row.

The tree is built by a small tolerant reader: it knows void and raw-text elements, closes what an
opening tag ends implicitly (paragraphs, list items, table cells, options), and ignores end tags without
a start.

Defined results: null or empty html has empty text; a page whose url has no host belongs to the host
``""``; rows that repeat a page count once, return each, and share the templates; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept
from .words import text_array

#: Pages of a host, with different contents of their own, that an element of its template is on.
MIN_PAGES = 5

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that never hold main text.
DROPPED = frozenset(
    "head nav footer aside form script style noscript iframe svg button select option input label textarea "
    "template object embed canvas audio video map dialog menu fieldset title xmp noembed noframes".split()
)
#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never cut for recurring: the frame of a page, and table cells.
FIXED = frozenset("#root html body article main td th".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre table td th figcaption".split())
#: What an opening tag closes, up to the nearest element that holds it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
#: Classes, ids and roles of elements without main text.  A name of several parts counts if each part is one of
#: these or one of ``PLACES``: ``comment-list`` does, ``ad-hoc`` does not.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar widget widgets related "
    "recommended share sharing social comment comments disqus reply replies respond footer masthead toolbar pagination "
    "pager subscribe newsletter signup login search skip skiplink contentinfo complementary dialog hidden".split()
)

#: Parts of names that say where something stands.
PLACES = frozenset(
    "area bar block body bottom box container content group inner item items left link links list main outer page panel "
    "right row section site text top wrap wrapper".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?=/)[^>]*>?",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Za-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("children", "marked", "parent", "tag")

    def __init__(self, tag: str, parent: Node | None, marked: bool = False):
        self.tag, self.parent, self.marked = tag, parent, marked
        self.children: list[Node | str] = []


def is_marked(attributes: str) -> bool:
    """Whether class, id or role say that the element holds no main text."""
    if not attributes or attributes.isspace():
        return False
    for name, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name != "aria-hidden" and any(names_no_text(w) for w in value.split()):
            return True
    return False


def names_no_text(name: str) -> bool:
    parts = _WORDS.findall(name)
    return any(w in MARKS for w in parts) and all(w in MARKS or w in PLACES for w in parts)


def parse(page: str) -> Node:
    """The tree of a page; text keeps its character references."""
    root = here = Node("#root", None)
    at, n = 0, len(page)
    while at < n:
        token = _TOKEN.search(page, at)
        if token is None:
            here.children.append(page[at:])
            break
        if token.start() > at:
            here.children.append(page[at : token.start()])
        at = max(token.end(), token.start() + 1)
        name = token.group(2)
        if name is None:
            continue
        tag = name.lower()
        if token.group(1):
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in BLOCKS:
            node = here
            while node.tag not in BLOCKS and node.parent is not None:
                node = node.parent
            if node.tag == "p" and tag not in ("html", "body"):
                here = node.parent
        if tag in CLOSES:
            ends, holders = CLOSES[tag]
            node, stop = here, None
            while node is not None and node.tag not in holders:
                if node.tag in ends:
                    stop = node
                node = node.parent
            if stop is not None:
                here = stop.parent
        attributes = token.group(3)
        made = Node(tag, here, is_marked(attributes))
        here.children.append(made)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            here = made
    return root


def walk(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


@dataclass
class Hashed:
    """A page's elements that can be cut, by the hashes of their subtrees (tags and text)."""

    found: dict[int, list[Node]]
    shown: set[int]  # hashes of those that are part of the main text
    content: int  # all of the main text: xor of these hashes and that of the text outside of them


def hashes(root: Node) -> Hashed:
    order = list(walk(root))
    frame = {id(up) for n in order if n.tag in ("article", "main") for up in uppers(n)}
    tops = {id(n) for n in main_tops(root)}
    own: dict[int, int] = {}
    texts: set[int] = set()  # nodes with text
    for node in reversed(order):
        parts, full = [node.tag], False
        for child in node.children:
            if isinstance(child, Node):
                parts.append(str(own[id(child)]))
                full = full or id(child) in texts
            elif not child.isspace():
                parts.append(" ".join(child.split()))
                full = True
        own[id(node)] = signed("\x1f".join(parts))
        if full:
            texts.add(id(node))
    found: dict[int, list[Node]] = {}
    shown: set[int] = set()
    rest: list[str] = []  # main text that no element that can be cut holds
    # Of each node: inside an article or main element, inside prose, part of the main text, inside what can be cut.
    flags: dict[int, tuple[bool, bool, bool, bool]] = {}
    for node in order:
        article, prose, text, held = flags[id(node.parent)] if node.parent is not None else (False,) * 4
        if id(node) in tops:
            text = True
        elif text:
            # Recurrence is asked before the names of classes are.
            text = not (node.tag in DROPPED or page_header(node))
        if node.tag in ("article", "main"):
            article, prose = True, False
        around, prose = prose, prose or node.tag in PROSE
        if (
            id(node) in texts
            and not (article and prose)
            and node.tag not in FIXED
            and node.tag not in DROPPED
            and id(node) not in frame
            and (node.tag in BLOCKS or (not around and stands_alone(node)))
        ):
            found.setdefault(own[id(node)], []).append(node)
            held = True
            if text:
                shown.add(own[id(node)])
        if text and not held:
            rest.extend(" ".join(c.split()) for c in node.children if isinstance(c, str) and not c.isspace())
        flags[id(node)] = article, prose, text, held
    content = signed("\x1f".join(rest))
    for h in shown:
        content ^= h
    return Hashed(found, shown, content)


def signed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def stands_alone(node: Node) -> bool:
    """Whether no text stands beside an inline element: it is not part of a sentence."""
    up = node.parent
    return (up.tag in BLOCKS or up.tag == "#root") and all(isinstance(c, Node) or c.isspace() for c in up.children)


def cut_templates(root: Node, templates: set[int]) -> None:
    """Take out the subtrees whose hashes are given."""
    if not templates:
        return
    for h, nodes in hashes(root).found.items():
        if h in templates:
            for node in nodes:
                node.parent.children.remove(node)


def page_header(node: Node) -> bool:
    """The heading of an article is text, that of a page is not."""
    return node.tag == "header" and not any(up.tag in ("article", "main") for up in uppers(node))


def skipped(node: Node, top: Node) -> bool:
    if node is top:
        return False
    if node.tag in DROPPED or page_header(node):
        return True
    if not node.marked or node.tag in ("article", "main", "body", "html"):
        return False
    # A marked word inside a sentence is part of it.
    return node.tag in BLOCKS or stands_alone(node)


def main_tops(root: Node) -> list[Node]:
    """The outermost articles, the main element, or the body; the main element also if its articles are but
    teasers, with less prose than stands beside them."""
    articles = [n for n in walk(root) if n.tag == "article" and not inside_dropped(n)]
    outer = [n for n in articles if not any(up is not n and up.tag == "article" for up in uppers(n))]
    main = [n for n in walk(root) if n.tag == "main"][:1]
    if outer and main:
        held = [n for n in outer if any(up is main[0] for up in uppers(n))]
        if len(held) == len(outer) and prose_beside(main[0], held) > sum(prose_beside(n, []) for n in held):
            return main
    return outer or main or [n for n in walk(root) if n.tag == "body"][:1] or [root]


def prose_beside(top: Node, without: list[Node]) -> int:
    """Characters of prose below an element, outside of some others."""
    total, stack = 0, [(top, False)]
    while stack:
        node, prose = stack.pop()
        if any(node is w for w in without) or (node is not top and skipped(node, top)):
            continue
        prose = prose or node.tag in PROSE
        for child in node.children:
            if isinstance(child, Node):
                stack.append((child, prose))
            elif prose:
                total += len(child.strip())
    return total


def main_blocks(root: Node) -> list[str]:
    tops = main_tops(root)
    blocks: list[str] = []
    text: list[str] = []

    def end_block():
        if text:
            block = _SPACE.sub(" ", "".join(text)).strip()
            if block:
                blocks.append(block)
            text.clear()

    for top in tops:
        stack: list[tuple[Node, bool] | str] = [(top, False)]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                text.append(entities.unescape(item))
                continue
            node, done = item
            if done:
                end_block()
                continue
            if skipped(node, top):
                if node.tag in BLOCKS:
                    end_block()
                continue
            if node.tag in ("br", "wbr"):
                text.append(" " if node.tag == "br" else "")
                continue
            if node.tag in BLOCKS:
                end_block()
                stack.append((node, True))
            stack.extend((c, False) if isinstance(c, Node) else c for c in reversed(node.children))
        end_block()
    return blocks


def uppers(node: Node) -> Iterator[Node]:
    up = node.parent
    while up is not None:
        yield up
        up = up.parent


def inside_dropped(node: Node) -> bool:
    return any(up.tag in DROPPED or (up.marked and up.tag not in ("body", "html", "main")) for up in uppers(node)) or (
        node.marked and node.tag != "article"
    )


def extract(page: str, templates: set[int] = frozenset()) -> str:
    root = parse(page)
    cut_templates(root, templates)
    return "\n\n".join(main_blocks(root))


# ---- over all pages


def host(pages: DataFrame) -> DataFrame:
    name = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", "html", F.coalesce(name, F.lit("")).alias("host"))


def page_hashes(pages: DataFrame) -> DataFrame:
    """(page_id, host, hash, shown, content): the different elements of each page that can be cut.

    ``shown``: the element is part of the page's main text; ``content``: the page's main text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, found, shown, content = [], [], [], []
            for i, page in enumerate(text_array(batch.column("html"))):
                got = hashes(parse(page.as_py()))
                found.extend(got.found)
                shown.extend(h in got.shown for h in got.found)
                content.extend([got.content] * len(got.found))
                where.extend([i] * len(got.found))
            rows = pa.array(where, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").take(rows), batch.column("host").take(rows), pa.array(found, pa.int64()),
                    pa.array(shown, pa.bool_()), pa.array(content, pa.int64()),
                ],
                names=["page_id", "host", "hash", "shown", "content"],
            )

    schema = "page_id bigint, host string, hash bigint, shown boolean, content bigint"
    return pages.select("page_id", "host", "html").mapInArrow(run, schema)


def repeats(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, host, own, elements): elements that ``min_pages`` rows of the host have, and a hash of the rest.

    Elements that no page shows in its main text are left out: cutting them changes nothing.  Counts combine before
    the shuffle.
    """
    counts = found.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"), F.bool_or("shown").alias("ever"))
    often = counts.filter(F.col("ever") & (F.col("n") >= min_pages)).select("host", "hash")
    # A page has one row here, with at most as many hashes as it has elements.
    return (
        found.join(often, ["host", "hash"])
        .groupBy("page_id", "host", "content")
        .agg(F.collect_set(F.struct("hash", "shown")).alias("elements"))
        .withColumn("own", F.expr("aggregate(elements, content, (a, e) -> if(e.shown, a ^ e.hash, a))"))
        .select("page_id", "host", "own", "elements")
    )


def templates(repeated: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash) of elements that are on ``min_pages`` pages with different contents of their own."""
    pages = repeated.select("host", "own", F.explode("elements.hash").alias("hash")).distinct()
    often = pages.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    return often.filter(F.col("n") >= min_pages).select("host", "hash")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    named = host(pages)
    found = kept(page_hashes(named), "page-hashes")
    repeated = kept(repeats(found), "page-repeats")
    recurring = kept(templates(repeated), "templates")
    # Only pages that show a template get a row here, with at most as many hashes as they have elements.
    mine = (
        repeated.select("page_id", "host", F.explode("elements").alias("e"))
        .filter("e.shown")
        .select("page_id", "host", F.col("e.hash").alias("hash"))
        .join(recurring, ["host", "hash"])
        .groupBy("page_id", "host")
        .agg(F.collect_set("hash").alias("cut"))
    )
    p, m = named.alias("p"), mine.alias("m")
    rows = p.join(m, F.expr("p.page_id <=> m.page_id and p.host = m.host"), "left").select(
        "p.page_id", "p.url", "p.html", "m.cut"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column("cut").to_pylist()
            texts = [
                extract(page.as_py(), set(cut or ()))
                for page, cut in zip(text_array(batch.column("html")), cuts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
