"""Main text of web pages by removal of site templates.

A page is parsed into a tree; every subtree gets a hash of its markup and text.
Spark counts, per host, on how many different pages each subtree occurs; those on
``MIN_PAGES`` or more are the site's template and are deleted from the whole page,
with everything below.  A passage that many pages quote stays if it is a bare
paragraph or a block quote; a box around it that recurs as a whole is template.
What differs from page to page but says by its tag, role, class or id that it is a
menu, header, footer, sidebar, notice, advert, form or comment goes next.  What
remains is the main text.  An ``article`` or ``main`` is a hint only: where it has
at least a quarter of the remaining characters, the rest goes too.

Scale: counting is a partial aggregate over (host, hash, page digest), so a host
with a third of all pages is summed before it moves.  Up to ``BROADCAST_HASHES``
templates go to every task as eight bytes each (the driver holds no more of them
either), more are joined with the pages' subtrees by host and hash, in a shuffle;
only those on more than ``HOT_PAGES`` pages, which are few, are broadcast there.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import kept, map_slices, pick
from bitext.llm.urlfilter import host_of

#: A subtree is template if so many different pages of its host have it.
MIN_PAGES = 4
#: An article element is believed if it holds one in so many of the remaining characters.
HINT_SHARE = 4
#: Template hashes in all up to which they are broadcast (32 MB); beyond, a shuffle join.
BROADCAST_HASHES = 4_000_000
#: Pages of a template beyond which that join deals its rows by page, not by hash; more
#: where more than ``HOT_TEMPLATES`` could have so many.
HOT_PAGES = 5_000
HOT_TEMPLATES = 100_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template svg math canvas iframe object embed audio video map nav header footer aside "
    "form button select textarea input label fieldset menu dialog title".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul nav header footer aside form".split()
)
#: Start tags that end an open element of the second set (implied end tags).
CLOSES = {
    **dict.fromkeys(BLOCKS - {"body", "html"}, frozenset({"p"})),
    "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}), "tbody": frozenset({"thead", "tr", "td", "th", "p"}),
}
#: Elements beyond which an implied end tag doesn't reach.
SCOPE = frozenset("article aside body blockquote details div figure footer form header html main nav ol section table td th ul dl".split())
LIST_SCOPE = {"li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}), "tr": frozenset({"table"}), "td": frozenset({"tr", "table"}), "th": frozenset({"tr", "table"}), "tbody": frozenset({"table"})}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
#: Words in class, id or role that mark what isn't the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar aside "
    "footer header masthead comment comments reply replies disqus respond share sharing social related recommended newsletter subscribe "
    "signup login widget pagination pager complementary contentinfo search".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PIECE = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "parts", "parent")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []


def parse(page: str) -> Node:
    """The element tree of a page; ``parts`` hold text and elements in order.

    Comments are dropped, implied end tags are supplied, an end tag without an
    open element is ignored, what is still open at the end ends there.
    """
    root = here = Node("#root", "", None)
    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            here.parts.append(page[at:])
            break
        if m.start() > at:
            here.parts.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                here.parts.append(entities.escape(m[0][9:-3]))
            continue
        if m[1]:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            elif tag == "p":
                here.parts.append(Node("p", "", here))
            continue
        if ends := CLOSES.get(tag):
            stop = LIST_SCOPE.get(tag, SCOPE)
            node = here
            while node is not root and node.tag not in stop:
                if node.tag in ends:
                    here = node.parent
                node = node.parent
        node = Node(tag, m[3], here)
        here.parts.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            node.parts.append(page[at : end.start() if end else n])
            at = end.end() if end else n
            continue
        here = node
    return root


def is_marked(node: Node) -> bool:
    """Whether tag, class, id or role says that the element isn't article text."""
    if node.tag in DROPPED:
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main") and "comment" not in node.attrs:
        return False
    return any(MARKS.intersection(_PIECE.split((a or b or c).lower())) for _, a, b, c in _ATTR.findall(node.attrs))


def _outermost(root: Node, tag: str) -> list[Node]:
    """The outermost elements of a tag that aren't marked, in page order."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node is not root and is_marked(node):
            continue
        if node.tag == tag:
            found.append(node)
        else:
            todo += [x for x in reversed(node.parts) if not isinstance(x, str)]
    return found


def hinted_nodes(root: Node) -> list[Node]:
    """What the page itself calls its text: the article elements, else main; may be none."""
    return _outermost(root, "article") or _outermost(root, "main")


def main_nodes(root: Node) -> list[Node]:
    """Where only containers can be template: the hinted elements, else the body or all."""
    return hinted_nodes(root) or _outermost(root, "body") or [root]


def subtree_hashes(root: Node) -> dict[int, int]:
    """id(node) -> hash of its markup and text, white space folded, for every element."""
    out: dict[int, int] = {}
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.parts if not isinstance(x, str)]
    for node in reversed(order):  # children before parents
        digest = xxhash.xxh64(node.tag.encode() + b"\0" + _SPACE.sub(" ", node.attrs).strip().encode())
        for part in node.parts:
            if isinstance(part, str):
                if text := _SPACE.sub(" ", part).strip():
                    digest.update(b"\1" + text.encode())
            else:
                digest.update(b"\2" + out[id(part)].to_bytes(8, "little"))
        out[id(node)] = digest.intdigest()
    return out


def candidates(root: Node) -> list[Node]:
    """The elements that template removal may delete.

    Outside the article every element that isn't void; inside it only
    containers, with the prose they hold, but never prose by itself (paragraphs,
    headings, list items, cells), what a block quote holds, nor what encloses
    the article: a passage that many pages quote stays.  Of several articles on
    a page each is a candidate.
    """
    tops = main_nodes(root)
    mains = {id(m) for m in tops}
    fixed = set() if len(tops) > 1 else set(mains)
    for m in tops:
        node = m.parent
        while node is not None:
            fixed.add(id(node))
            node = node.parent
    out, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or id(node) in mains
        if node is not root and id(node) not in fixed and node.tag not in VOID:
            if not inside or node.tag not in PROSE and node.tag in BLOCKS:
                out.append(node)
        if not inside or node.tag != "blockquote":
            todo += [(x, inside) for x in node.parts if not isinstance(x, str)]
    return out


def text_of(root: Node, gone: set[int]) -> str:
    """Blocks that remain of the page, one a line, without those in ``gone`` and marked elements.

    If the hinted elements hold at least a quarter of the characters, only theirs.
    """
    hinted = {id(m) for m in hinted_nodes(root)}
    blocks: list[tuple[bool, list[str]]] = [(False, [])]
    todo: list = [(root, False, False)]  # part, whether its end, whether inside a hinted element
    while todo:
        item, ending, inside = todo.pop()
        if isinstance(item, str):
            blocks[-1][1].append(item)
            continue
        if ending:
            blocks.append((inside, []))
            continue
        if id(item) in gone or item is not root and is_marked(item):
            continue
        if item.tag == "br":
            blocks[-1][1].append(" ")
            continue
        within = inside or id(item) in hinted
        if item.tag in BLOCKS:
            blocks.append((within, []))
            todo.append((item, True, inside))
        todo += [(x, False, within) for x in reversed(item.parts)]
    lines = [(inside, _SPACE.sub(" ", entities.unescape("".join(b))).strip()) for inside, b in blocks if b]
    trusted = HINT_SHARE * sum(len(x) for inside, x in lines if inside) >= sum(len(x) for _, x in lines)
    return "\n".join(x for inside, x in lines if x and (inside or not (hinted and trusted)))


# ---- Spark ------------------------------------------------------------------


def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pick(pages, page_id=id_col, url=url_col, html=html_col).select("page_id", "url", "html", host_of(F.col("url")).alias("host"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _key(host: str, value: int) -> int:
    """Spark's ``xxhash64(host, hash)``: one word for a template of a host."""
    return _signed(xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed=xxhash.xxh64_intdigest(host.encode(), seed=42)))


def subtree_counts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, hash, pages): on how many different pages of its host each subtree occurs.

    Pages of a host with equal bodies count once, so copies of a page don't turn
    its text into template.
    """

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            host, page, value = [], [], []
            for h, text in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                root = parse(text or "")
                hashes = subtree_hashes(root)
                body = xxhash.xxh64_intdigest(b"".join(hashes[id(m)].to_bytes(8, "little") for m in main_nodes(root)))
                found = {hashes[id(x)] for x in candidates(root)}
                host += [h] * len(found)
                page += [_signed(body)] * len(found)
                value += [_signed(x) for x in found]
            return {"host": host, "page": page, "hash": value}

        return run

    rows = map_slices(_rows(pages, id_col, url_col, html_col).select("host", "html"), make, "host string, page long, hash long")
    return rows.distinct().groupBy("host", "hash").agg(F.count("*").alias("pages"))


def templates(counts: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash, pages): the subtrees that recur on enough pages of their host."""
    return counts.where(F.col("pages") >= min_pages).select("host", "hash", "pages")


def _keys(found: DataFrame) -> np.ndarray:
    """The sorted ``_key`` of every template: they reach the driver as eight bytes each, not as rows."""

    def make():
        return lambda batch: {"keys": [batch["key"].to_numpy().astype(np.int64).tobytes()]}

    parts = map_slices(found.select(F.xxhash64("host", "hash").alias("key")), make, "keys binary", 1 << 16).collect()
    return np.sort(np.frombuffer(b"".join(r["keys"] for r in parts), np.int64))


def _gone(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(host, at, gone): the templates on each different page, by a shuffle join."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"host": [], "at": [], "hash": []}
            for host, at, page in zip(batch["host"].to_pylist(), batch["at"].to_pylist(), batch["html"].to_pylist()):
                root = parse(page or "")
                hashes = subtree_hashes(root)
                own = {hashes[id(x)] for x in candidates(root)}
                out["host"] += [host] * len(own)
                out["at"] += [at] * len(own)
                out["hash"] += [_signed(x) for x in own]
            return out

        return run

    own = map_slices(rows.select("host", "at", "html"), make, "host string, at long, hash long", 128).distinct()
    # rows of a template on very many pages are known to match and are dealt by their page
    least = max(HOT_PAGES, (found.agg(F.sum("pages")).first()[0] or 0) // HOT_TEMPLATES)
    hot = found.where(F.col("pages") > least).select("host", "hash", F.lit(True).alias("hot"))
    own = own.join(F.broadcast(hot), ["host", "hash"], "left")
    own = own.withColumn("by", F.when(F.col("hot"), F.xxhash64("at", "hash")).otherwise(F.col("hash")))
    # hinted: by its few bytes on disk Spark would broadcast the table of templates through the driver
    rest = found.select("host", F.col("hash").alias("by"), F.lit(True).alias("known")).hint("merge")
    own = own.join(rest, ["host", "by"], "left").where("hot OR known")
    return own.groupBy("host", "at").agg(F.collect_list("hash").alias("gone"))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(page_id, url, text, n_chars) for every page.

    Null html gives an empty text; a null URL has the empty host, whose pages
    are counted together; repeated rows give repeated rows; an empty table gives
    an empty result.
    """
    spark = pages.sparkSession
    found = kept(spark, templates(subtree_counts(pages, id_col, url_col, html_col), min_pages), "templates")
    rows = _rows(pages, id_col, url_col, html_col)
    few = found.count() <= BROADCAST_HASHES
    if few:
        shared = spark.sparkContext.broadcast(_keys(found).tobytes())
        rows = rows.select("page_id", "url", "html", "host")
    else:
        # a page's list may hold more of its host's templates than it needs, so 64 bits of its text do
        rows = rows.withColumn("at", F.xxhash64("html"))
        rows = rows.join(_gone(rows, found).hint("merge"), ["host", "at"], "left").select("page_id", "url", "html", "gone")

    def make():
        known = np.frombuffer(shared.value, np.int64) if few else None

        def dropped(root: Node, host: str, gone: list[int] | None) -> set[int]:
            if not (len(known) if few else gone):
                return set()  # nothing recurs
            hashes = subtree_hashes(root)
            own = candidates(root)
            if few:
                keys = np.array([_key(host, hashes[id(x)]) for x in own], np.int64)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                return {id(x) for x, hit in zip(own, known[at] == keys) if hit}
            bad = {x & (1 << 64) - 1 for x in gone}
            return {id(x) for x in own if hashes[id(x)] in bad}

        def run(batch: pa.RecordBatch) -> dict:
            texts = []
            for page, by in zip(batch["html"].to_pylist(), batch["host" if few else "gone"].to_pylist()):
                root = parse(page or "")
                texts.append(text_of(root, dropped(root, by, None) if few else dropped(root, "", by)))
            return {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return run

    return map_slices(rows, make, "page_id long, url string, text string, n_chars long", 128)
