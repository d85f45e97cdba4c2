"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Comments, declarations and tags; last, a tag whose quotes do not close, which ends at the first ``>``.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|(?=<)|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# fixed values: HTML's elements by their part in a page
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template noscript iframe object svg annotation annotation-xml canvas textarea select button title head".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_HOLDS = frozenset("html article main section div center blockquote table td dl ul ol figure details".split())
_SPACE = frozenset("br td th img".split())
_CLOSES_P = _BLOCK - frozenset("body html dd dt li tbody td tfoot th thead tr".split())
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "td": ("table",), "th": ("table",), "tr": ("table",)}
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}
_HEAD = frozenset("base link meta noscript script style template title".split())
_LABELS = frozenset("button select".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BESIDE = frozenset("nav footer aside form dialog menu".split())
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
#: A name hints at a thing beside the text if all its parts are such words or words for a place or a box, and one is such a word.
_NOISE = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|share|sharing|social|sidebar|related|recommended|breadcrumbs?|pagination|pager|menu|navbar|navigation|nav|footer|masthead|comments?|disqus|respond|replies|widget|contentinfo|complementary|search")
_PLACE = re.compile(r"\d+|area|articles?|bar|block|bottom|box|buttons?|container|form|icons?|inner|items?|left|links?|list|main|outer|page|panel|posts?|primary|right|secondary|section|signup|site|slot|thread|top|unit|wrap|wrapper")
_NOISE_WHOLE = frozenset("side-bar site-header page-header skip-link".split())
_TALK = re.compile(r"(?:comments?|disqus|respond|replies)(?:$|[_-])")


def _is_noise(name: str) -> bool:
    if name in _NOISE_WHOLE:
        return True
    parts = [p for p in re.split(r"[_-]+", name) if p]
    hits = [bool(_NOISE.fullmatch(p)) for p in parts]
    return any(hits) and all(h or _PLACE.fullmatch(p) for h, p in zip(hits, parts, strict=True))


class _Node:
    """An element. ``beside``: hinted by its tag (2) or name (1) to hold no article, -1 for a reader's comment."""

    __slots__ = ("tag", "parent", "kids", "chars", "tags", "link", "links", "density", "total", "beside")

    def __init__(self, tag: str, parent: _Node | None, beside: int = 0):
        self.tag, self.parent, self.beside = tag, parent, beside
        self.kids: list[_Node | str] = []


def _unseen(attrs: str) -> bool:
    """Whether an element is hidden by its attributes."""
    low = attrs.lower()
    return ("hidden" in low and re.search(r"(?:^|\s)hidden(?:[\s=/]|$)", _QUOTED.sub("", low)) is not None) or ("display" in low and _UNSEEN.search(attrs) is not None)


def _leave(node: _Node, to: _Node) -> _Node:
    """``to``, with all below it on the way closed. A button or select that no end tag closed had no end: its start tag alone
    is dropped, and what came after it stays."""
    while node is not to:
        if node.tag in _LABELS:
            node.tag = "span"
            node.parent.kids.append(node)
        node = node.parent
    return to


def parse(page: str) -> _Node:
    """A forgiving tree of all elements but scripts, styles, hidden ones and the like: unknown, unclosed and stray tags never fail.

    A head ends at the first thing that is none of its own, a button or select at a block; end tags are optional.
    """
    root = node = _Node("html", None)
    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            if node.tag == "head" and text.strip():
                node = node.parent
            node.kids.append(text)
        if m is None:
            break
        at, gap = m.end(), m[1]
        close, tag, attrs = (m[2], m[3], m[4]) if m[3] else (m[5], m[6] or "", m[7])
        tag = tag.lower()
        if not tag:
            if gap:
                node.kids.append(gap)
            continue
        if close:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                node = _leave(node, up).parent
            continue
        if node.tag == "head" and tag not in _HEAD:
            node = node.parent
        if tag in ("html", "body"):
            continue
        if tag in _BLOCK and (label := next((n for n in _above(node) if n.tag in _LABELS), None)):
            node = label.parent
        if tag in _RAW and tag != "head" and tag not in _LABELS:
            stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else (size if tag in ("script", "style", "template", "title", "textarea") else at)
            continue
        closes = _CLOSED_BY.get(tag) or (("p",) if tag in _CLOSES_P else ())
        if closes:
            up, stop = node, _SCOPE.get(tag, ("table", "td", "th", "article", "section", "div", "main", "aside", "blockquote", "form", "nav", "footer", "header"))
            while up is not root and up.tag not in closes and up.tag not in stop:
                up = up.parent
            if up.tag in closes:
                while up.parent.tag in closes and up.parent.tag not in stop and len(closes) > 1:
                    up = up.parent
                node = up.parent
        child = _Node(tag, node, _hint(tag, attrs or ""))
        if tag not in _RAW and not (attrs and _unseen(attrs)):
            node.kids.append(child)
        if tag not in _VOID and not (attrs or "").endswith("/"):
            node = child
    _leave(node, root)
    return root


def _hint(tag: str, attrs: str) -> int:
    if tag in _BESIDE or tag == "header":
        return 2
    if not attrs or tag in ("article", "main", "p") or tag in _HEADINGS:
        return 0
    names = [x for x in (x for a in _ATTR.finditer(attrs) for x in (a[1] or a[2] or a[3] or "").lower().split()) if _is_noise(x)]
    return 0 if not names else -1 if any(map(_TALK.match, names)) else 1


def _above(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _order(root: _Node) -> list[_Node]:
    """All nodes, parents before children (pages may nest deeper than Python recurses)."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [k for k in reversed(n.kids) if isinstance(k, _Node)]
    return out


def _measure(nodes: list[_Node]) -> None:
    """Composite text density of each node, and its sum over the node's children.

    With C characters and T tags in a node, LC and LT of them in links, and r the share of linked characters in the page, it
    is C / T times the logarithm of (C / LC) (T / LT), to a base that grows with ln(C LC / (C - LC) + r C + e): many links,
    or much text in them, bring the density down, the more so on a page of many links.
    """
    for n in reversed(nodes):
        kids = [k for k in n.kids if isinstance(k, _Node)]
        n.chars = sum(len(k.strip()) for k in n.kids if isinstance(k, str)) + sum(k.chars for k in kids)
        n.tags = sum(k.tags + 1 for k in kids)
        n.link = n.chars if n.tag == "a" else sum(k.link for k in kids)
        n.links = sum(k.links + (k.tag == "a") for k in kids)
    share = nodes[0].link / max(nodes[0].chars, 1)
    for n in reversed(nodes):
        c, t, lc, lt = n.chars, max(n.tags, 1), max(n.link, 1), max(n.links, 1)
        base = math.log(c / max(c - n.link, 1) * n.link + share * c + math.e)
        n.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / max(math.log(base + 1), 0.1) if c else 0.0
        n.total = sum(k.density for k in n.kids if isinstance(k, _Node))


def _best(nodes: list[_Node]) -> _Node:
    """The subtree of greatest density sum; a hint for a thing beside the text only decides between close rivals."""
    beside = {id(n) for n in nodes if n.beside and n.tag not in ("article", "main")}
    for n in nodes:  # parents first: what lies in a hinted node is hinted
        if n.parent is not None and id(n.parent) in beside:
            beside.add(id(n))
    rivals = [n for n in nodes if n.tag in _HOLDS] or nodes[:1]
    top = max(rivals, key=lambda n: n.total)
    if id(top) in beside and (open_ := [n for n in rivals if id(n) not in beside and 3 * n.total >= top.total]):
        top = max(open_, key=lambda n: n.total)
    return top


def _prose(n: _Node) -> int:
    return n.chars - n.link


def _whole(best: _Node, floor: float) -> _Node:
    """The article around the densest subtree: as far up as the text beside it is dense, and to the article or main
    element around that. The body is taken only if it is the densest subtree itself or holds dense text beside it."""
    node = best
    for up in list(_above(best))[1:]:
        others = [k for k in up.kids if isinstance(k, _Node) and k is not node and not k.beside and k.chars]
        loose = sum(len(k.strip()) for k in up.kids if isinstance(k, str))
        dense = sum(_prose(k) for k in others if k.density >= floor and 2 * k.link <= k.chars)
        if up.tag in ("article", "main") or (up.parent is not None and 4 * (dense + loose) >= sum(k.chars for k in others) + loose and dense + loose):
            node = up
    return node


def _drops(n: _Node, within: int, floor: float, articles: set[int] | None) -> bool:
    """Whether a node inside the article is none of it: sparse, or hinted. A name gives way where the node holds most of
    the text, or all articles of a page that marks them (``articles``: the nodes above all of them)."""
    if n.beside == 1 and (2 * _prose(n) > within if articles is None else id(n) in articles):
        return False
    if n.beside:
        return n.tag != "header" or not any(a.tag in ("article", "main") for a in _above(n.parent))
    # a block of links without text of its own, sparser than the path to the article
    return n.tag in _BLOCK and n.tag not in _HEADINGS and n.links > 1 and 10 * n.link >= 9 * n.chars and n.density < floor


def main_nodes(root: _Node) -> list[_Node | str]:
    """The article: the whole of it around the subtree of greatest density sum, the headings before it on the path from the
    body, and other blocks and loose text there by density; the threshold is the least density on that path."""
    nodes = _order(root)
    _measure(nodes)
    top = _best(nodes)
    floor = min(n.density for n in _above(top))
    best = _whole(top, floor)
    path, within = set(map(id, _above(best))), max(_prose(best), 1)
    inside = best.tag in ("article", "main")
    found, todo, before = [], [root], True
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            if len(n.strip()) >= max(floor, 1) and not inside:
                found.append(n)
        elif n is best:
            found.append(n)
            before = False
        elif id(n) in path:
            todo += reversed(_runs(n.kids, path))
        elif n.beside:
            continue
        elif n.tag in _HEADINGS and n.chars and before and not inside:
            found.append(n)
        elif n.chars and n.density >= floor and n.link * 2 <= n.chars and not inside:
            found.append(n)
    marked = [set(map(id, _above(n))) for n in nodes if n.tag in ("article", "main") and n.chars]
    _prune(found, within, floor, set.intersection(*marked) if marked else None)
    return found


def _runs(kids: list[_Node | str], path: set[int]) -> list[_Node | str]:
    """Children in order, each run of text and inline nodes gathered under one node of its own."""
    out, run = [], []
    for k in [*kids, None]:
        if k is not None and (isinstance(k, str) or k.tag not in _BLOCK and id(k) not in path):
            run.append(k)
            continue
        if run:
            n = _Node("span", None)
            n.kids = run
            _measure([n] + [x for r in run if isinstance(r, _Node) for x in _order(r)])
            out.append(n)
            run = []
        if k is not None:
            out.append(k)
    return out


def _prune(found: list[_Node | str], within: int, floor: float, articles: set[int] | None) -> None:
    """Cut from the article's nodes what is none of it."""
    todo = [n for n in found if isinstance(n, _Node)]
    while todo:
        n = todo.pop()
        n.kids = [k for k in n.kids if isinstance(k, str) or not _drops(k, within, floor, articles)]
        todo += [k for k in n.kids if isinstance(k, _Node)]


def blocks(nodes: list[_Node | str]) -> list[str]:
    """Texts between block boundaries, in page order."""
    out, cur = [], []

    def cut() -> None:
        t = " ".join(html.unescape("".join(cur)).split())
        cur.clear()
        if t:
            out.append(t)

    for top in nodes:
        todo: list = [top]
        while todo:
            n = todo.pop()
            if n is None:
                cut()
            elif isinstance(n, str):
                cur.append(n)
            else:
                if n.tag in _SPACE:
                    cur.append(" ")
                if n.tag in _BLOCK and n.tag not in ("td", "th"):
                    cut()
                    todo.append(None)
                todo += reversed(n.kids)
        cut()
    return out


def main_text(page: str | None) -> str:
    """The article of a page, one line for each block; empty for a null, empty or textless page."""
    return "\n".join(blocks(main_nodes(parse(page)))) if page else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages(page_id, url, html)``, from the whole html.

    Null or empty html gives an empty text and 0. Repeated rows are extracted one by one, nulls in page_id and url are
    passed on, other columns ignored. A page is one row, so no page depends on another and no data is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(t, pa.string()), pa.array([len(x) for x in t], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
