"""Main text of web pages by tree scoring.

A page becomes a light tree of elements. Every paragraph earns points for its length and its
commas; the parent gets them whole, each further ancestor half of what the one below it got,
and an element's sum is discounted by the share of its text that stands in links. The element
with the best score, or the article it lies in, is the container; around one that is no
article, what its parent holds is kept unless it is mostly links.

Points are handed up once, from the leaves to the root, and open elements are found through
links to the next one that matters, so the work grows with the page and not with its depth.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar.llm.common import record, rows_of, slices

# Elements of HTML by their role in a page.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "script style noscript template head nav footer aside button select option datalist label "
    "textarea input iframe object embed svg canvas audio video dialog menu title xmp noembed "
    "noframes".split()
)
FIELDS = frozenset("input select textarea".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure h1 h2 h3 h4 h5 h6 hr html legend li main ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre blockquote td th li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
#: An open element (value) that a new one (key) ends.
ENDS = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    **dict.fromkeys(
        ("tbody", "thead", "tfoot"), {"tbody", "thead", "tfoot", "tr", "td", "th"}
    ),
}
ENDED = frozenset().union(*ENDS.values())
#: Elements beyond which nothing is ended implicitly.
SCOPES = frozenset("table ul ol dl select article section div body html main".split())
ARTICLE = re.compile(r"\b(article|content|entry|main|post|story|text)\b", re.I)
UNWANTED = re.compile(
    r"ads?\d*|advert\w*|banner|breadcrumbs?|\w*comment(?!ar)\w*|consent|cookies?|disqus|footer|"
    r"gdpr|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|pager|popup|"
    r"promo\w*|related|replies|respond|share|sharing|sidebar|signup|social|sponsor\w*|"
    r"subscribe|toc|toolbar|widget",
    re.I,
)
#: Parts of a name that say nothing beside an unwanted one.
PLAIN = re.compile(
    r"\d*|area|bar|block|bottom|box|form|global|inner|left|links?|list|main|outer|page|primary|"
    r"right|secondary|section|site|top|widgets",
    re.I,
)
#: Parts of class names of what readers wrote; two together, or the plural alone, are evidence
#: where nothing of the article follows.
READERS = re.compile(
    r"users?|readers?|customers?|reviews?|discussions?|threads?|reply|replies|responses?|"
    r"feedback|list|area|board",
    re.I,
)
#: The word that ``_suspect`` gives for them.
LATE = "reviews"
#: Unwanted words that, late on a page, mark what readers wrote however long that is.
SAID = re.compile(rf"\w*comment\w*|replies|disqus|{LATE}", re.I)
#: Class names that tell how a page is laid out around something.
LAYOUT = re.compile(r"(?:no|has|with|without)[-_]", re.I)
AROUND = re.compile(r"[-_](?:wrap|wrapper|container|layout)$", re.I)
#: Elements that are never a whole article.
PARTS = PARAGRAPHS | frozenset("a b em i span strong tr tbody thead tfoot".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Share of links from which a block beside the container is no part of the article.
LINKED = 0.5
#: Share of the page's points on which an unwanted name tells nothing.
MOST = 0.75
#: Share of the page's points over which a form is the page's and not one of its parts.
FORM = 0.5
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar".split()
)

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ROLE_FORM = re.compile(r"(?<![\w-])role\s*=\s*[\"']?form\b", re.I)
_HIDDEN = re.compile(r"(?<![\w-])type\s*=\s*[\"']?(?:hidden|submit|button)\b", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: Node | None
    dropped: bool = False
    named: bool = False
    #: The unwanted word of the element's name: evidence that ``_judge`` weighs.
    suspect: str = ""
    #: A form or an article's own header, which ``_weigh`` keeps or drops by what it holds.
    weighed: str = ""
    children: list[Node | str] = field(default_factory=list)
    score: float = 0.0
    size: int = 0
    linked: int = 0
    #: Length and commas of the text outside the paragraphs inside.
    own: int = 0
    commas: int = 0
    depth: int = 0
    #: Whether the element lies in an article or main.
    inside: bool = False
    #: The nearest element, itself included, beyond which an end tag does not reach, ...
    scope: Node | None = None
    #: ... that a block stops at, ...
    stop: Node | None = None
    #: ... and that an item or a cell may end.
    item: Node | None = None

    def __post_init__(self) -> None:
        up = self.parent or self
        self.depth = up.depth + (up is not self)
        self.inside = up.inside or up.tag in ("article", "main")
        self.scope = self if self.tag in SCOPES and self.tag != "div" else up.scope
        self.stop = self if self.tag in SCOPES or self.tag == "p" else up.stop
        self.item = self if self.tag in SCOPES or self.tag in ENDED else up.item


def _suspect(tag: str, classes: str, own: str) -> str:
    """The first unwanted word of an element's class and id that is evidence, or nothing.

    Ids are often slugs of a heading, so all their words have to be unwanted or plain; so do
    those of a wrapper's class. Ids of headings and layout modifiers tell nothing.
    """
    names = [(x, bool(AROUND.search(x))) for x in classes.split() if not LAYOUT.match(x)]
    if tag not in HEADINGS:
        names += [(x, True) for x in own.split()]
    for name, whole in names:
        parts = re.split("[-_]+", AROUND.sub("", name))
        found = [x for x in parts if UNWANTED.fullmatch(x)]
        if found and (not whole or all(x in found or PLAIN.fullmatch(x) for x in parts)):
            return found[0].lower()
    for name in classes.split():
        parts = re.split("[-_]+", name)
        if name.lower() == LATE or (len(parts) > 1 and all(map(READERS.fullmatch, parts))):
            return LATE
    return ""


def _unwanted(tag: str, attributes: str) -> tuple[bool, bool, str]:
    """Whether an element is no part of an article, whether its name says it is one, and the
    word that says it is none."""
    if tag in DROPPED:
        return True, False, ""
    if not attributes.strip() or tag in ("html", "body"):
        return False, tag in ("article", "main"), ""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    classes, own = (_CAMEL.sub("-", found.get(x, "")) for x in ("class", "id"))
    hidden = "hidden" in found or found.get("aria-hidden") == "true"
    style = found.get("style", "").replace(" ", "").lower()
    hidden = hidden or "display:none" in style or "visibility:hidden" in style
    suspect = _suspect(tag, classes, own)
    if tag in ("article", "main"):
        return hidden, True, suspect
    return hidden or found.get("role") in ROLES, bool(ARTICLE.search(f"{classes} {own}")), suspect


def build(page: str) -> Node:
    """The element tree of a page; unclosed and misnested markup is closed as browsers do."""
    root = node = Node("html", None)
    opened: dict[str, list[Node]] = {}
    at, end = 0, len(page)
    while at < end:
        found = MARKUP.search(page, at)
        if found is None:
            node.children.append(page[at:])
            break
        if found.start() > at:
            node.children.append(page[at : found.start()])
        at = found.end()
        if found[1]:
            node = _close(node, found[1].lower(), opened)
            continue
        if not found[2]:
            if found[0].startswith("<![CDATA["):
                node.children.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag, attributes = found[2].lower(), found[3]
        if tag in ("html", "body"):
            continue
        node = _end_implied(node, tag, opened)
        dropped, named, suspect = _unwanted(tag, attributes)
        child = Node(tag, node, node.dropped or dropped, named, suspect)
        if tag == "form" or _ROLE_FORM.search(attributes):
            child.weighed = "form"
        elif tag == "header" and child.inside:
            child.weighed, child.suspect = tag, "" if suspect == tag else suspect
        elif tag == "header":
            child.dropped = True
        elif tag in FIELDS and not _HIDDEN.search(attributes):
            child.weighed = "field"
        node.children.append(child)
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            child.children.append(page[at : close.start() if close else end])
            at = close.end() if close else end
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            node = child
            opened.setdefault(tag, []).append(child)
    _weigh(root)
    _judge(root)
    return root


def _leave(node: Node, last: Node, opened: dict[str, list[Node]]) -> Node:
    """The parent of ``last``, which is closed with all that is open inside it."""
    while node is not last.parent:
        opened[node.tag].pop()
        node = node.parent
    return node


def _close(node: Node, tag: str, opened: dict[str, list[Node]]) -> Node:
    """The node after an end tag; one that closes nothing is ignored."""
    if not opened.get(tag):
        return node
    last = opened[tag][-1]
    if tag in PARAGRAPHS - {"blockquote"} and last.depth < node.scope.depth:
        return node
    return _leave(node, last, opened)


def _end_implied(node: Node, tag: str, opened: dict[str, list[Node]]) -> Node:
    """Where a start tag goes: paragraphs, items and cells end when the next one starts."""
    if tag in BLOCKS and node.stop.tag == "p":
        node = _leave(node, node.stop, opened)
    ended = ENDS.get(tag)
    if ended:
        up, last = node.item, None
        while up.tag not in SCOPES:
            if up.tag in ended:
                last = up
            up = up.parent.item
        if last is not None:
            node = _leave(node, last, opened)
    return node


def _walk(root: Node) -> Iterator[Node]:
    """Elements before their children."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


def blocks(node: Node) -> list[str]:
    """Texts of the blocks in page order, white space folded, dropped elements left out."""
    found: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            found.append(text)
        parts.clear()

    stack: list[Node | str | None] = [node]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            parts.append(item)
        elif not item.dropped:
            if item.tag in BLOCKS:
                flush()
                stack.append(None)
            elif item.tag in ("br", "wbr"):
                parts.append(" " if item.tag == "br" else "")
            stack.extend(reversed(item.children))
    flush()
    return found


def _measure(order: list[Node]) -> None:
    """Text and link lengths of every kept element."""
    for node in reversed(order):
        if node.dropped:
            continue
        said = [c.strip() for c in node.children if isinstance(c, str)]
        kids = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        own = sum(map(len, said))
        node.size = own + sum(c.size for c in kids)
        node.linked = node.size if node.tag == "a" else sum(c.linked for c in kids)
        loose = [c for c in kids if c.tag not in PARAGRAPHS]
        node.own = own + sum(c.own for c in loose)
        node.commas = sum(t.count(",") for t in said) + sum(c.commas for c in loose)


def _density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _points(node: Node) -> float:
    """A paragraph's points, for its own text and not that of paragraphs inside it."""
    if not node.own:
        return 0.0
    return (1 + node.commas + min(node.own / 100, 3)) * (1 - _density(node))


def _earns(node: Node) -> bool:
    """Whether an element's own text earns points."""
    if node.tag in PARAGRAPHS:
        return True
    return node.tag in BLOCKS and any(isinstance(c, str) and c.strip() for c in node.children)


def _weigh(root: Node) -> None:
    """Drop forms that are no page's body, and headers of articles without title or text.

    A form stays if it holds an article or main, or most of the page's points and fewer
    fields than points.
    """
    order = [x for x in _walk(root) if not x.dropped or x.weighed == "field"]
    if not any(x.weighed and not x.dropped for x in order):
        return
    _measure(order)
    points: dict[int, float] = {}
    fields: dict[int, int] = {}
    bodies, texts = set(), set()
    for node in reversed(order):
        kids = [c for c in node.children if isinstance(c, Node) and id(c) in points]
        own = _points(node) if _earns(node) and not node.dropped else 0.0
        points[id(node)] = own + sum(points[id(c)] for c in kids)
        fields[id(node)] = (node.weighed == "field") + sum(fields[id(c)] for c in kids)
        held = {id(c) for c in kids}
        if held & bodies or (node.tag in ("article", "main") and points[id(node)] > 0):
            bodies.add(id(node))
        if held & texts or (own > 0 and (node.tag == "p" or node.tag in HEADINGS)):
            texts.add(id(node))
    for node in order:
        n = id(node)
        if node.weighed == "form" and n not in bodies:
            node.dropped = points[n] <= max(fields[n], FORM * points[id(root)])
        elif node.weighed == "header":
            node.dropped = node.dropped or n not in texts
        node.dropped = node.dropped or (node.parent is not None and node.parent.dropped)


def _late(order: list[Node], points: dict[int, float]) -> set[int]:
    """What follows the article's text, not its headings alone, with nothing of it after."""
    mine = [
        0.0 if x.suspect else points[id(x)] - sum(
            points[id(c)] for c in x.children if isinstance(c, Node) and not c.dropped
        )
        for x in order
    ]
    within: list[bool] = []
    place = {id(x): i for i, x in enumerate(order)}
    for node in order:
        above = place.get(id(node.parent), -1)
        within.append(bool(node.suspect) or (above >= 0 and within[above]))
    told = [i for i, x in enumerate(mine) if x > 1e-9 and not within[i]]
    if all(order[i].tag in HEADINGS for i in told):
        return set()
    return {id(x) for i, x in enumerate(order) if told[-1] < i}


def _judge(root: Node) -> None:
    """Drop the elements with an unwanted name, where the page does not speak against it.

    What holds the page's main or h1 stays. If no other article is left, so does what a name
    marks on most of the page's points, and then what holds an article.
    """
    order = [x for x in _walk(root) if not x.dropped]
    if not any(x.suspect for x in order):
        return
    _measure(order)
    points: dict[int, float] = {}
    holds: dict[int, set[str]] = {}
    for node in reversed(order):
        kids = [c for c in node.children if isinstance(c, Node) and not c.dropped]
        own = _points(node) if _earns(node) else 0.0
        points[id(node)] = own + sum(points[id(c)] for c in kids)
        held = set().union(*(holds[id(c)] for c in kids))
        if node.tag == "main" or (node.tag in ("article", "h1") and not node.suspect):
            held.add(node.tag)
        holds[id(node)] = held

    def left(kept: set[int]) -> bool:
        """Whether an article with text stays if of the suspects only these do."""
        stack = [root]
        while stack:
            node = stack.pop()
            if node.dropped or (node.suspect and id(node) not in kept):
                continue
            if node.tag in ("article", "main") and points[id(node)] > 0:
                return True
            stack.extend(c for c in node.children if isinstance(c, Node))
        return False

    late = _late(order, points)
    for node in order:
        if node.suspect == LATE and id(node) not in late:
            node.suspect = ""
    suspects = [x for x in order if x.suspect]
    kept = {id(x) for x in suspects if holds[id(x)] & {"main", "h1"}}
    if not left(kept):
        marked: dict[str, float] = {}
        stack: list[tuple[Node, frozenset[str]]] = [(root, frozenset())]
        while stack:
            node, above = stack.pop()
            if node.dropped:
                continue
            if node.suspect and node.suspect not in above:
                marked[node.suspect] = marked.get(node.suspect, 0.0) + points[id(node)]
                above = above | {node.suspect}
            stack.extend((c, above) for c in node.children if isinstance(c, Node))
        most = {x for x, n in marked.items() if n > MOST * points[id(root)]}
        said = {id(x) for x in suspects if id(x) in late and SAID.fullmatch(x.suspect)}
        kept |= {id(x) for x in suspects if x.suspect in most} - said
        if not left(kept):
            kept |= {id(x) for x in suspects if "article" in holds[id(x)]}
    for node in order:
        above = node.parent is not None and node.parent.dropped
        node.dropped = above or bool(node.suspect and id(node) not in kept)


def container(root: Node) -> Node:
    """The element that holds the article."""
    order = list(_walk(root))
    _measure(order)
    best, most = root, (0.0, 0)
    for node in reversed(order):
        if node.dropped:
            continue
        loose = node.tag not in PARAGRAPHS and _earns(node)
        node.score = _points(node) if loose else 0.0
        for kid in node.children:
            if isinstance(kid, Node) and not kid.dropped:
                node.score += kid.score / 2
                node.score += _points(kid) if kid.tag in PARAGRAPHS else 0.0
        value = node.score * (1 - _density(node)) * (1.5 if node.named else 1.0)
        # Of equals the deepest, then the first of the page.
        if value > 0 and (value, node.depth) >= most:
            best, most = node, (value, node.depth)
    while best.tag in PARTS and best.parent:
        best = best.parent
    return _article(best)


def _article(node: Node) -> Node:
    """The nearest article, main or else named element that an element is or lies in."""
    above = [node]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    for wanted in ("article", "main"):
        for up in above:
            if up.tag == wanted:
                return up
    return next((up for up in above if up.named and up.tag not in PARTS), node)


def _alike(node: Node, best: Node, parent: Node) -> bool:
    """Whether what stands beside an article or main belongs to it."""
    if node is best:
        return True
    if node.dropped or not node.size:
        return False
    if node.tag in ("h1", "h2") and parent.tag != "html":
        return True
    if node.tag == best.tag and node.named == best.named and node.score >= 0.2 * best.score:
        return _density(node) < 0.3 and node.score > 0
    return node.tag in ("p", "pre", "blockquote") and node.size > 80 and _density(node) < 0.25


def main_text(page: str) -> str:
    """The article's blocks, joined by an empty line; empty if there is none."""
    root = build(page)
    best = container(root)
    parent = best.parent
    if parent is None:
        return "\n\n".join(blocks(best))
    if best.tag in ("article", "main"):
        kept = [c for c in parent.children if isinstance(c, Node) and _alike(c, best, parent)]
        return "\n\n".join(text for node in kept for text in blocks(node))
    for node in parent.children:
        if isinstance(node, Node) and node is not best and node.tag in BLOCKS:
            node.dropped = node.dropped or _density(node) >= LINKED
    return "\n\n".join(blocks(parent))


TEXTS = "page_id long, url string, text string, n_chars long"


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars), one row per page, from the whole markup.

    Null, empty and tag-only pages give an empty text; plain text without any markup is its own
    article. Null ids and urls stay null, repeated rows are extracted each, an empty table gives
    no rows. Each page is read on its own, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            out = []
            for page_id, address, page in rows_of(batch):
                text = main_text(page or "")
                out.append((page_id, address, text, len(text)))
            yield record(TEXTS, out)

    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), markup)
    return rows.mapInArrow(run, TEXTS)
