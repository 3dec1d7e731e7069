"""Main text of pages by tag-path ratios.

Every text node has the path of tags from the root to it. For each path of a page two ratios are taken over its nodes:
characters outside links per node, and punctuation marks per node. Ratios are smoothed over the paths that differ by one
step at the end (a paragraph and the heading beside it, a list item and its list), fused by their geometric mean, with a
bonus inside article and main, and paths above a threshold, a share of the page's strongest unmarked path, are content.
Of the smallest element that holds most of the content, the content is taken with all that stands between it, so that a
short heading inside the article stays and a long notice outside it does not.
Elements that by their tag or role are menus, footers, sidebars, dialogs or controls have no paths. A word of a class or
id that speaks of boilerplate, and the tags header and form, only weigh: the element is marked, its paths are paths of
their own, and their ratio counts a five-hundredth. The mark is lifted off an element that holds the article (see
``lifted``), so a wrapper called page-with-sidebar, or a form around the whole page, changes nothing.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without end tags, elements whose content is raw text, elements inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes plaintext template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr br img input label button select option".split()
)
#: Fixed values of HTML: elements that a start tag closes when they are open, up to the nearest of the third set.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
CLOSES = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "thead": ("tr td th", "table"),
    "tbody": ("thead tbody tr td th", "table"), "tfoot": ("thead tbody tr td th", "table"), "option": ("option", "select"),
}
#: Elements that are never the article, by tag and by role; elements that are marked, by tag and by a word of their class or id.
OUTSIDE = frozenset("nav footer aside dialog menu button select input fieldset head".split())
MARKED = frozenset("header form".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer foot bottombar copyright "
    "sidebar aside sidenav rail widget widgets related recommended recommendations popular trending "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social toolbar pagination pager comment comments commentlist reply replies respond "
    "disqus discussion form search searchbox skip skiplink legal disclaimer paywall".split()
)
#: Those that speak of readers' comments, and words that may follow them in a name.
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
COMMENT_TAILS = frozenset("area body box container content inner item items list section text thread wrap wrapper".split())
#: Words that make a name say what stands beside an element, not what the element is.
STATES = frozenset("has with no without is not enabled disabled open closed".split())
#: Elements whose content is the article whatever the words of their class are.
ARTICLE = frozenset("article main body html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¡¿»«„“”]")
#: The share of the strongest path's fused ratio from which a path is content.
THRESHOLD = 0.2
#: By how much more a path inside article or main counts.
BONUS = 12.0
#: How much a path through a marked element counts.
MARK = 0.002
#: What an element is by its tag and attributes: nothing known, marked, marked as comments, outside.
PLAIN, NAMED, COMMENTS, OUT = range(4)
#: Shares of the page's characters outside links from which a mark is lifted: with a title or an article inside, or
#: with two blocks of as many characters.
LIFT_TITLED, LIFT_ALL, LONG_BLOCK = 0.5, 0.9, 80


@dataclass
class Block:
    """Text between two breaks of blocks: its elements from the root on, as (number, tag), and its pieces."""

    path: tuple[tuple[int, str], ...]
    text: str
    linked: int  # characters inside links

    def tags(self) -> tuple[str, ...]:
        return tuple(t for _, t in self.path)

    def marked(self) -> bool:
        return any(t.endswith("~") for _, t in self.path)


def _kind(name: str, attrs: str) -> int:
    if name in OUTSIDE:
        return OUT
    kind = NAMED if name in MARKED else PLAIN
    if name in ("main", "body", "html") or not attrs:
        return kind
    for key, value in _ATTRIBUTE.findall(attrs):
        key = key.lower()
        value = value.strip("\"'")
        if name not in ARTICLE and (
            key == "role" and value.lower() in OUTSIDE_ROLES
            or key == "aria-hidden" and value.lower() == "true"
            or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)
        ):
            return OUT
        if key in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in _NAME_WORD.findall(one)]
                if not STATES.isdisjoint(words):
                    continue
                ends = [w for w in words if w not in COMMENT_TAILS]
                if ends and ends[-1] in COMMENT_NAMES:
                    kind = COMMENTS
                elif name not in ARTICLE and not MARKED_NAMES.isdisjoint(words):
                    kind = max(kind, NAMED)
    if name not in ARTICLE and "hidden" in attrs.lower() and re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs, re.I):
        return OUT
    return OUT if kind and name in INLINE else kind


def lifted(found: list[Block], kinds: dict[int, int], holds: dict[int, set[str]]) -> list[Block]:
    """The blocks with a ``~`` behind the tags of elements that stay marked.

    A mark is lifted off an element with ``main`` in it, off a header with a title inside an article or main, and,
    unless its name speaks of comments, off an element with half of the page's characters outside links and a title or
    an article, or with nine tenths of them and two long blocks.
    """
    size: dict[int, int] = defaultdict(int)
    long: dict[int, int] = defaultdict(int)
    free: set[int] = set()
    for b in found:
        own = len(b.text) - b.linked
        for i, (n, t) in enumerate(b.path):
            size[n] += own
            long[n] += own >= LONG_BLOCK
            if t == "header" and "h1" in holds[n] and any(x in ("article", "main") for _, x in b.path[:i]):
                free.add(n)
    whole = sum(len(b.text) - b.linked for b in found)
    for n, kind in kinds.items():
        titled = size[n] >= LIFT_TITLED * whole and not holds[n].isdisjoint(("h1", "article"))
        if "main" in holds[n] or kind != COMMENTS and (titled or size[n] >= LIFT_ALL * whole and long[n] >= 2):
            free.add(n)
    stay = {n for n, kind in kinds.items() if kind and n not in free}
    return [Block(tuple((n, t + "~" * (n in stay)) for n, t in b.path), b.text, b.linked) for b in found]


def blocks(page: str) -> list[Block]:
    """The blocks of a page that are not in an outside element, in the order of the page, marked elements with a ``~``.

    Tags that were left open are closed as browsers do: by the end of their parent, and a paragraph, list item or cell
    by the next of its kind. An end tag that fits no open element is left out.
    """
    out: list[Block] = []
    stack: list[tuple[int, str, bool]] = []  # number, tag, whether it or an element around it is outside
    marks: dict[int, int] = {}  # kinds of marked elements
    holds: dict[int, set[str]] = defaultdict(set)  # titles, articles and mains inside marked elements
    pieces: list[str] = []
    number = at = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text and not (stack and stack[-1][2]):
            out.append(Block(tuple((n, t) for n, t, _ in stack if t not in INLINE), text, min(linked, len(text))))
        linked = 0

    def close_to(depth: int) -> None:
        if any(t not in INLINE for _, t, _ in stack[depth:]) or any(o for _, _, o in stack[depth:]):
            flush()
        del stack[depth:]

    def take(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1][2]):
            pieces.append(text)
            if any(t == "a" for _, t, _ in stack):
                linked += len(text)

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            take(page[at:])
            break
        take(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            if found["cdata"]:
                take(found["cdata"])
            continue
        name = name.lower()
        if found["end"]:
            if name == "br":
                take(" ")
            elif name == "p" and not any(t == "p" for _, t, _ in stack):
                flush()
            else:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][1] == name:
                        close_to(depth)
                        break
                    if name in INLINE and stack[depth][1] not in INLINE:
                        break  # an inline end tag does not reach over a block
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I)
            end = None if found["attrs"].rstrip().endswith("/") and name in ("svg", "math") else close.search(page, at)
            if end or name not in ("svg", "math"):
                at = end.end() if end else len(page)
            continue
        if name in BLOCKS:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][1] == "p"), None)
            if depth is not None and not any(t in ("table", "td", "th", "button", "object") for _, t, _ in stack[depth:]):
                close_to(depth)
        if name in CLOSES:
            kinds, limits = (x.split() for x in CLOSES[name])
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][1] in limits:
                    break
                if stack[depth][1] in kinds:
                    close_to(depth)
                    if name not in ("tr", "tbody", "tfoot", "thead"):
                        break
        kind = _kind(name, found["attrs"])
        outside = bool(stack and stack[-1][2]) or kind == OUT
        if name not in INLINE or outside and not (stack and stack[-1][2]):
            flush()
        if name in VOID:
            take(" ")
            continue
        number += 1
        if name in ("h1", "article", "main") and not outside:
            for n, _, _ in stack:
                if n in marks:
                    holds[n].add(name)
        if kind and not outside:
            marks[number] = kind
        stack.append((number, name, outside))
    flush()
    return lifted(out, marks, holds)


def content_paths(found: list[Block]) -> set[tuple[str, ...]]:
    """The tag paths whose smoothed and fused ratios reach the threshold."""
    nodes: dict[tuple[str, ...], list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    for b in found:
        sums = nodes[b.tags()]
        sums[0] += 1
        sums[1] += len(b.text) - b.linked
        sums[2] += len(_PUNCTUATION.findall(b.text))
    families: dict[tuple[str, ...], list[tuple[str, ...]]] = defaultdict(list)
    for path in nodes:
        families[path].append(path)
        if path:
            families[path[:-1]].append(path)
    fused = {}
    for path in nodes:
        near = {*families[path], *(families[path[:-1]] if path else ())} - {path}
        near = {p for p in near if (p[-1:] and p[-1].endswith("~")) == (path[-1:] and path[-1].endswith("~"))}
        ratios = []
        for k in (1, 2):
            own = nodes[path][k] / nodes[path][0]
            around = sum(nodes[p][k] for p in near) / max(1, sum(nodes[p][0] for p in near))
            ratios.append(0.5 * own + 0.5 * around if near else own)
        weight = MARK if any(t.endswith("~") for t in path) else BONUS if "article" in path or "main" in path else 1
        fused[path] = ((1 + ratios[0]) * (1 + ratios[1])) ** 0.5 * weight
    plain = [x for p, x in fused.items() if not any(t.endswith("~") for t in p)]
    if not plain:
        return set()  # boilerplate only
    limit = THRESHOLD * max(plain)
    return {p for p, x in fused.items() if x >= limit}


def main_text(page: str | None) -> str:
    """The blocks of the article, joined by line ends."""
    found = blocks(page or "")
    paths = content_paths(found)
    weight: dict[tuple[tuple[int, str], ...], int] = defaultdict(int)
    for b in found:
        if b.tags() in paths:
            for depth in range(len(b.path) + 1):
                weight[b.path[:depth]] += len(b.text)
    whole = weight.get((), 0)
    holders = [p for p, w in weight.items() if 10 * w >= 9 * whole and (not p or p[-1][1] not in ("p", "li", "td"))]
    holder = max(holders, key=len, default=())
    inside = [b for b in found if b.path[: len(holder)] == holder]
    content = [i for i, b in enumerate(inside) if b.tags() in paths]
    first, last = min(content, default=0), max(content, default=-1)
    own = bool(holder) and holder[-1][1] not in ("body", "html")  # then what is before and behind is of the article too
    kept = [
        b for i, b in enumerate(inside)
        if b.tags() in paths or not b.marked() and (first <= i <= last or own and 2 * b.linked < len(b.text))
    ]
    return "\n".join(b.text for b in kept)


def extract(pages: DataFrame) -> DataFrame:
    """Each row of ``pages`` with its main text.

    Reads page_id, url and html; other columns are ignored. A null or empty html, or one of boilerplate only, has the
    empty text. Markup that is cut off anywhere is read as far as it goes; text without markup is one block. Rows that
    repeat a page_id are read each for itself; an empty table gives no rows. Returns page_id, url, text, n_chars.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
