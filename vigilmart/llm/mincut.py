"""Main text of web pages by minimum-cut labelling.

A page is read into blocks of text. A linear classifier over a block's place and shape gives
the cost of calling it content or boilerplate: these are the capacities to the two terminals.
Neighbouring blocks, and blocks of one parent, are tied by capacities that fall with their
distance in the element tree. The minimum cut between the terminals is the cheapest labelling;
the blocks left on the content side are the main text.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": "li", "dd": "dd", "dt": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}
LISTS = frozenset("ul ol menu dir dl table tbody thead tfoot tr select body".split())
FOREIGN = frozenset("svg math".split())
# Elements that end an open drawing, except within its foreignObject.
BREAKS = BLOCK_TAGS | frozenset("b big br code em embed i img ruby s small span strong strike sub sup tt u var font".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button fieldset label".split())
CONTENT_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role attributes, by what they tell.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts aside banner breadcrumb breadcrumbs byline comment commentlist "
    "comments consent cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notification pagination pager popup promo promoted recommended related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "topbar widget".split()
)
CONTENT_WORDS = frozenset("article articlebody body content entry main page post story text".split())
# Words before a boilerplate word that tell what an element has or lacks beside it, as in has-left-sidebar.
BESIDE_WORDS = frozenset("has have hide no with without".split())
SIDE_WORDS = frozenset("bottom fixed left right sticky top".split())
# Content words with which a header is that of the text, not of the site.
HEADED_WORDS = frozenset("article articlebody content entry post story".split())
# Boilerplate words for texts of a kind of their own.
OWN_TEXT_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts comment commentlist comments consent cookie cookies copyright "
    "disclaimer disqus gdpr newsletter notice promo promoted recommended related replies reply respond sponsor "
    "sponsored subscribe".split()
)

# Weights of the classifier, in units of log odds; above zero for content.
IN_BOILERPLATE, IN_BOILERPLATE_WORD, IN_CONTENT, IN_CONTENT_WORD, IN_HEADER = -9.0, -9.0, 4.0, 1.0, -3.0
IN_MIXED_WORDS = -1.0  # a boilerplate word on an element that content words name too
# Shares of a page's text, and characters of it, from which an element counts as a frame.
FRAME, FRAME_BESIDE, OWN_TEXT_REST, OWN_TEXT_LEAST = 0.75, 0.9, 240, 600
PER_WORD, MOST_WORDS, ALL_LINKS, HEADING, SENTENCE, BASE = 0.06, 40, -5.0, 1.0, 0.8, -0.6
TIE = 1.5  # capacity between blocks at distance one
ACROSS = 0.2  # the same, into or out of a boilerplate element

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|template|iframe|textarea)(?![\w-])([^>]*)>.*?(?:</\1\s*>|\Z)"
    r"|<(noscript|select)(?![\w-])[^>]*>(?:(?!<\3(?![\w-])).)*?</\3\s*>"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL | re.IGNORECASE,
)
_SVG_END = re.compile(r"</svg", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none(?![\w-])", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Element:
    number: int
    tag: str
    bias: float
    content: bool
    boilerplate: bool = False  # by its tag, or hidden
    named: bool = False  # by a boilerplate word: the bias holds IN_BOILERPLATE_WORD
    own_text: bool = False  # named by a word of OWN_TEXT_WORDS


@dataclass
class Block:
    path: tuple[int, ...]
    within: tuple[Element, ...]
    tag: str
    bias: float = 0.0
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _words(names: str) -> tuple[set[str], bool, bool]:
    """Boilerplate words of names; whether they hold content words, and such that outweigh those.

    In ``has-sidebar`` the word tells what stands beside the element's text and doesn't count.
    In ``article-header`` the header is the article's; ``post-comments`` are comments.
    """
    boilerplate, content, alone = set(), False, False
    for name in names.split():
        parts = [w.lower() for w in _WORD.findall(name)]
        words = set()
        for i, word in enumerate(parts):
            before = i - 2 if i > 1 and parts[i - 1] in SIDE_WORDS else i - 1
            if before < 0 or parts[before] not in BESIDE_WORDS:
                words.add(word)
        own = words & BOILERPLATE_WORDS
        if not CONTENT_WORDS.isdisjoint(words):
            content = True
            alone = alone or not own or (own == {"header"} and not HEADED_WORDS.isdisjoint(words))
        boilerplate |= own
    return boilerplate, content, alone


def _element(number: int, tag: str, attributes: str, parents: list[Element]) -> Element:
    out = Element(number, tag, 0.0, tag in CONTENT_TAGS)
    if tag in BOILERPLATE_TAGS:
        out.bias += IN_BOILERPLATE
        out.boilerplate = True
    if out.content:
        out.bias += IN_CONTENT
    if tag == "header":
        out.boilerplate = not any(e.content for e in parents)
        out.bias += IN_BOILERPLATE if out.boilerplate else IN_HEADER
    if attributes:
        given: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(attributes):
            given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        if "hidden" in given or _NOT_SHOWN.search(given.get("style", "")):
            out.bias += IN_BOILERPLATE_WORD
            out.boilerplate = True
        boilerplate, content, alone = _words(f"{given.get('class', '')} {given.get('id', '')}")
        role, main, _ = _words(given.get("role", ""))
        if tag in HEADINGS:
            boilerplate.discard("header")
        out.own_text = not OWN_TEXT_WORDS.isdisjoint(boilerplate)
        if boilerplate | role and tag not in ("body", "html", "article", "main"):
            if (alone or main) and not role:
                out.bias += IN_MIXED_WORDS + (0.0 if out.content else IN_CONTENT_WORD)
            else:
                out.bias += IN_BOILERPLATE_WORD
                out.named = True
        elif (content or main) and not out.content:
            out.bias += IN_CONTENT_WORD
    return out


def _told(block: Block) -> int:
    """Characters of a block that isn't mostly links and stands in no boilerplate tag."""
    if any(e.boilerplate for e in block.within):
        return 0
    text = block.text()
    return len(text) if 2 * block.linked <= len(text.split()) else 0


def _weigh(found: list[Block]) -> None:
    """Set the bias of every block from the elements it stands in.

    A boilerplate word may name a frame around the main text. Its weight is lifted where the
    element wraps most of the text in article and main elements, or holds FRAME of all text
    (FRAME_BESIDE while an article or main outside has some). Comments, notices and the like
    can outgrow the main text: theirs is lifted only where the page has next to nothing else.
    """
    named = {e.number: e for b in found for e in b.within if e.named}
    if named:
        total = articles = 0
        inside, wrapped, told = ({n: 0 for n in named} for _ in range(3))
        for block in found:
            size = _told(block)
            content = [i for i, e in enumerate(block.within) if e.content and not e.own_text]
            total += size
            articles += size if content else 0
            for i, e in enumerate(block.within):
                if e.named:
                    inside[e.number] += size
                    told[e.number] += size if content else 0
                    wrapped[e.number] += size if content and content[-1] > i else 0
        for n, e in named.items():
            if e.own_text:
                frame = total - inside[n] < OWN_TEXT_REST and (wrapped[n] > 0 or inside[n] >= OWN_TEXT_LEAST)
            else:
                share = FRAME_BESIDE if articles > told[n] else FRAME
                frame = 2 * wrapped[n] > articles or (inside[n] > 0 and inside[n] >= share * total)
            if frame:
                e.bias -= IN_BOILERPLATE_WORD
    for block in found:
        block.bias = sum(e.bias for e in block.within)


def blocks(page: str) -> list[Block]:
    """Runs of text between block elements, in page order, with their place in the tree.

    Text of drawings (svg) is left out, up to their end tag or an element that can't stand in one.
    """
    out: list[Block] = []
    stack: list[Element] = []
    current: Block | None = None
    number = anchors = foreign = drawings = last = 0
    svg_end: int | None = None  # place of the page's last one

    def add(raw: str) -> None:
        nonlocal current
        if drawings:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if current is None:
            if not text.strip():
                return
            outer = [e for e in stack if e.tag in BLOCK_TAGS]
            current = Block(tuple(e.number for e in outer), tuple(stack), outer[-1].tag if outer else "")
            out.append(current)
        current.parts.append(text)
        if anchors:
            current.linked += len(text.split())

    def close(at: int) -> None:
        nonlocal anchors, foreign, drawings
        anchors -= sum(e.tag == "a" for e in stack[at:])
        if foreign:
            foreign -= sum(e.tag in FOREIGN for e in stack[at:])
            drawings -= sum(e.tag == "svg" for e in stack[at:])
        del stack[at:]

    def found(tag: str, within: frozenset[str] = frozenset()) -> int | None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == tag:
                return i
            if stack[i].tag in within:
                return None
        return None

    while (m := _TOKEN.search(page, last)) is not None:
        if m.start() > last:
            add(page[last : m.start()])
        last = m.end()
        name = m[5] or m[8]
        if name is None:
            if foreign and m[1] and m[2].endswith("/"):  # such a tag has no text there
                last = m.end(2) + 1
            continue
        tag, ending, attributes = name.lower(), bool(m[4] or m[7]), m[6] or m[9] or ""
        if drawings:
            at = found(tag if ending else "foreignobject", frozenset({"svg"}))
            if at is None and tag in BREAKS and (tag != "br" or not ending):
                at = next(i for i, e in enumerate(stack) if e.tag == "svg")
                close(at)
            else:  # within the drawing
                if ending:
                    if at is not None:
                        close(at)
                elif tag not in VOID_TAGS and not attributes.endswith("/"):
                    number += 1
                    stack.append(Element(number, tag, 0.0, False))
                    foreign += tag in FOREIGN
                    drawings += tag == "svg"
                continue
        if tag in FOREIGN and not ending:
            if attributes.endswith("/"):
                continue
            if tag == "svg":
                if svg_end is None:
                    svg_end = max((e.start() for e in _SVG_END.finditer(page)), default=-1)
                if svg_end < last:
                    continue
        elif foreign and attributes.endswith("/") and tag not in BREAKS:
            continue
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            current = None
        if ending:
            at = found(tag)
            if at is not None:
                close(at)
            continue
        if tag in BLOCK_TAGS:
            at = found("p", frozenset({"td", "th", "button"}))
            if at is not None:
                close(at)
        if tag in CLOSES:
            at = found(CLOSES[tag], LISTS - {CLOSES[tag]})
            if at is not None:
                close(at)
        if tag in VOID_TAGS:
            continue
        number += 1
        stack.append(_element(number, tag, attributes, stack))
        anchors += tag == "a"
        foreign += tag in FOREIGN
        drawings += tag == "svg"
    if last < len(page):
        add(page[last:])
    out = [b for b in out if b.text()]
    _weigh(out)
    return out


def content_score(block: Block) -> float:
    """Log odds that the block is content."""
    words = block.text().split()
    share = min(1.0, block.linked / len(words))
    odds = BASE + block.bias + PER_WORD * min(len(words), MOST_WORDS) + ALL_LINKS * share
    if block.tag in HEADINGS:
        odds += HEADING
    if words[-1][-1] in ".!?\"')" and len(words) > 3:
        odds += SENTENCE
    return odds


def _distance(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    common = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        common += 1
    return len(a) + len(b) - 2 * common


def minimum_cut(scores: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut.

    A node with a score above zero has that capacity from the source, one below zero to the
    sink; ties hold in both directions. Flow is raised level graph by level graph (Dinic).
    """
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(there)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0.0)
        elif s < 0:
            join(i, sink, -s, 0.0)
    for a, b, c in ties:
        join(a, b, c, c)
    tiny = 1e-9
    while True:
        depth = [-1] * (n + 2)
        depth[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > tiny and depth[to[e]] < 0:
                    depth[to[e]] = depth[a] + 1
                    queue.append(to[e])
        if depth[sink] < 0:
            return [d >= 0 for d in depth[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                short = next(i for i, e in enumerate(path) if room[e] <= tiny)
                at = to[path[short] ^ 1]
                del path[short:]
                continue
            while nxt[at] < len(heads[at]):
                e = heads[at][nxt[at]]
                if room[e] > tiny and depth[to[e]] == depth[at] + 1:
                    break
                nxt[at] += 1
            else:
                if at == source:
                    break
                e = path.pop()
                at = to[e ^ 1]
                nxt[at] += 1
                continue
            path.append(e)
            at = to[e]


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Capacities between neighbours, and between a block and the last one of its parent.

    Where one of two neighbours stands in a boilerplate element, they are hardly tied.
    """
    out = []
    last: dict[tuple[tuple[int, ...], bool], int] = {}
    for i, block in enumerate(found):
        marked = block.bias <= IN_BOILERPLATE + IN_CONTENT
        if i:
            before = found[i - 1]
            apart = marked != (before.bias <= IN_BOILERPLATE + IN_CONTENT)
            out.append((i - 1, i, (ACROSS if apart else TIE) / max(1, _distance(before.path, block.path))))
        place = (block.path[:-1], marked)
        if place in last and last[place] < i - 1:
            out.append((last[place], i, TIE / 2))
        last[place] = i
    return out


def main_text(page: str | None) -> str:
    """Blocks of the main text, one a line; empty for NULL, empty and text-free pages."""
    found = blocks(page or "")
    kept = minimum_cut([content_score(b) for b in found], ties(found))
    return "\n".join(b.text() for b, keep in zip(found, kept, strict=True) if keep)


def extracted(pages: DataFrame, markup: str = "html") -> DataFrame:
    """Every row with ``text`` and ``n_chars`` (code points) of its whole page.

    Columns of ``pages`` named so are replaced. NULL and empty pages give an empty text.
    """

    @F.pandas_udf("string")
    def of(markups: pd.Series) -> pd.Series:
        return pd.Series([main_text(m) for m in markups], dtype=object)

    kept = pages.withColumn("_text", of(F.col(markup))).drop("text", "n_chars")
    return kept.withColumnRenamed("_text", "text").withColumn("n_chars", F.length("text").cast("bigint"))
