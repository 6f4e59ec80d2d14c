"""Main-text extraction from web pages by minimum-cut labelling.

A page is read into text blocks, each with its element path. A linear
classifier on the block (tags and class names around it, link share, length,
heading or paragraph) gives the cost of calling it boilerplate or content;
the costs are terminal capacities. Neighbouring blocks are joined by edges
whose capacity grows with what they share of their element paths, and blocks
of one parent element are chained too. The minimum cut, found by maximum flow
with blocking flows on level graphs, parts content from boilerplate; it can
differ from the classifier where a block's surroundings outweigh it.

Boilerplate marks come from tags and from names; a layout name (``has-sidebar``,
``with-comments``) marks nothing, and a heading in an article's header is not
marked by that header. An article or main element that holds most of the text
of all of them loses the marks above it if less lies outside marks; on a page
without such an element, and with less than a tenth of its text outside marks,
a name's mark fades where its element holds more than half of the text.

Scripts, styles, comments, templates, titles, form controls and other elements
without readable text never become blocks. Character references are decoded,
white space inside a block becomes one space, blocks are joined by one newline
in page order.

Defined cases: a null or empty page, or one without text, gives an empty text;
markup that is cut off at the end is dropped; unclosed and stray tags are
accepted as browsers accept them, a quote that is never closed ends with its
tag, and elements deeper than ``MAX_DEPTH`` stand beside each other; equal pages give equal texts; ids and urls
are passed through, null or not; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements by their meaning (fixed values of the HTML language).
HIDDEN = frozenset("script style noscript template title svg math iframe object select textarea button option "
                   "datalist canvas audio video head".split())
RAW = frozenset("script style title textarea noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT_TAGS = frozenset({"article", "main"})
BOILERPLATE_TAGS = frozenset("nav footer aside form menu fieldset dialog".split())
# An opening tag that ends an open paragraph or item (fixed values).
ENDS_P = BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "html", "body"}
ENDS_ITEM = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th")}
# Words of class, id and role names; a name is split at non-letters and case changes (fixed values).
BOILERPLATE_NAMES = frozenset("""ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs byline
    comment comments commentlist consent cookie cookies copyright dialog disclaimer discussion disqus footer gdpr
    header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager
    pagination popup privacy promo promoted promotion recommend recommendations recommended related replies reply
    respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser
    toolbar topbar tracking warning widget
    anzeige anzeigen datenschutz fusszeile hinweis kommentar kommentare kopfzeile seitenleiste werbung
    avis commentaire commentaires pied publicite publicité
    anuncio anuncios aviso barra comentario comentarios pie publicidad""".split())
# Those of them that also name parts of an article (fixed values).
VAGUE_NAMES = frozenset("""avis aviso banner barra byline dialog disclaimer header hinweis modal notice notices overlay
    pie pied recommended search share sharing skip social tags teaser warning widget""".split())
CONTENT_NAMES = frozenset("article body content entry main post story text".split())

MARKUP = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
STOP = re.compile(r"[>\"']")
MAX_DEPTH = 512            # elements below this depth become siblings
OPEN_END = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")
NAMES = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDES = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
LAYOUT_NAME = re.compile(r"(?:has|with|without|no)(?:[-_]|(?=[A-Z]))")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


PROSE = 40                 # characters without links that make a vaguely named box a part of its article


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    depth: int
    boilerplate: float = 0    # strength of the boilerplate marks here and above
    own: int = 0              # what this element adds to it
    named: bool = False       # marked by its names alone
    vague: bool = False       # and by none that names only boilerplate
    headed: int = 0           # marks here and above of headers inside the content
    content: bool = False     # inside an element marked as the content
    hidden: bool = False
    link: bool = False


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _child(parent: Element, tag: str, attributes: str) -> Element:
    if parent.depth >= MAX_DEPTH:
        parent = parent.parent
    names: set[str] = set()
    if attributes:
        for found in NAMES.finditer(attributes):
            for name in next(v for v in (*found.groups(), "") if v is not None).split():
                if not LAYOUT_NAME.match(name):
                    names.update(x.lower() for x in NAME_PART.findall(name))
    own, headed, marked = 0, parent.headed, names & BOILERPLATE_NAMES
    if tag in HEADINGS:
        own, headed = -headed, 0
    marks = parent.boilerplate + own
    inner = parent.content or tag in CONTENT_TAGS
    if (tag in BOILERPLATE_TAGS or marked and tag not in ("body", "html", *CONTENT_TAGS)
            or tag == "header" and not parent.content):
        marks, own = marks + 1, own + 1
        if parent.content and marked == {"header"} and tag not in BOILERPLATE_TAGS:
            headed += 1
    elif names & CONTENT_NAMES and not marks:
        inner = True
    return Element(tag, parent, parent.depth + 1, marks, own, own > 0 and tag not in BOILERPLATE_TAGS and tag != "header",
                   own > 0 and tag not in BOILERPLATE_TAGS and tag != "header" and marked <= VAGUE_NAMES, headed, inner, parent.hidden or tag in HIDDEN or bool(attributes and HIDES.search(attributes)),
                   parent.link or tag == "a")


def settle_marks(blocks: list[Block], texts: list[str]) -> None:
    """Weigh the marks by what the marked elements hold of the page's text."""
    if not any(b.element.boilerplate for b in blocks):
        return
    held: dict[Element, int] = {}
    links: dict[Element, int] = {}
    clean = unmarked = framed = 0
    for b, text in zip(blocks, texts):
        e = b.element
        while e is not None and e not in held:
            held[e] = links[e] = 0
            e = e.parent
        held[b.element] += len(text)
        links[b.element] += min(b.linked, len(text))
        if not b.element.boilerplate:
            unmarked += len(text)
            clean += len(text) * b.element.content
    down = sorted(held, key=lambda e: e.depth)
    for e in reversed(down):
        if e.parent is not None:
            held[e.parent] += held[e]
            links[e.parent] += links[e]
    total, framed_in = held[down[0]], {None: False}
    for e in down:                                         # text of the outermost articles and main elements
        framed_in[e] = framed_in[e.parent] or e.tag in CONTENT_TAGS
        if framed_in[e] and not framed_in[e.parent]:
            framed += held[e]
    trapped = {e for e in down if e.tag in CONTENT_TAGS and e.boilerplate and held[e] > unmarked and 2 * held[e] >= framed}
    fades = not clean and not trapped and 10 * unmarked < total
    for e in down:
        if e in trapped:
            e.boilerplate = 0
        elif e.parent is not None:
            own = e.own
            if e.vague and own > 0 and e.parent.content and held[e] >= PROSE and 5 * links[e] <= held[e]:
                own = 0                                    # prose of the article, whatever its box is called
            if fades and e.named and own > 0:
                own *= min(1.0, max(0.0, 3 - 4 * held[e] / total))       # full up to a half, none from three quarters
            e.boilerplate = max(0, e.parent.boilerplate + own)


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order; blocks without visible text are left out."""
    page = OPEN_END.sub("", page)
    root = Element("", None, 0)
    here, blocks, block, at, size = root, [], None, 0, len(page)

    def add(text: str) -> None:
        nonlocal block
        if not text or here.hidden:
            return
        if block is None:
            owner = here
            while owner.parent is not None and owner.tag not in BLOCK:
                owner = owner.parent
            block = Block(owner)
            blocks.append(block)
        block.parts.append(text)
        if here.link:
            block.linked += len(text)

    last = page.rfind(">")                     # no tag ends behind it
    unclosed = ""
    while at < size:
        found = MARKUP.search(page, at)
        if found is None or found.start() > last:          # text only, or markup that is cut off
            add(page[at:] if found is None else page[at:found.start()])
            break
        if found.start() > at:
            add(page[at:found.start()])
        if found[2] is None:                               # comment, declaration or instruction
            end = page.find("-->" if found[0] == "<!--" else ">", found.end())
            at = size if end < 0 else end + (3 if found[0] == "<!--" else 1)
            continue
        at = found.end()
        while True:                                        # to the tag's end, past quoted values
            stop = STOP.search(page, at)
            if stop is None or stop[0] == ">":
                break
            at = stop.end()
            if page[max(found.end(), stop.start() - 64):stop.start()].rstrip().endswith("="):
                end = page.find(stop[0], at) if stop[0] not in unclosed else -1
                if end < 0:                                # never closed: the tag ends at its first bracket
                    unclosed += stop[0]
                    end = page.find(">", at)
                    at = size if end < 0 else end
                    break
                at = end + 1
        end = page.find(">", at)
        if end < 0:                                        # cut off
            break
        attributes, at = page[found.end():end], end + 1
        tag = found[2].lower()
        if found[1]:
            target = here
            while target.parent is not None and target.tag != tag:
                target = target.parent
            if target.parent is not None:
                here = target.parent
            if tag in BLOCK:
                block = None
            continue
        if tag in BLOCK:
            block = None
            if tag in ENDS_P:
                here = _closed(here, ("p",))
            if tag in ENDS_ITEM:
                here = _closed(here, ENDS_ITEM[tag])
        if tag == "br":
            add(" ")
        elif tag not in VOID and not attributes.endswith("/"):
            here = _child(here, tag, attributes)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
                here = here.parent
    return [b for b in blocks if b.text()]


def _closed(here: Element, tags: tuple[str, ...]) -> Element:
    """Close an open element of ``tags`` that no container stands in front of."""
    look = here
    while look.parent is not None:
        if look.tag in tags:
            return look.parent
        if look.tag in BLOCK:
            return here
        look = look.parent
    return here


def content_score(block: Block, text: str, has_container: bool, plain: bool = False) -> float:
    """Log-odds that a block is content: the classifier behind the terminal capacities. ``plain``: the page
    has no marks and no links, so nothing speaks against its text."""
    e, words = block.element, text.count(" ") + 1
    score = (0.5 if plain else -0.5) + 0.6 * math.log(words)
    if has_container:
        score += 4.0 if e.content else -4.0
    if e.tag == "p" or e.tag in HEADINGS or e.tag in ("pre", "blockquote"):
        score += 1.0
    score -= 8.0 * min(e.boilerplate, 2)
    raw = sum(map(len, block.parts))
    score -= 5.0 * (block.linked / max(1, raw)) * (0.25 if e.content else 1.0)
    return score


def proximity(a: Element, b: Element) -> float:
    """Share of two element paths that is common, from 0 to 1."""
    x, y = a, b
    while x.depth > y.depth:
        x = x.parent
    while y.depth > x.depth:
        y = y.parent
    while x is not y:
        x, y = x.parent, y.parent
    return x.depth / max(a.depth, b.depth, 1)


def _marks(e: Element) -> tuple[int, bool]:
    return e.boilerplate, e.content


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours on the page, and the next block of the same
    parent. An edge across a change of marks (leaving an article, entering a
    menu) is weak."""
    edges = []
    last_of: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            before = blocks[i - 1].element
            near = proximity(before, block.element)
            weight = 1.5 * near * near
            edges.append((i - 1, i, weight if _marks(before) == _marks(block.element) else 0.1 * weight))
        parent = id(block.element.parent)
        j = last_of.get(parent)
        if j is not None and j != i - 1 and _marks(blocks[j].element) == _marks(block.element):
            edges.append((j, i, 0.5))
        last_of[parent] = i
    return edges


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side (content) of the minimum cut. A positive score is the
    capacity from the source, a negative one that to the sink; an edge has its
    capacity both ways."""
    n = len(scores)
    excess, deficit = [max(s, 0.0) for s in scores], [max(-s, 0.0) for s in scores]
    residual: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        if weight > 0:
            residual[a][b] = residual[a].get(b, 0.0) + weight
            residual[b][a] = residual[b].get(a, 0.0) + weight
    tiny = 1e-9
    while True:
        level = [0 if x > tiny else -1 for x in excess]
        front, met = [i for i in range(n) if not level[i]], False
        while front and not met:                            # up to the nearest sinks
            met = any(deficit[a] > tiny for a in front)
            ahead = []
            if not met:
                for a in front:
                    for b, room in residual[a].items():
                        if room > tiny and level[b] < 0:
                            level[b] = level[a] + 1
                            ahead.append(b)
            front = ahead if not met else front
        if not met:
            return [x >= 0 for x in level]
        _blocking_flow(level, residual, excess, deficit, tiny)


def _blocking_flow(level: list[int], residual: list[dict[int, float]], excess: list[float], deficit: list[float],
                   tiny: float) -> None:
    """Push flow along the level graph until no path through it is left."""
    arcs = [None] * len(level)
    for source in [i for i, x in enumerate(excess) if x > tiny]:
        path = [source]
        while path and excess[source] > tiny:
            a = path[-1]
            if deficit[a] > tiny:
                flow = min(excess[source], deficit[a], *(residual[x][y] for x, y in zip(path, path[1:])))
                excess[source] -= flow
                deficit[a] -= flow
                keep = len(path)
                for i in range(len(path) - 1, 0, -1):
                    x, y = path[i - 1], path[i]
                    residual[x][y] -= flow
                    residual[y][x] += flow
                    if residual[x][y] <= tiny:
                        keep = i
                del path[keep:]
                continue
            if arcs[a] is None:
                arcs[a] = [b for b in residual[a] if level[b] == level[a] + 1]
            while arcs[a] and residual[a][arcs[a][-1]] <= tiny:
                arcs[a].pop()
            if arcs[a]:
                path.append(arcs[a][-1])
            else:
                path.pop()
                if path:
                    arcs[path[-1]].pop()


def main_text(page: str | None) -> str:
    """The main text of one whole page."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    texts = [b.text() for b in blocks]
    settle_marks(blocks, texts)
    container = any(b.element.content and not b.element.boilerplate for b in blocks)
    plain = not any(b.linked or b.element.boilerplate for b in blocks)
    scores = [content_score(b, t, container, plain) for b, t in zip(blocks, texts)]
    kept = min_cut(scores, edges_of(blocks))
    return "\n".join(t for t, keep in zip(texts, kept) if keep)


def extract(pages: DataFrame, keep: list[str], page: str = "html", out: str = "text") -> DataFrame:
    """``keep`` columns and the main text of every page; a map, nothing is shuffled."""
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(len(keep))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*keep, out])

    return pages.select(*keep, F.col(page).alias("__page")).mapInArrow(run, schema)
