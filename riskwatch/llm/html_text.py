"""HTML extraction (6): blocks labelled by a minimum cut.

A page becomes blocks of text with their place in the element tree. A linear
classifier with fixed weights (enclosing elements, class and id words, length,
share of linked text) gives each block a score, which is evidence and no verdict.
Scores, bounded by ``CAPACITY``, are terminal capacities: a positive one is the
cost of calling the block boilerplate, a negative one that of calling it content.
Blocks next to each other, and blocks of one parent, are joined by smoothness
edges, whose weights are of the size of the weaker kinds of evidence. The least
cut, found by blocking flows, separates content from boilerplate: a linked line,
or a paragraph whose class only hints at a notice, goes with what is around it,
and so does a line without any sign of its own. Blocks whose score exceeds all
their edges are on a known side of any least cut and are settled first.

The weights follow from what each kind of evidence has to outweigh. An element
that says what it is, or a class that is such a word, outweighs being in an
article with any length of text; a word that is only a part of a class, or stands
on a single paragraph, does not. Evidence for content does not add up: an article
in a main element is no more of an article. A page without a block in an element
of content (article, main, or class words like them) says nothing about where its
text is: there, a block counts as content until something speaks against it,
however short it is.

Each page is handled by itself, in Arrow batches: nothing is shuffled.

Defined results: a null or empty page, or one without content, has an empty text.
A null ``page_id`` or ``url`` stays null, repeated rows give a row each, other
columns are not read, an empty table gives an empty one. Broken markup is read as
far as it goes and in time linear in the page: unclosed elements end with the one
around them, a stray ``<`` is text, and from the first tag on whose quotes do not
close before the page ends, a tag ends at the next ``>``. Formulas (MathML) are text,
a space before each of their symbols; a formula's annotations, which repeat it,
drawings (svg) with their labels, and what a form holds are not.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from riskwatch.llm.common import ship

# Elements by their role, and words of class and id attributes.
RAW = frozenset(
    "script style template noscript title svg iframe object canvas audio video textarea "
    "annotation annotation-xml".split()
)
MATH_TOKEN = frozenset("mi mn mo ms mtext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose maction semantics msub msup "
    "msubsup munder mover munderover mmultiscripts mprescripts none mspace mtable mtr mtd mlabeledtr".split()
)
GOOD_ELEMENTS = {"article": 2.6, "main": 1.6, "h1": 0.4, "blockquote": 0.3}
BAD_ELEMENTS = frozenset(
    "nav footer aside form menu dialog header button select textarea fieldset option".split()
)
# What a bad word on one of these says holds for a line, not for a part of the page.
LINE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr figcaption caption pre blockquote".split()) | INLINE
BAD_WORDS = frozenset(
    "ad ads adv advert nav menu menus share social promo popup modal login signup banner footer masthead toolbar "
    "pager topbar sponsor cookies gdpr teaser teasers outbrain taboola replies".split()
)
# Words that name such a part when they stand alone, and little as a part of a name.
WEAK_WORDS = frozenset(
    "related tags widget search legal reply responses notice notices alert alerts header hint rail".split()
)
BAD_STEM = re.compile(
    r"comment|sidebar|advert|sponsored|cookie|consent|breadcrumb|newsletter|subscri|navbar|navigation|notification"
    r"|recommend|pagination|copyright|disclaimer|disqus|discussion"
)
GOOD_WORDS = frozenset("article content post entry story main".split())

# Weights, in the units of the edges. VERDICT outweighs an article's 2.6 and the
# 1.2 of a long text; the others leave room for the blocks around.
VERDICT, PART_OF_NAME, WEAK_PART, WEAK_LINE, GOOD_HINT = -5.0, -4.0, -2.0, -1.0, 1.6
MOST_GOOD, MOST_BAD, CAPACITY = 2.6, -6.0, 4.0
# PLAIN: the start on pages without an element of content; ROLE: what makes one.
START, PLAIN, ROLE = -0.6, 0.9, 1.5
PER_WORD, MOST_WORDS, PER_LINKED = 0.03, 40, -2.4
NEXT, ACROSS, SIBLING = 0.9, 0.2, 0.5

# Each tries once, without falling back, so that a failure costs one look ahead.
_SPECIAL = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>", re.DOTALL)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_TEXT = re.compile(r"[^<]++|<")
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z]+")


@dataclass(frozen=True)
class Block:
    text: str
    score: float
    parent: int
    section: int
    role: bool


def _word_weight(words: list[str], line: bool) -> float:
    """What one class or id name says, given as its words."""
    bad, weak = not BAD_WORDS.isdisjoint(words), not WEAK_WORDS.isdisjoint(words)
    if len(words) == 1 and (bad or weak and not line):
        return VERDICT
    if bad:
        return PART_OF_NAME
    if weak:
        return WEAK_LINE if line else WEAK_PART
    return 0.0


def _attribute_weight(tag: str, rest: str) -> tuple[float, float]:
    """Good and bad evidence of an element's attributes."""
    good, bad = 0.0, VERDICT if _HIDDEN.search(rest) else 0.0
    for names in _NAMES.findall(rest):
        for name in "".join(names).lower().split():
            words = [w for w in _SPLIT.split(name) if w]
            if BAD_STEM.search(name):
                bad += VERDICT
            else:
                bad += _word_weight(words, tag in LINE)
            if not GOOD_WORDS.isdisjoint(words):
                good = GOOD_HINT
    return good, bad


@dataclass(frozen=True)
class Open:
    """An open element: evidence of it and all around it, its number, that of its
    section, and whether it is in a link."""

    tag: str
    good: float
    bad: float
    number: int
    section: int
    linked: bool


class _Reader:
    """Walks over a page's tokens and collects its blocks.

    Beside the stack of open elements it keeps where in the stack each tag, the
    blocks and the elements with a role are, so that no step searches the stack.
    """

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open = [Open("", 0.0, 0.0, 0, 0, False)]
        self.places: dict[str, list[int]] = {}
        self.block_places, self.role_places = [0], [0]
        self.parts: list[str] = []
        self.linked = 0
        self.elements = 0

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            around = self.open[self.block_places[-1]]
            words = text.count(" ") + 1
            score = START + around.good + around.bad + PER_WORD * min(words, MOST_WORDS)
            score += PER_LINKED * min(1.0, self.linked / len(text))
            self.blocks.append(Block(text, score, around.number, around.section, around.good >= ROLE))
        self.parts, self.linked = [], 0

    def text(self, raw: str) -> None:
        plain = unescape(raw) if "&" in raw else raw
        self.parts.append(plain)
        if self.open[-1].linked:
            self.linked += len(plain)

    def start(self, tag: str, rest: str) -> None:
        if tag in MATH_TOKEN:
            self.parts.append(" ")
        if tag not in INLINE:
            self.flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                self._close(tag, self.block_places[-1])
        if tag in VOID or rest.endswith("/"):
            return
        self.elements += 1
        above = self.open[-1]
        good, bad = GOOD_ELEMENTS.get(tag, 0.0), VERDICT if tag in BAD_ELEMENTS else 0.0
        if rest and "=" in rest or "hidden" in rest:
            more, less = _attribute_weight(tag, rest)
            good, bad = max(good, more), bad + less
        good, bad = min(MOST_GOOD, above.good + good), max(MOST_BAD, above.bad + bad)
        own = tag not in INLINE and (good, bad) != (above.good, above.bad)
        place, section = len(self.open), self.elements if own else above.section
        self.open.append(Open(tag, good, bad, self.elements, section, above.linked or tag == "a"))
        self.places.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.block_places.append(place)
        if tag in GOOD_ELEMENTS or tag in BAD_ELEMENTS:
            self.role_places.append(place)

    def _close(self, tag: str, least: int) -> None:
        """Ends the innermost element of the tag, if it is at ``least`` or above it
        in the stack, and all in it."""
        at = self.places.get(tag)
        if not at or at[-1] < least:
            return
        place = at[-1]
        for inner in self.open[place:]:
            self.places[inner.tag].pop()
        del self.open[place:]
        for places in (self.block_places, self.role_places):
            while places[-1] >= place:
                places.pop()

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if tag not in VOID:
            # An end tag stays inside the element that carries a role of its own.
            role = tag in GOOD_ELEMENTS or tag in BAD_ELEMENTS
            self._close(tag, 1 if role else self.role_places[-1])


def blocks_of(html: str) -> list[Block]:
    reader, at, size = _Reader(), 0, len(html)
    last_end, quoted = html.rfind(">"), True
    while at < size:
        if html.startswith(("<!--", "<![CDATA["), at) or at <= last_end and html.startswith(("<!", "<?"), at):
            at = _SPECIAL.match(html, at).end()
            continue
        tag_start = _TAG.match(html, at) if at <= last_end else None
        if tag_start is None:
            token = _TEXT.match(html, at)
            at = token.end()
            reader.text(token.group())
            continue
        begin = tag_start.end()
        whole = _QUOTED.match(html, begin) if quoted else None
        if whole is None:
            quoted = False
        stop = whole.end() - 1 if whole else html.find(">", begin)
        rest, at = html[begin:stop], stop + 1
        tag = tag_start.group(2).lower()
        if tag in ("head", "body", "html"):
            continue
        if tag_start.group(1):
            reader.end(tag)
        elif tag in RAW and not rest.endswith("/"):
            closing = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
            reader.flush()
            at = closing.end() if closing else size
        else:
            reader.start(tag, rest)
    reader.flush()
    return reader.blocks


def _edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours in the page, and the last block before it of the same parent."""
    found, last = [], {}
    for k, block in enumerate(blocks):
        if k:
            found.append((k - 1, k, NEXT if blocks[k - 1].section == block.section else ACROSS))
        before = last.get(block.parent, k)
        if before < k - 1:
            found.append((before, k, SIBLING))
        last[block.parent] = k
    return found


def least_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Per node: on the content side of a least cut."""
    near: list[dict[int, float]] = [{} for _ in scores]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    score, side = list(scores), [None] * len(scores)
    check = deque(range(len(scores)))
    while check:
        k = check.popleft()
        if side[k] is None and abs(score[k]) > sum(near[k].values()):
            side[k] = score[k] > 0
            for other, weight in near[k].items():
                score[other] += weight if side[k] else -weight
                del near[other][k]
                check.append(other)
            near[k] = {}
    if None in side:
        _augment(score, near, side)
    return side


def _augment(score: list[float], near: list[dict[int, float]], side: list) -> None:
    """Settles the open nodes by blocking flows along shortest paths."""
    left = [k for k, s in enumerate(side) if s is None]
    source = {k: max(0.0, score[k]) for k in left}
    sink = {k: max(0.0, -score[k]) for k in left}
    others = {k: list(near[k]) for k in left}
    tiny = 1e-9
    while True:
        level = {k: 0 for k in left if source[k] > tiny}
        queue, reached = deque(level), False
        while queue:
            k = queue.popleft()
            reached = reached or sink[k] > tiny
            for other in others[k]:
                if near[k][other] > tiny and other not in level:
                    level[other] = level[k] + 1
                    queue.append(other)
        if not reached:
            break
        tried = dict.fromkeys(level, 0)
        for start in [k for k, steps in level.items() if steps == 0]:
            path = [start]
            while path and source[start] > tiny:
                k = path[-1]
                if sink[k] > tiny:
                    flow = min(source[start], sink[k], *(near[a][b] for a, b in zip(path, path[1:], strict=False)))
                    source[start] -= flow
                    sink[k] -= flow
                    for a, b in zip(path, path[1:], strict=False):
                        near[a][b] -= flow
                        near[b][a] += flow
                    path = [start]
                    continue
                while tried[k] < len(others[k]):
                    other = others[k][tried[k]]
                    if near[k][other] > tiny and level[other] == level[k] + 1:
                        path.append(other)
                        break
                    tried[k] += 1
                else:
                    path.pop()
                    if path:
                        tried[path[-1]] += 1
    for k in left:
        side[k] = k in level


def labels(blocks: list[Block]) -> tuple[list[float], list[bool]]:
    """The blocks' capacities, and which of them the least cut calls content."""
    more = 0.0 if any(b.role for b in blocks) else PLAIN - START
    scores = [max(-CAPACITY, min(CAPACITY, b.score + more)) for b in blocks]
    return scores, least_cut(scores, _edges(blocks))


def main_text(html: str | None) -> str:
    blocks = blocks_of(html) if html else []
    return " ".join(b.text for b, kept in zip(blocks, labels(blocks)[1], strict=True) if kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    ship(pages.sparkSession)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
