"""A page's HTML as blocks of text with what is known about each of them."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)
      |<svg(?=[\s/>])(?:[^>"']++|"[^"]*"|'[^']*')*+(?<=/)>
      |<(?P<raw>script|style|noscript|template|svg|iframe|object|textarea|select|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
      |<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
      |<[!?/][^>]*>""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
_MARK = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_MAY_HIDE = re.compile("hidden|display", re.IGNORECASE)
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

# Element names of HTML by role.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd mark meter q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: An element of these ends an open element of the same name beside it.
ALONE = set("p li dt dd tr td th option".split())
DROPPED = set("head".split())
BOILERPLATE_TAGS = set("nav footer aside form dialog menu button".split())
#: Of these, elements that some pages put around everything they have.
WRAPPERS = set("form aside dialog".split())
CONTENT_TAGS = set("article main".split())
BOILERPLATE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies "
    "copyright discussion disqus feedback footer form gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice overlay pager pagination popup promo promoted reactions recommended related replies reply respond responses "
    "search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
CONTENT_WORDS = set("article articlebody body content entry main post story text".split())

FEATURES = [
    "one", "log_words", "few_words", "link_share", "ends_sentence", "commas", "capitals", "digits", "symbols",
    "from_start", "from_end", "is_heading", "is_paragraph", "is_item", "content_name", "boilerplate_name", "only_links",
]


class Block(NamedTuple):
    text: str
    element: int  # number of the innermost open element
    tag: str
    linked: int  # characters inside links


class Element(NamedTuple):
    number: int
    name: str
    marks: frozenset[str]
    hidden: bool  # by itself or by an element around it
    parent: int  # number of the element around it, smaller than its own; the root is its own parent
    depth: int


def _hides(attrs: str) -> bool:
    """Whether an element's attributes, not words in their values, hide it."""
    if not _MAY_HIDE.search(attrs):
        return False
    for name, *values in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values)
        shown = _DISPLAY.findall(value) if name == "style" else []
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (shown and shown[-1].lower() == "none"):
            return True
    return False


class Page:
    """Blocks in page order; ``elements`` by number. Reading takes time in proportion to the source, however deep it is nested."""

    def __init__(self, source: str | None):
        self.blocks: list[Block] = []
        self.elements: list[Element] = [Element(0, "", frozenset(), False, 0, 0)]
        self._read(source or "")

    def _read(self, source: str) -> None:
        stack = [self.elements[0]]
        opened: Counter[str] = Counter()  # open elements by name
        text: list[str] = []
        linked = links = at = 0

        def flush() -> None:
            nonlocal text, linked
            if text:
                joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
                if joined and not stack[-1].hidden:
                    self.blocks.append(Block(joined, stack[-1].number, stack[-1].name, linked))
                text, linked = [], 0

        def add(piece: str) -> None:
            nonlocal linked
            text.append(piece)
            if links:
                linked += len(piece)

        def end(size: int) -> None:
            while len(stack) > size:
                opened[stack.pop().name] -= 1

        for m in _TAG.finditer(source):
            if m.start() > at:
                add(source[at : m.start()])
            at = m.end()
            if not m["name"]:
                continue
            name = m["name"].lower()
            if name == "a":
                links = 0 if m["close"] else 1
            if name in INLINE:
                if name == "br":
                    text.append(" ")
                continue
            flush()
            if m["close"]:
                if opened[name]:
                    while stack[-1].name != name:
                        end(len(stack) - 1)
                    end(len(stack) - 1)
                continue
            if name in ALONE:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        end(k)
                        break
                    if stack[k].name not in ALONE:
                        break
            elif len(stack) > 1 and stack[-1].name == "p":
                end(len(stack) - 1)  # a block element ends an open paragraph
            if name not in VOID and not m["attrs"].endswith("/"):
                attrs = m["attrs"]
                marks = frozenset(w for v in _MARK.findall(attrs) for w in _WORDS.findall("".join(v).lower())) if attrs else frozenset()
                above = stack[-1]
                hidden = above.hidden or name in DROPPED or _hides(attrs)
                element = Element(len(self.elements), name, marks, hidden, above.number, above.depth + 1)
                self.elements.append(element)
                stack.append(element)
                opened[name] += 1
        if at < len(source):
            add(source[at:])
        flush()

    def shares(self) -> np.ndarray:
        """Share of the page's text below each element."""
        total = [0] * len(self.elements)
        for block in self.blocks:
            total[block.element] += len(block.text)
        for element in reversed(self.elements[1:]):
            total[element.parent] += total[element.number]
        return np.array(total) / max(total[0], 1)

    def distance(self, a: int, b: int) -> int:
        """Steps between two elements."""
        steps = 0
        while a != b:
            if self.elements[a].depth < self.elements[b].depth:
                a, b = b, a
            a = self.elements[a].parent
            steps += 1
        return steps

    def evidence(self) -> tuple[np.ndarray, np.ndarray]:
        """What element names say of each block, and the features of the classifier.

        Names say +1 inside an article, -1 inside navigation and the like, 0 otherwise; the
        innermost such element counts. An element with more than half of the page's text
        is not taken for boilerplate by its class names, nor because it is a form, aside or dialog.
        """
        shares, n = self.shares(), len(self.blocks)
        says, rows = np.zeros(n), np.zeros((n, len(FEATURES)))
        # Of each element, with those around it: what it says, whether it is in an article, and by its marks good or bad.
        inherited = [(0, False, False, False)]
        for e in self.elements[1:]:
            said, inside, good, bad = inherited[e.parent]
            wide = shares[e.number] > 0.5
            if e.name in CONTENT_TAGS:
                inside, said = True, 1
            if e.name in BOILERPLATE_TAGS and not (wide and e.name in WRAPPERS) or (e.name == "header" and not inside):
                said = -1
            good = good or bool(e.marks & CONTENT_WORDS)
            bad = bad or (e.name != "body" and not wide and bool(e.marks & BOILERPLATE_WORDS))
            inherited.append((said, inside, good, bad))
        for k, block in enumerate(self.blocks):
            says[k], _, good, bad = inherited[block.element]
            text = block.text
            words = text.count(" ") + 1
            letters = max(1, len(text))
            rows[k] = [
                1, np.log1p(words), words < 5, min(1, block.linked / letters), text[-1] in ".!?\u2026\u3002\"'", text.count(",") / words,
                sum(map(str.isupper, text)) / letters, sum(map(str.isdigit, text)) / letters,
                sum(c in "|\u00a9\u00b7\u00bb\u2192>" for c in text) / letters, k / n, (n - 1 - k) / n,
                block.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), block.tag in ("p", "pre", "blockquote"), block.tag in ("li", "td", "th", "option"),
                good, bad, block.linked >= len(text),
            ]
        return says, rows
