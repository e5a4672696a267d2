"""Leaf blocks of a page: stretches of text between block tags, with the elements around them."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Tags of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("head iframe math noembed noframes noscript object script style svg template textarea title".split())
#: Elements that a new one of the kind ends.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"thead"}, "tbody": {"thead", "tbody"}, "tfoot": {"tbody"},
}
#: An end tag that is missing is not looked for beyond these.
_SCOPES = frozenset("article aside body div footer form header html main nav section table ul ol dl".split())
#: What may stand outside of all other elements ends an open head.
_BODY = frozenset("body article aside div footer form header main nav section table ul ol dl p h1 h2 h3 h4 h5 h6".split())
_WORD = re.compile(r"[a-z]+")


Marks = tuple[str, ...]


@dataclass(eq=False, slots=True)
class Element:
    """An element around a block: its marks (tag, and words of class, id and role after a dot) and the element around it."""

    marks: Marks
    above: Element | None
    #: Marks that no element above has.
    fresh: Marks
    depth: int


def nested(around: tuple[Marks, ...]) -> Element | None:
    """Elements of these marks, the outermost first, within each other; the innermost."""
    element, seen = None, set()
    for depth, marks in enumerate(around, 1):
        element = Element(marks, element, tuple(dict.fromkeys(m for m in marks if m not in seen)), depth)
        seen.update(marks)
    return element


@dataclass
class Block:
    text: str
    #: The innermost of the elements around it that are no inline ones. Blocks share elements, so a page of any depth is small.
    within: Element | None
    linked: int

    @property
    def around(self) -> tuple[Marks, ...]:
        """Marks of the elements around it from the outermost."""
        out, element = [], self.within
        while element:
            out.append(element.marks)
            element = element.above
        return tuple(reversed(out))


@dataclass
class _Open:
    tag: str
    marks: Marks
    #: The innermost element that is no inline one, this one included.
    element: Element | None


@dataclass
class _Reader(HTMLParser):
    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self._open: list[_Open] = []
        self._tags: Counter[str] = Counter()
        self._marks: Counter[str] = Counter()
        self._held: list[str] = []
        self._linked = self._unseen = self._links = 0

    def _end_block(self) -> None:
        if self._held:
            text = " ".join("".join(self._held).split())
            if text:
                within = self._open[-1].element if self._open else None
                self.blocks.append(Block(text, within, min(self._linked, len(text))))
        self._held, self._linked = [], 0

    def _close(self, place: int) -> None:
        gone = self._open[place:]
        if any(e.tag not in INLINE for e in gone):
            self._end_block()
        self._unseen -= sum(e.tag in UNSEEN for e in gone)
        self._links -= sum(e.tag == "a" for e in gone)
        for e in gone:
            self._tags[e.tag] -= 1
            if e.tag not in INLINE:
                self._marks.subtract(e.marks)
        del self._open[place:]

    def _close_last(self, tags: set[str], scopes: frozenset[str]) -> None:
        if not any(self._tags[tag] for tag in tags):
            return
        for place in range(len(self._open) - 1, -1, -1):
            if self._open[place].tag in tags:
                self._close(place)
                return
            if self._open[place].tag in scopes:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _BODY and self._unseen and self._tags["head"]:
            self._close_last({"head"}, frozenset())
        if tag not in INLINE:
            self._end_block()
            self._close_last({"p"}, _SCOPES)
            if tag in SIBLINGS:
                self._close_last(SIBLINGS[tag], _SCOPES)
        elif tag in ("br", "wbr", "img"):
            if tag == "br":
                self._held.append(" ")
        elif tag == "a" and self._links:
            self._close_last({"a"}, _SCOPES)
        if tag in VOID:
            return
        words = [w for name, value in attrs if name in ("class", "id", "role") and value for w in _WORD.findall(value.lower())]
        marks, element = (tag, *("." + w for w in words)), self._open[-1].element if self._open else None
        if tag not in INLINE:
            fresh = tuple(m for m in dict.fromkeys(marks) if self._marks[m] <= 0)
            element = Element(marks, element, fresh, element.depth + 1 if element else 1)
            self._marks.update(marks)
        self._open.append(_Open(tag, marks, element))
        self._tags[tag] += 1
        self._unseen += tag in UNSEEN
        self._links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        # As browsers do: the slash has no meaning outside of foreign elements.
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math") or self._unseen and tag not in VOID and tag not in ("script", "style"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self._held.append(" ")
            return
        if not self._tags[tag]:
            return
        for place in range(len(self._open) - 1, -1, -1):
            if self._open[place].tag == tag:
                self._close(place)
                return
            # An inline end tag does not close blocks.
            if tag in INLINE and self._open[place].tag not in INLINE:
                return

    def handle_data(self, data):
        if not self._unseen:
            self._held.append(data)
            if self._links:
                self._linked += len(data.strip())

    def close(self):
        super().close()
        self._end_block()


def blocks_of(html: str) -> list[Block]:
    """The blocks with text, in page order: character references decoded, white space made one space, trimmed."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.blocks
