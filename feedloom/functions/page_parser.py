"""Outline of one HTML page, for the pages the column expressions cannot read.

A helper for use inside a task: it takes one string and touches no Spark object.
Tags nest as they come: an end tag closes the nearest open element of its name
and all that was opened inside it, an end tag without one is ignored.
"""

from __future__ import annotations

from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

# HTML elements without content, and elements whose text is not shown.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN = frozenset("script style template rt rp".split())
VERBATIM = frozenset("pre textarea".split())
ASCII_SPACES = " \n\t\f\r"


class Element:
    __slots__ = ("name", "attrs", "start", "end", "last", "text_from", "text_to", "hidden_by")

    def __init__(self, name, attrs, start, text_from, hidden_by):
        self.name, self.attrs, self.start = name, attrs, start
        self.text_from, self.hidden_by = text_from, hidden_by
        self.end = self.last = self.text_to = None

    def matches(self, name, cls):
        return self.name == name and (cls is None or cls in self.attrs.get("class", "").split())


class PageOutline(HTMLParser):
    """Elements in document order, with their extent in the source and in the text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=False)
        self.html = html
        self.elements: list[Element] = []
        self.strings: list[str] = []
        self._open: list[Element] = []
        self._depth: Counter[str] = Counter()  # open elements by name
        self._data: list[str] = []
        self._line_starts = [0]
        for line in html.split("\n"):
            self._line_starts.append(self._line_starts[-1] + len(line) + 1)
        self.feed(html)
        self.close()
        self._end_text()
        while self._open:
            self._end_element(len(html))

    def find(self, name, cls=None, after=-1, before=None):
        """Index of the first match in elements[after + 1:before], or None."""
        stop = len(self.elements) if before is None else before
        for i in range(after + 1, stop):
            if self.elements[i].matches(name, cls):
                return i
        return None

    def text(self, i):
        element = self.elements[i]
        return "".join(self.strings[element.text_from:element.text_to])

    def _inside(self, names):
        return next((name for name in names if self._depth[name]), None)

    def _offset(self):
        line, column = self.getpos()
        return self._line_starts[line - 1] + column

    def _end_text(self):
        data = "".join(self._data)
        self._data.clear()
        if not data or self._inside(HIDDEN):
            return
        if not data.strip(ASCII_SPACES) and not self._inside(VERBATIM):
            data = "\n" if "\n" in data else " "
        self.strings.append(data)

    def _end_element(self, offset):
        element = self._open.pop()
        self._depth[element.name] -= 1
        element.end, element.last = offset, len(self.elements)
        element.text_to = len(self.strings)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        start = self._offset() + len(self.get_starttag_text())
        values = {name: value or "" for name, value in attrs}
        element = Element(tag, values, start, len(self.strings), self._inside(HIDDEN))
        self.elements.append(element)
        self._open.append(element)
        self._depth[tag] += 1
        if tag in VOID:
            self._end_element(start)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._end_element(self.elements[-1].start)

    def handle_endtag(self, tag):
        self._end_text()
        if self._depth[tag]:
            offset = self._offset()
            while self._open[-1].name != tag:
                self._end_element(offset)
            self._end_element(offset)

    def handle_data(self, data):
        self._data.append(data)

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            # Low codes are read as Windows-1252, as browsers do.
            char = bytes([code]).decode("windows-1252", "ignore") if code < 256 else ""
            self._data.append(char or chr(code))
        except (ValueError, OverflowError):
            self._data.append("\N{REPLACEMENT CHARACTER}")

    def handle_entityref(self, name):
        self._data.append(html5.get(f"{name};", f"&{name}"))

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):
            self._data.append(data[len("CDATA["):])
            self._end_text()


def outline(html):
    """The outline, or None where the markup cannot be parsed at all."""
    try:
        return PageOutline(html)
    except AssertionError:
        return None


def item_sources(html, container, item):
    """Inner source of every ``item`` element after the container's start; None without one."""
    page = outline(html)
    at = page and page.find(*container)
    if at is None:
        return None
    found = [e for e in page.elements[at + 1:] if e.matches(item, None)]
    return [(f"<{e.hidden_by}>" if e.hidden_by else "") + html[e.start:e.end] for e in found]


def attributes(html, name, attr):
    """The attribute of every element of a name that has it."""
    page = outline(html)
    return [e.attrs[attr] for e in page.elements if e.name == name and attr in e.attrs] if page else []


def read_fields(html, fields):
    """One value per field, None for a missing element; see ``markup.Text`` and ``Attr``."""
    page = outline(html)
    if page is None:
        return [None] * len(fields)
    values = []
    for kind, steps, attr in fields:
        at = -1
        for name, cls in steps:
            at = page.find(name, cls, after=at) if at is not None else None
        if at is None:
            values.append(None)
        else:
            values.append(page.text(at) if kind == "text" else page.elements[at].attrs.get(attr))
    return values
