"""Reading marked elements out of one page; used inside Arrow batches only.

Covers the selector forms the rule tables use: ``tag``, ``.class``, ``#id``,
their combinations, ``[attribute]`` and ``:first-child``, in comma lists.
"""

import re
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

_FORM = re.compile(
    r"(?P<tag>[a-z][a-z0-9-]*)?(?:\.(?P<cls>[\w-]+))?(?:#(?P<id>[\w-]+))?(?:\[(?P<attr>[\w-]+)\])?(?P<first>:first-child)?"
)
# Fixed values of HTML: elements without content, and which open element a
# new start tag closes.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
_CLOSES = {"li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_CLOSE_STOPS = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_HIDDEN = frozenset(("script", "style", "template"))


class Selector(NamedTuple):
    tag: str | None
    cls: str | None
    id: str | None
    attr: str | None
    first: bool


@lru_cache(maxsize=1024)
def parse_selector(text: str) -> tuple[Selector, ...]:
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        m = _FORM.fullmatch(part)
        if not m:
            raise ValueError(f"unsupported selector: {part}")
        out.append(Selector(m["tag"], m["cls"], m["id"], m["attr"], bool(m["first"])))
    return tuple(out)


class Element:
    __slots__ = ("index", "tag", "attrs", "classes", "first", "start", "end", "text_from", "text_to", "last")

    def __init__(self, index, tag, attrs, first, start, text_from):
        self.index, self.tag, self.attrs, self.first = index, tag, attrs, first
        self.classes = (attrs.get("class") or "").split()
        self.start, self.text_from = start, text_from
        self.end = self.text_to = self.last = -1

    def matches(self, selectors) -> bool:
        return any(
            (s.tag is None or s.tag == self.tag)
            and (s.cls is None or s.cls in self.classes)
            and (s.id is None or s.id == self.attrs.get("id"))
            and (s.attr is None or s.attr in self.attrs)
            and (not s.first or self.first)
            for s in selectors
        )


class Page(HTMLParser):
    """Elements of a page in document order with their text and source ranges."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.elements: list[Element] = []
        self.pieces: list[str] = []
        self._open: list[Element] = []
        self._text: list[str] = []
        self._children = [False]
        self._lines = [0]
        for m in re.finditer("\n", html):
            self._lines.append(m.end())
        self.feed(html)
        self.close()
        self._flush()
        self._close_to(0, len(html))

    def _offset(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def _flush(self):
        text = "".join(self._text).strip()
        self._text.clear()
        if text and not any(e.tag in _HIDDEN for e in self._open):
            self.pieces.append(text)

    def _close_to(self, depth: int, end: int):
        while len(self._open) > depth:
            e = self._open.pop()
            self._children.pop()
            e.end, e.text_to, e.last = end, len(self.pieces), len(self.elements)

    def _close_implied(self, tag: str, at: int):
        closing = _CLOSES.get(tag, set()) | ({"p"} if tag in _BLOCK else set())
        stops = _CLOSE_STOPS.get(tag, set())
        for depth in range(len(self._open) - 1, -1, -1):
            name = self._open[depth].tag
            if name in closing:
                self._close_to(depth, at)
            elif name in stops or (name in _BLOCK and tag not in _CLOSES):
                return

    def handle_starttag(self, tag, attrs):
        self._flush()
        at = self._offset()
        self._close_implied(tag, at)
        e = Element(len(self.elements), tag, dict(reversed(attrs)), not self._children[-1], at, len(self.pieces))
        self._children[-1] = True
        self.elements.append(e)
        if tag in _VOID:
            e.end, e.text_to, e.last = at + len(self.get_starttag_text()), len(self.pieces), len(self.elements)
        else:
            self._open.append(e)
            self._children.append(False)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth].tag == tag:
                self._flush()
                close = self.html.find(">", self._offset())
                self._close_to(depth, len(self.html) if close < 0 else close + 1)
                return

    def handle_data(self, data):
        self._text.append(data)

    def handle_comment(self, data):
        self._flush()

    def select(self, selector: str, inside: Element | None = None):
        """Matching elements in document order."""
        wanted = parse_selector(selector)
        scope = self.elements if inside is None else self.elements[inside.index + 1 : inside.last]
        return (e for e in scope if e.matches(wanted))

    def first(self, selector: str, inside: Element | None = None) -> Element | None:
        return next(self.select(selector, inside), None)

    def text(self, e: Element | None, separator: str) -> str:
        return "" if e is None else separator.join(self.pieces[e.text_from : e.text_to])

    def source(self, e: Element) -> str:
        return self.html[e.start : e.end]
