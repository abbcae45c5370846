"""HTML as a stream of tokens, read by states as browsers do; plain Python without any state of its own."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

SPACE = " \t\n\f\r"
_NAME = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
_BETWEEN = re.compile(r"[ \t\n\f\r/]*")
_ATTRIBUTE = re.compile(r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*")
_EQUALS = re.compile(r"[ \t\n\f\r]*=[ \t\n\f\r]*")
_UNQUOTED = re.compile(r"[^ \t\n\f\r>]*")
_SPACES = re.compile(r"[ \t\n\f\r\xa0]+")

# Elements whose content has no tags; in the second group character references count.
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes"}
RAW_TEXT = {"textarea", "title"}
# Elements that begin and end a line.
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog",
    "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup",
    "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
CELLS = {"td", "th"}


class Token(NamedTuple):
    """``kind`` is start, end, text, raw or comment; ``name`` the element, ``raw`` text's included."""

    kind: str
    name: str
    text: str
    attributes: tuple[tuple[str, str], ...] = ()


def _tag_end(source: str, at: int) -> tuple[int, list[tuple[str, str]]] | None:
    """Where the tag ends whose name ends at ``at``, and its attributes; None if it never does.

    A quoted value may hold ``>``; of an attribute given twice the first counts.
    """
    attributes: dict[str, str] = {}
    while True:
        at = _BETWEEN.match(source, at).end()
        if at >= len(source):
            return None
        if source[at] == ">":
            return at + 1, list(attributes.items())
        name = _ATTRIBUTE.match(source, at)
        at, value = name.end(), ""
        if equals := _EQUALS.match(source, at):
            at = equals.end()
            quote = source[at : at + 1]
            if quote and quote in "\"'":
                end = source.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = source[at + 1 : end], end + 1
            else:
                unquoted = _UNQUOTED.match(source, at)
                value, at = unquoted.group(), unquoted.end()
        attributes.setdefault(name.group().lower(), html.unescape(value))


def tokens(source: str) -> Iterator[Token]:
    """The tokens of a page, each place of it in one token or dropped.

    States: text, tag, comment, raw element. A comment or raw element that is not
    closed reaches to the end of the page, a tag that is not closed is dropped to
    the end, ``<`` that begins none of these is text. ``<!`` and ``<?`` other than
    comments, and ``</`` before anything but a letter, reach to the next ``>``.
    Character references are decoded in text and attribute values; one that no
    standard names stays as it is, a numeric one out of range becomes U+FFFD.
    """
    at, text_from, size = 0, 0, len(source)

    def text(end: int) -> Iterator[Token]:
        if end > text_from:
            yield Token("text", "", html.unescape(source[text_from:end]))

    while (at := source.find("<", at)) >= 0:
        after = source[at + 1 : at + 2]
        closing = after == "/"
        name = _NAME.match(source, at + 2 if closing else at + 1)
        if name:
            yield from text(at)
            found = _tag_end(source, name.end())
            if found is None:
                return
            at, attributes = found
            text_from, element = at, name.group().lower()
            if closing:
                yield Token("end", element, "")
                continue
            yield Token("start", element, "", tuple(attributes))
            if element in RAW or element in RAW_TEXT:
                close = re.compile(f"</{element}(?=[ \t\n\f\r/>])", re.IGNORECASE).search(source, at)
                end = close.start() if close else size
                content = source[at:end]
                if content:
                    yield Token("raw", element, html.unescape(content) if element in RAW_TEXT else content)
                at = text_from = end
        elif source.startswith("<!--", at):
            yield from text(at)
            end = source.find("-->", at + 2)
            yield Token("comment", "", source[at + 4 : end if end >= 0 else size])
            at = text_from = end + 3 if end >= 0 else size
        elif closing or after in ("!", "?") and after:
            yield from text(at)
            end = source.find(">", at + 2)
            yield Token("comment", "", source[at + 1 : end if end >= 0 else size])
            at = text_from = end + 1 if end >= 0 else size
        else:
            at += 1
    yield from text(size)


def squeezed(text: str) -> str:
    """``text`` with runs of white space, no-break spaces included, as one space, and none at the ends."""
    return _SPACES.sub(" ", text).strip(" ")


def page_text(source: str) -> tuple[str | None, str]:
    """``(title, text)`` of a page: lines as its blocks give them, without empty ones.

    White space within a line counts as one space. Cells of a table row are apart
    by a space. Comments, scripts, styles and the title are no part of the text;
    the title is that of the first title element, NULL if there is none.
    """
    title, lines, line = None, [], []

    def end_line():
        if found := squeezed("".join(line)):
            lines.append(found)
        line.clear()

    for token in tokens(source):
        if token.kind == "text" or token.kind == "raw" and token.name == "textarea":
            line.append(token.text)
        elif token.kind == "raw" and token.name == "title" and title is None:
            title = squeezed(token.text)
        elif token.kind in ("start", "end") and token.name in BLOCKS:
            end_line()
        elif token.kind in ("start", "end") and token.name in CELLS:
            line.append(" ")
    end_line()
    return title, "\n".join(lines)


class Field(NamedTuple):
    """One list item, table row or definition of a page."""

    kind: str
    depth: int
    section: str | None
    name: str | None
    value: str
    cells: tuple[str, ...]
    link: str | None


def split_label(text: str) -> tuple[str | None, str]:
    """``Name: value`` at the first colon before a space or the end; no name without one."""
    found = re.match(r"([^:]*(?::[^ :][^:]*)*):(?: |$)", text)
    return (found.group(1).strip(), text[found.end() :].strip()) if found else (None, text)


class _Open:
    """An item that has begun: its own text, apart from that of items within it."""

    def __init__(self, kind: str, depth: int, section: str | None, place: int):
        self.kind, self.depth, self.section, self.place = kind, depth, section, place
        self.cells: list[list[str]] = [[]]
        self.link: str | None = None

    def text(self, text: str) -> None:
        self.cells[-1].append(text)

    def closed(self, term: str | None) -> Field:
        cells = tuple(squeezed("".join(c)) for c in self.cells)
        if self.kind == "row":
            cells = cells[1:] or cells
            name, value = (cells[0].rstrip(": "), " ".join(cells[1:])) if len(cells) > 1 else (None, cells[0])
        elif self.kind == "definition":
            name, value = term, cells[0]
        else:
            name, value = split_label(cells[0])
        return Field(self.kind, self.depth, self.section, name or None, value, cells, self.link)


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "caption", "legend"}
LISTS, BOLD = {"ul", "ol", "menu", "dir"}, {"b", "strong"}
ITEMS = {"li": "item", "tr": "row", "dd": "definition"}
HOLDERS = {"item": LISTS, "row": {"table"}, "definition": {"dl"}}
CONTAINERS = LISTS | {"table", "dl"}


class _Fields:
    """The items that are open at a place of a page: containers by name, items among them."""

    def __init__(self) -> None:
        self.stack: list[_Open | str] = []
        self.done: list[tuple[int, Field]] = []
        self.begun = 0
        self.section: str | None = None
        self.term: str | None = None
        self.heading: str | None = None
        self.caught: list[str] = []

    def item(self) -> _Open | None:
        return next((s for s in reversed(self.stack) if isinstance(s, _Open)), None)

    def inner(self, kinds: set[str]) -> int:
        """Place of the innermost open container of these kinds, -1 if there is none."""
        return max((i for i, s in enumerate(self.stack) if isinstance(s, str) and s in kinds), default=-1)

    def close(self, until: int) -> None:
        while len(self.stack) > until:
            top = self.stack.pop()
            if isinstance(top, _Open):
                field = top.closed(self.term)
                if field.value or field.name or field.link:
                    self.done.append((top.place, field))

    def begin(self, kind: str) -> None:
        """A new item ends those that its list holds; in a container of another kind, one before it of its own."""
        inner = self.inner(CONTAINERS)
        if inner >= 0 and self.stack[inner] not in HOLDERS[kind]:
            top = self.stack[-1]
            self.close(len(self.stack) - (isinstance(top, _Open) and top.kind == kind))
        else:
            self.close(inner + 1)
        depth = sum(isinstance(s, str) for s in self.stack)
        self.stack.append(_Open(kind, depth, self.section, self.begun))
        self.begun += 1

    def catch(self, heading: str) -> None:
        self.heading, self.caught = heading, []

    def end_heading(self) -> None:
        found = squeezed("".join(self.caught))
        if self.heading == "dt":
            self.term = found.rstrip(": ") or None
        elif self.heading in HEADINGS or self.heading and found.endswith(":"):
            self.section = found.rstrip(": ") or None
        self.heading = None

    def start(self, token: Token) -> None:
        name, item = token.name, self.item()
        if item is not None and name in BLOCKS:
            item.text(" ")
        if name in CONTAINERS or name in ITEMS:
            self.end_heading()
        if name in CONTAINERS:
            self.stack.append(name)
        elif name in ITEMS:
            self.begin(ITEMS[name])
        elif name == "dt":
            if (inner := self.inner({"dl"})) >= 0:
                self.close(inner + 1)
            self.catch("dt")
        elif item is None and (name in HEADINGS or name in BOLD and self.heading is None):
            self.end_heading()
            self.catch(name)
        elif item is not None and name in CELLS and item.kind == "row":
            item.cells.append([])
        elif item is not None and name == "a" and item.link is None:
            item.link = dict(token.attributes).get("href")

    def end(self, name: str) -> None:
        if name == self.heading or name == "dl" and self.heading == "dt":
            self.end_heading()
        item = self.item()
        if name in CONTAINERS:
            if (inner := self.inner({name})) >= 0:
                self.close(inner)
            if name == "dl":
                self.term = None
        elif item is not None and item is self.stack[-1] and ITEMS.get(name) == item.kind:
            self.close(len(self.stack) - 1)
        if name in BLOCKS and (item := self.item()) is not None:
            item.text(" ")


def page_fields(source: str) -> list[Field]:
    """The list items, table rows and definitions of a page, in the order they begin.

    An item's value is its own text: what nested items hold is theirs, one deeper.
    ``Name: value`` is split at the first colon before a space; a row's name is its
    first cell, a definition's the term before it. ``section`` is the last heading,
    or bold text ending in a colon, that began outside all items.

    Closing tags may be missing: an item ends where the next of its list or table
    begins, where the list or table ends, and at the end of the page. A closing tag
    of a list or table that is not open does nothing. Items without any list have
    depth 0, items without text and link are left out.
    """
    page = _Fields()
    for token in tokens(source):
        if token.kind == "start":
            page.start(token)
        elif token.kind == "end":
            page.end(token.name)
        elif token.kind == "text":
            item = page.item()
            if page.heading is not None:
                page.caught.append(token.text)
            if item is not None:
                item.text(token.text)
    page.close(0)
    return [field for _, field in sorted(page.done, key=lambda f: f[0])]
