"""Markup of one text, with offsets: small helpers that the table functions and Arrow functions of the library call per row.

Offsets are code points of the text as it is, end exclusive; lines count from 1.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from typing import NamedTuple

#: The elements that make a block, the patterns of attributes, cells and reference items, the class of warnings.
BLOCK_NAMES = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "div", "table", "figure", "figcaption", "li", "td", "th")
WARNING_NAMES = ("p", "div", "figure", "figcaption", "li")
WARNING_CLASS = "z2m-missing-figure-warning"
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)\s*=\s*(?:"(.*?)"|'(.*?)'|([^\s>]+))""", re.DOTALL)
CELL = re.compile(r"<t[dh]\b[^>]*>(.*?)</t[dh]>", re.IGNORECASE | re.DOTALL)
REFERENCE_ID = re.compile(r"^ref-(\d+)$", re.IGNORECASE)
REFERENCE_ITEM = re.compile(r"""<li\b[^>]*\bid\s*=\s*['"]ref-\d+['"]""", re.IGNORECASE)
#: What diagnostic text leaves out, and the dashes that it makes one.
UNSEEN_TAGS, UNSEEN_CLASSES = frozenset(("script", "style")), frozenset(("z2m-math", "katex", "katex-html"))
DASHES = "‐‑‒–—−"

TAG = re.compile(r"<[^>]+>")
_ANY = re.compile(r"<(/?)([a-z][a-z0-9:-]*)\b([^>]*)>", re.IGNORECASE)
_CLOSED_ENTITY = re.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
_DATA_IMAGE = re.compile(r"""data:image/[^'"]+""", re.IGNORECASE)


class Element(NamedTuple):
    start: int
    stop: int
    line: int
    tag: str
    attrs: dict[str, str]
    #: Where the content starts and ends.
    body_start: int
    body_stop: int


def squeezed(text: str) -> str:
    return " ".join(text.split())


def unescape_closed(text: str) -> str:
    """Entities decoded that end in a semicolon; a bare ``&amp`` stays as it is."""
    return _CLOSED_ENTITY.sub(lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], text)


def visible(fragment: str, open_entities: bool = True) -> str:
    """The text without tags, every entity decoded, white space squeezed. Browsers decode some entities without a semicolon too; ``open_entities`` tells whether these are."""
    return squeezed((unescape if open_entities else unescape_closed)(TAG.sub(" ", fragment)))


def attributes(text: str) -> dict[str, str]:
    """Names in lower case with their decoded values; of a repeated name the last."""
    return {name.lower(): unescape(double or single or bare) for name, double, single, bare in ATTRIBUTE.findall(text)}


def line_starts(text: str) -> list[int]:
    return [0, *(m.end() for m in re.finditer("\n", text))]


def line_of(starts: list[int], offset: int) -> int:
    return bisect_right(starts, offset)


def opening(names: tuple[str, ...]) -> re.Pattern[str]:
    return re.compile(rf"<({'|'.join(names)})\b([^>]*)>", re.IGNORECASE)


def spans(html: str, names: tuple[str, ...] = BLOCK_NAMES, overlapping: bool = False) -> Iterator[tuple[int, int, int, int, str, str]]:
    """Where elements are: start, stop, where the content starts and ends, tag, and attributes as they stand; from their opening tag to the next closing tag of the same name; those that are never closed are left out.

    With ``overlapping``, every opening tag makes one; otherwise the search goes
    on behind an element's end. The ends of each name are listed once.
    """
    pattern = opening(names)
    ends: dict[str, list[int]] = {}
    at = 0
    while found := pattern.search(html, at):
        tag = found[1].lower()
        if tag not in ends:
            ends[tag] = [m.start() for m in re.finditer(f"</{tag}>", html, re.IGNORECASE)]
        closing = bisect_left(ends[tag], found.end())
        if closing == len(ends[tag]):
            at = found.end() if overlapping else found.start() + 1
            continue
        body_stop = ends[tag][closing]
        stop = body_stop + len(tag) + 3
        yield found.start(), stop, found.end(), body_stop, tag, found[2]
        at = found.end() if overlapping else stop


def elements(html: str, names: tuple[str, ...] = BLOCK_NAMES, overlapping: bool = False) -> Iterator[Element]:
    """Elements where ``spans`` finds them, with their lines and attributes."""
    starts = line_starts(html)
    for start, stop, body_start, body_stop, tag, attrs in spans(html, names, overlapping):
        yield Element(start, stop, line_of(starts, start), tag, attributes(attrs), body_start, body_stop)


def classes(attrs: dict[str, str]) -> set[str]:
    return set(attrs.get("class", "").split())


def reference_elements(html: str) -> Iterator[tuple[Element, bool]]:
    """Blocks among which every reference item is one of its own, and whether it had to be taken out of another block.

    Paragraphs and divisions around reference items give way to the items; an
    item of the same markup counts once.
    """
    seen = set()
    for e in elements(html):
        raw = html[e.start : e.stop]
        if e.tag in ("p", "div") and not REFERENCE_ID.match(e.attrs.get("id", "")) and REFERENCE_ITEM.search(raw):
            continue
        seen.add(raw)
        yield e, False
    for e in elements(html, overlapping=True):
        raw = html[e.start : e.stop]
        if e.tag == "li" and REFERENCE_ID.match(e.attrs.get("id", "")) and raw not in seen:
            seen.add(raw)
            yield e, True


def warning_elements(html: str) -> Iterator[Element]:
    """Blocks that warn of a missing figure."""
    return (e for e in elements(html, WARNING_NAMES) if WARNING_CLASS in classes(e.attrs)) if WARNING_CLASS in html else iter(())


def structure(html: str) -> str:
    """The markup with the bytes of embedded images left out."""
    return _DATA_IMAGE.sub("data:image/...", html)


def snippet(text: str, start: int, stop: int, width: int = 260) -> str:
    """Visible text around a place, with dots where it was cut."""
    left, right = max(0, start - width // 2), min(len(text), stop + width // 2)
    shown = ("..." if left else "") + visible(text[left:right]) + ("..." if right < len(text) else "")
    return shown if len(shown) <= width else shown[: width - 3].rstrip() + "..."


class _Shown(HTMLParser):
    """Text outside of scripts, styles and formulas."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if self.hidden or tag in UNSEEN_TAGS or UNSEEN_CLASSES & set((dict(attrs).get("class") or "").split()):
            self.hidden += 1
        else:
            self.parts.append(" ")

    def handle_startendtag(self, tag, attrs):
        self.parts += [] if self.hidden else [" "]

    def handle_endtag(self, tag):
        if self.hidden:
            self.hidden -= 1
        else:
            self.parts.append(" ")

    def handle_data(self, data):
        self.parts += [] if self.hidden else [data]


def shown(fragment: str) -> str:
    """Text as a reader sees it, formulas left out."""
    parser = _Shown()
    parser.feed(fragment)
    parser.close()
    return squeezed(unescape(" ".join(parser.parts)))


def shown_units(fragment: str) -> list[str]:
    """The shown text of each table cell, or of the whole where there are no cells."""
    return [shown(c) for c in CELL.findall(fragment)] or [shown(fragment)]


def plain_dashes(text: str) -> str:
    return text.translate(dict.fromkeys(map(ord, DASHES), "-"))


def diagnostic_words(fragment: str) -> list[str]:
    return re.findall("[a-z0-9]+", plain_dashes(visible(fragment)).lower())


def word_sequence(text: str, words: list[str], start: int = 0) -> tuple[int, int] | None:
    """Where the words stand one after the other with white space between them; of no words nowhere."""
    found = words and re.compile(r"\b" + r"\s+".join(map(re.escape, words)) + r"\b").search(text, start)
    return found.span() if found else None


def tags(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Every tag: start, stop, whether it closes, name in lower case, and its attributes as they stand."""
    for m in _ANY.finditer(html):
        yield m.start(), m.end(), m[1] == "/", m[2].lower(), m[3]


def rebuilt(html: str, changes: dict[tuple[int, int], str]) -> str:
    """The text with spans replaced; spans don't overlap. What no span covers stays as it is."""
    parts, at = [], 0
    for (start, stop), value in sorted(changes.items()):
        parts += [html[at:start], value]
        at = stop
    return "".join([*parts, html[at:]])
