"""Headers of tables that page breaks repeated and recognition broke: mended from the clean one above them."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache

from .markup import visible

#: How like a phrase its pieces have to be, how long both may be, and when rows are headers or data.
ALIKE, SHORTEST, LONGEST, BLOCK_ALIKE = 0.84, 0.7, 1.3, 0.45
PHRASE_WORDS, PHRASE_LETTERS, PHRASE_CHARS, PIECES = (2, 8), 8, 80, 4
DATA_CELLS, DATA_LABEL, DATA_SHARE, BLOCK_ROWS, LABEL_LETTERS, MORE_CELLS = 4, 32, 0.7, 5, 4, 4

_TABLE = re.compile(r"(<table\b[^>]*>)([\s\S]*?)(</table>)", re.IGNORECASE)
_ROW = re.compile(r"<tr\b[^>]*>[\s\S]*?</tr>", re.IGNORECASE)
_CELL = re.compile(r"(<t[dh]\b[^>]*>)([\s\S]*?)(</t[dh]>)", re.IGNORECASE)
_SPAN = re.compile(r"""\bcolspan\s*=\s*["']?(\d+)""", re.IGNORECASE)
_SPAN_ATTRIBUTE = re.compile(r"""\s+colspan\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)


@lru_cache(4096)
def key(text: str) -> str:
    return "".join(c.casefold() for c in text if c.isalnum())


@lru_cache(4096)
def letters(text: str) -> int:
    return sum(c.isalpha() for c in text)


@lru_cache(4096)
def alike(a: str, b: str, least: float) -> float:
    """How like two texts are, or 0 if that is less than ``least``. Both bounds are never below the ratio; headers come again and again."""
    match = SequenceMatcher(None, a, b)
    if match.real_quick_ratio() < least or match.quick_ratio() < least:
        return 0.0
    ratio = match.ratio()
    return ratio if ratio >= least else 0.0


@dataclass
class Cell:
    raw: str
    opening: str
    closing: str
    start: int
    stop: int
    text: str = field(init=False)

    def __post_init__(self) -> None:
        self.text = visible(self.raw[len(self.opening) : len(self.raw) - len(self.closing)])

    @property
    def is_header(self) -> bool:
        return self.opening.lower().startswith("<th")

    @property
    def span(self) -> int:
        found = _SPAN.search(self.opening)
        return max(1, int(found[1])) if found else 1

    def spanning(self, columns: int) -> str:
        plain = _SPAN_ATTRIBUTE.sub("", self.opening)
        return plain if columns <= 1 else f'{plain[:-1].rstrip()} colspan="{columns}">'


@dataclass
class Line:
    """A table row and its cells."""

    raw: str
    cells: list[Cell] = field(init=False)

    def __post_init__(self) -> None:
        self.cells = [Cell(m[0], m[1], m[3], m.start(), m.end()) for m in _CELL.finditer(self.raw)]

    @property
    def label(self) -> str:
        return self.cells[0].text if self.cells else ""

    @property
    def is_data(self) -> bool:
        """A short label and mostly cells without letters."""
        rest = [c.text for c in self.cells[1:] if c.text]
        if len(self.cells) < DATA_CELLS or not self.label or len(rest) < 3:
            return False
        return len(self.label) <= DATA_LABEL and sum(not letters(t) for t in rest) / len(rest) >= DATA_SHARE


def phrases(lines: list[Line]) -> dict[str, str]:
    """Header cells of a few words, by their letters and digits."""
    found: dict[str, str] = {}
    for cell in (c for line in lines for c in line.cells if c.is_header):
        words = sum(1 for w in cell.text.split() if letters(w))
        if PHRASE_WORDS[0] <= words <= PHRASE_WORDS[1] and letters(cell.text) >= PHRASE_LETTERS and len(key(cell.text)) <= PHRASE_CHARS:
            found.setdefault(key(cell.text), cell.text)
    return found


def phrase_at(cells: list[Cell], known: dict[str, str]) -> tuple[int, str] | None:
    """How many cells from the first on are pieces of one phrase, and the phrase: the likest, then the one of most pieces."""
    best = None
    for n in range(2, min(len(cells), PIECES) + 1):
        part = cells[:n]
        if not all(c.is_header and c.text for c in part):
            break
        pieces = {key(c.text) for c in part}
        joined = "".join(key(c.text) for c in part)
        for whole, text in known.items() if len(joined) >= PHRASE_LETTERS else ():
            if whole in pieces or not SHORTEST <= len(joined) / max(1, len(whole)) <= LONGEST:
                continue
            ratio = alike(joined, whole, ALIKE)
            if ratio and (best is None or (ratio, n, text) > best):
                best = (ratio, n, text)
    return best and best[1:]


def with_phrases(line: Line, known: dict[str, str]) -> str:
    """The row with each phrase's pieces as one cell over their columns."""
    parts, at, i = [], 0, 0
    while i < len(line.cells):
        cell, found = line.cells[i], phrase_at(line.cells[i:], known) if len(line.cells) > 1 else None
        n = found[0] if found else 1
        merged = line.cells[i : i + n]
        value = f"{cell.spanning(sum(c.span for c in merged))} {entities.escape(found[1], quote=False)} {cell.closing}" if found else cell.raw
        parts += [line.raw[at : cell.start], value]
        at, i = merged[-1].stop, i + n
    return "".join([*parts, line.raw[at:]])


def header_block(lines: list[Line], first: int) -> range:
    """The header rows from one on, up to the first row of data."""
    stop = next((i for i in range(first + 1, min(len(lines), first + BLOCK_ROWS)) if lines[i].is_data), min(len(lines), first + BLOCK_ROWS))
    return range(first, stop)


def _size(lines: list[Line]) -> int:
    return sum(len(line.cells) for line in lines)


def _all_text(lines: list[Line]) -> str:
    return key(" ".join(visible(line.raw) for line in lines))


def mended_rows(rows: list[str]) -> dict[int, str]:
    """What rows become: later headers of a table take the form of the first, keeping labels of their own."""
    lines = [Line(r) for r in rows]
    places: dict[str, list[int]] = {}
    for i, line in enumerate(lines):
        if not line.is_data and letters(line.label) >= LABEL_LETTERS and len(key(line.label)) <= PHRASE_CHARS:
            places.setdefault(key(line.label), []).append(i)
    known, out = phrases(lines), {}
    for first, *others in (p for p in places.values() if len(p) > 1):
        block = header_block(lines, first)
        if len(block) < 2:
            continue
        template = [Line(with_phrases(lines[i], known)) for i in block]
        for other in others:
            target = [lines[i] for i in header_block(lines, other)]
            fits = len(target) == len(template) and key(template[-1].label) == key(target[-1].label) and _size(target) >= _size(template) + MORE_CELLS
            if not fits or not alike(_all_text(template), _all_text(target), BLOCK_ALIKE):
                continue
            out |= {i: t.raw for i, t in zip(block, template, strict=True) if t.raw != rows[i]}
            for k, (own, clean) in enumerate(zip(target, template, strict=True)):
                keeps = key(clean.label) != key(own.label) and letters(own.label) >= LABEL_LETTERS and clean.cells
                out[other + k] = clean.raw[: clean.cells[0].start] + own.cells[0].raw + clean.raw[clean.cells[0].stop :] if keeps else clean.raw
    return out


def mended(html: str) -> str:
    """A document whose tables' repeated headers are whole again."""

    def table(m: re.Match[str]) -> str:
        places = list(_ROW.finditer(m[2]))
        if len(places) < 4:
            return m[0]
        changes, parts, at = mended_rows([p[0] for p in places]), [], 0
        for i, p in enumerate(places):
            parts += [m[2][at : p.start()], changes.get(i, p[0])]
            at = p.end()
        return "".join([m[1], *parts, m[2][at:], m[3]])

    return _TABLE.sub(table, html)
