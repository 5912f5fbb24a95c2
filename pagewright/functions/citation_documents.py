"""What the defects of a document's citation ranges follow from, read off its markup: its blocks in order, each judged by itself."""

from __future__ import annotations

import re
from functools import lru_cache

from . import citation_ranges, markup

#: How bibliographies are headed, in the languages of the documents.
REFERENCES = r"(?iu)^\s*(?:references|bibliography|works cited|referencias|références|bibliografie|bibliografía|literatur|literaturverzeichnis|referenzen|Литература|Список литературы|Источники)\s*$"
#: Formulas that are citations, and citations that recognition broke.
LATEX_CITATION = r"\\\(\^\{[\d,\s\-–—]+\}\\\)"
BROKEN_CITATION = r"(?i)\btask\.\s+Sec\.|\bflagship models\s+6,000\b"
#: Classes of blocks that aren't the article's body.
ASIDE = ("z2m-front-matter", "z2m-affiliations", "z2m-footnote")
SIGNS = {"P28": ("raw", LATEX_CITATION), "P32": ("text", BROKEN_CITATION)}
#: What comes first counts first.
KINDS = ("body", "float", "math")
#: The same patterns as the columns', and the ids that make targets and footnotes.
_HEADED = re.compile(REFERENCES)
_SIGNED = {name: (column, re.compile(pattern, re.ASCII)) for name, (column, pattern) in SIGNS.items()}
_OWN, _INSIDE, _NOTE = re.compile(r"(?i)^ref-([0-9]+)$"), re.compile(r"""(?i)\bid\s*=\s*['"]ref-([0-9]+)['"]""", re.ASCII), re.compile(r"(?i)^footnote-([0-9]+)$")
#: Blocks without a bracket or a raised part aren't judged.
_CAN = re.compile(r"\[|<[sS][uU][pP]\b", re.ASCII)
#: Blocks of at most so many characters are remembered, so many of them: running heads, notices and the like stand in many documents.
REMEMBERED, BLOCKS = 1000, 8192


def _read(tag: str, attrs: str, raw: str) -> tuple:
    """A block, whether it heads a bibliography, whether it can be of the body, its targets, its footnote and its signs."""
    b = citation_ranges.Block(tag, markup.attributes(attrs), raw, markup.visible(raw))
    own = b.attrs.get("id", "")
    targets = [int(x) for x in [*_OWN.findall(own), *_INSIDE.findall(raw)]]
    note = _NOTE.match(own)
    signs = [name for name, (column, pattern) in _SIGNED.items() if pattern.search(getattr(b, column))]
    return b, bool(_HEADED.match(b.text)), not own.startswith("ref-") and b.classes.isdisjoint(ASIDE), targets, note and int(note[1]), signs


def _judge(tag: str, attrs: str, raw: str) -> tuple[str, list[int]]:
    b = _read_again(tag, attrs, raw)[0]
    kind = citation_ranges.kind(b) if _CAN.search(raw) else ""
    return kind, citation_ranges.candidates(b) if kind else []


def _remembered(f):
    short = lru_cache(BLOCKS)(f)
    return lambda tag, attrs, raw: (short if len(raw) <= REMEMBERED else f)(tag, attrs, raw)


_read_again, _judge_again = _remembered(_read), _remembered(_judge)


def summary(html: str) -> tuple:
    """The first range that counts with its block, its kind, whether it names footnotes alone, the document's targets, and where each sign is first.

    No block is judged behind the first range of the kind that comes first.
    """
    blocks = [(tag, attrs, html[start:stop]) for start, stop, _, _, tag, attrs in markup.spans(html)]
    read = [_read_again(*b) for b in blocks]
    end = next((n for n, r in enumerate(read) if r[1]), len(read))
    body = [n for n in range(end) if read[n][2]]
    first: dict[str, tuple[int, list[int]]] = {}
    for n in body:
        kind, numbers = _judge_again(*blocks[n])
        if kind:
            first.setdefault(kind, (n, numbers))
        if KINDS[0] in first:
            break
    kind = next((k for k in KINDS if k in first), None)
    footnotes = {r[4] for r in read if r[4] is not None}
    noted = kind is not None and citation_ranges.only_footnotes(read[first[kind][0]][0], footnotes)
    signs = [next((n for n in body if name in read[n][5]), None) for name in SIGNS]
    return first.get(kind), kind, noted, list({t for r in read for t in r[3]}), *signs
