"""Citation ranges in one block: whether ``[1-4]`` or a raised ``2, 5`` is a citation without a link, and what it cites.

Each guard looks at the match on the original string: what is left of it, right
of it, or around it, at the distance that the guard names. The first guard that
holds settles a match.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from .markup import visible

# The patterns of ranges and of the contexts that make them something else, and the distances at which contexts count.
DASH = "-–—"
BRACKETS = re.compile(r"\[\s*\d+\s*(?:[-–]\s*\d+|,\s*\d+)(?:\s*,\s*\d+(?:\s*[-–]\s*\d+)?)*\s*\]")
TAGGED = re.compile(r"\[\s*(?=[\s\S]*?<)([\s\S]{1,260}?)\s*\]")
RAISED = re.compile(rf"<sup\b(?![^>]*\bz2m-unit-exp\b)[^>]*>(\s*\d{{1,3}}\s*(?:[{DASH}]\s*\d{{1,3}}|,\s*\d{{1,3}})(?:\s*,\s*\d{{1,3}}(?:\s*[{DASH}]\s*\d{{1,3}})?)*\s*)</sup>", re.IGNORECASE)
LINK, FOOTNOTE, EQUATION = "z2m-ref-link", "z2m-footnote-ref", "z2m-equation-row"

UNIT_RIGHT = re.compile(
    r"^\s*(?:[.)]\s*)?(?:[-–—]\s*)?(?:"
    r"(?:l|L|ml|mL|min|s|sec|kg|g|mg|m|cm|mm|um|A|V|[kMGT]?Hz|bpm|mmHg)(?:\b|[\s.·*/^-])|"
    r"(?:[munpµμ]?g|[munpµμ]?m|[munpµμ]?A|[munpµμ]?V)\b)",
    re.IGNORECASE,
)
MEASURED = re.compile(r"\b(?:above|below|difference|differences|exercise|fick|mean|measured|measurement|rest|sd|value|values?)\b", re.IGNORECASE)
GRANT_LEFT = re.compile(r"\b(?:agreement|award|contract|funding|grant|project|programme|program|research)\s+(?:no\.?|number|id)?\s*$", re.IGNORECASE)
DIMENSION_LEFT = re.compile(r"(?:\b\d+(?:\.\d+)?\s*|[×x]\s*)(?:m|cm|mm|km|ft|in)\s*$", re.IGNORECASE)
COUNTED_WORDS = r"chair|chairs|choice|choices|integer|integers|item|items|label|labels|number|numbers|option|options|question|questions|response|responses|target|targets|value|values"
COUNTED = re.compile(rf"\b(?:{COUNTED_WORDS})\b", re.IGNORECASE)
COUNTED_RIGHT = re.compile(rf"^\s*(?:or\s+\d+\s+)?(?:{COUNTED_WORDS})\b", re.IGNORECASE)
COUNTED_SPAN = re.compile(r"\b(?:number\s+of|contained?|total|varied|conditional)\b", re.IGNORECASE)
COUNTED_LIST = re.compile(r"\b(?:integers?|labels?|numbers?|values?|number\s+of|contained?|total|varied|conditional)\b", re.IGNORECASE)
TIME_RIGHT = re.compile(r"^\s*(?:[,;]\s*)?((?:and|or)\s+\d{1,3}\s+)?(?:days?|weeks?|months?|years?|hours?|minutes?|mins?|seconds?|secs?|recording\s+sessions?|sessions?|trials?)\b", re.IGNORECASE)
TIME_LEFT = re.compile(r"\b(?:at|after|before|between|by|during|for|from|in|on|over|within)\s*$", re.IGNORECASE)
DECIMAL = re.compile(r"\b(?:coefficient|coordinate|decline|depth|dispersion\s+ratio|equal\s+to|height|length|mean|median|molecular\s+weight|ratio|slope|transl\.?|translation|value|values?|width)\b|\b(?:chi|χ)\s*2\b|p\s*[<=>]", re.IGNORECASE)
DECIMAL_RIGHT = re.compile(r"^\s*(?:[,;)]|\d+(?:\.\d+)?)")
LAYOUT = re.compile(r"\b(?:distance|head|height|sound|pattern|transl\.?|user)\b", re.IGNORECASE)
PROGRAMS = "python|pytorch|cuda|tensorflow|torch|matlab|unity|opencv|numpy|scipy|excel|photoshop"
VERSION_LEFT = re.compile(rf"\b(?:{PROGRAMS})\s*$|\b(?:{PROGRAMS}|driver)\s+(?:driver\s+)?version\s*$|\bversion\s*$", re.IGNORECASE)
STATISTICS = re.compile(r"\b(?:sample\s+size|G\*Power|allocation\s+ratio|effect\s+size|statistical\s+power|power\s+analysis)\b", re.IGNORECASE)
MATHS = re.compile(
    r"(?:\\\[|\\\(|\b(?:anova|array|arrays|class|classes|coordinate|coordinates|equation|eq\.?|formula|glm|heatmap|interval|intervals|likelihood|matrix|median|"
    r"parameter|parameters|probability|range|scale|score|scores|threshold|vector|values?)\b|[=<>]|[°μπστΦ∈∑−∗∙∣∼≈◦])",
    re.IGNORECASE,
)
NOT_CITED = re.compile(
    r"\b(?:amplitude|array|arrays|bounds?|class\s+scores?|coordinate|coordinates|current|dimension|dimensions|electrode\s+values?|feature|heatmap|input|interval|intervals|"
    r"layer|layers|likelihood|map\s+size|matrix|median|normalization|normalized|output|parameters?|pixel|points?|probability|range|random\s+number|scale|score|scores|"
    r"sigmoid|starting|STAI|threshold|values?|vector|vectors|VAS)\b|[°μπστΦ∈∑−∗∙∣∼≈◦]",
    re.IGNORECASE,
)
CITED_LEFT = re.compile(r"\b(?:prior|previous|related|reported|study|studies|work|works|literature|references?|refs?)\s*$", re.IGNORECASE)
#: As it stands in the data that this is to agree with, wrongly decoded letters included.
QUANTITY_RIGHT = re.compile(r"\s*(?:%|[munpВµОј]?A|[munpВµОј]?m|V|Hz|s|ms|kg|N)\b")
PLACES = re.compile(r"\b(?:map\s+size|starting|ending|points?)\b", re.IGNORECASE)
VECTOR_LEFT = re.compile(r"\b(?:vector|vectors|array|arrays|assignment|assignments|interval|intervals|likelihood|likelihoods|score|scores|class|classes|elements|normalized|dividing)\b")
IN_RANGE_LEFT = re.compile(r"\b(?:within|in|the)\s+(?:the\s+)?range\s*$", re.IGNORECASE)
YEARS = re.compile(rf"\[\s*(?:19|20)\d{{2}}\s*[{DASH}]\s*(?:19|20)\d{{2}}\s*\]")
FROM_ZERO = re.compile(r"\[\s*(?:0|[-−])")
FLOAT_CLASSES = frozenset(("z2m-float-unit", "z2m-figure-unit", "z2m-table-unit", "z2m-box-unit"))
CAPTION = re.compile(r"^\s*(?:(?:Figure|Fig\.?)\s+\d+[A-Za-z]?\b|Table\s+(?:[IVXLCM]+|\d+)\b)", re.IGNORECASE)
VISUAL = re.compile(r"<img\b|<table\b(?=[^>]*\bz2m-figure-target\b)", re.IGNORECASE)
AFFILIATION = re.compile(r"\b(?:department|division|faculty|institute|laboratory|school|university|correspondence|authors?\s+contributed|netherlands|denmark)\b", re.IGNORECASE)
MARKER = re.compile(r"(?:^|[\s,])\d{1,2}(?:,\d{1,2})*(?=\s|,|$)")
MARKED_AUTHOR = re.compile(r"\b[A-Z][A-Za-z.-]+\s+[A-Z][A-Za-z.-]+\s+\d{1,2}(?:,\d{1,2})?")


@dataclass(frozen=True)
class Block:
    tag: str
    attrs: dict[str, str]
    raw: str
    text: str

    @property
    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    @property
    def is_equation(self) -> bool:
        return self.attrs.get("block-type", "").lower() == "equation" or EQUATION in self.classes

    @property
    def is_float(self) -> bool:
        """Figures, tables and boxes, and captions of figures and tables."""
        return bool(VISUAL.search(self.raw) or FLOAT_CLASSES & self.classes or self.tag in ("table", "figure", "figcaption") or self.attrs.get("id", "").startswith("fig-") or CAPTION.match(self.text))

    @property
    def is_affiliation_table(self) -> bool:
        text = self.text
        if (self.tag != "table" and "z2m-table-unit" not in self.classes) or not 0 < len(text) <= 2600:
            return False
        return len(AFFILIATION.findall(text)) >= 2 and len(MARKER.findall(text)) >= 4 and bool(MARKED_AUTHOR.search(text))


@dataclass(frozen=True)
class Place:
    """A match in a string, and what is around it; with ``shown``, markup around it is left out."""

    string: str
    start: int
    stop: int
    body: str
    shown: bool = False

    def left(self, n: int) -> str:
        part = self.string[max(0, self.start - n) : self.start]
        return visible(part) if self.shown else part

    def right(self, n: int) -> str:
        part = self.string[self.stop : self.stop + n]
        return visible(part) if self.shown else part

    def around(self, n: int) -> str:
        return self.string[max(0, self.start - n) : self.stop + n]

    @property
    def numbers(self) -> list[int]:
        return [int(x) for x in re.findall(r"\d+", self.body)]

    @property
    def is_span(self) -> bool:
        return bool(re.search(f"[{DASH};]", self.body))


def is_vector(p: Place) -> bool:
    """Numbers from zero, an assignment, or numbers behind a word for vectors."""
    if not p.numbers:
        return False
    assigned = re.match(r"^[\s\u200b]*=", p.right(40))
    falling = len(p.numbers) == 2 and p.numbers[0] > p.numbers[1]
    return 0 in p.numbers or bool(assigned and (falling or re.search(r"[A-Za-z]\s*$", p.left(100)))) or bool(VECTOR_LEFT.search(p.left(100).lower()))


def is_mathematical(p: Place) -> bool:
    return bool(FROM_ZERO.search(p.body) or IN_RANGE_LEFT.search(p.left(120)) or MATHS.search(p.around(180)))


def is_quantity(p: Place) -> bool:
    """A range in brackets that measures or computes and doesn't cite."""
    if not p.numbers or CITED_LEFT.search(p.left(80)):
        return False
    around = p.around(180)
    if 0 in p.numbers or QUANTITY_RIGHT.match(p.right(80)) or PLACES.search(around):
        return True
    return bool(NOT_CITED.search(around)) and (len(p.numbers) >= 3 or is_mathematical(p))


# --- raised numbers: what else they may be ---------------------------------------------------------------------


def _granted(p: Place, b: Block) -> bool:
    return bool(GRANT_LEFT.search(p.left(180)))


def _version(p: Place, b: Block) -> bool:
    numbers = re.findall(r"\d{1,3}", p.body)
    where = re.finditer(r"\s*,\s*".join(numbers), b.text) if len(numbers) > 1 else ()
    return any(VERSION_LEFT.search(b.text[max(0, m.start() - 160) : m.start()]) for m in where)


def _measured(p: Place, b: Block) -> bool:
    right = p.right(260)
    if not UNIT_RIGHT.match(right):
        return False
    if re.fullmatch(r"\d{1,3}\s*,\s*\d{1,3}", visible(p.body)):
        return True
    left = p.left(220)
    return bool(DIMENSION_LEFT.search(left) or MEASURED.search(f"{left} {right}"))


def _decimal(p: Place, b: Block) -> bool:
    if p.is_span or len(p.numbers) != 2 or p.numbers[1] > 99:
        return False
    return bool(DECIMAL.search(f"{p.left(220)} {p.right(220)}") or DECIMAL_RIGHT.match(p.right(220)))


def _counted(p: Place, b: Block) -> bool:
    near = f"{p.left(220)} {p.right(120)}"
    if not COUNTED.search(near):
        return False
    if COUNTED_RIGHT.match(p.right(120)):
        return True
    return bool((COUNTED_SPAN if re.search(f"[{DASH}]", p.body) else COUNTED_LIST).search(near))


def _timed(p: Place, b: Block) -> bool:
    found = TIME_RIGHT.match(p.right(120))
    return bool(found and (not found[1] or TIME_LEFT.search(p.left(180))))


def _laid_out(p: Place, b: Block) -> bool:
    if (b.tag != "table" and not re.search(r"<t[dh]\b", b.raw, re.IGNORECASE)) or p.is_span or len(p.numbers) != 2 or max(p.numbers) > 5:
        return False
    return bool(LAYOUT.search(f"{p.left(140)} {p.right(140)}"))


Guard = Callable[[Place, Block], bool]
RAISED_GUARDS: dict[str, Guard] = {"grant": _granted, "version": _version, "measurement": _measured, "decimal": _decimal, "count": _counted, "time": _timed, "layout": _laid_out}


def raised(b: Block, but: tuple[str, ...] = ()) -> Place | None:
    """The first raised range that no guard explains; ``but`` names guards that aren't asked."""
    for m in RAISED.finditer(b.raw):
        p = Place(b.raw, m.start(), m.end(), m[1], shown=True)
        if LINK not in m[0] and FOOTNOTE not in m[0] and not any(guard(p, b) for name, guard in RAISED_GUARDS.items() if name not in but):
            return p
    return None


def tagged(b: Block) -> str | None:
    """What the first range in brackets with markup inside shows."""
    for m in TAGGED.finditer(b.raw):
        if "<" in m[1] and LINK not in m[1] and BRACKETS.fullmatch(f"[{visible(m[1])}]"):
            return visible(m[1])
    return None


def bracketed(b: Block) -> Place | None:
    m = BRACKETS.search(b.text)
    return m and Place(b.text, m.start(), m.end(), m[0])


def kind(b: Block) -> str:
    """Where a range without a link stands: body, float, math; empty if there is none, or it is no citation."""
    p, up = bracketed(b), raised(b) is not None
    plain = p is not None and LINK not in b.raw
    if not (plain or up or tagged(b)):
        return ""
    if plain and not up and (b.is_equation or is_quantity(p)):
        return ""
    if b.is_float:
        searched = plain and not up and YEARS.fullmatch(p.body)
        return "" if b.is_affiliation_table or searched else "float"
    if plain and is_vector(p) or p is not None and is_mathematical(p):
        return "math"
    return "math" if STATISTICS.search(b.text) or FROM_ZERO.search(b.text) or MATHS.search(b.text) else "body"


def candidates(b: Block) -> list[int]:
    """The numbers that the first range names."""
    if p := bracketed(b):
        return p.numbers
    if p := raised(b, but=("version",)):
        return p.numbers
    return [int(x) for x in re.findall(r"\d+", tagged(b) or "")]


def only_footnotes(b: Block, footnotes: set[int]) -> bool:
    """Whether some raised range without a link names footnotes alone."""
    found = (re.findall(r"\d{1,3}", m[1]) for m in RAISED.finditer(b.raw) if LINK not in m[0])
    return bool(footnotes) and any(numbers and {int(x) for x in numbers} <= footnotes for numbers in found)
