"""Defects of front matter, from the blocks of a document's two stages.

Every rule is a column expression over a block. What needs several blocks is a
window over a document's order or a join of a document's few first blocks.

Defined cases: a document without blocks has no defects; a rule reports a
document once, for its first block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from pagewright.functions import markup

from .structure import BLOCK, has_class

# How far rules look, the classes of front matter, and the patterns of damage and of what explains it.
RAW_FIRST, AFFILIATIONS_FIRST, AUTHORS_FIRST, SENTENCE_FIRST, GAP_LAST, REPAIRED_FIRST, LATE, LATE_LENGTH = 20, 25, 18, 40, 45, 40, 40, 80
FRONT, AFFILIATIONS = "z2m-front-matter", "z2m-affiliations"
REF_LINK = r"""(?i)<a\b[^>]*\bhref\s*=\s*['"]#ref-(\d+)['"][^>]*>"""
REF_LINK_BODY = r"""(?i)<a\b[^>]*\bhref\s*=\s*['"]#ref-\d+['"][^>]*>([\s\S]{0,180}?)</a>"""
DAMAGED = r"(?:©\s*\d|(?:\b[A-Z][A-Za-z.-]+\s+){1,3}(?:\d+\s+\d+|\d+(?:\.\d+){2})\b)"
NAME = r"\b[A-Z][A-Za-z.'-]*(?:\s+[A-Z][A-Za-z.'-]*){1,6}\b"
TWO_NAMES = r"\b[A-Z][A-Za-z.-]+\s+[A-Z][A-Za-z.-]+\b"
BODY_LIKE = (
    r"(?i)\b(?:abstract|introduction|generative artificial intelligence|clinical|methodology|papers?|studies|review|museum|gallery|visitors?|participants?|technolog(?:y|ies|ical)|"
    r"experimental|setup|tools?|toolkit|introduced|reported|developed|implementation|behavior|behaviour|records?|measure|measured|larval|zebrafish|swim|swimming|"
    r"posture|locomotion|research|data|projects?|collections?|neuroimaging|analys(?:is|es))\b"
)
LATE_BODY = r"(?i)\b(?:clinical|validation|metrics|model|models|performance|evaluation|patients|studies)\b"
HEADING = r"(?i)^\s*(?:references|bibliography|works cited)\s*$"
GOES_ON = r"^(?:[a-zа-яё]|and\b|or\b|among\b|и\b|а\b|но\b|среди\b)"
COPYRIGHT = ("copyright", "all rights reserved", "creative commons", "open access article", "licensee", "©")
_DOI = r"(?:\bdoi\s*:?\s*(?:https?://(?:dx\.)?doi\.org/)?10\.\S+|https?://(?:dx\.)?doi\.org/10\.\S+)"
_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_EVENT = r"(?:received|accepted|available\s+online|published|eingereicht|akzeptiert|angenommen|veröffentlicht)"
#: A notice holds all patterns of one line, and is no longer than its number (0 for any length). Patterns are of text without regard to case, unless they begin with ~.
NOTICES: tuple[tuple[int, tuple[str, ...]], ...] = (
    (0, (r"international publication date", r"\b\d{1,2}(?:[./]\d{1,2}){2}\b|\b\d{1,2}\s+[A-Za-z]+\s+\d{4}\b")),
    (0, (r"^IP\s+Address\s*:\s*(?:\d{1,3}\.){3}\d{1,3}\z",)),
    (100, (r"~^\d{1,3}/[\d,]+\s+\d{1,2}\s+[A-Za-z]+\s+\d{4}(?:\s+\(\d{1,2}\.\d{1,2}\.\d{4}\))?\s+[A-Z]{2}\z",)),
    (0, (r"(?:\b\d{1,2}\.\d{1,2}\.\d{4}\b.*){2}", r"\b(?:recebido|publica(?:ção|cao)|vers(?:ão|ao)|aprova(?:ção|cao))\b")),
    (0, (r"\bcorrespondence\b", r"\b(?:e-?mail|email)\b|@", r"\b(?:address|suite|street|avenue|road|doi)\b")),
    (90, (r"~^\d{4}\s+(?:[A-Z][A-Za-z. ]*\.[A-Za-z. ]*\s+\d{1,4}\s+\d{1,8}|[A-Z][A-Za-z. ]{2,45}\s+\d{1,4}\s+\d{4,8})\z", r"~^\d{4}\s+[A-Z][A-Za-z. ]{2,45}\s+\d{1,4}\s+\d{1,8}\z")),
    (0, (r"^(?:Academic\s+Editors?\s*:|(?:[*∗]\s*)?Equal\s+(?:advising|contribution)\b|These\s+authors\s+contributed\s+equally\b|See\s+(?:the\s+)?Comment\s+page\s+\d+\b|(?:ASSETS|TEI|CHI|UIST|DIS)\s*['’]?\s*\d{2}\b|Open\s+Access\s+Support\s+provided\s+by\s*:|Conference\s+Sponsors?\s*:|Citation\s+in\s+BibTeX\s+format\b|PDF\s+Download\b)",)),
    (0, (r"^publisher(?:'|’)s\s+note\s*:",)),
    (0, (r"^citation:", r"doi\.org/|\b\d{4}\b")),
    (0, (r"^pre-?print version\.", _DOI)),
    (600, (rf"{_DOI}|\b10\.\d{{4,9}}/\S+", r"\bet\s+al\.\.?|\bpp?\.\s*\d|\bhal-\d+")),
    (0, (r"^(?:to\s+(?:link|cite)\s+to\s+this\s+article|article\s+link)\s*:?\s*(?:https?://(?:dx\.)?doi\.org/)?10\.\S+\z",)),
    (0, (r"^(?:doi\s*:?\s*)?(?:https?://(?:dx\.)?doi\.org/)?10\.\S+\z",)),
    (180, (_DOI, r"^(?!.*\b(?:abstract|introduction|methods?|results?|discussion|conclusion)\b)")),
    (520, (_DOI, r"^citation:|^please cite this article as:|\b\d{4}\s*;\s*\d+\s*(?:\([^)]*\))?\s*:\s*\d+|\b(?:journal|hearing\s+research|invest\s+ophthalmol|pak\s+j\s+med\s+sci)\b")),
    (0, (rf"^(?:{_EVENT}\s*:?\s*\d{{1,4}}(?:[./]\d{{1,2}}){{2}}\s*){{2,5}}\z",)),
    (0, (rf"^{_EVENT}\s*:?\s*\d{{1,2}}\.\d{{1,2}}\.\d{{4}}\s+{_EVENT}\s*:?\s*\d{{1,2}}\.\d{{1,2}}\.\d{{4}}\z",)),
    (0, (r"~^\d+(?:\.\d+){2,}\s+[A-Z][\s\S]{2,140}\z",)),
    (0, (r"\b(?:clinicaltrials\.gov|trial\s+registration|project\s+no\.?)\b",)),
    (0, (r"^printed\s+in\s+the\s+united\s+states\s+of\s+america(?:\s+\d+){3,}\s*\z",)),
    (0, (rf"^(?:submitted|received|accepted|published|available\s+online(?:\s+date)?)?\s*:?\s*(?:\d{{1,2}}\s+{_MONTH}\s+\d{{4}}(?:\s*\(\d{{1,2}}\.\d{{1,2}}\.\d{{4}}\))?|\d{{1,2}}\.\d{{1,2}}\.\d{{4}})\z",)),
    (0, (r"\b(?:department|hospital|institute|university|medical\s+center|centre|klinik(?:um)?|institut|universit(?:ät|aet|t)|fakultät|abteilung)\b", r"\b(?:floor|room|street|road|laan|avenue|straße|strasse|weg|platz|kai)\b|\b\d{5}\s+[a-zà-ÿ-]+")),
    (0, (r"\b(?:tel\.?|fax|e-?mail|email|correspondence\s+to)\b|@", r"\b(?:department|institute|university|school|college|hospital|center|centre|street|avenue|road|universität|fakultät|institut|abteilung|straße|box|poland|india|sweden|usa|uk)\b")),
)
#: Tables and highlights that look like damaged front matter, in the same form.
TABLES: tuple[tuple[int, tuple[str, ...]], ...] = (
    (0, (r"^case no\.", r"\bage\b", r"\bsex\b", r"\b(?:lesion|deficit|procedure)\b")),
    (0, ("subjects", "data points", "sessions", "total")),
    (0, ("reading accuracy", "reading speed", "font size")),
    (0, ("^patient ", "cause of", "blindness", "braille")),
    (0, (r"\bprior\s+to\s+microelectrode\s+array\s+placement\b", r"\b(?:mri|human\s+connectome\s+project|surgical\s+array)\b")),
    (0, ("for array targeting", "connectome workbench")),
    (0, (r"~^\d+(?:\.\d+){1,4}\.?\s+[A-Z][\s\S]{80,}", r"\b(?:purpose|experiment|accuracy|array|targeting|participant|figure|workbench)\b")),
    (0, (r"^1\.\s+we\s+present\b", r"\b2\.\s+we\s+characterize\b")),
)


def _holds(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?s){pattern[1:]}" if pattern.startswith("~") else f"(?isu){pattern}")


def _any_of(text: Column, rules: tuple[tuple[int, tuple[str, ...]], ...]) -> Column:
    """Whether some rule's patterns all hold."""
    short = lambda n: F.lit(True) if not n else F.char_length(text) <= n
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [_holds(text, p) for p in patterns], short(n)) for n, patterns in rules])


def is_notice(text: Column) -> Column:
    """Publication metadata: dates, identifiers, addresses, citations of the article itself."""
    return _any_of(text, NOTICES)


def is_copyright(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.lower(text).contains(s) for s in COPYRIGHT])


def is_author_index(text: Column) -> Column:
    """A line of names with the numbers of their affiliations."""
    n = lambda p: F.regexp_count(text, F.lit(p))
    names = n(r"\b[A-Z][A-Za-zÀ-ÖØ-öø-ÿ.'-]+(?:\s+[A-Z][A-Za-zÀ-ÖØ-öø-ÿ.'-]+){0,3}\b") >= 3
    tail = text.rlike(r"(?:\b\d{1,2}\s*,?\s*){3,}$") & (n(",") >= 2)
    places = (n(r"(?i)\b(?:department|institute|university|school|faculty|centre|center)\b") >= 2) & (n(r"(?<![\w.-])\d{1,2}(?![\w.-])") >= 6)
    return F.char_length(text).between(40, 700) & ~text.contains("©") & names & ~text.rlike(r"(?i)\b(?:abstract|introduction|methods?|results?|discussion)\b") & (tail | places)


def is_contents(text: Column) -> Column:
    """A table of contents, by its headings and the numbers of its pages."""
    n = lambda p: F.regexp_count(text, F.lit(p))
    has = lambda p: text.rlike(f"(?i){p}")
    sections, numbers, headings = n(r"\b\d+(?:\.\d+){1,3}\s+[A-Z][A-Za-z]"), n(r"\b\d{1,4}\b"), n(r"\b\d{1,2}\.\s+[A-Z][A-Za-z]")
    tails = n(r"(?:^|\s)(?:S\d{1,2}|[A-Z]|\d{1,2}\.)[^.!?]{8,120}\s+\d{1,3}(?=\s|$)")
    return (
        ((n(r"\bS\d{1,2}\s*:\s*[A-Z]") >= 2) & (tails >= 4))
        | has("list of (?:figures|tables)")
        | ((n(r"(?i)\bchapter\s+(?:one|two|three|four|five|six|seven|eight|nine|ten)\b") >= 3) & (numbers >= 8))
        | ((headings >= 5) & (numbers >= 10) & has(r"\b(?:page|introduction|keywords|appendices|application|reviewer|research)\b"))
        | ((sections >= 4) & (numbers >= 8) & has(r"\b(?:pre-review|post-review|reviewer\s+matching|application\s+of\s+ai|research)\b"))
        | ((n(r"(?i)\bchapte?\s*r\s+\d+\s*:") >= 2) & (sections >= 4))
        | ((sections >= 5) & (numbers >= 10) & has(r"\b(?:abstract|chapter|introduction|overview|literature\s+review|theoretical\s+background)\b"))
        | ((sections >= 4) & (n(r"(?i)\b(?:i{1,3}|iv|v|vi{0,3}|ix|x|xi{0,3})\b") >= 1))
    )


def is_cyrillic(text: Column) -> Column:
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return (letters >= 40) & (F.regexp_count(text, F.lit(r"[Ѐ-ӿ]")) / F.greatest(letters, F.lit(1)) >= 0.7)


def _named(text: Column) -> Column:
    """The names in a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(NAME), F.lit(0)), lambda x: F.lower(F.regexp_replace(x, r"\s+", " "))))


def ruled_blocks(html: str) -> Iterator[tuple]:
    """The blocks of a document that some rule looks at: its first ones, and those marked as front matter."""
    starts = None
    marked = FRONT in html or "&" in html
    for n, (start, stop, _, _, tag, text) in enumerate(markup.spans(html)):
        if n > GAP_LAST and not marked:
            return
        # an entity may hide a class
        if n > GAP_LAST and FRONT not in text and "&" not in text:
            continue
        attrs = markup.attributes(text)
        if n <= GAP_LAST or FRONT in markup.classes(attrs):
            starts = starts or markup.line_starts(html)
            raw = html[start:stop]
            yield n, start, stop, markup.line_of(starts, start), tag, attrs, raw, markup.visible(raw)


@udtf(returnType=BLOCK)
class FrontBlocks:
    """``ruled_blocks`` as a table function."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from ruled_blocks(html or "")


def blocks(df: DataFrame, html: str) -> DataFrame:
    """The columns of ``df`` beside each block that a rule looks at: all that ``frontmatter_defects`` needs of a stage, a fixed number of rows and the marked ones, however long documents are."""
    return df.lateralJoin(FrontBlocks(F.col(html).outer()))


def _suspects() -> Column:
    """Per document the early raw blocks whose markers were damaged and that nothing explains: place and names."""
    text = F.col("text")
    plain = ~F.lower(text).startswith("to cite this article:") & ~is_cyrillic(text) & text.rlike(DAMAGED)
    explained = is_copyright(text) | is_notice(text) | is_author_index(text) | _any_of(text, TABLES) | is_contents(text)
    found = (F.col("n") < RAW_FIRST) & plain & ~explained
    return F.sort_array(F.collect_list(F.when(found, F.struct("n", _named(text).alias("names"))))).alias("_suspects")


def _is_right(suspect: Column, early: Column) -> Column:
    """Whether the polished stage has a suspect right: early blocks with its names, some of them marked as front matter with raised markers, aren't damaged and hold two of the names."""
    holds = lambda b: F.exists(suspect["names"], lambda name: b["lower"].contains(name))
    near = F.filter(early, lambda b: (b["n"] < REPAIRED_FIRST) & holds(b))
    held = F.size(F.filter(suspect["names"], lambda name: F.exists(near, lambda b: b["lower"].contains(name))))
    return F.exists(near, lambda b: b["marked"]) & ~F.exists(near, lambda b: b["damaged"]) & (held >= F.least(F.lit(2), F.size(suspect["names"])))


def _interruption(early: Column) -> Column:
    """Where two or more blocks of metadata stand between the halves of a sentence: a fold over a document's first blocks.

    A block that isn't metadata ends the gap before it and may begin another;
    blocks without text don't count; the last block that is looked at ends a
    gap whatever it is.
    """
    nothing = F.lit(None).cast("int")
    start = F.struct(F.lit(False).alias("left"), F.lit(0).alias("gap"), nothing.alias("first"), nothing.alias("found"))

    def step(acc: Column, b: Column) -> Column:
        last = b["n"] == GAP_LAST
        meta, blank = b["meta"] & ~last, (b["text"] == "") & ~last
        cut = acc["left"] & (acc["gap"] >= 2) & (b["tag"] == "p") & b["text"].rlike(GOES_ON)
        opens = (b["n"] < SENTENCE_FIRST) & (b["text"] != "") & (b["tag"] == "p") & ~b["text"].rlike(r"[.!?:;]\z") & ~b["meta"]
        more = F.struct(acc["left"].alias("left"), (acc["gap"] + 1).alias("gap"), F.coalesce(acc["first"], b["n"]).alias("first"), acc["found"].alias("found"))
        ended = F.struct(opens.alias("left"), F.lit(0).alias("gap"), nothing.alias("first"), F.when(cut, acc["first"]).alias("found"))
        return F.when(acc["found"].isNotNull() | blank, acc).when(meta, more).otherwise(ended)

    return F.aggregate(early, start, step, lambda acc: acc["found"])


def frontmatter_defects(raw: DataFrame, polish: DataFrame, keys: list[str]) -> DataFrame:
    """keys, id, severity, n of every defect.

    P01: damaged markers in an early raw block. P02: links in affiliations. P03:
    links on an author line. P25: a late block of the body marked as front
    matter. P100: metadata within a sentence, reported at its first block.

    Each stage's blocks are read once, and once for both if they are the same
    table: a partial aggregate holds a document's first blocks, a fixed number
    of them, and the first block of each rule.
    """
    text, attrs = F.col("text"), F.col("attrs")
    front, staff = has_class(attrs, FRONT), has_class(attrs, AFFILIATIONS)
    shown = F.transform(F.regexp_extract_all("raw", F.lit(REF_LINK_BODY), F.lit(1)), lambda b: F.replace(F.trim(F.regexp_replace(F.regexp_replace(b, "<[^>]+>", " "), r"\s+", " ")), F.lit("&nbsp;"), F.lit(" ")))
    markers = F.size(F.filter(shown, lambda b: b.rlike(r"^[\d\s,;–—-]+\z")))
    prose = F.regexp_replace(text, r"\s+[\d\s,;–—-]+\z", "").rlike(r"[.!?]\s*\z")
    authors = (markers >= 2) & (F.regexp_count(text, F.lit(TWO_NAMES)) >= 2) & ~text.rlike(BODY_LIKE) & ~text.rlike(r"\[\s*\d{1,3}") & ~prose & (F.regexp_count(text, F.lit(r"\w\.")) <= 2)
    listed = (F.lower(F.coalesce(attrs["block-type"], F.lit(""))) == "listgroup") | F.col("raw").rlike(r"(?i)<(?:ul|ol|li)\b")
    late = front & ~text.rlike(HEADING) & ~listed & (F.char_length(text) >= LATE_LENGTH) & text.rlike(LATE_BODY)
    true = lambda c: F.coalesce(c, F.lit(False))
    block = F.struct("n", "tag", "text", F.lower("text").alias("lower"), true(front | is_notice(text) | is_copyright(text)).alias("meta"), true((front | staff) & F.lower("raw").contains("<sup")).alias("marked"), text.rlike(DAMAGED).alias("damaged"))
    first = lambda c, name: F.min(F.when(c, F.col("n"))).alias(name)
    same = raw is polish
    pages = polish.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("n") <= GAP_LAST, block))).alias("_early"),
        first((F.col("n") < AFFILIATIONS_FIRST) & staff & F.col("raw").rlike(REF_LINK), "P02"),
        first((F.col("n") < AUTHORS_FIRST) & authors, "P03"),
        first((F.col("n") >= LATE) & late, "P25"),
        *([_suspects()] if same else []),
    )
    both = pages if same else pages.join(raw.where(F.col("n") < RAW_FIRST).groupBy(*keys).agg(_suspects()), keys, "full")
    early = F.coalesce("_early", F.array().cast(pages.schema["_early"].dataType))
    wrong = F.filter("_suspects", lambda s: ~_is_right(s, early))
    found = {"P01": F.get(wrong, F.lit(0))["n"], "P02": F.col("P02"), "P03": F.col("P03"), "P25": F.col("P25"), "P100": _interruption(early)}
    rows = [F.struct(F.lit(name).alias("id"), F.lit("warning" if name == "P01" else "error").alias("severity"), n.alias("n")) for name, n in found.items()]
    return both.select(*keys, F.inline(F.filter(F.array(*rows), lambda r: r["n"].isNotNull())))
