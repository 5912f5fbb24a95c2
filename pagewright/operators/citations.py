"""Citations: which style a text cites in, and what its reference numbers say about each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a citation looks like in each style.
PAREN = r"\(\s*\d{1,3}(?:\s*[,;–—-]\s*\d{1,3}){0,12}\s*\)"
BRACKET = r"\[\s*\d{1,3}(?:\s*[,;–—-]\s*\d{1,3}){0,12}\s*\]"
# Superscripts that became plain text: numbers between the end of a sentence and the next one's capital.
FLAT_SUPER = r"[.!?]\s+\d{1,3}(?:\s*[,;–—-]\s*\d{1,3}){1,12}\s+[A-Z]"
_NAME = r"[A-ZÀ-ÞА-ЯЁ][A-Za-zÀ-ÖØ-öø-ÿА-яЁё'’.-]+"
AUTHOR_YEAR = rf"(?iu)(?<![\w-]){_NAME}(?:\s+(?:et\s+al\.?|и\s+др\.?|(?:and|и)\s+{_NAME}|(?:&|&amp;)\s*{_NAME}))?(?:,\s*|\s+)\(?\d{{4}}[a-zа-яё]?\)?"

# The cascade of styles; the first that holds counts. SQL over the counts.
STYLES: tuple[tuple[str, str, str], ...] = (
    ("author_hint >= 5 AND author_hint >= greatest(5, signal * 2)", "author_year", "high"),
    ("NOT paired AND author_year >= 8 AND author_year >= greatest(8, signal * 2)", "author_year", "medium"),
    ("greatest(ref_links, numbered) >= 5 AND super_hint >= greatest(5, bracket * 2, floor((paren + 1) / 2))", "superscript_numeric", "high"),
    ("flat_super >= greatest(5, paren * 2, bracket * 2)", "superscript_numeric", "high"),
    ("ref_links >= 5 AND paren >= greatest(5, bracket * 2)", "paren_numeric", "high"),
    ("bracket >= 5 AND bracket >= greatest(5, paren * 2)", "bracket_numeric", "medium"),
    ("super_hint >= 5 AND super_hint > greatest(paren, bracket)", "superscript_numeric", "medium"),
    ("paren >= 5 AND paren > bracket", "paren_numeric", "medium"),
    ("bracket >= 5 AND bracket > paren", "bracket_numeric", "medium"),
    ("true", "unknown", "low"),
)


def style_case(part: int) -> str:
    return "CASE " + " ".join(f"WHEN {s[0]} THEN '{s[part]}'" for s in STYLES) + " END"


def styles(df: DataFrame, keys: list[str], text: Column, hints: dict[str, Column] | None = None) -> DataFrame:
    """keys, style, confidence, paren, bracket, author_year. Hints are counts from markup: ref_links, super_hint, author_hint, structure, numbered."""
    hints = hints or {}
    n = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    hint = lambda k: hints.get(k, F.lit(0)).cast("long").alias(k)
    counted = df.select(*keys, n(PAREN).alias("paren"), n(BRACKET).alias("bracket"), n(AUTHOR_YEAR).alias("author_year"), n(FLAT_SUPER).alias("flat_super"), *[hint(k) for k in ("ref_links", "super_hint", "author_hint", "structure", "numbered")])
    wide = counted.select("*", F.greatest("paren", "bracket", "flat_super", "super_hint", "structure", "numbered").alias("signal"), ((F.col("numbered") >= 5) & ((F.col("super_hint") >= 5) | (F.col("bracket") >= 5))).alias("paired"))
    return wide.select(*keys, F.expr(style_case(1)).alias("style"), F.expr(style_case(2)).alias("confidence"), "paren", "bracket", "author_year")


def reference_ids(html: Column) -> Column:
    """The numbers of a page's reference targets, sorted, once each."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r"(?i)\bid\s*=\s*['\"]ref-(\d+)['\"]"), F.lit(1)), lambda x: x.try_cast("int"))))


def missing_ids(ids: Column, widest: int = 25) -> Column:
    """Numbers between neighbours of a sorted list that aren't too far apart."""
    steps = F.transform(ids, lambda x, i: F.struct(x.alias("a"), F.get(ids, i + 1).alias("b")))
    near = F.filter(steps, lambda s: s["b"].isNotNull() & (s["b"] - s["a"] > 1) & (s["b"] - s["a"] <= widest))
    return F.flatten(F.transform(near, lambda s: F.sequence(s["a"] + 1, s["b"] - 1)))


def recovery_numbers(df: DataFrame, keys: list[str], html: Column, cited: Column) -> DataFrame:
    """keys, numbers, reason: references to look for again, gaps first, then cited numbers without a target."""
    base = df.select(*keys, reference_ids(html).alias("ids"), F.array_sort(F.array_distinct(cited)).alias("cited"))
    base = base.select("*", missing_ids(F.col("ids")).alias("gaps"), F.array_except("cited", "ids").alias("lost"))
    some = lambda c: F.size(c) > 0
    reason = F.when(some("gaps"), "reference_id_gap").when(some("ids") & some("lost"), "body_citation_missing_target").when(some("cited") & ~some("ids"), "body_citation").otherwise("")
    numbers = F.when(some("gaps"), F.col("gaps")).when(some("ids"), F.col("lost")).otherwise(F.col("cited"))
    return base.select(*keys, numbers.alias("numbers"), reason.alias("reason"))


def identity_defects(references: DataFrame, by: str, place: str, number: str) -> DataFrame:
    """by, place, number, defect: a number seen before, or a step over missing numbers. Rows in order of place."""
    order = Window.partitionBy(by).orderBy(place)
    seen = F.row_number().over(Window.partitionBy(by, number).orderBy(place)) > 1
    step = F.col(number) - F.lag(number).over(order)
    kind = F.when(seen, "duplicate_reference_number").when(step > 1, "reference_number_gap")
    return references.select(by, place, number, kind.alias("defect")).where(F.col("defect").isNotNull())


def matched_references(citations: DataFrame, references: DataFrame, by: str) -> DataFrame:
    """by, label, target for author-year labels that exactly one reference of their document fits.

    citations: (by, label, surnames, year); references: (by, target, words, year).
    Years and the first surname are keys of an equi-join; the other surnames are a filter.
    """
    c = citations.select(by, "label", "surnames", "year", F.lower(F.get("surnames", F.lit(0))).alias("key"))
    r = references.select(by, "target", "words", "year", F.explode(F.array_distinct(F.transform("words", lambda w: F.lower(w)))).alias("key"))
    both = c.join(r, [by, "year", "key"])
    fits = both.where(F.forall("surnames", lambda s: F.array_contains(F.transform("words", lambda w: F.lower(w)), F.lower(s))))
    return fits.groupBy(by, "label").agg(F.countDistinct("target").alias("n"), F.min("target").alias("target")).where("n = 1").drop("n")
