"""The catalogue of detectors over converted pages, by id.

Three tables of rules, each tested in one pass: over a page's text, over its
blocks and over its links. What needs several rows of a page (numbers seen
twice, targets that are missing) is a window or an aggregate over the same
rows. Patterns are our own; a corpus adds its rules to the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import visible
from pagewright.operators import audits, citations, defects, pages

#: Over the visible text of a page: at most one row per rule and page.
TEXT_RULES: tuple[defects.Rule, ...] = (
    defects.Rule("P24X", "info", "end_matter_heading", r"(?i)\b(?:acknowledge?ments|funding|conflicts? of interest)\b"),
    defects.Rule("P35", "warning", "replacement_character", r"�", needs="�"),
    defects.Rule("P52", "warning", "doi_split_after_slash", r"\b10\.[0-9]{4,9}/ +[a-z0-9]+[./-][a-z0-9]", needs="10."),
    defects.Rule("P64", "warning", "mail_split_before_suffix", r"\b[a-z]+ (?:v|i|x|ix|vi)@[a-z]", needs="@"),
    defects.Rule("P65", "error", "runaway_mark", r"[!?]{6,}"),
    defects.Rule("P74", "error", "runaway_macro", r"(?:\\[a-z]+\{){6,}", needs="\\"),
    defects.Rule("P75", "warning", "doi_joined_to_prose", r"\b10\.[0-9]{4,9}/[A-Za-z0-9.]+[0-9](?:The|This|We|In)\b", needs="10."),
    defects.Rule("P76", "warning", "detached_accent", r"[A-Za-z][ ]?[´¨˜][ ]?[a-z]"),
    defects.Rule("P81", "warning", "page_header_in_text", r"(?i)\bpage [0-9]+ of [0-9]+\b"),
    defects.Rule("P84", "warning", "escaped_markup", r"(?i)<sup>|</sup>"),
    defects.Rule("P86", "warning", "mail_split_after_dot", r"@[A-Za-z0-9-]+\. [a-z]{2,4}\b", needs="@"),
    defects.Rule("P88", "warning", "domain_split", r"\bwww\. [a-z]", needs="www. "),
    defects.Rule("P89", "warning", "mail_split_after_at", r"[A-Za-z0-9._%+-]+@ [A-Za-z0-9-]+\.[a-z]{2,}", needs="@ "),
    defects.Rule("R08", "info", "glued_suffix", r"\b[a-z]{4,}(?:iii|vii)\b"),
    defects.Rule("R11", "info", "broken_hyphen", r"[a-z]- [a-z]{2,}", needs="- "),
    defects.Rule("R12", "info", "split_micro_unit", r"\b[0-9]+ ?µ [a-zA-Z]\b", needs="µ"),
)

#: Over the markup itself.
MARKUP_RULES: tuple[defects.Rule, ...] = (
    defects.Rule("P15", "info", "links_without_target_style", r"(?i)<a\b[^>]*href=[\"']#"),
    defects.Rule("P28", "error", "tex_superscript_citation", r"\\\(\s*\^\{?[0-9]{1,3}", needs="\\("),
    defects.Rule("P34", "error", "double_closed_anchor", r"(?i)</a>\s*</a>"),
    defects.Rule("P63", "error", "bracket_citation_is_page_link", r"(?i)<a\b[^>]*href=[\"']#page-[^>]*>\s*\[[0-9]"),
    defects.Rule("P49", "warning", "digit_of_table_reference_linked", r"(?i)\btable\s*<a\b[^>]*>[0-9]+</a>"),
    defects.Rule("R14", "error", "sentinel", r"@@[A-Z_]{4,}@@", needs="@@"),
)


def raw_checks(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, id, severity, check: whether a page is empty, and whether html and body open and close once."""
    n = lambda p: F.regexp_count("html", F.lit(p))
    base = df.select(*keys, F.coalesce(html, F.lit("")).alias("html"))
    uneven = (n(r"(?i)<html\b") != n(r"(?i)</html>")) | (n(r"(?i)<body\b") != n(r"(?i)</body>")) | (n(r"(?i)<body\b") == 0)
    rules = [("R01", "error", "empty_page", F.trim("html") == ""), ("R02", "error", "page_frame", uneven), ("R03X", "info", "no_image", n(r"(?i)<img\b") == 0)]
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(i).alias("id"), F.lit(s).alias("severity"), F.lit(k).alias("check"))) for i, s, k, c in rules]))
    return base.select(*keys, F.explode(found).alias("d")).select(*keys, "d.*")


@dataclass(frozen=True)
class BlockRule:
    id: str
    severity: str
    check: str
    holds: Callable[[], Column]


_t, _r = lambda: F.col("text"), lambda: F.col("raw")

BLOCK_RULES: tuple[BlockRule, ...] = (
    BlockRule("P02", "error", "affiliation_links_references", lambda: (F.col("idx") < 25) & _r().rlike(r"(?i)class=[\"'][^\"']*affil") & _r().contains("#ref-")),
    BlockRule("P07", "error", "citation_in_formula", lambda: _r().rlike(r"\\\([^()]*[^\s\\(]\s*\[[0-9]{1,3}\][^()]*\\\)")),
    BlockRule("P09", "error", "equation_absorbed_prose", lambda: _t().rlike(r"\([0-9]{1,3}\)\s+(?:where|As shown)\b")),
    BlockRule("P10", "warning", "prose_in_equation", lambda: _r().rlike(r"(?i)class=[\"'][^\"']*equation") & _t().rlike(r"^Fig(?:ure|\.)\s*[0-9]+\s+shows")),
    BlockRule("P12", "warning", "caption_residue", lambda: audits.is_caption(_t()) & (_t().rlike(r"\\[a-z]+\{") | _t().contains("&lt;a"))),
    BlockRule("P25", "error", "late_front_matter", lambda: (F.col("idx") >= 40) & _r().rlike(r"(?i)class=[\"'][^\"']*front-?matter") & (F.char_length(_t()) >= 80)),
    BlockRule("P27", "warning", "duplicate_number_prefix", lambda: _t().rlike(r"^([0-9]{1,3})\. \[\1\]")),
    BlockRule("P38", "warning", "box_is_only_its_label", lambda: _t().rlike(r"^Box [0-9]+$")),
    BlockRule("P41", "warning", "prose_after_table_doi", lambda: _t().rlike(r"\.t[0-9]{3}\s+[a-z][a-z ]{19,219}$")),
    BlockRule("P44", "warning", "affiliation_page_glue", lambda: (F.col("idx") < 25) & _r().rlike(r"(?i)href=[\"']#page-[^>]*>i[0-9]+</a>")),
    BlockRule("P73", "warning", "author_marker_glued", lambda: (F.col("idx") < 20) & _t().rlike(r"[A-Z][a-z]+100(?:,|$)")),
    BlockRule("P77", "error", "table_absorbed_section", lambda: (F.col("tag") == "table") & _r().rlike(r"(?i)<h[1-6]\b|<figcaption\b")),
    BlockRule("P79", "warning", "number_glued_to_department", lambda: _t().rlike(r"\b[0-9]Department\b")),
    BlockRule("P93", "warning", "line_number_in_prose", lambda: _t().rlike(r"^[0-9]{1,3}[05] [a-z]")),
    BlockRule("R07", "info", "page_of", lambda: _t().rlike(r"(?i)^page [0-9]+ of [0-9]+$")),
    BlockRule("R13", "warning", "capital_heading", lambda: F.col("tag").rlike("^h[1-6]$") & (F.char_length(_t()) >= 40) & (audits.uppercase_share(_t()) >= 0.75) & _t().rlike("(?i)figure|table")),
)


def block_audit(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, idx, id, severity, check over blocks (keys, idx, tag, raw, text)."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(r.holds(), F.lit(False)), F.struct(F.lit(r.id).alias("id"), F.lit(r.severity).alias("severity"), F.lit(r.check).alias("check"))) for r in BLOCK_RULES]))
    return blocks.select(*keys, "idx", F.explode(found).alias("d")).select(*keys, "idx", "d.*")


def link_audit(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, id, severity, check, href, text over the links of a page.

    Labels against targets, and links whose label says they should be of
    another kind.
    """
    links = pages.anchors(df, keys, html).join(df.select(*keys, citations.reference_ids(html).alias("ids")), keys)
    target = F.regexp_extract("href", r"^#ref-(\d+)$", 1).try_cast("int")
    label = F.regexp_extract("text", r"^[\[(]?(\d{1,4})[\])]?$", 1).try_cast("int")
    page = F.col("href").startswith("#page-")
    rules = [
        ("P04R", "warning", "reference_target_missing", target.isNotNull() & (F.size("ids") > 0) & ~F.array_contains("ids", target)),
        ("P37", "error", "letter_absorbed_by_citation", target.isNotNull() & F.col("text").rlike(r"^[a-z][0-9]{1,4}$")),
        ("P42", "error", "label_is_not_target", target.isNotNull() & label.isNotNull() & (label != target) & ~label.between(1800, 2099)),
        ("P43", "warning", "equation_is_page_link", page & F.col("text").rlike(r"^[0-9]+\.[0-9]+$")),
        ("P51", "warning", "prose_is_page_link", page & F.col("text").rlike(r"^(?:[A-Za-z]+ ){2,}[A-Za-z]+$")),
        ("P56", "warning", "author_year_is_page_link", page & F.col("text").rlike(r"^[A-Z][A-Za-z'-]+.*\b(?:19|20)[0-9]{2}[a-z]?\)?$")),
        ("P98", "error", "bare_number_link", target.isNotNull() & F.col("text").rlike(r"^[0-9]{1,3}$") & (F.size("ids") == 0)),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(i).alias("id"), F.lit(s).alias("severity"), F.lit(k).alias("check"))) for i, s, k, c in rules]))
    return links.select(*keys, "href", "text", F.explode(found).alias("d")).select(*keys, "d.*", "href", "text")


def reference_audit(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, id, severity, check, number over a page's reference items: numbers that differ from their id, come twice, or are missing."""
    items = df.select(*keys, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<li\b[^>]*\bid=[\"']ref-\d+[\"'][^>]*>[^<]*"), F.lit(0))).alias("place", "item"))
    items = items.select(*keys, "place", F.regexp_extract("item", r"ref-(\d+)", 1).try_cast("int").alias("target"), F.nullif(F.regexp_extract("item", r">\s*\[?(\d{1,3})[\].)]", 1), F.lit("")).try_cast("int").alias("visible"))
    order = Window.partitionBy(*keys).orderBy("place")
    again = F.row_number().over(Window.partitionBy(*keys, "visible").orderBy("place")) > 1
    wide = items.select("*", again.alias("again"), (F.col("target") - F.lag("target").over(order)).alias("step"), F.count("visible").over(Window.partitionBy(*keys)).alias("n_visible"))
    rules = [
        ("P21", "error", "number_is_not_id", F.col("visible").isNotNull() & (F.col("visible") != F.col("target"))),
        ("P22", "warning", "number_twice", F.col("visible").isNotNull() & F.col("again")),
        ("P26", "warning", "gap_in_ids", F.col("step") > 1),
        ("P97", "warning", "number_not_visible", F.col("visible").isNull() & (F.col("n_visible") > 0)),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(i).alias("id"), F.lit(s).alias("severity"), F.lit(k).alias("check"))) for i, s, k, c in rules]))
    return wide.select(*keys, F.col("target").alias("number"), F.explode(found).alias("d")).select(*keys, "d.*", "number")


def audit(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, id, severity, check, place, in the fixed order of the detectors: frame, text, markup, blocks, links, references."""
    text = defects.detect(df, keys, visible(html), TEXT_RULES).select(*keys, "id", "severity", "check", F.lit(None).cast("string").alias("place"), F.lit(1).alias("step"))
    markup = defects.detect(df, keys, html, MARKUP_RULES).select(*keys, "id", "severity", "check", F.lit(None).cast("string").alias("place"), F.lit(2).alias("step"))
    frame = raw_checks(df, keys, html).select(*keys, "id", "severity", "check", F.lit(None).cast("string").alias("place"), F.lit(0).alias("step"))
    blocks = block_audit(pages.blocks(df, keys, html), keys).select(*keys, "id", "severity", "check", F.col("idx").cast("string").alias("place"), F.lit(3).alias("step"))
    links = link_audit(df, keys, html).select(*keys, "id", "severity", "check", F.col("href").alias("place"), F.lit(4).alias("step"))
    references = reference_audit(df, keys, html).select(*keys, "id", "severity", "check", F.col("number").cast("string").alias("place"), F.lit(5).alias("step"))
    return frame.unionByName(text).unionByName(markup).unionByName(blocks).unionByName(links).unionByName(references)


#: What is done about a defect, by id: accepted as it is, or looked for elsewhere.
ACCEPTED = ("P15", "P24X", "R03X", "R07", "R08")
RECOVERED = {"P04R": "needs_pdf_reference_recovery", "P26": "needs_pdf_reference_recovery", "P61": "needs_semantic_recovery", "P62": "needs_pdf_recovery"}


def decision(id_: Column, counted: Column) -> Column:
    """A resolver's decision on a defect."""
    out = F.when(id_.isin(*ACCEPTED), "accepted_telemetry")
    for k, v in RECOVERED.items():
        out = out.when(id_ == k, v)
    return out.when(counted, "needs_repair").otherwise("needs_review")
