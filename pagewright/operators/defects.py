"""Detectors: documents to defect rows, by a table of patterns, and what is counted from the rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.sources import shared


@dataclass(frozen=True)
class Rule:
    """A defect with an id, how severe it is, and what shows it. ``needs`` is a part that whatever matches has: texts without it aren't searched."""

    id: str
    severity: str
    check: str
    pattern: str
    needs: str = ""


#: A seed of rules; a corpus brings its own.
RULES: tuple[Rule, ...] = (
    Rule("D01", "warning", "repeated_marks", r"[!?]{2,}"),
    Rule("D02", "error", "symbol_noise", r"[#$%&*]{3}"),
    Rule("D03", "info", "pipe_rows", r" \| "),
    Rule("D04", "warning", "mail_address", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}"),
    Rule("D05", "error", "secret_like", r"[0-9a-f]{40}"),
    Rule("D06", "info", "licence_line", r"[Ll]icen[cs]e"),
    Rule("D07", "warning", "long_number", r"[0-9]{12,}"),
)

# Severities and what a link metric weighs.
SEVERITY_WEIGHTS = {"error": 10.0, "warning": 3.0}
BROADCAST_ROWS = 100_000
OTHER_WEIGHT, DISTINCT_WEIGHT = 0.5, 0.25
LINK_WEIGHTS = {"broken_internal_links": 4.0, "internal_page_anchor_links": 1.0, "external_page_query_links": 1.0, "table_units_with_section_ids": 5.0, "polish_replacement_chars": 1.0}


def detect(df: DataFrame, keys: list[str], text: Column, rules: Iterable[Rule] = RULES) -> DataFrame:
    """One row per document and rule that it breaks: keys, id, severity, check, hits, snippet.

    All rules are tested in one scan; a document's broken rules leave it as an
    array, so rows are made only for what was found. A text is searched to a
    rule's first match; only where there is one are all of them counted.
    """
    text_ = F.col("text")
    holds = lambda r: text_.contains(r.needs) & text_.rlike(r.pattern) if r.needs else text_.rlike(r.pattern)
    hit = lambda r: F.struct(F.lit(r.id).alias("id"), F.lit(r.severity).alias("severity"), F.lit(r.check).alias("check"), F.regexp_count("text", F.lit(r.pattern)).cast("long").alias("hits"), F.regexp_extract("text", f"({r.pattern})", 1).alias("snippet"))
    found = F.array_compact(F.array(*[F.when(holds(r), hit(r)) for r in rules]))
    base = df.select(*keys, text.alias("text"))
    rows = base.select(*keys, F.explode(found).alias("d"))
    return rows.select(*keys, "d.*")


def is_counted(flag: Column) -> Column:
    """Counted unless the flag is exactly false."""
    return F.coalesce(flag, F.lit(True))


def hit_counts(defects: DataFrame, article: str) -> DataFrame:
    """Articles per defect id."""
    return defects.groupBy("id").agg(F.countDistinct(article).alias("corpus_hits"))


def with_hit_counts(defects: DataFrame, article: str) -> DataFrame:
    """Each defect row with how many articles have its id. The rows are written once, so that texts are searched once; the counts are broadcast after they were counted."""
    found = shared.materialize(defects, "defects")
    counts = shared.materialize(hit_counts(found, article), "hit-counts")
    few = counts.count() <= BROADCAST_ROWS
    return found.join(F.broadcast(counts) if few else counts.hint("merge"), "id")


def article_scores(defects: DataFrame, article: str) -> DataFrame:
    """article, score, defects, errors, warnings, infos: the weighted sum, two decimals."""
    of = lambda s: F.count_if(F.col("severity") == s)
    per = defects.groupBy(article).agg(F.count("*").alias("defects"), of("error").alias("errors"), of("warning").alias("warnings"), F.countDistinct("id").alias("ids"))
    other = F.col("defects") - F.col("errors") - F.col("warnings")
    score = F.col("errors") * SEVERITY_WEIGHTS["error"] + F.col("warnings") * SEVERITY_WEIGHTS["warning"] + other * OTHER_WEIGHT + F.col("ids") * DISTINCT_WEIGHT
    return per.select(article, F.round(score, 2).alias("score"), "defects", "errors", "warnings", other.alias("infos"))


def link_score(metrics: Column) -> Column:
    """What a map of link metrics adds to a score."""
    part = sum((F.coalesce(F.element_at(metrics, k), F.lit(0.0)) * w for k, w in LINK_WEIGHTS.items()), F.lit(0.0))
    return F.round(part, 2)
