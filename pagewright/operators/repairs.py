"""Deterministic repairs of markup, as phases of column expressions in a fixed order.

Each repair is guarded by a cheap test, so that text without its mark is
passed on as it is. A phase adds nothing but the repaired column.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagewright.functions import mojibake as wrong
from pagewright.functions import text as T

Repair = Callable[[Column], Column]


def guarded(mark: str, repair: Repair) -> Repair:
    """The repair where the mark is found, else the text itself."""
    return lambda c: F.when(c.contains(mark), repair(c)).otherwise(c)


def to_fixpoint(repair: Repair, rounds: int = 3) -> Repair:
    """A repair applied so many times; enough for marks nested so deep."""

    def run(c: Column) -> Column:
        for _ in range(rounds):
            c = repair(c)
        return c

    return run


def sub(pattern: str, value: str) -> Repair:
    return lambda c: F.regexp_replace(c, pattern, value)


@F.pandas_udf(StringType())
def mojibake(texts: pd.Series) -> pd.Series:
    """Characters of wrong decodings, mended until nothing changes. The only repair here that needs a loop over a text, so it isn't an expression."""
    return texts.map(wrong.mended, na_action="ignore")


def url_spaces(c: Column) -> Column:
    """Spaces that were broken into a URL: after its scheme, around its slashes and before its domain's end."""
    c = sub(r"(?i)\b(https?)\s*:\s*/\s*/\s*", "$1://")(c)
    c = sub(r"(?i)\b(?:hps|htps|ttps)://", "https://")(c)
    c = to_fixpoint(sub(r"(?i)(\bhttps?://[A-Za-z0-9._~:/?#=&%-]*/)\s+(?=[A-Za-z0-9_~-]+/)", "$1"), 4)(c)
    return sub(r"(?i)(\bhttps?://[A-Za-z0-9.-]+)\s+(?=/[A-Za-z0-9])", "$1")(c)


def tex_text(c: Column) -> Column:
    """Text commands of TeX as markup or plain text."""
    c = sub(r"\\label\{[^{}]*\}", "")(c)
    c = sub(r"\\textbf\{([^{}]*)\}", "<b>$1</b>")(c)
    c = sub(r"\\(?:textit|emph)\{([^{}]*)\}", "<i>$1</i>")(c)
    return sub(r"\\(?:textrm|text)\{([^{}]*)\}", "$1")(c)


#: The phases in order; a phase's repairs in order.
PHASES: dict[str, tuple[Repair, ...]] = {
    "pre_cleanup": (
        mojibake,
        sub(r"(?i)<\s*(/?)\s*(sup|sub)\s*>", "<$1$2>"),
        sub(r"(?i)&lt;(/?(?:sup|sub))&gt;", "<$1>"),
        sub(r"(?is)<p\b[^>]*>\s*page\s+\d+\s+of\s+\d+\s*</p>", ""),
        guarded("@ ", T.joined_addresses),
        guarded("http", url_spaces),
    ),
    "math_and_units": (
        guarded("\\", tex_text),
        sub(r"\\\(\s*\^\{?(\d{1,3}(?:\s*[,–-]\s*\d{1,3})*)\}?\s*\\\)", "<sup>$1</sup>"),
        sub(r"\\\(((?:(?!\\\)).)*?)\s*(\[\d{1,3}\])\s*\\\)", "\\\\($1\\\\) $2"),
        sub(r"(?is)<math\b[^>]*display=[\"']block[\"'][^>]*>([^<]*)</math>", "\\\\[$1\\\\]"),
        sub(r"(?is)<math\b[^>]*>([^<]*)</math>", "\\\\($1\\\\)"),
    ),
    "references_and_links": (
        guarded("#ref-", sub(r"(?is)(<a\b[^>]*href=[\"']#ref-\d+[\"'][^>]*>)\s*([)\]])\s*(\d+)</a>", "$2$1$3</a>")),
        guarded("#page-", sub(r"(?is)<a\b[^>]*href=[\"']#page-[^\"']*[\"'][^>]*>((?:\s*[A-Za-z]+){3,}\s*)</a>", "$1")),
        guarded("href", sub(r"(?i)(href=[\"'])(https?)\s*:\s*/\s*/\s*", "$1$2://")),
        guarded("&amp;amp;", lambda c: F.replace(c, F.lit("&amp;amp;"), F.lit("&amp;"))),
        guarded("doi", sub(r"(?i)\bdoi\s*:\s*(10\.\d{4,9})\s*/\s*", "doi:$1/")),
    ),
    "presentation": (
        sub(r"(?is)<p\b[^>]*>(?:\s|&nbsp;|<br\s*/?>)*</p>", ""),
        sub(r"(?i)(?:<br\s*/?>\s*){3,}", "<br><br>"),
        lambda c: F.when(c.rlike(r"(?i)<head\b") & ~c.rlike(r"(?i)<meta\b[^>]*charset"), F.regexp_replace(c, r"(?i)(<head\b[^>]*>)", '$1<meta charset="utf-8">')).otherwise(c),
    ),
}


def polish(df: DataFrame, html: str, out: str = "polished") -> DataFrame:
    """All phases over a column; one phase after the other, each its own projection."""
    df = df.withColumn(out, F.col(html))
    for repairs in PHASES.values():
        for repair in repairs:
            df = df.withColumn(out, repair(F.col(out)))
    return df


def without_broken_links(html: Column, ids: Column) -> Column:
    """Links within a page whose target is missing lose their anchor and keep their text.

    The missing targets make one pattern per row.
    """
    missing = F.array_except(F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)href=[\"']#([A-Za-z0-9_.:-]+)[\"']"), F.lit(1))), ids)
    quoted = F.array_join(F.transform(missing, lambda m: F.concat(F.lit("\\Q"), m, F.lit("\\E"))), "|")
    pattern = F.concat(F.lit("(?is)<a\\b[^>]*href=[\"']#(?:"), quoted, F.lit(")[\"'][^>]*>(.*?)</a>"))
    return F.when(F.size(missing) > 0, F.regexp_replace(html, pattern, F.lit("$1"))).otherwise(html)
