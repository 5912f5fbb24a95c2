"""Markup to rows: blocks, anchors, targets, and whether tags and links hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.text import stripped_tags

# Tags that make a block, longest names first, as one is the beginning of another.
BLOCK_TAGS = ("figcaption", "figure", "table", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "p")
BLOCK = "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?</{t}>" for t in BLOCK_TAGS)

#: Tags whose openers and closers are held against each other.
BALANCED = ("table", "figure", "ul", "ol", "div", "sup", "sub")


def without_hidden(html: Column) -> Column:
    """Markup without comments, scripts and styles."""
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for tag in ("script", "style"):
        html = F.regexp_replace(html, rf"(?is)<{tag}\b.*?</{tag}>", "")
    return html


def blocks(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, idx, tag, raw, text, has_img: blocks in order; a block ends at its tag's first closer."""
    rows = df.select(*keys, F.posexplode(F.regexp_extract_all(without_hidden(html), F.lit(BLOCK), F.lit(0))).alias("idx", "raw"))
    tag = F.lower(F.regexp_extract("raw", r"^<([A-Za-z0-9]+)", 1))
    return rows.select(*keys, F.col("idx").cast("long").alias("idx"), tag.alias("tag"), "raw", stripped_tags(F.col("raw")).alias("text"), F.col("raw").rlike(r"(?i)<img\b").alias("has_img"))


def tag_balance(df: DataFrame, keys: list[str], html: Column, tags: tuple[str, ...] = BALANCED) -> DataFrame:
    """keys, tag, opened, closed for each tag that isn't closed as often as opened."""
    each = F.array(*[F.struct(F.lit(t).alias("tag"), F.regexp_count("html", F.lit(rf"(?i)<{t}\b")).cast("long").alias("opened"), F.regexp_count("html", F.lit(rf"(?i)</{t}\s*>")).cast("long").alias("closed")) for t in tags])
    rows = df.select(*keys, without_hidden(html).alias("html")).select(*keys, F.explode(F.filter(each, lambda x: x["opened"] != x["closed"])).alias("t"))
    return rows.select(*keys, "t.*")


def anchors(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, href, text of each link with an href, in order of place."""
    links = F.regexp_extract_all(without_hidden(html), F.lit(r"(?is)<a\b[^>]*\bhref\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0))
    rows = df.select(*keys, F.posexplode(links).alias("place", "raw"))
    return rows.select(*keys, "place", F.regexp_extract("raw", r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1).alias("href"), stripped_tags(F.col("raw")).alias("text"))


def targets(html: Column) -> Column:
    """Every id and name that a link could lead to, once."""
    return F.array_distinct(F.filter(F.regexp_extract_all(html, F.lit(r"(?i)\b(?:id|name)\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1)), lambda x: x != ""))


def inner_links(html: Column) -> Column:
    """The targets that links within the page name, with repeats."""
    return F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]*\bhref\s*=\s*[\"']#([^\"']+)[\"']"), F.lit(1))


def link_assessment(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, links, broken_links, broken_targets: links within a page and those that lead nowhere."""
    base = df.select(*keys, inner_links(html).alias("hrefs"), targets(html).alias("ids"))
    broken = F.filter("hrefs", lambda h: ~F.array_contains(F.col("ids"), h))
    return base.select(*keys, F.size("hrefs").cast("long").alias("links"), F.size(broken).cast("long").alias("broken_links"), F.array_sort(F.array_distinct(broken)).alias("broken_targets"))


def repeated_targets(df: DataFrame, keys: list[str], html: Column) -> DataFrame:
    """keys, target, times for ids that a page has more than once."""
    rows = df.select(*keys, F.explode(F.regexp_extract_all(html, F.lit(r"(?i)\bid\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))).alias("target"))
    return rows.groupBy(*keys, "target").agg(F.count("*").alias("times")).where("times > 1")


def base_url(url: Column) -> Column:
    """A URL without its fragment and query, lower-cased up to its path."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return F.concat(F.lower(F.regexp_extract(bare, r"^([a-zA-Z]+://[^/]*)", 1)), F.regexp_replace(bare, r"^[a-zA-Z]+://[^/]*", ""))


def repeated_lines(df: DataFrame, group: str, key: str, text: Column, least: int = 3) -> DataFrame:
    """group, line, documents: short lines found in several documents of a group, such as heads and feet of pages.

    A line counts once per document; distinct counts are partial before the shuffle.
    """
    lines = df.select(group, key, F.explode(F.array_distinct(F.split(text, "\n"))).alias("line"))
    lines = lines.select(group, key, F.trim(F.regexp_replace(F.lower("line"), r"\d+", "#")).alias("line")).where("line != '' AND length(line) <= 120").distinct()
    return lines.groupBy(group, "line").agg(F.count("*").alias("documents")).where(F.col("documents") >= least)
