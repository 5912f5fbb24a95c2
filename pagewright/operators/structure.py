"""Blocks and anchors of documents as tables, with exact offsets.

Table functions read one document's markup and yield its rows; a lateral join
puts them beside the document's own columns, and ``register`` gives them names
for SQL. Everything after that is joins, windows and aggregates over the rows.

Defined cases: a null text has no rows; elements that are never closed have
none either; repeated attributes count by their last value.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from pagewright.functions import markup

BLOCK = "n: int, start: int, stop: int, line: int, tag: string, attrs: map<string,string>, raw: string, text: string"


def _row(n: int, html: str, e: markup.Element, open_entities: bool = True) -> tuple:
    raw = html[e.start : e.stop]
    return n, e.start, e.stop, e.line, e.tag, e.attrs, raw, markup.visible(raw, open_entities)


@udtf(returnType=BLOCK)
class MarkupBlocks:
    """Blocks of a document, in order; with ``overlapping``, blocks inside of blocks too; ``open_entities`` as in ``markup.visible``."""

    def eval(self, html: str, overlapping: bool, open_entities: bool = True) -> Iterator[tuple]:
        for n, e in enumerate(markup.elements(html or "", overlapping=bool(overlapping))):
            yield _row(n, html, e, open_entities)


@udtf(returnType=f"{BLOCK}, nested: boolean")
class ReferenceBlocks:
    """Blocks among which each reference item is one of its own."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, (e, nested) in enumerate(markup.reference_elements(html or "")):
            yield *_row(n, html, e), nested


@udtf(returnType=BLOCK)
class WarningBlocks:
    """Blocks that warn of a missing figure."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, e in enumerate(markup.warning_elements(html or "")):
            yield _row(n, html, e)


@udtf(returnType="n: int, start: int, stop: int, line: int, attrs: map<string,string>, href: string, body_start: int, body_stop: int, label: string")
class MarkupAnchors:
    """Anchors of a document: where they and their contents are, their targets and what they show."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, e in enumerate(markup.elements(html or "", ("a",))):
            yield n, e.start, e.stop, e.line, e.attrs, e.attrs.get("href"), e.body_start, e.body_stop, markup.visible(html[e.body_start : e.body_stop])


@udtf(returnType="n: int, text: string")
class ShownUnits:
    """What a reader sees of a block: each table cell, or the whole."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from enumerate(markup.shown_units(html or ""))


NAMES = {"markup_blocks": MarkupBlocks, "reference_blocks": ReferenceBlocks, "warning_blocks": WarningBlocks, "markup_anchors": MarkupAnchors, "shown_units": ShownUnits}


def register(spark: SparkSession) -> None:
    """The table functions by name, for ``SELECT ... FROM t, LATERAL markup_blocks(t.html, false)``."""
    for name, function in NAMES.items():
        spark.udtf.register(name, function)


def blocks(df: DataFrame, html: str, overlapping: bool = False, open_entities: bool = True) -> DataFrame:
    """The columns of ``df`` beside each of its blocks."""
    return df.lateralJoin(MarkupBlocks(F.col(html).outer(), F.lit(overlapping), F.lit(open_entities)))


def reference_blocks(df: DataFrame, html: str) -> DataFrame:
    return df.lateralJoin(ReferenceBlocks(F.col(html).outer()))


def warning_blocks(df: DataFrame, html: str) -> DataFrame:
    return df.lateralJoin(WarningBlocks(F.col(html).outer()))


def anchors(df: DataFrame, html: str) -> DataFrame:
    return df.lateralJoin(MarkupAnchors(F.col(html).outer()))


def line_of(line_starts: Column, offset: Column) -> Column:
    """The line of an offset, from the sorted starts of all lines."""
    return F.size(F.filter(line_starts, lambda s: s <= offset))


def has_class(attrs: Column, name: str) -> Column:
    return F.array_contains(F.split(F.coalesce(attrs["class"], F.lit("")), r"\s+"), name)


def own_references() -> Column:
    """The numbers of a block's reference targets: of its own id, and of ids inside it."""
    own = F.regexp_extract(F.coalesce(F.col("attrs")["id"], F.lit("")), r"(?i)^ref-(\d+)$", 1)
    inside = F.regexp_extract_all("raw", F.lit(r"""(?i)\bid\s*=\s*['"]ref-(\d+)['"]"""), F.lit(1))
    return F.filter(F.concat(F.array(own), inside), lambda x: x != "").cast("array<long>")


def reference_numbers(found: DataFrame, keys: list[str]) -> DataFrame:
    """The numbers of each document's reference targets; documents without any have no row."""
    return found.select(*keys, F.explode(own_references()).alias("number")).groupBy(*keys).agg(F.sort_array(F.collect_set("number")).alias("numbers"))


def enclosing(anchors: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Anchors with the block they lie in, by a merge of both tables' offsets and not by comparing pairs: blocks don't overlap."""
    b = blocks.select(*keys, F.col("start").alias("at"), F.struct("n", "start", "stop", "tag").alias("block"), F.lit(None).cast("struct<n:int,start:int,stop:int,href:string,label:string>").alias("anchor"))
    a = anchors.select(*keys, F.col("start").alias("at"), F.lit(None).cast("struct<n:int,start:int,stop:int,tag:string>").alias("block"), F.struct("n", "start", "stop", "href", "label").alias("anchor"))
    before = Window.partitionBy(*keys).orderBy("at", F.col("anchor").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = b.unionByName(a).withColumn("_open", F.last("block", ignorenulls=True).over(before)).where("anchor IS NOT NULL")
    inside = F.when(F.col("_open.stop") >= F.col("anchor.stop"), F.col("_open"))
    return met.select(*keys, F.col("anchor.n").alias("n"), F.col("anchor.href").alias("href"), F.col("anchor.label").alias("label"), inside["n"].alias("block"), inside["tag"].alias("tag"))
