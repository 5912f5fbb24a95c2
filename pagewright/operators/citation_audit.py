"""The family of defects that ranges without links make, from blocks.

A block is judged by itself. What a document's defects are is then a matter of
where its bibliography begins, which block of each kind comes first and which
targets its references have: over tables of blocks a window and aggregates, over
whole documents a pass that judges no block behind the one that counts.

Defined cases: a document without blocks has no defects; a document's first
block of a kind counts, and body comes before float, float before math.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from pagewright.functions import citation_documents, citation_ranges
from pagewright.functions.citation_documents import ASIDE, KINDS, REFERENCES, SIGNS

from . import structure

SEVERITY = {"P04": "error", "P04N": "warning", "P04R": "warning", "P04T": "warning", "P04M": "warning", "P28": "error", "P32": "warning"}


@F.pandas_udf(StructType().add("kind", StringType()).add("numbers", ArrayType(LongType())))
def _judged(tag: pd.Series, attrs: pd.Series, raw: pd.Series, text: pd.Series) -> pd.DataFrame:
    found = [citation_ranges.Block(t, dict(a or {}), r, x) for t, a, r, x in zip(tag, attrs, raw, text, strict=True)]
    kinds = [citation_ranges.kind(b) for b in found]
    return pd.DataFrame({"kind": kinds, "numbers": [citation_ranges.candidates(b) if k else [] for b, k in zip(found, kinds, strict=True)]})


def _body(keys: list[str]) -> Column:
    """Whether a block is of the article's body: before the bibliography, and neither front matter nor a footnote."""
    heading = F.min(F.when(F.col("text").rlike(REFERENCES), F.col("n"))).over(Window.partitionBy(*keys))
    aside = F.coalesce(*[F.when(structure.has_class(F.col("attrs"), c), True) for c in ASIDE], F.lit(False))
    own = F.coalesce(F.col("attrs")["id"], F.lit("")).startswith("ref-")
    return (heading.isNull() | (F.col("n") < heading)) & ~own & ~aside


def body_blocks(blocks: DataFrame, keys: list[str]) -> DataFrame:
    return blocks.withColumn("_body", _body(keys)).where("_body").drop("_body")


def judged(blocks: DataFrame) -> DataFrame:
    """Blocks with ``kind`` and ``numbers`` of their first range without a link, both empty where there is none.

    Only blocks with a bracket or a raised part go through the Arrow function.
    """
    can = F.col("raw").rlike(r"\[|<[sS][uU][pP]\b")
    only = lambda c, d="": F.when(can, F.col(c)).otherwise(d)
    told = blocks.withColumn("_told", _judged("tag", "attrs", only("raw"), only("text")))
    return told.select(*blocks.columns, "_told.kind", "_told.numbers")


def citation_defects(blocks: DataFrame, keys: list[str], references: DataFrame | None = None) -> DataFrame:
    """One row per defect: keys, id, severity, n (of the block), numbers and missing targets.

    ``references`` are the blocks that hold reference targets, if they aren't
    the same. Documents without targets have P04N; ranges of which some target
    is missing P04R; others P04. A range in a float or in mathematics counts
    only if one of its numbers could be a target, or there are no targets.
    Blocks are read once: the window that finds the bibliography and the
    aggregates by document share one shuffle.
    """
    note = F.regexp_extract(F.coalesce(F.col("attrs")["id"], F.lit("")), r"(?i)^footnote-(\d+)$", 1)
    marked = judged(blocks).withColumn("_body", _body(keys))
    first = lambda condition, value: F.min(F.when(F.col("_body") & condition, value))
    ranges = [first(F.col("kind") == k, F.struct("n", "numbers", "raw")).alias(k) for k in KINDS]
    signs = [first(F.col(column).rlike(pattern), F.col("n")).alias(name) for name, (column, pattern) in SIGNS.items()]
    found = marked.groupBy(*keys).agg(*ranges, *signs, F.array_distinct(F.flatten(F.collect_set(structure.own_references()))).alias("targets"), F.collect_set(F.when(note != "", note.cast("long"))).alias("footnotes"))
    if references is not None:
        found = found.drop("targets").join(structure.reference_numbers(references, keys).withColumnRenamed("numbers", "targets"), keys, "left")
    none = F.array().cast("array<long>")
    found = found.withColumns({"targets": F.coalesce("targets", none), "b": F.coalesce(*KINDS), "kind": F.coalesce(*[F.when(F.col(k).isNotNull(), k) for k in KINDS])})
    return _defects(found.withColumn("noted", _only_footnotes(F.coalesce("b.raw", F.lit("")), F.col("footnotes"))), keys)


def _defects(found: DataFrame, keys: list[str]) -> DataFrame:
    """The defects of documents, of each its first range ``b``, the range's kind, whether it names footnotes alone, its targets and where its signs are."""
    none = F.array().cast("array<long>")
    missing = F.array_except("b.numbers", "targets")
    cited, known = F.size("b.numbers") > 0, F.size("targets") > 0
    strange = cited & known & ~F.arrays_overlap("b.numbers", "targets")
    range_id = _range_id(F.col("kind"), known, cited & (F.size(missing) > 0), strange, F.col("noted"))
    rows = [F.when(range_id.isNotNull(), F.struct(range_id.alias("id"), F.col("b.n").alias("n"), F.col("b.numbers").alias("numbers"), F.when(range_id == "P04R", missing).otherwise(none).alias("missing")))]
    rows += [F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("id"), F.col(name).alias("n"), none.alias("numbers"), none.alias("missing"))) for name in SIGNS]
    severity = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    out = found.select(*keys, F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))
    return out.withColumn("severity", severity[F.col("id")])


_FOUND = StructType().add("b", StructType().add("n", IntegerType()).add("numbers", ArrayType(LongType()))).add("kind", StringType()).add("noted", BooleanType()).add("targets", ArrayType(LongType()))
for _name in SIGNS:
    _FOUND = _FOUND.add(_name, IntegerType())


@F.udf(_FOUND, useArrow=False)
def _summary(html: str | None) -> tuple:
    """Rows come in small batches, so that long documents don't add up."""
    return citation_documents.summary(html or "")


def document_defects(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """``citation_defects`` of documents by their own markup: no table of blocks is made, and none is shuffled. ``keys`` tell documents apart."""
    return _defects(df.select(*keys, _summary(html).alias("_found")).select(*keys, "_found.*"), keys)


@F.pandas_udf(BooleanType())
def _only_footnotes(raw: pd.Series, footnotes: pd.Series) -> pd.Series:
    return pd.Series([citation_ranges.only_footnotes(citation_ranges.Block("", {}, r, ""), set(f)) for r, f in zip(raw, footnotes, strict=True)])


def _range_id(kind: Column, known: Column, missing: Column, strange: Column, noted: Column) -> Column:
    body = F.when(~known, "P04N").when(missing, "P04R").otherwise("P04")
    return F.when(kind.isNull(), None).when(kind == "body", body).when(strange, None).when(kind == "float", "P04T").when(~noted, "P04M")
