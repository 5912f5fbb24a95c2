"""Audits over ordered blocks: rows with (keys, idx, tag, text, has_img) to defect rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CAPTION = r"(?i)^(?:fig(?:ure)?\.?|table)\s*s?\d+"


def is_caption(text: Column) -> Column:
    return text.rlike(CAPTION)


def uppercase_share(text: Column) -> Column:
    letters = F.char_length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.when(letters > 0, F.char_length(F.regexp_replace(text, "[^A-Z]", "")) / letters).otherwise(F.lit(0.0))


def block_defects(blocks: DataFrame, by: list[str], window: int = 3) -> DataFrame:
    """by, idx, defect: all neighbourhood rules from one ordering of each document's blocks.

    A caption without an image near it; a heading right before a caption that
    is mostly capitals; an equation number alone after a table; the same text
    twice in a row; a sentence that is broken off and goes on after an image.
    """
    order = Window.partitionBy(*by).orderBy("idx")
    near = order.rowsBetween(-window, window)
    before = order.rowsBetween(-4, -1)
    heading = F.col("tag").rlike("^h[1-6]$")
    wide = blocks.select(
        *by,
        "idx",
        "tag",
        "text",
        "has_img",
        F.max("has_img").over(near).alias("img_near"),
        F.lead("text").over(order).alias("next"),
        F.lag("text").over(order).alias("last"),
        F.coalesce(F.max(F.col("tag") == "table").over(before), F.lit(False)).alias("table_before"),
        F.lead("has_img").over(order).alias("next_img"),
        F.lead("text", 2).over(order).alias("second"),
    )
    rules = {
        "caption_without_image": is_caption(F.col("text")) & F.col("text").rlike("(?i)^fig") & ~F.col("img_near"),
        "heading_before_caption": heading & is_caption(F.coalesce("next", F.lit(""))) & (F.char_length("text") <= 120) & (uppercase_share(F.col("text")) > 0.6),
        "orphan_equation_number": F.col("text").rlike(r"^\(\d{1,3}\)$") & F.col("table_before"),
        "repeated_block": (F.col("text") == F.col("last")) & (F.char_length("text") >= 20),
        "sentence_broken_by_image": F.coalesce(F.col("next_img"), F.lit(False)) & F.col("text").rlike(r"[a-z,]$") & F.coalesce(F.col("second").rlike("^[a-z]"), F.lit(False)),
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))
    return wide.select(*by, "idx", F.explode(found).alias("defect"))


def in_references(blocks: DataFrame, by: list[str]) -> DataFrame:
    """The blocks with a flag for those in the bibliography: from its heading on."""
    start = F.col("tag").rlike("^h[1-6]$") & F.lower("text").isin("references", "bibliography", "works cited")
    order = Window.partitionBy(*by).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("in_references", F.coalesce(F.max(start).over(order), F.lit(False)))


def nearest_label(blocks: DataFrame, by: list[str], label: str, window: int) -> DataFrame:
    """The blocks with the nearest label before and after them, so many places away at most."""
    order = Window.partitionBy(*by).orderBy("idx")
    return blocks.withColumn("label_before", F.last(label, True).over(order.rowsBetween(-window, -1))).withColumn("label_after", F.first(label, True).over(order.rowsBetween(1, window)))
