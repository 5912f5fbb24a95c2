"""Mixing sources to target weights.

Tokens are summed per source, a repetition rate per source follows from its
target, and each document is emitted floor(rate) times plus one copy more when
a hash of its id and its text falls below the fraction. Nothing is drawn at
random, so reruns agree.

Defined cases: a null text has no words; a null source is a source of its own,
last in order; documents without words are emitted like any others; a source
without words has the rate 0; an empty table gives an empty result. Rows
without an id are drawn by their texts; rows that repeat an id and a text share
their draw.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of, word_count

WEIGHTS = (3, 1, 2)
#: Rates of so many sources are broadcast to the documents; beyond, documents are shuffled to them.
BROADCAST_ROWS = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """Targets per source from (source, source_size): one row per source, a small table.

    Sources in code point order, null last, weigh ``weights``, repeating. They
    share ``share`` of all tokens by weight; a target stops at ``most`` times
    its source's size, and what that frees goes to the others by weight. In the
    order of size / weight the stopped sources come first, so running sums find
    them at once.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    table = sizes.withColumn("place", place).withColumn("weight", cycle)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("source_size").cast("double")
    table = table.select("*", (F.sum(size).over(every) * share).alias("whole"), F.sum("weight").over(every).alias("all_weight"), F.coalesce(F.sum(size).over(before) * most, F.lit(0.0)).alias("spent"), F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("spent_weight"))
    stopped = (F.col("whole") - F.col("spent")) * F.col("weight") >= size * most * (F.col("all_weight") - F.col("spent_weight"))
    table = table.withColumn("stopped", stopped)
    left = F.col("whole") - F.coalesce(F.sum(F.when(F.col("stopped"), size)).over(every) * most, F.lit(0.0))
    left_weight = F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(every)
    target = F.when(F.col("stopped"), size * most).otherwise(left * F.col("weight") / left_weight)
    return table.select("source", "source_size", target.alias("target"), F.when(F.col("source_size") > 0, target / size).otherwise(F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, rows: bool = False) -> DataFrame:
    """One row per document with its number of copies: id, size, source_size, target, rate, copies; with ``rows`` also the whole row as a struct ``row``."""
    size = F.coalesce(word_count(docs[text_col].cast("string")), F.lit(0)).cast("long")
    sized = docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), size.alias("size"), F.md5(F.encode(text_of(docs, text_col), "UTF-8")).alias("digest"), *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if rows else []))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sums, weights, share, most).withColumnRenamed("source", "t_source"), "rates")
    few = targets.count() <= BROADCAST_ROWS
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"), F.col("digest"))
    drawn = F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, 8), 16, 10).cast("double") / 4294967296.0
    copies = F.floor("rate") + (drawn < F.col("rate") - F.floor("rate")).cast("long")
    joined = sized.join(F.broadcast(targets) if few else targets.hint("merge"), F.col("source").eqNullSafe(F.col("t_source")))
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", "rate", copies.cast("long").alias("copies"), *(["row"] if rows else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row, as many times as it is taken."""
    taken = mix(docs, rows=True, **options).where("copies > 0")
    return taken.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select("row.*")
