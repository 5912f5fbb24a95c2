"""Filter interaction audit: every order of the filters, replayed.

Documents are measured once, which gives one bit for each filter they fail.
Each document then meets every order of the filters (120 for five: a table of a
fixed size, broadcast) and every step of that order. Where the first failure of
the document falls decides what the step does to it, and conditional counts by
part, order and step are combined on the map side, so that what is shuffled is
a row per task, part, order and step, however many documents a part has.

Defined cases: a null text counts as empty; a null part is the empty string, as
is an empty one; a null id is never a copy of a smaller id nor has it labels,
and no id is smaller than null; rows that share an id and a text are no copies
of each other; labels that come several times for an id count once if any of
them says so; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of, words

BROADCAST_ROWS = 100_000

Rule = Callable[[Column, Column], Column]

#: Each filter's failure, from the text and its words; COPY is failed by tables, not by a text alone.
FILTERS: dict[str, Rule] = {
    "A": lambda text, w: F.size(w) < 200,
    "B": lambda text, w: 100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
    "C": lambda text, w: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
    "D": lambda text, w: text.rlike("[#$%&*|]"),
}
COPY = "E"


def bits(letters: str) -> dict[str, int]:
    return {letter: 1 << i for i, letter in enumerate(letters)}


def document_flags(docs: DataFrame, part: str | None = None, filters: dict[str, Rule] = FILTERS, copy: str | None = COPY, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, part, and ``failed``, a bit for each filter in the order of its letters.

    Texts are read once. Equal texts are found by their SHA-256; a text's
    smallest id is a partial aggregate, and only texts that come more than once
    are joined back: broadcast after a count, or by a shuffle whose hot texts
    Spark splits.
    """
    letters = "".join(filters) + (copy or "")
    bit = bits(letters)
    text = text_of(docs)
    of = docs[part].cast("string") if part else F.lit("")
    read = docs.select(docs["doc_id"], F.coalesce(of, F.lit("")).alias("part"), text.alias("_text"))
    # the words are named once for all filters: a projection of their own keeps them from being made again
    failed = F.element_at(F.transform(F.array(words(F.col("_text"))), lambda w: sum((F.when(rule(F.col("_text"), w), bit[name]).otherwise(0) for name, rule in filters.items()), F.lit(0))), 1)
    slim = read.select("doc_id", "part", failed.alias("failed"), F.sha2(F.encode("_text", "UTF-8"), 256).alias("_digest"))
    if copy is None:
        return slim.drop("_digest")
    slim = materialize(slim.withColumn("_digest", F.unhex("_digest")), "flags")
    shared = slim.groupBy("_digest").agg(F.count("*").alias("_n"), F.min("doc_id").alias("_least")).where("_n > 1 AND _least IS NOT NULL")
    shared = materialize(shared.select("_digest", "_least"), "shared-texts")
    few = shared.count() <= broadcast_rows
    joined = slim.join(F.broadcast(shared) if few else shared.hint("merge"), "_digest", "left")
    return joined.select("doc_id", "part", (F.col("failed") + F.when(F.col("doc_id") > F.col("_least"), bit[copy]).otherwise(0)).alias("failed"))


def with_labels(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """The flags with ``good`` and ``toxic``, false where a document has no label.

    Documents without an id go their own way: they match nothing, and dealt by
    their key they would all meet in one task.
    """
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce(labels["quality"] == 1, F.lit(False))).alias("good"), F.max(F.coalesce(labels["toxic"] == 1, F.lit(False))).alias("toxic"))
    known = flags.where("doc_id IS NOT NULL").join(told, "doc_id", "left")
    known = known.select("part", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    return known.unionByName(flags.where("doc_id IS NULL").select("part", "failed", F.lit(False).alias("good"), F.lit(False).alias("toxic")))


def orders(spark, letters: str) -> DataFrame:
    """Every order of the letters: filter_order, and its filters' bits in that order."""
    bit = bits(letters)
    rows = [("".join(p), [bit[x] for x in p]) for p in itertools.permutations(letters)]
    return spark.createDataFrame(rows, "filter_order string, bits array<int>")


def replay(flags: DataFrame, letters: str) -> DataFrame:
    """Counts for each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, and the filter's removals over all orders.

    ``flags`` has part, failed, good and toxic.
    """
    n = len(letters)
    replayed = flags.crossJoin(F.broadcast(orders(flags.sparkSession, letters)))
    fails = lambda i: F.col("failed").bitwiseAND(F.get("bits", F.lit(i))) != 0
    first = F.coalesce(*[F.when(fails(i), i + 1) for i in range(n)], F.lit(n + 1))
    replayed = replayed.select("part", "filter_order", "failed", "good", "toxic", first.alias("first"), F.posexplode("bits").alias("_at", "bit"))
    step = F.col("_at") + 1
    removed = F.col("first") == step
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    counted = replayed.groupBy("part", "filter_order", step.alias("step")).agg(
        count(F.col("first") > step, "kept"),
        count(removed, "removed"),
        count((F.col("first") < step) & (F.col("failed").bitwiseAND(F.col("bit")) != 0), "redundant"),
        count(F.col("failed") == F.col("bit"), "unique_fails"),
        count(removed & F.col("good"), "good_lost"),
        count(removed & F.col("toxic"), "toxic_lost"),
    )
    same = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return counted.withColumn("shapley", F.sum("removed").over(same))


def audit(docs: DataFrame, labels: DataFrame, part: str | None = "source", filters: dict[str, Rule] = FILTERS, copy: str | None = COPY) -> DataFrame:
    """The replay of all orders of ``filters`` (and of ``copy``, equal to a text of a smaller id) over whole texts."""
    return replay(with_labels(document_flags(docs, part, filters, copy), labels), "".join(filters) + (copy or ""))
