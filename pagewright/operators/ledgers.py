"""Ledgers of observations: the latest entry of each, patterns over runs, queues and groups of decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def problem_state(runs: Column, articles: Column, occurrences: Column) -> Column:
    return F.when((runs >= 2) | (articles >= 2) | (occurrences >= 3), "problem_candidate").otherwise("pattern_observation")


def latest(ledger: DataFrame, key: str, at: str, line: str) -> DataFrame:
    """The last entry of each key, ties by the later line, with first_seen and entries.

    An aggregate, not a sort of the key's entries: a key with a third of all
    rows is reduced before it is shuffled.
    """
    rest = [c for c in ledger.columns if c not in (key, at, line)]
    best = F.max(F.struct(F.col(at), F.col(line), *rest)).alias("last")
    return ledger.groupBy(key).agg(best, F.min(at).alias("first_seen"), F.count("*").alias("entries")).select(key, "last.*", "first_seen", "entries")


def pattern_history(observations: DataFrame, pattern: str, run: str, article: str, at: str) -> DataFrame:
    """Per pattern over all runs: occurrences, runs, articles, first and last time, state."""
    per = observations.groupBy(pattern).agg(F.count("*").alias("occurrences"), F.countDistinct(run).alias("runs"), F.countDistinct(article).alias("articles"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))
    return per.withColumn("state", problem_state(F.col("runs"), F.col("articles"), F.col("occurrences")))


def histogram(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """A map of value to count for each group, in order of the values."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias("counts"))


def decision_groups(decisions: DataFrame, by: list[str], article: str, samples: int = 5) -> DataFrame:
    """count, distinct articles and the first few of them for each group of decisions."""
    once = decisions.groupBy(*by, article).agg(F.count("*").alias("n"))
    sums = once.groupBy(*by).agg(F.sum("n").alias("count"), F.count("*").alias("articles"))
    # The first few of a group are among the first few of its parts, so no task orders a whole group.
    part = F.pmod(F.xxhash64(article), F.lit(64))
    near = once.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy(*by, "part").orderBy(article))).where(F.col("place") <= samples)
    few = near.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(article)), 1, samples).alias("sample"))
    return sums.join(few, by)


# The order of risks in a review queue.
RISKS = ("high", "medium", "low", "auto_verified")


def risk_order(risk: Column) -> Column:
    out = F.lit(len(RISKS))
    for i, r in reversed(list(enumerate(RISKS))):
        out = F.when(risk == r, i).otherwise(out)
    return out


def review_queue(scored: DataFrame, article: str) -> DataFrame:
    """Scored articles with their risk, whether a review is a must, and their place in the queue's order."""
    risk = F.when(F.col("errors") > 0, "high").when(F.col("warnings") >= 2, "medium").when(F.col("defects") > 0, "low").otherwise("auto_verified")
    out = scored.withColumn("risk", risk).withColumn("mandatory", F.col("errors") > 0)
    return out.select(article, "score", "defects", "risk", "mandatory", risk_order(F.col("risk")).alias("risk_rank"))


def queue_order() -> list[Column]:
    """Mandatory first, then by risk, score, defects and article."""
    return [F.desc("mandatory"), F.asc("risk_rank"), F.desc("score"), F.desc("defects")]
