"""Runs compared: deltas by article, totals, gates, and how a repaired document moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("score", "defects", "errors", "warnings")


def compare_runs(previous: DataFrame, current: DataFrame, article: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Full outer join of two runs: article, comparison_state, a delta for each measure, verdict."""
    old = previous.select(F.col(article).alias("old_key"), *[F.col(m).alias(f"old_{m}") for m in measures])
    new = current.select(F.col(article).alias("new_key"), *[F.col(m).alias(f"new_{m}") for m in measures])
    both = old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")
    state = F.when(F.col("old_key").isNull(), "new").when(F.col("new_key").isNull(), "removed").otherwise("comparable")
    delta = lambda m: F.round(F.coalesce(F.col(f"new_{m}"), F.lit(0)) - F.coalesce(F.col(f"old_{m}"), F.lit(0)), 2).alias(f"{m}_delta")
    out = both.select(F.coalesce("new_key", "old_key").alias(article), state.alias("comparison_state"), *[delta(m) for m in measures])
    first = F.col(f"{measures[0]}_delta")
    verdict = F.when(F.col("comparison_state") != "comparable", F.col("comparison_state")).when(first > 0, "regression").when(first < 0, "improvement").otherwise("unchanged")
    return out.withColumn("verdict", verdict)


def gate_failures(compared: DataFrame, article: str, max_regressions: int, total_limits: dict[str, float], article_limits: dict[str, float]) -> DataFrame:
    """kind, article, metric, observed, limit: what stops a run.

    Totals cover the articles that both runs have; an article's own limits
    hold for those that got worse.
    """
    worse = compared.where("verdict = 'regression'")
    comparable = compared.where("comparison_state = 'comparable'")
    count = worse.agg(F.count("*").cast("double").alias("observed")).select(F.lit("regressions").alias("kind"), F.lit(None).cast("string").alias("article"), F.lit("regressions").alias("metric"), "observed", F.lit(float(max_regressions)).alias("limit"))
    limits = lambda d: F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.lit(float(v)).alias("limit")) for k, v in sorted(d.items())])).alias("l")
    sums = comparable.agg(*[F.coalesce(F.round(F.sum(k), 2), F.lit(0.0)).cast("double").alias(k) for k in sorted(total_limits)])
    value = lambda d: F.element_at(F.create_map(*[x for k in sorted(d) for x in (F.lit(k), F.col(k).cast("double"))]), F.col("l.metric"))
    totals = sums.select("*", limits(total_limits)).select(F.lit("total_delta").alias("kind"), F.lit(None).cast("string").alias("article"), F.col("l.metric").alias("metric"), value(total_limits).alias("observed"), F.col("l.limit").alias("limit"))
    own = worse.select("*", limits(article_limits)).select(F.lit("article_delta").alias("kind"), F.col(article).cast("string").alias("article"), F.col("l.metric").alias("metric"), value(article_limits).alias("observed"), F.col("l.limit").alias("limit"))
    return count.unionByName(totals).unionByName(own).where("observed > limit")


def classify(before: Column, after: Column, grown: Column, same: Column, failed: Column) -> Column:
    """How a repair moved a document, from the sums of its defects before and after; the order decides."""
    return F.when(failed, "repolish_failed").when(after == 0, "fixed").when(grown, "regressed").when(after < before, "improved").when(same, "unchanged").otherwise("regressed")


def deltas(before: DataFrame, after: DataFrame, article: str) -> DataFrame:
    """article, before, after, fixed, new, classification, action from two multisets (article, id)."""
    b = before.groupBy(article, "id").agg(F.count("*").alias("b"))
    a = after.groupBy(article, "id").agg(F.count("*").alias("a"))
    both = b.join(a, [article, "id"], "full_outer").fillna(0, ["a", "b"])
    gone, new = F.greatest(F.col("b") - F.col("a"), F.lit(0)), F.greatest(F.col("a") - F.col("b"), F.lit(0))
    per = both.groupBy(article).agg(F.sum("b").alias("before"), F.sum("a").alias("after"), F.sum(gone).alias("fixed"), F.sum(new).alias("new"))
    kind = classify(F.col("before"), F.col("after"), F.col("new") > 0, (F.col("new") == 0) & (F.col("fixed") == 0), F.lit(False))
    action = F.when(F.col("classification").isin("fixed", "improved"), "repolish").when(F.col("classification") == "repolish_failed", "artifact_repair_or_reconvert").otherwise("code_fix_or_reconvert")
    return per.withColumn("classification", kind).withColumn("action", action)


def upsert(previous: DataFrame, targeted: DataFrame, key: str, allow_new: bool = True) -> DataFrame:
    """The previous rows with the targeted ones in their place; unknown keys join only if allowed."""
    kept = previous.join(targeted.select(key), key, "left_anti")
    added = targeted if allow_new else targeted.join(previous.select(key), key, "left_semi")
    return kept.unionByName(added)


def totals(df: DataFrame, metrics: str = "metrics") -> DataFrame:
    """metric, total, articles with any: a map of metrics summed by key."""
    rows = df.select(F.explode(metrics).alias("metric", "value"))
    return rows.groupBy("metric").agg(F.sum("value").alias("total"), F.count_if(F.col("value") != 0).alias("articles"))
