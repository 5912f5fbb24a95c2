"""Ordered rows within a document: neighbours, runs, gaps, intervals, ranges and nearest starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_within(flag: Column, by: list[str], order: str, before: int, after: int) -> Column:
    """Whether a flag holds for any row so many places before or after."""
    return F.coalesce(F.max(flag).over(Window.partitionBy(*by).orderBy(order).rowsBetween(-before, after)), F.lit(False))


def longest_run(df: DataFrame, by: str, number: str) -> DataFrame:
    """by, first, length: the longest run of consecutive numbers, the earliest of equals. Repeats count once."""
    once = df.select(by, number).distinct()
    island = F.col(number) - F.row_number().over(Window.partitionBy(by).orderBy(number))
    runs = once.withColumn("island", island).groupBy(by, "island").agg(F.min(number).alias("first"), F.count("*").alias("length"))
    best = runs.groupBy(by).agg(F.max(F.struct("length", (-F.col("first")).alias("before"), "first")).alias("best"))
    return best.select(by, F.col("best.first").alias("first"), F.col("best.length").alias("length"))


def gaps(df: DataFrame, by: str, number: str) -> DataFrame:
    """by, missing: each number between a group's least and greatest that it lacks."""
    next_ = F.lead(number).over(Window.partitionBy(by).orderBy(number))
    steps = df.select(by, number).distinct().withColumn("next", next_).where(F.col("next") - F.col(number) > 1)
    return steps.select(by, F.explode(F.sequence(F.col(number) + 1, F.col("next") - 1)).alias("missing"))


def merged_intervals(df: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """by, start, end, n: intervals that touch or overlap, as one."""
    order = Window.partitionBy(by).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    island = F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = df.select(by, start, end).withColumn("fresh", fresh).withColumn("island", island)
    return marked.groupBy(by, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n")).drop("island")


def expanded_ranges(text: Column, widest: int = 25, most: int = 250) -> Column:
    """"3,5-8" as [3, 5, 6, 7, 8]: ranges too wide and numbers out of bounds are left out, repeats kept once."""
    parts = F.split(F.regexp_replace(text, r"\s+", ""), ",")
    bounds = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^(\d+)", 1).try_cast("int").alias("a"), F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(p, r"-(\d+)$", 1), F.lit("")), F.lit("999999999")).try_cast("int"), F.regexp_extract(p, r"^(\d+)", 1).try_cast("int")).alias("b")))
    fit = F.filter(bounds, lambda x: x["a"].isNotNull() & (x["a"] >= 1) & (x["b"] <= most) & (x["b"] >= x["a"]) & (x["b"] - x["a"] <= widest))
    return F.array_distinct(F.flatten(F.transform(fit, lambda x: F.sequence(x["a"], x["b"]))))


def nearest_before(events: DataFrame, starts: DataFrame, by: str, at: str, start: str) -> DataFrame:
    """Each event with the latest start of its group that isn't after it.

    Both sides are one ordered stream per group; the last start seen is carried
    along, so nothing is joined by range.
    """
    left = events.select("*", F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(starts.schema[start].dataType).alias("nearest_start"))
    right = starts.select(by, F.col(start).alias("_t"), F.lit(0).alias("_kind"), F.col(start).alias("nearest_start"))
    both = left.unionByName(right, allowMissingColumns=True)
    order = Window.partitionBy(by).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("nearest_start", F.last("nearest_start", ignorenulls=True).over(order)).where("_kind = 1").drop("_t", "_kind")
