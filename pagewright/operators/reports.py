"""The report of a run: a record for each article, and one row of what they sum up to.

A report of a large corpus is no single document. Its articles stay rows, with
their nested parts as structs and maps, and only sums by defect and by metric
meet in one row.

Defined cases: an article that has defects or metrics alone has a record; a
defect without an id is ``unknown`` in its counts, but no pattern of its own in
the score; whether a defect counts is unknown only as long as it isn't denied;
metrics without a value don't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .defects import DISTINCT_WEIGHT, LINK_WEIGHTS, OTHER_WEIGHT, SEVERITY_WEIGHTS, is_counted

#: Metrics that are the growth from one stage's to another's.
GROWTH = {"ref_links_delta": ("raw_ref_links", "ref_links"), "fig_links_delta": ("raw_fig_links", "fig_links"), "table_links_delta": ("raw_table_links", "table_links"), "page_links_delta": ("raw_page_links", "page_links")}


def _map_of(key: str, value: str) -> Column:
    """Rows of a group as a map in the order of its keys."""
    return F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value))))


def with_growth(metrics: DataFrame, article: str, pairs: dict[str, tuple[str, str]] = GROWTH) -> DataFrame:
    """Metrics (article, metric, value) with what follows from pairs of them; one that is missing counts as zero."""
    rows = [F.struct(F.lit(name).alias("metric"), (F.coalesce(F.sum(F.when(F.col("metric") == after, F.col("value"))), F.lit(0.0)) - F.coalesce(F.sum(F.when(F.col("metric") == before, F.col("value"))), F.lit(0.0))).alias("value"), F.bool_or(F.col("metric").isin(before, after)).alias("there")) for name, (before, after) in pairs.items()]
    found = metrics.groupBy(article).agg(F.array(*rows).alias("r")).select(article, F.inline(F.filter("r", lambda x: x["there"]))).drop("there")
    return metrics.select(article, "metric", "value").unionByName(found)


def article_records(defects: DataFrame, metrics: DataFrame, article: str) -> DataFrame:
    """article, score, defects, errors, warnings, infos, unique_ids, defect_ids (a map), metrics (a map).

    ``defects`` has article, id, severity and counted; ``metrics`` article,
    metric and value. Both are reduced by partial aggregates to a row per
    article before they meet.
    """
    counted = defects.where(is_counted(F.col("counted"))).withColumn("_id", F.coalesce(F.nullif("id", F.lit("")), F.lit("unknown")))
    by_id = counted.groupBy(article, "_id").agg(F.count("*").alias("n"), *[F.count(F.when(F.col("severity") == s, 1)).alias(s) for s in ("error", "warning", "info")], F.bool_or(F.coalesce(F.col("id") != "", F.lit(False))).alias("named"))
    sums = {"defects": F.sum("n"), "errors": F.sum("error"), "warnings": F.sum("warning"), "infos": F.sum("info"), "named": F.count(F.when(F.col("named"), 1)), "unique_ids": F.count("*")}
    per = by_id.groupBy(article).agg(*[c.alias(k) for k, c in sums.items()], _map_of("_id", "n").alias("defect_ids"))
    values = with_growth(metrics.where("value IS NOT NULL"), article).groupBy(article, "metric").agg(F.max("value").alias("value"))
    measured = values.groupBy(article).agg(_map_of("metric", "value").alias("metrics"))
    both = per.join(measured, article, "full")
    zero = {k: F.coalesce(k, F.lit(0)) for k in sums}
    weight = F.coalesce(F.aggregate(F.map_entries("metrics"), F.lit(0.0), lambda acc, e: acc + F.coalesce(F.create_map(*[F.lit(x) for kv in LINK_WEIGHTS.items() for x in kv])[e["key"]], F.lit(0.0)) * e["value"]), F.lit(0.0))
    other = zero["defects"] - zero["errors"] - zero["warnings"]
    score = zero["errors"] * SEVERITY_WEIGHTS["error"] + zero["warnings"] * SEVERITY_WEIGHTS["warning"] + other * OTHER_WEIGHT + zero["named"] * DISTINCT_WEIGHT + weight
    none = F.map_from_entries(F.array().cast("array<struct<key:string,value:bigint>>"))
    return both.select(article, F.round(score, 2).alias("score"), *[zero[k].alias(k) for k in ("defects", "errors", "warnings", "infos", "unique_ids")], F.coalesce("defect_ids", none).alias("defect_ids"), F.coalesce("metrics", F.map_from_entries(F.array().cast("array<struct<key:string,value:double>>"))).alias("metrics"))


def run_totals(records: DataFrame) -> DataFrame:
    """One row: article_count, score, defects, errors, warnings, infos, and the metrics' sums as a map."""
    sums = records.agg(F.count("*").alias("article_count"), F.round(F.coalesce(F.sum("score"), F.lit(0.0)), 2).alias("score"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("defects", "errors", "warnings", "infos")])
    by_metric = records.select(F.explode("metrics").alias("metric", "value")).groupBy("metric").agg(F.round(F.sum("value"), 2).alias("value"))
    return sums.crossJoin(by_metric.agg(_map_of("metric", "value").alias("metrics")))  # one row beside one row


def pattern_counts(defects: DataFrame, article: str) -> DataFrame:
    """id, counted, observed, uncounted: how many articles have a defect that counts, one at all, and one that only doesn't count."""
    per = defects.groupBy("id", article).agg(F.bool_or(is_counted(F.col("counted"))).alias("counts"))
    return per.groupBy("id").agg(F.count(F.when(F.col("counts"), 1)).alias("counted"), F.count("*").alias("observed"), F.count(F.when(~F.col("counts"), 1)).alias("uncounted"))


def ranking(records: DataFrame, article: str) -> DataFrame:
    """Records with the worst first."""
    return records.orderBy(F.desc("score"), article)
