"""Sinks: manifests with checksums, stages as partitions, and upserted queues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest(files: DataFrame) -> DataFrame:
    """article, raw and polish checksums and sizes, and whether both stages are there once."""
    of = lambda stage: F.count_if(F.col("stage") == stage)
    per = files.groupBy("article").agg(of("01.en.raw").alias("raws"), of("02.en.polish").alias("polishes"), F.count("*").alias("files"), F.array_sort(F.collect_list(F.struct("stage", "sha256", F.octet_length("html").alias("size")))).alias("stages"))
    return per.withColumn("valid", (F.col("raws") == 1) & (F.col("polishes") == 1) & (F.col("files") == 2))


def write_stage(df: DataFrame, path: str, stage: str) -> None:
    """Write documents as one stage; the stages of a corpus are partitions, and a stage is replaced whole."""
    df.withColumn("stage", F.lit(stage)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage").parquet(path)


def upserted_queue(queue: DataFrame, entries: DataFrame, keys: list[str], at: str) -> DataFrame:
    """A queue with new entries: the latest of each key stays."""
    both = queue.unionByName(entries)
    rest = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max(F.struct(at, *[c for c in rest if c != at])).alias("last")).select(*keys, "last.*")


def language_csv(decisions: DataFrame, path: str) -> None:
    decisions.write.mode("overwrite").option("header", "true").csv(path)
