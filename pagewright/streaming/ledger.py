"""The ledger as a stream: the same latest entries that the batch aggregate gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_stream(entries: DataFrame, key: str, at: str, line: str) -> DataFrame:
    """Per key the last entry, first_seen and entries, kept up to date as entries arrive."""
    rest = [c for c in entries.columns if c not in (key, at, line)]
    best = F.max(F.struct(F.col(at), F.col(line), *rest)).alias("last")
    return entries.groupBy(key).agg(best, F.min(at).alias("first_seen"), F.count("*").alias("entries")).select(key, "last.*", "first_seen", "entries")


def windowed_counts(entries: DataFrame, at: str, kind: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Entries per window and kind; a window closes when the watermark passes it."""
    return entries.withWatermark(at, late).groupBy(F.window(at, width).alias("window"), kind).agg(F.count("*").alias("entries")).select(F.col("window.start").alias("start"), kind, "entries")


def run_to_table(stream: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
    """Drive a stream over what is there now into a table in memory; for tests and small results."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def entries_of(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
