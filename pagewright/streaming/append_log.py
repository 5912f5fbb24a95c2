"""An append-only log of records as JSON lines, written by batches or by a stream.

Each batch has a number and a folder of its own, which is replaced whole: a
batch that a restart writes again is there once, however often it was tried. A
reader forgives one thing only, a last line of a file that was cut off while it
was written; any other line that is no object is an error.

Defined cases: blank lines are passed over; an empty batch has no lines; a log
without lines has no last entry; nulls stay nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append(records: DataFrame, path: str, number: int) -> None:
    """Write a batch once by its number."""
    records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(f"{path}/batch={number}")


def append_stream(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what a stream has now; a later call goes on where this one, or one that was broken off, left."""
    query = records.writeStream.foreachBatch(lambda batch, number: append(batch, path, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def lines(spark: SparkSession, path: str) -> DataFrame:
    """batch, file, line (from 1), value and whether the line is the cut end of its file. A file is one task's part of one batch.

    Files are read line by line and may be of any size. A file's lines are
    numbered by a window over its blocks and the order within them, which
    spills. Its last line is cut off if the lines have a byte more than the
    file, the end of the line that isn't there.
    """
    meta = lambda c: F.col(f"_metadata.{c}")
    found = spark.read.option("lineSep", "\n").text(path).select("batch", meta("file_path").alias("file"), meta("file_block_start").alias("_block"), meta("file_size").alias("_size"), F.monotonically_increasing_id().alias("_id"), "value")
    # a line may have others in it that end in a carriage return alone
    parts = F.posexplode(F.split(F.regexp_replace("value", r"\r\z", ""), "\r")).alias("_part", "line_text")
    found = found.select("batch", "file", "_block", "_size", "_id", (F.octet_length("value") + 1).cast("long").alias("_bytes"), F.col("value").endswith("\r").alias("_whole"), parts)
    order = Window.partitionBy("batch", "file").orderBy("_block", "_id", "_part")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.select("batch", "file", F.row_number().over(order).alias("line"), F.col("line_text").alias("value"), (F.lead("line_text").over(order).isNull() & ~F.col("_whole") & (F.sum(F.when(F.col("_part") == 0, F.col("_bytes"))).over(so_far) > F.col("_size"))).alias("last"))
    return found.where("trim(value) != ''")


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log's records with their batch, file and line."""
    rows = lines(spark, path)
    parsed = F.try_parse_json("value")
    good = parsed.isNotNull() & F.schema_of_variant(parsed).startswith("OBJECT")
    error = F.raise_error(F.concat(F.lit("no object in line "), F.col("line").cast("string"), F.lit(" of "), F.col("file")))
    rows = rows.withColumn("_good", F.when(good, True).when(F.col("last") & parsed.isNull(), False).otherwise(error))
    return rows.where("_good").select("batch", "file", "line", F.from_json("value", schema).alias("r")).select("batch", "file", "line", "r.*")


def last_entry(entries: DataFrame, keys: list[str]) -> DataFrame:
    """The entry that was appended last, for each of the keys, by partial aggregates."""
    rest = [c for c in entries.columns if c not in keys]
    place = F.struct("batch", "file", "line")
    out = entries.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("_last"), F.count("*").alias("entries"))
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest if c not in ("file", "line")], "entries")
