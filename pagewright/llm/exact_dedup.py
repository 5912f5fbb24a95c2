"""Exact deduplication as a stateful stream.

The documents are first laid down once as a content store. A stream over that
store keeps, per digest and without expiry, the identifier and the content
locator of the row that stays, in RocksDB on the executors' disks with its log
in the shared folder. A hit on a known digest is settled by the full bytes:
the row's content is fetched by its locator and compared with the content of
the row that stays. Only DataFrame functions run on the executors.

Defined cases: a null text counts as empty, and all empty texts are equal; a
null id sorts after every id; repeated rows are told apart by their locator, so
exactly one row of each group stays; an empty table gives an empty result.
Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_path, materialize, shared_path, stripped

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BROADCAST_ROWS = 500_000
#: What all state stores of an executor may hold in memory together, and one store's write buffer.
STATE_MB, WRITE_BUFFER_MB = 256, 4


def sha256(normalised: Column) -> Column:
    return F.sha2(F.encode(normalised, "UTF-8"), 256)


def _best() -> Column:
    """The row that stays comes first: most code points, then smallest id, then first written."""
    return F.min(F.struct(-F.col("n_points"), F.col("id").isNull().alias("no_id"), F.col("id"), F.col("locator")))


def digest_state(spark, store: str, schema, max_files: int | None = None) -> DataFrame:
    """Run the stream over what the store has now; return the state it ends with.

    One row per digest: digest, n_rows, best. Each micro-batch appends the keys
    that it changed, and a key's last entry is its state.
    """
    log, checkpoint = shared_path(spark, "dedup-state"), shared_path(spark, "dedup-stream")
    rocks = "spark.sql.streaming.stateStore.rocksdb"
    names = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        f"{rocks}.changelogCheckpointing.enabled": "true",
        f"{rocks}.allowFAllocate": "false",
        f"{rocks}.boundedMemoryUsage": "true",  # else each partition's store has buffers of its own, and an executor has many
        f"{rocks}.maxMemoryUsageMB": str(STATE_MB),
        f"{rocks}.writeBufferSizeMB": str(WRITE_BUFFER_MB),
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        state = reader.parquet(store).groupBy("digest").agg(F.count("*").alias("n_rows"), _best().alias("best"))

        def keep(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{log}/batch-{number}")

        query = state.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        batches = int((query.lastProgress or {}).get("batchId", -1)) + 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    drop_path(spark, checkpoint)
    if not batches:
        return state_schema(spark)
    found = spark.read.option("recursiveFileLookup", "true").parquet(log)
    if batches > 1:
        found = found.groupBy("digest").agg(F.max_by(F.struct("n_rows", "best"), "batch").alias("last")).select("digest", "last.*")
    return found.select("digest", "n_rows", "best")


def state_schema(spark) -> DataFrame:
    return spark.createDataFrame([], "digest string, n_rows long, best struct<col1: int, no_id: boolean, id: long, locator: long>")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, max_files: int | None = None, carry: list[str] | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest, and the columns in ``carry``.

    Texts are equal when they agree after all white space is deleted. ``digest``
    may be any function of the normalised text; a weak one costs time, not
    correctness, since bytes decide. ``max_files`` bounds a micro-batch. Up to
    ``broadcast_rows`` shared digests, and rows that share them, are broadcast,
    so that only the texts of hits are shuffled; beyond that all texts are.
    """
    spark, carry = docs.sparkSession, carry or []
    store = shared_path(spark, "dedup-content")
    raw = docs[text_col].cast("string")
    text = F.coalesce(raw, F.lit(""))
    laid = docs.select(docs[id_col].alias("id"), F.char_length(text).alias("n_points"), raw.alias("text"), digest(stripped(text)).alias("digest"), F.monotonically_increasing_id().alias("locator"), *[docs[c].alias(f"carry_{i}") for i, c in enumerate(carry) if c != text_col])
    laid.write.option("compression", "zstd").parquet(store)
    content = spark.read.schema(laid.schema).parquet(store)
    slim = content.select("id", "n_points", "digest", "locator").schema
    state = digest_state(spark, store, slim, max_files)

    shared = materialize(state.where("n_rows > 1").select("digest", F.col("best.locator").alias("keeper")), "dedup-shared")
    few = shared.count() <= broadcast_rows
    hits = content.select("id", "n_points", "digest", "locator", stripped(F.coalesce("text", F.lit(""))).alias("bytes")).join(F.broadcast(shared) if few else shared, "digest")
    hits = materialize(hits, "dedup-hits")
    keepers = hits.where("locator = keeper").select("digest", F.col("bytes").alias("kept_bytes"))
    compared = hits.join(keepers, "digest").select("id", "n_points", "digest", "locator", F.when(F.col("bytes") != F.col("kept_bytes"), F.col("bytes")).alias("other"))
    compared = materialize(compared, "dedup-compared")
    groups = compared.groupBy("digest", "other").agg(F.count("*").alias("size"), _best().alias("best"))
    groups = groups.select(F.col("digest").alias("g_digest"), F.col("other").alias("g_other"), "size", F.col("best.id").alias("best_id"), F.col("best.locator").alias("best_locator"))
    settled = compared.join(groups, (F.col("digest") == F.col("g_digest")) & F.col("other").eqNullSafe(F.col("g_other"))).select(F.col("locator").alias("s_locator"), "size", "best_id", "best_locator")
    settled = materialize(settled, "dedup-settled")
    few = settled.count() <= broadcast_rows
    out = content.join(F.broadcast(settled) if few else settled, F.col("locator") == F.col("s_locator"), "left")
    alone = F.col("s_locator").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("locator") == F.col("best_locator"))).alias("kept"),
        F.col("digest"),
        *[F.col("text" if c == text_col else f"carry_{i}").alias(c) for i, c in enumerate(carry)],
    )
