"""What the operators share: the text convention, tables in the shared folder, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space by the convention of every operator here: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, as in
    tests on one machine, a temporary folder is made once per application.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="pagewright-")
        spark.sparkContext.setCheckpointDir(_own_dir[app])
    return _own_dir[app]


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    This cuts lineage: a lost executor costs a re-read, never a recomputation,
    and values such as row numbers stay as they were written.
    """
    path = shared_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def stripped(text: Column) -> Column:
    """The text without any white space."""
    return F.regexp_replace(text, SPACE + "+", "")


def words(text: Column) -> Column:
    """Runs of characters that aren't white space, in order."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def word_count(text: Column) -> Column:
    """How many words the text has, without building them."""
    return F.regexp_count(text, F.lit(NOT_SPACE + "+"))


def with_rank(df: DataFrame, out: str, order: list[Column], by: list[str] | None = None, rows: int = 20_000, total: int | None = None, run: Column | None = None, parts: Column | None = None) -> DataFrame:
    """Number the rows from 0 without gaps (within ``by``), in an order that is fixed but arbitrary.

    Rows are dealt to buckets by a hash of ``order``; each bucket is numbered
    on its own and shifted by the sizes of the buckets before it, so that no
    task ever holds more than a bucket. Equal keys may share a bucket: only
    rows that repeat whole keys do.

    With ``run``, a hash as a long, rows are numbered in its order at every
    size: a bucket is a range of it, and ``order`` begins with it. A run of more
    than ``rows`` rows needs ``parts`` above 1, by which its rows are split.
    """
    by = by or []
    total = df.count() if total is None else total
    buckets = max(1, -(-total // rows))
    dealt = F.xxhash64(*order)
    if run is None:
        bucket, part = F.pmod(dealt, F.lit(buckets)), F.lit(0).cast("long")
    else:
        share = run.cast("double") / F.lit(2.0**64) + F.lit(0.5)
        bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("long")
        part = F.pmod(dealt, F.coalesce(parts, F.lit(1)).cast("long")) if parts is not None else F.lit(0).cast("long")
    df = df.withColumn("_bucket", bucket).withColumn("_part", part)
    keys = [*by, "_bucket", "_part"]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    sizes = sizes.select(*keys, (F.sum("_n").over(before.orderBy("_bucket", "_part")) - F.col("_n")).alias("_before"))
    own = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn("_at", F.row_number().over(own) - 1)
    on = [numbered[c].eqNullSafe(sizes[c]) for c in keys]
    joined = numbered.join(sizes, on, "left")
    own_columns = [numbered[c] for c in df.columns if c not in ("_bucket", "_part")]
    return joined.select(*own_columns, (F.col("_at") + F.col("_before")).alias(out))
