"""Where the modules of this package enter their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: So many rows are a task's share, however large a table is.
SHARE = 250_000


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys, to more tasks the more rows there are, so that what a task holds doesn't grow with the table. Tables are counted by their files' footers."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // SHARE + 1), *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
