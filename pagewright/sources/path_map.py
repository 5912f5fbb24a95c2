"""Maps from articles to source files, whose records have many shapes.

Records are VARIANT values, so no schema has to hold for all of them: a record
is a path, or an object with a path under one of several names, or an object
with lists of matches, each of which is a path, an object or a list again.

Defined cases: text that isn't JSON, and records without an article or a path,
have no row; an article that a list names twice is an error, as is one with two
paths in a map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of paths, of lists of matches, and of lists of records, each in the order in which they count.
PATHS = ("pdf_path", "source_pdf_path", "path")
MATCHES = ("exact_matches", "fuzzy_matches", "matches")
RECORDS = ("items", "articles", "records")


def _kind(value: Column) -> Column:
    """string, object, array or something else."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", "string").when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("other")


def _text(value: Column, path: str = "$") -> Column:
    """The text at a path; null if it is no text, or an empty one."""
    found = F.try_variant_get(value, path, "variant")
    return F.when((F.schema_of_variant(found) == "STRING") & (F.try_variant_get(found, "$", "string") != ""), F.try_variant_get(found, "$", "string"))


def own_path(value: Column) -> Column:
    """A value's path: itself, or one of its named paths."""
    return F.when(_kind(value) == "string", _text(value)).when(_kind(value) == "object", F.coalesce(*[_text(value, f"$.{p}") for p in PATHS]))


def _exploded(df: DataFrame, value: str, more: list[str]) -> DataFrame:
    """The elements of an array or object: more, pos, key, element."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(value).outer())).select(*more, F.col("pos"), F.col("key"), F.col("value").alias("element"))


def first_paths(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, path): the first path in each value, as deep as its lists go. Values without a path have no row.

    Lists are opened a level at a time, all rows together, until none is left;
    a place is the path of positions to it, and the first place counts.
    """
    level = df.select(key, F.col(value).alias("v"), F.array().cast("array<int>").alias("place"))
    found = None
    while True:
        level = level.withColumn("_kind", _kind(F.col("v")))
        here = level.where("_kind != 'array'").select(key, "place", own_path(F.col("v")).alias("path")).where("path IS NOT NULL")
        found = here if found is None else found.unionByName(here)
        lists = level.where("_kind = 'array'")
        if lists.isEmpty():
            break
        opened = lists.select(key, "v", F.col("place").alias("_place"))
        level = _exploded(opened, "v", [key, "_place"]).select(key, F.col("element").alias("v"), F.concat("_place", F.array("pos")).alias("place"))
    return found.groupBy(key).agg(F.min_by("path", "place").alias("path"))


def record_paths(records: DataFrame, key: str, value: str) -> DataFrame:
    """(key, path) of records: their own path, else the first in their lists of matches."""
    rows = records.select(key, F.col(value).alias("v"))
    own = rows.select(key, F.lit(0).alias("_rank"), own_path(F.col("v")).alias("path")).where("path IS NOT NULL")
    lists = rows.where((_kind(F.col("v")) == "object") & own_path(F.col("v")).isNull())
    parts = [first_paths(lists.select(key, F.try_variant_get("v", f"$.{m}", "variant").alias("m")).where("m IS NOT NULL"), key, "m").select(key, F.lit(i).alias("_rank"), "path") for i, m in enumerate(MATCHES, 1)]
    for p in parts:
        own = own.unionByName(p)
    return own.groupBy(key).agg(F.min_by("path", "_rank").alias("path"))


def read_map(files: DataFrame, text: str) -> DataFrame:
    """(article, path) of whole maps, one text a row: an object by article, or a list of records, bare or under a name."""
    v = files.select(F.try_parse_json(text).alias("v")).where("v IS NOT NULL").withColumn("_kind", _kind(F.col("v")))
    named = F.coalesce(*[F.when(F.col("_kind") == "object", F.try_variant_get("v", f"$.{r}", "variant")) for r in RECORDS])
    v = v.withColumn("_records", F.when(F.col("_kind") == "array", F.col("v")).otherwise(named))
    listed = _exploded(v.where("_records IS NOT NULL").select("_records"), "_records", []).select(_text(F.col("element"), "$.article").alias("article"), F.col("element").alias("record")).where("article IS NOT NULL")
    mapped = _exploded(v.where("_records IS NULL AND _kind = 'object'").select("v"), "v", []).select(F.col("key").alias("article"), F.col("element").alias("record"))
    records = listed.unionByName(mapped)
    twice = F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("duplicate article in a map: "), F.col("article")))).otherwise(F.lit(True))
    checked = records.groupBy("article").agg(F.count("*").alias("_n"), twice.alias("_once"), F.first("record").alias("record"))
    return record_paths(checked.where("_once").select("article", "record"), "article", "record")
