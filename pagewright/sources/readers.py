"""Sources: stage files of a corpus, lenient JSON lines, alias maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def stage_files(spark: SparkSession, roots: list[str], layout: str = "*/_*stages/0[12].*.html") -> DataFrame:
    """path, article, folder, stage, html, sha256 of every stage file below the roots.

    Folders of stages begin with an underscore, which a recursive scan takes
    for hidden, so the layout names the files themselves.
    """
    files = spark.read.format("binaryFile").load([f"{r}/{layout}" for r in roots])
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    article = F.regexp_extract(folder, r"([^/]+)/[^/]+$", 1)
    return files.select("path", article.alias("article"), folder.alias("folder"), F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("stage"), F.decode("content", "UTF-8").alias("html"), F.sha2("content", 256).alias("sha256"))


def stage_pairs(files: DataFrame, raw: str = "01.en.raw", polish: str = "02.en.polish") -> DataFrame:
    """article, raw_path, raw_html, polish_path, polish_html for folders that have both stages."""
    side = lambda stage, p: files.where(F.col("stage") == stage).select(F.col("folder").alias(f"{p}_folder"), F.col("article").alias(f"{p}_article"), F.col("path").alias(f"{p}_path"), F.col("html").alias(f"{p}_html"))
    both = side(raw, "raw").join(side(polish, "polish"), F.col("raw_folder") == F.col("polish_folder"))
    return both.select(F.col("polish_article").alias("article"), "raw_path", "raw_html", "polish_path", "polish_html")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON lines file; blank and broken lines, and lines that aren't objects, are left out."""
    lines = spark.read.text(path).where(F.trim("value").startswith("{"))
    parsed = lines.select(F.from_json("value", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.where(F.col("r._broken").isNull() & F.col("r").isNotNull()).select("r.*").drop("_broken")


def alias_maps(spark: SparkSession, paths: list[str], key: str) -> DataFrame:
    """Rows of CSV maps by alias; of equal aliases the one in the last file stays."""
    rows = spark.read.option("header", "true").csv(paths).withColumn("_file", F.input_file_name())
    last = Window.partitionBy(key).orderBy(F.desc("_file"))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", "_file")
