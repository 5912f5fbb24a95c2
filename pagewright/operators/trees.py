"""Hierarchies: all descendants of the nodes of a tree, level by level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def descendants(edges: DataFrame, parent: str, child: str, most_levels: int = 32) -> DataFrame:
    """ancestor, node, depth for every node below another.

    Each level is one equi-join with the edges; it ends with the first empty
    level, and a cycle is an error rather than an endless run.
    """
    step = edges.select(F.col(parent).alias("p"), F.col(child).alias("c"))
    level = step.select(F.col("p").alias("ancestor"), F.col("c").alias("node"), F.lit(1).alias("depth"))
    levels = [level]
    for depth in range(2, most_levels + 2):
        level = level.join(step, F.col("node") == F.col("p")).select("ancestor", F.col("c").alias("node"), F.lit(depth).alias("depth"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        levels.append(level)
    raise ValueError(f"more than {most_levels} levels: the edges have a cycle, or need a larger bound")
