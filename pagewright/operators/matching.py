"""Matching by shared tokens: which text a snippet comes from, which title a fragment names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.sources import shared


def tokens(text: Column) -> Column:
    """Distinct words of three characters or more that aren't numbers, in lower case."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9à-öø-ÿ]{3,}"), F.lit(0)), lambda t: ~t.rlike("^[0-9]+$")))


def rarest_first(want: DataFrame, have: DataFrame, owner: str) -> DataFrame:
    """The tokens of each owner with their place, from the rarest on, and how many there are: owner, t, place, n.

    ``want`` has owner and t, ``have`` the tokens of all that may match.
    """
    counts = have.groupBy("t").agg(F.count("*").alias("_df"))
    by = Window.partitionBy(owner)
    counted = want.join(counts, "t", "left").withColumn("place", F.row_number().over(by.orderBy(F.coalesce("_df", F.lit(0)), "t")))
    return counted.select(owner, "t", "place", F.count("*").over(by).alias("n"))


def best_page(snippets: DataFrame, pages: DataFrame, snippet: str, page: str, text: str, first: int = 3) -> DataFrame:
    """snippet, page, score: the page with the largest share of a snippet's tokens, the least page of equals.

    A snippet meets pages by its rarest tokens only. Its rarest third gives one
    page and that page's exact share, s of n tokens. A page without any of the
    n - s + 1 rarest tokens shares less, so these are all that has to be joined,
    and common words, which bring nearly all pages, are left out wherever a
    good page is found. Shares of the pages that are met are counted exactly.
    """
    want = snippets.select(F.col(snippet).alias("s"), tokens(F.col(text)).alias("w"))
    listed = want.select("s", F.explode("w").alias("t"))
    have = pages.select(F.col(page).alias("p"), F.explode(tokens(F.col(text))).alias("t"))
    have = shared.materialize(have.join(listed.select("t").distinct(), "t", "left_semi"), "page-tokens")  # tokens that some snippet has
    ranked = shared.materialize(rarest_first(listed, have, "s"), "snippet-tokens")
    held = have.groupBy("p").agg(F.collect_list("t").alias("h"))

    def exact(pairs: DataFrame) -> DataFrame:
        return pairs.select("s", "p").join(held, "p").join(want, "s").select("s", "p", F.size(F.array_intersect("w", "h")).alias("shared"))

    met = ranked.where(F.col("place") <= F.ceil(F.col("n") / first)).join(have, "t").groupBy("s", "p").agg(F.count("*").alias("c"))
    one = met.groupBy("s").agg(F.max(F.struct("c", (-F.col("p")).alias("first"), "p")).alias("best")).select("s", F.col("best.p").alias("p"))
    bound = shared.materialize(exact(one).select("s", F.col("shared").alias("bound")), "page-bounds")
    needed = ranked.join(bound, "s", "left").where(F.col("place") <= F.col("n") - F.coalesce("bound", F.lit(0)) + 1)
    pairs = needed.join(have, "t").select("s", "p").distinct()
    best = exact(pairs).groupBy("s").agg(F.max(F.struct("shared", (-F.col("p")).alias("first"), "p")).alias("best"))
    sizes = want.select(F.col("s").alias("z"), F.size("w").alias("n"))
    return best.join(sizes, F.col("s") == F.col("z")).select(F.col("s").alias(snippet), F.col("best.p").alias(page), F.round(F.col("best.shared") / F.col("n"), 6).alias("score"))


def shared_identities(df: DataFrame, group: str, identity: Column, member: str, least: int = 2) -> DataFrame:
    """group, identity, members: contents that stand under several members of a group."""
    rows = df.select(group, identity.alias("identity"), member).where(F.col("identity").isNotNull())
    return rows.groupBy(group, "identity").agg(F.countDistinct(member).alias("members")).where(F.col("members") >= least)


def unique_names(df: DataFrame, name: Column, order: str, out: str = "unique_name") -> DataFrame:
    """Names made unique without regard to case: the second and later ones get _2, _3, in order."""
    keyed = df.withColumn("_name", name)
    place = F.row_number().over(Window.partitionBy(F.lower("_name")).orderBy(order))
    return keyed.withColumn(out, F.when(place == 1, F.col("_name")).otherwise(F.concat("_name", F.lit("_"), place.cast("string")))).drop("_name")
