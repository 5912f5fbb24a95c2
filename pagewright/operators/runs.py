"""What a run needs to know about its inputs and its past: selections, states, queues, candidates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.sources import shared


def ordered_union(sources: list[DataFrame], key: str, order: str) -> DataFrame:
    """key, source, place: each key once, from the first source that has it, in order."""
    parts = [s.select(F.col(key), F.lit(i).alias("source"), F.col(order).alias("place")) for i, s in enumerate(sources)]
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(key).agg(F.min(F.struct("source", "place")).alias("first")).select(key, "first.*")


def state_by_any_key(items: DataFrame, states: DataFrame, keys: list[str], id_: str, state_key: str, value: str) -> DataFrame:
    """id, value: the state found under the first of an item's keys that has one.

    Keys become rows with their rank, so the lookup is one equi-join.
    """
    rows = items.select(id_, F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), F.col(k).cast("string").alias("key")) for i, k in enumerate(keys)])).alias("k"))
    found = rows.select(id_, "k.*").where(F.col("key").isNotNull()).join(states.select(F.col(state_key).cast("string").alias("key"), F.col(value)), "key")
    return found.groupBy(id_).agg(F.min(F.struct("rank", value)).alias("first")).select(id_, F.col(f"first.{value}").alias(value))


def processed_elsewhere(sources: DataFrame, history: DataFrame, key: str, folder: str, at: str, here: str) -> DataFrame:
    """key, folder, at: the latest other folder in which a source was processed."""
    known = history.where(F.col(folder) != here).groupBy(key).agg(F.max(F.struct(at, folder)).alias("last"))
    return sources.select(key).distinct().join(known, key).select(key, F.col(f"last.{folder}").alias(folder), F.col(f"last.{at}").alias(at))


def partition_by_existence(records: DataFrame, present: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Records whose key is there, and those whose key isn't."""
    there = present.select(key).distinct()
    return records.join(there, key, "left_semi"), records.join(there, key, "left_anti")


def retried(queue: DataFrame, outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """The queue after a retry: what succeeded or is gone leaves, the rest stays with one attempt more."""
    joined = queue.join(outcomes.select(*keys, "outcome"), keys, "left")
    left = F.coalesce(F.col("outcome").isin("uploaded", "missing"), F.lit(False))
    return joined.where(~left).withColumn("attempts", F.col("attempts") + F.when(F.col("outcome").isNotNull(), 1).otherwise(0)).drop("outcome")


def sampled_pages(count: Column, most: int = 15) -> Column:
    """Page numbers to look at: all of a short document, else both ends and evenly spread ones between."""
    ends = F.array(*[F.lit(i) for i in range(3)], count - 3, count - 2, count - 1)
    inside = F.array_distinct(F.filter(ends, lambda p: (p >= 0) & (p < count)))
    rest = most - F.size(inside)
    spread = F.when(rest > 0, F.transform(F.sequence(F.lit(1), F.greatest(rest, F.lit(1))), lambda i: F.bround((count - 1) * i / (rest + 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    many = F.slice(F.array_sort(F.array_distinct(F.concat(inside.cast("array<int>"), spread))), 1, most)
    return F.when(count <= 0, F.array().cast("array<int>")).when(count <= most, F.sequence(F.lit(0), F.greatest(count.cast("int") - 1, F.lit(0)))).otherwise(many)


def prefix_counts(destinations: DataFrame, by: list[str], name: str) -> DataFrame:
    """by, prefix, n: destinations by the letters before their number."""
    prefix = F.regexp_extract(name, r"^([A-Za-z]+)\d+", 1)
    return destinations.select(*by, prefix.alias("prefix")).where("prefix != ''").groupBy(*by, "prefix").agg(F.count("*").alias("n"))


def dominant_prefix(counts: DataFrame, by: list[str], candidates: list[str]) -> DataFrame:
    """by, prefix: the candidate with the greatest count, the earlier of equals, whatever its case."""
    rank = F.array_position(F.array(*[F.lit(c.lower()) for c in candidates]), F.lower("prefix"))
    known = counts.withColumn("rank", rank).where("rank > 0")
    return known.groupBy(*by).agg(F.max(F.struct("n", (-F.col("rank")).alias("first"), "prefix")).alias("best")).select(*by, F.col("best.prefix").alias("prefix"))


def worsened(deltas: Column, lower_is_better: list[str]) -> Column:
    """The deltas of the metrics that should fall but rose."""
    return F.map_filter(deltas, lambda k, v: F.array_contains(F.array(*[F.lit(x) for x in lower_is_better]), k) & (v > 0))


_NO_WORD = re.compile(r"[^a-z0-9à-öø-ÿ]+")


def title_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), _NO_WORD.pattern, " "))


#: A fragment so long counts whole if a title contains it; words that match begin alike, with so many letters at least.
CONTAINED, ALIKE = 32, 4
#: Fixed value: into how many groups titles are dealt to be read.
BUCKETS = 1024


def _long_words(text: str) -> list[str]:
    return [w for w in text.split(" ") if len(w) >= ALIKE]


def _taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Titles as ``title_key`` has them, and the distinct beginnings of their long words."""
    for b in batches:
        keys = [None if x is None else _NO_WORD.sub(" ", x.lower()).strip(" ") for x in b.column(1).to_pylist()]
        begins = [list({w[:ALIKE] for w in _long_words(k or "")}) for k in keys]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.string()), pa.array(begins, pa.list_(pa.string()))], names=["t", "tk", "tb"])


def _in_order(words: list[str], title: list[str], places: dict[str, list[int]]) -> int:
    """How many of the words a title has in order; each takes the first that begins alike behind the one before."""
    at = n = 0
    for w in words:
        near = places.get(w[:ALIKE], ())
        for p in islice(near, bisect_left(near, at), None):
            if title[p].startswith(w) or w.startswith(title[p]):
                at, n = p + 1, n + 1
                break
    return n


def _read_titles(titles: pa.Table, asked: pa.Table) -> pa.Table:
    """The fragments that each title of a group has to be asked for: f, t, size, n and whether it holds the fragment whole.

    Titles that lack more of a fragment's beginnings than may be missing aren't read.
    """
    fragments, pairs = {}, {}
    for r in zip(*(asked[c].to_pylist() for c in ("f", "title", "missing", "fk"))):
        if r[3] is None:
            pairs.setdefault(r[1], []).append(r[0])
        else:
            words = _long_words(r[3])
            fragments[r[0]] = (r[2], r[3], words, {w[:ALIKE] for w in words})
    rows = []
    for t, text in zip(titles["t"].to_pylist(), titles["tk"].to_pylist()):
        if t not in pairs or text is None:
            continue
        title, places = _long_words(text), {}
        for i, w in enumerate(title):
            places.setdefault(w[:ALIKE], []).append(i)
        for f in pairs[t]:
            missing, key, words, begins = fragments[f]
            if len(begins - places.keys()) <= missing:
                rows.append((f, t, len(words), _in_order(words, title, places), len(key) >= CONTAINED and key in text))
    kinds = [asked.schema.field("f").type, asked.schema.field("title").type, pa.int32(), pa.int32(), pa.bool_()]
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["f", "t", "size", "n", "whole"])


def title_candidates(fragments: DataFrame, titles: DataFrame, fragment_id: str, title_id: str, text: str, most: int = 8, least: int = 6, share: float = 0.78) -> DataFrame:
    """fragment, title, score: titles that hold a fragment's words in order, or the whole fragment, the best few of each.

    Two words of four letters or more match if one begins with the other, so
    their first four letters are keys of an equi-join. A title that shares the
    needed words shares one of the rarest keys, as many as may be missing and
    one more; of a fragment that a title contains, only the first word may be
    missing, of which the fragment has the end. So only these keys are joined,
    and titles they bring are read word by word. Fragments without a word of
    four letters match nothing.
    """
    words = lambda c: F.filter(F.split(c, " "), lambda w: F.char_length(w) >= ALIKE)
    f = fragments.select(F.col(fragment_id).alias("f"), title_key(F.col(text)).alias("fk")).withColumn("fw", words("fk"))
    f = f.where((F.size("fw") >= least) | (F.char_length("fk") >= CONTAINED))
    begins = lambda ws: F.transform(ws, lambda w: F.substring(w, 1, ALIKE))
    missing = F.greatest(F.lit(1), F.floor(F.size("fw") - F.greatest(F.lit(least), F.lit(share) * F.size("fw"))))
    f = f.withColumn("missing", missing)
    t = titles.select(F.col(title_id).alias("t"), F.col(text).alias("text"))
    t = shared.materialize(t.mapInArrow(_taken_apart, f"t {dict(t.dtypes)['t']}, tk string, tb array<string>"), "titles")  # read three times, taken apart once
    counted = f.select("f", "missing", F.explode(begins(F.col("fw"))).alias("w")).groupBy("f", "missing", "w").agg(F.count("*").alias("times"))
    have = t.select("t", F.explode("tb").alias("w"))
    known = counted.join(have.join(counted.select("w").distinct(), "w", "left_semi").groupBy("w").agg(F.count("*").alias("df")), "w", "left")
    rarest = Window.partitionBy("f").orderBy(F.coalesce("df", F.lit(0)), "w").rowsBetween(Window.unboundedPreceding, -1)
    index = known.withColumn("before", F.coalesce(F.sum("times").over(rarest), F.lit(0))).where("before <= missing")
    index = shared.materialize(index.select("f", "w"), "rarest-words")
    # titles, the pairs and each fragment once are dealt to groups of titles: no text is repeated by pairs
    bucket = F.pmod(F.xxhash64("t"), F.lit(BUCKETS)).alias("bucket")
    met = index.join(have, "w").select("f", "t").distinct().select(bucket, "f", "t")
    kept = met.select("bucket", "f").distinct().join(f.select("f", "missing", "fk"), "f")
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    types = dict(t.dtypes) | dict(f.dtypes)
    asked = met.select(F.col("bucket").alias("group"), "f", F.col("t").alias("title"), none("missing", "long"), none("fk", "string")).unionByName(kept.select(F.col("bucket").alias("group"), "f", none("title", types["t"]), F.col("missing").cast("long").alias("missing"), "fk"))
    scored = t.select("t", "tk", bucket).groupBy("bucket").cogroup(asked.groupBy("group")).applyInArrow(_read_titles, f"f {types['f']}, t {types['t']}, size int, n int, whole boolean")
    good = scored.where(F.col("whole") | ((F.col("size") >= least) & (F.col("n") >= least) & (F.col("n") >= F.lit(share) * F.col("size"))))
    good = good.withColumn("score", F.when(F.col("whole"), 1.0).otherwise(F.round(F.col("n") / F.col("size"), 4)))
    place = F.row_number().over(Window.partitionBy("f").orderBy(F.desc("score"), "t"))
    return good.withColumn("place", place).where(F.col("place") <= most).select(F.col("f").alias(fragment_id), F.col("t").alias(title_id), "score")


def checked_snapshot(expected: DataFrame, found: DataFrame, key: str, digest: str) -> DataFrame:
    """key, problem: files that are missing, that differ, or that a manifest doesn't know."""
    e = expected.select(F.col(key).alias("e_key"), F.col(digest).alias("e_digest"))
    f = found.select(F.col(key).alias("f_key"), F.col(digest).alias("f_digest"))
    both = e.join(f, F.col("e_key") == F.col("f_key"), "full_outer")
    problem = F.when(F.col("f_key").isNull(), "missing").when(F.col("e_key").isNull(), "unknown").when(F.col("e_digest") != F.col("f_digest"), "changed")
    return both.select(F.coalesce("e_key", "f_key").alias(key), problem.alias("problem")).where(F.col("problem").isNotNull())
