"""Quality by the perplexity of a Kneser-Ney n-gram model of trusted text.

The model is interpolated modified Kneser-Ney over characters, order 4, trained
on documents labelled good. Every character that the trusted text holds counts
as itself, whatever its script; digits are one character, and so is a run of
white space. Counts of all orders are one table, keyed by the gram. Its shards
are joined, history by history and then order by order, with the totals, the
discounts' shares and the lower orders' probabilities, and give the logarithm
of each seen gram's probability and of each seen history's back-off weight.

The documents that train the model are a bounded sample: of the first
``sample`` trusted documents by a hash of their id, four fifths, as far as their
texts have ``chars`` characters together. So the joined table is bounded too,
and goes to the tasks as sorted arrays, in which a document's grams are looked
up; no document's grams are shuffled. All other trusted documents, however many,
set the thresholds.

A document has two measures over its whole text. ``score`` is the mean of minus
log10 p by character, from which the perplexity follows. ``excess`` is the mean
of what passes ``FLOOR`` of it: a passage that the model can't expect shows
there, though the mean of a long text hides it. Both are drawn towards their
language's mean as if the document had ``prior`` characters more, since short
texts say little, and both have a quantile of the trusted documents of their
language as their limit.

Defined cases: a null or empty text has the language's means and is kept; a
language without enough trusted documents uses the quantiles of all of them; no
trusted document at all keeps everything; null ids are scored like any others;
an empty table gives an empty result. Columns beyond id, text and language pass
through in ``filter_documents`` only.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of

ORDER = 4
SAMPLE, CHARS, QUANTILE, MARGIN, PRIOR, LEAST = 5_000, 10_000_000, 0.99, 1.02, 200, 20
#: Minus log10 p beyond which a character is unexpected.
FLOOR = 3.0
#: Measures are told apart to so many decimals, which bounds what a quantile has to count.
DECIMALS = 4


def codes(text: str) -> np.ndarray:
    """Code points as the model sees them, after ORDER - 1 spaces: digits are 0, a run of white space is one space."""
    found = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    found = np.concatenate([np.full(ORDER - 1, 32, dtype=np.uint32), found])
    found[(found >= 9) & (found <= 13)] = 32
    found[(found >= 48) & (found <= 57)] = 48
    space = found == 32
    kept = ~space
    kept[1:] |= ~space[:-1]
    kept[: ORDER - 1] = True
    return found[kept]


_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def keys(found: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit key of each gram of ``order`` characters, by its place; grams of different orders differ."""
    n = len(found) - order + 1
    out = np.full(max(0, n), order, dtype=np.uint64) * _PRIMES[3]
    for i in range(order if n > 0 else 0):
        out += (found[i : i + n].astype(np.uint64) + np.uint64(1)) * _PRIMES[i]
        out ^= out >> np.uint64(29)
        out *= _PRIMES[0]
    return out ^ (out >> np.uint64(32))


class Table:
    """Values by 64-bit key: sorted keys, and where each leading-bits bucket of them begins."""

    def __init__(self, found: np.ndarray, values: np.ndarray):
        order = np.argsort(found)
        bits = max(1, int(len(found) * 2).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.append(found[order], np.uint64(0))
        self.values = np.append(values[order], 0.0).astype(np.float64)
        self.first = np.searchsorted(self.keys[:-1] >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        bucket = (wanted >> self.shift).astype(np.int64)
        at, last = self.first[bucket], self.first[bucket + 1]
        out = np.where((self.keys[at] == wanted) & (at < last), at, -1)
        open_ = np.flatnonzero((out < 0) & (at + 1 < last))
        while len(open_):
            at[open_] += 1
            hit = self.keys[at[open_]] == wanted[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (at[open_] + 1 < last[open_])]
        return out


_tables: dict[str, tuple[list[Table], Table]] = {}


@dataclass
class Model:
    """What the joins gave: log10 of each seen gram's probability by order, of each seen history's back-off weight, and of any other character's probability."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    histories: tuple[np.ndarray, np.ndarray]
    other: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def tables(self) -> tuple[list[Table], Table]:
        """Made once per worker and model."""
        if self.key not in _tables:
            _tables.clear()
            _tables[self.key] = [Table(*x) for x in self.grams], Table(*self.histories)
        return _tables[self.key]

    def log10_p(self, text: str) -> np.ndarray:
        """log10 of the probability of each character after those before it: the longest seen gram, and the back-off weights of the longer histories."""
        grams, histories = self.tables()
        found = codes(text)
        n = len(found) - ORDER + 1
        out, left = np.zeros(n), np.arange(n)  # characters whose gram hasn't been found yet
        for order in range(ORDER, 0, -1):
            part = found if len(left) == n else None
            wanted = keys(part, order)[ORDER - order :] if part is not None else keys_at(found, left + ORDER - order, order)
            at = grams[order - 1].find(wanted)
            hit = at >= 0
            out[left[hit]] += grams[order - 1].values[at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if order > 1:
                back = histories.find(keys_at(found, left + ORDER - order, order - 1))
                out[left] += np.where(back >= 0, histories.values[back], 0.0)
        out[left] += self.other
        return out


def keys_at(found: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Keys of the grams that begin at ``starts``."""
    if not order:
        return np.full(len(starts), 0, dtype=np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(found, order)[starts]
    out = np.full(len(starts), order, dtype=np.uint64) * _PRIMES[3]
    for i in range(order):
        out += (windows[:, i].astype(np.uint64) + np.uint64(1)) * _PRIMES[i]
        out ^= out >> np.uint64(29)
        out *= _PRIMES[0]
    return out ^ (out >> np.uint64(32))


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) of the highest order over a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text").to_pylist():
                plain = codes(text).tobytes().decode("utf-32-le")
                seen.update(map("".join, zip(*(plain[i:] for i in range(ORDER)))))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["gram", "n"])

    counted = texts.mapInArrow(run, "gram string, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(ns: dict[int, int]) -> list[float]:
    """Modified Kneser-Ney: three discounts from the counts of counts, for counts of one, two, and three or more."""
    n = [ns.get(i, 0) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return [min(i + 0.95, max(0.05, i + 1 - (i + 2) * y * n[i + 1] / n[i])) if n[i] else 0.5 for i in range(3)]


def smoothed(texts: DataFrame) -> DataFrame:
    """(gram, p, gamma) of all orders: the interpolated probability of a gram and the back-off weight of it as a history; null where it isn't one. The empty gram has the first order's weight."""
    top = count_grams(texts)
    cut = lambda k: F.struct(F.substring("gram", ORDER - k + 1, k).alias("gram"), F.substring("gram", ORDER - k, 1).alias("before"))
    lower = top.select(F.explode(F.array(*[cut(k) for k in range(1, ORDER)])).alias("x")).select("x.*")
    lower = lower.groupBy("gram").agg(F.size(F.collect_set("before")).cast("long").alias("n"))  # the characters seen before it
    order = F.char_length("gram")
    every = top.unionByName(lower).select("gram", "n", order.alias("order"), F.left("gram", order - 1).alias("history"))
    every = materialize(every, "grams")
    few = every.where("n <= 4").groupBy("order", "n").agg(F.count("*").alias("k")).collect()  # four rows an order
    rates = {k: discounts({r["n"]: r["k"] for r in few if r["order"] == k}) for k in range(1, ORDER + 1)}
    rate = F.element_at(F.create_map(*[x for k, ds in rates.items() for x in (F.lit(k), F.array(*[F.lit(d) for d in ds]))]), F.col("order"))
    sharded = every.withColumn("discount", F.least(F.element_at(rate, F.least(F.col("n"), F.lit(3)).cast("int")), F.col("n").cast("double")))
    totals = sharded.groupBy("history").agg(F.sum("n").alias("total"), F.sum("discount").alias("freed"))
    totals = materialize(totals.select(F.col("history").alias("t_history"), "total", (F.col("freed") / F.col("total")).alias("gamma")), "totals")
    joined = sharded.join(totals, F.col("history") == F.col("t_history")).select("gram", "order", ((F.col("n") - F.col("discount")) / F.col("total")).alias("alpha"), "gamma")
    joined = materialize(joined, "alphas")
    letters = every.where("order = 1").count() + 1
    level = joined.where("order = 1").select("gram", (F.col("alpha") + F.col("gamma") / letters).alias("p"))
    levels = [level]
    for k in range(2, ORDER + 1):
        below = level.select(F.col("gram").alias("b_gram"), F.col("p").alias("b_p"))
        one = joined.where(F.col("order") == k)
        level = one.join(below, F.substring("gram", 2, k - 1) == F.col("b_gram")).select("gram", (F.col("alpha") + F.col("gamma") * F.col("b_p")).alias("p"))
        levels.append(level)
    seen = levels[0]
    for level in levels[1:]:
        seen = seen.unionByName(level)
    weights = totals.select(F.col("t_history").alias("gram"), F.when(F.col("t_history") == "", F.col("gamma") / letters).otherwise(F.col("gamma")).alias("gamma"))
    return seen.join(weights, "gram", "full")


def train(texts: DataFrame) -> Model:
    """The model of a column ``text``, whose number of characters bounds the table that goes through the driver."""
    table = materialize(smoothed(texts), "model").toPandas()
    lengths = table["gram"].str.len().to_numpy()

    def part(rows: np.ndarray, values: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        flat = np.frombuffer("".join(table["gram"][rows]).encode("utf-32-le"), dtype=np.uint32)
        found = keys_at(flat, np.arange(0, len(flat), order), order) if len(flat) else np.empty(0, dtype=np.uint64)
        return found, np.log10(values[rows].astype(np.float64))

    p, gamma = table["p"].to_numpy(), table["gamma"].to_numpy()
    grams = [part((lengths == k) & ~np.isnan(p), p, k) for k in range(1, ORDER + 1)]
    backs = [part((lengths == k) & ~np.isnan(gamma), gamma, k) for k in range(1, ORDER)]
    histories = tuple(np.concatenate([b[i] for b in backs]) for i in range(2))
    first = gamma[lengths == 0]
    return Model(grams, histories, float(np.log10(first[0])) if len(first) else 0.0)


def score(docs: DataFrame, model: Model, text: Column, keep: dict[str, Column], floor: float = FLOOR) -> DataFrame:
    """The columns in ``keep``, n_chars (characters scored), log10_p and over (the sums of log10 p and of what passes the floor)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(*[c.alias(k) for k, c in keep.items()], text.alias("_text"))
    names, block = list(keep), 1 << 20

    def measured(text: str) -> tuple[int, float, float]:
        n, total, over = 0, 0.0, 0.0
        for at in range(0, max(1, len(text)), block):  # a block sees the characters before it, and starts after white space as a text does
            logs = held.value.log10_p(text[at : at + block])
            n += len(logs)
            total += float(logs.sum())
            over += float(np.maximum(-logs - floor, 0.0).sum())
        return n, total, over

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measured(text) for text in batch.column("_text").to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in names], *columns], [*names, "n_chars", "log10_p", "over"])

    kept = ", ".join(f"`{k}` {slim.schema[k].dataType.simpleString()}" for k in keep)
    return slim.mapInArrow(run, f"{kept}, n_chars long, log10_p double, over double")


def drawn(total: Column, mean: Column, prior: int = PRIOR) -> Column:
    """The mean of a sum by character, drawn towards ``mean``; equal to DECIMALS decimals."""
    return F.round((total + mean * prior) / (F.col("n_chars") + prior), DECIMALS)


def thresholds(trusted: DataFrame, quantile: float, margin: float, least: int) -> DataFrame:
    """(t_lang, mean, over_mean, threshold, over_threshold) from scored trusted documents; the null language's row is for all others.

    A row per language and measure. The quantile of a language counts the
    different values of its measure in parts before they meet, and rounding
    bounds how many there are.
    """
    known = materialize(trusted.where("n_chars > 0").select("lang", "n_chars", "log10_p", "over"), "calibration")
    keyed = known.select(F.explode(F.array_distinct(F.array("lang", F.lit(None).cast("string")))).alias("key"), "n_chars", "log10_p", "over")
    mean = lambda c: F.sum(c) / F.sum("n_chars")
    means = keyed.groupBy("key").agg((-mean("log10_p")).alias("mean"), mean("over").alias("over_mean"), F.count("*").alias("n"))
    means = materialize(means.where(F.col("key").isNull() | (F.col("n") >= least)).select(F.col("key").alias("t_lang"), "mean", "over_mean"), "means")
    joined = keyed.join(F.broadcast(means), F.col("key").eqNullSafe(F.col("t_lang")))
    cut = lambda total, mean: F.percentile(drawn(total, mean), F.lit(quantile)) * margin
    return joined.groupBy("t_lang").agg(F.first("mean").alias("mean"), F.first("over_mean").alias("over_mean"), cut(-F.col("log10_p"), F.col("mean")).alias("threshold"), cut(F.col("over"), F.col("over_mean")).alias("over_threshold"))


def sampled(docs: DataFrame, good: DataFrame, id_col: str, text_col: str, sample: int, chars: int) -> tuple[DataFrame, DataFrame]:
    """The ids and the texts that train the model."""
    chosen = good.orderBy(F.xxhash64("g_id"), "g_id").limit(sample).where(F.pmod(F.xxhash64("g_id", F.lit(7)), F.lit(5)) != 0)
    texts = docs.join(F.broadcast(materialize(chosen, "chosen")), docs[id_col] == F.col("g_id")).select("g_id", text_of(docs, text_col).alias("text"))  # at most ``sample`` ids
    texts = materialize(texts, "trusted")
    sizes = texts.groupBy("g_id").agg(F.sum(F.char_length("text")).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("g_id"), "g_id"))  # at most ``sample`` rows
    trained = materialize(sizes.withColumn("so_far", so_far).where(F.col("so_far") <= chars).select(F.col("g_id").alias("b_id")), "trained")
    return trained, texts.join(F.broadcast(trained), F.col("g_id") == F.col("b_id"), "left_semi").select("text")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, chars: int = CHARS, quantile: float = QUANTILE, margin: float = MARGIN, least: int = LEAST, row: bool = False) -> DataFrame:
    """One row per document: id, lang, n_chars, perplexity (per character), score, threshold, excess, excess_threshold, kept.

    ``labels`` has (doc_id, quality, toxic); trusted is quality 1 and not toxic.
    With ``row`` the document's columns come as a struct ``row`` with it.
    """
    good = labels.where((F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False)) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("g_id")).distinct()
    trained, texts = sampled(docs, good, id_col, text_col, sample, chars)
    model = train(texts)
    slim = {"id": docs[id_col], "lang": docs[lang_col].cast("string")}
    measured = materialize(score(docs, model, text_of(docs, text_col), slim), "scored")
    held_back = good.join(F.broadcast(trained), F.col("g_id") == F.col("b_id"), "left_anti")
    limits = thresholds(measured.join(held_back, F.col("id") == F.col("g_id"), "left_semi"), quantile, margin, least)
    limits = materialize(limits, "limits")  # a row per language
    scored = score(docs, model, text_of(docs, text_col), slim | {"row": F.struct(*[docs[c] for c in docs.columns])}) if row else measured  # rows are large: texts are scored again rather than rows written
    special = limits.where("t_lang is not null")
    general = limits.where("t_lang is null").select(*[F.col(c).alias(f"any_{c}") for c in limits.columns[1:]])
    joined = scored.join(F.broadcast(special), F.col("lang") == F.col("t_lang"), "left").join(F.broadcast(general), F.lit(True), "left")
    own = {c: F.coalesce(F.col(c), F.col(f"any_{c}")) for c in limits.columns[1:]}
    mean, over_mean = F.coalesce(own["mean"], F.lit(0.0)), F.coalesce(own["over_mean"], F.lit(0.0))
    perplexity = F.pow(F.lit(10.0), F.when(F.col("n_chars") > 0, -F.col("log10_p") / F.col("n_chars")).otherwise(mean))
    out = joined.select("*", perplexity.alias("perplexity"), drawn(-F.col("log10_p"), mean).alias("score"), drawn(F.col("over"), over_mean).alias("excess"), own["threshold"].alias("limit"), own["over_threshold"].alias("over_limit"))
    within = F.coalesce(F.col("score") <= F.col("limit"), F.lit(True)) & F.coalesce(F.col("excess") <= F.col("over_limit"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "lang", "n_chars", "perplexity", "score", F.col("limit").alias("threshold"), "excess", F.col("over_limit").alias("excess_threshold"), within.alias("kept"), *(["row"] if row else []))


def filter_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the model keeps, with their columns."""
    return classify(docs, labels, row=True, **options).where("kept").select("row.*")
