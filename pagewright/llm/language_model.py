"""Scoring by a log-bilinear language model trained with noise-contrastive estimation.

Tokens are words, with A-Z lower-cased, and one end per text. Counts are exact
over all training documents. The end, the most common words, and buckets of all
other words by their last letters are the model's units. A context is the sum of
the vectors of the tokens before, each with vectors of its own for each place; a
unit's energy is that sum times the unit's vector plus a bias. Units lie in
classes of equal number, so P(unit | context) = P(class | context) x P(unit |
class, context), both normalised by matrix products over a batch of tokens; a
word of a bucket has its add-one share of the bucket.

Training is numpy in tasks: each partition of the training documents is a
trainer, which takes every one of its documents through stochastic
noise-contrastive steps from the shared parameters. Noise is drawn once for a
group of tokens and shared by them as weights, so a step is matrix products.
Trainers grow with the input's partitions; their parameters are averaged,
weighted by tokens, by a tree of aggregates.

Counts of words beyond a bounded dictionary come back by a join on the word, so
no task holds the vocabulary.

Defined cases: a null or empty text is its end token; a word never seen in
training is the unseen word of its bucket; a null id is a training document;
with nothing to train on every token is unseen and the units are uniform;
repeated rows are scored alike; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

END = b"\n"  # not a word: words have no white space
CLASSES, PER_CLASS = 32, 32
UNITS, BUCKETS = CLASSES * PER_CLASS, PER_CLASS
COMMON = UNITS - BUCKETS  # the end and the most common words
DIM, CONTEXT, NOISE = 8, 4, 8
DICTIONARY, PASSES, FAN = 300_000, 1, 32


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(7)) == 2, F.lit(False))


def tokens(text: str) -> list[bytes]:
    """The text's words; bytes.lower and bytes.split know ASCII alone, as the convention asks."""
    return text.encode().lower().split()


# What a word ends in: a letter or digit, a mark that ends a sentence or part of one, another mark.
_ENDS = np.array([0 if chr(i).isalnum() or i >= 128 else 1 if chr(i) in ".,;:" else 2 for i in range(256)])


def bucket(word: bytes) -> int:
    """A number below BUCKETS from a word's last letters and the mark after them."""
    shape = _ENDS[word[-1]]
    if shape:
        return int(16 + 8 * (shape - 1) + zlib.crc32(word[-4:-1]) % 8)
    return zlib.crc32(word[-3:]) % 16


@dataclass
class Model:
    """Parameters and the counts that the buckets need; every array is bounded by UNITS or the dictionary."""

    words: list[bytes]  # the end, then words from the most common on
    counts: np.ndarray
    total: int
    types: int
    bucket_count: np.ndarray
    bucket_types: np.ndarray
    context: np.ndarray = field(default=None)  # CONTEXT x (UNITS + 1) x DIM: a unit's vector at each place before
    class_vec: np.ndarray = field(default=None)
    class_bias: np.ndarray = field(default=None)
    unit_vec: np.ndarray = field(default=None)  # CLASSES x PER_CLASS x DIM
    unit_bias: np.ndarray = field(default=None)
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def unit_mass(self) -> np.ndarray:
        mass = np.ones(UNITS)
        mass[: min(COMMON, len(self.words))] += self.counts[:COMMON]
        mass[COMMON:] += self.bucket_count + self.bucket_types
        return mass


class Numbers(dict):
    """A number for each word: its place in the dictionary, or past it the bucket of an unseen word; arrays tell the rest."""

    def __init__(self, model: Model, most: int = 500_000):
        super().__init__(zip(model.words, range(len(model.words))))
        n = len(model.words)
        self.beyond, self.most = n, n + most
        self.unit = np.concatenate([np.arange(min(n, COMMON)), [COMMON + bucket(w) for w in model.words[COMMON:]], np.arange(COMMON, UNITS)]).astype(np.int32)
        self.log = np.concatenate([np.log10(model.counts + 1.0), np.zeros(BUCKETS)])

    def __missing__(self, word: bytes) -> int:
        number = self.beyond + bucket(word)
        if len(self) < self.most:
            self[word] = number
        return number

    def of(self, flat: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, flat), dtype=np.int32, count=len(flat))


_numbers: dict[str, Numbers] = {}


def numbers(model: Model) -> Numbers:
    """Made once per worker and model."""
    if model.key not in _numbers:
        _numbers.clear()
        _numbers[model.key] = Numbers(model)
    return _numbers[model.key]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, bucket) of a column ``text``: words are counted in tasks before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = list(seen)
            made = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(list(seen.values()), pa.int64()), pa.array([bucket(w) for w in words], pa.int32())], ["word", "c", "bucket"])
            seen.clear()
            return made

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column("text").slice(at, 256).to_pylist()
                seen.update(" ".join(texts).encode().lower().split())
                seen[END] += len(texts)
                if len(seen) > 1_000_000:
                    yield out()
        yield out()

    counted = docs.select("text").mapInArrow(run, "word binary, c long, bucket int")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.min("bucket").alias("bucket"))


def dictionary(counts: DataFrame, most: int) -> Model:
    """The end and the common words with their counts, at most ``most``, and the sums that complete the counts."""
    end = sum(r["c"] for r in counts.where(F.col("word") == F.lit(END)).select("c").collect())  # one row
    counts = counts.where(F.col("word") != F.lit(END))
    sums = counts.groupBy("bucket").agg(F.sum("c").alias("n"), F.count("*").alias("types")).collect()  # a row per bucket
    levels = counts.groupBy("c").agg(F.count("*").alias("k")).where(F.col("k") < most).orderBy(F.desc("c")).limit(most)
    tail, least = 0, None
    for row in levels.toLocalIterator():  # distinct counts from the top, at most as many as the words they stand for
        tail += row["k"]
        if tail > most:
            break
        least = row["c"]
    top = counts.where(F.col("c") >= least).select("word", "c").toPandas() if least is not None else pd.DataFrame({"word": [], "c": []})
    if least is None or len(top) < COMMON:  # one level alone is larger: its first words in order
        top = counts.orderBy(F.desc("c"), "word").limit(COMMON).select("word", "c").toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["c", "word"], ascending=[False, True], kind="stable")
    words, c = [END, *top["word"]], np.r_[end, top["c"].to_numpy(dtype=np.int64)]
    n, types = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for row in sums:
        n[row["bucket"]] += row["n"]
        types[row["bucket"]] += row["types"]
    total, all_types = int(n.sum()) + end, int(types.sum()) + (end > 0)
    for w, k in zip(words[1:COMMON], c[1:]):
        at = bucket(w)
        n[at] -= k
        types[at] -= 1
    return Model(words, c, total, all_types, n, types)


def start(model: Model, seed: int = 3) -> Model:
    rng = np.random.default_rng(seed)
    mass = model.unit_mass().reshape(CLASSES, PER_CLASS)
    model.context = rng.normal(0, 0.1, (CONTEXT, UNITS + 1, DIM)).astype(np.float32)
    model.class_vec = rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
    model.unit_vec = rng.normal(0, 0.1, (CLASSES, PER_CLASS, DIM)).astype(np.float32)
    model.class_bias = np.log(mass.sum(1) / mass.sum()).astype(np.float32)
    model.unit_bias = np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)
    return model


PARTS = ("context", "class_vec", "class_bias", "unit_vec", "unit_bias")


def contexts(units: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Units of the tokens before each token, nearest first; UNITS where the text hasn't begun. ends: the index past each text's last token."""
    starts = np.repeat(np.r_[0, ends[:-1]], np.diff(np.r_[0, ends]))
    place = np.arange(len(units)) - starts
    out = np.full((CONTEXT, len(units)), UNITS, dtype=np.int32)
    for i in range(CONTEXT):
        inside = place > i
        out[i, inside] = units[np.flatnonzero(inside) - i - 1]
    return out


def hidden(model: Model, before: np.ndarray) -> np.ndarray:
    out = model.context[0].take(before[0], 0)
    for i in range(1, CONTEXT):
        out += model.context[i].take(before[i], 0)
    return out


def by_class(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings tokens of one class together, and where each class begins and ends in it."""
    c = (units // PER_CLASS).astype(np.uint16)
    order = np.argsort(c, kind="stable")
    return order, np.searchsorted(c[order], np.arange(CLASSES + 1))


class Trainer:
    """Noise-contrastive steps in place, with AdaGrad step sizes.

    A true label and NOISE labels drawn from the unigram distribution are told
    apart by sigma(energy - log(NOISE x noise probability)): classes among all
    classes, then units among those of their class. The noise of a group of
    tokens is drawn at once; how often a label was drawn weighs its column.
    """

    def __init__(self, model: Model, rng: np.random.Generator, rate: float = 0.1):
        self.model, self.rng, self.rate, self.seen = model, rng, rate, 0
        mass = model.unit_mass().reshape(CLASSES, PER_CLASS)
        self.p_class = mass.sum(1) / mass.sum()
        self.p_unit = mass / mass.sum(1, keepdims=True)
        self.log_class, self.log_unit = np.log(NOISE * self.p_class).astype(np.float32), np.log(NOISE * self.p_unit).astype(np.float32)
        self.grown = {name: np.full(getattr(model, name).shape, 1e-2, dtype=np.float32) for name in PARTS}

    def contrast(self, h: np.ndarray, true: np.ndarray, vec: np.ndarray, bias: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients by context, vectors and biases of one group of tokens; ``bias`` is less the noise's logarithms."""
        e = h @ vec.T
        e += bias
        np.negative(e, out=e)
        np.exp(e, out=e)
        e += 1
        np.reciprocal(e, out=e)  # how true each label looks
        at = np.arange(len(true))
        own = e[at, true] - 1
        e *= (self.rng.multinomial(NOISE * len(true), p) / len(true)).astype(np.float32)
        e[at, true] += own
        return e @ vec, e.T @ h, e.sum(0)

    def step(self, units: np.ndarray, before: np.ndarray) -> None:
        m = self.model
        h = hidden(m, before)
        grad = {name: np.zeros_like(getattr(m, name)) for name in PARTS}
        dh, grad["class_vec"], grad["class_bias"] = self.contrast(h, units // PER_CLASS, m.class_vec, m.class_bias - self.log_class, self.p_class)
        order, cuts = by_class(units)
        inside, sorted_h, sorted_dh = (units % PER_CLASS)[order], h.take(order, 0), np.empty_like(h)
        for k in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[k], cuts[k + 1])
            sorted_dh[part], grad["unit_vec"][k], grad["unit_bias"][k] = self.contrast(sorted_h[part], inside[part], m.unit_vec[k], m.unit_bias[k] - self.log_unit[k], self.p_unit[k])
        dh[order] += sorted_dh
        columns = dh.T.astype(np.float64)
        for i in range(CONTEXT):
            for d in range(DIM):
                grad["context"][i, :, d] = np.bincount(before[i], weights=columns[d], minlength=UNITS + 1)
        for name in PARTS:
            self.grown[name] += grad[name] ** 2
            getattr(m, name)[...] -= self.rate * grad[name] / np.sqrt(self.grown[name])

    def learn(self, units: np.ndarray, ends: np.ndarray) -> None:
        """One pass over a row of texts; steps are short at first and grow to ``8192`` tokens."""
        before, at = contexts(units, ends), 0
        while at < len(units):
            n = min(8192, max(256, self.seen // 32))
            self.step(units[at : at + n], before[:, at : at + n])
            at += n
            self.seen += n


def flattened(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """All tokens of the texts in a row, and how many each has."""
    flat, n = [], []
    for text in texts:
        own = tokens(text)
        flat += own
        flat.append(END)
        n.append(len(own) + 1)
    return flat, np.array(n, dtype=np.int64)


def merged(parts: DataFrame, n: int, fan: int = FAN) -> tuple[int, np.ndarray | None]:
    """All tokens seen and the mean of (trainer, seen, flat) rows weighted by them; trainers count from 0 to below ``n``.

    Rows are merged ``fan`` at a time in tasks until ``fan`` are left, so the
    driver reads a bounded number of rows, one at a time.
    """

    def one(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mass = 0.0, 0
        for batch in batches:
            for seen, flat in zip(batch.column("seen"), batch.column("flat")):
                total = total + seen.as_py() * np.frombuffer(flat.as_py(), dtype=np.float32).astype(np.float64)
                mass += seen.as_py()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([mass], pa.int64()), pa.array([(total / mass).astype(np.float32).tobytes()], pa.binary())], ["trainer", "seen", "flat"])

    while n > fan:
        n = -(-n // fan)
        level = parts.select(F.pmod("trainer", F.lit(n)).cast("int").alias("trainer"), "seen", "flat")
        parts = materialize(level.groupBy("trainer").applyInArrow(one, "trainer int, seen long, flat binary"), "lm-parts")
    total, mass = 0.0, 0
    for row in parts.toLocalIterator():
        total = total + row["seen"] * np.frombuffer(bytes(row["flat"]), dtype=np.float32).astype(np.float64)
        mass += row["seen"]
    return mass, (total / mass).astype(np.float32) if mass else None


def train(docs: DataFrame, model: Model, passes: int = PASSES, chunk: int = 256) -> Model:
    """Fit the parameters on all documents of a column ``text``; each partition is a trainer."""
    spark, model = docs.sparkSession, start(model)
    for number in range(passes):
        held = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import copy

            place = TaskContext.get().partitionId()
            own, seen = copy.copy(held.value), 0
            for name in PARTS:
                setattr(own, name, getattr(own, name).copy())
            words, trainer = numbers(own), Trainer(own, np.random.default_rng([number, place]))
            for batch in batches:
                for at in range(0, batch.num_rows, chunk):
                    flat, n = flattened(batch.column("text").slice(at, chunk).to_pylist())
                    trainer.learn(words.unit[words.of(flat)], np.cumsum(n))
                    seen += len(flat)
            if seen:
                flat = np.concatenate([getattr(own, name).ravel() for name in PARTS])
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([seen], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["trainer", "seen", "flat"])

        parts = materialize(docs.select("text").mapInArrow(run, "trainer int, seen long, flat binary"), "lm-parts")
        mass, flat = merged(parts, (parts.agg(F.max("trainer")).first()[0] or 0) + 1)
        if mass:
            at = 0
            for name in PARTS:
                old = getattr(model, name)
                setattr(model, name, flat[at : at + old.size].reshape(old.shape))
                at += old.size
    return model


def _log_softmax_at(energies: np.ndarray, at: np.ndarray) -> np.ndarray:
    own = energies[np.arange(len(at)), at]
    top = energies.max(axis=1)
    energies -= top[:, None]
    np.exp(energies, out=energies)
    return own - top - np.log(energies.sum(axis=1))


def log_probs(model: Model, units: np.ndarray, ends: np.ndarray, block: int = 8192) -> np.ndarray:
    """Natural log of P(unit | context) of every token, normalised."""
    before, out = contexts(units, ends), np.empty(len(units))
    for at in range(0, len(units), block):
        part = slice(at, at + block)
        h, own = hidden(model, before[:, part]), units[part]
        logs = _log_softmax_at(h @ model.class_vec.T + model.class_bias, own // PER_CLASS)
        order, cuts = by_class(own)
        inside, h, found = (own % PER_CLASS)[order], h.take(order, 0), np.empty(len(own), dtype=np.float32)
        for k in np.flatnonzero(np.diff(cuts)):
            rows = slice(cuts[k], cuts[k + 1])
            found[rows] = _log_softmax_at(h[rows] @ model.unit_vec[k].T + model.unit_bias[k], inside[rows])
        logs[order] += found
        out[part] = logs
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = DICTIONARY, passes: int = PASSES) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    slim = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"), held_out(docs[id_col]).alias("held_out"))
    counts = materialize(count_words(slim.where(~F.col("held_out"))), "lm-counts")
    model = train(slim.where(~F.col("held_out")), dictionary(counts, most), passes)
    held = spark.sparkContext.broadcast(model)
    rows = slim.withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        words = numbers(own)
        share_of = np.log10(own.bucket_count + own.bucket_types + 1.0)
        base_of = np.log10(float(own.total + own.types + 1))
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                flat, n = flattened(batch.column("text").to_pylist())
                found = words.of(flat)
                units, logs10 = words.unit[found], words.log[found]
                ends = np.cumsum(n)
                first, unseen = ends - n, found >= words.beyond
                logs = log_probs(own, units, ends) / np.log(10.0)
                rare = units >= COMMON
                logs[rare] += logs10[rare] - share_of[units[rare] - COMMON]
                sums = lambda x: np.add.reduceat(x, first)
                places = np.flatnonzero(unseen)
                tails = pa.ListArray.from_arrays(pa.array(np.searchsorted(places, np.r_[0, ends]).astype(np.int32)), pa.array([flat[i] for i in places.tolist()], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("id"), batch.column("held_out"), pa.array(n, pa.int64()), pa.array(sums((logs10 > 0).astype(np.int64)), pa.int64()), pa.array(sums(logs10) - n * base_of), pa.array(sums(logs)), tails],
                    ["row", "id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"],
                )

    scored = materialize(rows.mapInArrow(run, f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, tail array<binary>"), "lm-scored")
    # A rare word's count adds the same log10(c + 1) to both scores; the rest of either is known without it.
    tail = scored.select("row", F.explode("tail").alias("t_word")).groupBy("t_word", "row").agg(F.count("*").alias("times"))
    found = tail.join(counts, F.col("t_word") == F.col("word")).groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("times").alias("more_known")).withColumnRenamed("row", "m_row")
    out = scored.drop("tail").join(found, F.col("row") == F.col("m_row"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))
