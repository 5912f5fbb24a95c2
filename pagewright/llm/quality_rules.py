"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row holds what was
measured and one bit per failed rule; policies are versioned masks over those
bits, and ablations are bitwise aggregates of the ledger, so neither reads a
text again. All of it is columnar expressions inside one scan: no shuffle, no
Python.

Defined cases: a null text has no words and fails ``few_words``; a document of
any length is measured whole, in time that grows as n log n; ties and repeated
rows are measured alike; an empty table gives an empty ledger. Other columns
pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, stripped, text_of, words

SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5

#: Fixed bit of each rule; a retired rule's bit is never used again.
RULES: dict[str, int] = {"few_words": 0, "repeated_windows": 1, "many_symbols": 2, "repeated_lines": 3, "word_length": 4, "shouting": 5}

#: Policies by version: a document is dropped if any of these rules failed.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "many_symbols", "repeated_lines", "word_length", "shouting"),
}


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << RULES[r] for r in rules)


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(w: Column) -> Column:
    """A hash of each window of words, in order."""
    at = lambda i, k: F.get(w, i + k)
    return F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[at(i, F.lit(k)) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """How many words lie in windows that occur twice or more, given the windows' hashes in order.

    Sorting (hash, place) puts equal windows side by side; the places of those
    with an equal neighbour, sorted again, each cover the words up to the next
    place, five at most.
    """

    def repeated(s: Column) -> Column:
        same = lambda k, j: F.coalesce(F.get(s, k)["h"] == F.get(s, j)["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, k: same(k, k - 1) | same(k, k + 1)), lambda x: x["i"]))

    places = bind(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)
    return bind(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b))


def repeat_words(w: Column) -> Column:
    """Words in windows found twice or more; the sort is only paid by texts that have such a window."""
    return bind(_windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with a struct ``measured``."""
    text = text_of(docs, text_col)

    def lines(found: Column) -> Column:
        return F.size(found) - F.size(F.array_distinct(found))

    dup_lines = bind(F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)), lines)
    n_lines = F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)))
    from_words = bind(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")))
    solid = F.char_length(stripped(text)).cast("long")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    letters = F.char_length(F.regexp_replace(text, "[^A-Za-z]+", "")).cast("long")
    symbols = F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long")
    return docs.select(
        *[docs[c] for c in docs.columns],
        F.struct(from_words.alias("words"), solid.alias("word_chars"), symbols.alias("n_symbols"), dup_lines.cast("long").alias("n_dup_lines"), n_lines.cast("long").alias("n_lines"), capitals.alias("n_capitals"), letters.alias("n_letters")).alias("measured"),
    )


def failures() -> dict[str, Column]:
    """What fails each rule, as a condition on ``measured``. Integers only, so that no rounding decides."""
    m = lambda name: F.col(f"measured.{name}")
    n = m("words.n_words")
    return {
        "few_words": n < 10,
        "repeated_windows": 100 * m("words.n_repeat_words") > 20 * n,
        "many_symbols": (n >= 10) & (100 * m("n_symbols") > 20 * n),
        "repeated_lines": (m("n_lines") >= 4) & (100 * m("n_dup_lines") > 50 * m("n_lines")),
        "word_length": (n >= 50) & ((m("word_chars") < 2 * n) | (m("word_chars") > 15 * n)),
        "shouting": (n >= 10) & (100 * m("n_capitals") > 60 * m("n_letters")),
    }


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with ``measured`` and ``failed``, the bits of the rules they fail."""
    found = failures()
    bits = F.lit(0).cast("long")
    for rule, bit in RULES.items():
        bits = bits.bitwiseOR(F.when(found[rule], F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text_col).withColumn("failed", bits)


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(ledgered: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: how many documents fail it, and how many fail nothing else.

    The ledger is first summed by its distinct bit patterns, of which there are
    few, so that each rule reads only those.
    """
    mask = mask_of(POLICIES[policy])
    patterns = ledgered.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    rows = patterns.select("failed", "n", rules.alias("r")).where(F.col("failed").bitwiseAND(F.col("r.bit")) != 0)
    only = F.when(F.bit_count("failed") == 1, F.col("n")).otherwise(0)
    return rows.groupBy("r.rule").agg(F.sum("n").alias("fails"), F.sum(only).alias("fails_only_this"), F.bit_or("failed").alias("seen_with"))
