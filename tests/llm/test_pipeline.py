import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_dedup import exact_by_hand, near_by_hand

import corpus_pipeline
from pagewright.llm import mixing, quality_classifier
from pagewright.llm.common import materialize

SF = "/root/testdata/sf0.001"


def seen_by_model(text):
    """The characters that the model sees, after three spaces."""
    out = "   "
    for c in text:
        c = " " if c in " \t\n\v\f\r" else "0" if c in "0123456789" else c
        if c != " " or out[-1] != " ":
            out += c
    return out


def kneser_ney_by_hand(texts):
    """Probabilities of 4-grams of characters, by the textbook, from plain dictionaries."""
    counts = [Counter()]
    for t in texts:
        s = seen_by_model(t)
        counts[0].update(s[i - 3 : i + 1] for i in range(3, len(s)))
    for _ in range(3):
        counts.append(Counter(g[1:] for g in counts[-1]))
    letters, levels = len(counts[-1]) + 1, []
    for c in reversed(counts):
        n = [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [min(i + 0.95, max(0.05, i + 1 - (i + 2) * y * n[i + 1] / n[i])) if n[i] else 0.5 for i in range(3)]
        total, freed = Counter(), defaultdict(float)
        for g, v in c.items():
            total[g[:-1]] += v
            freed[g[:-1]] += d[min(v, 3) - 1]
        levels.append((c, d, total, freed))

    def p(g):
        if not g:
            return 1 / letters
        c, d, total, freed = levels[len(g) - 1]
        back = p(g[1:])
        if not total[g[:-1]]:
            return back
        v = c.get(g, 0)
        return (max(0, v - d[min(v, 3) - 1]) if v else 0) / total[g[:-1]] + freed[g[:-1]] / total[g[:-1]] * back

    return p, set(counts[-1])


TEXTS = ["the cat sat on the mat. and the rat sat", " a hat  and a bat,\n\nand that 12 34", "thin things think", "日本語の文 и ещё слова", "x"]


def test_model_against_the_textbook(spark):
    """Every character has its own class, whatever its script; what was never seen has the rest."""
    m = quality_classifier.train(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    p, letters = kneser_ney_by_hand(TEXTS)
    for t in [*TEXTS, "the zebra", "日文の", "", "  ", "й\U0001f600 q9", "abc" * 50]:
        s = seen_by_model(t)
        want = [math.log10(p(s[i - 3 : i + 1])) for i in range(3, len(s))]
        got = m.log10_p(t)
        assert len(got) == len(want) and all(math.isclose(g, w, abs_tol=1e-6) for g, w in zip(got, want))
    for history in ("the", "語の文", "zzz", "   "):
        total = sum(p(history + c) for c in letters) + p(history + "\U0001f600")
        assert math.isclose(total, 1, abs_tol=1e-9)


def test_model_of_nothing_and_blocks(spark):
    none = spark.createDataFrame([], "text string")
    assert quality_classifier.train(none).log10_p("ab").tolist() == [0.0, 0.0]
    t = quality_classifier.Table(np.array([7, 1 << 63, 9], dtype=np.uint64), np.array([1.0, 2.0, 3.0]))
    assert t.find(np.array([9, 8, 7, 1 << 63, 0], dtype=np.uint64)).tolist() == [1, -1, 0, 2, -1]


def test_stages_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = materialize(stages["quality_classifier"](spark, docs, SF), "t")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdicts = {r["doc_id"]: r["kept"] for r in quality_classifier.classify(docs, labels).collect()}
    assert {r["doc_id"] for r in good.collect()} == {d for d, kept in verdicts.items() if kept}

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    once = materialize(stages["exact_dedup"](spark, good, SF), "t")
    assert sorted(r["doc_id"] for r in once.collect()) == sorted({keep for keep, _ in exact_by_hand(rows).values()})

    rows = [(r["doc_id"], r["text"]) for r in once.collect()]
    apart = materialize(stages["near_dedup"](spark, once, SF), "t")
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted({least for _, least, _ in near_by_hand(rows)})

    mixed = materialize(stages["mixing"](spark, apart, SF), "t")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(apart).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({d: n for d, n in copies.items() if n})

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum(len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed.collect())
    packed = stages["packing"](spark, mixed, SF).agg(F.sum("length").alias("n"), F.sum(F.octet_length("ids")).alias("b")).first()
    assert packed["n"] == want and packed["b"] == 4 * want
