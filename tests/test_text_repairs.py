"""Entities and wrong decodings, and matching by rarest words against plain readings."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright.functions import mojibake, text
from pagewright.operators import matching, repairs, runs


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t"))).first()[0]


@pytest.mark.parametrize("value", ["a &amp; b", "&lt;b&gt; &quot;x&quot;", "&amp;lt;", "&eacute;&Omega;&rarr;", "&#233;&#x3a9;&#X1F600;", "&#39;&#8211;", "&nosuch; &", "no entity", "", "&amp", "&#0;", "AT&T; R&D"])
def test_entities(spark, value):
    want = value if value in ("&amp", "&#0;") else html.unescape(value)  # names need their semicolons, and zero is no character
    assert one(spark, value, text.unescaped) == want


def test_entities_of_null(spark):
    assert one(spark, None, text.unescaped) is None


def test_wrong_decodings(spark):
    for c in mojibake.CYRILLIC:
        once = mojibake.misread(c, "cp1251")
        assert mojibake.mended(f"a{once}b") == f"a{c}b" and mojibake.mended(mojibake.misread(once, "cp1251")) == c
    for c in mojibake.WESTERN:
        assert mojibake.mended(mojibake.misread(c, "cp1252")) == c
    # written out, so that the rule isn't held against itself
    assert mojibake.mended("вЂ” вЂ™ РІР‚вЂќ РћС\u0098 Г— в€’") == "— ’ — μ × −"
    assert mojibake.mended("Вот обычный текст, à la carte") == "Вот обычный текст, à la carte"
    assert one(spark, "вЂ”", repairs.mojibake) == "—" and one(spark, None, repairs.mojibake) is None


def tokens(t):
    return {w for w in re.findall("[a-z0-9à-öø-ÿ]{3,}", t.lower()) if not w.isdigit()}


@pytest.mark.parametrize("seed", range(2))
def test_best_pages_against_all_pairs(spark, seed):
    r = random.Random(seed)
    words = [f"word{i}" for i in range(12)] + [f"rare{i}" for i in range(200)]
    draw = lambda n: " ".join(words[min(int(r.expovariate(0.05)), len(words) - 1)] for _ in range(n))
    pages = [(i, draw(r.randint(0, 60))) for i in range(60)]
    snippets = [(i, draw(r.randint(0, 25)) if r.random() < 0.6 else r.choice(pages)[1][: r.randint(20, 200)]) for i in range(40)]
    snippets += [(100, "unseen entirely"), (101, None)]
    got = matching.best_page(spark.createDataFrame(snippets, "s int, x string"), spark.createDataFrame(pages, "p int, x string"), "s", "p", "x")
    want = []
    for s, t in snippets:
        own = tokens(t or "")
        n, p = max((len(own & tokens(x)), -p) for p, x in pages)
        if n:
            want.append((s, -p, round(n / len(own), 6)))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_titles_against_all_pairs(spark):
    r = random.Random(5)
    words = [f"{chr(97 + i)}ord{end}" for i in range(8) for end in ("", "s", "less")] + ["of", "the"]
    draw = lambda n: [r.choice(words) for _ in range(n)]
    titles = [(i, " ".join(draw(r.randint(3, 20)))) for i in range(120)]
    fragments = []
    for i in range(60):
        w = list(r.choice(titles)[1].split())
        if r.random() < 0.5:
            w.insert(r.randrange(len(w) + 1), r.choice(words))
        x = " ".join(w[: r.randint(4, 20)])
        fragments.append((i, x[r.randint(1, 3) :] if r.random() < 0.3 else x))  # some begin within a word
    got = runs.title_candidates(spark.createDataFrame(fragments, "f int, x string"), spark.createDataFrame(titles, "t int, x string"), "f", "t", "x")
    want = []
    for f, x in fragments:
        fw, found = [w for w in x.split() if len(w) > 3], []
        for t, y in titles:
            at, n, tw = 0, 0, [w for w in y.split() if len(w) > 3]
            for w in fw:
                place = next((i for i in range(at, len(tw)) if tw[i].startswith(w) or w.startswith(tw[i])), None)
                if place is not None:
                    at, n = place + 1, n + 1
            if len(x) >= 32 and x in y:
                found.append((-1.0, t))
            elif n >= 6 and n >= 0.78 * len(fw):
                found.append((-round(n / len(fw), 4), t))
        want += [(f, t, -s) for s, t in sorted(found)[:8]]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 40
