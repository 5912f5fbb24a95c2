"""Front matter: each rule, what explains it away, and how far it looks."""

import pytest
from pyspark.sql import functions as F

from pagewright.operators import frontmatter, structure


def blocks(spark, docs):
    df = spark.createDataFrame([(d, "\n".join(b if b.startswith("<") else f"<p>{b}</p>" for b in bs)) for d, bs in docs.items()], "doc string, html string")
    return structure.blocks(df, "html")


def found(spark, raw=None, polish=None):
    none = {"nothing": []}
    got = frontmatter.frontmatter_defects(blocks(spark, raw or none), blocks(spark, polish or none), ["doc"]).collect()
    return sorted((r["doc"], r["id"], r["n"]) for r in got)


EXPLAINED = {
    "copyright": "© 2020 The Authors. All rights reserved",
    "cite": "To cite this article: Ann Lee 1 2",
    "cyrillic": "Иванов Петр Сидоров Николай Александрович Москва Университет © 1",
    "received": "Received 2.3.2020 Accepted 4.5.2020",
    "address": "Ann Lee 1 2 Department of A, Main Street",
    "mail": "Bob Ray 3 4 e-mail bob@x.org University of B",
    "trial": "Ann Lee 1 2 ClinicalTrials.gov",
    "index": "Ann Lee, Bob Ray, Cy Fox, Di Moe, Ed Poe Jr 1 2, 3, 4",
    "section": "1.2.3 Ann Lee 1.2.3",
    "contents": "List of Figures Ann Lee 1 2",
    "case": "Case No. Age Sex Lesion Ann Lee 1 2",
    "doi": "Ann Lee 1 2 et al. doi:10.1000/x",
}


def test_damaged_markers(spark):
    raw = {name: ["intro", text] for name, text in EXPLAINED.items()}
    raw |= {"plain": ["intro", "Ann Lee 1 2, Bob Ray 3"], "dotted": ["Ann Lee 1.2.3"], "sign": ["by © 3 them"], "late": ["x"] * 20 + ["Ann Lee 1 2"], "fine": ["Ann Lee, Bob Ray"]}
    raw |= {"mended": ["Ann Lee 1 2, Bob Ray 3"], "half mended": ["Ann Lee 1 2, Bob Ray 3"], "still": ["Ann Lee 1 2, Bob Ray 3"]}
    polish = {
        "mended": ['<p class="z2m-front-matter">Ann Lee<sup>1,2</sup>, Bob Ray<sup>3</sup></p>'],
        "half mended": ['<p class="z2m-front-matter">Ann Lee<sup>a</sup> alone</p>'],
        "still": ['<p class="z2m-front-matter">Ann Lee 1 2<sup>,</sup>, Bob Ray</p>'],
    }
    # a name with its copyright sign is a notice, so a bare one is explained
    assert found(spark, raw, polish) == [("dotted", "P01", 0), ("half mended", "P01", 0), ("plain", "P01", 1), ("still", "P01", 0)]


LINK = '<a href="#ref-{0}">{0}</a>'


def test_links_in_affiliations_and_author_lines(spark):
    authors = f"Ann Lee{LINK.format(1)} Bob Ray{LINK.format(2)}"
    polish = {
        "affiliation": ["x", f'<p class="z2m-affiliations">{LINK.format(4)} Lab</p>'],
        "late affiliation": ["x"] * 25 + [f'<p class="z2m-affiliations">{LINK.format(4)} Lab</p>'],
        "authors": [authors],
        "late authors": ["x"] * 18 + [authors],
        "words": ['Ann Lee<a href="#ref-1">one</a> Bob Ray<a href="#ref-2">two</a>'],
        "body": [f"Ann Lee{LINK.format(1)} Bob Ray{LINK.format(2)} reported"],
        "brackets": [f"Ann Lee [{LINK.format(1)}] Bob Ray{LINK.format(2)}"],
        "prose": [f"Seen by Ann Lee and Bob Ray.{LINK.format(1)}{LINK.format(2)}"],
    }
    assert found(spark, polish=polish) == [("affiliation", "P02", 1), ("authors", "P03", 0)]


META = ["Received: 3.4.2020", "doi:10.1000/abc"]
LONG = "Clinical validation of the model in many patients, which goes on for more than eighty characters."


def test_interrupted_sentences_and_late_marks(spark):
    polish = {
        "cut": ["Title.", "the sentence goes", *META, "on after them."],
        "marked": ["It goes", '<p class="z2m-front-matter">a</p>', '<p class="z2m-front-matter">b</p>', "and on"],
        "blank between": ["It goes", META[0], "<p> </p>", META[1], "on"],
        "one only": ["It goes", META[0], "on"],
        "ended": ["It ends.", *META, "on"],
        "capital": ["It goes", *META, "On"],
        "heading": ["<h2>It goes</h2>", *META, "on"],
        "far": ["x."] * 40 + ["It goes", *META, "on"],
        "near the end": ["x."] * 39 + ["It goes", *META, *META, META[0], "on"],
        "past the end": ["x."] * 39 + ["It goes", *META, *META, *META[::-1], "on"],
        "late": ["x."] * 40 + [f'<p class="z2m-front-matter">{LONG}</p>'],
        "late list": ["x."] * 40 + [f'<p class="z2m-front-matter"><ul>{LONG}</ul></p>'],
        "late short": ["x."] * 40 + ['<p class="z2m-front-matter">clinical</p>'],
        "early": [f'<p class="z2m-front-matter">{LONG}</p>'],
    }
    assert found(spark, polish=polish) == [("blank between", "P100", 1), ("cut", "P100", 2), ("late", "P25", 40), ("marked", "P100", 1), ("near the end", "P100", 40)]


@pytest.mark.parametrize(
    ("text", "is_one"),
    [
        ("12/345 3 May 2020 EN", True), ("IP Address: 1.2.3.4", True), ("2019 J. Neural Eng. 16 1", True), ("2019 Nature 16 12345", True), ("2019 Nature 16 1", False),
        ("CHI '20, April", True), ("Citation: Lee (2020)", True), ("Preprint version. doi:10.1000/x", True), ("https://doi.org/10.1000/x", True),
        ("Recebido 1.2.2020 e 3.4.2020", True), ("Submitted 3 March 2020", True), ("3.4.2020", True), ("Results with doi:10.1000/x", False), ("Printed in the United States of America 1 2 3", True), ("A plain sentence", False), ("Abteilung A, 12345 Berlin", True),
    ],
)
def test_notices(spark, text, is_one):
    assert spark.range(1).select(frontmatter.is_notice(F.lit(text))).first()[0] is is_one


def test_one_table_for_both_stages(spark):
    """Long documents give the rules a fixed number of blocks and the marked ones, and a table that is both stages is made once; the defects stay."""
    authors = f"Ann Lee{LINK.format(1)} Bob Ray{LINK.format(2)}"
    late = [f'<p class="x z2m-front-matter">{LONG}</p>', f'<p class="z2m&#45;front&#45;matter">{LONG}</p>', '<p class="z2m-front-matters">x</p>']
    docs = {
        "long": ["Ann Lee 1 2", authors, "It goes", *META, "on", *["x."] * 200, late[0]],
        "hidden": ["x"] * 60 + [late[1]],
        "alike": ["x"] * 60 + [late[2]],
        "edge": ["x."] * 39 + ["It goes", *META, *META, META[0], "on"],
        "plain": ["x"] * 300,
        "empty": [],
    }
    df = spark.createDataFrame([(d, "\n".join(b if b.startswith("<") else f"<p>{b}</p>" for b in bs)) for d, bs in docs.items()] + [("null", None)], "doc string, html string")
    few = frontmatter.blocks(df, "html")
    assert {r["doc"]: r["count"] for r in few.groupBy("doc").count().collect()} == {"long": 47, "hidden": 47, "alike": 46, "edge": 46, "plain": 46}
    every = {(r["doc"], r["n"]): r for r in structure.blocks(df, "html").collect()}
    assert all(every[r["doc"], r["n"]] == r for r in few.collect())
    out = frontmatter.frontmatter_defects(few, few, ["doc"])
    rows = lambda d: sorted((r["doc"], r["id"], r["n"]) for r in d.collect())
    assert rows(out) == rows(frontmatter.frontmatter_defects(structure.blocks(df, "html"), structure.blocks(df, "html"), ["doc"]))
    assert ("hidden", "P25", 60) in rows(out) and ("long", "P01", 0) in rows(out)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("BatchEvalPythonUDTF") == 1 and "Join" not in plan
