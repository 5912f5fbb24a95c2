import random

import json

from pyspark.sql import functions as F

from pagewright.functions import language, ocr, text
from pagewright.operators import citations, defects, detectors, history, ledgers, matching, pages, repairs, runs, sequences, trees
from pagewright.sources import readers, writers
from pagewright.streaming import ledger


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


def test_visible_text(spark):
    html = "<p>A&amp;B<!-- no --></p><script>x('</p>')</script><div>see https://a.b/c now<br>C &lt;d&gt;</div>"
    assert one(spark, text.visible(F.col("h")), h=html) == "A&B see now C <d>"


def test_repairs(spark):
    assert one(spark, text.collapsed_phrases(F.col("t")), t="so the cat the cat the cat sat") == "so the cat sat"
    assert one(spark, text.joined_addresses(F.col("t")), t="to a.b@ c.org or x @ y") == "to a.b@c.org or x @ y"
    got = one(spark, text.url_and_rest(F.col("t")), t="http://a.b/(c)).")
    assert (got["url"], got["rest"]) == ("http://a.b/(c)", ").")
    assert one(spark, text.url_key(F.col("t")), t=" HTTPS://www.A.b/c/ ") == "a.b/c"


def test_languages(spark):
    rows = [
        (1, "the cat and the dog are in the house with a man of the town that is by it " * 8),
        (2, "это было для меня и не для него что было бы если бы он был там " * 12),
        (3, "der Hund und die Katze sind nicht mit dem Mann von der Stadt auf dem Land " * 8),
        (4, "short"),
        (5, "日本語のテキストはここにあります。これは長い文章です。" * 20),
    ]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r["id"]: r["language"] for r in language.detect_document(df, "id", F.col("t")).collect()}
    assert got == {1: "en", 2: "ru", 3: "de", 4: "unknown", 5: "ja"}


def test_windows_cover_the_ends(spark):
    df = spark.createDataFrame([(1, "x" * 20_000), (2, "")], "id long, t string")
    got = [(r["id"], r["start"], len(r["text"])) for r in language.windows(df, "id", F.col("t")).orderBy("id", "start").collect()]
    assert got[0] == (1, 0, 4500) and got[-2][1] == 15_500 and got[-1] == (2, 0, 0)


def test_damaged_tokens(spark):
    df = spark.createDataFrame([(w,) for w in ("brght", "mmxvii", "a1b2c", "WOrD", "heLLOw", "house", "rnvvii")], "w string")
    got = {r["w"]: r["x"] for r in df.select("w", ocr.is_damaged(F.col("w")).alias("x")).collect()}
    assert got == {"brght": True, "mmxvii": False, "a1b2c": True, "WOrD": False, "heLLOw": True, "house": False, "rnvvii": True}


def test_ranges_runs_and_intervals(spark):
    assert one(spark, sequences.expanded_ranges(F.col("t")), t="3, 5-8,7,300,9-100") == [3, 5, 6, 7, 8]
    df = spark.createDataFrame([("a", n) for n in (9, 1, 2, 3, 3, 7, 8)], "g string, n long")
    assert [tuple(r) for r in sequences.longest_run(df, "g", "n").collect()] == [("a", 1, 3)]
    assert sorted(r["missing"] for r in sequences.gaps(df, "g", "n").collect()) == [4, 5, 6]
    spans = spark.createDataFrame([("a", 1, 3), ("a", 3, 4), ("a", 6, 9), ("a", 7, 8)], "g string, s long, e long")
    assert sorted(tuple(r) for r in sequences.merged_intervals(spans, "g", "s", "e").collect()) == [("a", 1, 4, 2), ("a", 6, 9, 2)]


def test_upsert_refuses_unknown_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(tuple(r) for r in history.upsert(old, new, "k", allow_new=False).collect()) == [(1, "a"), (2, "B")]
    assert history.upsert(old, new, "k").count() == 3


def test_a_cycle_is_an_error(spark):
    import pytest

    df = spark.createDataFrame([("a", "b"), ("b", "a")], "p string, c string")
    with pytest.raises(ValueError, match="cycle"):
        trees.descendants(df, "p", "c", 3)


def test_blocks_and_links(spark):
    df = spark.createDataFrame([(1, "<p>a<img src='x'></p><li id='r1'>b</li><a href='#r1'>1</a><a href='#r2'>2</a><table><tr><td>c</td></tr></table>")], "id long, h string")
    got = pages.blocks(df, ["id"], F.col("h")).orderBy("idx").collect()
    assert [(r["tag"], r["text"], r["has_img"]) for r in got] == [("p", "a", True), ("li", "b", False), ("table", "c", False)]
    assert pages.link_assessment(df, ["id"], F.col("h")).first()["broken_targets"] == ["r2"]


def test_names_and_groups(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a"), (3, "b")], "id long, n string")
    assert {r["id"]: r["unique_name"] for r in matching.unique_names(df, F.col("n"), "id").collect()} == {1: "A", 2: "a_2", 3: "b"}
    rows = spark.createDataFrame([("x", i % 7) for i in range(40)], "d string, a long")
    got = ledgers.decision_groups(rows, ["d"], "a", 3).first()
    assert (got["count"], got["articles"], got["sample"]) == (40, 7, [0, 1, 2])


def test_lenient_json_lines(spark, tmp_path):
    p = tmp_path / "ledger.jsonl"
    p.write_text("\n".join([json.dumps({"id": 1, "s": "a"}), "", "{broken", "[1, 2]", json.dumps({"id": 2})]))
    got = readers.json_lines(spark, str(p), "id long, s string").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, None)]


def test_stages_to_manifest(spark, tmp_path):
    for article, stages in {"one": ("01.en.raw", "02.en.polish"), "two": ("01.en.raw",)}.items():
        folder = tmp_path / article / "_stages"
        folder.mkdir(parents=True)
        for s in stages:
            (folder / f"{s}.html").write_text(f"<p>{article}</p>")
    files = readers.stage_files(spark, [str(tmp_path)])
    assert [r["article"] for r in readers.stage_pairs(files).collect()] == ["one"]
    assert {r["article"]: r["valid"] for r in writers.manifest(files).collect()} == {"one": True, "two": False}
    writers.write_stage(spark.range(3).toDF("id"), str(tmp_path / "out"), "polish")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_queue_keeps_the_latest(spark):
    q = spark.createDataFrame([("a", 1, "x")], "k string, at long, v string")
    e = spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], "k string, at long, v string")
    assert sorted((r["k"], r["v"]) for r in writers.upserted_queue(q, e, ["k"], "at").collect()) == [("a", "y"), ("b", "z")]


def test_stream_agrees_with_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id", "event_type")
    events.repartition(4).write.parquet(str(tmp_path / "events"))
    stream = ledger.latest_stream(ledger.entries_of(spark, str(tmp_path / "events"), events.schema), "user_id", "ts", "event_id")
    ledger.run_to_table(stream, "latest_entries")
    got = sorted(tuple(r) for r in spark.table("latest_entries").collect())
    assert got == sorted(tuple(r) for r in ledgers.latest(events, "user_id", "ts", "event_id").collect())


def test_references_that_fit_once(spark):
    from pagewright.operators import citations

    cites = spark.createDataFrame([(1, "Smith and Lee 2010", ["Smith", "Lee"], "2010"), (1, "Roe 1999", ["Roe"], "1999")], "d long, label string, surnames array<string>, year string")
    refs = spark.createDataFrame([(1, "ref-1", ["smith", "lee", "title"], "2010"), (1, "ref-2", ["smith", "other"], "2010"), (1, "ref-3", ["roe"], "1999"), (1, "ref-4", ["roe"], "1999")], "d long, target string, words array<string>, year string")
    assert [tuple(r) for r in citations.matched_references(cites, refs, "d").collect()] == [(1, "Smith and Lee 2010", "ref-1")]


def test_recovery_reasons(spark):
    from pagewright.operators import citations

    rows = [(1, '<li id="ref-1"><li id="ref-4">', [1]), (2, '<li id="ref-1">', [1, 2]), (3, "", [5, 5]), (4, "", [])]
    df = spark.createDataFrame(rows, "id long, h string, c array<int>")
    got = {r["id"]: (r["numbers"], r["reason"]) for r in citations.recovery_numbers(df, ["id"], F.col("h"), F.col("c")).collect()}
    assert got == {1: ([2, 3], "reference_id_gap"), 2: ([2], "body_citation_missing_target"), 3: ([5], "body_citation"), 4: ([], "")}


def test_polish_repairs_and_leaves_the_rest(spark):
    from pagewright.operators import repairs

    cases = {
        "<p>GrÃ¶ÃŸe</p>": "<p>Größe</p>",
        "<p>Page 3 of 9</p><p>x</p>": "<p>x</p>",
        r"a \(^{12}\) b": "a <sup>12</sup> b",
        '<a href="#ref-3">)3</a>': ')<a href="#ref-3">3</a>',
        '<a href="http: //a.b/c">x</a>': '<a href="http://a.b/c">x</a>',
        "<p> &nbsp; </p><p>kept</p>": "<p>kept</p>",
        "<head></head>": '<head><meta charset="utf-8"></head>',
        "<p>5 < 6 and fine.</p>": "<p>5 < 6 and fine.</p>",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "html string, want string")
    for r in repairs.polish(df, "html").collect():
        assert r["polished"] == r["want"]
    got = one(spark, repairs.without_broken_links(F.col("h"), F.array(F.lit("a"))), h='<a href="#a">1</a><a href="#b.c">2</a>')
    assert got == '<a href="#a">1</a>2'


def test_block_audits(spark):
    from pagewright.operators import audits

    rows = [(1, i, t, x, img) for i, (t, x, img) in enumerate([("h2", "RESULTS TABLE", False), ("p", "Table 1 shows", False), ("p", "Figure 2 A caption", False), ("table", "", False), ("p", "(3)", False), ("p", "x", False), ("p", "x", False), ("p", "this goes on and", False), ("figure", "", True), ("p", "ends here.", False), ("h2", "References", False), ("li", "one", False)])]
    df = spark.createDataFrame(rows, "doc long, idx long, tag string, text string, has_img boolean")
    got = sorted((r["idx"], r["defect"]) for r in audits.block_defects(df, ["doc"]).collect())
    assert got == [(0, "heading_before_caption"), (2, "caption_without_image"), (4, "orphan_equation_number"), (7, "sentence_broken_by_image")]
    flags = [r["in_references"] for r in audits.in_references(df, ["doc"]).orderBy("idx").collect()]
    assert flags == [False] * 10 + [True] * 2


def test_catalogue_of_detectors(spark):
    from pagewright.operators import detectors

    html = (
        "<html><body><h2>A FIGURE HEADING THAT IS LONG AND ALL IN CAPITALS</h2><p>1. [1] Name</p><p>Page 2 of 9</p><table><h3>x</h3></table>"
        '<p>see <a href="#ref-1">1</a> <a href="#ref-2">3</a> <a href="#ref-8">8</a> <a href="#page-4">as shown above here</a> <a href="#page-4">2.3</a> <a href="#page-5">Smith, 2010</a></p>'
        '<li id="ref-1">1. One</li><li id="ref-2">2. Two</li><li id="ref-4">2. Again</li><li id="ref-5">no number</li> mail a@ b.org \\(^{3}\\)</a></a></body></html>'
    )
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "id long, h string")
    df = df.withColumnRenamed("id", "page")
    rows = [(r["page"], r["id"]) for r in detectors.audit(df, ["page"], F.col("h")).collect()]
    one = {rule for page, rule in rows if page == 1}
    assert one >= {"R13", "P27", "R07", "P77", "P42", "P04R", "P51", "P43", "P56", "P22", "P26", "P97", "P89", "P28", "P34", "P81"}
    assert {rule for page, rule in rows if page == 2} == {"R01", "R02", "R03X"} == {rule for page, rule in rows if page == 3}


def test_runs(spark):
    from pagewright.operators import runs

    df = spark.createDataFrame([(n,) for n in (0, 5, 15, 16, 40)], "n int")
    got = {r["n"]: r["p"] for r in df.select("n", runs.sampled_pages(F.col("n")).alias("p")).collect()}
    assert got[0] == [] and got[5] == [0, 1, 2, 3, 4] and len(got[15]) == 15
    assert got[40] == sorted({0, 1, 2, 37, 38, 39} | {round(39 * i / 10) for i in range(1, 10)})[:15]
    counts = spark.createDataFrame([(1, "Cite", 3), (1, "ref", 3), (1, "fig", 9)], "d long, prefix string, n long")
    assert runs.dominant_prefix(counts, ["d"], ["ref", "cite"]).first()["prefix"] == "ref"
    queue = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "path string, attempts int")
    outcome = spark.createDataFrame([("a", "uploaded"), ("b", "failed")], "path string, outcome string")
    assert sorted(tuple(r) for r in runs.retried(queue, outcome, ["path"]).collect()) == [("b", 2), ("c", 2)]
    f = spark.createDataFrame([(1, "alpha bravo charlie delta echoes foxtrot golfing")], "f long, text string")
    t = spark.createDataFrame([(1, "the alpha bravo charlie delta echoes foxtrot golfing hotel"), (2, "golfing foxtrot echoes delta charlie bravo alpha")], "t long, text string")
    assert [(r["t"], r["score"]) for r in runs.title_candidates(f, t, "f", "t", "text").collect()] == [(1, 1.0)]


def test_superscripts_that_became_plain_text(spark):
    cited = "It was seen. 1,2,3 Then it was lost. " * 6
    r = citations.styles(spark.createDataFrame([(1, cited)], "id int, text string"), ["id"], F.col("text")).first()
    assert (r["style"], r["confidence"], r["paren"], r["bracket"]) == ("superscript_numeric", "high", 0, 0)


def test_wrongly_decoded_degrees_and_slugs_of_any_script(spark):
    r = spark.createDataFrame([("20 Â°C", "Об одной: статье.", "?!")], "a string, b string, c string")
    r = r.select(F.col("a").alias("html"), text.slug(F.col("b")).alias("b"), text.slug(F.col("c")).alias("c"))
    r = repairs.polish(r, "html").first()
    assert (r["polished"], r["b"], r["c"]) == ("20 °C", "Об_одной_статье", "article")


def test_title_candidates_in_long_titles(spark):
    """Titles of thousands of words that hold most beginnings of every fragment; against brute force over all pairs."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(3, 8))) for _ in range(200)]
    titles = [(i, " ".join(rng.choices(words, k=rng.choice([0, 20, 300, 3000])))) for i in range(60)] + [(60, None)]
    fragments = [(i, " ".join(rng.choices(words, k=rng.choice([4, 9, 30])))) for i in range(30)] + [(30 + i, " ".join(t.split()[3:20])) for i, t in titles[:20]]

    def score(fragment, title):
        f, t = ([w for w in x.split() if len(w) >= 4] for x in (fragment, title))
        if len(fragment) >= 32 and f and fragment in title:
            return 1.0
        at = n = 0
        for w in f:
            place = next((p for p in range(at, len(t)) if t[p].startswith(w) or w.startswith(t[p])), None)
            at, n = (at, n) if place is None else (place + 1, n + 1)
        return round(n / len(f), 4) if len(f) >= 6 and n >= 6 and n >= 0.78 * len(f) else 0

    want = {(f, t): s for f, x in fragments for t, y in titles if y is not None and (s := score(x, y))}
    best = {f: sorted((-s, t) for (g, t), s in want.items() if g == f)[:8] for f, _ in fragments}
    got = runs.title_candidates(spark.createDataFrame(fragments, "f int, x string"), spark.createDataFrame(titles, "t long, x string"), "f", "t", "x").collect()
    assert {(r["f"], r["t"], r["score"]) for r in got} == {(f, t, -s) for f, rows in best.items() for s, t in rows} and len(want) > 50


def test_rules_need_what_their_matches_have(spark):
    """A rule's needed part is in whatever its pattern matches, so a rule with it finds what it finds without; texts without the part aren't searched."""
    shown = ["a � b", "see 10.1234/ abc.d there", "jane vi@x", r"\a{\b{\c{\d{\e{\f{", "10.1234/ab.9The end", "x@ab. de", "www. x", "joe@ ab.de", "con- tinue", "5 µ m", r"\( ^{12", "@@SOME_MARK@@", "@@ 10. - www. µ", "", None]
    df = spark.createDataFrame(list(enumerate(shown)), "i int, text string")
    rules = (*detectors.TEXT_RULES, *detectors.MARKUP_RULES)
    plain = [defects.Rule(r.id, r.severity, r.check, r.pattern) for r in rules]
    rows = lambda rs: sorted(map(tuple, defects.detect(df, ["i"], F.col("text"), rs).collect()))
    assert rows(rules) == rows(plain)
    assert {r.id for r in rules if r.needs} <= {r[1] for r in rows(rules)}
    # "(a|a)*b" takes exponential time on such a text, were it searched
    slow = spark.createDataFrame([(0, "a" * 40)], "i int, text string")
    assert defects.detect(slow, ["i"], F.col("text"), [defects.Rule("S", "info", "slow", "(?:a|a)*b", "b")]).count() == 0
