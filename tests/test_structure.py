"""Blocks, anchors, bibliographies and citation ranges: offsets, guards, folds."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright.functions import citation_ranges, markup
from pagewright.operators import bibliography, citation_audit, structure
from pagewright.plans import registry

HTML = """<div class="a b" id=x>one
<p TITLE='q &amp; r'>two</p>
</div><P>three</P>
<p>open <table><tr><td>4</td><td>5 &lt; 6</td></tr></table>"""


def test_blocks_are_exact():
    closed, all_ = list(markup.elements(HTML)), list(markup.elements(HTML, overlapping=True))
    assert [(e.tag, e.line) for e in closed] == [("div", 1), ("p", 3), ("table", 4)]
    assert [(e.tag, e.line) for e in all_] == [("div", 1), ("p", 2), ("p", 3), ("table", 4), ("td", 4), ("td", 4)]
    for e in all_:
        assert HTML[e.start : e.stop].lower().endswith(f"</{e.tag}>") and HTML[e.start] == "<"
        assert HTML[e.body_start - 1] == ">" and HTML[e.body_stop : e.stop].lower() == f"</{e.tag}>"
    assert closed[0].attrs == {"class": "a b", "id": "x"} and all_[1].attrs == {"title": "q & r"}
    assert markup.shown_units(HTML[closed[2].start : closed[2].stop]) == ["4", "5 < 6"]


def test_reference_items_are_blocks_of_their_own():
    html = '<div><ol><li id="ref-1">A</li><li id="ref-2">B</li></ol></div><p id="ref-3">C</p><p>D</p><li id="ref-2">B</li>'
    assert [(e.tag, e.attrs.get("id"), nested) for e, nested in markup.reference_elements(html)] == [("p", "ref-3", False), ("p", None, False), ("li", "ref-2", False), ("li", "ref-1", True)]
    warned = '<p class="z2m-missing-figure-warning x">gone</p><p data="z2m-missing-figure-warning">not</p>'
    assert [e.start for e in markup.warning_elements(warned)] == [0]


def test_small_helpers():
    starts = markup.line_starts("a\nb\n\nc")
    assert [markup.line_of(starts, i) for i in (0, 1, 2, 4, 5)] == [1, 1, 2, 3, 4]
    assert markup.snippet("x" * 400, 200, 210, 20) == "..." + "x" * 14 + "..."
    assert markup.shown('<p>a <span class="katex">hidden <b>too</b></span> b<script>c</script></p>') == "a b"
    assert markup.diagnostic_words("<b>Per–cent</b> É 5") == ["per", "cent", "5"]
    assert markup.word_sequence("a fig 2 b", ["fig", "2"]) == (2, 7) and markup.word_sequence("a", []) is None
    assert markup.structure('<img src="data:image/png;base64,xx">') == '<img src="data:image/...">'
    assert markup.rebuilt("abcdef", {(4, 5): "", (1, 3): "--"}) == "a--df"


def test_table_functions_by_name(spark):
    structure.register(spark)
    spark.createDataFrame([(1, HTML), (2, None), (3, "")], "id int, html string").createOrReplaceTempView("marked")
    rows = spark.sql("SELECT id, b.tag, b.start, b.attrs['class'] AS c FROM marked, LATERAL markup_blocks(marked.html, false) b ORDER BY start").collect()
    assert [tuple(r) for r in rows] == [(1, "div", 0, "a b"), (1, "p", HTML.index("<P>"), None), (1, "table", HTML.index("<table>"), None)]


# --- bibliographies ------------------------------------------------------------------------------------------

FOLDS = {
    "heading": ([(1, "1. Before the heading.\nReferences\n1. Smith J. On things. 1999.\ncontinued here\n[2] Doe A, Roe B. More. 2001."), (2, "2\nmore of two\n3) Poe E. Tales. 1845.\n7. Too far. 1900.")], [(1, 1, "Smith J. On things. 1999. continued here"), (1, 2, "Doe A, Roe B. More. 2001. more of two"), (2, 3, "Poe E. Tales. 1845.")]),
    "pending": ([(1, "Bibliography\n1\nSmith J. On things. 1999.\n2​\n"), (2, "Doe A, Roe B. More. 2001.\n3\nsmall\nignored")], [(1, 1, "Smith J. On things. 1999."), (1, 2, "Doe A, Roe B. More. 2001.")]),
    "furniture": ([(3, "R E F E R E N C E S\n1. Smith J. On things. 1999.\n3\nAnnals of Surgery\nits end")], [(3, 1, "Smith J. On things. 1999. its end")]),
    "unheaded": ([(1, "Some text.\n" + "\n".join(f"{i} Author A. Title {i}, 200{i}." for i in (1, 2, 3, 4)))], [(1, i, f"Author A. Title {i}, 200{i}.") for i in (1, 2, 3, 4)]),
    "too few": ([(1, "\n".join(f"{i} Author A. Title {i}, 200{i}." for i in (1, 2, 3)))], []),
    "none": ([(1, None), (2, "")], []),
}


def test_folds_over_lines_and_pages(spark):
    rows = [(name, page, text) for name, (pages, _) in FOLDS.items() for page, text in pages]
    got = bibliography.entries(spark.createDataFrame(rows, "doc string, page int, text string"), ["doc"], "page", "text").orderBy("doc", "nth").collect()
    for name, (_, want) in FOLDS.items():
        assert [(r["page"], r["number"], r["text"]) for r in got if r["doc"] == name] == want, name


def plain_entries(lines, headed):
    """One reading, line by line, as plainly as can be. A line: page, text, number, body, kind, looks like a body (body, line), heading, furniture."""
    out, now, wait, on = [], None, None, not headed
    for page, text, number, body, kind, body_like, line_like, heading, furniture in lines:
        if not on:
            on = heading
        elif kind in ("bare", "punct_only", "tail"):
            if kind == "bare" and now and number != now[1] + 1:
                continue
            out, now, wait = out + [now] * bool(now), None, (page, number)
        elif kind == "body" and not headed and not body_like:
            now, wait = now and (*now[:2], f"{now[2]} {text}"), None
        elif kind == "body":
            wait = None
            if not now or now[1] < number <= now[1] + 3:
                out, now = out + [now] * bool(now), (page, number, body)
        elif furniture:
            continue
        elif wait:
            now, wait = ((*wait, text) if line_like else now), None
        elif now:
            now = (*now[:2], f"{now[2]} {text}")
    return out + [now] * bool(now)


def longest(entries):
    best, run = [], []
    for e in entries:
        if run and run[0][1] <= e[1] <= run[-1][1]:
            continue
        run = [*run, e] if run and e[1] == run[-1][1] + 1 else [e]
        best = run if len(run) > len(best) else best
    return best if len(best) >= 4 else []


def test_entries_of_documents_against_a_plain_reading(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    line = "concat_ws(' ', nullif(concat(1 + (doc_id + i) % 5, element_at(array('.', ')', '', ' ', ''), cast(1 + i % 5 as int))), ''), if(i % 3 = 2, '', l))"
    pages = docs.selectExpr("doc_id", "posexplode(split(text, '\n')) AS (i, l)").selectExpr("doc_id", "cast(1 + i / 4 AS int) AS page", "i", f"CASE WHEN i = 2 AND doc_id % 3 = 0 THEN 'References' ELSE {line} END AS l")
    pages = pages.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "l"))), lambda x: x["l"]), "\n").alias("text"))
    got = bibliography.entries(pages, ["doc_id"], "page", "text").orderBy("doc_id", "nth").collect()
    lines = {}
    for r in bibliography.classified(pages, ["doc_id"], "page", "text").orderBy("doc_id", "page", "at").collect():
        lines.setdefault(r["doc_id"], []).append((r["page"], r["line"], r["number"], r["body"], r["kind"], r["body_like"], r["line_like"], r["heading"], r["furniture"]))
    want = {d: plain_entries(ls, True) or longest(plain_entries(ls, False)) for d, ls in lines.items()}
    assert [(r["doc_id"], r["page"], r["number"], r["text"]) for r in got] == [(d, p, n, t.strip()) for d in sorted(want) for p, n, t in want[d]]
    assert len(got) > 50


def test_columns_by_hand(spark):
    column = [(1, n, x, 10.0 * i) for i, (n, x) in enumerate([(1, 100.0), (2, 124.0), (4, 110.0), (9, 101.0), (10, 100.0)])]
    other = [(1, 20, 125.0, 5.0), (2, 3, 0.0, 0.0), (2, 4, 0.0, 1.0), (3, 50, 7.0, 1.0)]
    got = bibliography.column_starts(spark.createDataFrame(column + other, "page int, number int, x double, y double"), ["page"]).collect()
    # no run of four in the first column; a high number keeps the second and the third page's whole
    assert sorted((r["page"], r["number"]) for r in got) == [(1, 20), (3, 50)]
    longer = [(1, n, 100.0, float(n)) for n in (1, 2, 3, 5, 9, 10, 11, 12)]
    got = bibliography.column_starts(spark.createDataFrame(longer, "page int, number int, x double, y double"), ["page"]).collect()
    assert sorted(r["number"] for r in got) == [1, 2, 3, 5]


def test_columns_are_sorted_once(spark, monkeypatch):
    """Runs that begin, end and tie, against a plain reading; starts dealt by page stay where they are, and are sorted once for the join and once for all windows."""
    rng = random.Random(11)
    starts = [(rng.randrange(3), rng.randrange(12), rng.choice([0.0, 10.0, 40.0]), rng.randrange(90) * 1.0) for _ in range(150)] + [(3, n, 5.0, 1.0 * n) for n in (1, 2, 3, 4, 9, 10, 11, 12, 30)]

    def expected():
        for page in range(4):
            for column, xs in ((1, (0.0, 5.0, 10.0)), (2, (40.0,))):
                order = sorted((y, n, x) for p, n, x, y in starts if p == page and x in xs)
                runs = []
                for y, n, x in order:
                    if runs and n - runs[-1][-1][0] in (1, 2):
                        runs[-1].append((n, x, y))
                    else:
                        runs.append([(n, x, y)])
                longest = max(runs, key=len, default=[])
                yield from [(page, column, *r) for r in (longest if len(longest) >= 4 else [])]

    monkeypatch.setattr(registry, "SHARE", 10)
    made = registry.dealt(spark.createDataFrame(starts, "page int, number int, x double, y double"), "page")
    assert made.rdd.getNumPartitions() == len(starts) // 10 + 1
    found = bibliography.column_starts(made, ["page"])
    assert sorted(map(tuple, found.collect())) == sorted(expected())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan
    assert len(re.findall(r"Sort \[[^\]]*column", plan.split("Initial Plan")[-1])) == 1


def test_targets_by_hand(spark):
    starts = spark.createDataFrame([(1, 5, 100.0, 200.0), (1, 6, 100.0, 230.0), (1, 7, 300.0, 200.0), (2, 1, 0.0, 0.0), (2, 2, 10.0, -30.0)], "page int, number int, x double, y double")
    links = [("near", 1, 90.0, 205.0), ("above", 1, 100.0, 217.0), ("far", 1, 100.0, 500.0), ("aside", 1, 500.0, 200.0), ("unplaced", 1, 0.0, 201.0), ("no height", 1, 310.0, 0.0), ("no page", 9, 1.0, 1.0), ("nothing", 2, 0.0, 0.0), ("null", 2, None, None)]
    got = dict(bibliography.located_targets(spark.createDataFrame(links, "link string, page int, x double, y double"), starts, "link").collect())
    # of equal heights the one more to the left; what lies more than 16 above gives way to what lies below, however far
    assert got == {"near": 5, "above": 6, "far": None, "aside": None, "unplaced": 5, "no height": 7, "no page": None, "nothing": 1, "null": 1}


# --- ranges --------------------------------------------------------------------------------------------------


def judge(raw, text=None, tag="p", **attrs):
    b = citation_ranges.Block(tag, attrs, raw if raw.startswith("<") else f"<p>{raw}</p>", text or markup.visible(raw))
    kind = citation_ranges.kind(b)
    return kind, citation_ranges.candidates(b) if kind else []


RANGES = [
    ("As shown before [1-4, 9].", "body", [1, 4, 9]),
    ("It was raised<sup>3, 5</sup> again.", "body", [3, 5]),
    ("It was raised<sup class='z2m-unit-exp'>3, 5</sup> again.", "", []),
    ("A tag [<i>7</i>, 8] inside.", "body", [7, 8]),
    ("A tag [<i>7</i>, eight] inside.", "", []),
    ('Linked <a class="z2m-ref-link">[2, 3]</a>.', "", []),
    ("The range [0, 1] is closed.", "", []),
    ("Found in earlier works [3, 5] with scores.", "math", [3, 5]),
    ("Lengths of [3, 5] mm were seen.", "", []),
    ("A current of [3, 5, 8] was set.", "", []),
    ("We put x [5, 3] = y there.", "math", [5, 3]),
    ("Raised<sup>4,2</sup> ml of it.", "", []),
    ("The mean was <sup>4-6</sup> kg then.", "", []),
    ("All of <sup>4-6</sup> kg then.", "body", [4, 6]),
    ("A room of 7 m<sup>10-5</sup> m wide.", "", []),
    ("Funding from Grant No. <sup>12,5</sup> went on.", "", []),
    ("Ran on Python version <sup>3,10</sup> here.", "", []),
    ("The slope was <sup>1,25</sup> here.", "", []),
    ("Shown<sup>1,25</sup>, and more.", "", []),
    ("There were <sup>3, 4</sup> or 5 chairs.", "", []),
    ("In total <sup>35-58</sup> questions came.", "", []),
    ("Pick items<sup>35-58</sup> freely.", "body", [35, 58]),
    ("Seen at <sup>2, 5</sup> and 7 days later.", "", []),
    ("They saw <sup>2, 5</sup> and 7 days later.", "body", [2, 5]),
    ("Seen <sup>2-5</sup> weeks later.", "", []),
    ("With power analysis, raised<sup>3, 5</sup> again.", "math", [3, 5]),
    ("Noted<sup class='z2m-footnote-ref'>7-11</sup> then.", "", []),
]


@pytest.mark.parametrize(("raw", "kind", "numbers"), RANGES)
def test_each_guard(raw, kind, numbers):
    assert judge(raw) == (kind, numbers)


def test_floats_and_tables():
    assert judge("<table><td>Author <sup>1,2</sup></td></table>", tag="table") == ("float", [1, 2])
    assert judge("<table><td>User height <sup>1,2</sup></td></table>", tag="table") == ("", [])
    assert judge("<p>Table 2 has [1, 2] in it.</p>")[0] == "float"
    assert judge("<table><td>Years [1999-2004]</td></table>", tag="table") == ("", [])
    assert judge("<p>Sum [1, 2] here</p>", **{"class": "z2m-equation-row"}) == ("", [])
    staff = "<table><td>Ann Lee 1,2 Bob Ray 2 Cy Fox 3 Di Moe 4 [1, 2] Department of A, University of B</td></table>"
    assert judge(staff, tag="table") == ("", [])


def test_defects_of_documents(spark):
    refs = "<h2>References</h2>" + "".join(f'<li id="ref-{i}">An entry.</li>' for i in (1, 2, 3))
    html = {
        "plain": "<p>As shown [1, 2].</p>" + refs,
        "missing": "<p>As shown [2, 7].</p>" + refs,
        "untargeted": "<p>As shown [1, 2].</p>",
        "body first": "<table><td>Author <sup>1,2</sup></td></table><p>As shown [1, 2].</p>" + refs,
        "float": "<table><td>Author <sup>1,2</sup></td></table>" + refs,
        "strange float": "<table><td>Author <sup>8,9</sup></td></table>" + refs,
        "math": "<p>The scores<sup>2-3</sup> rose.</p>" + refs,
        "noted": '<p>The scores<sup>8-9</sup> rose.</p><p id="footnote-8">n</p><p id="footnote-9">n</p>',
        "behind": "<p>No range.</p>" + refs + "<p>As shown [1, 2].</p>",
        "aside": '<p class="x z2m-footnote">As shown [1, 2].</p>' + refs,
        "signs": "<p>Then \\(^{1-2}\\) came.</p><p>task. Sec. 2</p>" + refs,
        "empty": "",
    }
    df = spark.createDataFrame(list(html.items()), "doc string, html string")
    got = {}
    for r in citation_audit.citation_defects(structure.blocks(df, "html"), ["doc"]).orderBy("doc", "id").collect():
        got.setdefault(r["doc"], []).append((r["id"], r["n"], r["numbers"], r["missing"]))
    assert got == {
        "plain": [("P04", 0, [1, 2], [])],
        "missing": [("P04R", 0, [2, 7], [7])],
        "untargeted": [("P04N", 0, [1, 2], [])],
        "body first": [("P04", 1, [1, 2], [])],
        "float": [("P04T", 0, [1, 2], [])],
        "math": [("P04M", 0, [2, 3], [])],
        "signs": [("P28", 0, [], []), ("P32", 1, [], [])],
    }


def test_defects_of_whole_documents(spark):
    """The same defects without a table of blocks and without a shuffle; blocks behind the first range of the body aren't judged."""
    refs = "<h2>References</h2>" + "".join(f'<li id="ref-{i}">An entry.</li>' for i in (1, 2, 3))
    rng = random.Random(3)
    pieces = [f"<p>{raw}</p>" for raw, _, _ in RANGES] + ["<table><td>Author <sup>1,2</sup></td></table>", '<p class="x z2m-footnote">As shown [1, 2].</p>', '<p id="Footnote-2">n</p>', "<p>Then \\(^{1-2}\\) came.</p>", "<p>task. Sec. 2</p>", "<h2> <b>REFERENCES</b></h2>", "<p>&#91;1, 2&#93; x<sup>2</sup></p>", '<div><li id="REF-4">e</li></div>', "<p>never closed"]
    docs = [(i, "\n".join(rng.choices(pieces, k=rng.randrange(6))) + refs * (i % 2)) for i in range(300)] + [(300, None), (301, "<p>" + "long " * 400 + "[1, 2].</p>" + refs)]
    df = spark.createDataFrame(docs, "doc int, html string")
    rows = lambda found: sorted((r["doc"], r["id"], r["severity"], r["n"], tuple(r["numbers"]), tuple(sorted(r["missing"]))) for r in found.collect())
    whole = citation_audit.document_defects(df, ["doc"], "html")
    assert rows(whole) == rows(citation_audit.citation_defects(structure.blocks(df, "html"), ["doc"]))
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()


def test_anchors_in_their_blocks(spark):
    html = '<p>a <a href="#x">b</a> <a href="y">c</a></p><a href="z">d</a><div><a>e</a></div>'
    df = spark.createDataFrame([(1, html)], "id int, html string")
    got = structure.enclosing(structure.anchors(df, "html"), structure.blocks(df, "html"), ["id"]).orderBy("n").collect()
    assert [(r["label"], r["href"], r["tag"]) for r in got] == [("b", "#x", "p"), ("c", "y", "p"), ("d", "z", None), ("e", None, "div")]
    assert re.findall("<a", html) == ["<a"] * 4


def test_located_targets_on_a_dense_page(spark):
    """Thousands of starts within reach of each link, all ties, links without a place and starts far below; against brute force. No pairs are made."""
    rng = random.Random(5)
    places = [(rng.randrange(2), rng.randrange(60), rng.randrange(40) * 10.0, rng.choice([rng.randrange(-60, 500) / 2, rng.randrange(100, 104) / 1.0])) for _ in range(3000)] + [(2, 1, 50.0, 10.0), (2, 2, 70.0, 900.0), (3, 1, 50.0, 10.0)]
    wanted = [(i, rng.randrange(2), rng.choice([0.0, rng.randrange(1, 450) * 1.0]), rng.choice([0.0, rng.randrange(-160, 800) / 2])) for i in range(1500)] + [(1500, 2, 60.0, 40.0), (1501, 3, 60.0, 40.0), (1502, 2, 0.0, 40.0), (1503, 3, 0.0, 40.0)]

    def expected(page, x, y):
        near = [(sy < y - 16, abs(sy - y), max(0.0, sy - y), abs(sx - x) if x else 0.0, sx, sy, n) for p, n, sx, sy in places if p == page and (not x or abs(sx - x) <= 80)]
        best = min(near, default=None)
        return best and (best[-1] if y == 0 or best[1] <= 40 else None)

    starts = spark.createDataFrame(places, "page int, number long, x double, y double")
    got = dict(bibliography.located_targets(spark.createDataFrame(wanted, "link long, page int, x double, y double"), starts, "link").collect())
    assert got == {i: expected(page, x, y) for i, page, x, y in wanted}
    assert (got[1500], got[1501], got[1502], got[1503]) == (None, 1, None, 1)


def test_open_entities_stay_if_asked(spark):
    """A bare ``&amp`` is decoded as browsers do, or stays; those with a semicolon are decoded either way, once."""
    html = "<p>a &amp b &amp; &lt;c&gt; &amp;lt; &#233; &#xe9; &eacute; &nosuch; &notit; d&amp</p>"
    df = spark.createDataFrame([(html,)], "html string")
    shown = lambda **k: [r["text"] for r in structure.blocks(df, "html", **k).collect()]
    assert shown() == ["a & b & <c> &lt; é é é &nosuch; ¬it; d&"]
    assert shown(open_entities=False) == ["a &amp b & <c> &lt; é é é &nosuch; &notit; d&amp"]
    structure.register(spark)
    df.createOrReplaceTempView("entities")
    assert [r[0] for r in spark.sql("SELECT text FROM entities, LATERAL markup_blocks(html, false)").collect()] == shown()
