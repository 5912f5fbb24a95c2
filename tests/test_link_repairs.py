"""Targets, anchor runs and links in text, against plain readings and by hand."""

import random
import re

import pytest

from pagewright.functions import urls
from pagewright.operators import link_repairs


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()), "doc string, html string")


def got(df, column="html"):
    return {r["doc"]: r[column] for r in df.collect()}


def test_targets_by_hand(spark):
    docs = {
        "plain": '<p id="a">1</p><a href="#a">x</a>',
        "two": '<p id="a">1</p><a href="#a">x</a><p id=\'a\'>2</p> and <a href="#a">y</a>',
        "chunks": '<section data-zotero-worker-chunk="1" data-pages="1-2"><p id="n">1</p></section><section data-zotero-worker-chunk="2" data-pages="3 4"><a href="#n">far but own</a>' + "-" * 300 + '<p id="n">2</p><i id="n">3</i></section><a href="#n">out</a>',
        "taken": '<p id="a">1</p><p id="a--z2m-d2">t</p><p id="a">2</p><a href="#a">y</a>',
        "words": '<p id="a">1</p><p id="b">b</p>' + "-" * 90 + '<p id="a">2</p><label for="b a">l</label><b style="fill:url(#a)">c</b><a xlink:href="#a%62">d</a>',
        "hidden": '<!-- <p id="a"> --><script>x = \'<p id="a">\'</script><p id="a" title="id=\'a\'">1</p><a name="b" id="b">2</a>',
        "escaped": '<p id="x&amp;y">1</p><p id="x&amp;y">2</p><a href="#x&amp;y">z</a><a href="#x%26y">z</a>',
        "empty": "",
        "null": None,
    }
    done = link_repairs.unique_targets(frame(spark, docs).selectExpr("*", "1 AS value", "'q' AS at"), ["doc"], "html")
    out, rows = got(done), {r["doc"]: (r["duplicate_targets"], r["renamed_targets"], r["rewritten_references"]) for r in done.collect()}
    for same in ("plain", "hidden", "empty", "null"):
        assert out[same] == docs[same] and rows[same] == (0, 0, 0)
    # of equally near targets the one behind: the first link is nearer to the first paragraph's start
    assert out["two"] == '<p id="a">1</p><a href="#a">x</a><p id=\'a--z2m-d2\'>2</p> and <a href="#a--z2m-d2">y</a>' and rows["two"] == (1, 1, 1)
    assert '<p id="n--z2m-p3-4">2</p><i id="n--z2m-p3-4-2">3</i>' in out["chunks"] and '<a href="#n--z2m-p3-4">far' in out["chunks"] and '<a href="#n--z2m-p3-4-2">out' in out["chunks"]
    assert '<p id="a--z2m-d2-2">2</p><a href="#a--z2m-d2-2">' in out["taken"]
    assert 'for="b a--z2m-d2"' in out["words"] and "url(#a--z2m-d2)" in out["words"] and 'xlink:href="#a%62"' in out["words"]
    assert out["escaped"] == '<p id="x&amp;y">1</p><p id="x&amp;y--z2m-d2">2</p><a href="#x&amp;y--z2m-d2">z</a><a href="#x&amp;y--z2m-d2">z</a>'


@pytest.mark.parametrize("seed", range(2))
def test_targets_are_unique_and_links_resolve(spark, seed):
    r = random.Random(seed)
    docs = {}
    for d in range(30):
        parts = []
        for _ in range(r.randint(0, 25)):
            name = r.choice("abc")
            parts.append(r.choice([f'<p id="{name}">t</p>', f'<a href="#{name}">l</a>', f'<a name="{name}">m</a>', "text " * r.randint(1, 9), '<section data-zotero-worker-chunk="k">', "</section>"]))
        docs[f"d{d}"] = "".join(parts)
    out = got(link_repairs.unique_targets(frame(spark, docs), ["doc"], "html"))
    for name, html in docs.items():
        ids = re.findall(r'(?:id|name)="(\w[^"]*)"', out[name])
        assert len(ids) == len(set(ids)), (html, out[name])
        had = set(re.findall(r'(?:id|name)="(\w+)"', html))
        for before, after in zip(re.findall('href="#([^"]+)"', html), re.findall('href="#([^"]+)"', out[name]), strict=True):
            assert after in ids if before in had else after == before
        bare = lambda t: re.sub(r'="#?[abc][^"]*"', "", t)
        assert bare(out[name]) == bare(html)


HUB = '<a href="https://refhub.x.org/1">{}</a>'
WEB = '<a href="https://x.org/data/file">{}</a>'
MAIL = '<a class="m" href="mailto:{}">{}</a>'
RUNS = {
    "hub": (HUB.format("Smith") + " et al. " + HUB.format("19<i>9</i>9") + " and " + HUB.format("x"), '<a href="https://refhub.x.org/1">Smith et al. 19<i>9</i>9 and x</a>'),
    "hub words": (HUB.format("accu") + " r" + HUB.format("acy"), None),
    "no letters": (HUB.format("a") + ", " + HUB.format("b"), None),
    "markup between": (HUB.format("a") + "<b>or</b>" + HUB.format("b"), None),
    "other target": (HUB.format("a") + " or " + HUB.format("b").replace("/1", "/2"), None),
    "long text": (HUB.format("a") + " or" * 120 + HUB.format("b"), None),
    "web": (WEB.format("https://x.org/da") + "\n" + WEB.format("ta/file"), '<a href="https://x.org/data/file">https://x.org/data/file</a>'),
    "web words": (WEB.format("Online supple") + " " + WEB.format("mental table"), WEB.format("Online supplemental table")),
    "web strange": (WEB.format("one") + " " + WEB.format("two"), None),
    "web doi": ('<a href="https://doi.org/10.1000/ab">10.1000/</a> <a href="https://doi.org/10.1000/ab">ab</a>', '<a href="https://doi.org/10.1000/ab">10.1000/ab</a>'),
    "three": (WEB.format("https://x.org/") + " " + WEB.format("data/") + " " + WEB.format("file"), '<a href="https://x.org/data/file" target="_blank" rel="noopener noreferrer">https://x.org/data/file</a>'),
    "mail": (MAIL.format("ann@x.org", "ann@") + " " + MAIL.format("Ann@x.org", "x.org."), '<a href="mailto:ann@x.org">ann@x.org</a>.'),
    "mail strange": (MAIL.format("ann@x.org", "bob@") + " " + MAIL.format("ann@x.org", "x.org"), None),
}


def test_runs_of_anchors(spark):
    docs = {name: f"<p>before {html} after</p>" for name, (html, _) in RUNS.items()} | {"null": None, "none": "<p>no anchor</p>"}
    out = got(link_repairs.merge_anchor_runs(frame(spark, docs), ["doc"], "html"))
    for name, (html, want) in RUNS.items():
        if name == "hub words":
            assert out[name] == f"<p>before {HUB.format('accuracy')} after</p>"
        else:
            assert out[name] == f"<p>before {want or html} after</p>", name
    assert out["null"] is None and out["none"] == docs["none"]


def test_merging_keeps_what_is_seen(spark):
    r = random.Random(3)
    piece = lambda: r.choice([HUB.format(r.choice(["Smith", "in <b>b</b>", "1999"])), HUB.format("q").replace("/1", "/2"), " and then ", ", ", "<i>x</i>", "\n"])
    docs = {f"d{i}": "".join(piece() for _ in range(r.randint(1, 30))) for i in range(40)}
    once = link_repairs.merge_anchor_runs(frame(spark, docs), ["doc"], "html")
    out = got(once)
    shown = lambda t: re.sub("<[^>]+>", "", t)
    assert all(shown(out[d]) == shown(docs[d]) for d in docs)
    assert any(out[d].count("<a") < docs[d].count("<a") for d in docs)
    assert got(link_repairs.merge_anchor_runs(once, ["doc"], "html")) == out


LINKS = [
    ("see https://x.org/q. Then", ["https://x.org/q"]),
    ("(www.x.org/a(b)).", ["www.x.org/a(b)"]),
    ("doi: 10.1000/abc, and", ["10.1000/abc"]),
    ("DOI 10.1000/abc; 10.1001/d[1]", ["10.1000/abc", "10.1001/d"]),
    ("https://doi.org/10.1000/abc", ["https://doi.org/10.1000/abc"]),
    ("https://x.org/a/ b", ["https://x.org/a/b"]),
    ("https://arxi v.org/abs/1", ["https://arxiv.org/abs/1"]),
    ("at https://x.org/a/and more", ["https://x.org/a/"]),
    ("10.1000/ abc", ["10.1000/abc"]),
    ("https://x.org,doi:10.1000/5", ["https://x.org,doi", "10.1000/5"]),
    ("no links at all", []),
    ("version 10.2 of it", []),
]


@pytest.mark.parametrize(("text", "labels"), LINKS)
def test_links_in_text(text, labels):
    once = urls.linked(text)
    assert re.findall("<a [^>]*>(.*?)</a>", once) == labels
    assert urls.linked(once) == once


def test_no_link_in_a_link(spark):
    html = '<a href="u">https://x.org</a><code>www.x.org</code><pre>a<b>https://x.org</b></pre>https://y.org<script>"https://z.org"</script><br/>&lt;a href https://q.org'
    want = html.replace(">https://y.org<", '><a href="https://y.org" target="_blank" rel="noopener noreferrer">https://y.org</a><')
    out = got(frame(spark, {"a": html, "b": None, "long": "x " * 60_000 + "www.x.org"}).withColumn("html", link_repairs.autolinked("html")))
    assert out["a"] == want and out["b"] is None and out["long"].endswith(">www.x.org</a>")


def test_mended_urls():
    for broken, whole in (("htps://x.org/ a", "https://x.org/a"), ("http: // x.org", "http://x.org"), ("https://www. x.org/a", "https://www.x.org/a"), ("https://x.org /a", "https://x.org/a"), ("10. 1000/ abc", "10.1000/abc"), ("https://x.org/a.pdfpdf", "https://x.org/a.pdf"), ("https://https://x.org", "https://x.org"), ("plain words", "plain words")):
        assert urls.mended(broken) == whole
    assert urls.apart("x(a)).,") == ("x(a)", ").,") and urls.apart("...") == ("", "...")
    assert urls.same(urls.compare_key("HTTPS://X.org/a-b/"), urls.compare_key("x.org/ab"))


def test_broken_links_are_unwrapped(spark):
    docs = {
        "some": '<p id="a b">1</p><a href="#a%20b">in</a> <a class="x" href="#none">o<b>u</b>t</a> <a name="m">m</a><a href="#m">n</a><a href="https://x.org#none">away</a>',
        "hidden": '<!-- <i id="z"> --><a href="#z">z</a><!-- <a href="#q">q</a> -->',
        "null": None,
        "empty": "",
    }
    rows = {r["doc"]: (r["html"], r["unwrapped_links"]) for r in link_repairs.unwrap_broken_links(frame(spark, docs), ["doc"], "html").collect()}
    assert rows["some"] == (docs["some"].replace('<a class="x" href="#none">o<b>u</b>t</a>', "o<b>u</b>t"), 1)
    assert rows["hidden"] == ('<!-- <i id="z"> -->z<!-- <a href="#q">q</a> -->', 1)
    assert rows["null"] == (None, 0) and rows["empty"] == ("", 0)


def test_broken_links_without_joins(spark):
    """Documents are settled each by itself: no shuffle, and Arrow's batches, which may hold thousands of whole documents, aren't used."""
    rows = [(f"d{i}", f'<p id="a">1</p><a href="#a">in</a><a href="#b{i}" xlink:href="#c">out</a><svg><use href="#none"/></svg>') for i in range(3)]
    out = link_repairs.unwrap_broken_links(spark.createDataFrame(rows, "doc string, html string"), ["doc"], "html")
    assert {(r["doc"], r["html"], r["unwrapped_links"]) for r in out.collect()} == {(d, '<p id="a">1</p><a href="#a">in</a>out<svg><use href="#none"/></svg>', 2) for d, _ in rows}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "Arrow" not in plan and "Join" not in plan and "Exchange" not in plan


def test_runs_without_repeated_texts(spark):
    """Runs of each kind side by side, found without joins, windows or Arrow's batches of whole documents."""
    hub, web = [HUB.format("a"), HUB.format("b")], [WEB.format("https://x.org/da"), WEB.format("ta/file")]
    html = "".join([hub[0], " or ", hub[1], " ", web[0], " ", web[1], "\n", MAIL.format("ann@x.org", "ann@"), " ", MAIL.format("Ann@x.org", "x.org")])
    df = spark.createDataFrame([(1, html), (2, None), (3, "<a>a</a> <a>b</a>")], "doc int, html string")
    runs = link_repairs.anchor_runs(df, ["doc"], "html")
    assert [(r["doc"], r["kind"], ["".join(html[p["start"] : p["body_start"]] for p in r["parts"][:1]), len(r["parts"])]) for r in runs.collect()] == [(1, "hub", [HUB[:-6], 2]), (1, "web", [WEB[:-6], 2]), (1, "mail", ['<a class="m" href="mailto:ann@x.org">', 2])]
    assert [r["kind"] for r in link_repairs.anchor_runs(df, ["doc"], "html", ("web",)).collect()] == ["web"]
    plan = link_repairs.merge_anchor_runs(df, ["doc"], "html")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and not any(x in plan for x in ("Arrow", "Join", "Window", "Exchange"))
