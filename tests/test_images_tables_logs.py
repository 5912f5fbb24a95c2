"""Embedded images, table headers, maps of paths, appended logs."""

import base64
import json
import struct
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagewright.functions import images, tables
from pagewright.operators import images as image_rows
from pagewright.operators import table_repairs
from pagewright.sources import path_map, shared
from pagewright.streaming import append_log

PNG = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 40) + b"\x08\x02\0\0\0" + b"\0\0\0\0IEND\xaeB`\x82"
JPEG = b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xff\xc2" + struct.pack(">HBHHB", 11, 8, 30, 600, 1) + b"\0\0\0" + b"\xff\xd9"
GIF = b"GIF89a" + b"\0" * 9 + b";"
WEBP = b"RIFF" + struct.pack("<I", 20) + b"WEBPVP8 "


def url(data, mime):
    return f"data:{mime};base64,{base64.b64encode(data).decode()}"


def test_formats():
    for data, mime, size in ((PNG, "image/png", (640, 40)), (JPEG, "image/jpeg", (600, 30)), (GIF, "image/gif", None), (WEBP, "image/webp", None)):
        assert images.renderable(url(data, mime)) and images.payload(url(data, mime)) == (mime, data)
        assert images.payload(base64.b64encode(data).decode()) == (mime, data)
        assert images.pixel_size(data) == size
        if mime != "image/webp":  # its end says nothing
            assert not images.renderable(url(data[:-2], mime))
    assert images.renderable(url(b"\xef\xbb\xbf <svg/>", "image/svg+xml")) and images.renderable("data:image/svg+xml,%3csvg") and not images.renderable("data:image/png,abc")
    assert images.is_page_strip(640, 40) and not images.is_page_strip(640, 97) and not images.is_page_strip(499, 10)


def test_broken_data_does_no_harm():
    for src in ("data:image/png;base64,", "data:image/png;base64,A", "data:image/png;base64,AAA=AAA", "data:image/png;base64,é", "data:image/png"):
        assert images.state(src) == "broken"
    for n in range(len(JPEG)):
        images.pixel_size(JPEG[:n])
        images.pixel_size(PNG[:n])
    assert images.pixel_size(b"") is None and images.pixel_size(None) is None
    assert [images.state(s) for s in ("", "a.png", "HTTPS://x", url(PNG, "image/png"))] == ["missing", "unsupported", "remote", "embedded"]


def test_integrity_of_documents(spark):
    html = f'<img src="{url(PNG, "image/png")}"><!-- <img> --><IMG data-z2m-inline-skip><img src="data:image/gif;base64,AAAA"/><img src="x.png" data-z2m-inline-skip="1">'
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    got = [tuple(r) for r in image_rows.integrity(df, ["id"], "html").orderBy("id").collect()]
    assert got == [(1, 4, 1, 1, 1, 2), (2, 0, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0)]
    assert [(r["n"], r["width"], r["strip"]) for r in image_rows.inline_images(df, "html").where("width IS NOT NULL").collect()] == [(0, 640, True)]


def row(*cells, tag="th"):
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


CLEAN = row("Study", "Year of publication", "Mean age") + row("Author name", "of it", "in months")
BROKEN = row("Study", "Year of", "publi", "cation", "Mean", "age") + row("Author name", "of", "it", "in", "mon", "ths")
DATA = row("P1", 1, 2, 3, tag="td")


def test_headers_by_hand(spark):
    whole, broken = f"<table>{CLEAN}{DATA}{CLEAN}{DATA}</table>", f"<table>{CLEAN}{DATA}{BROKEN}{DATA}</table>"
    other = broken.replace("Author name</th><th>of</th>", "Town hall</th><th>of</th>")
    own = f"<table>{row('Study', 'a b', 'c')}{row('Region', 'x', 'y')}{row('Kind', 'm', 'n')}{DATA}{row('Study', 'a', 'b', 'c', 'x', 'y', 'z')}{row('Country', 'x', 'y')}{row('Kind', 'm', 'n')}{DATA}</table>"
    few = f"<table>{CLEAN}{row('Study', 'Year', 'of', 'publication')}</table>"
    assert tables.mended(broken) == whole and tables.mended(whole) == whole
    assert tables.mended(other) == other and tables.mended(few) == few
    # a label of its own stays in a header that takes the form of the first
    assert tables.mended(own) == own.replace(row("Study", "a", "b", "c", "x", "y", "z"), row("Study", "a b", "c"))
    df = spark.createDataFrame([("a", broken), ("b", None), ("c", "no table")], "id string, html string")
    assert [r[0] for r in df.select(table_repairs.mended_headers("html")).collect()] == [whole, None, "no table"]


@pytest.mark.parametrize(("joined", "whole", "fits"), [("yearofpublication", "yearofpublication", True), ("yearofpubl1cation", "yearofpublication", True), ("yearofxxxxxcation", "yearofpublication", False), ("yearofpublicationandmore", "yearofpublication", False), ("publicat", "yearofpublication", False)])
def test_how_like_pieces_have_to_be(joined, whole, fits):
    line = tables.Line(row(joined[:5], joined[5:]))
    assert (tables.phrase_at(line.cells, {whole: "Year of publication"}) is not None) is fits


def test_phrases_span_their_columns():
    line = tables.Line('<tr><th colspan="2">Year of</th><th>publication</th><td>5</td></tr>')
    assert tables.with_phrases(line, {"yearofpublication": "Year of <publication>"}) == '<tr><th colspan="3"> Year of &lt;publication&gt; </th><td>5</td></tr>'


def test_path_maps(spark):
    files = {
        "by article": '{"a1": "p1", "a2": {"source_pdf_path": "p2"}, "a3": {"matches": [{"path": "p3"}]}, "a4": 5, "a5": ""}',
        "under a name": '{"articles": [{"article": "b1", "path": "q1"}, {"article": "", "path": "x"}, {"path": "y"}, 7, {"article": "b2", "fuzzy_matches": [[], ["q2"]]}]}',
        "bare": '[{"article": "c1", "pdf_path": "r1", "exact_matches": ["x"]}]',
        "broken": '{"d1": ',
        "nothing": "[]",
    }
    df = spark.createDataFrame([(t,) for t in files.values()], "text string")
    got = {r["article"]: r["path"] for r in path_map.read_map(df, "text").collect()}
    assert got == {"a1": "p1", "a2": "p2", "a3": "p3", "b1": "q1", "b2": "q2", "c1": "r1"}
    twice = spark.createDataFrame([('[{"article": "a", "path": "1"}, {"article": "a", "path": "2"}]',)], "text string")
    with pytest.raises(Exception, match="duplicate article"):
        path_map.read_map(twice, "text").collect()


def test_a_log_forgives_a_cut_end_only(spark):
    path = tempfile.mkdtemp(prefix="pagewright-test-")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string").repartition(1).sortWithinPartitions("id")
    append_log.append(df, path, 0)
    append_log.append(df, path, 1)
    append_log.append(df.where("id = 2"), path, 1)  # a batch that is tried again is there once
    read = lambda: append_log.read(spark, path, "id int, name string")
    assert sorted((r["batch"], r["line"], r["id"], r["name"]) for r in read().collect()) == [(0, 1, 1, "a"), (0, 2, 2, None), (1, 1, 2, None)]
    spark.createDataFrame([('{"id": 9, "name": "z"}\n\n{"id": 10, "na',)], "value string").coalesce(1).write.option("lineSep", " ").mode("overwrite").text(f"{path}/batch=2")
    # the writer's own separator ends the file, so the cut line is last without a line break
    assert [(r["line"], r["id"]) for r in read().where("batch = 2").collect()] == [(1, 9)]
    assert append_log.last_entry(read(), []).first()["id"] == 9
    spark.createDataFrame([("[1]\n",)], "value string").coalesce(1).write.text(f"{path}/batch=3")
    with pytest.raises(Exception, match="no object in line 1"):
        read().collect()


def test_a_stream_appends_what_a_batch_does(spark):
    base = tempfile.mkdtemp(prefix="pagewright-test-")
    source, path, mark = f"{base}/in", f"{base}/log", f"{base}/mark"
    first, second = (spark.range(a, b).select("id", (F.col("id") % 3).alias("kind")) for a, b in ((0, 20), (20, 50)))
    first.coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(source)
    append_log.append_stream(stream(), path, mark)
    second.coalesce(2).write.mode("append").parquet(source)
    append_log.append_stream(stream(), path, mark)
    append_log.append_stream(stream(), path, mark)  # a restart with nothing new
    got = append_log.read(spark, path, "id long, kind long")
    assert sorted((r["id"], r["kind"]) for r in got.collect()) == [(i, i % 3) for i in range(50)]
    assert got.select("batch").distinct().count() == 3


def test_shared_folder(spark):
    assert shared.shared_path(spark, "x") != shared.shared_path(spark, "x")
    assert json.dumps(shared.shared_path(spark, "tag")).count("/tag-") == 1


def test_long_files_of_a_log_are_read_by_lines(spark):
    """A file of several blocks, with blank lines, all kinds of line ends and a cut end: numbered through; no row holds the whole file."""
    path, n = tempfile.mkdtemp(prefix="pagewright-test-"), 30_000
    ends = ["\n", "\r\n", "\r", "\n\n"]
    text = "".join(f'{{"id": {i}, "name": "é"}}' + ends[i % 4] for i in range(n))
    at = [line for i in range(n) for line in ([i] if i % 4 < 3 else [i, None])]
    Path(f"{path}/batch=0").mkdir()
    Path(f"{path}/batch=0/part-0.txt").write_bytes((text + '{"id": 1, "na').encode())
    Path(f"{path}/batch=1").mkdir()
    Path(f"{path}/batch=1/part-0.txt").write_bytes('{"id": 7, "name": "é"}'.encode()[:-3])
    block = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000b")
    try:
        got = append_log.read(spark, path, "id int, name string").select("batch", "line", "id").collect()
        cut = append_log.lines(spark, path).where("last").select("batch", "line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    assert sorted((r["line"], r["id"]) for r in got) == [(k + 1, i) for k, i in enumerate(at) if i is not None]
    assert sorted(map(tuple, cut)) == [(0, len(at) + 1), (1, 1)] and {r["batch"] for r in got} == {0}


def test_tables_of_a_small_file_are_mended_by_several_tasks(spark):
    """A file too small to be split has many tables; likeness with its bounds is that of the whole comparison."""
    from difflib import SequenceMatcher

    from pagewright.plans import repair_queries

    assert repair_queries.mended_table_headers(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4
    for a, b in (("yearofpublication", "yearofpublcation"), ("meanage", "yearof"), ("", "a"), ("abcd", "dcba")):
        ratio = SequenceMatcher(None, a, b).ratio()
        assert tables.alike(a, b, 0.5) == (ratio if ratio >= 0.5 else 0)
