"""Queries over repairs of targets, links and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import images, link_repairs, table_repairs
from pagewright.sources import path_map, shared
from pagewright.streaming import append_log

from .registry import dealt, query, table

#: Pages whose paragraphs all have one id, to which all their links lead.
_SAME_IDS = "regexp_replace(regexp_replace(html, '<p>', '<p id=\"p\">', 'g'), '<a href=\"[^\"]*\">', '<a href=\"#p\">', 'g')"
_MARKS = "'<p id=\"p\">|<a href=\"#p\">'"


@query(f"""
    WITH h AS (SELECT page_id, {_SAME_IDS} AS html FROM pages),
         s AS (SELECT page_id, html, regexp_extract_all(html, {_MARKS}) AS marks, string_split_regex(html, {_MARKS}) AS pieces FROM h),
         m AS (SELECT page_id, i, marks[i] AS mark, pieces[i] AS piece, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(marks[1:i - 1], lambda x: length(x))), 0) AS pos FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS i FROM s)),
         p AS (SELECT page_id, i, pos, row_number() OVER (PARTITION BY page_id ORDER BY i) AS nth FROM m WHERE mark LIKE '<p%'),
         a AS (SELECT m.page_id, m.i, arg_min(p.nth, struct_pack(d := abs(p.pos - m.pos), l := p.pos < m.pos)) AS nth FROM m JOIN p ON m.page_id = p.page_id WHERE mark LIKE '<a%' GROUP BY m.page_id, m.i),
         r AS (SELECT m.page_id, m.i, piece || coalesce(CASE WHEN p.nth > 1 THEN '<p id="p--z2m-d' || p.nth || '">' WHEN a.nth > 1 THEN '<a href="#p--z2m-d' || a.nth || '">' ELSE mark END, '') AS part, p.nth AS p, a.nth AS a
               FROM m LEFT JOIN p ON m.page_id = p.page_id AND m.i = p.i LEFT JOIN a ON m.page_id = a.page_id AND m.i = a.i)
    SELECT page_id, (count(p) > 1)::BIGINT AS duplicate_targets, greatest(count(p) - 1, 0) AS renamed_targets, count(*) FILTER (a > 1) AS rewritten_references, md5(string_agg(part, '' ORDER BY i)) AS html_md5 FROM r GROUP BY page_id""")
def unique_page_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose paragraphs share an id: every paragraph gets one of its own, every link the nearest."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.regexp_replace("html", "<p>", '<p id="p">'), '<a href="[^"]*">', '<a href="#p">').alias("html"))
    found = link_repairs.unique_targets(pages, ["page_id"], "html")
    return found.select("page_id", "duplicate_targets", "renamed_targets", "rewritten_references", F.md5(F.encode("html", "UTF-8")).alias("html_md5"))


_SPLIT = """SELECT page_id, '<p>See <a class="c" href="https://refhub.example.org/' || page_id % 7 || '">Smith</a> and <a class="c" href="https://refhub.example.org/' || (page_id + page_id % 3) % 7 || '">others</a>, '
    || '<a href="' || u || '">' || substr(u, 1, 14) || '</a> <a href="' || u || '">' || substr(u, 15) || '</a>.</p>' || html AS html, u FROM (SELECT page_id, html, 'https://host' || page_id || '.example.org/a' || page_id % 11 AS u FROM pages)"""


@query(f"""SELECT page_id, md5('<p>See <a class="c" href="https://refhub.example.org/' || page_id % 7 || '">Smith' || CASE WHEN page_id % 3 = 0 THEN '' ELSE '</a>' END || ' and ' || CASE WHEN page_id % 3 = 0 THEN '' ELSE '<a class="c" href="https://refhub.example.org/' || (page_id + page_id % 3) % 7 || '">' END
    || 'others</a>, <a href="' || u || '">' || u || '</a>.</p>' || html) AS html_md5 FROM (SELECT page_id, html, 'https://host' || page_id || '.example.org/a' || page_id % 11 AS u FROM pages)""")
def merged_page_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that begin with split anchors: those with one target are one again."""
    n = lambda c: c.cast("string")
    i = F.col("page_id")
    u = F.concat(F.lit("https://host"), n(i), F.lit(".example.org/a"), n(i % 11))
    hub = lambda k: F.concat(F.lit('<a class="c" href="https://refhub.example.org/'), n(k), F.lit('">'))
    web = lambda label: F.concat(F.lit('<a href="'), u, F.lit('">'), label, F.lit("</a>"))
    split = F.concat(F.lit("<p>See "), hub(i % 7), F.lit("Smith</a> and "), hub((i + i % 3) % 7), F.lit("others</a>, "), web(F.substring(u, 1, 14)), F.lit(" "), web(F.substring(u, 15, 1000)), F.lit(".</p>"), F.col("html"))
    found = link_repairs.merge_anchor_runs(dealt(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").withColumn("html", split), ["page_id"], "html")
    return found.select("page_id", F.md5(F.encode("html", "UTF-8")).alias("html_md5"))


@query("""SELECT page_id, md5('<p>At <a href="' || url || '" target="_blank" rel="noopener noreferrer">' || url || '</a>, doi:<a href="https://doi.org/10.1000/x' || page_id || '" target="_blank" rel="noopener noreferrer">10.1000/x' || page_id || '</a>. <a href="u">www.example.org</a></p>'
    || regexp_replace(html, '&copy; (www[.][a-z.-]+) ', '&copy; <a href="https://\\1" target="_blank" rel="noopener noreferrer">\\1</a> ', 'g')) AS html_md5 FROM pages""")
def autolinked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that begin with their own address and a DOI as plain text."""
    text = F.concat(F.lit("<p>At "), F.col("url"), F.lit(", doi: 10.1000/x"), F.col("page_id").cast("string"), F.lit('. <a href="u">www.example.org</a></p>'), F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(F.encode(link_repairs.autolinked(text), "UTF-8")).alias("html_md5"))


_LOCAL = "regexp_replace(replace(html, '<h1>', '<h1 id=\"to\">'), '<a href=\"/', '<a href=\"#', 'g')"


@query(f"""WITH h AS (SELECT page_id, {_LOCAL} AS html FROM pages)
    SELECT page_id, len(regexp_extract_all(html, '<a href="#[^"]+">[^<]*</a>')) - len(regexp_extract_all(html, '<a href="#to">')) AS unwrapped_links,
           md5(replace(regexp_replace(replace(html, '<a href="#to">', '<A href="#to">'), '<a href="#[^"]+">([^<]*)</a>', '\\1', 'g'), '<A href="#to">', '<a href="#to">')) AS html_md5 FROM h""")
def unwrapped_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose links are local, and of whose targets one alone is there."""
    local = F.replace(F.replace("html", F.lit("<h1>"), F.lit('<h1 id="to">')), F.lit('<a href="/'), F.lit('<a href="#'))
    found = link_repairs.unwrap_broken_links(dealt(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").withColumn("html", local), ["page_id"], "html")
    return found.select("page_id", "unwrapped_links", F.md5(F.encode("html", "UTF-8")).alias("html_md5"))


# --- tables and images ---------------------------------------------------------------------------------------

_CLEAN = "<tr><th>Study</th><th>Year of publication</th><th>Mean age</th></tr><tr><th>Author name</th><th>of it</th><th>in months</th></tr>"
_BROKEN = "<tr><th>Study</th><th>Year of</th><th>publi</th><th>cation</th><th>Mean</th><th>age</th></tr><tr><th>{0}</th><th>of</th><th>it</th><th>in</th><th>mon</th><th>ths</th></tr>"
_DATA = "<tr><td>P{0}</td><td>1</td><td>2</td><td>{1}</td></tr>"


@query(f"""
    WITH p AS (SELECT p_partkey, '{_DATA.replace("{0}", "' || p_partkey || '").replace("{1}", "' || p_size || '")}' AS data, '{_CLEAN}' AS clean, '{_BROKEN.replace("{0}", "' || CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'Author name' END || '")}' AS broken FROM part)
    SELECT p_partkey, md5('<table>' || clean || data || CASE WHEN p_partkey % 3 = 0 THEN broken ELSE clean END || data || '</table>') AS html_md5 FROM p""")
def mended_table_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of parts whose second header is in pieces; where its last label is another, it is another header and stays."""
    put = lambda text, *values: _put(F.lit(text), values)
    n = lambda c: F.col(c).cast("string")
    data = put(_DATA, n("p_partkey"), n("p_size"))
    broken = put(_BROKEN, F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise("Author name"))
    html = F.concat(F.lit(f"<table>{_CLEAN}"), data, broken, data, F.lit("</table>"))
    # a small file of many rows would be one task's
    parts = table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return parts.select("p_partkey", F.md5(F.encode(table_repairs.mended_headers(html), "UTF-8")).alias("html_md5"))


def _put(text, values):
    for i, v in enumerate(values):
        text = F.replace(text, F.lit(f"{{{i}}}"), v)
    return text


@query("""
    SELECT page_id, 5 AS image_count, 1 AS missing_count, 1 AS unsupported_count, (page_id % 2 + 1)::BIGINT AS broken_count, (1 + page_id % 2)::BIGINT AS skipped_count, 1 + page_id % 600 AS width, 1 + page_id % 90 AS height, (1 + page_id % 600 >= 500 AND 1 + page_id % 90 <= 96 AND (1 + page_id % 600)::DOUBLE / (1 + page_id % 90) >= 8)::BIGINT AS strips FROM pages WHERE page_id % 2 = 0
    UNION ALL SELECT page_id, 5, 1, 1, 2, 2, NULL, NULL, 0 FROM pages WHERE page_id % 2 = 1""")
def inline_image_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with five images: a PNG of a size that the page's number gives (cut off on odd pages), a broken one, and three others."""
    number = lambda n: F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0"))
    raw = lambda text: F.unhex(F.lit(text))
    size = [1 + F.col("page_id") % 600, 1 + F.col("page_id") % 90]
    png = F.concat(raw("89504E470D0A1A0A0000000D49484452"), number(size[0]), number(size[1]), raw("0802000000"), F.unhex(F.when(F.col("page_id") % 2 == 0, "0000000049454E44AE426082").otherwise("00000000")))
    shown = F.concat(F.lit('<img src="data:image/png;base64,'), F.base64(png), F.when(F.col("page_id") % 2 == 1, F.lit('" data-z2m-inline-skip>')).otherwise(F.lit('">')))
    more = F.lit('<img src="data:image/jpeg;base64,!!" data-z2m-inline-skip="x"><img alt="none"><img src="a/b.png"><IMG SRC=\'https://x.org/a.png\'>')
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(shown, more, "html").alias("html"))
    found = images.inline_images(pages, "html").groupBy("page_id")
    fault = F.col("state").isin("missing", "unsupported", "broken")
    count = lambda c: F.count(F.when(c, 1))
    counts = [count(F.col("state") == s).alias(f"{s}_count") for s in ("missing", "unsupported", "broken")]
    whole = F.col("state") == "embedded"
    return found.agg(F.count("*").alias("image_count"), *counts, count(fault & F.col("skipped")).alias("skipped_count"), F.max(F.when(whole, F.col("width"))).alias("width"), F.max(F.when(whole, F.col("height"))).alias("height"), count(whole & F.col("strip")).alias("strips"))


# --- sources and logs ----------------------------------------------------------------------------------------


@query("""SELECT doc_id::VARCHAR AS article, CASE doc_id % 7 WHEN 0 THEN 'p' || doc_id WHEN 1 THEN 'q' || doc_id WHEN 2 THEN source || '.pdf' WHEN 3 THEN 'e' || doc_id WHEN 4 THEN 'f' || doc_id WHEN 5 THEN 'deep' || doc_id END AS path FROM documents WHERE doc_id % 7 != 6""")
def source_path_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths from records of seven shapes, one for each document."""
    i = F.col("doc_id").cast("string")
    shapes = [
        F.concat(F.lit('"p'), i, F.lit('"')),
        F.concat(F.lit('{"path": "no", "source_pdf_path": "q'), i, F.lit('", "pdf_path": ""}')),
        F.concat(F.lit('{"pdf_path": 5, "path": "'), F.col("source"), F.lit('.pdf"}')),
        F.concat(F.lit('{"fuzzy_matches": ["f"], "exact_matches": ["", {"path": "e'), i, F.lit('"}, "z"]}')),
        F.concat(F.lit('{"matches": ["z"], "fuzzy_matches": [{"score": 1}, "f'), i, F.lit('"], "exact_matches": []}')),
        F.concat(F.lit('{"matches": [[], [[{"pdf_path": "deep'), i, F.lit('"}]], "z"]}')),
        F.lit('{"exact_matches": null, "size": 3}'),
    ]
    text = F.element_at(F.array(*shapes), (F.col("doc_id") % 7).cast("int") + 1)
    records = table(spark, sf_dir, "documents").select(i.alias("article"), F.parse_json(text).alias("record"))
    return path_map.record_paths(records, "article", "record")


@query("""SELECT user_id, event_id, event_type, entries FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, ts DESC) AS n, count(*) OVER (PARTITION BY user_id) AS entries FROM events) WHERE n = 1""")
def appended_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a log by their numbers in four batches, one of them tried twice, and each user's last entry read back."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    last = events.agg(F.max("event_id").alias("n")).first()["n"] or 0
    path = shared.shared_path(spark, "history")
    for number in range(4):
        part = F.floor(F.col("event_id") * 4 / (last + 1))
        batch = events.where(F.least(part, F.lit(3)) == number).repartitionByRange("event_id").sortWithinPartitions("event_id")
        for _ in range(1 + (number == 2)):
            append_log.append(batch, path, number)
    entries = append_log.read(spark, path, "user_id long, event_id long, event_type string")
    return append_log.last_entry(entries, ["user_id"]).select("user_id", "event_id", "event_type", "entries")
