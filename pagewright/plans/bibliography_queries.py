"""Queries over bibliographies and citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import bibliography, citation_audit, frontmatter

from .registry import dealt, query, table


@query()
def bibliography_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries in the lines of documents, six lines to a page.

    Lines are numbered as bibliographies are, some with their numbers alone on
    the line before; every third document has a heading. The fold over lines
    has no SQL; tests hold it against brute force.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    numbered = F.transform(
        lines,
        lambda line, i: F.when((i == 1) & (F.col("doc_id") % 3 == 0), F.concat(F.lit("References\n"), line))
        .when(i % 3 == 0, F.concat((i / 3).cast("int") + 1, F.lit(". "), line))
        .when((i % 3 == 2) & (F.col("doc_id") % 5 == 0), F.concat((i / 3).cast("int") + 2, F.lit("\n"), line))
        .otherwise(line),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", numbered.alias("lines"))
    at = F.posexplode(F.transform(F.sequence(F.lit(0), ((F.size("lines") - 1) / 6).cast("int")), lambda k: F.array_join(F.slice("lines", k * 6 + 1, F.lit(6)), "\n")))
    pages = docs.select("doc_id", at.alias("page", "text")).withColumn("page", F.col("page") + 1)
    return bibliography.entries(pages, ["doc_id"], "page", "text")


_STARTS = "SELECT l_suppkey AS page, floor(l_extendedprice / 1000)::BIGINT AS number, (l_partkey % 40) * 7.0::DOUBLE AS x, l_extendedprice AS y FROM lineitem"


@query(f"""
    WITH RECURSIVE s AS (SELECT page, number, x::DOUBLE AS x, y FROM ({_STARTS})),
         p AS (SELECT page FROM s GROUP BY page HAVING count(*) >= 4 OR max(number) >= 20),
         seed AS (SELECT page, min(x) AS x, 1 AS k FROM s JOIN p USING (page) GROUP BY page
                  UNION ALL SELECT page, x, k FROM (SELECT seed.page, min(s.x) AS x, any_value(k) + 1 AS k FROM seed JOIN s ON s.page = seed.page AND s.x > seed.x + 24 GROUP BY seed.page)),
         c AS (SELECT s.page, s.number, s.x, s.y, max(seed.k) AS "column" FROM (SELECT row_number() OVER () AS r, * FROM s) s JOIN seed ON seed.page = s.page AND seed.x <= s.x GROUP BY s.r, s.page, s.number, s.x, s.y),
         n AS (SELECT *, row_number() OVER w AS place, CASE WHEN number - lag(number) OVER w IN (1, 2) THEN 0 ELSE 1 END AS first FROM c WINDOW w AS (PARTITION BY page, "column" ORDER BY y, number, x)),
         r AS (SELECT *, sum(first) OVER (PARTITION BY page, "column" ORDER BY place) AS run FROM n),
         z AS (SELECT *, count(*) OVER (PARTITION BY page, "column", run) AS size, max(number) OVER (PARTITION BY page, "column") AS high FROM r),
         b AS (SELECT *, first_value(run) OVER (PARTITION BY page, "column" ORDER BY size DESC, run) AS best, max(size) OVER (PARTITION BY page, "column") AS longest FROM z)
    SELECT page, "column"::INT AS "column", number, x, y FROM b WHERE (longest >= 4 AND run = best) OR (longest < 4 AND high >= 20)""")
def reference_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that follow each other down a column, from the places of line items."""
    items = table(spark, sf_dir, "lineitem")
    starts = items.select(F.col("l_suppkey").alias("page"), F.floor(F.col("l_extendedprice") / 1000).alias("number"), ((F.col("l_partkey") % 40) * 7.0).alias("x"), F.col("l_extendedprice").alias("y"))
    return bibliography.column_starts(dealt(starts, "page"), ["page"])


@query("""
    WITH l AS (SELECT l_orderkey * 10 + l_linenumber AS link, l_suppkey % 100 AS page, max(CASE WHEN l_linenumber = 7 THEN 0.0 ELSE (l_partkey % 50) * 7.0 + 3.0 END)::DOUBLE AS x, max(CASE WHEN l_quantity = 50 THEN 0.0 ELSE l_extendedprice / 100.0 - 5.0 END)::DOUBLE AS y FROM lineitem GROUP BY ALL),
         m AS (SELECT link, min(page) AS page, min(x) AS x, min(y) AS y FROM l GROUP BY link),
         s AS (SELECT o_custkey % 100 AS page, o_orderkey % 300 AS number, ((o_orderkey % 50) * 7.0)::DOUBLE AS sx, o_totalprice / 500.0 AS sy FROM orders),
         c AS (SELECT *, sy >= y - 16 AS below FROM m JOIN s USING (page) WHERE x = 0 OR abs(sx - x) <= 80),
         r AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY below DESC, abs(sy - y), greatest(0.0, sy - y), CASE WHEN x = 0 THEN 0.0 ELSE abs(sx - x) END, sx, sy, number) AS n FROM c)
    SELECT m.link, CASE WHEN m.y = 0 OR abs(r.sy - m.y) <= 40 THEN r.number END AS number FROM m LEFT JOIN r ON m.link = r.link AND r.n = 1""")
def located_reference_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of line items to the nearest start among orders, on the same page."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    link = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("link")
    x = F.when(F.col("l_linenumber") == 7, 0.0).otherwise((F.col("l_partkey") % 50) * 7.0 + 3.0)
    y = F.when(F.col("l_quantity") == 50, 0.0).otherwise(F.col("l_extendedprice") / 100.0 - 5.0)
    # dealt by link, so that both groupings share one shuffle
    placed = items.select(link, (F.col("l_suppkey") % 100).alias("page"), x.alias("x"), y.alias("y")).repartition("link")
    links = placed.groupBy("link", "page").agg(F.max("x").alias("x"), F.max("y").alias("y")).groupBy("link").agg(F.min("page").alias("page"), F.min("x").alias("x"), F.min("y").alias("y"))
    starts = orders.select((F.col("o_custkey") % 100).alias("page"), (F.col("o_orderkey") % 300).alias("number"), ((F.col("o_orderkey") % 50) * 7.0).alias("x"), (F.col("o_totalprice") / 500.0).alias("y"))
    return bibliography.located_targets(links, starts, "link")


#: A block for each remainder of a line item's part: its markup, what its range is, and which sign it bears. @1 and @2 are two numbers.
TEMPLATES: list[tuple[str, str, str]] = [
    ("<p>Prior studies [@1, @2] support the method.</p>", "body", ""),
    ("<p>The weights w [0, @2] were normalized.</p>", "", ""),
    ("<table><td>Author <sup>@1,@2</sup></td></table>", "float", ""),
    ("<p>The parameter values<sup>@1-@2</sup> matched.</p>", "math", ""),
    ("<p>Recordings were resumed at <sup>@1, @2</sup> and 7 days after.</p>", "", ""),
    ('<p>Seen in <a class="z2m-ref-link" href="#ref-@1">[@1, @2]</a> before.</p>', "", ""),
    ("<p>The Python version <sup>@1,@2</sup> was used.</p>", "", ""),
    ("<p>The serum held <sup>@1,@2</sup> μg/l.</p>", "", ""),
    ("<p>Much was shown \\(^{@1-@2}\\) since.</p>", "", "P28"),
    ("<p>They ended the task. Sec. @1 says how.</p>", "", "P32"),
    ("<p>Shown [<b>@1</b>-@2] before.</p>", "body", ""),
    ('<p class="z2m-footnote">Prior studies [@1, @2] support the note.</p>', "", ""),
]
_A, _B = "l_linenumber", "(l_linenumber + 1 + l_suppkey % 5)"


@query(f"""
    WITH b AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS n, l_partkey % {len(TEMPLATES)} AS t, [{_A}, {_B}]::BIGINT[] AS numbers FROM lineitem),
         k AS (SELECT *, {[k for _, k, _ in TEMPLATES]}[t + 1] AS kind, {[s for _, _, s in TEMPLATES]}[t + 1] AS sign, range(1, l_orderkey % 9 + 1) AS targets FROM b),
         f AS (SELECT * FROM k WHERE kind != '' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY list_position(['body', 'float', 'math'], kind), n) = 1),
         m AS (SELECT *, list_filter(numbers, lambda x: NOT list_contains(targets, x)) AS missing FROM f),
         d AS (SELECT l_orderkey, n, numbers, missing, CASE WHEN kind = 'body' THEN CASE WHEN len(targets) = 0 THEN 'P04N' WHEN len(missing) > 0 THEN 'P04R' ELSE 'P04' END
                 WHEN len(targets) > 0 AND len(missing) = len(numbers) THEN NULL WHEN kind = 'float' THEN 'P04T' ELSE 'P04M' END AS id FROM m)
    SELECT l_orderkey, id, CASE WHEN id = 'P04' THEN 'error' ELSE 'warning' END AS severity, n::INT AS n, array_to_string(numbers, ',') AS numbers, CASE WHEN id = 'P04R' THEN array_to_string(missing, ',') ELSE '' END AS missing FROM d WHERE id IS NOT NULL
    UNION ALL SELECT l_orderkey, sign, CASE WHEN sign = 'P28' THEN 'error' ELSE 'warning' END, min(n)::INT, '', '' FROM k WHERE sign != '' GROUP BY l_orderkey, sign""")
def citation_range_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges without links in articles: one per order, a block per line item, and as many references as the order's remainder by nine."""
    items = dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey")

    def markup(r: Column) -> Column:
        a, b = r["l_linenumber"].cast("string"), (r["l_linenumber"] + 1 + r["l_suppkey"] % 5).cast("string")
        return F.replace(F.replace(F.element_at(F.array(*[F.lit(t) for t, _, _ in TEMPLATES]), (r["l_partkey"] % len(TEMPLATES)).cast("int") + 1), F.lit("@1"), a), F.lit("@2"), b)

    body = items.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), markup), "\n").alias("body"))
    targets = F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.col("l_orderkey") % 9), lambda i: i > 0), lambda i: F.concat(F.lit('<li id="ref-'), i.cast("string"), F.lit('">An entry.</li>'))), "")
    articles = body.select("l_orderkey", F.concat("body", F.lit("\n<h2>References</h2><ol>"), targets, F.lit("</ol>")).alias("html"))
    found = citation_audit.document_defects(articles, ["l_orderkey"], "html")
    shown_list = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return found.select("l_orderkey", "id", "severity", "n", shown_list("numbers"), shown_list("missing"))


#: Blocks of an article for each remainder of a line item's part, and the defect that a block is by itself. Names and numbers are as damaged or as linked as the rule asks.
FRONT: list[tuple[str, str]] = [
    ("<p>Ann Lee @1 @2, Bob Ray @1</p>", "P01"),
    ('<p class="z2m-affiliations"><a href="#ref-@1">@1</a> Lab of it</p>', "P02"),
    ('<p>Cy Fox<a href="#ref-@1">@1</a> Di Moe<a href="#ref-@2">@2</a></p>', "P03"),
    ("<p>Ed Poe @1 @2 ClinicalTrials.gov</p>", ""),
    ("<p>© @1 The Authors.</p>", ""),
    ("<p>A plain paragraph ends.</p>", ""),
    ("<h2>A heading</h2>", ""),
]


@query(f"""
    WITH b AS (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS n, {[d for _, d in FRONT]}[l_partkey % {len(FRONT)} + 1] AS id FROM lineitem)
    SELECT l_suppkey, id, CASE id WHEN 'P01' THEN 'warning' ELSE 'error' END AS severity, min(n)::INT AS n FROM b WHERE (id = 'P01' AND n < 20) OR (id = 'P02' AND n < 25) OR (id = 'P03' AND n < 18) GROUP BY l_suppkey, id""")
def frontmatter_defect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter of one long article per supplier, a block for each line item; both stages are the same."""
    items = dealt(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"), "l_suppkey")

    def markup(r: Column) -> Column:
        a, b = r["l_linenumber"].cast("string"), (r["l_linenumber"] + 1).cast("string")
        return F.replace(F.replace(F.element_at(F.array(*[F.lit(t) for t, _ in FRONT]), (r["l_partkey"] % len(FRONT)).cast("int") + 1), F.lit("@1"), a), F.lit("@2"), b)

    blocks = F.transform(F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_partkey"))), markup)
    articles = items.groupBy("l_suppkey").agg(F.array_join(blocks, "\n").alias("html"))
    found = frontmatter.blocks(articles, "html")
    return frontmatter.frontmatter_defects(found, found, ["l_suppkey"])
