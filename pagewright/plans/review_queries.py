"""Queries over reviews and the languages of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import language
from pagewright.operators import reports, reviews

from .registry import query, table

_STATUS = ["patched", "unresolved", "source_visual_unavailable", "source_pdf_unavailable", "open", "asset_ready_patch_missed", ""]
_FIGURES = """
    r AS (SELECT l_partkey AS article, ['patched', 'unresolved', 'source_visual_unavailable', 'source_pdf_unavailable', 'open', 'asset_ready_patch_missed', ''][l_linenumber] AS status, 'F' || l_suppkey % 9 AS label, l_returnflag = 'R' AS ready, 'from_' || l_linestatus AS source FROM lineitem),
    u AS (SELECT DISTINCT p_partkey AS article, 'F' || (p_partkey + k) % 11 AS label FROM part, (SELECT unnest([0, 1]) AS k) WHERE p_size % 2 = 0),
    j AS (SELECT r.*, CASE WHEN status = 'source_pdf_unavailable' THEN 'no_source' WHEN status = 'source_visual_unavailable' OR u.label IS NOT NULL THEN 'no_visual' WHEN status IN ('unresolved', 'asset_ready_patch_missed') THEN 'open' ELSE 'rest' END AS state FROM r LEFT JOIN u ON r.article = u.article AND r.label = u.label),
    s AS (SELECT article, count(*) FILTER (state = 'rest' AND (ready OR status = 'patched')) AS patched, count(*) FILTER (state = 'no_visual') AS shown, count(*) FILTER (state = 'no_source') AS no_source, count(*) FILTER (state = 'open') AS unresolved FROM j GROUP BY article),
    n AS (SELECT u.article, count(*) AS unseen FROM u WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.article = u.article AND j.label = u.label AND j.state = 'no_visual') GROUP BY u.article),
    e AS (SELECT coalesce(s.article, n.article) AS article, coalesce(patched, 0) AS patched, coalesce(shown, 0) + coalesce(unseen, 0) AS no_visual, coalesce(no_source, 0) AS no_source, coalesce(unresolved, 0) AS unresolved FROM s FULL JOIN n ON s.article = n.article)"""


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    status = F.element_at(F.array(*[F.lit(s) for s in _STATUS]), F.col("l_linenumber"))
    label = lambda c: F.concat(F.lit("F"), c.cast("string")).alias("label")
    recoveries = items.select(F.col("l_partkey").alias("article"), status.alias("status"), F.lit(None).cast("string").alias("plan_status"), label(F.col("l_suppkey") % 9), F.when(F.col("l_returnflag") == "R", "ready").alias("asset_status"), F.concat(F.lit("from_"), F.col("l_linestatus")).alias("recovery_source"), F.lit(False).alias("terminal"))
    told = parts.where("p_size % 2 = 0").select(F.col("p_partkey").alias("article"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select("article", label((F.col("article") + F.col("k")) % 11))
    return reviews.figure_evidence(recoveries, told, "article")


@query(f"WITH {_FIGURES} SELECT article, patched, no_visual, no_source, unresolved FROM e")
def figure_recovery_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each part's figures: line items are recoveries, parts of even size lack visuals."""
    return _figures(spark, sf_dir).drop("sources")


@query(f"""
    WITH {_FIGURES},
         a AS (SELECT p.p_partkey AS article, p_partkey % 4 != 0 AS changed, ['regressions', 'unchanged', 'improvements', 'unchanged', 'new'][p_partkey % 5 + 1] AS bucket, p_partkey % 13 - 11 AS delta, p_partkey % 6 % 3 AS defects, (p_partkey % 6 = 4)::INT AS observed, (p_partkey % 17 = 4)::INT AS counted, (p_partkey % 19 = 3)::INT AS links, (p_partkey % 23 = 5)::INT AS images, p_partkey % 29 = 7 AS mixed, p_partkey % 3 AS restored,
                  coalesce(e.patched, 0) AS patched, coalesce(e.no_visual, 0) AS no_visual, coalesce(e.no_source, 0) AS no_source, CASE WHEN p_partkey % 2 = 0 THEN coalesce(e.unresolved, 0) ELSE 0 END AS unresolved FROM part p LEFT JOIN e ON p.p_partkey = e.article),
         g AS (SELECT *, list_filter([CASE WHEN links > 0 THEN 'broken_internal_links' END, CASE WHEN bucket = 'regressions' THEN 'comparison_regression' END, CASE WHEN delta > 0 THEN 'lower_is_better_metric_increase' END, CASE WHEN images > 0 THEN 'missing_local_images' END, CASE WHEN counted > 0 THEN 'non_ignored_quality_counted_audit_defects' END, CASE WHEN unresolved > 0 THEN 'p62_unresolved_without_terminal_status' END], lambda x: x IS NOT NULL) AS grave FROM a),
         l AS (SELECT *, CASE WHEN len(grave) > 0 THEN 'high' WHEN changed AND (defects > 0 OR observed > 0 OR mixed) THEN 'medium' WHEN changed AND bucket = 'unchanged' AND (restored > 0 OR patched + no_visual + no_source > 0) THEN 'auto_verified' ELSE 'low' END AS level FROM g)
    SELECT article, level, changed AND level IN ('auto_verified', 'low') AS automatic, CASE level WHEN 'high' THEN array_to_string(grave, ',')
        WHEN 'medium' THEN array_to_string(list_sort(list_filter([CASE WHEN mixed THEN 'mixed_citation_style_present' END, CASE WHEN observed > 0 THEN 'observed_non_quality_or_telemetry_defects' WHEN defects > 0 THEN 'ignored_defects_only' END], lambda x: x IS NOT NULL)), ',')
        WHEN 'auto_verified' THEN 'changed_without_quality_delta_explained' ELSE CASE WHEN changed AND bucket IN ('unchanged', 'improvements') THEN 'changed_without_quality_regression' ELSE 'unchanged_or_not_review_required' END END AS reasons FROM l""")
def weighed_review_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as articles, with all kinds of evidence: deltas, defects, links, images, styles, figures and repairs."""
    k = F.col("p_partkey")
    joined = table(spark, sf_dir, "part").join(_figures(spark, sf_dir).withColumnRenamed("article", "p_partkey"), "p_partkey", "left")
    flag = lambda n, r: (k % n == r).cast("int")
    bucket = F.element_at(F.array(*[F.lit(b) for b in ("regressions", "unchanged", "improvements", "unchanged", "new")]), (k % 5).cast("int") + 1)
    worse = reviews.worsened(F.create_map(F.lit("score"), (k % 13 - 11).cast("double"), F.lit("words"), F.lit(5.0)), ["score", "defects"])
    figures = F.struct("patched", "no_visual", "no_source")
    repairs = F.struct(F.lit(False).alias("patched"), F.array().cast("array<string>").alias("repair_ids"), F.lit(0).alias("errors"))
    sources = reviews.change_sources(k % 3, F.lit(0), figures, repairs)
    risk = reviews.review_risk(k % 4 != 0, bucket, worse, k % 6 % 3, flag(6, 4), flag(17, 4), flag(19, 3), flag(23, 5), k % 29 == 7, F.when(k % 2 == 0, F.col("unresolved")), sources)
    return joined.select(k.alias("article"), risk.alias("r")).select("article", "r.level", "r.automatic", F.array_join("r.reasons", ",").alias("reasons"))


@query("""
    WITH d AS (SELECT doc_id, ['English', ' EN-gb ', 'rus', 'de', 'zh-TW', 'auto', NULL, 'xx'][doc_id % 8 + 1] AS requested, ['en', 'ru', 'de', 'unknown', 'eng'][doc_id % 5 + 1] AS detected, (doc_id % 10) / 10.0::DOUBLE AS confidence FROM documents),
         n AS (SELECT *, CASE doc_id % 8 WHEN 5 THEN 'auto' WHEN 2 THEN 'ru' WHEN 3 THEN 'other' WHEN 4 THEN 'other' WHEN 7 THEN 'other' ELSE 'en' END AS code FROM d)
    SELECT doc_id, code AS requested, CASE WHEN code != 'auto' THEN code WHEN confidence < 0.75 OR detected = 'unknown' THEN 'en' WHEN detected IN ('en', 'eng') THEN 'en' WHEN detected = 'ru' THEN 'ru' ELSE 'other' END AS selected FROM n""")
def document_polish_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which language's rules a document gets, from what was asked for and what was found."""
    i = F.col("doc_id")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values)).cast("int") + 1)
    asked = language.requested_polish_language(pick(["English", " EN-gb ", "rus", "de", "zh-TW", "auto", None, "xx"]))
    selected = language.selected_polish_language(asked, pick(["en", "ru", "de", "unknown", "eng"]), i % 10 / 10)
    return table(spark, sf_dir, "documents").select("doc_id", asked.alias("requested"), selected.alias("selected"))


_RECORDS = """
    d AS (SELECT l_orderkey AS article, CASE WHEN l_linenumber = 7 THEN '' ELSE 'P' || l_partkey % 5 END AS id, ['error', 'warning', 'info', 'note'][l_suppkey % 4 + 1] AS severity, CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN l_partkey % 2 = 0 ELSE true END AS counted FROM lineitem),
    c AS (SELECT *, CASE WHEN id = '' THEN 'unknown' ELSE id END AS name FROM d WHERE counted IS NOT FALSE),
    n AS (SELECT article, name, count(*) AS n FROM c GROUP BY ALL),
    p AS (SELECT article, count(*) AS defects, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'info') AS infos, count(DISTINCT name) AS unique_ids, count(DISTINCT name) FILTER (name != 'unknown') AS named FROM c GROUP BY article),
    i AS (SELECT article, string_agg(name || '=' || n, ',' ORDER BY name) AS ids FROM n GROUP BY article),
    m AS (SELECT o_orderkey AS article, o_custkey % 3 AS broken, o_custkey % 7 AS raw, o_custkey % 11 AS ref FROM orders)"""


def _run_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items as defects of their orders, and three metrics of each order."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    severity = F.element_at(F.array(*[F.lit(s) for s in ("error", "warning", "info", "note")]), (F.col("l_suppkey") % 4).cast("int") + 1)
    name = F.when(F.col("l_linenumber") == 7, "").otherwise(F.concat(F.lit("P"), (F.col("l_partkey") % 5).cast("string")))
    counted = F.when(F.col("l_linenumber") % 3 == 1, F.col("l_partkey") % 2 == 0).when(F.col("l_linenumber") % 3 == 2, True)
    found = items.select(F.col("l_orderkey").alias("article"), name.alias("id"), severity.alias("severity"), counted.alias("counted"))
    metric = lambda n, c: F.struct(F.lit(n).alias("metric"), c.cast("double").alias("value"))
    k = F.col("o_custkey")
    metrics = orders.select(F.col("o_orderkey").alias("article"), F.inline(F.array(metric("broken_internal_links", k % 3), metric("raw_ref_links", k % 7), metric("ref_links", k % 11))))
    return found, metrics


@query(f"""WITH {_RECORDS}
    SELECT coalesce(p.article, m.article) AS article, round(coalesce(errors, 0) * 10.0 + coalesce(warnings, 0) * 3.0 + (coalesce(defects, 0) - coalesce(errors, 0) - coalesce(warnings, 0)) * 0.5 + coalesce(named, 0) * 0.25 + coalesce(broken, 0) * 4.0, 2)::DOUBLE AS score,
           coalesce(defects, 0) AS defects, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings, coalesce(infos, 0) AS infos, coalesce(unique_ids, 0) AS unique_ids, coalesce(ids, '') AS defect_ids,
           CASE WHEN m.article IS NULL THEN '' ELSE 'broken_internal_links=' || broken || ',raw_ref_links=' || raw || ',ref_links=' || ref || ',ref_links_delta=' || (ref - raw) END AS metrics
    FROM p LEFT JOIN i ON p.article = i.article FULL JOIN m ON p.article = m.article""")
def run_article_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a run's articles: orders with line items as their defects."""
    found = reports.article_records(*_run_rows(spark, sf_dir), "article")
    shown = lambda c, kind: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast(kind).cast("string"))), ",").alias(c)
    return found.select("article", "score", "defects", "errors", "warnings", "infos", "unique_ids", shown("defect_ids", "long"), shown("metrics", "long"))


@query(f"""WITH {_RECORDS}, a AS (SELECT id, article, bool_or(counted IS NOT FALSE) AS counts FROM d GROUP BY id, article)
    SELECT id, count(*) FILTER (counts) AS counted, count(*) AS observed, count(*) FILTER (NOT counts) AS uncounted FROM a GROUP BY id""")
def run_pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many articles each defect counts, is seen, and is seen without counting."""
    return reports.pattern_counts(_run_rows(spark, sf_dir)[0], "article")


@query(f"""WITH {_RECORDS},
    s AS (SELECT count(*) AS article_count, sum(coalesce(errors, 0) * 10.0 + coalesce(warnings, 0) * 3.0 + (coalesce(defects, 0) - coalesce(errors, 0) - coalesce(warnings, 0)) * 0.5 + coalesce(named, 0) * 0.25 + coalesce(broken, 0) * 4.0) AS score, sum(defects) AS defects, sum(errors) AS errors, sum(warnings) AS warnings, sum(infos) AS infos FROM p FULL JOIN m ON p.article = m.article)
    SELECT article_count, round(score, 2)::DOUBLE AS score, defects::BIGINT AS defects, errors::BIGINT AS errors, warnings::BIGINT AS warnings, infos::BIGINT AS infos, (SELECT sum(ref - raw) FROM m)::DOUBLE AS ref_links_delta FROM s""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the records of a run sum up to."""
    totals = reports.run_totals(reports.article_records(*_run_rows(spark, sf_dir), "article"))
    return totals.select("article_count", "score", "defects", "errors", "warnings", "infos", F.element_at("metrics", "ref_links_delta").alias("ref_links_delta"))
