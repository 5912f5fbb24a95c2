"""The registered queries over the tables, with the SQL that each is held against."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions import language, ocr, text
from pagewright.operators import audits, citations, defects, detectors, history, ledgers, matching, pages, repairs, runs, sequences, trees

from . import bibliography_queries, repair_queries, review_queries, structure_queries  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES, query, table

FLAGSHIP = "document_quality_ranking"


# --- SQL that several oracles share -------------------------------------------------------------------------

_RULES_SQL = " UNION ALL ".join(f"SELECT doc_id, source, '{r.id}' AS id, '{r.severity}' AS severity, '{r.check}' AS \"check\", len(regexp_extract_all(text, '{r.pattern}')) AS hits, regexp_extract(text, '{r.pattern}') AS snippet FROM documents" for r in defects.RULES)
DEFECTS_SQL = f"SELECT * FROM ({_RULES_SQL}) WHERE hits > 0"
SCORES_SQL = f"""SELECT doc_id, any_value(source) AS source, round(count(*) FILTER (severity = 'error') * 10.0 + count(*) FILTER (severity = 'warning') * 3.0 + count(*) FILTER (severity NOT IN ('error', 'warning')) * 0.5 + count(DISTINCT id) * 0.25, 2)::DOUBLE AS score,
    count(*) AS defects, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity NOT IN ('error', 'warning')) AS infos FROM ({DEFECTS_SQL}) GROUP BY doc_id"""


def _stop_sql() -> str:
    return ", ".join(f"('{w}', '{c}')" for c, ws in language.STOP_WORDS.items() for w in ws.split())


def _detect_sql(source: str, keys: str, min_alpha: int, min_words: int) -> str:
    """The detector as DuckDB SQL over rows of (keys, text)."""
    plain = lambda sql: re.sub(r"(\d\.\d+)D", r"\1::DOUBLE", sql)
    hits = ", ".join(f"count(*) FILTER (code = '{c}') AS hits_{c}" for c in language.STOP_WORDS)
    zero = ", ".join(f"coalesce(hits_{c}, 0) AS hits_{c}" for c in language.STOP_WORDS)
    best = "greatest(" + ", ".join(f"hits_{c}" for c in language.EUROPEAN) + ")"
    code = "CASE " + " ".join(f"WHEN hits_{c} = {best} THEN '{c}'" for c in language.EUROPEAN) + " END"
    n = lambda p: f"len(regexp_extract_all(text, '{p}'))"
    join = " AND ".join(f"m.{k} = h.{k}" for k in keys.split(", "))
    own = ", ".join(f"m.{k}" for k in keys.split(", "))
    scores = ", ".join(f"{plain(s)} AS {k}" for k, s in language.SCORES.items())
    return f"""
        SELECT {keys}, {plain(language.case(1))} AS language, {plain(language.case(3))} AS confidence, {plain(language.case(2))} AS reason, n_chars, n_words, en_hits, ru_hits, latin_ratio, cyrillic_ratio
        FROM (SELECT *, {scores} FROM (
            SELECT *, hits_en AS en_hits, hits_ru AS ru_hits, {best} AS eu_hits, {code} AS eu, latin + cyrillic AS alpha, {min_alpha} AS min_alpha, {min_words} AS min_words,
                   CASE WHEN latin + cyrillic > 0 THEN latin / (latin + cyrillic)::DOUBLE ELSE 0.0 END AS latin_ratio, CASE WHEN latin + cyrillic > 0 THEN cyrillic / (latin + cyrillic)::DOUBLE ELSE 0.0 END AS cyrillic_ratio
            FROM (SELECT {own}, n_chars, n_words, latin, cyrillic, cjk, kana, han, {zero}
                  FROM (SELECT {keys}, length(text) AS n_chars, {n(language.WORD)} AS n_words, {n(language.LATIN)} AS latin, {n(language.CYRILLIC)} AS cyrillic, {n(language.CJK)} AS cjk, {n(language.KANA)} AS kana, {n(language.HAN)} AS han FROM ({source})) m
                  LEFT JOIN (SELECT {keys}, {hits} FROM (SELECT {keys}, unnest(regexp_extract_all(lower(text), '{language.WORD}')) AS word FROM ({source})) JOIN (VALUES {_stop_sql()}) AS s(word, code) USING (word) GROUP BY {keys}) h ON {join})))
    """


_TEXT = r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents"
DETECT_SQL = _detect_sql(_TEXT, "doc_id", 250, 40)


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.detect(docs, ["doc_id"], F.col("text"), 250, 40)


def found_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return defects.detect(docs, ["doc_id", "source"], F.col("text"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.article_scores(found_defects(spark, sf_dir), "doc_id")


# --- language and recognition quality -----------------------------------------------------------------------


@query(f"SELECT doc_id, language, round(confidence, 6) AS confidence, reason, n_words, en_hits FROM ({DETECT_SQL})")
def lang_detect_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(spark, sf_dir).select("doc_id", "language", F.round("confidence", 6).alias("confidence"), "reason", "n_words", "en_hits")


@query()
def lang_windows_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.detect_document(docs, "doc_id", F.col("text")).withColumn("confidence", F.round("confidence", 6))


@query(f"""SELECT doc_id, CASE WHEN language = 'en' OR language = 'unknown' THEN false ELSE confidence >= 0.75 END AS skip,
    CASE WHEN language = 'en' THEN 'target_language_detected' WHEN language = 'unknown' THEN 'unknown_language_allowed' WHEN confidence >= 0.75 THEN 'detected_' || language || '_not_en' ELSE 'non_target_below_threshold' END AS reason FROM ({DETECT_SQL})""")
def lang_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(spark, sf_dir).select("doc_id", language.gate(F.col("language"), F.col("confidence")).alias("g")).select("doc_id", "g.skip", "g.reason")


@query(f"SELECT language, count(*) AS documents FROM ({DETECT_SQL}) GROUP BY language")
def lang_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(spark, sf_dir).groupBy("language").agg(F.count("*").alias("documents"))


_OCR_WORD = ocr.WORD
_OCR_SQL = f"""
    WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '(?i)\\b(?:https?://|www\\.)\\S+', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM documents),
         w AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_OCR_WORD.replace("'", "''")}')) AS word FROM t),
         f AS (SELECT doc_id, word, trim(lower(word), '-''') AS bare FROM w),
         d AS (SELECT doc_id, count(*) AS word_count, count(*) FILTER (length(word) >= 5 AND regexp_full_match(word, '[A-Za-z][A-Za-z0-9''-]*') AND bare != '' AND (
                 (NOT regexp_matches(bare, '[aeiouy]') AND NOT regexp_full_match(bare, '[ivxlcdm]+')) OR regexp_matches(word, '{ocr.DAMAGE[0]}') OR regexp_matches(word, '{ocr.DAMAGE[1]}') OR regexp_matches(bare, '{ocr.RUNS}'))) AS damaged FROM f GROUP BY doc_id)
    SELECT t.doc_id, length(t.text) AS text_chars, coalesce(word_count, 0) AS word_count, coalesce(damaged, 0) AS damaged,
           greatest(0.0, least(1.0, round(1.0 - least(0.35, coalesce(damaged, 0) / greatest(coalesce(word_count, 0), 1)::DOUBLE * 1.4), 3)))::DOUBLE AS score
    FROM t LEFT JOIN d ON t.doc_id = d.doc_id
"""


@query(_OCR_SQL)
def ocr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ocr.assess(docs, ["doc_id"], F.col("text"))
    return found.select("doc_id", "text_chars", "word_count", "damaged", "score")


@query()
def ocr_quality_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.assess(table(spark, sf_dir, "pages"), ["page_id"], F.col("html"))


# --- defects, scores, runs ----------------------------------------------------------------------------------


@query(f"SELECT doc_id, id, severity, \"check\", hits, snippet FROM ({DEFECTS_SQL})")
def defect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_defects(spark, sf_dir).select("doc_id", "id", "severity", "check", "hits", "snippet")


@query(f"WITH d AS ({DEFECTS_SQL}) SELECT d.doc_id, d.id, h.corpus_hits FROM d JOIN (SELECT id, count(DISTINCT doc_id) AS corpus_hits FROM d GROUP BY id) h USING (id)")
def corpus_hit_counts_joined_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.with_hit_counts(found_defects(spark, sf_dir), "doc_id").select("doc_id", "id", "corpus_hits")


@query(f"SELECT doc_id, score, defects, errors, warnings, infos FROM ({SCORES_SQL})")
def article_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir)


@query(f"""WITH s AS ({SCORES_SQL}), l AS ({DETECT_SQL})
    SELECT d.source, l.language, count(*) AS documents, round(sum(coalesce(s.score, 0)), 2)::DOUBLE AS score, sum(coalesce(s.errors, 0))::BIGINT AS errors
    FROM documents d JOIN l ON d.doc_id = l.doc_id LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.source, l.language""")
def document_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their language and score, summed by source and language, worst first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    joined = docs.join(detected(spark, sf_dir).select("doc_id", "language"), "doc_id").join(scores(spark, sf_dir), "doc_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = joined.groupBy("source", "language").agg(F.count("*").alias("documents"), F.round(F.sum(zero("score")), 2).alias("score"), F.sum(zero("errors")).alias("errors"))
    return out.orderBy(F.desc("score"), "source", "language")


@query(f"SELECT severity, count(*) AS defects, count(DISTINCT doc_id) AS documents, sum(hits)::BIGINT AS hits FROM ({DEFECTS_SQL}) GROUP BY severity")
def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_defects(spark, sf_dir).groupBy("severity").agg(F.count("*").alias("defects"), F.countDistinct("doc_id").alias("documents"), F.sum("hits").alias("hits"))


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two runs over sources: even documents and odd ones; source src0 is in the first alone, src1 in the second."""
    found = found_defects(spark, sf_dir)
    old = defects.article_scores(found.where("(doc_id % 2 = 0 AND source != 'src1') OR source = 'src0'"), "source")
    new = defects.article_scores(found.where("(doc_id % 2 = 1 AND source != 'src0') OR source = 'src1'"), "source")
    return old, new


_RUN_SQL = """SELECT source, round(count(*) FILTER (severity = 'error') * 10.0 + count(*) FILTER (severity = 'warning') * 3.0 + count(*) FILTER (severity NOT IN ('error', 'warning')) * 0.5 + count(DISTINCT id) * 0.25, 2)::DOUBLE AS score,
    count(*) AS defects, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM ({d}) WHERE {w} GROUP BY source"""
_COMPARE_SQL = f"""
    SELECT coalesce(n.source, o.source) AS source, CASE WHEN o.source IS NULL THEN 'new' WHEN n.source IS NULL THEN 'removed' ELSE 'comparable' END AS comparison_state,
           round(coalesce(n.score, 0) - coalesce(o.score, 0), 2)::DOUBLE AS score_delta, coalesce(n.defects, 0) - coalesce(o.defects, 0) AS defects_delta,
           coalesce(n.errors, 0) - coalesce(o.errors, 0) AS errors_delta, coalesce(n.warnings, 0) - coalesce(o.warnings, 0) AS warnings_delta,
           CASE WHEN o.source IS NULL THEN 'new' WHEN n.source IS NULL THEN 'removed' WHEN round(n.score - o.score, 2) > 0 THEN 'regression' WHEN round(n.score - o.score, 2) < 0 THEN 'improvement' ELSE 'unchanged' END AS verdict
    FROM ({_RUN_SQL.format(d=DEFECTS_SQL, w="(doc_id % 2 = 0 AND source != 'src1') OR source = 'src0'")}) o FULL OUTER JOIN ({_RUN_SQL.format(d=DEFECTS_SQL, w="(doc_id % 2 = 1 AND source != 'src0') OR source = 'src1'")}) n ON o.source = n.source"""


@query(_COMPARE_SQL)
def compare_runs_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.compare_runs(*_runs(spark, sf_dir), "source")


@query(f"""WITH c AS ({_COMPARE_SQL}), w AS (SELECT * FROM c WHERE verdict = 'regression'), s AS (SELECT coalesce(sum(defects_delta), 0) AS defects_delta, coalesce(round(sum(score_delta), 2), 0) AS score_delta FROM c WHERE comparison_state = 'comparable'),
    r AS (SELECT 'regressions' AS kind, NULL::VARCHAR AS article, 'regressions' AS metric, (SELECT count(*) FROM w)::DOUBLE AS observed, 0.0::DOUBLE AS "limit"
      UNION ALL SELECT 'total_delta', NULL, 'defects_delta', defects_delta::DOUBLE, 0.0::DOUBLE FROM s UNION ALL SELECT 'total_delta', NULL, 'score_delta', score_delta::DOUBLE, -50.0::DOUBLE FROM s
      UNION ALL SELECT 'article_delta', source, 'errors_delta', errors_delta::DOUBLE, 1.0::DOUBLE FROM w UNION ALL SELECT 'article_delta', source, 'score_delta', score_delta::DOUBLE, 5.0::DOUBLE FROM w)
    SELECT * FROM r WHERE observed > "limit" """)
def gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = history.compare_runs(*_runs(spark, sf_dir), "source")
    return history.gate_failures(compared, "source", 0, {"defects_delta": 0, "score_delta": -50}, {"errors_delta": 1, "score_delta": 5})


@query(f"""WITH d AS ({DEFECTS_SQL}), b AS (SELECT source, id, count(*) AS b FROM d WHERE doc_id % 2 = 0 GROUP BY ALL), a AS (SELECT source, id, count(*) AS a FROM d WHERE doc_id % 2 = 1 GROUP BY ALL),
    j AS (SELECT coalesce(b.source, a.source) AS source, coalesce(b, 0) AS b, coalesce(a, 0) AS a FROM b FULL OUTER JOIN a ON b.source = a.source AND b.id = a.id),
    s AS (SELECT source, sum(b)::BIGINT AS before, sum(a)::BIGINT AS after, sum(greatest(b - a, 0))::BIGINT AS fixed, sum(greatest(a - b, 0))::BIGINT AS new FROM j GROUP BY source),
    c AS (SELECT *, CASE WHEN after = 0 THEN 'fixed' WHEN new > 0 THEN 'regressed' WHEN after < before THEN 'improved' WHEN new = 0 AND fixed = 0 THEN 'unchanged' ELSE 'regressed' END AS classification FROM s)
    SELECT *, CASE WHEN classification IN ('fixed', 'improved') THEN 'repolish' ELSE 'code_fix_or_reconvert' END AS action FROM c""")
def delta_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_defects(spark, sf_dir)
    return history.deltas(found.where("doc_id % 2 = 0"), found.where("doc_id % 2 = 1"), "source")


@query("""SELECT doc_id, quality, toxic FROM labels WHERE doc_id % 3 != 0 UNION ALL SELECT doc_id, 1 - quality, toxic FROM labels WHERE doc_id % 3 = 0""")
def targeted_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    targeted = labels.where("doc_id % 3 = 0").withColumn("quality", 1 - F.col("quality"))
    return history.upsert(labels, targeted, "doc_id")


@query(f"""SELECT doc_id, score, defects, risk, errors > 0 AS mandatory, CASE risk WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END AS risk_rank
    FROM (SELECT *, CASE WHEN errors > 0 THEN 'high' WHEN warnings >= 2 THEN 'medium' WHEN defects > 0 THEN 'low' ELSE 'auto_verified' END AS risk FROM ({SCORES_SQL}))""")
def review_risk_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.review_queue(scores(spark, sf_dir), "doc_id").orderBy(*ledgers.queue_order(), "doc_id")


@query(f"""WITH d AS ({DEFECTS_SQL}) SELECT id, severity, count(*) AS count, count(DISTINCT doc_id) AS articles, list_sort(list(DISTINCT doc_id))[1:5]::VARCHAR AS sample FROM d GROUP BY id, severity""")
def resolver_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledgers.decision_groups(found_defects(spark, sf_dir), ["id", "severity"], "doc_id")
    return found.withColumn("sample", F.concat(F.lit("["), F.array_join(F.col("sample").cast("array<string>"), ", "), F.lit("]")))


# --- ledgers ------------------------------------------------------------------------------------------------


@query("""SELECT user_id, event_id, event_type, entries FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n, count(*) OVER (PARTITION BY user_id) AS entries FROM events) WHERE n = 1""")
def manual_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return ledgers.latest(events, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "entries")


@query("""SELECT event_type, count(*) AS occurrences, count(DISTINCT ts::DATE) AS runs, count(DISTINCT user_id) AS articles, min(ts) AS first_seen, max(ts) AS last_seen,
    CASE WHEN count(DISTINCT ts::DATE) >= 2 OR count(DISTINCT user_id) >= 2 OR count(*) >= 3 THEN 'problem_candidate' ELSE 'pattern_observation' END AS state FROM events GROUP BY event_type""")
def pattern_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("run", F.to_date("ts"))
    return ledgers.pattern_history(events, "event_type", "run", "user_id", "ts")


# --- sequences ----------------------------------------------------------------------------------------------


@query("""SELECT conv_id, turn, role, coalesce(max(length(text) > 2000) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), false) AS long_nearby FROM conversations""")
def neighbour_window_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", "role", sequences.any_within(F.char_length("text") > 2000, ["conv_id"], "turn", 2, 2).alias("long_nearby"))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items, numbered so that three is never a number."""
    return table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.col("l_linenumber") + (F.col("l_linenumber") >= 3).cast("int"))


@query("""WITH k AS (SELECT DISTINCT l_orderkey, l_linenumber + (l_linenumber >= 3)::INT AS l_linenumber FROM lineitem), i AS (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS island FROM k),
    r AS (SELECT l_orderkey, min(l_linenumber) AS first, count(*) AS length FROM i GROUP BY l_orderkey, island)
    SELECT l_orderkey, first, length FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY length DESC, first) AS n FROM r) WHERE n = 1""")
def longest_consecutive_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.longest_run(_with_gaps(spark, sf_dir), "l_orderkey", "l_linenumber")


@query("""WITH k AS (SELECT DISTINCT l_orderkey, l_linenumber + (l_linenumber >= 3)::INT AS l_linenumber FROM lineitem), b AS (SELECT l_orderkey, unnest(range(min(l_linenumber), max(l_linenumber) + 1))::INT AS missing FROM k GROUP BY l_orderkey)
    SELECT b.l_orderkey, missing FROM b LEFT JOIN k ON b.l_orderkey = k.l_orderkey AND missing = l_linenumber WHERE k.l_orderkey IS NULL""")
def id_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.gaps(_with_gaps(spark, sf_dir), "l_orderkey", "l_linenumber")


@query("""WITH e AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 * (1 + event_id % 48) AS t FROM events),
    m AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
    i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT user_id, min(s) AS start, max(t) AS "end", count(*) AS n FROM i GROUP BY user_id, island""")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("s"), (F.unix_micros(F.col("ts").cast("timestamp")) + F.lit(3600000000).cast("long") * (1 + F.col("event_id") % 48)).alias("t"))
    return sequences.merged_intervals(events, "user_id", "s", "t")


@query("""SELECT o_orderkey, list_sort(list_distinct(list_concat([(1 + o_orderkey % 7)::INT], range((10 + o_orderkey % 5)::INT, (10 + o_orderkey % 5 + o_orderkey % 9 + 1)::INT))))::VARCHAR AS numbers FROM orders""")
def range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    value = F.concat((1 + k % 7).cast("string"), F.lit(", "), (10 + k % 5).cast("string"), F.lit("-"), (10 + k % 5 + k % 9).cast("string"))
    numbers = F.array_sort(sequences.expanded_ranges(value))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("["), F.array_join(numbers.cast("array<string>"), ", "), F.lit("]")).alias("numbers"))


@query("""SELECT e.event_id, e.user_id, coalesce(max(s.event_id), -1) AS nearest_start FROM events e LEFT JOIN events s ON e.user_id = s.user_id AND s.event_type = 'view' AND s.event_id <= e.event_id GROUP BY e.event_id, e.user_id""")
def nearest_start_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    starts = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("start_id"))
    return sequences.nearest_before(events.select("event_id", "user_id"), starts, "user_id", "event_id", "start_id").select("event_id", "user_id", F.coalesce("nearest_start", F.lit(-1)).alias("nearest_start"))


# --- matching, names, trees ---------------------------------------------------------------------------------

_TOKENS = "list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9à-öø-ÿ]{3,}'), lambda t: NOT regexp_full_match(t, '[0-9]+')))"


@query(f"""WITH w AS (SELECT item_id, unnest({_TOKENS}) AS t FROM benchmark), h AS (SELECT doc_id, unnest({_TOKENS}) AS t FROM documents), c AS (SELECT item_id, doc_id, count(*) AS shared FROM w JOIN h USING (t) GROUP BY ALL),
    b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS r FROM c), z AS (SELECT item_id, count(*) AS n FROM w GROUP BY item_id)
    SELECT item_id, doc_id, round(shared / n::DOUBLE, 6) AS score FROM b JOIN z USING (item_id) WHERE r = 1""")
def page_match_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.best_page(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id", "text")


@query("""SELECT source, sha256(text) AS identity, count(DISTINCT doc_id) AS members FROM documents GROUP BY ALL HAVING count(DISTINCT doc_id) >= 2""")
def shared_identity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return matching.shared_identities(docs, "source", F.sha2(F.encode("text", "UTF-8"), 256), "doc_id")


_SLUG = "regexp_replace(trim(regexp_replace(p_name || ' ' || p_type || '/' || p_brand, '[^\\p{L}\\p{N}_.-]+', '_', 'g'), '._'), '_+', '_', 'g')"


@query(f"SELECT p_partkey, CASE WHEN length({_SLUG}) <= 24 THEN {_SLUG} ELSE {_SLUG}[1:15] || '_' || sha1({_SLUG})[1:8] END AS slug FROM part")
def stable_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", text.stable_slug(F.concat("p_name", F.lit(" "), "p_type", F.lit("/"), "p_brand")).alias("slug"))


@query("""SELECT p_partkey, CASE WHEN n = 1 THEN p_type ELSE p_type || '_' || n END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY lower(p_type) ORDER BY p_partkey) AS n FROM part)""")
def alias_unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.unique_names(table(spark, sf_dir, "part"), F.col("p_type"), "p_partkey").select("p_partkey", "unique_name")


@query("""WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS p, 'n' || n_nationkey AS c FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
    t AS (SELECT p AS ancestor, c AS node, 1 AS depth FROM e UNION ALL SELECT t.ancestor, e.c, t.depth + 1 FROM t JOIN e ON t.node = e.p) SELECT ancestor, node, depth FROM t""")
def collection_tree_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation = table(spark, sf_dir, "nation").select(key("r", "n_regionkey").alias("p"), key("n", "n_nationkey").alias("c"))
    customer = table(spark, sf_dir, "customer").select(key("n", "c_nationkey").alias("p"), key("c", "c_custkey").alias("c"))
    supplier = table(spark, sf_dir, "supplier").select(key("n", "s_nationkey").alias("p"), key("s", "s_suppkey").alias("c"))
    return trees.descendants(nation.unionByName(customer).unionByName(supplier), "p", "c")


# --- markup -------------------------------------------------------------------------------------------------


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with reference links and targets added: a link without a target, and a target that is there twice."""
    html = F.concat("html", F.lit('<p><a href="#ref-1">1</a> <a href="#ref-2">2</a> <a href="#gone-'), (F.col("page_id") % 3).cast("string"), F.lit('">x</a></p><ul><li id="ref-1">a</li><li id="ref-2">b</li><li id="ref-'), (1 + F.col("page_id") % 2).cast("string"), F.lit('">c</li></ul>'))
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


_LINKED_SQL = """SELECT page_id, html || '<p><a href="#ref-1">1</a> <a href="#ref-2">2</a> <a href="#gone-' || page_id % 3 || '">x</a></p><ul><li id="ref-1">a</li><li id="ref-2">b</li><li id="ref-' || (1 + page_id % 2) || '">c</li></ul>' AS html FROM pages"""


@query(f"""WITH l AS ({_LINKED_SQL}), a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*\\bhref\\s*=\\s*["'']#([^"'']+)["'']', 1)) AS h FROM l), t AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?i)\\b(?:id|name)\\s*=\\s*["'']([^"'']+)["'']', 1)) AS h FROM l)
    SELECT a.page_id, count(*) AS links, count(*) FILTER (t.h IS NULL) AS broken_links, coalesce(string_agg(DISTINCT a.h, ',' ORDER BY a.h) FILTER (t.h IS NULL), '') AS broken_targets FROM a LEFT JOIN t ON a.page_id = t.page_id AND a.h = t.h GROUP BY a.page_id""")
def href_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.link_assessment(_linked(spark, sf_dir), ["page_id"], F.col("html")).withColumn("broken_targets", F.array_join("broken_targets", ","))


@query(f"""SELECT page_id, target, count(*) AS times FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)\\bid\\s*=\\s*["'']([^"'']+)["'']', 1)) AS target FROM ({_LINKED_SQL})) GROUP BY ALL HAVING count(*) > 1""")
def duplicate_target_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.repeated_targets(_linked(spark, sf_dir), ["page_id"], F.col("html"))


_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(html, '<!--[\s\S]*?-->', '', 'g'), '(?is)<script\b.*?</script>', '', 'g'), '(?is)<style\b.*?</style>', '', 'g')"
_BALANCE_SQL = " UNION ALL ".join(f"SELECT page_id, '{t}' AS tag, len(regexp_extract_all(h, '(?i)<{t}\\b')) AS opened, len(regexp_extract_all(h, '(?i)</{t}\\s*>')) AS closed FROM c" for t in pages.BALANCED)


@query(f"WITH p AS (SELECT page_id, html || CASE WHEN page_id % 4 = 0 THEN '<div>' ELSE '' END AS html FROM pages), c AS (SELECT page_id, {_CLEAN} AS h FROM p) SELECT * FROM ({_BALANCE_SQL}) WHERE opened != closed")
def page_tag_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat("html", F.when(F.col("page_id") % 4 == 0, "<div>").otherwise(""))
    return pages.tag_balance(table(spark, sf_dir, "pages"), ["page_id"], html)


@query(f"""WITH b AS (SELECT page_id, unnest(regexp_extract_all({_CLEAN}, '{pages.BLOCK}')) AS raw FROM pages)
    SELECT page_id, lower(regexp_extract(raw, '^<([A-Za-z0-9]+)', 1)) AS tag, count(*) AS blocks, count(*) FILTER (regexp_matches(raw, '(?i)<img\\b')) AS images FROM b GROUP BY ALL""")
def page_block_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.blocks(table(spark, sf_dir, "pages"), ["page_id"], F.col("html"))
    return found.groupBy("page_id", "tag").agg(F.count("*").alias("blocks"), F.count_if("has_img").alias("images"))


@query()
def page_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.visible(F.col("html")).alias("visible"))


@query()
def page_anchor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.anchors(table(spark, sf_dir, "pages"), ["page_id"], F.col("html"))
    return found.groupBy("page_id").agg(F.count("*").alias("anchors"), F.countDistinct("href").alias("targets"), F.count_if(F.col("text") == "").alias("empty"))


@query(r"""SELECT page_id, lower(regexp_extract(b, '^([a-zA-Z]+://[^/]*)', 1)) || regexp_replace(b, '^[a-zA-Z]+://[^/]*', '') AS base FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS b FROM pages)""")
def same_document_base_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", pages.base_url(F.col("url")).alias("base"))


@query(r"""WITH l AS (SELECT DISTINCT source, doc_id, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\d+', '#', 'g')) AS line FROM documents)
    SELECT source, line, count(*) AS documents FROM l WHERE line != '' AND length(line) <= 120 GROUP BY ALL HAVING count(*) >= 3""")
def repeated_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.repeated_lines(table(spark, sf_dir, "documents"), "source", "doc_id", F.col("text"))


# --- repairs ------------------------------------------------------------------------------------------------


@query()
def repeated_phrase_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fixed = text.collapsed_phrases(F.col("text"))
    return docs.select("doc_id", F.char_length("text").alias("before"), F.char_length(fixed).alias("after")).where("after < before")


@query(r"""SELECT doc_id, regexp_replace(t, '\b([A-Za-z0-9._%+-]+)(?: @ ?|@ )([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})\b', '\1@\2', 'g') = text AS restored FROM (SELECT doc_id, text, replace(text, '@', '@ ') AS t FROM documents WHERE text LIKE '%@%')""")
def email_split_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").contains("@"))
    return docs.select("doc_id", (text.joined_addresses(F.replace("text", F.lit("@"), F.lit("@ "))) == F.col("text")).alias("restored"))


# --- citations, references, audits, repairs -----------------------------------------------------------------

_CITED_TEXT = "text || CASE doc_id % 5 WHEN 0 THEN repeat(' as shown [1-3] and [7].', 6) WHEN 1 THEN repeat(' as seen (4, 5).', 6) WHEN 2 THEN repeat(' Smith et al., 2010 found it.', 9) WHEN 3 THEN repeat(' It was seen. 1,2,3 Then it was lost', 6) ELSE '' END"


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with citations added, in a style that depends on the id."""
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(_CITED_TEXT).alias("text"))


_STYLE_SQL = f"""WITH c AS (SELECT doc_id, {_CITED_TEXT} AS text FROM documents),
    n AS (SELECT doc_id, len(regexp_extract_all(text, '{citations.PAREN}')) AS paren, len(regexp_extract_all(text, '{citations.BRACKET}')) AS bracket, len(regexp_extract_all(text, '(?i)(?:^|[^\\w-])[A-ZÀ-ÞА-ЯЁ][A-Za-zÀ-ÖØ-öø-ÿА-яЁё''’.-]+(?:\\s+(?:et\\s+al\\.?|и\\s+др\\.?|(?:and|и)\\s+[A-ZÀ-ÞА-ЯЁ][A-Za-zÀ-ÖØ-öø-ÿА-яЁё''’.-]+|(?:&|&amp;)\\s*[A-ZÀ-ÞА-ЯЁ][A-Za-zÀ-ÖØ-öø-ÿА-яЁё''’.-]+))?(?:,\\s*|\\s+)\\(?\\d{{4}}[a-zа-яё]?\\)?')) AS author_year,
          len(regexp_extract_all(text, '[.!?]\\s+[0-9]{{1,3}}(?:\\s*[,;–—-]\\s*[0-9]{{1,3}}){{1,12}}\\s+[A-Z]')) AS flat_super, 0 AS ref_links, 0 AS super_hint, 0 AS author_hint, 0 AS structure, 0 AS numbered FROM c),
    w AS (SELECT *, greatest(paren, bracket, flat_super, super_hint, structure, numbered) AS signal, numbered >= 5 AND (super_hint >= 5 OR bracket >= 5) AS paired FROM n)
    SELECT doc_id, {citations.style_case(1)} AS style, {citations.style_case(2)} AS confidence, paren, bracket, author_year FROM w"""


@query(_STYLE_SQL)
def citation_style_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.styles(_cited(spark, sf_dir), ["doc_id"], F.col("text"))


_REFS_HTML = "'<li id=\"ref-' || (1 + page_id % 3) || '\"></li><li id=\"ref-' || (4 + page_id % 3) || '\"></li><li id=\"ref-9\"></li>'"


@query(f"""WITH h AS (SELECT page_id, html || {_REFS_HTML} AS html FROM pages), i AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?i)\\bid\\s*=\\s*["'']ref-(\\d+)["'']', 1))::INT AS n FROM h),
    s AS (SELECT page_id, n, lead(n) OVER (PARTITION BY page_id ORDER BY n) AS m FROM i)
    SELECT page_id, unnest(range(n + 1, m))::INT AS missing FROM s WHERE m - n > 1 AND m - n <= 25""")
def reference_gap_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = table(spark, sf_dir, "pages").select("page_id", F.expr(f"html || {_REFS_HTML}").alias("html"))
    return html.select("page_id", F.explode(citations.missing_ids(citations.reference_ids(F.col("html")))).alias("missing"))


@query("""WITH r AS (SELECT l_orderkey, l_partkey % 20 AS number, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem),
    s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, number ORDER BY place) AS k, number - lag(number) OVER (PARTITION BY l_orderkey ORDER BY place) AS step FROM r)
    SELECT l_orderkey, place, number, CASE WHEN k > 1 THEN 'duplicate_reference_number' ELSE 'reference_number_gap' END AS defect FROM s WHERE k > 1 OR step > 1""")
def reference_identity_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    refs = lines.select("l_orderkey", (F.col("l_partkey") % 20).alias("number"), place.alias("place"))
    return citations.identity_defects(refs, "l_orderkey", "place", "number").select("l_orderkey", "place", "number", "defect")


@query()
def page_block_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = pages.blocks(table(spark, sf_dir, "pages"), ["page_id"], F.col("html"))
    return audits.block_defects(blocks, ["page_id"])


@query("""WITH b AS (SELECT conv_id, turn, role, text, lag(text) OVER w AS last, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, CASE WHEN text = last THEN 'repeated_turn' ELSE 'same_role_follows' END AS defect FROM b WHERE text = last OR role = next_role""")
def conversation_order_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lag("text").over(order).alias("last"), F.lead("role").over(order).alias("next_role"))
    repeated = F.col("text") == F.col("last")
    return turns.where(repeated | (F.col("role") == F.col("next_role"))).select("conv_id", "turn", F.when(repeated, "repeated_turn").otherwise("same_role_follows").alias("defect"))


@query()
def polished_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repairs.polish(table(spark, sf_dir, "pages"), "html")
    return done.select("page_id", F.char_length("html").alias("before"), F.char_length("polished").alias("after"), "polished")


@query("""SELECT metric, sum(value)::BIGINT AS total, count(*) FILTER (value != 0) AS articles FROM (SELECT 'digits' AS metric, len(regexp_extract_all(text, '[0-9]')) AS value FROM documents UNION ALL SELECT 'lines', len(string_split(text, chr(10))) FROM documents UNION ALL SELECT 'marks', len(regexp_extract_all(text, '[!?]')) FROM documents) GROUP BY metric""")
def assessment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("long")
    metrics = F.create_map(F.lit("digits"), n("[0-9]"), F.lit("lines"), F.size(F.split("text", "\n")).cast("long"), F.lit("marks"), n("[!?]"))
    return history.totals(table(spark, sf_dir, "documents").select(metrics.alias("metrics")))


@query(f"""WITH d AS ({DEFECTS_SQL}), o AS (SELECT id, count(DISTINCT doc_id) AS observed FROM d GROUP BY id), c AS (SELECT id, count(DISTINCT doc_id) AS counted FROM d WHERE severity != 'info' GROUP BY id)
    SELECT o.id, observed - coalesce(counted, 0) AS uncounted FROM o LEFT JOIN c ON o.id = c.id WHERE observed - coalesce(counted, 0) > 0""")
def non_quality_hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_defects(spark, sf_dir)
    counted = F.countDistinct(F.when(F.col("severity") != "info", F.col("doc_id")))
    per = found.groupBy("id").agg((F.countDistinct("doc_id") - counted).alias("uncounted"))
    return per.where("uncounted > 0")


@query(f"""SELECT doc_id, string_agg(id || ':' || hits, ',' ORDER BY id) AS histogram FROM ({DEFECTS_SQL}) GROUP BY doc_id""")
def defect_id_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.concat("id", F.lit(":"), F.col("hits").cast("string"))))
    return found_defects(spark, sf_dir).groupBy("doc_id").agg(F.array_join(pairs, ",").alias("histogram"))


@query("""SELECT doc_id, coalesce(list_aggregate(list_distinct(list_filter(regexp_extract_all(text, '[A-Za-z]{12,}'), lambda t: true)), 'count'), 0)::BIGINT AS long_words FROM documents""")
def distinct_long_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]{12,}"), F.lit(0)))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).cast("long").alias("long_words"))


# --- the detectors' catalogue -------------------------------------------------------------------------------

_MARKED = """html || CASE page_id % 5 WHEN 0 THEN '<p>mail a.b@ c.org and www. site</p><li id="ref-1">1. [1] One</li><li id="ref-3">2. Two</li><a href="#ref-9">9</a>'
    WHEN 1 THEN '<h2>A FIGURE HEADING THAT IS LONG AND ALL IN CAPITALS</h2><p>3Department of x</p><a href="#ref-2">5</a></a>' WHEN 2 THEN '<p>Page 2 of 9</p><a href="#page-3">some plain words here</a>' ELSE '' END"""


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with defects added by id."""
    return table(spark, sf_dir, "pages").select("page_id", F.expr(_MARKED).alias("html"))


@query()
def page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.audit(_marked(spark, sf_dir), ["page_id"], F.col("html"))


_MARKUP_SQL = " UNION ALL ".join("SELECT page_id, '{0}' AS id, '{1}' AS severity, '{2}' AS \"check\", len(regexp_extract_all(html, '{3}')) AS hits FROM m".format(r.id, r.severity, r.check, r.pattern.replace("'", "''")) for r in detectors.MARKUP_RULES)


@query(f"WITH m AS (SELECT page_id, {_MARKED} AS html FROM pages) SELECT * FROM ({_MARKUP_SQL}) WHERE hits > 0")
def page_markup_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.detect(_marked(spark, sf_dir), ["page_id"], F.col("html"), detectors.MARKUP_RULES).drop("snippet")


_TEXT_RULES_SQL = " UNION ALL ".join("SELECT doc_id, '{0}' AS id, '{1}' AS severity, len(regexp_extract_all(text, '{2}')) AS hits FROM documents".format(r.id, r.severity, r.pattern.replace("'", "''")) for r in detectors.TEXT_RULES)


@query(f"SELECT * FROM ({_TEXT_RULES_SQL}) WHERE hits > 0")
def document_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.detect(table(spark, sf_dir, "documents"), ["doc_id"], F.col("text"), detectors.TEXT_RULES).drop("snippet", "check")


@query("""SELECT page_id, target AS number, CASE WHEN visible != target THEN 'P21' ELSE 'P26' END AS id FROM (SELECT page_id, unnest([1, 3]) AS target, unnest([1, 2]) AS visible, unnest([0, 2]) AS step FROM pages WHERE page_id % 5 = 0) WHERE visible != target
    UNION ALL SELECT page_id, 3, 'P26' FROM pages WHERE page_id % 5 = 0""")
def page_reference_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.reference_audit(_marked(spark, sf_dir), ["page_id"], F.col("html")).select("page_id", "number", "id")


@query()
def resolver_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detectors.audit(_marked(spark, sf_dir), ["page_id"], F.col("html"))
    decided = found.withColumn("decision", detectors.decision(F.col("id"), F.col("severity") != "info"))
    return ledgers.decision_groups(decided, ["id", "decision"], "page_id")


# --- runs ---------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, source, place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source) AS n FROM (SELECT doc_id, 0 AS source, doc_id AS place FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 1, doc_id FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 2, n_chars FROM documents)) WHERE n = 1""")
def select_article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("place", F.col("doc_id"))
    docs = table(spark, sf_dir, "documents").withColumn("place", F.col("n_chars"))
    return runs.ordered_union([labels.where("quality = 0"), labels.where("toxic = 1"), docs], "doc_id", "place")


@query("""WITH s AS (SELECT c_custkey::VARCHAR AS k, c_mktsegment AS state FROM customer) SELECT o.o_orderkey, coalesce(a.state, b.state) AS state FROM orders o LEFT JOIN s a ON a.k = (o.o_custkey * 3)::VARCHAR LEFT JOIN s b ON b.k = o.o_custkey::VARCHAR WHERE coalesce(a.state, b.state) IS NOT NULL""")
def review_state_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 3).alias("k1"), F.col("o_custkey").alias("k2"))
    states = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("state"))
    return runs.state_by_any_key(items, states, ["k1", "k2"], "o_orderkey", "c_custkey", "state")


@query("""SELECT user_id, event_type AS folder, event_id AS at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE event_type != 'view') WHERE n = 1""")
def processed_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("folder"), F.col("event_id").alias("at"))
    return runs.processed_elsewhere(past, past, "user_id", "folder", "at", "view")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unresolved' ELSE 'resolved' END AS state FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def resolved_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    there, gone = runs.partition_by_existence(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")
    return there.withColumn("state", F.lit("resolved")).unionByName(gone.withColumn("state", F.lit("unresolved")))


@query("""SELECT o_orderstatus, prefix, count(*) AS n FROM (SELECT o_orderstatus, regexp_extract(o_orderpriority || o_orderkey, '^([A-Za-z]+)[0-9]+', 1) AS prefix FROM (SELECT o_orderstatus, o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'cite' WHEN 1 THEN 'fig' ELSE 'Table' END AS o_orderpriority FROM orders)) WHERE prefix != '' GROUP BY ALL""")
def destination_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "cite").when(F.col("o_orderkey") % 3 == 1, "fig").otherwise("Table"), F.col("o_orderkey").cast("string"))
    return runs.prefix_counts(table(spark, sf_dir, "orders").select("o_orderstatus", name.alias("name")), ["o_orderstatus"], "name")


@query("""WITH e AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 7 != 0), f AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN md5(text || 'x') ELSE md5(text) END AS h FROM documents WHERE doc_id % 5 != 0 OR doc_id % 7 = 0)
    SELECT coalesce(e.doc_id, f.doc_id) AS doc_id, CASE WHEN f.doc_id IS NULL THEN 'missing' WHEN e.doc_id IS NULL THEN 'unknown' ELSE 'changed' END AS problem FROM e FULL OUTER JOIN f ON e.doc_id = f.doc_id WHERE f.doc_id IS NULL OR e.doc_id IS NULL OR e.h != f.h""")
def cached_source_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = lambda c: F.md5(F.encode(c, "UTF-8"))
    expected = docs.where("doc_id % 7 != 0").select("doc_id", digest(F.col("text")).alias("h"))
    found = docs.where("doc_id % 5 != 0 OR doc_id % 7 = 0").select("doc_id", digest(F.concat("text", F.when(F.col("doc_id") % 11 == 0, "x").otherwise(""))).alias("h"))
    return runs.checked_snapshot(expected, found, "doc_id", "h")


@query()
def title_match_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return runs.title_candidates(items, table(spark, sf_dir, "documents"), "item_id", "doc_id", "text")


@query("""SELECT p_partkey, (CASE WHEN n <= 15 THEN n ELSE len(list_distinct(list_concat([0, 1, 2, n - 3, n - 2, n - 1], list_transform(range(1, 10), lambda i: round_even((n - 1) * i / 10.0, 0)::INT)))) END)::INT AS sampled FROM (SELECT p_partkey, p_size AS n FROM part)""")
def sampled_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.size(runs.sampled_pages(F.col("p_size"))).cast("int").alias("sampled"))
