"""Review risks and run reports by hand."""

import pytest
from pyspark.sql import functions as F

from pagewright.functions import language
from pagewright.operators import reports, reviews


def risk(spark, **given):
    base = {"changed": True, "bucket": "unchanged", "worse": "map()", "defects": 0, "observed": 0, "counted": 0, "links": 0, "images": 0, "mixed": False, "unresolved": 0, "sources": []}
    base |= given
    lit = lambda v: F.expr(v) if isinstance(v, str) and v.startswith("map(") else F.array(*[F.lit(x) for x in v]).cast("array<string>") if isinstance(v, list) else F.lit(v)
    r = spark.range(1).select(reviews.review_risk(*[lit(v) for v in base.values()]).alias("r")).first()["r"]
    return r["level"], r["reasons"], r["automatic"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ({"bucket": "regressions"}, ("high", ["comparison_regression"], False)),
        ({"counted": 1, "links": 2, "images": 3, "unresolved": 4}, ("high", ["broken_internal_links", "missing_local_images", "non_ignored_quality_counted_audit_defects", "p62_unresolved_without_terminal_status"], False)),
        ({"worse": "map('score', 1.0D)", "changed": False}, ("high", ["lower_is_better_metric_increase"], False)),
        ({"observed": 1, "defects": 2, "mixed": True}, ("medium", ["mixed_citation_style_present", "observed_non_quality_or_telemetry_defects"], False)),
        ({"defects": 2}, ("medium", ["ignored_defects_only"], False)),
        ({"sources": ["image_cache_restore"]}, ("auto_verified", ["changed_without_quality_delta_explained"], True)),
        ({"bucket": "improvements", "sources": ["x"]}, ("low", ["changed_without_quality_regression"], True)),
        ({"changed": False, "defects": 2}, ("low", ["unchanged_or_not_review_required"], False)),
        ({"bucket": None, "changed": None, "defects": None, "mixed": None}, ("low", ["unchanged_or_not_review_required"], None)),
    ],
)
def test_review_risks(spark, given, want):
    level, reasons, automatic = risk(spark, **given)
    assert (level, reasons, bool(automatic)) == (want[0], want[1], bool(want[2]))


def test_figure_evidence_and_sources(spark):
    schema = "article string, status string, plan_status string, label string, asset_status string, recovery_source string, terminal boolean"
    rows = [
        ("a", "patched", None, "F1", None, "pdf", None),
        ("a", "other", None, "F2", "ready", "marker", None),
        ("a", "patched", None, " F3 ", None, "pdf", None),
        ("a", "unresolved", None, None, None, None, None),
        ("a", "unresolved", None, None, None, None, True),
        ("a", None, "source_pdf_unavailable", "F3", None, None, None),
        ("a", "source_visual_unavailable", None, "F9", None, None, None),
    ]
    told = [("a", "F3"), ("a", "F4"), ("a", " "), ("b", "F1"), ("b", "F1")]
    got = {r["article"]: tuple(r)[1:] for r in reviews.figure_evidence(spark.createDataFrame(rows, schema), spark.createDataFrame(told, "article string, label string"), "article").collect()}
    assert got == {"a": (2, 4, 1, 1, ["marker", "pdf"]), "b": (0, 1, 0, 0, [])}
    repairs = reviews.repair_evidence(spark.createDataFrame([("a", "r2", True, None), ("a", "r1", None, ""), ("b", "r1", True, "bad"), ("c", None, False, None)], "article string, repair string, patched boolean, error string"), "article")
    sources = reviews.change_sources(F.lit(1), F.lit(None).cast("int"), F.struct(F.lit(0).alias("patched"), F.lit(2).alias("no_visual"), F.lit(None).cast("int").alias("no_source")), F.struct("patched", "repair_ids", "errors"))
    got = dict(repairs.select("article", sources).collect())
    assert got["a"] == ["image_cache_restore", "p62_source_visual_unavailable", "polish_auto_repair:r1", "polish_auto_repair:r2"]
    assert got["b"] == got["c"] == ["image_cache_restore", "p62_source_visual_unavailable"]


def test_records_and_totals(spark):
    defects = spark.createDataFrame([("a", "P1", "error", None), ("a", "P1", "warning", True), ("a", "P2", "error", False), ("a", None, "odd", True), ("b", "P2", "info", False)], "article string, id string, severity string, counted boolean")
    metrics = spark.createDataFrame([("a", "broken_internal_links", 2.0), ("c", "ref_links", 5.0), ("c", "raw_ref_links", 3.0), ("c", "words", None)], "article string, metric string, value double")
    records = reports.article_records(defects, metrics, "article")
    got = {r["article"]: r for r in records.collect()}
    a = got["a"]
    assert (a["score"], a["defects"], a["errors"], a["warnings"], a["infos"], a["unique_ids"]) == (10 + 3 + 0.5 + 0.25 + 8, 3, 1, 1, 0, 2)
    assert a["defect_ids"] == {"P1": 2, "unknown": 1} and a["metrics"] == {"broken_internal_links": 2.0}
    assert got["c"]["metrics"] == {"ref_links": 5.0, "raw_ref_links": 3.0, "ref_links_delta": 2.0} and got["c"]["score"] == 0 and "b" not in got
    total = reports.run_totals(records).first()
    assert (total["article_count"], total["score"], total["defects"], total["metrics"]["ref_links_delta"]) == (2, 21.75, 3, 2.0)
    counts = {r["id"]: tuple(r)[1:] for r in reports.pattern_counts(defects, "article").collect()}
    assert counts["P1"] == (1, 1, 0) and counts["P2"] == (0, 2, 2)
    assert [r["article"] for r in reports.ranking(records, "article").collect()] == ["a", "c"]
    none = reports.run_totals(reports.article_records(defects.where("false"), metrics.where("false"), "article")).first()
    assert none["article_count"] == 0 and none["defects"] == 0 and not none["metrics"]


def test_language_names(spark):
    names = spark.createDataFrame([(v,) for v in (" German ", "DUT", "xx", "", None, "pt-BR")], "v string")
    assert [r[0] for r in names.select(language.normalized_code(F.col("v"))).collect()] == ["de", "nl", "xx", "", "", "pt"]
