"""How much a changed article needs a review, weighed from all that a run knows of it.

Evidence comes as tables with a row per event (a recovered figure, a repair, a
defect); each is reduced to a row per article by partial aggregates before any
join, and the weighing itself is a column expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ends the recovery of a figure, what leaves it open, what counts as done.
NO_SOURCE, NO_VISUAL = "source_pdf_unavailable", "source_visual_unavailable"
OPEN, DONE = ("unresolved", "asset_ready_patch_missed"), ("patched", "already_patched", "patched_duplicate_visuals")
MANDATORY_ORDER = ("high", "medium", "low", "auto_verified")


def _zero(c: str | Column) -> Column:
    return F.coalesce(c, F.lit(0))


def figure_evidence(recoveries: DataFrame, unavailable: DataFrame, article: str) -> DataFrame:
    """Per article: patched, no_visual, no_source, unresolved, sources.

    ``recoveries`` has article, status, plan_status, label, asset_status,
    recovery_source and terminal (evidence of its own that the source shows
    nothing); ``unavailable`` has article and label of figures that an audit
    found without a visual. What is unavailable in the source is settled before
    anything else counts, and labels that no recovery names count once each.
    """
    labels = unavailable.where(F.trim("label") != "").select(article, F.trim("label").alias("label")).distinct()
    r = recoveries.withColumn("label", F.trim(F.coalesce("label", F.lit(""))))
    r = r.join(labels.withColumn("_told", F.lit(True)), [article, "label"], "left")
    has = lambda c, *values: F.coalesce(F.col(c).isin(*values), F.lit(False))
    no_source = has("status", NO_SOURCE) | has("plan_status", NO_SOURCE)
    no_visual = ~no_source & (has("status", NO_VISUAL) | F.coalesce("terminal", F.lit(False)) | F.coalesce("_told", F.lit(False)))
    open_ = ~no_source & ~no_visual & has("status", *OPEN)
    rest = ~no_source & ~no_visual & ~open_
    count = lambda c: F.count(F.when(c, 1))
    found = r.groupBy(article).agg(
        count(rest & (has("asset_status", "ready") | has("status", *DONE))).alias("patched"),
        count(no_visual).alias("_shown"),
        count(no_source).alias("no_source"),
        count(open_).alias("unresolved"),
        F.sort_array(F.collect_set(F.when(rest & (F.col("recovery_source") != ""), F.col("recovery_source")))).alias("sources"),
    )
    seen = r.where(no_visual & (F.col("label") != "")).select(article, "label").distinct()
    unseen = labels.join(seen, [article, "label"], "left_anti").groupBy(article).agg(F.count("*").alias("_unseen"))
    both = found.join(unseen, article, "full")
    return both.select(article, _zero("patched").alias("patched"), (_zero("_shown") + _zero("_unseen")).alias("no_visual"), _zero("no_source").alias("no_source"), _zero("unresolved").alias("unresolved"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"))


def repair_evidence(repairs: DataFrame, article: str) -> DataFrame:
    """Per article: whether it was patched, by which repairs, and how many failed. ``repairs`` has article, repair, patched and error."""
    ids = F.collect_set(F.when(F.col("repair") != "", F.col("repair")))
    return repairs.groupBy(article).agg(F.coalesce(F.bool_or("patched"), F.lit(False)).alias("patched"), F.sort_array(ids).alias("repair_ids"), F.count(F.when(F.col("error") != "", 1)).alias("errors"))


def change_sources(restored: Column, recovered: Column, figures: Column, repairs: Column) -> Column:
    """What explains a change, sorted."""
    if_any = lambda c, name: F.when(_zero(c) > 0, name)
    patched = F.coalesce(repairs["patched"], F.lit(False)) & (_zero(repairs["errors"]) == 0)
    named = F.when(patched, F.transform(repairs["repair_ids"], lambda r: F.concat(F.lit("polish_auto_repair:"), r)))
    own = F.array_compact(F.array(if_any(restored, "image_cache_restore"), if_any(recovered, "pdf_reference_recovery"), if_any(figures["patched"], "p62_image_recovery"), if_any(figures["no_visual"], "p62_source_visual_unavailable"), if_any(figures["no_source"], "p62_source_pdf_unavailable")))
    return F.array_sort(F.array_distinct(F.concat(own, F.coalesce(named, F.array().cast("array<string>")))))


def worsened(deltas: Column, lower_is_better: list[str]) -> Column:
    """The metrics that should not rise and did, with their deltas."""
    return F.map_filter(deltas, lambda k, v: k.isin(*lower_is_better) & (v > 0))


def review_risk(changed: Column, bucket: Column, worse: Column, defects: Column, observed: Column, counted: Column, broken_links: Column, missing_images: Column, mixed_style: Column, unresolved: Column, sources: Column) -> Column:
    """level, reasons, automatic.

    ``defects`` are all, ``observed`` those that aren't ignored, ``counted``
    those of them that count for quality. Anything that worsened, is broken or
    unresolved makes a high risk; a change with defects that don't count, or
    with mixed citations, a medium one; a change that its sources explain is
    verified; all else is low.
    """
    some = lambda c: _zero(c) > 0
    changed, mixed = F.coalesce(changed, F.lit(False)), F.coalesce(mixed_style, F.lit(False))
    grave = {
        "comparison_regression": F.coalesce(bucket == "regressions", F.lit(False)),
        "lower_is_better_metric_increase": some(F.cardinality(worse)),
        "non_ignored_quality_counted_audit_defects": some(counted),
        "broken_internal_links": some(broken_links),
        "missing_local_images": some(missing_images),
        "p62_unresolved_without_terminal_status": some(unresolved),
    }
    high = reduce(lambda a, b: a | b, grave.values())
    medium = changed & (some(observed) | some(defects) | mixed)
    same = F.coalesce(bucket == "unchanged", F.lit(False))
    verified = changed & same & some(F.cardinality(sources))
    fine = changed & (same | F.coalesce(bucket == "improvements", F.lit(False)))
    named = lambda pairs: F.array_sort(F.array_compact(F.array(*[F.when(c, n) for n, c in pairs.items()])))
    mild = {"observed_non_quality_or_telemetry_defects": some(observed), "ignored_defects_only": ~some(observed) & some(defects), "mixed_citation_style_present": mixed}
    one = lambda name: F.array(F.lit(name))
    level = F.when(high, "high").when(medium, "medium").when(verified, "auto_verified").otherwise("low")
    reasons = F.when(high, named(grave)).when(medium, named(mild)).when(verified, one("changed_without_quality_delta_explained")).when(fine, one("changed_without_quality_regression")).otherwise(one("unchanged_or_not_review_required"))
    return F.struct(level.alias("level"), reasons.alias("reasons"), (changed & level.isin("auto_verified", "low")).alias("automatic"))


def queue_order(mandatory: str, level: str, score: str, observed: str, defects: str, article: str) -> list[Column]:
    """Reviews that are a must first, then by risk, score, defects and article."""
    rank = F.coalesce(*[F.when(F.col(level) == r, i) for i, r in enumerate(MANDATORY_ORDER)], F.lit(len(MANDATORY_ORDER)))
    return [F.desc(mandatory), rank.asc(), F.desc(score), F.desc(observed), F.desc(defects), F.asc(article)]
