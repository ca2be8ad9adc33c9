"""The five reports as line tables, and the result records.

A line is (analysis_id, report, section_no, rank_key, query_no, item_no, line_no, text); the
columns after report, ascending, are the order of the lines. Keeping the sort keys instead of
a running number means that no window has to see a whole report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.functions.text import fixed_1, percent_1, stamp, yes_no
from caselore.functions.vocabulary import RECORD_TTL_SECONDS
from caselore.operators.answers import ARRIVAL, by_category, first_k

ORDER = ["section_no", "rank_key", "query_no", "item_no", "line_no", "text"]
A = "analysis_id"


def _say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _lines(rows: DataFrame, report: str, section: int | Column, texts: list[Column], rank_key: Column | None = None,
           query_no: Column | None = None, item_no: Column | None = None) -> DataFrame:
    """One row per text; a null text is no line."""
    zero = F.lit(0)
    return rows.select(
        A, F.lit(report).alias("report"),
        (F.lit(section) if isinstance(section, int) else section).cast("int").alias("section_no"),
        (zero if rank_key is None else rank_key).cast("long").alias("rank_key"),
        (zero if query_no is None else query_no).cast("int").alias("query_no"),
        (zero if item_no is None else item_no).cast("int").alias("item_no"),
        F.posexplode(F.array_compact(F.array(*texts))).alias("line_no", "text"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def summary_rows(analyses: DataFrame, gaps: DataFrame, risks: DataFrame, recs: DataFrame,
                 scores: DataFrame | None = None) -> DataFrame:
    """analyses with the counts of gaps, high risks and recommendations."""
    out = analyses
    for rows, name in ((gaps, "n_gaps"), (risks, "n_risks"), (recs, "n_recs")):
        out = out.join(rows.groupBy(A).agg(F.count("*").alias(name)), A, "left")
    out = out.na.fill(0, ["n_gaps", "n_risks", "n_recs"])
    if scores is None:
        return out.withColumn("coverage_score", F.lit(0.0))
    return out.join(scores.select(A, "coverage_score"), A, "left").na.fill(0.0, ["coverage_score"])


def executive_summary(summary: DataFrame, gaps: DataFrame, risks: DataFrame, now: Column,
                      engine_label: str = "") -> DataFrame:
    """summary: summary_rows with product_id and n_cases."""
    name = "executive_summary"
    c = F.col
    # Report lines.
    head = [
        _say(f"# Executive Summary - {engine_label}Analysis"),
        _say("**Product ID:** ", c("product_id")),
        _say("**Analysis Date:** ", stamp(now)),
        _say("**Cases Analyzed:** ", c("n_cases")),
        F.lit(""),
        F.lit("## Key Findings"),
        _say("- **Self-Help Gaps Identified:** ", c("n_gaps")),
        _say("- **High-Risk Failure Modes:** ", c("n_risks")),
        _say("- **Actionable Recommendations:** ", c("n_recs")),
        _say("- **Overall Coverage Score:** ", percent_1(c("coverage_score"))),
        F.lit(""),
        F.lit("## Top 5 Self-Help Content Gaps"),
    ]
    gap = [_say("1. **", c("suggested_title"), "** - ", c("frequency"), " cases, Impact: ", c("impact"), "/10")]
    risk = [_say("1. **", c("failure_mode"), "** - RPN: ", c("rpn"), ", Risk: ", c("risk_level"))]
    return _union([
        _lines(summary, name, 0, head),
        _lines(first_k(gaps, 5), name, 1, gap, query_no=c("query_no"), item_no=c("item_no")),
        _lines(summary, name, 2, [F.lit(""), F.lit("## Top 5 High-Risk Failure Modes")]),
        _lines(first_k(risks, 5), name, 3, risk, query_no=c("query_no"), item_no=c("item_no")),
    ])


def gap_report(analyses: DataFrame, gaps: DataFrame) -> DataFrame:
    name, c = "selfhelp_gaps", F.col
    # Report lines.
    head = [F.lit("# Self-Help Gap Analysis Report"), F.lit(""), F.lit("## Identified Gaps")]
    item = [
        _say("### ", c("suggested_title")),
        _say("- **Problem Area:** ", c("problem_area")),
        _say("- **Category:** ", c("issue_category")),
        _say("- **Frequency:** ", c("frequency"), " cases"),
        _say("- **Customer Solvable:** ", yes_no(c("customer_solvable"))),
        _say("- **Estimated Impact:** ", c("impact"), "/10"),
        F.when(F.size("related_cases") > 0,
               _say("- **Related Cases:** ", F.array_join(F.slice("related_cases", 1, 5), ", "))),
        F.when(F.size("related_paths") > 0, _say("- **SAP Paths:** ", F.array_join("related_paths", ", "))),
        F.lit(""),
    ]
    return _union([
        _lines(analyses, name, 0, head),
        _lines(gaps, name, 1, item, -c("impact"), c("query_no"), c("item_no")),
    ])


def fmea_report(analyses: DataFrame, risks: DataFrame, prevention: DataFrame) -> DataFrame:
    name, c = "fmea_analysis", F.col
    # Report lines.
    head = [F.lit("# FMEA Analysis Report"), F.lit(""), F.lit("## High-Risk Items")]
    risk = [
        _say("### ", c("failure_mode")),
        _say("- **Risk Priority Number:** ", c("rpn")),
        _say("- **Risk Level:** ", c("risk_level")),
        _say("- **Immediate Action:** ", c("immediate_action")),
        F.lit(""),
    ]
    opportunity = [
        _say("### ", c("failure_mode")),
        _say("- **Prevention Type:** ", c("prevention_type")),
        _say("- **Recommended Control:** ", c("recommended_control")),
        _say("- **Customer Actionable:** ", yes_no(c("customer_actionable"))),
        F.when(c("content_needed") != "", _say("- **Self-Help Content Needed:** ", c("content_needed"))),
        F.lit(""),
    ]
    return _union([
        _lines(analyses, name, 0, head),
        _lines(risks, name, 1, risk, -c("rpn"), c("query_no"), c("item_no")),
        _lines(analyses, name, 2, [F.lit("## Prevention Opportunities")]),
        _lines(prevention, name, 3, opportunity, None, c("query_no"), c("item_no")),
    ])


def recommendation_report(analyses: DataFrame, recs: DataFrame) -> DataFrame:
    """Categories in order of first appearance, impact descending inside."""
    name, c = "actionable_recommendations", F.col
    grouped = by_category(recs)
    # Report lines.
    head = [F.lit("# Actionable Recommendations Report"), F.lit("")]
    item = [
        _say("### ", c("title")),
        _say("- **Priority:** ", c("priority")),
        _say("- **Estimated Impact:** ", c("impact"), "/10"),
        _say("- **Description:** ", c("description")),
        _say("- **Expected Outcome:** ", c("expected_outcome")),
        F.lit(""),
    ]
    titles = grouped.select(A, "category", "group_seq").distinct()
    return _union([
        _lines(analyses, name, 0, head),
        _lines(titles, name, c("group_seq") * 2, [_say("## ", c("category"))]),
        _lines(grouped, name, c("group_seq") * 2 + 1, item, -c("impact"), None, c("seq")),
    ])


def detailed_report(metrics: DataFrame, distribution: DataFrame) -> DataFrame:
    """metrics: analysis_id, minutes, n_entities, n_relations, n_communities; distribution: type, mentions."""
    name, c = "detailed_analysis", F.col
    # Report lines.
    head = [
        F.lit("# Detailed Analysis Report"), F.lit(""), F.lit("## Processing Metrics"),
        _say("- **Total Processing Time:** ", fixed_1(c("minutes")), " minutes"),
        _say("- **Entities Extracted:** ", c("n_entities")),
        _say("- **Relationships Found:** ", c("n_relations")),
        _say("- **Communities Identified:** ", c("n_communities")),
        F.lit(""), F.lit("## Entity Distribution"),
    ]
    item = [_say("- **", c("type"), ":** ", c("mentions"))]
    # ties go by the text of the line
    return _union([
        _lines(metrics, name, 0, head),
        _lines(distribution, name, 1, item, -c("mentions")),
    ])


# --- result records -----------------------------------------------------------------------

def _listed(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """The rows of an analysis as one array in arrival order.

    An analysis is eight bounded answers, so the array is bounded too.
    """
    item = F.struct(*[F.col(f) for f in fields])
    order = F.struct(*[F.col(k) for k in (ARRIVAL if "query_no" in rows.columns else ["seq"])])
    gathered = F.sort_array(F.collect_list(F.struct(order.alias("o"), item.alias("i"))))
    return rows.groupBy(A).agg(F.transform(gathered, lambda x: x["i"]).alias(name))


def document_record(summary: DataFrame, gaps: DataFrame, risks: DataFrame, recs: DataFrame, metrics: DataFrame,
                    now: Column) -> DataFrame:
    """One nested record per analysis."""
    gap_list = _listed(gaps, "selfHelpGaps", "gap_id", "problem_area", "frequency", "customer_solvable", "impact",
                       "suggested_title", "related_cases", "related_paths")
    risk_list = _listed(risks, "fmeaHighRiskItems", "failure_mode", "rpn", "risk_level", "immediate_action")
    rec_list = _listed(recs, "recommendations", "recommendation_id", "category", "title", "priority", "impact")
    return (
        summary.join(gap_list, A, "left").join(risk_list, A, "left").join(rec_list, A, "left").join(metrics, A, "left")
        .select(
            F.col(A).alias("id"), F.col("product_id").alias("productId"), now.alias("analysisTimestamp"),
            F.col("n_cases").alias("totalCasesAnalyzed"),
            *[F.coalesce(n, F.array()).alias(n) for n in ("selfHelpGaps", "fmeaHighRiskItems", "recommendations")],
            F.struct(F.coalesce("n_entities", F.lit(0)).alias("totalEntitiesExtracted"),
                     F.coalesce("n_relations", F.lit(0)).alias("totalRelationshipsFound"),
                     F.coalesce("minutes", F.lit(0.0)).alias("processingTimeMinutes")).alias("metrics"),
            F.lit(RECORD_TTL_SECONDS).alias("ttl")))


def metrics_record(summary: DataFrame, metrics: DataFrame, risk_scores: DataFrame, now: Column) -> DataFrame:
    """Nine flat columns per analysis."""
    return summary.join(metrics, A, "left").join(risk_scores, A, "left").select(
        A, "product_id", now.alias("analysis_timestamp"), F.col("n_cases").alias("total_cases"),
        F.coalesce("n_entities", F.lit(0)).alias("total_entities"),
        F.coalesce("n_relations", F.lit(0)).alias("total_relationships"),
        F.coalesce("minutes", F.lit(0.0)).alias("processing_minutes"),
        "coverage_score", F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"))


def callback_summary(summary: DataFrame, gaps: DataFrame, risks: DataFrame) -> DataFrame:
    """Status row per analysis with the first five gap titles and failure modes."""
    def top(rows: DataFrame, field: str, name: str) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct("place", field)))
        return first_k(rows, 5).groupBy(A).agg(F.transform(ordered, lambda x: x[field]).alias(name))

    empty = F.array().cast("array<string>")
    return (summary.join(top(gaps, "suggested_title", "top_gaps"), A, "left")
            .join(top(risks, "failure_mode", "top_risks"), A, "left")
            .select(F.lit("Success").alias("status"), A, "product_id", F.col("n_cases").alias("total_cases"),
                    F.coalesce("top_gaps", empty).alias("top_gaps"), F.coalesce("top_risks", empty).alias("top_risks"),
                    F.col("n_recs").alias("recommendations")))


def _in_order(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """The rows of an analysis as one array in the order of their fields."""
    return rows.groupBy(A).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def _counts(rows: DataFrame, name: str, key: str, value: str) -> DataFrame:
    return rows.groupBy(A).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias(name))


def analysis_result(summary: DataFrame, gaps: DataFrame, failure_modes: DataFrame, risks: DataFrame,
                    prevention: DataFrame, recs: DataFrame, metrics: DataFrame, distribution: DataFrame,
                    coverage: DataFrame, needs: DataFrame, detection: DataFrame, risk_score: DataFrame, issues: DataFrame,
                    gap_check: DataFrame, now: Column) -> DataFrame:
    """The whole nested result, one row per analysis."""
    severities = gap_check.select(A, "gap_id", "severity_level", "confirmed")
    parts = [
        _listed(gaps.join(severities, [A, "gap_id"], "left"), "gaps", "gap_id", "problem_area", "issue_category", "frequency",
                "severity_level", "confirmed", "customer_solvable", "suggested_title", "impact", "related_cases", "related_paths"),
        _in_order(coverage, "existing_coverage", "topic", "covered_issues", "quality", "needs_update"),
        _listed(needs, "needs", "suggested_title"),
        _listed(failure_modes, "failure_modes", "failure_mode", "failure_cause", "failure_effect", "severity",
                "occurrence", "detectability", "rpn", "existing_controls", "recommended_actions"),
        _listed(risks, "high_risk_items", "failure_mode", "rpn", "risk_level", "immediate_action"),
        _listed(prevention, "prevention_opportunities", "failure_mode", "prevention_type", "recommended_control",
                "customer_actionable", "content_needed"),
        _in_order(detection, "detection_gaps", "failure_mode", "current_method", "recommendation"),
        risk_score,
        _listed(recs, "recommendations", "recommendation_id", "category", "title", "description", "priority",
                "impact", "action_owner", "expected_outcome"),
        _counts(distribution, "entity_types", "type", "mentions"),
        _counts(issues, "issue_distribution", "issue_category", "cases"),
        metrics,
    ]
    out = summary
    for part in parts:
        out = out.join(part, A, "left")
    titles = F.transform("needs", lambda x: x["suggested_title"]).alias("high_priority_needs")
    return out.select(
        A, "product_id", now.alias("analysis_timestamp"), "n_cases",
        F.struct("gaps", "existing_coverage", "coverage_score", titles).alias("selfhelp_gaps"),
        F.struct("failure_modes", "high_risk_items", "prevention_opportunities", "detection_gaps", "risk_score").alias("fmea"),
        "recommendations",
        F.struct("n_entities", "n_relations", "n_communities", "minutes", "entity_types", "issue_distribution").alias("metrics"))
