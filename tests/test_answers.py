"""Answer parsing, ranking, recommendations, reports."""

import json
import re

import pytest

from caselore.operators import answers as ans
from caselore.operators import insights as ins
from caselore.operators import reports as rep

ANSWER = "analysis_id string, product_id string, query_no int, query string, response string, payload string"


def answer(spark, *payloads, response="text"):
    return spark.createDataFrame(
        [("A", "P", i + 1, "q", response, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], ANSWER)


def test_gap_defaults(spark):
    row = ans.parse_gaps(answer(spark, [{}])).first()
    assert (row["frequency"], row["impact"], row["customer_solvable"]) == (1, 5, False)
    assert (row["problem_area"], row["related_cases"], row["related_paths"]) == ("", [], [])


def test_gap_values(spark):
    payload = [{"problemArea": "p", "frequencyInCases": 2.5, "customerSolvable": True, "estimatedImpact": "8",
                "relatedCaseNumbers": ["1", "2"], "extra": 1}, {"frequencyInCases": 3.5, "estimatedImpact": None}]
    first, second = sorted(ans.parse_gaps(answer(spark, payload)).collect(), key=lambda r: r["item_no"])
    assert (first["frequency"], first["impact"], first["related_cases"]) == (2, 8, ["1", "2"])
    assert (second["frequency"], second["impact"]) == (4, 5)
    assert first["gap_id"] != second["gap_id"]


@pytest.mark.parametrize("payload", ["not json", '{"problemArea": "a"}', ""])
def test_unreadable_gap_answers(spark, payload):
    found = answer(spark, payload)
    assert ans.parse_gaps(found).isEmpty()
    assert ans.answer_failures(found, answer(spark, {"failureModes": []})).count() == 1


def test_blank_response_is_skipped(spark):
    found = answer(spark, [{}], response=" \n")
    assert ans.parse_gaps(found).isEmpty()
    assert ans.answer_failures(found, answer(spark, "x", response="")).isEmpty()


def test_fmea_defaults_and_optional_parts(spark):
    found = answer(spark, {"failureModes": [{}]}, {"preventionOpportunities": [{}]}, "[1]", "{broken")
    row = ans.high_risk(ans.parse_failure_modes(found)).first()
    assert (row["rpn"], row["risk_level"], row["immediate_action"]) == (125, "High", "Review and assess")
    opportunity = ans.parse_prevention(found).first()
    assert (opportunity["query_no"], opportunity["customer_actionable"], opportunity["content_needed"]) == (2, False, "")
    assert {r["query_no"] for r in ans.answer_failures(answer(spark, []), found).collect()} == {3, 4}


def modes(spark, ratings):
    return ans.parse_failure_modes(answer(spark, {"failureModes": [
        {"failureMode": f"m{i}", "severityRating": s, "occurrenceFrequency": o, "detectabilityRating": d, "recommendedActions": ["do"]}
        for i, (s, o, d) in enumerate(ratings)]}))


def test_risk_levels(spark):
    found = modes(spark, [(10, 10, 1), (101, 1, 1), (10, 10, 2), (201, 1, 1)])
    assert {r["rpn"]: r["risk_level"] for r in ans.high_risk(found).collect()} == {101: "High", 200: "High", 201: "Critical"}


def test_recommendations(spark):
    gaps = ans.parse_gaps(answer(spark, [{"customerSolvable": i != 1, "suggestedTitle": f"t{i}", "estimatedImpact": i + 2}
                                         for i in range(8)]))
    risks = ans.high_risk(modes(spark, [(10, 5, 5)] * 4))
    rows = sorted(ans.recommendations(gaps, risks).collect(), key=lambda r: r["seq"])
    assert [r["title"] for r in rows] == [f"Create t{i}" for i in (0, 2, 3, 4, 5)] + [f"Implement controls for m{i}" for i in range(3)]
    assert [r["priority"] for r in rows] == ["Low", "Low", "Medium", "Medium", "Medium", "Critical", "Critical", "Critical"]
    assert rows[-1]["impact"] == 2


def ordered(lines):
    return [r["text"] for r in sorted(lines.collect(), key=lambda r: tuple(r[c] for c in rep.ORDER))]


def test_gap_report_text(spark):
    gaps = ans.parse_gaps(answer(spark, [
        {"suggestedTitle": "low", "estimatedImpact": 2}, {"suggestedTitle": "top", "estimatedImpact": 9,
         "customerSolvable": True, "relatedCaseNumbers": list("1234567"), "relatedSAPPaths": ["a", "b"]},
        {"suggestedTitle": "low too", "estimatedImpact": 2}]))
    analyses = spark.createDataFrame([("A", "P")], "analysis_id string, product_id string")
    text = ordered(rep.gap_report(analyses, gaps))
    assert text[:12] == ["# Self-Help Gap Analysis Report", "", "## Identified Gaps", "### top", "- **Problem Area:** ",
                         "- **Category:** ", "- **Frequency:** 1 cases", "- **Customer Solvable:** Yes",
                         "- **Estimated Impact:** 9/10", "- **Related Cases:** 1, 2, 3, 4, 5", "- **SAP Paths:** a, b", ""]
    assert [t for t in text if t.startswith("###")] == ["### top", "### low", "### low too"]


def test_empty_analysis_still_has_report_heads(spark):
    analyses = spark.createDataFrame([("A", "P")], "analysis_id string, product_id string")
    none = ans.parse_gaps(answer(spark, []))
    assert ordered(rep.gap_report(analyses, none)) == ["# Self-Help Gap Analysis Report", "", "## Identified Gaps"]


def test_recommendation_report_groups(spark):
    gaps = ans.parse_gaps(answer(spark, [{"customerSolvable": True, "suggestedTitle": f"t{i}", "estimatedImpact": i} for i in (3, 9, 3)]))
    recs = ans.recommendations(gaps, ans.high_risk(modes(spark, [(10, 10, 10)])))
    analyses = spark.createDataFrame([("A", "P")], "analysis_id string, product_id string")
    heads = [t for t in ordered(rep.recommendation_report(analyses, recs)) if t.startswith("##")]
    assert heads == ["## Self-Help Content Creation", "### Create t9", "### Create t3", "### Create t3",
                     "## Risk Mitigation", "### Implement controls for m0"]


def test_gap_case_check(spark):
    gaps = ans.parse_gaps(answer(spark, [{"relatedCaseNumbers": ["1", "2", "9"]}, {"relatedCaseNumbers": ["1"]}, {}]))
    cases = spark.createDataFrame([("1", "3"), ("2", "2")], "case_id string, sr_severity string")
    rows = ins.gap_case_check(gaps, cases).join(gaps.select("gap_id", "item_no"), "gap_id").collect()
    assert {r["item_no"]: (r["cited"], r["found"], r["confirmed"], r["severity_level"]) for r in rows} == {
        0: (3, 2, True, "2"), 1: (1, 1, False, "3"), 2: (0, 0, False, "")}


def test_a_case_cited_twice_is_one_case(spark):
    gaps = ans.parse_gaps(answer(spark, [{"relatedCaseNumbers": ["1", "1"]}]))
    cases = spark.createDataFrame([("1", "3"), ("1", "2")], "case_id string, sr_severity string")
    row = ins.gap_case_check(gaps, cases).first()
    assert (row["cited"], row["found"], row["confirmed"], row["severity_level"]) == (1, 1, False, "2")


def test_cited_cases_are_dealt_by_case_alone(spark):
    """Gaps that come twice, lists with nulls and no list; a row per cited case is dealt to its case, and not before that by gap too."""
    gaps = spark.createDataFrame([("A", "g", ["1", None, "1"]), ("A", "g", ["1", "2"]), ("A", "h", None), ("B", "g", [None]), (None, "g", ["9"])],
                                 "analysis_id string, gap_id string, related_cases array<string>")
    cases = spark.createDataFrame([("1", "3"), ("2", None), (None, "1")], "case_id string, sr_severity string")
    checked = ins.gap_case_check(gaps, cases)
    assert {(r["analysis_id"], r["gap_id"]): (r["cited"], r["found"], r["severity_level"]) for r in checked.collect()} == {
        ("A", "g"): (2, 2, ""), ("A", "h"): (0, 0, ""), ("B", "g"): (0, 0, ""), (None, "g"): (1, 0, "")}
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(analysis_id#\d+, gap_id#\d+, case_id#\d+", plan)


def test_ratings_too_large_to_multiply(spark):
    payload = {"failureModes": [{"severityRating": 2000, "occurrenceFrequency": 2000, "detectabilityRating": 2000}, {}]}
    found = answer(spark, payload, {"failureModes": [{}]})
    assert sorted((r["rpn"] for r in ans.parse_failure_modes(found).collect()), key=str) == [125, 125, None]
    assert [r["query_no"] for r in ans.answer_failures(answer(spark, []), found).collect()] == [1]


def test_community_report_rating_range(spark):
    df = spark.createDataFrame([("c", json.dumps({"title": "t", "rating": r, "findings": [{"summary": "s", "explanation": "e"}]}))
                                for r in (0, 10, 10.5, -1)], "component string, report_json string")
    assert [r["rating"] for r in ins.community_insights(df).collect()] == [0.0, 10.0, None, None]
    assert ins.community_insights(df).first()["key_findings"] == ["s"]


def test_modes_without_rpn_play_no_part_in_the_risk(spark):
    modes = spark.createDataFrame([("A", None), ("A", 200), ("B", None)], "analysis_id string, rpn long")
    known = spark.createDataFrame([("A",), ("B",), ("C",)], "analysis_id string")
    assert {r["analysis_id"]: r["risk_score"] for r in ins.risk_score(modes, known).collect()} == {"A": 20.0, "B": 0.0, "C": 0.0}


def test_sketches_of_runs_are_united(spark):
    rows = [(run, "A", "CASE_PROBLEM", "CASE_SOURCE", "slow", f"c{k}") for run in range(3) for k in range(run * 500, run * 500 + 1000)]
    seen = spark.createDataFrame(rows, "run int, analysis_id string, type string, marker string, name string, case_id string")
    united = ins.merged_problem_frequency(ins.problem_sketches(seen, "run")).first()
    assert abs(united["estimate"] - 2000) <= 40  # 2 in 100; a register count of 2 ** 14 errs by 0.8 in 100 as a rule
