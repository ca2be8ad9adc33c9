"""Structured answers: JSON texts to typed rows, risk ranking, recommendations.

Arrival order is (query_no, item_no); no window is needed to number it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.functions import vocabulary as V
from caselore.functions.text import has_text, priority_tier, short_id

ARRIVAL = ["query_no", "item_no"]

# Numbers and flags are read as text, since a typed read turns 2.5 and "3" into null.
GAP_SCHEMA = ("array<struct<problemArea string, issueCategory string, frequencyInCases string,"
              " customerSolvable string, suggestedTitle string, estimatedImpact string,"
              " relatedCaseNumbers array<string>, relatedSAPPaths array<string>>>")
FMEA_SCHEMA = ("struct<failureModes array<struct<failureMode string, failureCause string, failureEffect string,"
               " severityRating string, occurrenceFrequency string, detectabilityRating string,"
               " existingControls array<string>, recommendedActions array<string>>>,"
               " preventionOpportunities array<struct<failureMode string, preventionType string,"
               " recommendedControl string, customerActionable string, selfHelpContentNeeded string>>,"
               " _corrupt_record string>")


def _number(col: Column, default: int) -> Column:
    return F.coalesce(F.bround(col.try_cast("double"), 0).try_cast("int"), F.lit(default))


def _flag(col: Column) -> Column:
    return F.coalesce(col.try_cast("boolean"), F.lit(False))


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def _list(col: Column) -> Column:
    return F.coalesce(col, F.array().cast("array<string>"))


def _read_gaps(answers: DataFrame) -> DataFrame:
    """Answers with text; items is null where the payload is not a JSON array."""
    is_array = F.col("payload").rlike(r"^\s*\[")
    return answers.filter(has_text(F.col("response"))).withColumn(
        "items", F.when(is_array, F.from_json("payload", GAP_SCHEMA)))


def _read_fmea(answers: DataFrame) -> DataFrame:
    is_object = F.col("payload").rlike(r"^\s*\{")
    parsed = F.from_json("payload", FMEA_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return answers.filter(has_text(F.col("response"))).withColumn("doc", F.when(is_object, parsed)).withColumn(
        "doc", F.when(F.col("doc._corrupt_record").isNull(), F.col("doc")))


def parse_gaps(answers: DataFrame) -> DataFrame:
    g = F.col("g")
    rows = _read_gaps(answers).select("analysis_id", "product_id", "query_no", F.posexplode("items").alias("item_no", "g"))
    return rows.select(
        "analysis_id", "product_id", *ARRIVAL,
        short_id(F.col("analysis_id"), F.col("query_no").cast("string"), F.col("item_no").cast("string")).alias("gap_id"),
        _text(g["problemArea"]).alias("problem_area"),
        _text(g["issueCategory"]).alias("issue_category"),
        _number(g["frequencyInCases"], V.DEFAULT_FREQUENCY).alias("frequency"),
        _flag(g["customerSolvable"]).alias("customer_solvable"),
        _text(g["suggestedTitle"]).alias("suggested_title"),
        _number(g["estimatedImpact"], V.DEFAULT_IMPACT).alias("impact"),
        _list(g["relatedCaseNumbers"]).alias("related_cases"),
        _list(g["relatedSAPPaths"]).alias("related_paths"))


def _rpn(severity: Column, occurrence: Column, detectability: Column) -> Column:
    """Their product, null if it is no int."""
    return F.try_multiply(F.try_multiply(severity.cast("long"), occurrence.cast("long")), detectability.cast("long")).try_cast("int")


def _ratings(m: Column) -> list[Column]:
    return [_number(m[n], V.DEFAULT_RATING) for n in ("severityRating", "occurrenceFrequency", "detectabilityRating")]


def parse_failure_modes(answers: DataFrame) -> DataFrame:
    """Rows of failure modes; one whose ratings multiply to more than an int has no rpn and is in answer_failures."""
    m = F.col("m")
    rows = _read_fmea(answers).select(
        "analysis_id", "product_id", "query_no", F.posexplode("doc.failureModes").alias("item_no", "m"))
    severity, occurrence, detectability = _ratings(m)
    return rows.select(
        "analysis_id", "product_id", *ARRIVAL,
        _text(m["failureMode"]).alias("failure_mode"),
        _text(m["failureCause"]).alias("failure_cause"),
        _text(m["failureEffect"]).alias("failure_effect"),
        severity.alias("severity"), occurrence.alias("occurrence"), detectability.alias("detectability"),
        _list(m["existingControls"]).alias("existing_controls"),
        _list(m["recommendedActions"]).alias("recommended_actions"),
    ).withColumn("rpn", _rpn(F.col("severity"), F.col("occurrence"), F.col("detectability")))


def parse_prevention(answers: DataFrame) -> DataFrame:
    o = F.col("o")
    rows = _read_fmea(answers).select(
        "analysis_id", "product_id", "query_no", F.posexplode("doc.preventionOpportunities").alias("item_no", "o"))
    return rows.select(
        "analysis_id", "product_id", *ARRIVAL,
        _text(o["failureMode"]).alias("failure_mode"),
        _text(o["preventionType"]).alias("prevention_type"),
        _text(o["recommendedControl"]).alias("recommended_control"),
        _flag(o["customerActionable"]).alias("customer_actionable"),
        _text(o["selfHelpContentNeeded"]).alias("content_needed"))


def answer_failures(gap_answers: DataFrame, fmea_answers: DataFrame) -> DataFrame:
    """Answers whose payload could not be read, or has ratings that cannot be multiplied."""
    bad_gaps = _read_gaps(gap_answers).filter(F.col("items").isNull())
    too_large = F.exists("doc.failureModes", lambda m: _rpn(*_ratings(m)).isNull())
    bad_fmea = _read_fmea(fmea_answers).filter(F.col("doc").isNull() | F.coalesce(too_large, F.lit(False)))
    columns = ["analysis_id", "product_id", "query_no", "query"]
    return bad_gaps.select(*columns).unionByName(bad_fmea.select(*columns))


def high_risk(failure_modes: DataFrame) -> DataFrame:
    return failure_modes.filter(F.col("rpn") > V.HIGH_RISK_RPN).select(
        "analysis_id", "product_id", *ARRIVAL, "failure_mode", "rpn",
        F.when(F.col("rpn") > V.CRITICAL_RPN, "Critical").otherwise("High").alias("risk_level"),
        F.coalesce(F.get("recommended_actions", 0), F.lit("Review and assess")).alias("immediate_action"))


def first_k(rows: DataFrame, k: int) -> DataFrame:
    """The first k rows of every analysis by arrival; the rank filter also runs before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("analysis_id").orderBy(*ARRIVAL))
    return rows.withColumn("place", rank).filter(F.col("place") <= k)


def recommendations(gaps: DataFrame, risks: DataFrame, k_gaps: int = 5, k_risks: int = 3) -> DataFrame:
    """First customer-solvable gaps, then first risks, of every analysis. seq is the list order."""
    # Categories, owners and text templates.
    top_gaps = first_k(gaps.filter("customer_solvable"), k_gaps).select(
        "analysis_id", "product_id", F.col("place").cast("int").alias("seq"),
        F.lit("Self-Help Content Creation").alias("category"),
        F.concat(F.lit("Create "), "suggested_title").alias("title"),
        F.concat(F.lit("Address "), "problem_area", F.lit(" issues that appear in "),
                 F.col("frequency").cast("string"), F.lit(" cases")).alias("description"),
        priority_tier(F.col("impact")).alias("priority"), "impact",
        F.lit("Content Team").alias("action_owner"),
        F.concat(F.lit("Reduce support cases for "), "problem_area",
                 F.lit(" by enabling customer self-service")).alias("expected_outcome"))
    top_risks = first_k(risks.filter(F.col("rpn") > V.HIGH_RISK_RPN), k_risks).select(
        "analysis_id", "product_id", (F.col("place") + k_gaps).cast("int").alias("seq"),
        F.lit("Risk Mitigation").alias("category"),
        F.concat(F.lit("Implement controls for "), "failure_mode").alias("title"),
        F.col("immediate_action").alias("description"),
        F.col("risk_level").alias("priority"), F.expr("cast(rpn div 100 as int)").alias("impact"),
        F.lit("Engineering Team").alias("action_owner"),
        F.concat(F.lit("Reduce occurrence and impact of "), "failure_mode").alias("expected_outcome"))
    both = top_gaps.unionByName(top_risks)
    return both.withColumn("recommendation_id", short_id(F.col("analysis_id"), F.col("seq").cast("string")))


def by_category(recs: DataFrame) -> DataFrame:
    """Recommendations with group_seq, the first place of their category in the list."""
    groups = recs.groupBy("analysis_id", "category").agg(F.min("seq").alias("group_seq"))
    return recs.join(groups, ["analysis_id", "category"])
