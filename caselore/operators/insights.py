"""Coverage, controls, risk and frequency figures from gaps, failure modes and the graph.

`per P` of the survey is analysis_id here. Edges and mentions are reduced to distinct pairs
before they are joined, so a pair that is repeated often does not travel often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.functions import vocabulary as V

A = "analysis_id"


def _edges(relations: DataFrame, *types: str) -> DataFrame:
    return relations.filter(F.col("type").isin(*types))


def case_problems(entities: DataFrame) -> DataFrame:
    """Distinct case problems (marked as coming from a case)."""
    return (entities.filter((F.col("type") == "CASE_PROBLEM") & (F.col("marker") == "CASE_SOURCE"))
            .select(A, F.col("name").alias("problem")).distinct())


def uncovered_problems(entities: DataFrame, relations: DataFrame) -> DataFrame:
    covered = _edges(relations, "COVERED_BY", "PARTIALLY_COVERED_BY").select(A, F.col("source").alias("problem")).distinct()
    return case_problems(entities).join(covered, [A, "problem"], "left_anti")


def coverage(relations: DataFrame) -> DataFrame:
    """Per topic: covered issues, quality, whether it needs an update."""
    pairs = (_edges(relations, "COVERED_BY", "PARTIALLY_COVERED_BY")
             .groupBy(A, F.col("target").alias("topic"), F.col("source").alias("issue"))
             .agg(F.bool_or(F.col("type") == "PARTIALLY_COVERED_BY").alias("partial")))
    return (pairs.groupBy(A, "topic")
            .agg(F.sort_array(F.collect_set("issue")).alias("covered_issues"), F.bool_or("partial").alias("needs_update"))
            .withColumn("quality", F.when(F.col("needs_update"), "Partial").otherwise("Full")))


def coverage_score(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(covered + half of the only partially covered) / all case problems, per analysis."""
    state = (_edges(relations, "COVERED_BY", "PARTIALLY_COVERED_BY")
             .groupBy(A, F.col("source").alias("problem"))
             .agg(F.bool_or(F.col("type") == "COVERED_BY").alias("full")))
    share = F.when(F.col("full"), 1.0).when(~F.col("full"), 0.5).otherwise(0.0)
    return (case_problems(entities).join(state, [A, "problem"], "left")
            .groupBy(A).agg(F.count("*").alias("n_problems"), F.round(F.sum(share) / F.count("*"), 6).alias("coverage_score")))


def high_priority_needs(gaps: DataFrame) -> DataFrame:
    return gaps.filter(F.col("impact") > 7).select(A, "query_no", "item_no", "suggested_title")


def detection_gaps(failure_modes: DataFrame, relations: DataFrame) -> DataFrame:
    detected = _edges(relations, "DETECTS").select(A, F.col("target").alias("failure_mode")).distinct()
    return (failure_modes.select(A, "failure_mode").distinct().join(detected, [A, "failure_mode"], "left_anti")
            .select(A, "failure_mode", F.lit("").alias("current_method"),
                    F.lit("No detection control").alias("recommendation")))


def control_gaps(relations: DataFrame) -> DataFrame:
    """Failure modes with an effect but without prevention; whether a customer could prevent them."""
    kinds = relations.filter(F.col("type").isin("RESULTS_IN", "PREVENTS", "PREVENTABLE_BY_CUSTOMER")).select(
        A, F.when(F.col("type") == "PREVENTS", F.col("target")).otherwise(F.col("source")).alias("failure_mode"), "type")
    return (kinds.groupBy(A, "failure_mode")
            .agg(F.bool_or(F.col("type") == "RESULTS_IN").alias("has_effect"),
                 F.bool_or(F.col("type") == "PREVENTS").alias("prevented"),
                 F.bool_or(F.col("type") == "PREVENTABLE_BY_CUSTOMER").alias("preventable_by_customer"))
            .filter("has_effect AND NOT prevented").select(A, "failure_mode", "preventable_by_customer"))


def risk_score(failure_modes: DataFrame, analyses: DataFrame) -> DataFrame:
    """A tenth of the mean rpn; modes without one play no part."""
    # decimal, so that halves round up whatever their binary form is
    mean = F.sum("rpn").cast("decimal(20,0)") / F.count("rpn")
    scored = failure_modes.groupBy(A).agg(F.round(mean / 10, 2).cast("double").alias("risk_score"))
    return analyses.select(A).distinct().join(scored, A, "left").select(A, F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"))


def gap_case_check(gaps: DataFrame, cases: DataFrame) -> DataFrame:
    """Per gap: cited cases, how many exist, whether at least two do, and the worst severity.

    A case that a gap cites twice, or that has several rows, is one case. The cases of a gap are made distinct as a list, so
    that a row per cited case travels only to the cases and back.
    """
    listed = F.array_distinct(F.flatten(F.collect_list(F.coalesce("related_cases", F.array()))))
    cited = gaps.groupBy(A, "gap_id").agg(listed.alias("cited_cases")).select(A, "gap_id", F.explode_outer("cited_cases").alias("case_id"))
    known = cases.groupBy("case_id").agg(F.min(F.coalesce("sr_severity", F.lit(""))).alias("found_severity"))
    return (cited.join(known, "case_id", "left").groupBy(A, "gap_id")
            .agg(F.count("case_id").cast("int").alias("cited"),
                 F.count("found_severity").cast("int").alias("found"),
                 F.coalesce(F.min("found_severity"), F.lit("")).alias("severity_level"))
            .withColumn("confirmed", F.col("found") >= 2))


def type_distribution(entities: DataFrame) -> DataFrame:
    return entities.groupBy(A, "type").agg(F.count("*").alias("mentions"))


def issue_distribution(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy(A, "issue_category").agg(F.sum("frequency").alias("cases"))


def problem_frequency(entities: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct cases per case problem."""
    count = F.approx_count_distinct("case_id") if approximate else F.count_distinct("case_id")
    return (entities.filter((F.col("type") == "CASE_PROBLEM") & (F.col("marker") == "CASE_SOURCE"))
            .groupBy(A, F.col("name").alias("problem")).agg(count.alias("cases")))


def problem_sketches(entities: DataFrame, *run: str) -> DataFrame:
    """(run columns, analysis, problem, sketch): a HyperLogLog sketch of the cases of a problem, to be kept per run."""
    return (entities.filter((F.col("type") == "CASE_PROBLEM") & (F.col("marker") == "CASE_SOURCE"))
            .groupBy(*run, A, F.col("name").alias("problem")).agg(F.hll_sketch_agg("case_id", 14).alias("sketch")))


def merged_problem_frequency(sketches: DataFrame) -> DataFrame:
    """Estimated distinct cases per problem from the stored sketches of any number of runs; a case of several counts once."""
    return sketches.groupBy(A, "problem").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def entity_insights(mentions: DataFrame, relations: DataFrame) -> DataFrame:
    """(type, name, frequency, related): number of distinct chunks, one row per related name, null if there is none.

    mentions: (type, term, doc_id, chunk_no); relations: (source, target). A name may have any number of related
    ones, so they are rows and never one list. Both inputs are read twice.
    """
    chunks = mentions.select("type", F.col("term").alias("name"), "doc_id", "chunk_no").distinct()
    frequency = chunks.groupBy("type", "name").agg(F.count("*").alias("frequency"))
    # a pair is made distinct once, in one order of its ends, and then seen from both of them
    turned = F.coalesce(F.col("source") > F.col("target"), F.col("target").isNull())
    ends = relations.select(F.when(turned, F.col("target")).otherwise(F.col("source")).alias("name"),
                            F.when(turned, F.col("source")).otherwise(F.col("target")).alias("related")).distinct()
    related = ends.unionByName(ends.filter(~F.col("name").eqNullSafe(F.col("related"))).select(
        F.col("related").alias("name"), F.col("name").alias("related")))
    alone = frequency.join(related.select("name").distinct(), "name", "left_anti").withColumn("related", F.lit(None).cast("string"))
    return (frequency.join(related, "name").select("type", "name", "frequency", "related")
            .unionByName(alone.select("type", "name", "frequency", "related")))


def relationship_insights(relations: DataFrame) -> DataFrame:
    return relations.groupBy(A, "source", "target", "type").agg(
        F.max("strength").alias("strength"), F.count("*").alias("mentions"))


def failure_chains(relations: DataFrame) -> DataFrame:
    """cause -> mode -> effect; parallel edges are rolled up before the join."""
    rolled = relationship_insights(relations.filter(F.col("type").isin("TRIGGERS", "RESULTS_IN")))
    causes = rolled.filter(F.col("type") == "TRIGGERS").select(
        A, F.col("source").alias("cause"), F.col("target").alias("failure_mode"), F.col("strength").alias("s1"))
    effects = rolled.filter(F.col("type") == "RESULTS_IN").select(
        A, F.col("source").alias("failure_mode"), F.col("target").alias("effect"), F.col("strength").alias("s2"))
    return causes.join(effects, [A, "failure_mode"]).select(
        A, "cause", "failure_mode", "effect", F.least("s1", "s2").alias("strength"))


def gap_ranking(entities: DataFrame, relations: DataFrame, gaps: DataFrame, k: int = 5) -> DataFrame:
    """Frequent, customer-solvable problems without coverage, by cases x impact; top k per analysis."""
    areas = gaps.groupBy(A, F.upper("problem_area").alias("problem")).agg(
        F.bool_or("customer_solvable").alias("solvable"), F.max("impact").alias("impact"))
    rank = Window.partitionBy(A).orderBy(F.col("score").desc(), F.col("problem"))
    return (problem_frequency(entities).filter(F.col("cases") >= 2)
            .join(uncovered_problems(entities, relations), [A, "problem"])
            .join(areas.filter("solvable"), [A, "problem"])
            .withColumn("score", F.col("cases") * F.coalesce("impact", F.lit(V.DEFAULT_IMPACT)))
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select(A, "rank", "problem", "cases", "score"))


def community_stats(components: DataFrame, edges: DataFrame, entities: DataFrame, relations: DataFrame,
                    failure_modes: DataFrame) -> DataFrame:
    """Per component: nodes, edges, case problems, uncovered problems, greatest RPN, priority.

    components: (analysis_id, node, component), node being '<analysis_id>/<name>'.
    """
    def node(name: Column) -> Column:
        return F.concat(F.col(A), F.lit("/"), name)

    problems = case_problems(entities).select(node(F.col("problem")).alias("node"), F.lit(1).alias("is_problem"))
    open_ = uncovered_problems(entities, relations).select(node(F.col("problem")).alias("node"), F.lit(1).alias("is_open"))
    risk = failure_modes.groupBy(A, "failure_mode").agg(F.max("rpn").alias("rpn")).select(
        node(F.col("failure_mode")).alias("node"), "rpn")
    per_edge = (edges.select(F.col("src").alias("node"), "dst").distinct().groupBy("node").agg(F.count("*").alias("out_edges")))
    marked = (components.join(problems, "node", "left").join(open_, "node", "left")
              .join(risk, "node", "left").join(per_edge, "node", "left"))
    return marked.groupBy(A, "component").agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("out_edges"), F.lit(0)).alias("edges"),
        F.count("is_problem").alias("case_problems"),
        F.count("is_open").alias("uncovered"),
        F.coalesce(F.max("rpn"), F.lit(0)).alias("max_rpn"),
        F.round(F.coalesce(F.max("rpn"), F.lit(0)) / 100, 1).alias("priority"))


COMMUNITY_SCHEMA = ("struct<title string, summary string, rating double, rating_explanation string,"
                    " findings array<struct<summary string, explanation string>>>")


def community_insights(reports: DataFrame) -> DataFrame:
    """Report JSON to columns; a rating outside 0..10 becomes null."""
    r = F.from_json("report_json", COMMUNITY_SCHEMA)
    return reports.withColumn("r", r).select(
        "component", F.col("r.title").alias("title"), F.col("r.summary").alias("description"),
        F.when(F.col("r.rating").between(0, 10), F.col("r.rating")).alias("rating"),
        F.transform("r.findings", lambda f: f["summary"]).alias("key_findings"),
        F.transform("r.findings", lambda f: f["explanation"]).alias("actions"))
