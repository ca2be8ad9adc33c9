"""Named queries: each takes a session and a table directory and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselore.functions import text as X
from caselore.functions import vocabulary as V
from caselore.operators import answers as ans
from caselore.operators import cases as cs
from caselore.operators import changes as ch
from caselore.operators import communities as cm
from caselore.operators import components as comp
from caselore.operators import documents as docs
from caselore.operators import graph as gr
from caselore.operators import insights as ins
from caselore.operators import reports as rep
from caselore.operators import retrieval as ret
from caselore.operators import selfhelp as sh
from caselore.operators import threads as th
from caselore.operators import vector_index as vi
from caselore.session import freed_shuffles, scratch_path, widen
from caselore.sources import files as fs
from caselore.sources import mapping as mp
from caselore.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(*names: str) -> list[Column]:
    return [F.array_join(n, "|").alias(n) for n in names]


def _stamped(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: X.stamp(F.col(n)) for n in names})


# --- shared inputs ------------------------------------------------------------------------

def all_cases(spark: SparkSession, d: str, **params) -> DataFrame:
    return cs.closed_cases(mp.case_fact(spark, d), mp.area_dim(spark, d), mp.as_of(), **params)


def documents(spark: SparkSession, d: str) -> DataFrame:
    return docs.documents_of(all_cases(spark, d), mp.emails(spark, d), mp.notes(spark, d))


def documents_and_corpus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    found = documents(spark, d)
    return found, mp.prior_corpus(found)


def gaps_of(spark: SparkSession, d: str) -> DataFrame:
    return ans.parse_gaps(mp.gap_answers(spark, d))


def modes_of(spark: SparkSession, d: str) -> DataFrame:
    return ans.parse_failure_modes(mp.fmea_answers(spark, d))


def analyses(spark: SparkSession, d: str) -> DataFrame:
    return mp.parts(spark, d).select("analysis_id", "product_id").distinct()


def _case_counts(cases: DataFrame) -> DataFrame:
    return cases.groupBy("product_id").agg(F.count("*").alias("n_cases"))


class Stored(NamedTuple):
    """What the results and reports read many times, each stored once."""
    lines: DataFrame
    cases: DataFrame
    gaps: DataFrame
    modes: DataFrame
    risks: DataFrame
    recs: DataFrame


def stored_inputs(spark: SparkSession, d: str) -> Stored:
    gaps, modes = _kept(gaps_of(spark, d), "gaps"), _kept(modes_of(spark, d), "modes")
    risks = _kept(ans.high_risk(modes), "risks")
    return Stored(_kept(mp.lines_with_parts(spark, d).select(*mp.LINE_COLUMNS), "lines"),
                  _kept(all_cases(spark, d).select("product_id", "case_id", "sr_severity"), "cases"),
                  gaps, modes, risks, _kept(ans.recommendations(gaps, risks), "recommendations"))


def summary(spark: SparkSession, d: str, gaps: DataFrame, risks: DataFrame, recs: DataFrame, stored: Stored | None = None) -> DataFrame:
    """The counts of every analysis; with stored inputs, from them."""
    lines, cases = (stored.lines, stored.cases) if stored else (None, all_cases(spark, d))
    base = analyses(spark, d).join(_case_counts(cases), "product_id", "left").na.fill(0, ["n_cases"])
    scores = ins.coverage_score(mp.entity_mentions(spark, d, lines), mp.relations(spark, d, lines))
    return rep.summary_rows(base, gaps, risks, recs, scores)


def metrics(spark: SparkSession, d: str, communities: bool = False, stored: Stored | None = None) -> DataFrame:
    """With stored inputs, every count is stored as it is made: the shuffle files of one are gone before the next."""
    lines = stored.lines if stored else None

    def counts(rows: DataFrame, name: str) -> DataFrame:
        found = rows.groupBy("analysis_id").agg(F.count("*").alias(name))
        return _kept(found, name) if stored else found

    entities = mp.entity_mentions(spark, d, lines).select("analysis_id", "type", "name").distinct()
    relations = mp.relations(spark, d, lines).select("analysis_id", "source", "target", "type").distinct()
    took = mp.runs(spark, d, lines).select("analysis_id", X.minutes_between(F.col("finished_ts"), F.col("started_ts")).alias("minutes"))
    out = (analyses(spark, d).select("analysis_id").join(took, "analysis_id", "left")
           .join(counts(entities, "n_entities"), "analysis_id", "left")
           .join(counts(relations, "n_relations"), "analysis_id", "left"))
    if communities:
        found = component_rows(spark, d).select("analysis_id", "component").distinct()
        out = out.join(counts(found, "n_communities"), "analysis_id", "left")
    return out.na.fill(0)


def component_rows(spark: SparkSession, d: str) -> DataFrame:
    edges = mp.graph_edges(spark, d)
    return comp.connected_components(edges.select("src", "dst")).select(
        F.substring_index("node", "/", 1).alias("analysis_id"), "node", "component")


def doc_chunks(spark: SparkSession, d: str) -> DataFrame:
    return gr.chunks(widen(mp.table(spark, d, "documents").select("doc_id", "text")))


def parsed_records(spark: SparkSession, d: str) -> DataFrame:
    return gr.parse_records(mp.extraction_records(spark, d))


# --- cases --------------------------------------------------------------------------------

def _case_columns(df: DataFrame) -> DataFrame:
    return _stamped(df, "created_ts", "closed_ts", "first_assignment_ts")


@query
def closed_cases(spark: SparkSession, d: str) -> DataFrame:
    return _case_columns(all_cases(spark, d))


@query
def closed_cases_filtered(spark: SparkSession, d: str) -> DataFrame:
    return _case_columns(all_cases(spark, d, product_id="P1", max_age_days=1500))


@query
def cases_of_area(spark: SparkSession, d: str) -> DataFrame:
    """Area path given with the other kind of slash."""
    return _case_columns(all_cases(spark, d, sap_path="ASIA/NATION_17", max_age_days=-1))


@query
def newest_n_per_product(spark: SparkSession, d: str) -> DataFrame:
    return _case_columns(cs.newest_per_product(all_cases(spark, d), 10))


@query
def newest_many_per_product(spark: SparkSession, d: str) -> DataFrame:
    return _case_columns(cs.newest_per_product(all_cases(spark, d), cs.WINDOW_LIMIT + 1))


# --- threads ------------------------------------------------------------------------------

@query
def email_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = mp.emails(spark, d).filter(X.wanted_subject(F.col("subject")))
    return _stamped(kept.select("ticket_number", "created_ts", "subject"), "created_ts")


@query
def email_clean(spark: SparkSession, d: str) -> DataFrame:
    ids = th.requested_ids(all_cases(spark, d))
    return _stamped(th.email_pieces(mp.emails(spark, d), ids), "created_ts")


@query
def email_threads(spark: SparkSession, d: str) -> DataFrame:
    return th.threads(th.email_pieces(mp.emails(spark, d)))


@query
def email_first_k(spark: SparkSession, d: str) -> DataFrame:
    found = th.with_pieces(th.threads(th.email_pieces(mp.emails(spark, d))), 2)
    return found.select("case_id", "part_no", *_joined("pieces"))


@query
def note_latest(spark: SparkSession, d: str) -> DataFrame:
    return _stamped(th.latest_notes(mp.notes(spark, d)), "created_ts")


@query
def note_scrub_sequential(spark: SparkSession, d: str) -> DataFrame:
    return _stamped(th.note_pieces(mp.notes(spark, d)), "created_ts")


@query
def note_scrub_literal(spark: SparkSession, d: str) -> DataFrame:
    return _stamped(th.note_pieces(mp.notes(spark, d), mode="literal"), "created_ts")


@query
def note_threads(spark: SparkSession, d: str) -> DataFrame:
    return th.threads(th.note_pieces(mp.notes(spark, d)))


@query
def case_documents(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d)


# --- changes ------------------------------------------------------------------------------

@query
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return mp.table(spark, d, "documents").select("doc_id", X.content_hash(F.col("text")).alias("content_hash"))


@query
def stable_hash(spark: SparkSession, d: str) -> DataFrame:
    """Hashes that do not change with the age of a case."""
    return ch.with_hash(documents(spark, d), stable=True).select("product_id", "case_id", "part_no", "content_hash")


@query
def classify_changes(spark: SparkSession, d: str) -> DataFrame:
    return ch.classify_changes(*documents_and_corpus(spark, d))


@query
def change_stats(spark: SparkSession, d: str) -> DataFrame:
    found, corpus = documents_and_corpus(spark, d)
    return ch.change_stats(ch.classify_changes(found, corpus), corpus, mp.product_list(spark, d))


@query
def work_set_new_only(spark: SparkSession, d: str) -> DataFrame:
    return ch.work_set(*documents_and_corpus(spark, d), policy="new_only")


@query
def work_set_new_or_updated(spark: SparkSession, d: str) -> DataFrame:
    return ch.work_set(*documents_and_corpus(spark, d), policy="new_or_updated")


@query
def removed_cases(spark: SparkSession, d: str) -> DataFrame:
    found, corpus = documents_and_corpus(spark, d)
    recent = found.join(all_cases(spark, d, max_age_days=1500).select("case_id"), "case_id", "left_semi")
    return ch.removed_cases(recent, corpus)


@query
def corpus_upsert(spark: SparkSession, d: str) -> DataFrame:
    found, corpus = documents_and_corpus(spark, d)
    return ch.upsert_corpus(corpus, ch.work_set(found, corpus, "new_only"))


# --- self-help ----------------------------------------------------------------------------

def _selfhelp_diff(spark: SparkSession, d: str) -> DataFrame:
    return sh.selfhelp_diff(mp.selfhelp_files(spark, d), mp.selfhelp_tracking(spark, d))


def _selfhelp_corpus(spark: SparkSession, d: str) -> DataFrame:
    return sh.selfhelp_corpus(
        mp.selfhelp_files(spark, d), sh.selfhelp_sections(_selfhelp_diff(spark, d)),
        mp.selfhelp_existing(spark, d), mp.product_list(spark, d), mp.as_of())


@query
def selfhelp_changed(spark: SparkSession, d: str) -> DataFrame:
    return sh.selfhelp_changed(mp.selfhelp_files(spark, d), mp.selfhelp_tracking(spark, d), mp.product_list(spark, d))


@query
def selfhelp_diff(spark: SparkSession, d: str) -> DataFrame:
    return _selfhelp_diff(spark, d).select("product_id", "file_name", "status", "new_content")


@query
def selfhelp_sections(spark: SparkSession, d: str) -> DataFrame:
    return sh.selfhelp_sections(_selfhelp_diff(spark, d))


@query
def selfhelp_tracking_after(spark: SparkSession, d: str) -> DataFrame:
    after = sh.tracking_after(_selfhelp_diff(spark, d), mp.selfhelp_tracking(spark, d), mp.as_of())
    return _stamped(after, "last_processed")


@query
def selfhelp_corpus(spark: SparkSession, d: str) -> DataFrame:
    return _selfhelp_corpus(spark, d)


@query
def corpus_union(spark: SparkSession, d: str) -> DataFrame:
    _, corpus = documents_and_corpus(spark, d)
    return sh.corpus_union(corpus, _selfhelp_corpus(spark, d))


# --- decisions ----------------------------------------------------------------------------

def _decision(spark: SparkSession, d: str, **params) -> DataFrame:
    found, corpus = documents_and_corpus(spark, d)
    stats = ch.change_stats(ch.classify_changes(found, corpus), corpus, mp.product_list(spark, d))
    last_runs = mp.index_tracking(spark, d).select(
        "product_id", F.col("last_full_index").alias("last_processed"),
        F.concat(F.lit("run_"), F.date_format("last_full_index", "yyyyMMdd")).alias("output_dir"))
    changed = sh.selfhelp_changed(mp.selfhelp_files(spark, d), mp.selfhelp_tracking(spark, d), mp.product_list(spark, d))
    return ch.processing_decision(stats, changed, last_runs, mp.as_of(), **params)


@query
def processing_decision(spark: SparkSession, d: str) -> DataFrame:
    return _decision(spark, d).withColumn("skip_reasons", F.array_join("skip_reasons", "|"))


@query
def processing_decision_forced(spark: SparkSession, d: str) -> DataFrame:
    return _decision(spark, d, force=True).withColumn("skip_reasons", F.array_join("skip_reasons", "|"))


@query
def reindex_policy(spark: SparkSession, d: str) -> DataFrame:
    return ch.reindex_policy(mp.index_tracking(spark, d), mp.as_of())


# --- answers ------------------------------------------------------------------------------

@query
def parse_gaps(spark: SparkSession, d: str) -> DataFrame:
    out = gaps_of(spark, d)
    return out.withColumns({n: F.array_join(n, "|") for n in ("related_cases", "related_paths")})


@query
def parse_fmea(spark: SparkSession, d: str) -> DataFrame:
    out = modes_of(spark, d)
    return out.withColumns({n: F.array_join(n, "|") for n in ("existing_controls", "recommended_actions")})


@query
def prevention_opportunities(spark: SparkSession, d: str) -> DataFrame:
    return ans.parse_prevention(mp.fmea_answers(spark, d))


@query
def answer_failures(spark: SparkSession, d: str) -> DataFrame:
    return ans.answer_failures(mp.gap_answers(spark, d), mp.fmea_answers(spark, d))


@query
def high_risk(spark: SparkSession, d: str) -> DataFrame:
    return ans.high_risk(modes_of(spark, d))


@query
def recommendations(spark: SparkSession, d: str) -> DataFrame:
    return ans.recommendations(gaps_of(spark, d), ans.high_risk(modes_of(spark, d)))


@query
def gap_top5(spark: SparkSession, d: str) -> DataFrame:
    return ans.first_k(gaps_of(spark, d), 5).select("analysis_id", "place", "suggested_title", "frequency", "impact")


@query
def risk_top5(spark: SparkSession, d: str) -> DataFrame:
    return ans.first_k(ans.high_risk(modes_of(spark, d)), 5).select("analysis_id", "place", "failure_mode", "rpn", "risk_level")


@query
def recs_by_category(spark: SparkSession, d: str) -> DataFrame:
    recs = ans.recommendations(gaps_of(spark, d), ans.high_risk(modes_of(spark, d)))
    return ans.by_category(recs).groupBy("analysis_id", "category", "group_seq").agg(
        F.count("*").alias("n"), F.max("impact").alias("top_impact"))


@query
def result_counts(spark: SparkSession, d: str) -> DataFrame:
    gaps, risks = gaps_of(spark, d), ans.high_risk(modes_of(spark, d))
    found = rep.summary_rows(analyses(spark, d), gaps, risks, ans.recommendations(gaps, risks))
    return found.drop("coverage_score").join(metrics(spark, d).drop("minutes"), "analysis_id")


# --- insights -----------------------------------------------------------------------------

@query
def coverage(spark: SparkSession, d: str) -> DataFrame:
    out = ins.coverage(mp.relations(spark, d))
    return out.withColumn("covered_issues", F.array_join("covered_issues", "|"))


@query
def coverage_score(spark: SparkSession, d: str) -> DataFrame:
    return ins.coverage_score(mp.entity_mentions(spark, d), mp.relations(spark, d))


@query
def uncovered_problems(spark: SparkSession, d: str) -> DataFrame:
    return ins.uncovered_problems(mp.entity_mentions(spark, d), mp.relations(spark, d))


@query
def high_priority_needs(spark: SparkSession, d: str) -> DataFrame:
    return ins.high_priority_needs(gaps_of(spark, d))


@query
def detection_gaps(spark: SparkSession, d: str) -> DataFrame:
    return ins.detection_gaps(modes_of(spark, d), mp.relations(spark, d))


@query
def control_gaps(spark: SparkSession, d: str) -> DataFrame:
    return ins.control_gaps(mp.relations(spark, d))


@query
def risk_score(spark: SparkSession, d: str) -> DataFrame:
    return ins.risk_score(modes_of(spark, d), analyses(spark, d))


@query
def gap_case_check(spark: SparkSession, d: str) -> DataFrame:
    return ins.gap_case_check(gaps_of(spark, d), all_cases(spark, d))


@query
def type_distribution(spark: SparkSession, d: str) -> DataFrame:
    return ins.type_distribution(mp.entity_mentions(spark, d))


@query
def issue_distribution(spark: SparkSession, d: str) -> DataFrame:
    return ins.issue_distribution(gaps_of(spark, d))


@query
def problem_frequency(spark: SparkSession, d: str) -> DataFrame:
    return ins.problem_frequency(mp.entity_mentions(spark, d))


@query
def problem_frequency_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Distinct cases per problem by sketches kept per run and united, beside the exact count and their relative error."""
    mentioned = mp.entity_mentions(spark, d)
    path = scratch_path(spark, "sketches")
    run = F.pmod(F.xxhash64("case_id"), F.lit(3)).alias("run")
    ins.problem_sketches(mentioned.select("*", run), "run").write.partitionBy("run").parquet(path)
    # A second index of one run's cases brings nothing new: sketches are united, not added up.
    ins.problem_sketches(mentioned.select("*", run).filter("run = 1").withColumn("run", F.lit(9)), "run").write.mode("append").partitionBy("run").parquet(path)
    united = ins.merged_problem_frequency(spark.read.parquet(path))
    exact = ins.problem_frequency(mentioned)
    return exact.join(united, ["analysis_id", "problem"], "left").select(
        "analysis_id", "problem", "cases", "estimate", F.round(F.abs(F.col("estimate") - F.col("cases")) / F.col("cases"), 4).alias("error"))


@query
def relationship_insights(spark: SparkSession, d: str) -> DataFrame:
    return ins.relationship_insights(mp.relations(spark, d))


@query
def failure_chains(spark: SparkSession, d: str) -> DataFrame:
    return ins.failure_chains(mp.relations(spark, d))


@query
def gap_ranking(spark: SparkSession, d: str) -> DataFrame:
    return ins.gap_ranking(mp.entity_mentions(spark, d), mp.relations(spark, d), gaps_of(spark, d))


# --- graph --------------------------------------------------------------------------------

@query
def chunks(spark: SparkSession, d: str) -> DataFrame:
    return doc_chunks(spark, d)


@query
def record_entities(spark: SparkSession, d: str) -> DataFrame:
    return gr.record_entities(parsed_records(spark, d))


@query
def record_relations(spark: SparkSession, d: str) -> DataFrame:
    return gr.record_relations(parsed_records(spark, d))


@query
def malformed_records(spark: SparkSession, d: str) -> DataFrame:
    return gr.malformed_records(parsed_records(spark, d))


@query
def vocabulary_violations(spark: SparkSession, d: str) -> DataFrame:
    return gr.vocabulary_violations(parsed_records(spark, d))


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return gr.mentions(doc_chunks(spark, d), mp.lexicon(spark, d))


@query
def mentions(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d)


def _kept(rows: DataFrame, label: str) -> DataFrame:
    """Rows that are read several times, from the scratch folder."""
    path = scratch_path(rows.sparkSession, label)
    with freed_shuffles(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _stored_mentions(spark: SparkSession, d: str) -> DataFrame:
    return _kept(_mentions(spark, d), "mentions")


@query
def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return gr.cooccurrence(_stored_mentions(spark, d))


@query
def entity_insights(spark: SparkSession, d: str) -> DataFrame:
    found = _stored_mentions(spark, d)
    return ins.entity_insights(found, _kept(gr.cooccurrence(found).select("source", "target"), "pairs"))


@query
def components(spark: SparkSession, d: str) -> DataFrame:
    return component_rows(spark, d)


def _entity_graph(spark: SparkSession, d: str) -> DataFrame:
    """Entities that share chunks, weighted by how many they share."""
    found = gr.cooccurrence(_stored_mentions(spark, d)).select(F.col("source").alias("src"), F.col("target").alias("dst"), F.col("shared").alias("weight"))
    return _kept(found, "entity_graph")


@query
def communities(spark: SparkSession, d: str) -> DataFrame:
    """The community of every entity at every level, with the level's modularity."""
    edges = _entity_graph(spark, d)
    levels = cm.communities(edges)
    return levels.join(cm.modularity(edges, levels).select("level", "modularity"), "level")


@query
def community_stats(spark: SparkSession, d: str) -> DataFrame:
    return ins.community_stats(component_rows(spark, d), mp.graph_edges(spark, d), mp.entity_mentions(spark, d),
                               mp.relations(spark, d), modes_of(spark, d))


@query
def community_reports(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "community_reports")
    fs.write_graph_csv(mp.community_reports(component_rows(spark, d)), path)
    found = ins.community_insights(fs.read_graph_csv(spark, path, fs.REPORT_CSV))
    return found.withColumns({n: F.array_join(n, "|") for n in ("key_findings", "actions")})


def _merge_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Problem descriptions of two index runs: by lines returned, and by lines shipped."""
    lines = mp.lines_with_parts(spark, d)

    def run(flag: Column, label: str) -> DataFrame:
        return lines.filter(flag).groupBy("analysis_id", F.lit("CASE_PROBLEM").alias("type"), F.col("problem").alias("name")).agg(
            F.concat(F.lit(label), F.count("*").cast("string")).alias("description"))

    returned = F.col("l_returnflag") == "R"
    return run(~returned, "old "), run(returned, "new ")


@query
def graph_merge_entities(spark: SparkSession, d: str) -> DataFrame:
    current, incoming = _merge_inputs(spark, d)
    return gr.merge_entities(current, incoming, ["analysis_id", "type", "name"])


@query
def graph_merge_relations(spark: SparkSession, d: str) -> DataFrame:
    rows = mp.relations(spark, d)
    current, incoming = rows.filter("strength > 5"), rows.filter("strength <= 5")
    return ins.relationship_insights(gr.merge_relations(current, incoming))


@query
def graph_merge_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of two index runs by id: the second run replaces every third one and adds ids of its own."""
    current = _vectors(spark, d).withColumn("run", F.lit("first"))
    incoming = current.filter(F.col("vec_id") % 3 == 0).withColumns({"vector": F.reverse("vector"), "run": F.lit("second")})
    added = incoming.filter(F.col("vec_id") % 2 == 0).withColumn("vec_id", -F.col("vec_id") - 1)
    merged = gr.merge_entities(current, incoming.unionByName(added), ["vec_id"])
    return merged.select("vec_id", "run", F.size("vector").alias("dims"), F.element_at("vector", 1).cast("double").alias("first"),
                         F.element_at("vector", -1).cast("double").alias("last"))


@query
def graph_merge_components(spark: SparkSession, d: str) -> DataFrame:
    """The stored components of one half of the edges, and what they become by the other half and some edges known before."""
    edges = mp.graph_edges(spark, d).select("src", "dst")
    first = F.col("src") < F.concat(F.substring_index("src", "/", 1), F.lit("/M"))
    path = scratch_path(spark, "components")
    comp.connected_components(edges.filter(first)).write.parquet(path)
    stored = spark.read.parquet(path)
    after = comp.merge_components(stored, edges.filter(~first | (F.crc32("src") % 4 == 0)))
    return after.join(stored.withColumnRenamed("component", "old_component"), "node", "left")


# --- retrieval ----------------------------------------------------------------------------

def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return mp.table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


@query
def knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    """The nearest vectors to the mean vector of every label."""
    centroids = ret.class_centroids(mp.table(spark, d, "embeddings"))
    return ret.top_k_similar(_vectors(spark, d), centroids, 5)


def _hundredth(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set of the vector searches."""
    return _vectors(spark, d).filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")


@query
def knn_index(spark: SparkSession, d: str) -> DataFrame:
    """The nearest other vectors of every vector whose id is divisible by 100, by cells and bounds."""
    return vi.nearest(vi.build_index(_vectors(spark, d)), _hundredth(spark, d), 5, skip_self=True)


@query
def knn_index_recall(spark: SparkSession, d: str) -> DataFrame:
    """How much of that the nearest half, three quarters and all of the cells alone give; knn_index goes on to the exact result."""
    index = vi.build_index(_vectors(spark, d))
    n = len(index.centres)
    return vi.recall(index, _hundredth(spark, d), 5, sorted({-(-n // 2), -(-3 * n // 4), n}), skip_self=True)


def _ranked(spark: SparkSession, d: str, questions: DataFrame) -> DataFrame:
    return ret.rank_chunks(doc_chunks(spark, d), questions)


@query
def question_ranking(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, mp.questions(spark, d))


@query
def fixed_question_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The questions asked of every corpus, ranked over all documents."""
    texts = V.GAP_QUESTIONS + V.FMEA_QUESTIONS + V.FOLLOW_UP_QUESTIONS
    asked = spark.createDataFrame(list(enumerate(texts, 1)), "question_id long, question string")
    return _ranked(spark, d, asked)


# --- reports and records ------------------------------------------------------------------

def _report_inputs(spark: SparkSession, d: str):
    gaps, risks = gaps_of(spark, d), ans.high_risk(modes_of(spark, d))
    recs = ans.recommendations(gaps, risks)
    return gaps, risks, recs


def _executive(spark: SparkSession, d: str, gaps: DataFrame, risks: DataFrame, recs: DataFrame, stored: Stored | None = None) -> DataFrame:
    return rep.executive_summary(summary(spark, d, gaps, risks, recs, stored), gaps, risks, mp.as_of())


def _fmea(spark: SparkSession, d: str, risks: DataFrame) -> DataFrame:
    return rep.fmea_report(analyses(spark, d), risks, ans.parse_prevention(mp.fmea_answers(spark, d)))


def _detail(spark: SparkSession, d: str, stored: Stored | None = None) -> DataFrame:
    mentioned = mp.entity_mentions(spark, d, stored.lines if stored else None)
    return rep.detailed_report(metrics(spark, d, communities=True, stored=stored), ins.type_distribution(mentioned))


@query
def report_executive(spark: SparkSession, d: str) -> DataFrame:
    return _executive(spark, d, *_report_inputs(spark, d))


@query
def report_gaps(spark: SparkSession, d: str) -> DataFrame:
    return rep.gap_report(analyses(spark, d), gaps_of(spark, d))


@query
def report_fmea(spark: SparkSession, d: str) -> DataFrame:
    return _fmea(spark, d, ans.high_risk(modes_of(spark, d)))


@query
def report_recommendations(spark: SparkSession, d: str) -> DataFrame:
    _, _, recs = _report_inputs(spark, d)
    return rep.recommendation_report(analyses(spark, d), recs)


@query
def report_detail(spark: SparkSession, d: str) -> DataFrame:
    return _detail(spark, d)


@query
def document_record(spark: SparkSession, d: str) -> DataFrame:
    gaps, risks, recs = _report_inputs(spark, d)
    full = rep.document_record(summary(spark, d, gaps, risks, recs), gaps, risks, recs, metrics(spark, d), mp.as_of())

    def titles(name: str, field: str) -> Column:
        return F.array_join(F.transform(name, lambda x: x[field].cast("string")), "|")

    return full.select(
        "id", "productId", X.stamp(F.col("analysisTimestamp")).alias("analysisTimestamp"), "totalCasesAnalyzed",
        titles("selfHelpGaps", "suggested_title").alias("gap_titles"),
        titles("selfHelpGaps", "impact").alias("gap_impacts"),
        titles("fmeaHighRiskItems", "rpn").alias("risk_rpns"),
        titles("recommendations", "title").alias("rec_titles"),
        F.col("metrics.totalEntitiesExtracted").alias("n_entities"),
        F.col("metrics.totalRelationshipsFound").alias("n_relations"),
        F.col("metrics.processingTimeMinutes").alias("minutes"), "ttl")


@query
def metrics_record(spark: SparkSession, d: str) -> DataFrame:
    gaps, risks, recs = _report_inputs(spark, d)
    found = rep.metrics_record(summary(spark, d, gaps, risks, recs), metrics(spark, d),
                               ins.risk_score(modes_of(spark, d), analyses(spark, d)), mp.as_of())
    return _stamped(found, "analysis_timestamp")


@query
def callback_summary(spark: SparkSession, d: str) -> DataFrame:
    gaps, risks, recs = _report_inputs(spark, d)
    found = rep.callback_summary(summary(spark, d, gaps, risks, recs), gaps, risks)
    return found.withColumns({n: F.array_join(n, "|") for n in ("top_gaps", "top_risks")})


def nested_results(spark: SparkSession, d: str) -> DataFrame:
    """The whole results. What is made of many rows is stored as it is made, so that shuffle files do not add up."""
    stored = stored_inputs(spark, d)
    lines, cases, gaps, modes, risks, recs = stored
    edges, mentioned = mp.relations(spark, d, lines), mp.entity_mentions(spark, d, lines)
    return rep.analysis_result(
        _kept(summary(spark, d, gaps, risks, recs, stored), "summary"), gaps, modes, risks,
        ans.parse_prevention(mp.fmea_answers(spark, d)), recs, _kept(metrics(spark, d, communities=True, stored=stored), "metrics"),
        _kept(ins.type_distribution(mentioned), "types"), ins.coverage(edges), ins.high_priority_needs(gaps),
        _kept(ins.detection_gaps(modes, edges), "undetected"), ins.risk_score(modes, analyses(spark, d)), ins.issue_distribution(gaps),
        _kept(ins.gap_case_check(gaps, cases), "checked"), mp.as_of())


def _flat_result(full: DataFrame) -> DataFrame:
    """Every part of nested results as plain columns, lists in their order."""
    def listed(name: str, item: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.array_join(F.transform(name, lambda x: F.coalesce(item(x), F.lit("-"))), "|"), F.lit(""))

    def counted(name: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")

    return full.select(
        "analysis_id", "product_id", "n_cases",
        listed("selfhelp_gaps.gaps", lambda x: F.concat_ws(":", x["gap_id"], x["severity_level"], x["impact"].cast("string"))).alias("gaps"),
        listed("selfhelp_gaps.existing_coverage", lambda x: F.concat_ws(":", x["topic"], x["quality"], F.array_join(x["covered_issues"], ","))).alias("coverage"),
        listed("selfhelp_gaps.high_priority_needs", lambda x: x).alias("needs"), F.col("selfhelp_gaps.coverage_score").alias("coverage_score"),
        listed("fmea.failure_modes", lambda x: F.concat_ws(":", x["failure_mode"], x["rpn"].cast("string"))).alias("modes"),
        listed("fmea.high_risk_items", lambda x: F.concat_ws(":", x["failure_mode"], x["risk_level"])).alias("risks"),
        F.coalesce(F.size("fmea.prevention_opportunities"), F.lit(0)).alias("n_prevention"),
        listed("fmea.detection_gaps", lambda x: x["failure_mode"]).alias("detection_gaps"), F.col("fmea.risk_score").alias("risk_score"),
        listed("recommendations", lambda x: F.concat_ws(":", x["priority"], x["title"])).alias("recommendations"),
        F.col("metrics.n_communities").alias("n_communities"), F.col("metrics.minutes").alias("minutes"), counted("metrics.entity_types").alias("entity_types"),
        F.coalesce(counted("metrics.issue_distribution"), F.lit("")).alias("issues"))


@query
def analysis_result(spark: SparkSession, d: str) -> DataFrame:
    return _flat_result(nested_results(spark, d))


# --- sinks and streams --------------------------------------------------------------------

@query
def sink_cases(spark: SparkSession, d: str) -> DataFrame:
    found, corpus = documents_and_corpus(spark, d)
    path = scratch_path(spark, "corpus")
    fs.write_table(ch.upsert_corpus(corpus, ch.work_set(found, corpus, "new_or_updated")), path, "product_id")
    return spark.read.parquet(path).select("product_id", "case_id", "part_no", "content_hash")


@query
def sink_selfhelp(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "selfhelp")
    fs.write_table(_selfhelp_corpus(spark, d), path, "product_id")
    return spark.read.parquet(path).select("product_id", "doc_kind", "part", "file_name",
                                           X.content_hash(F.col("content")).alias("content_hash"))


@query
def sink_metrics(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    fs.append_table(metrics_record(spark, d), path)
    return spark.read.parquet(path)


@query
def sink_reports(spark: SparkSession, d: str) -> DataFrame:
    """All five reports written as texts and read back, every line at its place.

    What several reports are made of is stored once, and so are the lines, which are read twice to be dealt by their order.
    """
    path, stored = scratch_path(spark, "reports"), stored_inputs(spark, d)
    made = [_executive(spark, d, stored.gaps, stored.risks, stored.recs, stored), rep.gap_report(analyses(spark, d), stored.gaps),
            _fmea(spark, d, stored.risks), rep.recommendation_report(analyses(spark, d), stored.recs), _detail(spark, d, stored)]
    lines = _kept(reduce(DataFrame.unionByName, made), "report_lines")
    with freed_shuffles(spark):
        fs.write_reports(lines, path, rep.ORDER)
    return fs.read_reports(spark, path)


def _stored_results(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "results")
    gaps, risks, recs = _report_inputs(spark, d)
    found = rep.callback_summary(summary(spark, d, gaps, risks, recs), gaps, risks)
    fs.write_results(found.filter(F.col("recommendations") > 0), path, "analysis_result_20240101_000000")
    fs.write_results(found.withColumn("status", F.lit("Later")), path, "analysis_result_20240102_000000")
    schema = ("status string, analysis_id string, total_cases long, top_gaps array<string>, top_risks array<string>,"
              " recommendations long, product_id string, run string")
    return fs.latest_run(fs.read_results(spark, path, schema))


@query
def sink_result_json(spark: SparkSession, d: str) -> DataFrame:
    """The whole nested results of two runs as JSON; the newest run read back as variants and typed again."""
    path = scratch_path(spark, "nested")
    full = nested_results(spark, d)
    stored = _kept(full, "result")
    with freed_shuffles(spark):
        fs.write_results(stored.filter("n_cases > 0"), path, "analysis_result_20240101_000000")
        fs.write_results(stored, path, "analysis_result_20240102_000000")
    found = fs.latest_run(fs.read_result_variants(spark, path))
    kinds = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in stored.schema.fields if f.name not in ("product_id", "analysis_timestamp"))
    typed = found.select("run", "product_id", F.variant_get("result", "$", f"struct<{kinds}>").alias("r")).select("run", "product_id", "r.*")
    return _flat_result(typed).join(typed.select("analysis_id", "run"), "analysis_id")


@query
def existing_result(spark: SparkSession, d: str) -> DataFrame:
    found = fs.existing_result(_decision(spark, d), _stored_results(spark, d))
    return found.select("product_id", "run", "analysis_id", "reason", "processing_skipped", *_joined("skip_reasons"))


@query
def graph_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "relationships")
    edges = ins.relationship_insights(mp.relations(spark, d)).select(
        F.concat("analysis_id", F.lit(' "x"\n'), "source").alias("source"), "target", "type",
        F.lit("").alias("description"), "strength")
    fs.write_graph_csv(edges, path)
    return fs.read_graph_csv(spark, path, fs.RELATION_CSV).select("source", "target", "type", "strength")


def _blocked(rows: DataFrame) -> DataFrame:
    """Tracking rows with a block of 64 sources, which bounds a stored map."""
    return rows.withColumn("block", F.floor(F.regexp_extract("file_name", r"_(\d+)\.txt$", 1).cast("long") / 64))


@query
def tracking_maps(spark: SparkSession, d: str) -> DataFrame:
    """Tracking rows written to files of JSON maps and read back."""
    path = scratch_path(spark, "tracking")
    fs.write_tracking(_blocked(mp.selfhelp_tracking(spark, d)), path, "tracking_20231201_000000", "block")
    return _stamped(fs.read_latest_tracking(spark, path), "last_processed")


@query
def sink_tracking(spark: SparkSession, d: str) -> DataFrame:
    """The tracking stored by an earlier run is read, advanced by the present files, stored, and read again."""
    path = scratch_path(spark, "tracking")
    fs.write_tracking(_blocked(mp.selfhelp_tracking(spark, d)), path, "tracking_20231201_000000", "block")
    stored = fs.read_latest_tracking(spark, path)
    after = sh.tracking_after(sh.selfhelp_diff(mp.selfhelp_files(spark, d), stored), stored, mp.as_of())
    kept = scratch_path(spark, "tracking_after")
    after.write.parquet(kept)
    fs.write_tracking(_blocked(spark.read.parquet(kept)), path, "tracking_20240101_000000", "block")
    found = fs.read_latest_tracking(spark, path)
    return _stamped(found.select(*after.columns), "last_processed")


@query
def stream_cases(spark: SparkSession, d: str) -> DataFrame:
    """An earlier corpus and then the present documents arrive; the stored corpus afterwards."""
    found, corpus = documents_and_corpus(spark, d)
    base = scratch_path(spark, "stream-cases")
    for rows in (corpus, found):
        rows.select("product_id", "case_id", "part_no", "content").write.mode("append").parquet(f"{base}/in")
        ingest.stream_cases(spark, f"{base}/in", f"{base}/corpus", f"{base}/check").awaitTermination()
    return ingest.read_corpus(spark, f"{base}/corpus").select("product_id", "case_id", "part_no", "content_hash")


@query
def stream_selfhelp(spark: SparkSession, d: str) -> DataFrame:
    """Earlier and then present self-help files arrive; the sections written for them."""
    base = scratch_path(spark, "stream-selfhelp")
    earlier = mp.selfhelp_tracking(spark, d).select(
        "product_id", "file_name", F.col("processed_content").alias("content"),
        F.col("last_processed").alias("modified_ts"))
    for rows in (earlier, mp.selfhelp_files(spark, d)):
        rows.select("product_id", "file_name", "content", "modified_ts").write.mode("append").parquet(f"{base}/in")
        ingest.stream_selfhelp(spark, f"{base}/in", f"{base}/sections", f"{base}/tracking",
                               f"{base}/check").awaitTermination()
    sections = ingest.read_sections(spark, f"{base}/sections")
    return sections.select("product_id", "file_name", "status", X.content_hash(F.col("section")).alias("section_hash"))
