"""The sample tables seen as support-case inputs (FIXTURES.md, part C).

Every function reads whole tables. Groups built here are bounded by the formula that builds
them: an answer holds ten parts, an analysis forty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselore.functions import vocabulary as V
from caselore.functions.text import content_hash
from caselore.session import widen

AS_OF = "2002-01-01 00:00:00"
PARTS_PER_ANSWER = 10
PARTS_PER_ANALYSIS = 40


# Schemas are given, so that no job reads footers to find them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def as_of() -> Column:
    return ts(AS_OF)


def hours_after(start: str, hours: Column) -> Column:
    return ts(start) + F.make_dt_interval(hours=hours.cast("int"))


# --- cases --------------------------------------------------------------------------------

def area_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    path = F.concat("r_name", F.lit("\\"), "n_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("sap_key"),
        F.col("r_name").alias("product_name"),
        F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("pes_product_id"),
        path.alias("sap_path"),
        F.when(F.col("n_nationkey") % 4 == 0, F.col("r_name"))
        .otherwise(F.concat(path, F.lit("\\topic"))).alias("support_topic_id"),
    )


def case_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("closed_ts"), F.count("*").cast("int").alias("tasks"))
    turns = (table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
             .groupBy(F.col("conv_id").alias("o_orderkey"))
             .agg(F.count("*").cast("int").alias("mails")))
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, "o_custkey")
        .join(lines, "o_orderkey", "left")
        .join(turns, "o_orderkey", "left")
        .selectExpr(
            "c_nationkey AS sap_key", "concat('SR', o_orderkey) AS sr_number", "c_name AS sr_owner",
            "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS sr_status",
            "o_orderstatus AS service_request_status", "substring(o_orderpriority, 1, 1) AS sr_severity",
            "if(o_totalprice > 400000, '1', substring(o_orderpriority, 1, 1)) AS sr_max_severity",
            "if(o_orderkey % 97 = 0, null, concat(c_mktsegment, ' ', o_orderpriority)) AS internal_title",
            "o_orderdate + INTERVAL '1' DAY AS first_assignment_ts",
            "cast(o_orderkey % 30 AS int) AS case_idle_days", "cast(o_custkey % 15 AS int) AS communication_idle_days",
            "c_acctbal > 9000 AS is_s500", "coalesce(tasks, 0) AS collaboration_tasks",
            "cast(o_orderkey % 4 AS int) AS phone_interactions", "coalesce(mails, 0) AS email_interactions",
            "c_mktsegment AS ir_status", "o_orderkey % 7 = 0 AS is_transferred",
            f"datediff(TIMESTAMP_NTZ '{AS_OF}', o_orderdate) AS sr_age_days", "o_orderdate AS created_ts", "closed_ts")
    )


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    kind = (F.col("conv_id") + F.col("turn")) % 10
    wrap = (F.col("conv_id") + F.col("turn")) % 4
    return table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select(
        F.concat(F.lit("SR"), F.col("conv_id").cast("string")).alias("ticket_number"),
        hours_after("2024-01-01 00:00:00", F.col("turn")).alias("created_ts"),
        F.when(kind == 0, "New File Uploaded for x").when(kind == 1, "Automatic reply: x")
        .when(kind == 2, F.lit(None)).when(kind == 3, "a {CREDITCARDPII} b")
        .otherwise(F.concat(F.lit("Re: case "), F.col("conv_id").cast("string"))).alias("subject"),
        F.when(wrap == 1, F.concat(F.lit('<a href="x">'), text, F.lit("</a>")))
        .when(wrap == 2, F.concat(F.lit("head From: a To: b "), text))
        .when(wrap == 3, F.concat(F.lit("<img src=x> "), text, F.lit("\t")))
        .otherwise(text).alias("description"),
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.col("turn") % 5
    base = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant").select(
        F.concat(F.lit("SR"), F.col("conv_id").cast("string")).alias("ticket_number"),
        F.concat("text", F.when(tail == 0, " NAMEPII").when(tail == 1, " {EMAILPII}")
                 .when(tail == 2, " NAME+EMAILPII").when(tail == 3, " " + "=" * 46)
                 .otherwise("")).alias("note_text"),
        hours_after("2024-01-01 00:00:00", F.col("turn")).alias("created_ts"),
        F.when(F.col("turn") % 3 == 1, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return base.select("ticket_number", "note_text", "created_ts", F.explode("copies").alias("day")).select(
        "ticket_number", "note_text",
        (F.col("created_ts") + F.make_dt_interval(days=F.col("day"))).alias("created_ts"))


def prior_corpus(documents: DataFrame) -> DataFrame:
    """An earlier corpus: by case number a case is absent, the same, or has ' old' appended.

    Product P2 holds the very same documents, product P4 has no corpus yet.
    """
    number = F.substring("case_id", 3, 20).cast("long") % 3
    content = F.when((number == 2) & (F.col("product_id") != "P2"),
                     F.concat("content", F.lit(" old"))).otherwise(F.col("content"))
    return documents.filter(
        (F.col("product_id") != "P4") & ((F.col("product_id") == "P2") | (number != 0))
    ).select("product_id", "case_id", "part_no", content.alias("content"),
             content_hash(content).alias("content_hash"))


# --- self-help ----------------------------------------------------------------------------

def selfhelp_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.concat(F.lit("P"), (F.col("doc_id") % 4).cast("string"))
    return table(spark, sf_dir, "documents").select(
        product.alias("product_id"),
        F.concat(product, F.lit("_"), "source", F.lit("_"), F.col("doc_id").cast("string"),
                 F.lit(".txt")).alias("file_name"),
        F.col("text").alias("content"),
        hours_after("2024-01-01 00:00:00", F.col("doc_id")).alias("modified_ts"),
    )


def selfhelp_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = selfhelp_files(spark, sf_dir)
    number = F.regexp_extract("file_name", r"_(\d+)\.txt$", 1).cast("long")
    kind = F.when(F.col("product_id") == "P2", 1).otherwise(F.floor(number / 4) % 4)
    half = F.substring("content", F.lit(1), F.floor(F.char_length("content") / 2).cast("int"))
    seen = (F.when(kind == 1, F.col("content")).when(kind == 2, half)
            .otherwise(F.concat(F.lit("changed "), F.col("content"))))
    return files.filter(kind != 0).select(
        "product_id", "file_name", seen.alias("processed_content"),
        ts("2023-12-01 00:00:00").alias("last_processed"),
        F.char_length(seen).alias("content_length"))


def product_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("product_id"))


def selfhelp_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored self-help text: products with an odd number have one."""
    return table(spark, sf_dir, "region").filter(F.col("r_regionkey") % 2 == 1).select(
        F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("product_id"),
        F.concat(F.lit("stored text of "), "r_name", F.lit(" \n\n")).alias("content"))


def index_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("P"), key.cast("string")).alias("product_id"),
        F.when(key != 4, as_of() - F.make_dt_interval(days=key * 3)).alias("last_full_index"),
        (key * 4).alias("increments"))


# --- answers ------------------------------------------------------------------------------

def analysis_no() -> Column:
    return F.floor(F.col("p_partkey") / PARTS_PER_ANALYSIS)


def analysis_id() -> Column:
    return F.concat(F.lit("A"), analysis_no().cast("string"))


def problem() -> Column:
    return F.upper(F.concat("p_type", F.lit(" "), "p_name"))


def failure_mode() -> Column:
    return F.upper(F.col("p_brand"))


def brand_no() -> Column:
    return F.substring("p_brand", 7, 5).cast("int")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.col("p_partkey") % PARTS_PER_ANALYSIS
    return table(spark, sf_dir, "part").select(
        "*",
        analysis_id().alias("analysis_id"),
        F.concat(F.lit("P"), (analysis_no() % 5).cast("string")).alias("product_id"),
        (F.floor(slot / PARTS_PER_ANSWER) + 1).cast("int").alias("question"),
        (F.col("p_partkey") % PARTS_PER_ANSWER).cast("int").alias("slot"),
        problem().alias("problem"), failure_mode().alias("failure_mode"))


def _payload_state(question_offset: int) -> tuple[Column, Column]:
    """Which answers are blank and which payloads are not JSON."""
    number = F.substring("analysis_id", 2, 20).cast("long") * 8 + F.col("question") + question_offset
    return number % 13 == 0, number % 11 == 0


def _answers(grouped: DataFrame, questions: list[str], offset: int) -> DataFrame:
    blank, broken = _payload_state(offset)
    texts = F.array(*[F.lit(q) for q in questions])
    return grouped.select(
        "analysis_id", "product_id", (F.col("question") + offset).alias("query_no"),
        F.get(texts, F.col("question") - 1).alias("query"),
        F.when(blank, F.lit(" ")).otherwise(F.lit("answer text")).alias("response"),
        F.when(broken, F.concat(F.lit("Here it is: "), "payload")).otherwise(F.col("payload")).alias("payload"))


def gap_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    # every order of a part is cited
    cited = lines.groupBy("l_partkey").agg(
        F.count("*").alias("n_lines"), F.sort_array(F.collect_set("l_orderkey")).alias("keys"))
    thin = F.col("p_partkey") % 7 == 0
    item = F.struct(
        F.col("problem").alias("problemArea"),
        F.col("p_brand").alias("issueCategory"),
        F.when(~thin, F.coalesce("n_lines", F.lit(0))).alias("frequencyInCases"),
        F.when(~thin, F.col("p_partkey") % 2 == 0).alias("customerSolvable"),
        F.col("p_name").alias("suggestedTitle"),
        F.when(~thin, 1 + F.col("p_size") % 10).alias("estimatedImpact"),
        F.transform("keys", lambda k: F.concat(F.lit("SR"), k.cast("string"))).alias("relatedCaseNumbers"),
        F.when(F.col("p_partkey") % 2 == 0, F.array(F.concat(F.lit("Area\\"), "p_type"))).alias("relatedSAPPaths"),
    )
    grouped = (
        parts(spark, sf_dir)
        .join(cited, F.col("p_partkey") == cited.l_partkey, "left").drop("l_partkey")
        .groupBy("analysis_id", "product_id", "question")
        .agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("slot", item.alias("item")))),
                                   lambda x: x["item"])).alias("payload")))
    return _answers(grouped, V.GAP_QUESTIONS, 0)


def fmea_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, thin = F.col("p_partkey"), F.col("p_partkey") % 7 == 0
    mode = F.struct(
        F.col("failure_mode").alias("failureMode"),
        F.concat(F.col("p_type"), F.lit(" cause")).alias("failureCause"),
        F.concat(F.col("p_type"), F.lit(" effect")).alias("failureEffect"),
        F.when(~thin, 1 + F.col("p_size") % 10).alias("severityRating"),
        F.when(~thin, 1 + key % 10).alias("occurrenceFrequency"),
        F.when(~thin, 1 + F.floor(key / 10) % 10).alias("detectabilityRating"),
        F.when(F.col("p_size") % 2 == 0, F.array(F.concat(F.lit("control "), F.col("p_size").cast("string"))))
        .alias("existingControls"),
        F.when(key % 3 != 0, F.array(F.concat(F.lit("inspect "), "p_name"),
                                     F.concat(F.lit("replace "), "p_type"))).alias("recommendedActions"),
    )
    opportunity = F.when(key % 4 == 0, F.struct(
        F.col("failure_mode").alias("failureMode"),
        F.col("p_type").alias("preventionType"),
        F.concat(F.lit("check "), "p_name").alias("recommendedControl"),
        F.when(key % 20 != 0, key % 8 == 0).alias("customerActionable"),
        F.when(key % 12 == 0, F.col("p_name")).alias("selfHelpContentNeeded")))
    rows = F.sort_array(F.collect_list(F.struct("slot", mode.alias("mode"), opportunity.alias("opp"))))
    grouped = (
        parts(spark, sf_dir).groupBy("analysis_id", "product_id", "question").agg(rows.alias("rows"))
        .withColumn("opps", F.filter(F.transform("rows", lambda r: r["opp"]), lambda o: o.isNotNull()))
        .withColumn("payload", F.to_json(F.struct(
            F.transform("rows", lambda r: r["mode"]).alias("failureModes"),
            F.when(F.size("opps") > 0, F.col("opps")).alias("preventionOpportunities")))))
    return _answers(grouped, V.FMEA_QUESTIONS, len(V.GAP_QUESTIONS))


# --- graph --------------------------------------------------------------------------------

def lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = widen(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"))
    return lines.join(parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))


#: What mentions, relations and runs take from the lines and their parts.
LINE_COLUMNS = ["analysis_id", "product_id", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "problem", "failure_mode"]


def entity_mentions(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One row per entity mention; the case is the source, a self-help title has none. lines: stored LINE_COLUMNS, if they are read often."""
    mention = F.explode(F.array(
        F.struct(F.lit("CASE_PROBLEM").alias("type"), F.col("problem").alias("name")),
        F.struct(F.lit("FAILURE_MODE").alias("type"), F.col("failure_mode").alias("name")),
        F.struct(F.lit("FAILURE_CAUSE").alias("type"),
                 F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("name")))).alias("m")
    case_id = F.concat(F.lit("SR"), F.col("l_orderkey").cast("string"))
    cases = (lines_with_parts(spark, sf_dir) if lines is None else lines).select(
        "analysis_id", "product_id", case_id.alias("case_id"), mention).select(
        "analysis_id", "product_id", "case_id", "m.type", "m.name",
        F.lit("CASE_SOURCE").alias("marker"))
    topics = parts(spark, sf_dir).filter(F.col("p_type").isin("PROMO", "SMALL", "LARGE")).select(
        "analysis_id", "product_id", F.lit(None).cast("string").alias("case_id"),
        F.lit("SELFHELP_TOPIC").alias("type"), topic().alias("name"), F.lit("SELFHELP_SOURCE").alias("marker"))
    return cases.unionByName(topics)


def topic() -> Column:
    return F.concat(F.lit("TOPIC "), (F.col("p_size") % 12).cast("string"))


def _edge(source: Column, target: Column, kind: Column | str, strength: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(source.alias("source"), target.alias("target"), kind.alias("type"),
                    strength.cast("int").alias("strength"))


def relations(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Typed edges of every analysis, one row per mention. lines: stored LINE_COLUMNS, if they are read often."""
    strength = 1 + F.col("l_linenumber") % 10
    supplier = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    from_lines = (lines_with_parts(spark, sf_dir) if lines is None else lines).select("analysis_id", F.explode(F.array(
        _edge(supplier, F.col("failure_mode"), "TRIGGERS", strength),
        _edge(F.col("failure_mode"), F.concat("l_returnflag", "l_linestatus"), "RESULTS_IN", strength),
    )).alias("e"))
    number = brand_no() + F.substring("analysis_id", 2, 20).cast("int")
    mode = F.col("failure_mode")
    optional = F.array(
        F.when(number % 2 == 0, _edge(F.concat(F.lit("PC "), mode), mode, "PREVENTS", F.lit(5))),
        F.when(number % 3 == 0, _edge(F.concat(F.lit("DC "), mode), mode, "DETECTS", F.lit(6))),
        F.when(number % 4 == 1, _edge(mode, F.lit("CUSTOMER"), "PREVENTABLE_BY_CUSTOMER", F.lit(7))),
        F.when(F.col("p_type").isin("PROMO", "SMALL"),
               _edge(F.col("problem"), topic(), "COVERED_BY", F.lit(9))),
        F.when((F.col("p_type") == "LARGE") | ((F.col("p_type") == "SMALL") & (F.col("p_size") % 5 == 0)),
               _edge(F.col("problem"), topic(), "PARTIALLY_COVERED_BY", F.lit(7))),
    )
    from_parts = parts(spark, sf_dir).select("analysis_id", F.explode(F.array_compact(optional)).alias("e"))
    return reduce(DataFrame.unionByName, [from_lines, from_parts]).select(
        "analysis_id", "e.source", "e.target", "e.type", "e.strength")


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem - failure mode edges, each analysis a graph of its own."""
    prefix = F.concat("analysis_id", F.lit("/"))
    return parts(spark, sf_dir).select(
        "analysis_id", F.concat(prefix, "problem").alias("src"), F.concat(prefix, "failure_mode").alias("dst"))


def extraction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record texts as an extractor writes them, one text per analysis and case."""
    d = F.lit(V.TUPLE_DELIMITER)
    case_id = F.concat(F.lit("SR"), F.col("l_orderkey").cast("string"))

    def entity(name: Column, kind: Column, about: Column) -> Column:
        return F.concat(F.lit('("entity"'), d, name, d, kind, d, about, F.lit(")"))

    def text(line: Column) -> Column:
        number, mode, problem_ = line["l_linenumber"], line["failure_mode"], line["problem"]
        supplier = F.concat(F.lit("s"), line["l_suppkey"].cast("string"))
        lost = (F.col("l_orderkey") + number) % 10 == 0
        relation = F.when(number == 6, "CAUSES").otherwise("TRIGGERS")
        source = F.when(number == 4, problem_).otherwise(supplier)
        head = F.concat(F.lit('("relationship"'), d, source, d, F.lower(mode), d, relation, F.lit(": cause of the mode"))
        strength = (1 + (number + line["l_suppkey"]) % 11).cast("string")
        return F.concat_ws(
            V.RECORD_DELIMITER,
            entity(F.lower(problem_), F.when(number == 7, "WIDGET").otherwise("CASE_PROBLEM"),
                   F.concat(F.lit("CASE_SOURCE problem in "), case_id)),
            entity(mode, F.lit("FAILURE_MODE"), F.lit("CASE_SOURCE mode")),
            entity(supplier, F.lit("FAILURE_CAUSE"), F.lit("no marker")),
            F.when(lost, F.concat(head, F.lit(")"))).otherwise(F.concat(head, d, strength, F.lit(")"))))

    # lines are gathered as keys and names; their texts, many times as long, are made after the shuffle
    lines = F.transform("lines", lambda x: F.struct(x["l_linenumber"].alias("l_linenumber"), text(x).alias("text")))
    return (
        lines_with_parts(spark, sf_dir)
        .groupBy("analysis_id", "l_orderkey")
        .agg(F.collect_list(F.struct("l_linenumber", "l_suppkey", "problem", "failure_mode")).alias("lines"))
        .select("analysis_id", case_id.alias("doc_id"), F.concat(
            F.array_join(F.transform(F.sort_array(lines), lambda x: x["text"]), V.RECORD_DELIMITER),
            F.lit(V.END_MARK + " trailing words")).alias("records")))


def runs(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Start and end of the run of every analysis: six seconds for every line it reads."""
    lines = lines_with_parts(spark, sf_dir) if lines is None else lines
    counted = lines.groupBy("analysis_id").agg(F.count("*").cast("int").alias("n"))
    return counted.select("analysis_id", as_of().alias("started_ts"), (as_of() + F.make_dt_interval(secs=F.col("n") * 6)).alias("finished_ts"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words and all pairs of adjacent words of the benchmark texts, with a type."""
    words = table(spark, sf_dir, "benchmark").select(
        F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "").alias("words"))
    first, second = F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, F.size("words"))
    pairs = F.zip_with(first, second, lambda a, b: F.concat(a, F.lit(" "), b))
    terms = words.select(F.explode(F.concat("words", pairs)).alias("term")).distinct()
    types = F.array(*[F.lit(t) for t in V.ENTITY_TYPES])
    return terms.select("term", F.get(types, F.char_length("term") % len(V.ENTITY_TYPES)).alias("type"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"),
                                                     F.col("text").alias("question"))


def community_reports(components: DataFrame) -> DataFrame:
    """A JSON report per component; a rating of 11 is out of range."""
    sizes = components.groupBy("analysis_id", "component").agg(F.count("*").alias("n"))
    finding = F.transform(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(3)).cast("int")), lambda i: F.struct(
        F.concat(F.lit("finding "), i.cast("string")).alias("summary"),
        F.concat(F.lit("do "), i.cast("string")).alias("explanation")))
    return sizes.select("component", F.to_json(F.struct(
        F.col("component").alias("title"), F.concat(F.lit("size "), F.col("n").cast("string")).alias("summary"),
        (F.col("n") % 12).cast("double").alias("rating"), F.lit("by size").alias("rating_explanation"),
        finding.alias("findings"))).alias("report_json"))
