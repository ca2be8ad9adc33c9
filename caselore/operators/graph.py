"""Chunks, extraction records, vocabulary checks, mentions, co-occurrence, graph merge."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.functions import vocabulary as V
from caselore.operators.gazetteer import PhraseTree, mention_rows, pair_rows
from caselore.session import scratch_path

#: A lexicon of up to so many words and characters is sent to every task.
TREE_WORDS, TREE_CHARS = 1_000_000, 16_000_000
#: A term with at least this fraction of all mentions is heavy, so there are no more heavy terms than this.
HEAVY_TERMS = 2048
#: A closing bracket at the end, or before a last line break.
_CLOSED = "\\)(\r\n|[\n\r\u0085\u2028\u2029])?$"


def chunks(documents: DataFrame, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP) -> DataFrame:
    """(doc_id, chunk_no, n_tokens, text) of documents (doc_id, text); tokens by white space.

    Chunks are cut inside one expression, so the token array is not repeated per chunk.
    """
    step = size - overlap
    trimmed = F.regexp_replace("text", r"^\s+|\s+$", "")
    n = F.size("tokens")
    starts = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(step))
    pieces = F.transform(starts, lambda s: F.slice(F.col("tokens"), s + 1, F.lit(size)))
    cut = F.transform(pieces, lambda p: F.struct(F.size(p).alias("n_tokens"), F.array_join(p, " ").alias("text")))
    return (documents.filter(F.col("text").rlike(r"\S"))
            .select("doc_id", F.split(trimmed, r"\s+").alias("tokens"))
            .select("doc_id", F.posexplode(cut).alias("chunk_no", "c"))
            .select("doc_id", "chunk_no", "c.n_tokens", "c.text"))


def chunk_count(documents: DataFrame, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP) -> DataFrame:
    """One row n: how many chunks the documents give, without cutting them."""
    trimmed = F.regexp_replace("text", r"^\s+|\s+$", "")
    tokens = F.size(F.split(trimmed, r"\s+"))
    n = F.greatest(F.ceil((tokens - overlap) / (size - overlap)), F.lit(1))
    return documents.filter(F.col("text").rlike(r"\S")).agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"))


def _record_fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(analysis_id, doc_id, p) per record that is not blank: its fields, without the brackets around them."""
    for whole in batches:
        for k in range(0, whole.num_rows, 1024):
            batch = whole.slice(k, 1024)
            lists = pc.split_pattern(batch.column("records"), V.RECORD_DELIMITER)
            of = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            records = pc.utf8_trim(lists.flatten(), " ")
            some = pc.not_equal(records, "")
            of = pa.array(of).filter(some)
            records = pc.replace_substring_regex(pc.replace_substring_regex(records.filter(some), r"^\(", "", max_replacements=1),
                                                 _CLOSED, r"\1")
            yield pa.RecordBatch.from_arrays(
                [batch.column("analysis_id").take(of), batch.column("doc_id").take(of), pc.split_pattern(records, V.TUPLE_DELIMITER)],
                ["analysis_id", "doc_id", "p"])


def parse_records(texts: DataFrame) -> DataFrame:
    """Rows of record texts (analysis_id, doc_id, records): kind is entity, relationship or malformed."""
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    parts = (texts.select("analysis_id", "doc_id", F.substring_index("records", V.END_MARK, 1).alias("records"))
             .mapInArrow(_record_fields, f"analysis_id {kinds['analysis_id']}, doc_id {kinds['doc_id']}, p array<string>"))
    tag, n = F.trim(F.get("p", 0)), F.size("p")
    strength = F.trim(F.get("p", 4)).try_cast("double")
    is_entity = (tag == '"entity"') & (n == 4)
    is_relation = (tag == '"relationship"') & (n == 5) & strength.isNotNull()
    kind = F.when(is_entity, "entity").when(F.coalesce(is_relation, F.lit(False)), "relationship").otherwise("malformed")
    return parts.select("analysis_id", "doc_id", "p", kind.alias("kind"), strength.alias("strength"))


def _name(i: int) -> Column:
    return F.upper(F.trim(F.get("p", i)))


def source_marker(description: Column) -> Column:
    found = F.regexp_extract(description, r"(CASE|SELFHELP)_SOURCE", 0)
    return F.when(found != "", found)


def relation_type(description: Column) -> Column:
    """The first known relation type named in the description."""
    names = "|".join(name for name, *_ in V.RELATION_TYPES)
    found = F.regexp_extract(description, rf"\b({names})\b", 1)
    return F.when(found != "", found)


def record_entities(parsed: DataFrame) -> DataFrame:
    about = F.trim(F.get("p", 3))
    return parsed.filter(F.col("kind") == "entity").select(
        "analysis_id", "doc_id", _name(1).alias("name"), F.trim(F.get("p", 2)).alias("type"),
        about.alias("description"), source_marker(about).alias("marker"))


def record_relations(parsed: DataFrame) -> DataFrame:
    about = F.trim(F.get("p", 3))
    return parsed.filter(F.col("kind") == "relationship").select(
        "analysis_id", "doc_id", _name(1).alias("source"), _name(2).alias("target"),
        relation_type(about).alias("type"), about.alias("description"), "strength")


def malformed_records(parsed: DataFrame) -> DataFrame:
    return (parsed.groupBy("analysis_id")
            .agg(F.count_if(F.col("kind") == "malformed").alias("malformed"), F.count("*").alias("records")))


def _relation_map(index: int, kind: str) -> Column:
    entries: list[Column] = []
    for row in V.RELATION_TYPES:
        entries += [F.lit(row[0]), F.lit(row[index]).cast(kind)]
    return F.create_map(*entries)


def vocabulary_violations(parsed: DataFrame) -> DataFrame:
    """One row per violation (analysis_id, doc_id, violation, subject) in parsed records, which are parsed once.

    Types and strength ranges are literal maps in the expression, so one pass finds what can
    be wrong with each record. An end point is in order if the graph holds an entity of that
    name and the expected type: those candidates carry it as a key and are anti-joined; the
    others have no key and stay.
    """
    def candidate(found: Column, violation: str, subject: Column, end: Column, end_type: Column) -> Column:
        return F.when(found, F.struct(F.lit(violation).alias("violation"), subject.alias("subject"),
                                      end.alias("end"), end_type.alias("end_type")))

    is_relation, is_entity = F.col("kind") == "relationship", F.col("kind") == "entity"
    source, target, kind = F.col("source"), F.col("target"), F.col("type")
    rows = parsed.filter(is_relation | is_entity).select(
        "analysis_id", "doc_id", "kind", "strength", _name(1).alias("source"), _name(2).alias("target"),
        F.when(is_relation, relation_type(F.trim(F.get("p", 3)))).otherwise(F.trim(F.get("p", 2))).alias("type"))
    path = scratch_path(parsed.sparkSession, "records")
    rows.write.parquet(path)
    rows = parsed.sparkSession.read.schema(rows.schema).parquet(path)
    # what the vocabulary says of the type is looked up once, before it is used several times
    said = rows.withColumns({name: F.when(is_relation, _relation_map(i, t)[kind]) for name, i, t in (
        ("source_type", 1, "string"), ("target_type", 2, "string"), ("low", 3, "double"), ("high", 4, "double"))})
    none, edge, strength = F.lit(None).cast("string"), F.concat_ws(" -> ", "source", "target"), F.col("strength")
    candidates = F.array_compact(F.array(
        candidate(is_entity & ~kind.isin(*V.ENTITY_TYPES), "entity type", source, none, none),
        candidate(is_relation & kind.isNull(), "relation type", edge, none, none),
        candidate((strength < F.col("low")) | (strength > F.col("high")), "strength", edge, none, none),
        candidate(F.col("source_type").isNotNull(), "source type", edge, source, F.col("source_type")),
        candidate(F.col("target_type").isNotNull(), "target type", edge, target, F.col("target_type"))))
    known = rows.filter(is_entity).select("analysis_id", F.col("source").alias("end"), F.col("type").alias("end_type")).distinct()
    return (said.select("analysis_id", "doc_id", F.explode(candidates).alias("c")).select("analysis_id", "doc_id", "c.*")
            .join(known, ["analysis_id", "end", "end_type"], "left_anti")
            .select("analysis_id", "doc_id", "violation", "subject"))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _phrase_tree(lexicon: DataFrame) -> PhraseTree | None:
    """The lexicon as a tree of words if it is small enough to be sent to every task, else nothing."""
    size = lexicon.agg(F.sum(F.size(F.split("term", " "))).alias("words"), F.sum(F.char_length("term")).alias("chars")).first()
    if (size["words"] or 0) > TREE_WORDS or (size["chars"] or 0) > TREE_CHARS:
        return None
    return PhraseTree([(r["term"], r["type"]) for r in lexicon.select("term", "type").collect()])


def mentions(chunked: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(doc_id, chunk_no, term, type, n) for lexicon terms of any number of words, terms inside others included.

    A lexicon of at most TREE_WORDS words is a prefix tree that every chunk is walked through, without a shuffle; a
    larger one is joined. Null terms and types of their own are allowed: a null term is found nowhere, a term of several
    types gives a row for each. Every row of chunked is a chunk of its own.
    """
    spark = chunked.sparkSession
    terms = lexicon.select("term", "type").filter(F.col("term").isNotNull()).distinct()
    tree = _phrase_tree(terms)
    if tree is None:
        return mentions_by_join(chunked, terms)
    sent = spark.sparkContext.broadcast(tree)
    kinds = {f.name: f.dataType.simpleString() for f in chunked.schema.fields}
    return (chunked.select("doc_id", "chunk_no", words(F.col("text")).alias("words"))
            .mapInArrow(mention_rows(lambda: sent.value),
                        f"doc_id {kinds['doc_id']}, chunk_no {kinds['chunk_no']}, term string, type string, n long"))


def mentions_by_join(chunked: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of mentions for a lexicon of any size: the word runs of the lengths that terms have are joined to it."""
    def runs_of(n: int) -> Column:
        if n == 1:
            return F.col("words")
        starts = F.sequence(F.lit(1), F.size("words") - (n - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.lit(n)), " "))
        return F.when(F.size("words") >= n, found).otherwise(F.array().cast("array<string>"))

    counts = terms.select(F.size(F.split("term", " ")).alias("n")).filter(F.col("n") > 0).distinct()
    runs = [runs_of(row["n"]) for row in counts.orderBy("n").collect()] or [F.col("words")]
    return (chunked.select("doc_id", "chunk_no", words(F.col("text")).alias("words"))
            .select("doc_id", "chunk_no", F.explode(F.concat(*runs)).alias("term"))
            .join(terms, "term").groupBy("doc_id", "chunk_no", "term", "type").agg(F.count("*").alias("n")))


def cooccurrence(mentions: DataFrame, heavy_terms: int = HEAVY_TERMS) -> DataFrame:
    """(source, target, shared, strength): entities that share chunks, source before target.

    Mentions are read twice: terms get numbers, then the numbers of a chunk, bounded by its text, are counted in pairs inside
    the tasks, so pairs are added up as numbers and a pair leaves a task about once. Terms that hold at least one in
    heavy_terms of all mentions are heavy, so there are at most heavy_terms of them; their pairs come from a matrix product.
    """
    spark = mentions.sparkSession
    path = scratch_path(spark, "terms")
    (mentions.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("n"))
     .withColumn("number", F.monotonically_increasing_id()).write.parquet(path))
    terms = spark.read.schema("term string, n long, number long").parquet(path)
    total = terms.agg(F.sum("n")).first()[0] or 0
    heavy = [r["number"] for r in terms.filter(F.col("n") * heavy_terms >= total).select("number").collect()]
    held = (mentions.select("doc_id", "chunk_no", "term").join(terms.select("term", "number"), "term")
            .groupBy("doc_id", "chunk_no").agg(F.collect_set("number").alias("terms")).select("terms"))
    pairs = held.mapInArrow(pair_rows(heavy), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    first, second = (terms.select(F.col("number").alias(k), F.col("term").alias(f"{k}_term")) for k in ("a", "b"))
    return (pairs.join(first, "a").join(second, "b")
            .select(F.least("a_term", "b_term").alias("source"), F.greatest("a_term", "b_term").alias("target"), "shared",
                    F.least(F.col("shared"), F.lit(10)).cast("int").alias("strength")))


def merge_entities(current: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows replace those with the same key; others are appended."""
    return current.join(incoming.select(*key).distinct(), key, "left_anti").unionByName(incoming)


def merge_relations(current: DataFrame, incoming: DataFrame) -> DataFrame:
    return current.unionByName(incoming)
