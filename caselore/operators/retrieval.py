"""Vector search and keyword ranking."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.operators.graph import words
from caselore.session import scratch_path

MAX_QUERIES = 4096  # query vectors sent to every task at once


def class_centroids(vectors: DataFrame) -> DataFrame:
    """(query_id, vector): the mean vector of each label, as wide as its vectors are."""
    places = vectors.select(F.col("label").cast("long").alias("query_id"), F.posexplode("embedding").alias("i", "x"))
    means = places.groupBy("query_id", "i").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "mean")))
    return means.groupBy("query_id").agg(F.transform(ordered, lambda p: p["mean"]).alias("vector"))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; a zero vector stays zero and scores 0."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def _search(vectors: DataFrame, ids: list[int], matrix: np.ndarray, k: int, skip_self: bool) -> DataFrame:
    unit = _unit(matrix)

    def best_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf["vec_id"].to_numpy()
            rows = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
            scores = np.round(_unit(rows) @ unit.T, 6)
            out = []
            for j, query in enumerate(ids):
                order = np.lexsort((keys, -scores[:, j]))
                if skip_self:
                    order = order[keys[order] != query]
                order = order[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": keys[order], "score": scores[order, j]}))
            yield pd.concat(out)

    return vectors.select("vec_id", "vector").mapInPandas(best_of_batch, "query_id long, vec_id long, score double")


def top_k_similar(vectors: DataFrame, queries: DataFrame, k: int = 5, skip_self: bool = False,
                  max_queries: int = MAX_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors by cosine of every query.

    vectors: (vec_id, vector); queries: (query_id, vector). The vectors stay where they are:
    each Arrow batch is scored against the queries by one matrix product and keeps its k best
    per query, so the shuffle carries no other rows. At most max_queries are fetched at once;
    if there are more, they are searched in several passes.
    """
    def search(part: DataFrame, limit: int | None) -> DataFrame | None:
        rows = (part if limit is None else part.limit(limit + 1)).select("query_id", "vector").collect()
        if limit is not None and len(rows) > limit:
            return None
        matrix = np.array([r["vector"] for r in rows], dtype=np.float64)
        return _search(vectors, [r["query_id"] for r in rows], matrix, k, skip_self) if rows else vectors.sparkSession.createDataFrame(
            [], "query_id long, vec_id long, score double")

    whole = search(queries, max_queries)
    if whole is not None:
        found = [whole]
    else:
        passes = -(-2 * queries.count() // max_queries)
        bucket = F.pmod(F.xxhash64("query_id"), F.lit(passes))
        found = [search(queries.filter(bucket == i), None) for i in range(passes)]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id")))
    return (reduce(DataFrame.unionByName, found).withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


BLOCK_CHUNKS = 256  # about so many chunks share a block of the index
SEED_BLOCKS = 4  # blocks of each question that are scored first
_ROUND = 1e-6  # what rounding can add to a score


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _postings(chunked: DataFrame, asked: DataFrame) -> DataFrame:
    """(term, doc_id, chunk_no, tf) of the asked terms, and the empty term once for every chunk, in one pass over the texts."""
    marked = F.concat(words(F.col("text")), F.array(F.lit("")))
    terms = asked.select("term").unionByName(asked.sparkSession.createDataFrame([("",)], "term string")).distinct()
    return (chunked.select("doc_id", "chunk_no", F.explode(marked).alias("term")).join(terms, "term", "left_semi")
            .groupBy("term", "doc_id", "chunk_no").agg(F.count("*").alias("tf")))


def _scored(weighted: DataFrame, wanted: DataFrame, postings: DataFrame) -> DataFrame:
    """(question_id, doc_id, chunk_no, score) of all chunks with an asked term in the wanted (question_id, block)."""
    return (wanted.join(weighted, "question_id").join(postings, ["term", "block"]).groupBy("question_id", "doc_id", "chunk_no")
            .agg(F.round(F.sum(F.col("tf") * F.col("idf")), 6).alias("score")))


def _best(scored: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("question_id").orderBy(F.col("score").desc(), "doc_id", "chunk_no"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def rank_chunks(chunked: DataFrame, questions: DataFrame, k: int = 5, block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """(question_id, rank, doc_id, chunk_no, score): best chunks by tf * ln((N+1)/(df+1)), N chunks in all.

    An inverted index in blocks: the texts are read once, for the postings of the asked terms, which are dealt to blocks
    of about block_chunks chunks. The greatest tf of a term in a block bounds what a question can score there. The blocks
    of greatest bound are scored first; of the others only those whose bound reaches the k-th score so far, so the rows are
    those of a full search. Postings are joined by term and block, so a term of every chunk is as many keys as there are blocks.
    A chunk with an asked term is ranked even if the term is in every chunk and so weighs nothing.
    """
    asked = questions.select("question_id", F.explode(F.array_distinct(words(F.col("question")))).alias("term")).distinct()
    postings = _stored(_postings(chunked, asked), "postings")
    total = postings.filter("term = ''").count()
    blocks = max(1, -(-total // block_chunks))
    postings = postings.filter("term <> ''").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    seen = postings.groupBy("term", "block").agg(F.count("*").alias("df"), F.max("tf").alias("most"))
    blocked = _stored(seen, "blocks")
    weights = blocked.groupBy("term").agg(F.log(F.lit(total + 1) / (F.sum("df") + 1)).alias("idf"))
    weighted = _stored(asked.join(weights, "term"), "weights")
    bounds = _stored(weighted.join(blocked, "term").groupBy("question_id", "block").agg(F.sum(F.col("idf") * F.col("most")).alias("bound")),
                     "bounds")
    order = F.row_number().over(Window.partitionBy("question_id").orderBy(F.col("bound").desc(), "block"))
    seeds = _stored(bounds.withColumn("n", order).filter(F.col("n") <= SEED_BLOCKS).select("question_id", "block"), "seeds")
    first = _stored(_best(_scored(weighted, seeds, postings), k).drop("rank"), "first")
    threshold = first.groupBy("question_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("threshold"))
    more = (bounds.join(seeds, ["question_id", "block"], "left_anti").join(threshold, "question_id", "left")
            .filter(F.col("threshold").isNull() | (F.col("bound") + _ROUND >= F.col("threshold"))).select("question_id", "block"))
    return _best(first.unionByName(_scored(weighted, more, postings)), k).select("question_id", "rank", "doc_id", "chunk_no", "score")
