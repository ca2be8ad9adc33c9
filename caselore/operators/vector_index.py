"""Nearest vectors by cosine for any number of queries: an index of cells with a bound for every block.

Index. Centres are fitted on a sample of at most SAMPLE_ROWS vectors (spherical k-means, at most MAX_CELLS centres); every
vector of the table goes to the cell of its nearest centre. A cell is written in blocks of about BLOCK_ROWS vectors, each with
the least cosine to the centre in it, so a cell of any size is many rows and no task holds one.

Search. Each query looks into its `probes` nearest cells first; its k-th score so far is its threshold. No vector of a block
is nearer to the query than the angle to the centre less the block's radius, so blocks whose bound is below the
threshold are left out and all others are searched: the result is exact, whatever the centres. Queries that want the same
block travel together, in groups of at most QUERY_ROWS, and meet it in one matrix product whose k best per query
leave the task.

Null vectors are left out, a zero vector has cosine 0 to all. Scores are rounded to six digits; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.session import scratch_path

SAMPLE_ROWS, MAX_CELLS, BLOCK_ROWS, QUERY_ROWS = 20_000, 4096, 2048, 256
OUT_ROWS = 1 << 14  # rows with a vector that leave a task together
_ROUND = 1e-6  # what rounding can add to a score


@dataclass(frozen=True)
class VectorIndex:
    """centres: unit vectors; blocks: (cell, part, low, ids, vectors); cells: per cell the number of parts and least cosine."""

    centres: np.ndarray
    blocks: DataFrame
    cells: DataFrame
    low: np.ndarray


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as unit rows."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit(values.reshape(len(column), -1) if len(column) else np.zeros((0, 1)))


def fit_centres(sample: np.ndarray, cells: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spread rows of the sample; an empty cell keeps its centre."""
    sample = _unit(sample)
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(steps):
        at = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, sample)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centres)
    return centres


def build_index(vectors: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> VectorIndex:
    """The index of (vec_id, vector); every row is in it, the sample only places the centres."""
    spark = vectors.sparkSession
    vectors = vectors.filter("vector IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", "vector")
    n = vectors.count()
    share = int(min(1.0, sample_rows / max(n, 1)) * (1 << 20))
    drawn = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < max(share, 1)).orderBy("vec_id").limit(2 * sample_rows).collect()
    rows = np.array([r["vector"] for r in drawn] or [r["vector"] for r in vectors.orderBy("vec_id").limit(1).collect()], np.float64)
    centres = fit_centres(rows, min(MAX_CELLS, cells or max(1, int(np.sqrt(n))))) if len(rows) else np.zeros((0, 1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(k, QUERY_ROWS)
                near = _matrix(batch.column("vector")) @ centres.T
                at = np.argmax(near, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(near[np.arange(len(at)), at])],
                                                 ["vec_id", "vector", "cell", "cos"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields) + ", cell int, cos double"
    path = scratch_path(spark, "assigned")
    vectors.mapInArrow(assign, schema).write.parquet(path)
    assigned = spark.read.parquet(path)
    counts = {r["cell"]: r["count"] for r in assigned.groupBy("cell").count().collect()}  # at most MAX_CELLS rows
    parts = spark.createDataFrame([(c, max(1, -(-m // block_rows))) for c, m in sorted(counts.items())], "cell int, parts int")
    part = F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts").cast("long")).cast("int").alias("part")
    packed = (assigned.join(F.broadcast(parts), "cell").select("cell", part, "vec_id", "vector", "cos").groupBy("cell", "part")
              .agg(F.min("cos").alias("low"), F.collect_list(F.struct("vec_id", "vector")).alias("rows"))
              .select("cell", "part", "low", F.col("rows.vec_id").alias("ids"), F.col("rows.vector").alias("vectors")))
    path = scratch_path(spark, "blocks")
    packed.write.parquet(path)
    blocks = spark.read.parquet(path)
    low = np.ones(len(centres))
    for r in blocks.groupBy("cell").agg(F.min("low").alias("low")).collect():
        low[r["cell"]] = r["low"]
    return VectorIndex(centres, blocks, blocks.select("cell", "part", "low"), low)


def _cells_of(index: VectorIndex, queries: DataFrame, probes: int, rest: bool) -> DataFrame:
    """(query_id, vector, cell, angle): the `probes` nearest cells, or of the others those that may beat `threshold`."""
    centres, low = index.centres, index.low

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, QUERY_ROWS):
                batch = whole.slice(k, QUERY_ROWS)
                angle = np.arccos(np.clip(_matrix(batch.column("vector")) @ centres.T, -1, 1))
                order = np.argsort(angle, axis=1, kind="stable")
                wanted = np.zeros(angle.shape, bool)
                np.put_along_axis(wanted, order[:, :probes], True, axis=1)
                if rest:
                    threshold = batch.column("threshold").to_numpy(zero_copy_only=False)[:, None]
                    wanted = ~wanted & (np.cos(np.maximum(angle - np.arccos(np.clip(low, -1, 1)), 0)) + _ROUND >= threshold)
                rows, cells = np.nonzero(wanted)
                for low_ in range(0, len(rows), OUT_ROWS):
                    row, cell = rows[low_:low_ + OUT_ROWS], cells[low_:low_ + OUT_ROWS]
                    known = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("query_id").take(known), batch.column("vector").take(known), batch.column("threshold").take(known),
                         pa.array(cell.astype(np.int32)), pa.array(angle[row, cell])], ["query_id", "vector", "threshold", "cell", "angle"])

    kinds = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    return queries.select("query_id", "vector", "threshold").mapInArrow(
        step, f"query_id {kinds['query_id']}, vector {kinds['vector']}, threshold double, cell int, angle double")


def _searched(index: VectorIndex, wanted: DataFrame, groups: int, k: int, skip_self: bool) -> DataFrame:
    """(query_id, vec_id, score): the k best of every block that a query wants; wanted: (query_id, vector, cell, part)."""
    kinds = {f.name: f.dataType for f in index.blocks.schema.fields}
    asked = (wanted.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups))).groupBy("cell", "part", "group")
             .agg(F.collect_list(F.struct("query_id", "vector")).alias("q"))
             .select("cell", "part", F.col("q.query_id").alias("query_ids"), F.col("q.vector").alias("query_vectors")))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, asks = batch.column("ids")[i].values, batch.column("query_ids")[i].values
                scores = np.round(_matrix(batch.column("query_vectors")[i].values) @ _matrix(batch.column("vectors")[i].values).T, 6)
                keys = ids.to_numpy(zero_copy_only=False)
                if skip_self:
                    scores[asks.to_numpy(zero_copy_only=False)[:, None] == keys] = -np.inf
                order = np.lexsort((np.broadcast_to(keys, scores.shape), -scores), axis=1)[:, :k]
                best = np.take_along_axis(scores, order, axis=1).ravel()
                row, keep = np.repeat(np.arange(len(asks)), order.shape[1]), np.flatnonzero(best > -np.inf)
                yield pa.RecordBatch.from_arrays([asks.take(pa.array(row[keep])), ids.take(pa.array(order.ravel()[keep])), pa.array(best[keep])],
                                                 ["query_id", "vec_id", "score"])

    query_kind = wanted.schema["query_id"].dataType.simpleString()
    return (asked.join(index.blocks, ["cell", "part"]).select("query_ids", "query_vectors", "ids", "vectors")
            .mapInArrow(step, f"query_id {query_kind}, vec_id {kinds['ids'].elementType.simpleString()}, score double"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest(index: VectorIndex, queries: DataFrame, k: int = 5, probes: int = 4, exact: bool = True, skip_self: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest; without `exact` only the `probes` nearest cells are searched."""
    spark = queries.sparkSession
    if not len(index.centres):
        return spark.createDataFrame([], f"query_id {queries.schema['query_id'].dataType.simpleString()}, rank int, vec_id long, score double")
    queries = queries.filter("vector IS NOT NULL AND query_id IS NOT NULL").select("query_id", "vector")
    groups = max(1, -(-2 * queries.count() // QUERY_ROWS))
    first = _cells_of(index, queries.withColumn("threshold", F.lit(None).cast("double")), probes, rest=False)
    found = _ranked(_searched(index, first.join(index.cells, "cell"), groups, k, skip_self), k).select("query_id", "vec_id", "score")
    if not exact:
        return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
    path = scratch_path(spark, "first")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    # The k-th score so far; with fewer than k found nothing is left out.
    threshold = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("threshold"))
    again = queries.join(threshold, "query_id", "left").withColumn("threshold", F.coalesce("threshold", F.lit(-2.0)))
    radius = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("low"))))
    bound = F.cos(F.greatest(F.lit(0.0), F.col("angle") - radius))
    more = _cells_of(index, again, probes, rest=True).join(index.cells, "cell").filter(bound + _ROUND >= F.col("threshold"))
    return _ranked(found.unionByName(_searched(index, more, groups, k, skip_self)), k).select("query_id", "rank", "vec_id", "score")


def recall(index: VectorIndex, queries: DataFrame, k: int, probes: list[int], skip_self: bool = False) -> DataFrame:
    """(probes, queries, wanted, found, recall): how much of the exact result the nearest cells alone give, by their number."""
    path = scratch_path(queries.sparkSession, "exact")
    nearest(index, queries, k, max(probes), skip_self=skip_self).select("query_id", "vec_id").write.parquet(path)
    every = queries.sparkSession.read.parquet(path)
    quick = reduce(DataFrame.unionByName, [
        nearest(index, queries, k, n, exact=False, skip_self=skip_self).select("query_id", "vec_id", F.lit(n).alias("probes")) for n in probes])
    asked = every.withColumn("probes", F.explode(F.lit(probes)))
    return (asked.join(quick.withColumn("hit", F.lit(1)), ["probes", "query_id", "vec_id"], "left").groupBy("probes").agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"), F.count("hit").alias("found"),
        (F.count("hit") / F.count("*")).alias("recall")))
