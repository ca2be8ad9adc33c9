"""A corpus pipeline: documents in, shuffled shards of a clean, de-duplicated, decontaminated mixture out.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the docs of the
next stage, so a lost executor costs at most the work of one stage. All stages but the last return the columns of
documents. Null and empty texts have no good quality and go in the first stage unless the labels say otherwise; the
docstrings of the operators say what each does with nulls, ties, repeats and empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caselore.llm import quality_classifier
from caselore.llm.decontamination import cut
from caselore.llm.mixing import MIX_COLUMNS, mix
from caselore.llm.queries import WEIGHTS, domain_of_source, held_out, table
from caselore.llm.sharding import shard
from caselore.llm.simhash import one_per_group
from caselore.session import scratch_path

#: Share of the remaining tokens that the mixture takes.
MIX_SHARE = 0.8


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, labels))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of linked SimHash fingerprints (three words, three bits)."""
    return one_per_group(docs, shingle=3, distance=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that the benchmark has; a document of nothing else goes."""
    return cut(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture by target weights, each at most once."""
    return mix(docs, domain_of_source(), WEIGHTS, total_share=MIX_SHARE, max_epochs=1).drop(*MIX_COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mixture),
    ("sharding", shards),
]

#: Classifier, fingerprints and the random order cannot be expressed in SQL; tests/llm checks them by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what they return is in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
