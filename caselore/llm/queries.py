"""The queries of this subpackage: thin callers of its operators on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselore.llm import decontamination, language_id, quality_classifier, url_filter
from caselore.llm.filter_audit import audit
from caselore.llm.licenses import license_scan
from caselore.llm.mixing import mix
from caselore.llm.quality_rules import quality_rules
from caselore.llm.sharding import row_bytes, shard
from caselore.llm.simhash import simhash_components
from caselore.llm.spelling import spelling_variants, word_counts
from caselore.llm.substring_dedup import dedup_substrings
from caselore.llm.suffix_dedup import remove_repeats

#: Target weights of the mixture; a domain is every fourth source.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of_source():
    """d0 to d3 by the number at the end of the source; null where there is none."""
    number = F.regexp_extract(F.col("source"), r"(\d+)$", 1)
    return F.concat(F.lit("d"), (number.try_cast("int") % 4).cast("string"))


def held_out():
    """A quarter of the documents, by their id, from which nothing is learned."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur elsewhere too."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the verdict of the rule cascade for every document."""
    return quality_rules(table(spark, sf_dir, "documents"))


def fitted_classifier(spark: SparkSession, sf_dir: str) -> quality_classifier.Classifier | quality_classifier.Constant:
    """Learned from the labels of the tables, without the held-out ids."""
    return quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter(~held_out()))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = quality_classifier.score(table(spark, sf_dir, "documents"), fitted_classifier(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents chosen for a mixture of 80 % of the tokens, per epoch, with the budget of their leaf."""
    mixed = mix(table(spark, sf_dir, "documents"), domain_of_source(), WEIGHTS)
    return mixed.select("doc_id", F.col("mix_epoch").alias("epoch"), F.col("mix_domain").alias("domain"),
                        F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"),
                        F.col("mix_tokens").alias("n_tokens"), F.col("mix_budget").alias("leaf_budget"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shuffled shards by the law `rows`."""
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", row_bytes(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs.filter(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


#: The rules that the query judges by.
URL_RULES = (url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"),
             url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document."""
    return license_scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold passages of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.digest(decontamination.scan(docs, table(spark, sf_dir, "benchmark")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of linked fingerprints of every document."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of five letters or more that occurs three times, with the form that it is a variant of."""
    counted = word_counts(table(spark, sf_dir, "documents"), deleted_in=97)
    return spelling_variants(counted.filter("n >= 3 AND char_length(word) >= 5"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 13-word windows that a document of a smaller id has."""
    # the doubling goes on until nothing is shared; its length is a result of the operator, the query's are fixed by its SQL
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("longest")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, per source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_quality_rules, op3_quality_classifier, op4_mixing, op5_sharding, op6_language_id,
                                 op7_url_filter, op8_licenses, op9_decontamination, op10_simhash, op11_spelling_variants,
                                 op12_substring_dedup, op13_filter_audit)
}
