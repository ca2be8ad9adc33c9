"""What changed since the last corpus, and what has to be done about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.functions.text import content_hash, fixed_1, hours_between, stamp
from caselore.functions.vocabulary import MAX_INCREMENTS, MAX_INDEX_AGE_DAYS

KEY = ["product_id", "case_id", "part_no"]


def without_age(content: Column) -> Column:
    """A document without the two lines of its head that change every day."""
    return F.regexp_replace(content, r"(?m)\A((?:.*\n){5}.*)\nResolution Time: -?\d+ days(\n.*)\nCase Age: -?\d+ days$", "$1$2")


def with_hash(documents: DataFrame, stable: bool = False) -> DataFrame:
    """stable leaves the age of the case out of the hash."""
    text = F.col("content")
    return documents.withColumn("content_hash", content_hash(without_age(text) if stable else text))


def _case_hash(parts: DataFrame, name: str) -> DataFrame:
    """One hash per case; the hash of the joined part hashes where a document has several."""
    ordered = F.sort_array(F.collect_list(F.struct("part_no", "content_hash")))
    joined = F.array_join(F.transform("parts", lambda p: p["content_hash"]), "")
    whole = F.when(F.size("parts") == 1, joined).otherwise(content_hash(joined))
    return (parts.groupBy("product_id", "case_id").agg(ordered.alias("parts"))
            .select("product_id", "case_id", whole.alias(name)))


def classify_changes(documents: DataFrame, corpus: DataFrame, stable: bool = False) -> DataFrame:
    """New, Updated or Unchanged per case. Only ids and hashes are shuffled, never the texts."""
    current = _case_hash(with_hash(documents, stable).select(*KEY, "content_hash"), "current_hash")
    stored = _case_hash(corpus.select(*KEY, "content_hash"), "stored_hash")
    joined = current.join(stored, ["product_id", "case_id"], "left")
    known = F.col("stored_hash").isNotNull()
    return joined.select(
        "product_id", "case_id",
        F.when(~known, "New").when(F.col("stored_hash") != F.col("current_hash"), "Updated")
        .otherwise("Unchanged").alias("change_type"),
        F.col("stored_hash").alias("old_hash"),
        F.when(known, F.col("current_hash")).alias("new_hash"))


def removed_cases(documents: DataFrame, corpus: DataFrame) -> DataFrame:
    """Cases of the corpus that were not asked for; the change analysis itself ignores them."""
    return (corpus.select("product_id", "case_id").distinct()
            .join(documents.select("product_id", "case_id").distinct(), ["product_id", "case_id"], "left_anti"))


def change_stats(changes: DataFrame, corpus: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Counts per product."""
    kind = F.col("change_type")
    counted = changes.groupBy("product_id").agg(
        F.count("*").alias("requested"),
        F.count_if(kind == "New").alias("new_cases"),
        F.count_if(kind == "Updated").alias("updated_cases"),
        F.count_if(kind == "Unchanged").alias("unchanged_cases"))
    existing = corpus.filter("part_no = 0").groupBy("product_id").agg(F.count("*").alias("existing_cases"))
    base = counted if products is None else products.join(counted, "product_id", "left")
    return base.join(existing, "product_id", "left").na.fill(0)


def work_set(documents: DataFrame, corpus: DataFrame, policy: str = "new_only", skip_existing: bool = True) -> DataFrame:
    """Documents to write.

    new_only leaves known cases alone even if their text changed; new_or_updated takes those
    too. Without skip_existing, and for a product without a corpus, all documents are taken.
    """
    if not skip_existing:
        return documents
    if policy == "new_only":
        known = corpus.select("product_id", "case_id").distinct()
    elif policy == "new_or_updated":
        known = (classify_changes(documents, corpus).filter(F.col("change_type") == "Unchanged")
                 .select("product_id", "case_id"))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return documents.join(known, ["product_id", "case_id"], "left_anti")


def upsert_corpus(corpus: DataFrame, changed: DataFrame) -> DataFrame:
    """The corpus with the changed cases put in place of their old rows."""
    fresh = with_hash(changed).select(*KEY, "content", "content_hash")
    ids = fresh.select("product_id", "case_id").distinct()
    return corpus.join(ids, ["product_id", "case_id"], "left_anti").select(*fresh.columns).unionByName(fresh)


def processing_decision(
    stats: DataFrame,
    selfhelp_changed: DataFrame,
    last_runs: DataFrame,
    now: Column,
    mode: str = "incremental",
    force: bool = False,
    engine_label: str = "",
) -> DataFrame:
    """One row per product: process or use the stored result, the reason, the skip reasons.

    last_runs has (product_id, last_processed, output_dir); no row means never.
    """
    rows = (stats.join(selfhelp_changed, "product_id", "left").join(last_runs, "product_id", "left")
            .withColumn("selfhelp_changed", F.coalesce("selfhelp_changed", F.lit(True))))
    never = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    last = F.coalesce(F.col("last_processed"), never)
    first_run = F.col("existing_cases") == 0
    idle = (F.col("new_cases") == 0) & (F.col("updated_cases") == 0) & ~F.col("selfhelp_changed")

    def number(name: str) -> Column:
        return F.col(name).cast("string")

    # Texts of the reasons.
    changed = F.array_join(F.array_compact(F.array(
        F.when(F.col("new_cases") > 0, F.concat(number("new_cases"), F.lit(" new cases"))),
        F.when(F.col("updated_cases") > 0, F.concat(number("updated_cases"), F.lit(" updated cases"))),
        F.when(F.col("selfhelp_changed"), F.lit("self-help content changed")))), ", ")
    skip = F.array_compact(F.array(
        F.concat(F.lit("No new cases found (analyzed "), number("requested"), F.lit(" cases, all "),
                 number("unchanged_cases"), F.lit(" unchanged)")),
        F.lit("No case content updates detected"),
        F.lit("Self-help content unchanged"),
        F.concat(F.lit("Last processed: "), stamp(last), F.lit(" ("), fixed_1(hours_between(now, last)),
                 F.lit(" hours ago)")),
        F.when(F.col("output_dir").isNotNull(),
               F.concat(F.lit(f"Using existing {engine_label}index from: "), F.col("output_dir")))))
    reason = (
        F.when(first_run, F.lit("First time processing - no existing data found"))
        .when(idle, F.concat(F.lit("No changes detected - all "), number("requested"),
                             F.lit(" cases and self-help content unchanged since last processing")))
        .otherwise(F.concat(F.lit("Changes detected: "), changed)))
    use_existing = ~first_run & idle
    if mode == "full" or force:
        use_existing = F.lit(False)
        reason = F.when(first_run, reason).otherwise(F.lit("Force reindex requested by user"))
    empty = F.array().cast("array<string>")
    return rows.select(
        "product_id", "requested", "new_cases", "updated_cases", "unchanged_cases", "existing_cases",
        "selfhelp_changed", (~use_existing).alias("should_process"),
        F.when(use_existing, "UseExisting").otherwise("Process").alias("decision"),
        reason.alias("reason"), F.when(use_existing, skip).otherwise(empty).alias("skip_reasons"))


def reindex_policy(tracking: DataFrame, now: Column, mode: str = "incremental") -> DataFrame:
    """Whether an index has to be rebuilt in full, and the reason given for it."""
    last, never = F.col("last_full_index"), F.col("last_full_index").isNull()
    many = F.col("increments") > MAX_INCREMENTS
    old = F.timestamp_diff("MICROSECOND", last, now) > MAX_INDEX_AGE_DAYS * 86_400_000_000
    due = never | many | F.coalesce(old, F.lit(False)) | F.lit(mode == "full")
    # Texts of the reasons.
    reason = (F.when(never, "First time indexing").when(many, "Too many incremental updates")
              .when(old, "Weekly reindex schedule").otherwise("Requested full reindex"))
    return tracking.select("product_id", due.alias("full_reindex"), reason.alias("reason"))
