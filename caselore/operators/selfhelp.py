"""Self-help files: what is new in them, and the corpus text kept per product.

The corpus text of a product grows without bound, so it is kept as ordered rows
(product_id, part, file_name, content); the rows in order are the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.functions.text import appended_text, content_hash, has_text, stamp, title_from_file, trim_end
from caselore.session import scratch_path

KEY = ["product_id", "file_name"]


def selfhelp_changed(files: DataFrame, tracking: DataFrame, products: DataFrame, directory_exists: bool = True) -> DataFrame:
    """Per product: true without tracking, else whether any file is new or differs.

    Only names and hashes are joined.
    """
    tracked = tracking.select("product_id").distinct().withColumn("tracked", F.lit(True))
    base = products.select("product_id").join(tracked, "product_id", "left")
    untracked = F.col("tracked").isNull()
    if not directory_exists:
        return base.select("product_id", untracked.alias("selfhelp_changed"))
    stored = tracking.select(*KEY, content_hash(F.col("processed_content")).alias("stored_hash"))
    current = files.select(*KEY, content_hash(F.col("content")).alias("current_hash"))
    differs = (current.join(stored, KEY, "left")
               .select("product_id", (~F.col("current_hash").eqNullSafe(F.col("stored_hash"))).alias("differs"))
               .groupBy("product_id").agg(F.bool_or("differs").alias("differs")))
    return base.join(differs, "product_id", "left").select(
        "product_id", (untracked | F.coalesce("differs", F.lit(False))).alias("selfhelp_changed"))


def selfhelp_diff(files: DataFrame, tracking: DataFrame) -> DataFrame:
    """Per file with text: status (new, incremental, unchanged) and the new text."""
    seen = tracking.select(*KEY, "processed_content", "last_processed")
    return compared(files.select(*KEY, "content", "modified_ts").filter(has_text(F.col("content"))).join(seen, KEY, "left"))


def compared(rows: DataFrame) -> DataFrame:
    """selfhelp_diff of rows that bring what was processed before, null for nothing; further columns stay."""
    more = [c for c in rows.columns if c not in (*KEY, "content", "modified_ts", "processed_content", "last_processed")]
    known = F.col("processed_content").isNotNull()
    fresh = F.when(known, appended_text(F.col("content"), F.col("processed_content"))).otherwise(F.col("content"))
    status = F.when(~known, "new").when(has_text(F.col("new_content")), "incremental").otherwise("unchanged")
    return rows.withColumn("new_content", fresh).select(
        *KEY, status.alias("status"), "new_content", "content", "modified_ts", "last_processed", *more)


def section_text() -> Column:
    title = title_from_file(F.col("file_name"), F.col("product_id"))
    kind = F.when(F.col("status") == "new", "NEW FILE").otherwise("INCREMENTAL UPDATE")
    # The lines of a section.
    return F.concat(
        F.lit("\n\n=== SELF-HELP CONTENT UPDATE: "), title, F.lit(" (ProductId: "), F.col("product_id"),
        F.lit(") ===\nSource File: "), F.col("file_name"),
        F.lit("\nUpdate Type: "), kind,
        F.lit("\nNew Content Length: "), F.char_length("new_content").cast("string"),
        F.lit(" characters\nLast Updated: "), stamp(F.col("modified_ts")),
        F.lit("\n\n"), F.col("new_content"), F.lit("\n\n=== END "), title, F.lit(" UPDATE ===\n"))


def selfhelp_sections(diff: DataFrame) -> DataFrame:
    """One section per file with new text."""
    return diff.filter(F.col("status") != "unchanged").select(*KEY, "status", section_text().alias("section"))


def tracking_after(diff: DataFrame, tracking: DataFrame, now: Column) -> DataFrame:
    """Tracking rows after a run; they are replaced only where some file had new text.

    The compared files are stored once, without the texts they were compared to. The products with new text, a short row each,
    are sent to the texts, which are never dealt by product.
    """
    spark, path = diff.sparkSession, scratch_path(diff.sparkSession, "compared")
    diff.select(*KEY, "status", "content", "last_processed").write.parquet(path)
    diff = spark.read.schema(diff.select(*KEY, "status", "content", "last_processed").schema).parquet(path)
    renewed = F.broadcast(diff.filter(F.col("status") != "unchanged").select("product_id").distinct())
    last = F.when(F.col("status") == "unchanged", F.col("last_processed")).otherwise(now)
    fresh = diff.join(renewed, "product_id", "left_semi").select(
        *KEY, F.col("content").alias("processed_content"), last.alias("last_processed"),
        F.char_length("content").alias("content_length"))
    return tracking.join(renewed, "product_id", "left_anti").select(*fresh.columns).unionByName(fresh)


PLACEHOLDER_FOLDER = "Selfhelp"


def selfhelp_corpus(
    files: DataFrame,
    sections: DataFrame,
    existing: DataFrame,
    products: DataFrame,
    now: Column,
    folder: str = PLACEHOLDER_FOLDER,
    engine_label: str = "",
) -> DataFrame:
    """(product_id, doc_kind, part, file_name, content), in order of part and file name.

    Nothing new: the stored text stays. No stored text: head, sections, end. Else: stored
    text, sections, update mark. A product without any file gets the placeholder.
    """
    n_files = files.groupBy("product_id").agg(F.count("*").alias("n_files"))
    new = sections.groupBy("product_id").agg(F.count("*").alias("n_sections"))
    state = (products.select("product_id").join(n_files, "product_id", "left")
             .join(new, "product_id", "left")
             .join(existing.select("product_id", F.col("content").alias("stored")), "product_id", "left")
             .withColumn("stored", F.when(F.col("stored") != "", F.col("stored"))))
    p, time = F.col("product_id"), stamp(now)
    # The texts around the sections.
    head = F.concat(
        F.lit("=== EXISTING SELF-HELP DOCUMENTATION FOR PRODUCT "), p, F.lit(" ===\n\nProduct ID: "), p,
        F.lit("\nContent Type: Self-Help Documentation (Content-Diff Tracking)\nTotal Files Monitored: "),
        F.col("n_files").cast("string"), F.lit("\nLast Updated: "), time, F.lit("\n\n"))
    # sections end with the newline that separates them, so what follows starts with one less
    end = F.concat(F.lit("\n=== END ALL SELF-HELP CONTENT FOR PRODUCT "), p, F.lit(" ==="))
    mark = F.concat(F.lit("\n=== CONTENT-DIFF UPDATE COMPLETED: "), time, F.lit(" ==="))
    placeholder = F.concat(
        F.lit("=== NO EXISTING SELF-HELP CONTENT FOUND FOR PRODUCT "), p, F.lit(" ===\n\nProduct ID: "), p,
        F.lit(f"\nExpected File Pattern: {folder}\\"), p,
        F.lit("_*.txt\nStatus: No existing self-help content found\n\n"
              "This indicates there may be limited or no existing self-help documentation for this product.\n"
              f"{engine_label}analysis should focus on identifying the most critical content gaps."))
    has_new, has_old = F.col("n_sections").isNotNull(), F.col("stored").isNotNull()

    def row(kind: str, part: int, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("doc_kind"), F.lit(part).alias("part"),
                        F.lit("").alias("file_name"), text.alias("content"))

    around = state.select("product_id", F.explode(F.array_compact(F.array(
        F.when(has_old, row("selfhelp", 0, F.when(has_new, trim_end(F.col("stored"))).otherwise(F.col("stored")))),
        F.when(has_new & ~has_old, row("selfhelp", 0, head)),
        F.when(has_new, row("selfhelp", 2, F.when(has_old, mark).otherwise(end))),
        F.when(F.col("n_files").isNull(), row("placeholder", 0, placeholder)),
    ))).alias("r")).select("product_id", "r.*")
    body = sections.select("product_id", F.lit("selfhelp").alias("doc_kind"), F.lit(1).alias("part"), "file_name",
                           F.concat("section", F.lit("\n")).alias("content"))
    return around.unionByName(body)


def corpus_union(case_corpus: DataFrame, selfhelp: DataFrame) -> DataFrame:
    """Case documents, self-help text and placeholders as one table."""
    columns = ["product_id", "doc_kind", "doc_key", "part", "content_hash"]
    cases = case_corpus.select("product_id", F.lit("case").alias("doc_kind"), F.col("case_id").alias("doc_key"),
                               F.col("part_no").alias("part"), "content_hash")
    other = selfhelp.withColumn("content_hash", content_hash(F.col("content"))).withColumnRenamed("file_name", "doc_key")
    return cases.unionByName(other.select(*columns))
