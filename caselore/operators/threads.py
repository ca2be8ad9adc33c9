"""E-mail and note threads of cases.

A thread is one array of pieces per case. A case with more pieces than PART_ROWS cannot be
one row; its thread is cut by time into consecutive parts, so that the parts in order are the
whole thread. The pieces of one minute stay together. part_no is 0 for every other case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.functions.text import email_line, has_text, note_line, split_thread, wanted_subject
from caselore.functions.vocabulary import THREAD_SEPARATOR

PART_ROWS = 10_000


def requested_ids(cases: DataFrame, column: str = "case_id") -> DataFrame:
    """Distinct ids that hold more than white space."""
    return cases.select(F.col(column).alias("case_id")).filter(has_text(F.col("case_id"))).distinct()


def email_pieces(emails: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(case_id, created_ts, text) of the wanted e-mails of the requested cases."""
    kept = emails.filter(wanted_subject(F.col("subject"))).withColumnRenamed("ticket_number", "case_id")
    if ids is not None:
        kept = kept.join(ids, "case_id", "left_semi")
    return kept.select(
        F.coalesce("case_id", F.lit("")).alias("case_id"), "created_ts",
        email_line(F.col("subject"), F.col("created_ts"), F.col("description")).alias("text"))


def latest_notes(notes: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The newest of notes with the same case and text.

    A maximum per (case, text) combines copies before the shuffle, so a note that is copied
    many times does not gather in one task.
    """
    kept = notes.withColumnRenamed("ticket_number", "case_id")
    if ids is not None:
        kept = kept.join(ids, "case_id", "left_semi")
    return kept.groupBy("case_id", "note_text").agg(F.max("created_ts").alias("created_ts"))


def note_pieces(notes: DataFrame, ids: DataFrame | None = None, mode: str = "sequential") -> DataFrame:
    return latest_notes(notes, ids).select(
        F.coalesce("case_id", F.lit("")).alias("case_id"), "created_ts",
        note_line(F.col("created_ts"), F.col("note_text"), mode).alias("text"))


def long_threads(pieces: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Ids of the cases whose thread has more than part_rows pieces."""
    return (pieces.groupBy("case_id").agg(F.count("*").alias("n"))
            .filter(F.col("n") > part_rows).select("case_id"))


def _gather(pieces: DataFrame, *keys: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("created_ts", "text")))
    thread = F.array_join(F.transform(ordered, lambda p: p["text"]), THREAD_SEPARATOR)
    return pieces.groupBy(*keys).agg(thread.alias("thread")).select(*keys, "thread")


def long_or_none(pieces: DataFrame, part_rows: int = PART_ROWS) -> DataFrame | None:
    """long_threads, or None if there is none. The check reads the id and filter columns only."""
    long_ids = long_threads(pieces, part_rows)
    return None if long_ids.isEmpty() else long_ids


def threads(pieces: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(case_id, part_no, thread): pieces by creation time, then text, joined by the separator."""
    return gather_threads(pieces, long_or_none(pieces, part_rows), part_rows)


def gather_threads(pieces: DataFrame, long_ids: DataFrame | None, part_rows: int = PART_ROWS) -> DataFrame:
    """One aggregation if no thread is long; else rows of the long ones get the part of their minute."""
    if long_ids is None:
        return _gather(pieces, "case_id").withColumn("part_no", F.lit(0))
    minute = F.coalesce(F.date_trunc("minute", "created_ts").cast("timestamp_ntz"),
                        F.lit("0001-01-01").cast("timestamp_ntz"))
    timed = pieces.withColumn("minute", minute)
    earlier = (Window.partitionBy("case_id").orderBy("minute")
               .rowsBetween(Window.unboundedPreceding, -1))
    parts = (timed.join(long_ids, "case_id", "left_semi")
             .groupBy("case_id", "minute").agg(F.count("*").alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
             .select("case_id", "minute",
                     F.floor(F.col("before") / part_rows).cast("int").alias("raw_part")))
    dense = F.dense_rank().over(Window.partitionBy("case_id").orderBy("raw_part")) - 1
    parts = parts.select("case_id", "minute", dense.alias("part"))
    cut = timed.join(parts, ["case_id", "minute"], "left").withColumn("part_no", F.coalesce("part", F.lit(0)))
    return _gather(cut, "case_id", "part_no")


def with_pieces(threads: DataFrame, max_pieces: int | None = None) -> DataFrame:
    """Split each thread text into its pieces; keep the first max_pieces of every case.

    A piece that holds the separator itself counts as several pieces.
    """
    split = threads.withColumn("pieces", split_thread(F.col("thread"))).drop("thread")
    if max_pieces is None:
        return split
    earlier = (Window.partitionBy("case_id").orderBy("part_no")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum(F.size("pieces")).over(earlier), F.lit(0))
    left = F.greatest(F.lit(max_pieces) - before, F.lit(0)).cast("int")
    return (split.withColumn("left", left).withColumn("pieces", F.slice("pieces", F.lit(1), F.col("left")))
            .filter((F.col("part_no") == 0) | (F.col("left") > 0)).drop("left"))
