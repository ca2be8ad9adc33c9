"""One document per case: head, customer communication, resolution steps."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.functions.vocabulary import PIECE_SEPARATOR
from caselore.operators import threads as th


# The lines of the document head; names in braces are columns.
DOCUMENT_HEAD = """
=== SUPPORT CASE: {case_id} ===
Product: {product_name}
Area: {sap_path}
Title: {internal_title}
Severity: {sr_severity} (Max: {sr_max_severity})
Resolution Time: {case_age} days
Customer Interactions: {email_interactions} emails, {phone_interactions} calls
Case Age: {case_age} days
Idle Days: {case_idle_days} case, {communication_idle_days} communication

=== CUSTOMER PROBLEM ===
"""


def document_head() -> Column:
    texts = re.split(r"\{(\w+)\}", DOCUMENT_HEAD)
    parts = ["'" + t.replace("\n", "\\n") + "'" if i % 2 == 0 else t for i, t in enumerate(texts)]
    return F.expr(f"concat({', '.join(parts)})")


EMAIL_TITLE = "CUSTOMER COMMUNICATIONS:\n"
NOTE_TITLE = "=== RESOLUTION STEPS ===\n"


def documents_of(cases: DataFrame, emails: DataFrame, notes: DataFrame, max_emails: int | None = None,
                 note_mode: str = "sequential", part_rows: int = th.PART_ROWS) -> DataFrame:
    """Documents of the cases from raw e-mails and notes.

    Communications of other cases are dropped by a semi join, whose partitioning by case id
    serves the gathering of the threads too.
    """
    ids = th.requested_ids(cases)
    mails, steps = th.email_pieces(emails, ids), th.note_pieces(notes, ids, note_mode)
    # raw counts, dropped and repeated messages included: more cases may count as long, none is missed
    long_mails, long_steps = (
        th.long_or_none(raw.select(F.col("ticket_number").alias("case_id")), part_rows) for raw in (emails, notes))
    found = [x for x in (long_mails, long_steps) if x is not None]
    long_ids = reduce(DataFrame.unionByName, found).distinct() if found else None
    return case_documents(
        cases,
        th.with_pieces(th.gather_threads(mails, long_mails, part_rows), max_emails),
        th.with_pieces(th.gather_threads(steps, long_steps, part_rows)),
        long_ids)


def case_documents(cases: DataFrame, emails: DataFrame, notes: DataFrame, long_ids: DataFrame | None = None) -> DataFrame:
    """(product_id, case_id, part_no, content) from the pieces of e-mails and notes.

    Cases without a thread get no section for it. With long_ids the threads of those cases
    have several parts; the document then has one row per part, and the rows in order are the
    whole document.
    """
    def lookup(threads: DataFrame, name: str) -> DataFrame:
        return threads.select("case_id", F.col("pieces").alias(name))

    def section(title: str, name: str, end: str) -> Column:
        body = F.concat(F.lit(title), F.array_join(name, PIECE_SEPARATOR), F.lit(end))
        return F.when(F.col(name).isNotNull(), body).otherwise(F.lit(""))

    short, short_mails, short_notes = cases, emails, notes
    if long_ids is not None:
        short = cases.join(long_ids, "case_id", "left_anti")
        short_mails, short_notes = emails.filter("part_no = 0"), notes.filter("part_no = 0")
    content = F.concat(document_head(), section(EMAIL_TITLE, "mails", "\n\n"), section(NOTE_TITLE, "steps", "\n"))
    documents = (
        short.join(lookup(short_mails, "mails"), "case_id", "left")
        .join(lookup(short_notes, "steps"), "case_id", "left")
        .select("product_id", "case_id", F.lit(0).alias("part_no"), content.alias("content")))
    if long_ids is None:
        return documents
    return documents.unionByName(_long_documents(cases, emails, notes, long_ids))


def _long_documents(cases: DataFrame, emails: DataFrame, notes: DataFrame, long_ids: DataFrame) -> DataFrame:
    """Rows of the documents whose threads have several parts."""
    chosen = cases.join(long_ids, "case_id", "left_semi")

    def parts(threads: DataFrame, section: int, title: str, end: str) -> DataFrame:
        last = threads.groupBy("case_id").agg(F.max("part_no").alias("last"))
        text = F.concat(
            F.when(F.col("part_no") == 0, F.lit(title)).otherwise(F.lit(PIECE_SEPARATOR)),
            F.array_join("pieces", PIECE_SEPARATOR),
            F.when(F.col("part_no") == F.col("last"), F.lit(end)).otherwise(F.lit("")))
        return (threads.join(last, "case_id").join(chosen.select("case_id", "product_id"), "case_id")
                .select("product_id", "case_id", F.lit(section).alias("section"), "part_no", text.alias("content")))

    mails = parts(emails, 1, EMAIL_TITLE, "\n\n")
    n_mail_parts = mails.groupBy("case_id").agg(F.count("*").alias("mail_parts"))
    head = chosen.select("product_id", "case_id", F.lit(0).alias("section"), F.lit(0).alias("part_no"),
                         document_head().alias("content"))
    rows = head.unionByName(mails).unionByName(parts(notes, 2, NOTE_TITLE, "\n"))
    place = (F.when(F.col("section") == 0, F.lit(0))
             .when(F.col("section") == 1, F.col("part_no") + 1)
             .otherwise(F.col("part_no") + 1 + F.coalesce("mail_parts", F.lit(0))))
    return rows.join(n_mail_parts, "case_id", "left").select(
        "product_id", "case_id", place.cast("int").alias("part_no"), "content")
