"""Column expressions for cleaning, formatting, hashing and comparing text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselore.functions.vocabulary import EMAIL_SUBJECT_EXCLUSIONS, NOTE_PATTERNS, THREAD_SEPARATOR

SECONDS = "yyyy-MM-dd HH:mm:ss"


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def stamp(col: Column) -> Column:
    """Timestamp as yyyy-MM-dd HH:mm:ss."""
    return F.date_format(col, SECONDS)


def trim_unicode(col: Column) -> Column:
    """Strip all Unicode white space at both ends (F.trim strips blanks only)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def trim_end(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)\s+$", "")


def has_text(col: Column) -> Column:
    """True where something other than white space is present; false for null."""
    return F.coalesce(col.rlike(r"(?U)\S"), F.lit(False))


# --- support topic path -------------------------------------------------------------------

def first_segment(path: Column) -> Column:
    """Text before the first backslash, the whole text if there is none."""
    return F.substring_index(path, "\\", 1)


def rest_of_path(path: Column) -> Column:
    """At most 1000 characters after the first backslash, else an empty text."""
    start = F.locate("\\", F.concat(path, F.lit("\\"))) + 1
    return F.substring(path, start, F.lit(1000))


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


# --- e-mails and notes --------------------------------------------------------------------

def wanted_subject(subject: Column) -> Column:
    """Null for a null subject, so a filter drops it."""
    keep = ~F.contains(subject, F.lit(EMAIL_SUBJECT_EXCLUSIONS[0]))
    for text in EMAIL_SUBJECT_EXCLUSIONS[1:]:
        keep = keep & ~F.contains(subject, F.lit(text))
    return keep


def clean_message(raw: Column) -> Column:
    """Drop tabs and newlines, quoted mail heads to the end, image and anchor tags; trim.

    (?d) makes the dot stop at a newline only, not at the other Unicode line ends.
    """
    out = F.regexp_replace(raw, r"[\t\n\r]", "")
    for pattern in (r"(?d)From:(.+?)To:(.+)", r"(?d)<img(.+?)>", r"(?d)<a(.*?)>"):
        out = F.regexp_replace(out, pattern, "")
    return F.coalesce(trim_unicode(out), F.lit(""))


def email_line(subject: Column, created: Column, message: Column) -> Column:
    return F.concat(
        F.lit("Subject: "), text_or_empty(subject),
        F.lit("; Created On: "), F.coalesce(stamp(created), F.lit("")),
        F.lit("; Message: "), clean_message(message),
    )


def scrub_note(note: Column, mode: str = "sequential") -> Column:
    """Remove the placeholder texts.

    sequential: all of them from one copy, in order. literal: one copy of the note per
    pattern, each without that pattern, one after the other.
    """
    if mode == "literal":
        return F.concat(*[F.replace(note, F.lit(p), F.lit("")) for p in NOTE_PATTERNS])
    if mode != "sequential":
        raise ValueError(f"unknown scrub mode {mode!r}")
    for pattern in NOTE_PATTERNS:
        note = F.replace(note, F.lit(pattern), F.lit(""))
    return note


def note_line(created: Column, note: Column, mode: str = "sequential") -> Column:
    return F.coalesce(F.concat(stamp(created), F.lit(" | "), scrub_note(note, mode)), F.lit(""))


def split_thread(thread: Column) -> Column:
    return F.split(thread, re.escape(THREAD_SEPARATOR), -1)


# --- hashing and comparing ----------------------------------------------------------------

def content_hash(text: Column) -> Column:
    """Base64 of the SHA-256 of the text; null counts as empty."""
    return F.base64(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)))


def short_id(*parts: Column) -> Column:
    """Repeatable id: the first 32 hex digits of a hash over the parts."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32)


def appended_text(current: Column, previous: Column) -> Column:
    """'' if equal, the suffix if the previous text was only extended, else the whole text."""
    suffix = F.substring(current, F.char_length(previous) + 1, F.char_length(current))
    return (
        F.when(current == previous, F.lit(""))
        .when(F.startswith(current, previous), suffix)
        .otherwise(current)
    )


def case_id_from_file(path: Column) -> Column:
    """Base name without its extension and without any 'case_'."""
    base = F.regexp_extract(path, r"([^/\\]*?)(\.[^./\\]*)?$", 1)
    return F.replace(base, F.lit("case_"), F.lit(""))


def title_from_file(file_name: Column, product_id: Column) -> Column:
    """File name without '<product>_' and without '.txt'."""
    bare = F.replace(file_name, F.concat(product_id, F.lit("_")), F.lit(""))
    return F.replace(bare, F.lit(".txt"), F.lit(""))


# --- numbers and labels -------------------------------------------------------------------

def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def fixed_1(number: Column) -> Column:
    """One decimal, no grouping."""
    return F.format_string("%.1f", number.cast("double"))


def percent_1(share: Column) -> Column:
    return F.concat(F.format_string("%.1f", (share * 100).cast("double")), F.lit("%"))


def hours_between(later: Column, earlier: Column) -> Column:
    seconds = F.timestamp_diff("SECOND", earlier, later)
    return seconds / F.lit(3600.0)


def priority_tier(impact: Column) -> Column:
    return F.when(impact > 7, "High").when(impact > 4, "Medium").otherwise("Low")


def minutes_between(later: Column, earlier: Column) -> Column:
    """Processing time of a run in minutes, null if either end is unknown."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(60_000_000.0)
