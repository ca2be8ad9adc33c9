"""Hand-made rows with expected values for the column expressions."""

import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caselore.functions import text as X


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, expected", [
    ("a\nb\tc", "abc"),
    ("hi From: x To: y\nbye", "hi"),
    ("<img>a<b>c", "c"),
    ("<abbr t>x</abbr>", "x</abbr>"),
    (None, ""),
    ("", ""),
    (" a　", "a"),
    ("x <a href='u'>link</a> y", "x link</a> y"),
    ("From: x  To: y  rest", ""),
])
def test_clean_message(spark, raw, expected):
    assert one(spark, raw, X.clean_message) == expected


@pytest.mark.parametrize("subject, kept", [
    ("Re: help", True), ("New File Uploaded for a", False), ("x {CREDITCARDPII}", False),
    ("Automated Notification", False), ("Automated reply: a", False), ("Automatic reply: a", False),
    ("automatic reply: a", True), (None, None)])
def test_wanted_subject(spark, subject, kept):
    assert one(spark, subject, X.wanted_subject) is kept


def test_scrub_note(spark):
    assert one(spark, "x NAME+EMAILPII y", X.scrub_note) == "x  y"
    assert one(spark, "{CREDITCARDPII}", X.scrub_note) == "{}"
    assert one(spark, "NAMEPII", lambda c: X.scrub_note(c, "literal")) == "NAMEPII" * 16
    with pytest.raises(ValueError):
        X.scrub_note(F.lit("a"), "other")


def test_note_line_is_empty_for_null(spark):
    assert one(spark, None, lambda c: X.note_line(F.lit("2024-01-01").cast("timestamp_ntz"), c)) == ""


@pytest.mark.parametrize("path, first, rest", [("A", "A", ""), ("A\\B\\C", "A", "B\\C"), ("", "", ""), ("\\x", "", "x")])
def test_topic_split(spark, path, first, rest):
    assert one(spark, path, X.first_segment) == first
    assert one(spark, path, X.rest_of_path) == rest


@pytest.mark.parametrize("current, previous, new", [
    ("ab", "ab", ""), ("abc", "ab", "c"), ("xbc", "ab", "xbc"), ("a", "ab", "a"), ("", "", "")])
def test_appended_text(spark, current, previous, new):
    row = spark.createDataFrame([(current, previous)], "c string, p string")
    assert row.select(X.appended_text(F.col("c"), F.col("p"))).first()[0] == new


def test_hash_of_null_is_hash_of_empty(spark):
    assert one(spark, None, X.content_hash) == one(spark, "", X.content_hash)


@settings(max_examples=15, deadline=None)
@given(st.text(max_size=40).filter(lambda s: not any(0xD800 <= ord(c) < 0xE000 for c in s)))
def test_hash_is_base64_sha256(spark, text):
    expected = base64.b64encode(hashlib.sha256(text.encode()).digest()).decode()
    assert one(spark, text, X.content_hash) == expected


def test_file_names(spark):
    assert one(spark, "file:/a/b/case_12.txt", X.case_id_from_file) == "12"
    assert one(spark, "case_case_1.txt", X.case_id_from_file) == "1"
    assert one(spark, "P1_src_P1_x.txt", lambda c: X.title_from_file(c, F.lit("P1"))) == "src_x"


def test_formats(spark):
    row = spark.range(1).select(
        X.fixed_1(F.lit(12.25)), X.percent_1(F.lit(0.4567)), X.yes_no(F.lit(True)),
        X.hours_between(F.lit("2024-01-02").cast("timestamp_ntz"), F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")),
        *[X.priority_tier(F.lit(i)) for i in (4, 5, 7, 8)]).first()
    assert tuple(row) == ("12.3", "45.7%", "Yes", 12.0, "Low", "Medium", "Medium", "High")
