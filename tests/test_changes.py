"""Change detection, decisions, self-help diffs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from caselore.operators import changes as ch
from caselore.operators import selfhelp as sh

DOC = "product_id string, case_id string, part_no int, content string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_classes(spark):
    new = docs(spark, [("P", "a", 0, "x"), ("P", "b", 0, "y2"), ("P", "c", 0, "z"), ("Q", "a", 0, "x")])
    old = ch.with_hash(docs(spark, [("P", "b", 0, "y"), ("P", "c", 0, "z"), ("P", "gone", 0, "g")]))
    found = {(r["product_id"], r["case_id"]): r for r in ch.classify_changes(new, old).collect()}
    assert {k: r["change_type"] for k, r in found.items()} == {
        ("P", "a"): "New", ("P", "b"): "Updated", ("P", "c"): "Unchanged", ("Q", "a"): "New"}
    assert found[("P", "a")]["old_hash"] is None and found[("P", "a")]["new_hash"] is None
    assert found[("P", "b")]["old_hash"] != found[("P", "b")]["new_hash"]
    assert [r["case_id"] for r in ch.removed_cases(new, old).collect()] == ["gone"]
    assert sorted(r["case_id"] for r in ch.work_set(new, old).filter("product_id = 'P'").collect()) == ["a"]
    assert sorted(r["case_id"] for r in ch.work_set(new, old, "new_or_updated").filter("product_id = 'P'").collect()) == ["a", "b"]
    assert ch.work_set(new, old, skip_existing=False).count() == 4
    with pytest.raises(ValueError):
        ch.work_set(new, old, "other")


def test_a_changed_part_updates_the_case(spark):
    old = ch.with_hash(docs(spark, [("P", "a", 0, "x"), ("P", "a", 1, "y"), ("P", "b", 0, "x"), ("P", "b", 1, "y")]))
    new = docs(spark, [("P", "a", 0, "x"), ("P", "a", 1, "z"), ("P", "b", 1, "y"), ("P", "b", 0, "x")])
    assert {r["case_id"]: r["change_type"] for r in ch.classify_changes(new, old).collect()} == {"a": "Updated", "b": "Unchanged"}


def test_upsert_twice_leaves_nothing_to_do(spark):
    rng = random.Random(3)
    old = ch.with_hash(docs(spark, [("P", str(i), 0, str(rng.random())) for i in range(40)]))
    new = docs(spark, [("P", str(i), 0, f"n{i}") for i in range(20, 60)])
    corpus = ch.upsert_corpus(old, ch.work_set(new, old, "new_or_updated"))
    assert corpus.count() == 60
    assert {r["change_type"] for r in ch.classify_changes(new, corpus).collect()} == {"Unchanged"}


def test_stable_hash_ignores_the_age_lines(spark):
    text = ("\n=== SUPPORT CASE: 1 ===\nProduct: p\nArea: a\nTitle: t\nSeverity: 1 (Max: 1)\nResolution Time: {0} days\n"
            "Customer Interactions: 1 emails, 2 calls\nCase Age: {0} days\nIdle Days: 1 case, 0 communication\nCase Age: 5 days\n")
    rows = docs(spark, [("P", "a", 0, text.format(3)), ("P", "b", 0, text.format(44)), ("P", "c", 0, text.format(3) + "x")])
    stable = {r["case_id"]: r["content_hash"] for r in ch.with_hash(rows, stable=True).collect()}
    assert stable["a"] == stable["b"] != stable["c"]
    plain = {r["case_id"]: r["content_hash"] for r in ch.with_hash(rows).collect()}
    assert plain["a"] != plain["b"]
    assert rows.select(ch.without_age(F.col("content"))).first()[0].endswith("communication\nCase Age: 5 days\n")


def decide(spark, stats, changed, last=None, **params):
    s = spark.createDataFrame([("P", *stats)], "product_id string, requested long, new_cases long, updated_cases long,"
                              " unchanged_cases long, existing_cases long")
    c = spark.createDataFrame([("P", changed)], "product_id string, selfhelp_changed boolean")
    runs = spark.createDataFrame([("P", last, None)], "product_id string, last_processed timestamp_ntz, output_dir string")
    return ch.processing_decision(s, c, runs, F.lit("2024-01-02").cast("timestamp_ntz"), **params).first()


def test_decisions(spark):
    first = decide(spark, (3, 3, 0, 0, 0), True)
    assert (first["decision"], first["reason"]) == ("Process", "First time processing - no existing data found")
    idle = decide(spark, (3, 0, 0, 3, 9), False, dt.datetime(2024, 1, 1))
    assert (idle["decision"], idle["should_process"]) == ("UseExisting", False)
    assert idle["skip_reasons"] == ["No new cases found (analyzed 3 cases, all 3 unchanged)", "No case content updates detected",
                                    "Self-help content unchanged", "Last processed: 2024-01-01 00:00:00 (24.0 hours ago)"]
    assert decide(spark, (3, 0, 0, 3, 9), False)["skip_reasons"][3].startswith("Last processed: 0001-01-01 00:00:00 (")
    for params in ({"force": True}, {"mode": "full"}):
        forced = decide(spark, (3, 0, 0, 3, 9), False, **params)
        assert (forced["decision"], forced["reason"], forced["skip_reasons"]) == ("Process", "Force reindex requested by user", [])
    assert decide(spark, (3, 1, 2, 0, 9), True)["reason"] == "Changes detected: 1 new cases, 2 updated cases, self-help content changed"
    assert decide(spark, (3, 0, 0, 3, 9), True)["reason"] == "Changes detected: self-help content changed"


def test_reindex_policy(spark):
    now = dt.datetime(2024, 1, 9)
    rows = [("ten", now, 10), ("eleven", now, 11), ("week", dt.datetime(2024, 1, 2), 0),
            ("longer", dt.datetime(2024, 1, 1, 21, 36), 0), ("never", None, 0)]
    df = spark.createDataFrame(rows, "product_id string, last_full_index timestamp_ntz, increments int")
    at = F.lit("2024-01-09").cast("timestamp_ntz")
    found = {r["product_id"]: (r["full_reindex"], r["reason"]) for r in ch.reindex_policy(df, at).collect()}
    assert found == {"ten": (False, "Requested full reindex"), "eleven": (True, "Too many incremental updates"),
                     "week": (False, "Requested full reindex"), "longer": (True, "Weekly reindex schedule"),
                     "never": (True, "First time indexing")}
    assert all(r["full_reindex"] for r in ch.reindex_policy(df, at, mode="full").collect())


# --- self-help ------------------------------------------------------------------------------

FILE = "product_id string, file_name string, content string, modified_ts timestamp_ntz"
TRACK = "product_id string, file_name string, processed_content string, last_processed timestamp_ntz, content_length int"
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1)


def inputs(spark, files, tracking):
    f = spark.createDataFrame([("P", n, c, T0) for n, c in files], FILE)
    t = spark.createDataFrame([("P", n, c, T1, len(c)) for n, c in tracking], TRACK)
    return f, t, spark.createDataFrame([("P",)], "product_id string")


def now():
    return F.lit("2024-05-01").cast("timestamp_ntz")


@pytest.mark.parametrize("files, tracking, directory, expected", [
    ([("a", "x")], [], True, True), ([("a", "x")], [("a", "x")], False, False),
    ([("a", "x"), ("b", "y")], [("a", "x")], True, True), ([("a", "x")], [("a", "x"), ("gone", "g")], True, False),
    ([("a", "xy")], [("a", "x")], True, True), ([], [("a", "x")], True, False)])
def test_selfhelp_changed(spark, files, tracking, directory, expected):
    assert sh.selfhelp_changed(*inputs(spark, files, tracking), directory).first()["selfhelp_changed"] is expected


def test_diff_and_tracking(spark):
    files, tracking, products = inputs(
        spark, [("P_new.txt", "n"), ("P_same.txt", "s"), ("P_more.txt", "abc"), ("P_blanks.txt", "ab  "), ("P_empty.txt", " \n")],
        [("P_same.txt", "s"), ("P_more.txt", "ab"), ("P_blanks.txt", "ab"), ("P_gone.txt", "g")])
    diff = sh.selfhelp_diff(files, tracking)
    assert {r["file_name"]: (r["status"], r["new_content"]) for r in diff.collect()} == {
        "P_new.txt": ("new", "n"), "P_same.txt": ("unchanged", ""), "P_more.txt": ("incremental", "c"),
        "P_blanks.txt": ("unchanged", "  ")}
    after = {r["file_name"]: (r["processed_content"], r["last_processed"]) for r in sh.tracking_after(diff, tracking, now()).collect()}
    later = dt.datetime(2024, 5, 1)
    assert after == {"P_new.txt": ("n", later), "P_same.txt": ("s", T1), "P_more.txt": ("abc", later), "P_blanks.txt": ("ab  ", T1)}
    idle = sh.selfhelp_diff(files.filter("file_name = 'P_same.txt'"), tracking)
    assert sh.tracking_after(idle, tracking, now()).count() == 4  # unchanged, the row of the lost file too


def corpus_text(spark, files, tracking, stored):
    f, t, products = inputs(spark, files, tracking)
    existing = spark.createDataFrame([("P", stored)] if stored is not None else [], "product_id string, content string")
    rows = sh.selfhelp_corpus(f, sh.selfhelp_sections(sh.selfhelp_diff(f, t)), existing, products, now()).collect()
    return "".join(r["content"] for r in sorted(rows, key=lambda r: (r["part"], r["file_name"])))


def section(name, kind, text):
    return (f"\n\n=== SELF-HELP CONTENT UPDATE: {name} (ProductId: P) ===\nSource File: P_{name}.txt\nUpdate Type: {kind}\n"
            f"New Content Length: {len(text)} characters\nLast Updated: 2024-01-01 00:00:00\n\n{text}\n\n=== END {name} UPDATE ===\n")


def test_corpus_text(spark):
    files = [("P_b.txt", "bb"), ("P_a.txt", "aaa")]
    fresh = corpus_text(spark, files, [], None)
    assert fresh == (
        "=== EXISTING SELF-HELP DOCUMENTATION FOR PRODUCT P ===\n\nProduct ID: P\n"
        "Content Type: Self-Help Documentation (Content-Diff Tracking)\nTotal Files Monitored: 2\nLast Updated: 2024-05-01 00:00:00\n\n"
        + section("a", "NEW FILE", "aaa") + "\n" + section("b", "NEW FILE", "bb")
        + "\n\n=== END ALL SELF-HELP CONTENT FOR PRODUCT P ===")
    appended = corpus_text(spark, files, [("P_b.txt", "bb"), ("P_a.txt", "a")], "old \n")
    assert appended == ("old" + section("a", "INCREMENTAL UPDATE", "aa")
                        + "\n\n=== CONTENT-DIFF UPDATE COMPLETED: 2024-05-01 00:00:00 ===")
    assert corpus_text(spark, files, [("P_b.txt", "bb"), ("P_a.txt", "aaa")], "old \n") == "old \n"
    assert corpus_text(spark, [], [], None).startswith("=== NO EXISTING SELF-HELP CONTENT FOUND FOR PRODUCT P ===")
