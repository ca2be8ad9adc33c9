"""Case loading, threads and documents."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from caselore.operators import cases as cs
from caselore.operators import documents as docs
from caselore.operators import threads as th
from caselore.functions.vocabulary import THREAD_SEPARATOR

FACT = ("sap_key int, sr_number string, sr_owner string, sr_status string, service_request_status string,"
        " sr_severity string, sr_max_severity string, internal_title string, first_assignment_ts timestamp_ntz,"
        " case_idle_days int, communication_idle_days int, is_s500 boolean, collaboration_tasks int,"
        " phone_interactions int, email_interactions int, ir_status string, is_transferred boolean,"
        " sr_age_days int, created_ts timestamp_ntz, closed_ts timestamp_ntz")
AREA = "sap_key int, product_name string, pes_product_id string, sap_path string, support_topic_id string"


def fact_row(number, key=1, status="Closed", created=dt.datetime(2024, 1, 1, 23, 59), age=3, idle=1):
    return (key, number, None, status, "s", "2", "1", None, None, idle, 0, False, 0, 2, 1, None, True, age, created, None)


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([(1, "Prod", "P1", "A\\B", "T\\L3\\x"), (2, "Other", "P2", "C", None)], AREA)


def as_of():
    return F.lit("2024-01-02 00:01:00").cast("timestamp_ntz")


def ids(df):
    return sorted(r["case_id"] for r in df.select("case_id").collect())


def test_filters(spark, areas):
    fact = spark.createDataFrame([fact_row("a"), fact_row("b", status="Open"), fact_row("c", key=2, age=20),
                                  fact_row("d", key=9), fact_row("e", age=0)], FACT)
    load = lambda **p: ids(cs.closed_cases(fact, areas, as_of(), **p))
    assert load() == ["a", "c", "e"]
    assert load(product_id="P1") == ["a", "e"]
    assert load(sap_path="A/B") == load(sap_path="A\\B") == ["a", "e"]
    assert load(sap_path="") == ["a", "c", "e"]
    assert load(case_id="c") == ["c"]
    assert load(max_age_days=-1) == load(max_age_days=None) == ["a", "c", "e"]
    assert load(max_age_days=0) == ["e"]


def test_columns(spark, areas):
    fact = spark.createDataFrame([fact_row("a"), fact_row("c", key=2)], FACT)
    rows = {r["case_id"]: r for r in cs.closed_cases(fact, areas, as_of()).collect()}
    assert rows["a"]["case_age"] == 1  # one midnight
    assert rows["a"]["internal_title"] == "" and rows["a"]["closed_ts"] is None
    assert (rows["a"]["support_topic_l2"], rows["a"]["support_topic_l3"]) == ("T", "L3\\x")
    assert (rows["c"]["support_topic_l2"], rows["c"]["support_topic_l3"]) == ("", "")


def test_null_number_is_an_error(spark, areas):
    fact = spark.createDataFrame([fact_row("a", idle=None)], FACT)
    with pytest.raises(Exception, match="case_idle_days must not be null"):
        cs.closed_cases(fact, areas, as_of()).collect()


@pytest.mark.parametrize("n", [1, 3, 7, 50, 1000])
def test_newest_for_large_n_agrees_with_sorting(spark, n):
    rng = random.Random(n)
    base = dt.datetime(2024, 1, 1)
    rows = [(f"P{rng.choice('0001')}", f"c{i:03d}", base + dt.timedelta(hours=rng.randrange(3) * 12, microseconds=rng.randrange(2)))
            for i in range(120)]
    rows += [("P2", "solo", None)]
    df = spark.createDataFrame(rows, "product_id string, case_id string, created_ts timestamp_ntz")
    expected = []
    for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        group = sorted(group, key=lambda r: (-(r[2] or dt.datetime.min.replace(year=2)).timestamp() if r[2] else 0, r[1]))
        expected += [r[1] for r in group[:n]]
    assert ids(cs.newest_per_product(df, n, window_limit=0)) == sorted(expected)
    assert ids(cs.newest_per_product(df, n)) == sorted(expected)


def test_request_order(spark):
    df = spark.createDataFrame([("b", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 1)), ("c", dt.datetime(2024, 2, 1))],
                               "case_id string, created_ts timestamp_ntz")
    assert [r["case_id"] for r in cs.in_request_order(df).collect()] == ["c", "a", "b"]


# --- threads --------------------------------------------------------------------------------

def pieces(spark, rows):
    return spark.createDataFrame(
        [(c, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), t) for c, s, t in rows],
        "case_id string, created_ts timestamp_ntz, text string")


def random_pieces(seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["hot"] * 6 + ["a", "b"]), rng.randrange(1200), f"t{i}") for i in range(150)]


def whole(df):
    rows = sorted(df.collect(), key=lambda r: (r["case_id"], r["part_no"]))
    return {c: THREAD_SEPARATOR.join(r["thread"] for r in g) for c, g in itertools.groupby(rows, key=lambda r: r["case_id"])}


def test_long_threads_keep_all_pieces_in_order(spark):
    found = pieces(spark, random_pieces())
    single, cut = th.threads(found), th.threads(found, part_rows=20)
    assert cut.filter("case_id = 'hot'").count() > 3
    assert cut.filter("case_id <> 'hot' AND part_no > 0").isEmpty()
    assert whole(single) == whole(cut)


def test_thread_order_does_not_depend_on_partitions(spark):
    found = pieces(spark, random_pieces())
    assert whole(th.threads(found.repartition(7))) == whole(th.threads(found.coalesce(1)))


@pytest.mark.parametrize("k", [0, 1, 25, 1000])
def test_first_pieces_of_long_threads(spark, k):
    found = pieces(spark, random_pieces())

    def first(part_rows):
        rows = sorted(th.with_pieces(th.threads(found, part_rows), k).collect(), key=lambda r: (r["case_id"], r["part_no"]))
        return {c: [p for r in g for p in r["pieces"]] for c, g in itertools.groupby(rows, key=lambda r: r["case_id"])}

    assert first(10_000) == first(20)
    assert all(len(v) <= k for v in first(20).values())


def test_separator_inside_a_piece_counts_as_pieces(spark):
    found = pieces(spark, [("a", 1, "x\n----\ny"), ("a", 2, "z")])
    assert th.with_pieces(th.threads(found), 2).first()["pieces"] == ["x", "y"]


def test_latest_note(spark):
    notes = spark.createDataFrame([("1", "t", dt.datetime(2024, 1, 1)), ("1", "t", dt.datetime(2024, 1, 2)), ("2", "t", None)],
                                  "ticket_number string, note_text string, created_ts timestamp_ntz")
    rows = {r["case_id"]: r["created_ts"] for r in th.latest_notes(notes).collect()}
    assert rows == {"1": dt.datetime(2024, 1, 2), "2": None}


def test_requested_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "case_id string")
    assert ids(th.requested_ids(df)) == ["a"]


# --- documents ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def loaded(spark, areas):
    return cs.closed_cases(spark.createDataFrame([fact_row("a"), fact_row("hot"), fact_row("none")], FACT), areas, as_of())


def messages(spark, n_hot):
    start = dt.datetime(2024, 1, 1)
    rows = [("hot", start + dt.timedelta(minutes=i), "Re: s", f"m{i}") for i in range(n_hot)] + [("a", start, "Re: s", "hello")]
    mails = spark.createDataFrame(rows, "ticket_number string, created_ts timestamp_ntz, subject string, description string")
    return mails, mails.select("ticket_number", F.col("description").alias("note_text"), "created_ts")


def test_document_text(spark, loaded):
    mails, notes = messages(spark, 1)
    found = {r["case_id"]: r["content"] for r in docs.documents_of(loaded, mails, notes).collect()}
    head = ("\n=== SUPPORT CASE: {} ===\nProduct: Prod\nArea: A\\B\nTitle: \nSeverity: 2 (Max: 1)\n"
            "Resolution Time: 1 days\nCustomer Interactions: 1 emails, 2 calls\nCase Age: 1 days\n"
            "Idle Days: 1 case, 0 communication\n\n=== CUSTOMER PROBLEM ===\n")
    assert found["none"] == head.format("none")
    assert found["a"] == head.format("a") + (
        "CUSTOMER COMMUNICATIONS:\nSubject: Re: s; Created On: 2024-01-01 00:00:00; Message: hello\n\n"
        "=== RESOLUTION STEPS ===\n2024-01-01 00:00:00 | hello\n")


@pytest.mark.parametrize("max_emails", [None, 7])
def test_long_documents_are_whole(spark, loaded, max_emails):
    mails, notes = messages(spark, 30)

    def texts(part_rows):
        rows = sorted(docs.documents_of(loaded, mails, notes, max_emails, part_rows=part_rows).collect(),
                      key=lambda r: (r["case_id"], r["part_no"]))
        groups = {c: list(g) for c, g in itertools.groupby(rows, key=lambda r: r["case_id"])}
        assert all([r["part_no"] for r in g] == list(range(len(g))) for g in groups.values())
        return {c: "".join(r["content"] for r in g) for c, g in groups.items()}, len(groups["hot"])

    (single, n_single), (cut, n_cut) = texts(10_000), texts(5)
    assert n_single == 1 and n_cut > 5
    assert single == cut
