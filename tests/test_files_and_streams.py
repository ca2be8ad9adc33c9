"""File sources and sinks, streaming ingest."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from caselore import session
from caselore.operators import changes as ch
from caselore.operators import reports as rep
from caselore.operators import selfhelp as sh
from caselore.plans import queries as Q
from caselore.sources import files as fs
from caselore.sources import mapping as mp
from caselore.streaming import ingest


def test_selfhelp_and_case_files(spark, tmp_path):
    (tmp_path / "P1_how_to.txt").write_text("line\nline two")
    (tmp_path / "case_SR9.txt").write_text("text")
    row = fs.read_selfhelp(spark, str(tmp_path)).filter("product_id = 'P1'").first()
    assert (row["file_name"], row["content"]) == ("P1_how_to.txt", "line\nline two")
    assert isinstance(row["modified_ts"], dt.datetime)
    assert [tuple(r) for r in fs.read_case_files(spark, str(tmp_path)).collect()] == [("SR9", "text")]


def test_missing_folders_are_empty(spark, tmp_path):
    nowhere = str(tmp_path / "none")
    for df in (fs.read_selfhelp(spark, nowhere), fs.read_case_files(spark, nowhere), fs.read_tracking(spark, nowhere),
               fs.read_graph_csv(spark, nowhere, fs.ENTITY_CSV), fs.read_results(spark, nowhere, "product_id string, run string")):
        assert df.isEmpty()


def test_tracking_maps(spark, tmp_path):
    entry = {"FileName": "P1_a.txt", "ProcessedContent": "x", "LastProcessed": "2024-01-01T10:00:00", "ContentLength": 1}
    for product, text in (("P1", json.dumps({"P1_a.txt": entry, "P1_b.txt": {}})), ("P2", "not json")):
        (tmp_path / product).mkdir()
        (tmp_path / product / "tracking.json").write_text(text)
    rows = {(r["product_id"], r["file_name"]): (r["processed_content"], r["last_processed"], r["content_length"])
            for r in fs.read_tracking(spark, str(tmp_path)).collect()}
    assert rows == {("P1", "P1_a.txt"): ("x", dt.datetime(2024, 1, 1, 10), 1), ("P1", "P1_b.txt"): ("", None, 0)}


def test_index_tracking(spark):
    texts = spark.createDataFrame([("P1", '{"LastFullIndex": "2024-01-01T00:00:00", "IncrementalUpdateCount": 4}'), ("P2", "?"), ("P3", None)],
                                  "product_id string, value string")
    rows = {r["product_id"]: (r["last_full_index"], r["increments"]) for r in fs.index_tracking_rows(texts).collect()}
    assert rows == {"P1": (dt.datetime(2024, 1, 1), 4), "P2": (None, 0), "P3": (None, 0)}


def test_graph_csv_keeps_quotes_and_newlines(spark, tmp_path):
    rows = [("a", 'say "x"\nnew line', "T", "d,e", 3)]
    path = str(tmp_path / "relationships.csv")
    fs.write_graph_csv(spark.createDataFrame(rows, fs.RELATION_CSV), path)
    assert [tuple(r) for r in fs.read_graph_csv(spark, path, fs.RELATION_CSV).collect()] == rows


def test_latest_run(spark, tmp_path):
    path = str(tmp_path / "results")
    for run, products in (("analysis_result_1", ["P1", "P2"]), ("analysis_result_2", ["P1"])):
        fs.write_results(spark.createDataFrame([(p, f"{p} in {run}") for p in products], "product_id string, note string"), path, run)
    rows = fs.latest_run(fs.read_results(spark, path, "note string, product_id string, run string"))
    assert {r["note"] for r in rows.collect()} == {"P1 in analysis_result_2", "P2 in analysis_result_1"}


def test_results_are_packed(spark, tmp_path):
    """Results are packed JSON lines, and read back as they were by both readers."""
    path, rows = tmp_path / "results", [("P1", "é" * 5000, [1, 2]), ("P2", "", [])]
    frame = spark.createDataFrame(rows, "product_id string, note string, places array<int>")
    fs.write_results(frame, str(path), "analysis_result_1")
    files = [p for p in path.rglob("part-*") if p.is_file()]
    assert len(files) >= 2 and all(p.name.endswith(".json.gz") for p in files) and sum(p.stat().st_size for p in files) < 2000
    plain = fs.read_results(spark, str(path), "note string, places array<int>, product_id string, run string")
    assert {(r["product_id"], r["note"], tuple(r["places"])) for r in plain.collect()} == {(p, n, tuple(x)) for p, n, x in rows}
    read = fs.read_result_variants(spark, str(path)).select("product_id", F.variant_get("result", "$.note", "string").alias("note"))
    assert {tuple(r) for r in read.collect()} == {(p, n) for p, n, _ in rows}


def test_written_report_reads_in_order(spark, tmp_path):
    rows = [("A", "r", s, -i, 1, 0, n, f"{s}-{i}-{n}") for s, i, n in itertools.product(range(2), range(40), range(3))]
    lines = spark.createDataFrame(rows, "analysis_id string, report string, section_no int, rank_key long, query_no int,"
                                  " item_no int, line_no int, text string")
    path = tmp_path / "reports"
    fs.write_reports(lines.repartition(5), str(path), rep.ORDER)
    files = sorted((path / "analysis_id=A" / "report=r").glob("part-*.txt"))
    text = "".join(f.read_text() for f in files).splitlines()
    assert text == [r[-1] for r in sorted(rows, key=lambda r: r[2:7])]


def test_shared_dir_follows_the_session_setting(spark):
    first = session.shared_dir(spark)
    assert session.shared_dir(spark) == first
    assert session.scratch_path(spark, "x").startswith(first) and session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


@pytest.fixture
def small_tables(spark, monkeypatch):
    """Tables of 80 parts, 60 orders and 240 lines in place of stored ones; counts how often lines are joined to their parts."""
    day = dt.datetime(1998, 1, 1)
    rows = {
        "region": [(i, f"R{i}") for i in range(5)], "nation": [(i, f"N{i}", i % 5) for i in range(10)],
        "customer": [(i, f"c{i}", i % 10, 9500.0 if i % 3 else 1.0, "AUTO") for i in range(20)],
        "orders": [(i, i % 20, "FOP"[i % 3], 1000.0 * i, day, f"{i % 5 + 1}-X") for i in range(60)],
        "lineitem": [(i % 60, i % 80, i % 7, i // 60 + 1, 1.0, 2.0, 0.0, 0.0, "RNA"[i % 3], "OF"[i % 2], day) for i in range(240)],
        "part": [(i, f"part {i}", f"Brand#{i % 9}", ["PROMO", "SMALL", "LARGE", "ECO"][i % 4], i % 50, 1.0) for i in range(80)],
        "conversations": [(i, t, "user" if t % 2 else "assistant", f"t{t}") for i in range(20) for t in range(2)]}
    joined = []
    monkeypatch.setattr(mp, "table", lambda spark, d, name: spark.createDataFrame(rows[name], mp.SCHEMAS[name]))
    lines = mp.lines_with_parts
    monkeypatch.setattr(mp, "lines_with_parts", lambda *args: joined.append(1) or lines(*args))
    return joined


def test_results_join_lines_to_parts_once(spark, small_tables):
    """The stored inputs give the results of each part made on its own."""
    read = {r["analysis_id"]: r for r in Q.sink_result_json(spark, "").collect()}
    assert len(small_tables) == 1 and sorted(read) == ["A0", "A1"]
    alone = {r["analysis_id"]: r for r in Q.metrics(spark, "", communities=True).collect()}
    gaps, risks, recs = Q._report_inputs(spark, "")
    counts = {r["analysis_id"]: r for r in Q.summary(spark, "", gaps, risks, recs).collect()}
    for a, r in read.items():
        assert (r["n_communities"], r["minutes"], r["n_cases"], r["coverage_score"]) == (
            alone[a]["n_communities"], alone[a]["minutes"], counts[a]["n_cases"], counts[a]["coverage_score"])
        assert r["n_cases"] > 0 and r["gaps"] and r["modes"]


def test_reports_join_lines_to_parts_once(spark, small_tables):
    """The reports from stored inputs are the five reports made on their own, each line at its place."""
    got = {(r["analysis_id"], r["report"], r["line_no"]): r["text"] for r in Q.sink_reports(spark, "").collect()}
    assert len(small_tables) == 1
    want = {}
    for name in ("executive", "gaps", "fmea", "recommendations", "detail"):
        for r in Q.QUERIES[f"report_{name}"](spark, "").collect():
            want.setdefault((r["analysis_id"], r["report"]), []).append((*[r[c] if r[c] is not None else -10**9 for c in rep.ORDER[:-1]], r["text"]))
    assert len(want) == 10 and got == {(*key, n): row[-1] for key, rows in want.items() for n, row in enumerate(sorted(rows), 1)}


# --- streams --------------------------------------------------------------------------------

def feed(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("policy", ["new_or_updated", "new_only"])
def test_case_stream_equals_batch(spark, tmp_path, policy):
    source, corpus, check = (str(tmp_path / n) for n in ("in", "corpus", "check"))
    batches = [[("P", str(i), 0, f"v{b}" if i % 2 else "same") for i in range(b * 3, b * 3 + 6)] for b in range(3)]
    state = ch.with_hash(spark.createDataFrame([], ingest.DOCUMENTS))
    for rows in batches:
        feed(spark, rows, ingest.DOCUMENTS, source)
        ingest.stream_cases(spark, source, corpus, check, policy).awaitTermination()
        docs = spark.createDataFrame(rows, ingest.DOCUMENTS)
        state = ch.upsert_corpus(state, ch.work_set(docs, state, policy))
    got = {tuple(r) for r in ingest.read_corpus(spark, corpus).select("case_id", "content", "content_hash").collect()}
    assert got == {tuple(r) for r in state.select("case_id", "content", "content_hash").collect()}


def test_a_retried_batch_changes_nothing(spark, tmp_path):
    source, corpus, check = (str(tmp_path / n) for n in ("in", "corpus", "check"))
    feed(spark, [("P", "a", 0, "x")], ingest.DOCUMENTS, source)
    ingest.stream_cases(spark, source, corpus, check).awaitTermination()
    # a lost checkpoint replays the same files as batch 0
    ingest.stream_cases(spark, source, corpus, check + "2").awaitTermination()
    assert [r["content"] for r in ingest.read_corpus(spark, corpus).collect()] == ["x"]


def test_selfhelp_stream_equals_batch(spark, tmp_path):
    source, sections, tracking, check = (str(tmp_path / n) for n in ("in", "sections", "tracking", "check"))
    at = dt.datetime(2024, 1, 1)
    batches = [[("P", "P_a.txt", "one", at), ("P", "P_b.txt", "b", at)], [("P", "P_a.txt", "one two", at)],
               [("P", "P_a.txt", "other", at), ("P", "P_b.txt", "b", at)]]
    state = spark.createDataFrame([], fs.TRACKING)
    expected = []
    for rows in batches:
        feed(spark, rows, ingest.FILES, source)
        ingest.stream_selfhelp(spark, source, sections, tracking, check).awaitTermination()
        diff = sh.selfhelp_diff(spark.createDataFrame(rows, ingest.FILES), state)
        expected += [(r["file_name"], r["section"]) for r in sh.selfhelp_sections(diff).collect()]
        fresh = sh.tracking_after(diff, state, F.lit("2024-01-01").cast("timestamp_ntz"))
        kept = state.join(fresh.select("file_name"), "file_name", "left_anti").select(*fresh.columns)
        state = spark.createDataFrame(fresh.unionByName(kept).collect(), fs.TRACKING)
    got = [(r["file_name"], r["section"]) for r in ingest.read_sections(spark, sections).collect()]
    assert sorted(got) == sorted(expected)
    assert {(r["file_name"], r["processed_content"]) for r in ingest.read_stream_tracking(spark, tracking).collect()} == {
        (r["file_name"], r["processed_content"]) for r in state.collect()}


def test_two_versions_of_a_case_in_one_batch(spark, tmp_path):
    source, corpus, check = (str(tmp_path / n) for n in ("in", "corpus", "check"))
    for rows in ([("P", "a", 0, "v2", 2), ("P", "a", 1, "v2 more", 2)], [("P", "a", 0, "v1", 1), ("P", "a", 2, "v1 more", 1), ("P", "b", 0, "x", None)]):
        feed(spark, rows, ingest.ARRIVALS, source)
    ingest.stream_cases(spark, source, corpus, check).awaitTermination()
    assert {(r["case_id"], r["part_no"], r["content"]) for r in ingest.read_corpus(spark, corpus).collect()} == {
        ("a", 0, "v2"), ("a", 1, "v2 more"), ("b", 0, "x")}


def test_two_versions_of_a_file_in_one_batch(spark, tmp_path):
    source, sections, tracking, check = (str(tmp_path / n) for n in ("in", "sections", "tracking", "check"))
    for hour, text in ((2, "one two"), (1, "one"), (3, " ")):
        feed(spark, [("P", "P_a.txt", text, dt.datetime(2024, 1, 1, hour))], ingest.FILES, source)
    ingest.stream_selfhelp(spark, source, sections, tracking, check).awaitTermination()
    rows = sorted(ingest.read_sections(spark, sections).collect(), key=lambda r: r["step"])
    assert [r["status"] for r in rows] == ["new", "incremental"] and "\n\n two\n\n" in rows[1]["section"]
    assert [r["processed_content"] for r in ingest.read_stream_tracking(spark, tracking).collect()] == ["one two"]


def test_versions_are_whole_without_a_number(spark, tmp_path):
    """Two versions in one trigger, told apart by their files alone: the stored text is one that arrived."""
    source, corpus, check = (str(tmp_path / n) for n in ("in", "corpus", "check"))
    feed(spark, [("P", "a", 0, "z old head"), ("P", "a", 1, "a old tail")], ingest.DOCUMENTS, source)
    feed(spark, [("P", "a", 0, "a NEW head"), ("P", "a", 1, "z NEW tail")], ingest.DOCUMENTS, source)
    ingest.stream_cases(spark, source, corpus, check).awaitTermination()
    stored = {r["part_no"]: r["content"] for r in ingest.read_corpus(spark, corpus).collect()}
    assert stored in ({0: "z old head", 1: "a old tail"}, {0: "a NEW head", 1: "z NEW tail"})
    times = {p.name: p.stat().st_mtime_ns // 1000 for p in (tmp_path / "in").glob("*.parquet")}
    if len(set(times.values())) == 2:
        assert stored[0] == "a NEW head"


def test_late_and_unchanged_versions(spark, tmp_path):
    """Neither an older number nor the same text changes the corpus, and a version without some part has it no more."""
    source, corpus, check = (str(tmp_path / n) for n in ("in", "corpus", "check"))
    steps = [[("P", "a", 0, "two", 2), ("P", "a", 1, "tail", 2)], [("P", "a", 0, "one", 1)], [("P", "a", 1, "tail", 3), ("P", "a", 0, "two", 3)],
             [("P", "a", 0, "four", 4)]]
    seen = []
    for rows in steps:
        feed(spark, rows, ingest.ARRIVALS, source)
        ingest.stream_cases(spark, source, corpus, check).awaitTermination()
        seen.append(sorted((r["part_no"], r["content"], r["batch"]) for r in ingest.read_corpus(spark, corpus).collect()))
    assert seen == [[(0, "two", 0), (1, "tail", 0)]] * 3 + [[(0, "four", 3)]]


def test_a_late_file_version_is_left_out(spark, tmp_path):
    source, sections, tracking, check = (str(tmp_path / n) for n in ("in", "sections", "tracking", "check"))
    for hour, text in ((2, "one two"), (1, "one"), (3, "one two three")):
        feed(spark, [("P", "P_a.txt", text, dt.datetime(2024, 1, 1, hour))], ingest.FILES, source)
        ingest.stream_selfhelp(spark, source, sections, tracking, check).awaitTermination()
    assert [r["processed_content"] for r in ingest.read_stream_tracking(spark, tracking).collect()] == ["one two three"]
    rows = sorted(ingest.read_sections(spark, sections).collect(), key=lambda r: r["batch"])
    assert [r["status"] for r in rows] == ["new", "incremental"] and "\n\n three\n\n" in rows[1]["section"]


def test_cases_of_a_group_keep_their_own_versions(spark, tmp_path, monkeypatch):
    """Cases that share a state entry are told apart, null keys and parts without a number included; one call serves a group."""
    monkeypatch.setattr(ingest, "CASE_GROUPS", 1)
    source, corpus, check = (str(tmp_path / n) for n in ("in", "corpus", "check"))
    first = [("P", str(i), 0, f"one {i}", 1) for i in range(20)] + [("Q", "3", 0, "other product", 1), (None, "3", 0, "none", 1)]
    second = [("P", "1", 0, "late", 0), ("P", "2", 0, "two", 2), ("P", "3", 0, "one 3", 2), ("P", "new", None, "x", 1), ("P", "new", None, "y", 1)]
    third = [("P", "3", 0, "late", 1), (None, "3", 0, "again", 2)]
    for rows in (first, second, third):
        feed(spark, rows, ingest.ARRIVALS, source)
        ingest.stream_cases(spark, source, corpus, check).awaitTermination()
    stored = ingest._stored(spark, corpus, ingest.CORPUS)
    got = sorted(((r["product_id"], r["case_id"], r["content"], r["batch"]) for r in stored.collect()), key=repr)
    assert got == sorted([(p, c, t, 0) for p, c, _, t, _ in first] + [("P", "2", "two", 1), ("P", "new", "x", 1), ("P", "new", "y", 1),
                                                                      (None, "3", "again", 2)], key=repr)
    entries = spark.read.format("statestore").load(check)
    assert entries.count() == 1


def test_files_of_a_group_keep_their_own_versions(spark, tmp_path, monkeypatch):
    """Files that share a state entry are told apart, null keys included, and the state holds no text."""
    monkeypatch.setattr(ingest, "FILE_GROUPS", 1, raising=False)
    source, sections, tracking, check = (str(tmp_path / n) for n in ("in", "sections", "tracking", "check"))
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    texts = {name: f"\U0001f600 long text of {name} " * 200 for name in "abcd"}
    first = [("P", n, t, early) for n, t in texts.items()] + [("Q", "a", "other product", early), (None, "a", "none", early)]
    second = [("P", "a", texts["a"] + "é more", late), ("P", "b", texts["b"][:-3], late), ("P", "c", texts["c"], late),
              ("P", "c", texts["c"] + "tail", dt.datetime(2024, 1, 3)), (None, "a", "none and more", late), ("Q", "a", "late", dt.datetime(2023, 1, 1))]
    for rows in (first, second):
        feed(spark, rows, ingest.FILES, source)
        ingest.stream_selfhelp(spark, source, sections, tracking, check).awaitTermination()
    got = {(r["product_id"], r["file_name"], r["status"], r["batch"]): r["section"] for r in ingest.read_sections(spark, sections).collect()}
    assert {k for k in got if k[3] == 0} == {(p, n, "new", 0) for p, n, _, _ in first}
    fresh = {("P", "a"): "é more", ("P", "b"): texts["b"][:-3], ("P", "c"): "tail"}
    assert {k for k in got if k[3] == 1} == {(p, n, "incremental", 1) for p, n in [*fresh, (None, "a")]}
    assert all(f"\n\n{text}\n\n" in got[p, n, "incremental", 1] for (p, n), text in fresh.items())
    assert {(r["product_id"], r["file_name"], r["processed_content"]) for r in ingest.read_stream_tracking(spark, tracking).collect() if r["product_id"]} == {
        ("P", "a", texts["a"] + "é more"), ("P", "b", texts["b"][:-3]), ("P", "c", texts["c"] + "tail"), ("P", "d", texts["d"]), ("Q", "a", "other product")}
    entries = [str(r) for r in spark.read.format("statestore").load(check).collect()]
    assert len(entries) == 1 and "long text" not in entries[0]
