"""Chunks, records, mentions, components, search."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caselore.functions import vocabulary as V
from caselore.operators import components as comp
from caselore.operators import gazetteer as gz
from caselore.operators import graph as gr
from caselore.operators import insights as ins
from caselore.operators import retrieval as ret


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (1200, 1), (1201, 2), (2300, 2), (2301, 3)])
def test_chunk_borders(spark, n, expected):
    docs = spark.createDataFrame([(1, "  " + " \n".join(f"w{i}" for i in range(n)) + "\n")], "doc_id long, text string")
    rows = sorted(gr.chunks(docs).collect(), key=lambda r: r["chunk_no"])
    assert len(rows) == expected == gr.chunk_count(docs).first()["n"]
    for r in rows:
        words = [f"w{i}" for i in range(n)][r["chunk_no"] * 1100:r["chunk_no"] * 1100 + 1200]
        assert r["text"] == " ".join(words) and r["n_tokens"] == len(words)


def parsed(spark, text):
    return gr.parse_records(spark.createDataFrame([("A", "d", text)], "analysis_id string, doc_id string, records string"))


def test_records(spark):
    text = ('("entity"<|>disk full<|>CASE_PROBLEM<|>CASE_SOURCE seen)## ("relationship"<|>a<|>b<|>NOT_COVERED_BY: x<|>9)##'
            '("entity"<|>x<|>y)##("relationship"<|>a<|>b<|>d<|>high)##nonsense####'
            '("entity"<|>guide<|>SELFHELP_TOPIC<|>SELFHELP_SOURCE (old))<|COMPLETE|>("entity"<|>late<|>ISSUE<|>x)')
    found = parsed(spark, text)
    assert Counter(r["kind"] for r in found.collect()) == {"entity": 2, "relationship": 1, "malformed": 3}
    entities = {r["name"]: (r["type"], r["description"], r["marker"]) for r in gr.record_entities(found).collect()}
    assert entities == {"DISK FULL": ("CASE_PROBLEM", "CASE_SOURCE seen", "CASE_SOURCE"),
                        "GUIDE": ("SELFHELP_TOPIC", "SELFHELP_SOURCE (old)", "SELFHELP_SOURCE")}
    relation = gr.record_relations(found).first()
    assert (relation["source"], relation["target"], relation["type"], relation["strength"]) == ("A", "B", "NOT_COVERED_BY", 9.0)


def test_violations(spark):
    text = ('("entity"<|>p<|>CASE_PROBLEM<|>d)##("entity"<|>w<|>WIDGET<|>d)##("relationship"<|>p<|>t<|>COVERED_BY<|>7)##'
            '("relationship"<|>w<|>t<|>COVERED_BY<|>9)##("relationship"<|>p<|>t<|>LIKES<|>50)##("relationship"<|>p<|>t<|>COVERED_BY<|>8)')
    rows = gr.vocabulary_violations(parsed(spark, text)).collect()
    assert Counter((r["violation"], r["subject"]) for r in rows) == {
        ("entity type", "W"): 1, ("strength", "P -> T"): 1, ("source type", "W -> T"): 1, ("relation type", "P -> T"): 1}


def test_vocabulary_sizes():
    assert len(V.ENTITY_TYPES) == 23 and len(V.RELATION_TYPES) == 18 and len(V.NOTE_PATTERNS) == 17


def test_mentions_and_cooccurrence_against_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Disk", "full", "error", "disk-full", "ünder", "net"]) for _ in range(12)) for _ in range(15)]
    lexicon = {"disk": "ISSUE", "disk full": "CASE_PROBLEM", "full error net": "SYMPTOM", "ünder": "OUTAGE"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = spark.createDataFrame(list(lexicon.items()), "term string, type string")
    found = gr.mentions(gr.chunks(docs), terms)
    expected = Counter()
    for i, text in enumerate(texts):
        words = text.lower().replace("-", " ").split()
        for n, at in itertools.product((1, 2, 3), range(len(words))):
            gram = " ".join(words[at:at + n])
            if at + n <= len(words) and gram in lexicon:
                expected[(i, gram)] += 1
    assert {(r["doc_id"], r["term"]): r["n"] for r in found.collect()} == expected
    pairs = Counter()
    for i in range(len(texts)):
        pairs.update(itertools.combinations(sorted(t for d, t in expected if d == i), 2))
    assert {(r["source"], r["target"]): r["shared"] for r in gr.cooccurrence(found).collect()} == pairs


def roots(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["random", "chain", "hub", "loops"])
def test_components(spark, kind):
    rng = random.Random(kind)
    name = "n{:03d}".format
    edges = {
        "random": [(name(rng.randrange(80)), name(rng.randrange(80))) for _ in range(60)],
        "chain": [(name(i), name(i + 1)) for i in rng.sample(range(120), 120)],
        "hub": [(name(50), name(i)) for i in range(90) if i != 50] + [(name(95), name(96))],
        "loops": [(name(1), name(1)), (name(2), name(3)), (name(3), name(2))],
    }[kind]
    lone = [("zz",)]
    df = spark.createDataFrame(edges, "src string, dst string")
    found = {r["node"]: r["component"] for r in
             comp.connected_components(df, spark.createDataFrame(lone, "node string")).collect()}
    assert found == roots(edges, {x for e in edges for x in e} | {"zz"})
    turned = df.select(F.col("dst").alias("src"), F.col("src").alias("dst")).repartition(3)
    again = {r["node"]: r["component"] for r in comp.connected_components(turned).collect()}
    assert again == {n: c for n, c in found.items() if n != "zz"}


def test_merge(spark):
    old = spark.createDataFrame([("T", "a", "1"), ("T", "b", "1")], "type string, name string, d string")
    new = spark.createDataFrame([("T", "b", "2"), ("T", "c", "2")], "type string, name string, d string")
    assert {(r["name"], r["d"]) for r in gr.merge_entities(old, new, ["type", "name"]).collect()} == {("a", "1"), ("b", "2"), ("c", "2")}
    assert gr.merge_relations(old, new).count() == 4


@pytest.mark.parametrize("max_queries", [100, 3])
def test_vector_search(spark, max_queries):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 8))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, vector array<double>")
    queries = vectors.filter("vec_id < 9").select(F.col("vec_id").alias("query_id"), "vector")
    found = ret.top_k_similar(vectors, queries, 4, skip_self=True, max_queries=max_queries).collect()
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    for q in range(9):
        scores = unit @ unit[q]
        best = sorted((-round(float(s), 6), i) for i, s in enumerate(scores) if i != q)[:4]
        assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == [i for _, i in best]


@pytest.mark.parametrize("block_chunks", [1, 4, 256])
def test_question_ranking_against_brute_force(spark, block_chunks):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    texts = [" ".join(rng.choice(words[:4]) for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    asked = {1: "Alpha beta?", 2: "gamma gamma eps", 3: "none of these"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    questions = spark.createDataFrame(list(asked.items()), "question_id long, question string")
    found = ret.rank_chunks(gr.chunks(docs), questions, 5, block_chunks=block_chunks).collect()
    df = Counter(w for t in texts for w in set(t.split()))
    for q, terms in ((1, ["alpha", "beta"]), (2, ["gamma"]), (3, [])):
        scored = [(-round(sum(t.split().count(w) * math.log(31 / (df[w] + 1)) for w in terms), 6), i)
                  for i, t in enumerate(texts) if set(terms) & set(t.split())]
        got = [(-r["score"], r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"]) if r["question_id"] == q]
        assert [i for _, i in got] == [i for _, i in sorted(scored)[:5]]
        assert [s for s, _ in got] == pytest.approx([s for s, _ in sorted(scored)[:5]])


@pytest.mark.parametrize("block_chunks", [1, 4, 256])
def test_a_term_of_every_chunk_ranks_with_nothing(spark, block_chunks):
    docs = spark.createDataFrame([(1, "common alpha"), (2, "common"), (3, "common beta")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "common"), (2, "alpha common"), (3, "unknown")], "question_id long, question string")
    found = ret.rank_chunks(gr.chunks(docs), asked, 5, block_chunks=block_chunks).collect()
    assert {(r["question_id"], r["rank"], r["doc_id"], r["score"] > 0) for r in found} == {
        (1, 1, 1, False), (1, 2, 2, False), (1, 3, 3, False), (2, 1, 1, True), (2, 2, 2, False), (2, 3, 3, False)}
    assert ret.rank_chunks(gr.chunks(docs), asked.filter("question_id = 3"), 5, block_chunks=block_chunks).isEmpty()


def test_blocks_are_skipped_and_rows_are_those_of_a_full_search(spark):
    """Many chunks, ties and hot terms: the same rows whether all chunks are one block or each is its own."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["hot", "hot", "warm", "cold", f"r{rng.randrange(40)}"]) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame([(k, f"hot r{k} cold r{k + 1}") for k in range(12)], "question_id long, question string")
    one, many = (sorted(map(tuple, ret.rank_chunks(gr.chunks(docs), asked, 5, block_chunks=b).collect())) for b in (1000, 5))
    assert one == many and len(one) == 60


def test_terms_of_any_length_and_all_related_names(spark):
    docs = spark.createDataFrame([(1, "zero one two three four"), (2, "one two")], "doc_id long, text string")
    terms = spark.createDataFrame([("one two three four", "ISSUE"), ("zero", "ISSUE")], "term string, type string")
    found = gr.mentions(gr.chunks(docs), terms)
    assert {(r["doc_id"], r["term"]) for r in found.collect()} == {(1, "one two three four"), (1, "zero")}
    assert gr.mentions(gr.chunks(docs), terms.limit(0)).isEmpty()
    edges = spark.createDataFrame([("zero", f"n{i}") for i in range(15)], "source string, target string")
    rows = ins.entity_insights(found, edges).collect()
    assert {r["related"] for r in rows if r["name"] == "zero"} == {f"n{i}" for i in range(15)}
    assert [(r["frequency"], r["related"]) for r in rows if r["name"] != "zero"] == [(1, None)]


def test_tree_and_join_find_the_same_mentions(spark, monkeypatch):
    """Nested, overlapping and repeated terms, two types of one term, null and unreachable terms, blocks of a few words."""
    rng = random.Random(11)
    words = ["a", "b", "c", "ü", "dd"]
    texts = [" ".join(rng.choice(words + ["zz", "1"]) for _ in range(rng.randrange(1, 40))) for _ in range(60)] + ["", None, "a" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = {" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))) for _ in range(60)}
    rows = [(t, "ISSUE") for t in terms] + [("a", "OUTAGE"), ("a", None), (None, "ISSUE"), ("no  such", "ISSUE"), ("", "ISSUE"), ("b c", "ISSUE")]
    lexicon = spark.createDataFrame(rows, "term string, type string")
    walked = gr.mentions(gr.chunks(docs), lexicon)
    monkeypatch.setattr(gr, "TREE_WORDS", 3)
    joined = gr.mentions(gr.chunks(docs), lexicon)
    found = Counter(tuple(r) for r in walked.select(*joined.columns).collect())
    assert found == Counter(tuple(r) for r in joined.collect())
    assert max(found.values()) == 1 and {"OUTAGE", None} == {k for *_, t, k, _ in found if t == "a"} - {"ISSUE"}


def test_blocks_of_words_change_nothing():
    tree = gz.PhraseTree([("a", "X"), ("a b", "X"), ("b a b", "X"), ("b", "Y"), ("b", "X")])
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "chunk_no": [0, 0, 0, 1],
                                        "words": [["a", "b", "a", "b"], [], ["b"], ["q", "a"]]})
    whole = pa.Table.from_batches(gz.mention_rows(lambda: tree)(iter([batch]))).to_pylist()
    assert sorted((r["doc_id"], r["chunk_no"], r["term"], r["type"], r["n"]) for r in whole) == [
        (1, 0, "a", "X", 2), (1, 0, "a b", "X", 2), (1, 0, "b", "X", 2), (1, 0, "b", "Y", 2), (1, 0, "b a b", "X", 1),
        (3, 0, "b", "X", 1), (3, 0, "b", "Y", 1), (4, 1, "a", "X", 1)]
    size, gz.BLOCK_WORDS = gz.BLOCK_WORDS, 2
    try:
        assert pa.Table.from_batches(gz.mention_rows(lambda: tree)(iter([batch]))).to_pylist() == whole
    finally:
        gz.BLOCK_WORDS = size


@pytest.mark.parametrize("heavy_terms", [1, 4, 10_000])
def test_heavy_and_light_pairs(spark, heavy_terms):
    """One term in every chunk, some in a third, the rest rare: the pairs are those of a plain count, however they are split."""
    rng = random.Random(2)
    chunks = [{"hot", *rng.sample(["w1", "w2", "w3"], 1), *(f"r{rng.randrange(30)}" for _ in range(rng.randrange(6)))} for _ in range(90)]
    rows = [(i // 2, i % 2, t) for i, terms in enumerate(chunks) for t in terms]
    found = gr.cooccurrence(spark.createDataFrame(rows + rows[:5], "doc_id long, chunk_no int, term string"), heavy_terms)
    pairs = Counter(p for terms in chunks for p in itertools.combinations(sorted(terms), 2))
    assert {(r["source"], r["target"]): (r["shared"], r["strength"]) for r in found.collect()} == {p: (n, min(n, 10)) for p, n in pairs.items()}
    assert gr.cooccurrence(spark.createDataFrame([], "doc_id long, chunk_no int, term string"), heavy_terms).isEmpty()


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_a_light_pair_leaves_a_block_once(block):
    """Pairs are counted inside the task, light ones too: no row per place where two terms meet."""
    rng = random.Random(4)
    lists = [sorted(rng.sample(range(40), rng.randrange(12))) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"terms": pa.array(lists, pa.list_(pa.int64()))})
    old, gz.BLOCK_PAIRS = gz.BLOCK_PAIRS, block
    try:
        rows = [r for b in gz.pair_rows([3, 7])(iter([batch])) for r in b.to_pylist()]
    finally:
        gz.BLOCK_PAIRS = old
    expected = Counter(p for terms in lists for p in itertools.combinations(terms, 2))
    found = Counter()
    for r in rows:
        found[r["a"], r["b"]] += r["n"]
    assert found == expected
    if block == 1 << 20:
        assert len(rows) == len(expected)


def test_names_without_partners_and_pairs_in_both_orders(spark):
    mentions = spark.createDataFrame([("X", "a", 1, 0), ("Y", "a", 1, 0), ("X", "b", 1, 0), ("X", "c", 2, 0), ("X", None, 3, 0)],
                                     "type string, term string, doc_id long, chunk_no int")
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "b"), (None, "b"), ("b", None)], "source string, target string")
    found = sorted(map(tuple, ins.entity_insights(mentions, pairs).collect()), key=repr)
    assert found == sorted([("X", "a", 1, "b"), ("Y", "a", 1, "b"), ("X", "b", 1, "a"), ("X", "b", 1, "b"), ("X", "b", 1, None),
                            ("X", "c", 1, None), ("X", None, 1, None)], key=repr)


def test_records_are_parsed_once_for_the_vocabulary(spark):
    """The check reads its records from one pass, and odd brackets, blanks and breaks are split as before."""
    d = V.TUPLE_DELIMITER
    texts = [f'("entity"{d}a{d}X{d}b)', "()", " ", ")", "((x))", f'("entity"{d}a{d}X{d}b)\n', f'("relationship"{d}a{d}b{d}c{d}1)', ""]
    rows = [("A", "1", V.RECORD_DELIMITER.join(texts) + V.END_MARK + "(rest)"), ("A", "2", None), ("A", "3", "")]
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    given = spark.createDataFrame(rows, "analysis_id string, doc_id string, records string").repartition(1)
    parsed = gr.parse_records(given.mapInArrow(counted, given.schema))
    assert [r["p"] for r in parsed.collect()] == [
        ['"entity"', "a", "X", "b"], [""], [""], ["(x)"], ['"entity"', "a", "X", "b\n"], ['"relationship"', "a", "b", "c", "1"]]
    passes.value = 0
    assert gr.vocabulary_violations(parsed).count() > 0
    assert passes.value == len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_merged_components_are_those_of_all_edges(spark, seed):
    """New edges inside, between and beside stored components, some known before, loops and new nodes; the stored rows decide alone."""
    rng = random.Random(seed)
    draw = lambda n, top: [(f"n{rng.randrange(top):02d}", f"n{rng.randrange(top):02d}") for _ in range(n)]
    old, new = draw(20, 40), draw(12, 60)
    edges = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    stored = comp.connected_components(edges(old))
    found = comp.merge_components(stored, edges(new + old[:5] + [(None, "n01"), ("lone", "lone")]))
    expected = comp.connected_components(edges(old + new + [("lone", "lone")]))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert sorted(map(tuple, comp.merge_components(stored, edges([])).collect())) == sorted(map(tuple, stored.collect()))
    assert sorted(map(tuple, comp.merge_components(stored.limit(0), edges(old)).collect())) == sorted(map(tuple, stored.collect()))
