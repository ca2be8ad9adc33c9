"""Operators over the whole corpus against brute force, and the pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from caselore.llm import decontamination, mixing, pigeonhole, sharding, simhash, suffix_dedup
from caselore.llm.prefix import running_totals

from .test_texts import LOWER, UPPER, spaced


def roots(n, edges):
    u, v = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    return pigeonhole.local_roots(u, v, n)


@pytest.mark.parametrize("window", [400, 96])
def test_suffix_dedup(docs, corpus, nothing, window):
    options = {} if window == 400 else {"window": window}
    raw = [(t or "").encode() for _, t, *_ in corpus]
    counts = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, with_kept=True, **options).collect()}
    for (i, *_), b in zip(corpus, raw, strict=True):
        change = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - window + 1):
            if counts[b[k:k + window]] > 1:
                change[k] += 1
                change[k + window] -= 1
        covered = np.cumsum(change[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        r = found[i]
        assert (r["n_bytes"], r["n_removed"]) == (len(b), int(covered.sum()))
        assert r["n_spans"] == int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        assert r["kept"] == kept and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_suffix_dedup_without_ids(spark, docs):
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), "text")
    assert rows.count() == suffix_dedup.remove_repeats(rows).count()
    twice = suffix_dedup.remove_repeats(rows.unionByName(rows)).agg(F.sum(F.when(F.col("n_bytes") >= 400, F.col("n_bytes") - F.col("n_removed")))).first()[0]
    assert twice == 0


def fingerprint(text, k=3):
    ws = spaced((text or "").translate(str.maketrans(UPPER, LOWER)))
    parts = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or ([" ".join(ws)] if ws else [])
    hashed = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_simhash_components(docs, corpus, nothing):
    prints = [fingerprint(t) for _, t, *_ in corpus]
    edges = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    root = roots(len(prints), edges)
    for options in ({}, {"bucket_members": 30}):
        found = {r["doc_id"]: r for r in simhash.simhash_components(docs, **options).collect()}
        assert [found[i]["fp"] % (1 << 64) for i in range(len(prints))] == prints
        assert [found[i]["component_id"] for i in range(len(prints))] == root.tolist()
    assert simhash.simhash_components(nothing).count() == 0


def test_dense_group_links(spark):
    """Many fingerprints around one: connected as by all pairs, with no more links than nodes per bucket round."""
    rng = np.random.default_rng(6)
    base = int(rng.integers(0, 1 << 62))
    prints = {base}
    while len(prints) < 700:
        prints.add(base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)))
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 300)}
    array = np.array(sorted(prints), np.uint64)
    edges = [(i, j) for i in range(len(array)) for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 3)]
    frame = spark.createDataFrame([(pigeonhole.signed(int(x)),) for x in array], "fp long")
    at = {int(x): k for k, x in enumerate(array)}
    for members in (2000, 300):
        rows = pigeonhole.links(frame, 3, bucket_members=members).collect()
        mine = [(at[r["a"] % (1 << 64)], at[r["b"] % (1 << 64)]) for r in rows]
        assert roots(len(array), mine).tolist() == roots(len(array), edges).tolist()
        assert len(rows) < len(edges)


def test_thresholds_add_up():
    sample = np.random.default_rng(2).integers(0, 1 << 62, 500).astype(np.uint64)
    for rows in (10, 10**6, 10**11):
        for distance in (1, 3):
            chosen = pigeonhole.plan(sample, rows, distance)
            assert sum(t + 1 for _, t in chosen) == distance + 1
            assert all(a & b == 0 for a, _ in chosen for b, _ in chosen if a != b)


def brute_gone(rows):
    """Ids linked, over any number of links, to a smaller one."""
    rows = sorted(rows)
    prints = [fingerprint(t) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    root = roots(len(rows), edges)
    return {rows[i][0] for i in range(len(rows)) if root[i] != i}


def odd_columns(df):
    """The table with columns named like what operators use inside, and with names that clash, repeat or have dots."""
    names = ["full", "cut", "SHARD", "slot", "a.b", "range", "Mix_Tokens", "decon_words", "salt", "bucket", "c0", "gone", "same", "same", "row"]
    return df.select("*", *[F.lit(f"{n}!").alias(n) for n in names])


def test_one_per_group(spark, docs, corpus, nothing):
    rows = [(i, t) for i, t, *_ in corpus]
    want = {i for i, _ in rows} - brute_gone(rows)
    odd = odd_columns(docs)
    left = simhash.one_per_group(odd)
    assert left.columns == odd.columns and {r[0] for r in left.collect()} == want
    assert simhash.one_per_group(nothing).count() == 0
    texts = docs.select(F.format_string("%05d", "doc_id").alias("doc_id"), "text")
    assert {int(r["doc_id"]) for r in simhash.one_per_group(texts).collect()} == want
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (2, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.one_per_group(nulls).orderBy("doc_id").collect()] == [None, None, 2, 2]


def test_odd_columns(spark, docs, corpus):
    odd = odd_columns(docs)
    mixed = mixing.mix(odd, F.col("source"), {}, total_share=0.6)
    plain = mixing.mix(docs, F.col("source"), {}, total_share=0.6)
    assert mixed.columns == [*[c for c in odd.columns if c != "Mix_Tokens"], *mixing.MIX_COLUMNS]
    assert sorted((r[0], r[-1]) for r in mixed.collect()) == sorted((r[0], r[-1]) for r in plain.collect())
    dealt = sharding.shard(odd)
    assert dealt.columns == [*[c for c in odd.columns if c not in ("SHARD", "slot")], "shard", "slot"]
    assert sorted(r[0] for r in dealt.collect()) == [r[0] for r in corpus]
    bench = spark.createDataFrame([("a", " ".join((corpus[3][1]).split()[:12]))], "item_id string, text string")
    left = decontamination.cut(odd, bench)
    assert left.columns == odd.columns
    got = {r[0]: r[1] for r in left.collect()}
    assert {r["doc_id"]: r["text"] for r in decontamination.cut(docs, bench).collect()} == got
    assert len(got[3].split()) == len(corpus[3][1].split()) - 12
    scanned = decontamination.scan(odd, bench)
    assert scanned.columns == [*[c for c in odd.columns if c != "decon_words"], *decontamination.DECON_COLUMNS]
    texts = docs.select(F.format_string("id %d", "doc_id").alias("doc_id"), "text", F.lit(1).alias("DOC_ID"), F.lit(2).alias("mark"))
    found = {r[0]: r[1:] for r in suffix_dedup.remove_repeats(texts).collect()}
    assert found == {f"id {r[0]}": r[1:] for r in suffix_dedup.remove_repeats(docs).collect()}


def test_sharding_of_equal_rows(spark):
    """A third of all rows are equal in id and text: they are spread over buckets, and the law holds."""
    rows = [(None, "the same row again and again")] * 3000 + [(i, f"text of row {i} with some more words") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.shard(docs, 8, bucket_bytes=8_000)
    slots = {}
    for r in found.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} == {1125}
    plain = found._jdf.queryExecution().executedPlan().toString()
    assert "ShufflePartitionIdPassThrough" in plain or "REPARTITION_BY" in plain
    sizes = [r["n"] for r in found.filter("doc_id IS NULL").groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert min(sizes) > 250


def test_mixing(docs, corpus, nothing):
    weights = {"domain": {"src1": 3.0}, "lang": {"en": 2.0}}
    rows = mixing.mix(docs, F.col("source"), weights, total_share=0.6, max_epochs=2).collect()
    taken, capacity = {}, {}
    for i, text, lang, source, _ in corpus:
        leaf = (source or "(none)", lang or "(none)", source or "(none)")
        capacity[leaf] = capacity.get(leaf, 0) + len(spaced(text))
    for r in rows:
        taken.setdefault((r["mix_domain"], r["mix_lang"], r["mix_source"]), []).append(r)
    total = 0.6 * sum(capacity.values())
    budgets = {leaf: part[0]["mix_budget"] for leaf, part in taken.items()}
    assert sum(budgets.values()) <= total + 1
    for leaf, part in taken.items():
        assert sum(r["mix_tokens"] for r in part) <= budgets[leaf] <= 2 * capacity[leaf]
        by_epoch = Counter(r["mix_epoch"] for r in part)
        assert list(by_epoch) and all(by_epoch[e] == max(by_epoch.values()) for e in by_epoch if e < max(by_epoch))
        # A prefix: the rest of the last epoch's order starts with a text that no longer fits.
        epoch = budgets[leaf] // capacity[leaf]
        mine = [(hashlib.md5(f"7:{epoch}:{i}".encode()).hexdigest(), len(spaced(t)), i) for i, t, lang, source, _ in corpus
                if (source or "(none)", lang or "(none)", source or "(none)") == leaf]
        room, want = budgets[leaf] - epoch * capacity[leaf], set()
        for _, n, i in sorted(mine):
            room -= n
            if room < 0:
                break
            want.add(i)
        if epoch < 2:
            assert {r["doc_id"] for r in part if r["mix_epoch"] == epoch} == want
    assert mixing.mix(nothing, F.col("source"), weights).count() == 0


def test_budgets_fill_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 100), ("a", "y", "3", 100), ("b", "x", "4", 1000)],
                                   "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in mixing.budgets(leaves, 200.0, {}, 1).collect()}
    assert got == {"1": 10, "2": 40, "3": 50, "4": 100}
    got = {r["source"]: r["budget"] for r in mixing.budgets(leaves, 600.0, {}, 1).collect()}
    assert got == {"1": 10, "2": 100, "3": 100, "4": 390}


def test_sharding(docs, corpus, nothing):
    found = sharding.shard(docs, 8, bucket_bytes=20_000).collect()
    assert sorted(r["doc_id"] for r in found) == [r[0] for r in corpus]
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert (r["text"], r["score"]) == (corpus[r["doc_id"]][1], 1)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs, 8, bucket_bytes=20_000).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in found}
    other = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs, 8, seed=18, bucket_bytes=20_000).collect()}
    assert other != again
    assert sharding.shard(nothing).count() == 0


def test_sharding_replaces_clashing_columns(docs):
    clash = docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit("y"))
    assert sharding.shard(clash).schema["shard"].dataType.simpleString() == "int"


def test_running_totals(spark):
    rows = [(i, (i * 7) % 5) for i in range(9000)]
    got = {r["k"]: r["before"] for r in running_totals(spark.createDataFrame(rows, "k int, v long"), "k", "v").collect()}
    total = 0
    for i, v in rows:
        assert got[i] == total
        total += v


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        if name == "sharding":
            assert out.columns == [*names, "shard", "slot"] and out.count() == docs.count()
        else:
            assert out.columns == names and 0 < out.count() <= docs.count()
        if name == "simhash_near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
            assert {r["doc_id"] for r in out.collect()} == {i for i, _ in rows} - brute_gone(rows)
        docs = out
    assert corpus_pipeline.run(spark, sf).count() == docs.count()
    assert re.match(r"\w+", corpus_pipeline.STAGES[0][0])
