"""Spelling variants, substring dedup and the filter audit against plain Python."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caselore.llm import filter_audit, spelling, substring_dedup
from caselore.llm.blocks import to_block

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def same(a):
    """An extra column of every name that the operators use inside."""
    names = ["doc", "mark", "digit", "names", "id", "part", "mask", "digest", "word", "n", "key", "r", "low", "DOC_ID", "Text", "a.b", "level"]
    return a.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])


# Spelling variants

def plain_counts(rows, every):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if every and h % every == 0 else run] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(counts, ratio=2):
    near, form = defaultdict(list), {}
    for a in counts:
        near[a] = [b for b in counts if one_edit(a, b)]
        best = min(near[a], key=lambda b: (-counts[b], b), default=None)
        if best is not None and counts[best] >= ratio * counts[a]:
            form[a] = best
    out = {}
    for a in counts:
        root = a
        while root in form:
            root = form[root]
        out[a] = (form.get(a), root, counts[a], len(near[a]), counts[form[a]] if a in form else None)
    return out


def variants_of(spark, counts):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(frame).collect()}


@pytest.mark.parametrize("every", [None, 2, 97])
def test_word_counts(spark, docs, corpus, every):
    got = {r["word"]: r["n"] for r in spelling.word_counts(same(docs), every).collect()}
    assert got == plain_counts([(r[0], r[1]) for r in corpus], every)


def test_word_counts_of_odd_texts(spark, nothing):
    rows = [(None, "Aé×÷ÿ Ÿé中aÀ"), (1, "x" * 200 + " " + "y" * 63 + "é" + " É"), (1, "x" * 200), (2, None), (3, ""), (4, "é"), (5, "é")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    for every in (None, 1, 3):
        assert {r["word"]: r["n"] for r in spelling.word_counts(frame, every).collect()} == plain_counts(rows, every)
    assert spelling.word_counts(nothing).count() == 0


def test_variants(spark, docs):
    rng = np.random.default_rng(1)
    base = ["".join(rng.choice(list("abcé"), int(n))) for n in rng.integers(5, 9, 150)]
    counts = {w: int(n) for w, n in zip(base, rng.integers(1, 60, len(base)), strict=True)}
    # A chain of forms, ties of n, a word that only a longer one is near to, and one near to nothing.
    counts |= {"stone": 3, "stones": 6, "stonesy": 12, "stonesyx": 24, "lonely!": 1, "ties0": 2, "ties1": 4, "ties2": 4, "": 5, "q": 9, "z" * 3000: 4, "z" * 2999: 9}
    assert variants_of(spark, counts) == plain_variants(counts)


def test_variants_of_copies_nulls_and_none(spark):
    frame = spark.createDataFrame([("same", 1, 7), (None, 5, 7), ("same", 2, 7), ("sane", None, 7), ("alone", 1, 7)], "word string, n long, N int")
    got = {r["word"]: (r["form"], r["n"], r["n_near"]) for r in spelling.spelling_variants(frame).collect()}
    assert got == {"same": (None, 3, 1), "sane": ("same", 0, 1), "alone": (None, 1, 0)}
    none = spelling.spelling_variants(spark.createDataFrame([], "word string, n long"))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0


@given(st.lists(st.text("ab", max_size=5), min_size=2, max_size=2), st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_neighbourhood_holds_every_edit(pair, symbols):
    """Words that one edit tells apart have reduced words in each other's neighbourhood, and keys are those of the words."""
    a, b = (np.array([[ord(x) % symbols for x in w]], np.int64).reshape(1, -1) for w in pair)
    if one_edit(*pair) or pair[0] == pair[1]:
        assert spelling.key_of(b, symbols)[0] in spelling.neighbourhood(a, symbols)[0]
    assert spelling.key_of(a, symbols)[0] == spelling.neighbourhood(a, symbols)[0, 0]


def test_symbols_grow_until_pairs_are_few(spark):
    """Words that a few symbols cannot tell apart get more symbols: the pairs stay as many as the words."""
    words = ["".join(p) for p in permutations("abcdefgh", 5)]
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    classes = spelling._alphabet(frame)
    groups = Counter("".join(str(classes[x]) for x in w) for w in words)
    assert sum(c * (c - 1) // 2 for c in groups.values()) <= len(words)


# Substring dedup

def plain_dedup(rows, window):
    texts = [(doc, SPACED.findall(text or "")) for doc, text in rows]
    least = {}
    for doc, ws in texts:
        for k in range(len(ws) - window + 1):
            if doc is not None:
                key = tuple(ws[k:k + window])
                least[key] = min(doc, least.get(key, doc))
    out = []
    for doc, ws in texts:
        gone = set()
        for k in range(len(ws) - window + 1):
            if doc is not None and least[tuple(ws[k:k + window])] < doc:
                gone |= set(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((doc, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def dedup(frame, window, **more):
    found = substring_dedup.dedup_substrings(frame, window, with_kept=True, **more)
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")) for r in found.collect()), key=str)


@pytest.mark.parametrize("window", [2, 5, 13])
def test_substrings(docs, corpus, window):
    assert dedup(same(docs), window, extend=window == 13) == plain_dedup([(r[0], r[1]) for r in corpus], window)


def test_substrings_of_few_words(spark):
    """Overlaps, repeats inside a document, edits in the middle of runs, equal and null ids, ids of text."""
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 30)) if rng.random() < 0.95 else None, " ".join(rng.choice(list("abc"), int(n)))) for n in rng.integers(0, 40, 60)]
    rows += [(3, rows[0][1])] * 3 + [(None, rows[0][1]), (None, None), (7, None), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert dedup(frame, 4) == plain_dedup(rows, 4)
    named = [(None if doc is None else f"id{doc:03}", text) for doc, text in rows]
    assert dedup(spark.createDataFrame(named, "doc_id string, text string"), 6) == plain_dedup(named, 6)


def test_substrings_of_many_copies_and_none(spark, nothing):
    """A third of the rows are one text; nothing is lost and the first one stays."""
    text = " ".join(f"w{k}" for k in range(200))
    rows = [(k, text if k % 3 == 0 else f"only{k} " * 20) for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert dedup(frame, 13, extend=False) == plain_dedup(rows, 13)
    assert substring_dedup.dedup_substrings(nothing).count() == 0
    assert substring_dedup.dedup_substrings(nothing.select("text", "doc_id"), extend=False).count() == 0


def test_doubling_ends_when_nothing_is_shared(spark):
    rng = np.random.default_rng(8)
    shared = " ".join(f"s{x}" for x in rng.integers(0, 10**6, 900))
    own = [" ".join(f"o{x}" for x in rng.integers(0, 10**6, 300)) for _ in range(3)]
    rows = [(1, f"{own[0]} {shared}"), (2, f"{shared} {own[1]}"), (3, own[2]), (4, own[2][:len(own[2]) // 2]), (5, "few words")]
    found = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    longest = {r["doc_id"]: r["longest"] for r in found.collect()}
    # A stretch of n shared words is found at level L at the latest if n >= 1.5 L, and never where L > n.
    assert longest[1] == longest[2] and 416 <= longest[1] <= 832
    assert longest[3] == longest[4] and 52 <= longest[3] <= 104 and longest[5] == 0


@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=40), st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_names_of_windows_are_those_of_their_words(letters, window):
    import pyarrow as pa

    block = to_block(pa.array([" ".join(letters)]))
    names = substring_dedup.word_names(block)[3]
    lengths = substring_dedup._lengths(window)
    for have, want in zip(lengths[:-1], lengths[1:], strict=True):
        assert have < want <= 2 * have
        names = substring_dedup.extended(names, have, want)
    by_name = defaultdict(set)
    for k, name in enumerate(names.tolist()):
        by_name[name].add(tuple(letters[k:k + window]))
    assert all(len(x) == 1 for x in by_name.values()) and len(by_name) == len({x for v in by_name.values() for x in v})


def test_a_full_bit_set_loses_nothing(spark):
    digits = spark.range(5000).select(F.xxhash64("id").alias("digit"))
    table = substring_dedup.bit_set(spark, digits, 1 << 12).value
    assert len(table) == 64
    wanted = np.array([r["digit"] for r in digits.collect()], np.int64).view(np.uint64)
    assert substring_dedup.in_bit_set(table, wanted).all()


# Filter audit

def plain_masks(rows):
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    for doc, text, part in rows:
        text = text or ""
        ws = SPACED.findall(text)
        yield doc, part or "", {
            "A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and least[text] < doc}


def plain_audit(rows, labels):
    good, bad = ({d for d, *marks in labels if marks[k] == 1 and d is not None} for k in (0, 1))
    out, docs = {}, list(plain_masks(rows))
    for part in {p for _, p, _ in docs}:
        mine = [(d, m) for d, p, m in docs if p == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(d, m) for d, m in left if m[f]]
                left = [(d, m) for d, m in left if not m[f]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(m[f] for _, m in mine) - len(gone),
                                          sum(m[f] and sum(m.values()) == 1 for _, m in mine),
                                          sum(d in good for d, _ in gone), sum(d in bad for d, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def audited(docs, labels):
    return {tuple(r[:3]): list(r[3:]) for r in filter_audit.audit(docs, labels).collect()}


def test_audit(spark, docs, corpus):
    long = "Word " * 150 + " ".join(f"w{k}" for k in range(160))
    rows = [(r[0], r[1], r[3]) for r in corpus]
    more = [(900, long, "src1"), (901, long, "src2"), (None, long, "src2"), (901, long, "src2"), (902, "A# " * 300, None), (None, None, ""), (903, "", "new")]
    marks = [(k, k % 2, k % 3 == 0) for k in range(0, 905, 3)] + [(900, 1, 1), (901, 1, 0), (901, 0, 1), (901, None, None), (None, 1, 1)]
    labels = spark.createDataFrame([(d, q, int(t) if t is not None else None) for d, q, t in marks], "doc_id long, quality int, toxic int")
    frame = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))
    got = audited(same(frame), same(labels))
    assert got == plain_audit(rows + more, marks)
    assert all(len([k for k in got if k[0] == p]) == 600 for p in {k[0] for k in got})


def test_audit_of_many_copies_and_none(spark, nothing):
    rows = [(k, "copy " * 5 if k % 3 == 0 else f"text {k}", f"s{k % 2}") for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(frame, labels) == plain_audit(rows, [])
    assert filter_audit.audit(nothing, labels).count() == 0


@given(st.lists(st.text(st.sampled_from(list("aAé中😀#|& \n\t "))), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_transducer(texts):
    import pyarrow as pa

    got = filter_audit.text_counts(to_block(pa.array(texts)))
    for k, text in enumerate(texts):
        ws = SPACED.findall(text)
        assert [got[c][k] for c in ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")] == [
            len(ws), len(set(ws)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text))]


# Hashes

def doubling(n):
    """The alternating doubling text of a and b, and its complement: equal sums under any modulus that is a power of two."""
    text = "a"
    while len(text) < n:
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 1 << 16])
def test_doubling_texts_differ(spark, n):
    from caselore.llm import decontamination, quality_rules
    from caselore.llm.blocks import Hashes

    one, other = doubling(n)
    assert len({int(Hashes(np.frombuffer(x.encode(), np.uint8)).of(np.array([0]), np.array([n]))[0]) for x in (one, other)}) == 2
    frame = spark.createDataFrame([(1, f"{one}\n{other}"), (2, f"{one}\n{one}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_dup_lines"] for r in quality_rules.quality_rules(frame).collect()} == {1: 0, 2: 1}
    items = spark.createDataFrame([("item", one)], "item_id string, text string")
    words = spark.createDataFrame([(1, other), (2, one)], "doc_id long, text string")
    found = decontamination.digest(decontamination.scan(words, items)).collect()
    assert {r["doc_id"]: (r["n_hit"], r["contaminated"]) for r in found} == {1: (0, False), 2: (1, True)}


@given(st.binary(min_size=0, max_size=60), st.data())
@settings(max_examples=100, deadline=None)
def test_equal_bytes_have_equal_hashes(data, draw):
    from caselore.llm.blocks import Hashes

    i = draw.draw(st.integers(0, len(data)))
    j = draw.draw(st.integers(i, len(data)))
    whole, part = (np.frombuffer(x, np.uint8) for x in (data, data[i:j]))
    want = int(Hashes(part).of(np.array([0]), np.array([j - i]))[0])
    assert int(Hashes(whole).of(np.array([i]), np.array([j]))[0]) == want
    if j > i:
        assert int(Hashes(whole).rolling(j - i)[i]) == want


def test_the_query_goes_through_all_levels(spark, tmp_path, monkeypatch):
    """The doubling is not stopped at the window: levels of 26 words and more are compared too."""
    from caselore.llm import queries

    long = " ".join(f"w{i}" for i in range(60))
    spark.createDataFrame([(1, long), (2, long), (3, "short text")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    seen, extend = [], substring_dedup._extend
    monkeypatch.setattr(substring_dedup, "_extend", lambda rows, window: seen.append(extend(rows, window)) or seen[-1])
    found = queries.op12_substring_dedup(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in found.collect()) == [(1, 60, 0), (2, 60, 60), (3, 2, 0)]
    assert max(r["longest"] for r in seen[0].collect()) >= 26


def test_names_of_long_and_odd_words():
    """Words around 8 and 16 bytes, with zero bytes and at the ends of texts; equal words have equal names wherever they stand."""
    import pyarrow as pa

    shapes = ["a" * n for n in (1, 7, 8, 9, 15, 16, 17, 40)] + ["a\0", "a\0\0", "\0", "\0\0", "aaaaaaaa\0", "é" * 8, "é" * 9]
    rows = [" ".join(shapes), *shapes, "\n".join(shapes[::-1]) + " "]
    block = to_block(pa.array(rows))
    starts, ends, _, *names = substring_dedup.word_names(block)
    texts = [block.data[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
    for one in names:
        assert len(set(one.tolist())) == len(set(texts)) == len({*zip(one.tolist(), texts, strict=True)}) == len(shapes)


@given(st.lists(st.text(alphabet="ab \n\té", max_size=12), min_size=1, max_size=6), st.randoms())
@settings(max_examples=100, deadline=None)
def test_kept_words_are_joined_by_one_space(rows, random):
    import pyarrow as pa

    block = to_block(pa.array(rows))
    starts, ends, first, *_ = substring_dedup.word_names(block)
    stay = np.array([random.random() < 0.6 for _ in starts], bool)
    want = [b" ".join(block.data[starts[k]:ends[k]].tobytes() for k in range(i, j) if stay[k])
            for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    assert substring_dedup._kept_texts(block, starts, ends, stay) == want


def test_stored_steps_leave_no_shuffle_files(spark, docs):
    """Disk: what a step was shuffled by goes when its rows are stored; the setting of the session stays as it was."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for name in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}

    before, was = shuffles(), spark.conf.get(key)
    substring_dedup._stored(docs.groupBy("source").agg(F.count("*").alias("n")), "counts")
    until = time.monotonic() + 20  # files are deleted beside other work
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(key) == was
