"""Operators on single texts against plain Python."""

import hashlib
import inspect
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caselore.llm import decontamination, language_id, licenses, quality_classifier, quality_rules, url_filter
from caselore.llm.fm_index import FMIndex

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_rules(docs, corpus, nothing):
    found = by_id(quality_rules.quality_rules(docs))
    assert len(found) == len(corpus)
    for i, text, *_ in corpus:
        ws, r = spaced(text), found[i]
        windows = [tuple(ws[k:k + 3]) for k in range(len(ws) - 2)]
        counts = Counter(windows)
        covered = {k + d for k, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if spaced(x)]
        assert (r["n_words"], r["word_chars"]) == (len(ws), sum(map(len, ws)))
        assert (r["n_symbols"], r["n_dup_lines"]) == (len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)))
        assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(ws) < 50 or 100 * len(covered) > 50 * len(ws))
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.quality_rules(nothing).count() == 0


def test_rule_order_changes_no_verdict(spark, docs):
    rows = [(i, t) for i, t in enumerate(["GO!! " * 3 + "abcd ef " * 40, "word " * 80, "a*** b*** " * 50, " ".join(f"w{k}" for k in range(90))])]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    results = []
    for rules in (quality_rules.RULES, quality_rules.RULES[::-1]):
        results.append({i: r["kept"] for i, r in by_id(quality_rules.quality_rules(some, rules)).items()})
    assert results[0] == results[1] == {0: False, 1: False, 2: False, 3: True}


def test_licenses(docs, corpus, nothing):
    found = by_id(licenses.license_scan(docs))
    for i, text, *_ in corpus:
        ws, r = alnum(text), found[i]
        places = {}
        for t in licenses.TEMPLATES:
            key = t.key.split()
            places.setdefault(t, []).extend(k for k in range(len(ws) - len(key) + 1) if ws[k:k + len(key)] == key)
        base = [k for t, at in places.items() if t.base for k in at]
        assert (r["n_words"], r["n_base"]) == (len(ws), len(base))
        assert (r["first_word"], r["last_word"]) == (min(base, default=None), max(base, default=None))
        assert r["labels"] == ",".join(sorted({t.label for t, at in places.items() if at}))
        assert r["base_labels"] == ",".join(sorted({t.label for t, at in places.items() if at and t.base}))
        assert (r["score"] > 0) == (r["labels"] != "")
    assert found[len(corpus) - 1]["base_labels"] == "cc-by,reserved"
    assert licenses.license_scan(nothing).count() == 0


def test_fm_index():
    rng = np.random.default_rng(8)
    runs = [rng.integers(1, 4, n) for n in rng.integers(1, 60, 40)] + [np.full(70, 2)]
    text = np.concatenate([np.append(r, 0) for r in runs])
    index = FMIndex(text, 3)
    patterns = np.zeros((300, 6), np.int64)
    lengths = rng.integers(1, 7, 300)
    for k, n in enumerate(lengths):
        patterns[k, 6 - n:] = rng.integers(1, 4, n)
    low, high = index.search(patterns, lengths)
    for k, n in enumerate(lengths):
        wanted = [i for i in range(len(text) - n + 1) if np.array_equal(text[i:i + n], patterns[k, 6 - n:])]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == wanted


@pytest.mark.parametrize("phrase_words", [1_000_000, 40])
def test_decontamination(spark, docs, corpus, nothing, monkeypatch, phrase_words):
    monkeypatch.setattr(decontamination, "PHRASE_WORDS", phrase_words)
    items = [(1, " ".join(spaced(corpus[5][1])[3:25])), (2, "all rights reserved"), (11, corpus[66][1]), (3, None), (4, "..."), (None, "cc by"),
             (12, " ".join(spaced(corpus[5][1])[3:25]).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontamination.digest(decontamination.scan(docs, bench)))
    for i, text, *_ in corpus:
        ws, hit, ids = alnum(text), set(), set()
        for item, phrase in items:
            pw = alnum(phrase)
            n = min(len(pw), 10)
            for w in {tuple(pw[k:k + n]) for k in range(len(pw) - n + 1)} if pw else ():
                for k in range(len(ws) - n + 1):
                    if tuple(ws[k:k + n]) == w:
                        hit |= set(range(k, k + n))
                        ids |= {str(item)} if item is not None else set()
        r = found[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(ws), len(hit), len(ids), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    left = by_id(decontamination.cut(docs, bench))
    assert 5 in left and not any(r["contaminated"] for r in decontamination.digest(
        decontamination.scan(decontamination.cut(docs, bench), bench)).collect())
    assert 66 not in left and left[0]["text"] == corpus[0][1] and left[0]["score"] == 1
    assert decontamination.digest(decontamination.scan(nothing, bench)).count() == 0
    assert not any(r["contaminated"] for r in decontamination.digest(decontamination.scan(docs, bench.limit(0))).collect())


def test_language(spark, nothing):
    root = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(root)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    models = language_id.fit(docs.filter(~held), fit_docs=100)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 34 !?"), (-4, "the and of the"), (-5, "Ж" * 200)], "doc_id long, text string")
    found = by_id(language_id.identify(docs.select("doc_id", "text").unionByName(odd), models))
    truth = {r["doc_id"]: r["lang"] for r in docs.filter(held).select("doc_id", "lang").collect()}
    assert sum(found[i]["lang_pred"] == lang for i, lang in truth.items()) >= 0.97 * len(truth)
    assert [found[i]["lang_pred"] for i in (-1, -2, -3, -4)] == ["und", "und", "und", "en"]
    assert found[-5]["rejected"] and all(0 <= r["score"] <= 1 for r in found.values())
    assert language_id.fit(nothing) is None
    assert language_id.identify(odd, None).first()["lang_pred"] == "und"
    assert language_id.identify(nothing, models).count() == 0


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(4)
    codes, counts = np.unique(rng.integers(0, 5, 900) << 18 | rng.integers(0, 5, 900) << 12 | rng.integers(0, 5, 900) << 6 | rng.integers(0, 64, 900),
                              return_counts=True)
    model = language_id.KneserNey(codes, counts)
    for context in (int(codes[0]) >> 6, 63 << 12 | 1 << 6 | 2):
        assert abs(np.exp2(model.log2((context << 6) | np.arange(64))).sum() - 1) < 1e-9


def plain_entropies(train, texts, bits):
    """Cross-entropy of texts under a plain Kneser-Ney model of order 4 of train, by dictionaries of strings."""
    def shown(text):
        return re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower()))

    def grams(text):
        padded = "   " + shown(text)
        return [padded[i:i + 4] for i in range(len(padded) - 3)]

    counts, levels = Counter(g for t in train for g in grams(t)), []
    while True:
        once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once else 0.5
        total, kinds = Counter(), Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        levels.append((dict(counts), discount, total, kinds))
        if len(next(iter(counts))) == 1:
            break
        counts = Counter(g[1:] for g in counts)

    def p(gram):
        found = 1 / (1 << bits)
        for k, (counts, discount, total, kinds) in enumerate(reversed(levels)):
            g = gram[3 - k:]
            if g[:-1] in total:
                found = max(counts.get(g, discount) - discount, 0) / total[g[:-1]] + discount * kinds[g[:-1]] / total[g[:-1]] * found
        return found

    return [-sum(math.log2(p(g)) for g in grams(t)) / len(grams(t)) if t else math.inf for t in texts]


@pytest.mark.parametrize("remembered", [1 << 22, 10])
def test_language_models_against_plain_ones(monkeypatch, remembered):
    """More letters than 62, of scripts that only their own codes tell apart; a memory that starts anew changes nothing."""
    monkeypatch.setattr(language_id, "REMEMBERED", remembered)
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 64)
    rng = random.Random(6)
    letters = {name: [chr(first + i) for i in range(60)] for name, first in (("x", 0xAC00), ("y", 0xB000), ("z", 0x4E00))}
    drawn = lambda name, n: " ".join("".join(rng.choice(letters[name][:30]) for _ in range(rng.randrange(1, 6))) for _ in range(n))
    train = {name: [drawn(name, 30) for _ in range(12)] + ["".join(letters[name]), "1, 2"] for name in letters}
    points = np.unique(np.frombuffer("".join(t for texts in train.values() for t in texts).encode("utf-32-le"), np.uint32))
    alphabet = language_id.Alphabet(np.array([c for c in points if chr(c).isalpha()]))
    assert alphabet.bits == 8
    models = {}
    for name, texts in train.items():
        batch = pa.RecordBatch.from_pydict({"text": texts})
        codes = np.concatenate([alphabet.ngrams(points, offsets)[0] for _, points, offsets in language_id._char_blocks(iter([batch]), "text")])
        models[name] = language_id.KneserNey(*np.unique(codes, return_counts=True), alphabet.bits)
    texts = [drawn(name, 8) for name in letters for _ in range(5)] + ["", "...", "7 " + letters["y"][0]]
    found = list(language_id.Models(alphabet, models).entropies(iter([pa.RecordBatch.from_pydict({"text": texts})]), "text"))
    bits = np.concatenate([b for _, b, _ in found], axis=1)
    for k, name in enumerate(letters):
        assert np.allclose(bits[k], plain_entropies(train[name], texts, 8), rtol=1e-4)
    assert list(bits.argmin(axis=0)[:15]) == [0] * 5 + [1] * 5 + [2] * 5


def test_quality(spark, nothing):
    root = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = quality_classifier.fit(docs, labels.filter(~held))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "x" * 100_000)], "doc_id long, text string")
    scores = {i: r["score"] for i, r in by_id(quality_classifier.score(docs.select("doc_id", "text").unionByName(odd), model)).items()}
    truth = {r["doc_id"]: r["quality"] for r in labels.filter(held).collect()}
    right = sum((scores[i] >= quality_classifier.THRESHOLD) == (q == 1) for i, q in truth.items())
    assert right >= 0.93 * len(truth) and all(0 <= s <= 1 for s in scores.values())
    kept = quality_classifier.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if i >= 0 and s >= quality_classifier.THRESHOLD}
    one_class = quality_classifier.fit(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in quality_classifier.score(docs, one_class).collect()} == {1.0}
    assert quality_classifier.score(nothing, model).count() == 0


def test_urls(spark, nothing):
    rules = (url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"),
             url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow"))
    urls = ["http://A.Example.NET/en/x?y", "https://a.net/", "https://a.net", "ftp://example.com/de/", "http://notexample.com/de/1", "x.org/fr/", None,
            "", "http://x.org/fr/#://y/", "http://b.org/FR/", "é://net/ü", "http://net?q=/en/", "a://b://c.net/", "http://x.net/\nen/"]
    urls += [f"http://m{k}.example.net/en/{k}" for k in range(40)] + [f"http://m{k}.example.com/de/{k}" for k in range(40)]
    urls += ["http://q.example.com/en/7"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r["page_id"]: r for r in url_filter.judge(pages, rules).collect()}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = host.translate(str.maketrans(UPPER, LOWER))
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best.text if best else None)
        assert r["verdict"] == (best.verdict if best else r["verdict"]) and r["verdict"] in ("allow", "block")
    assert len({rows[len(urls) - k]["verdict"] for k in (1, 2, 3)}) == 1
    only = url_filter.judge(pages.filter("page_id > 2 and page_id < 8"), rules).collect()
    assert {r["verdict"] for r in only if r["rule"] is None} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_url_models_and_threshold_come_from_all_rows(spark):
    """Counts are those of all judged URLs, and the threshold is the best of a plain search over all scores of the other folds."""
    urls = [(i, f"http://{'good' if i % 3 else 'bad'}{'abcdefg'[i % 7]}.x/{i % 11}{'q' * (i % 5)}", "allow" if i % 3 else "block") for i in range(300)]
    rows = spark.createDataFrame(urls, "page_id long, url string, verdict string").repartition(3)
    models, threshold = url_filter.fit(rows)
    for side in ("allow", "block"):
        chars = "".join(u for _, u, v in urls if v == side)
        order, grams, share, context, backoff = models[side].levels[0]
        want = [chars.count(chr(c)) if chr(c) != "0" else sum(x.isdigit() for x in chars) for c in grams]
        assert np.allclose(share, np.array(want) / (len(chars) + len(grams)))
    assert np.isfinite(threshold)
    every, a, b = np.array([.5, -1, 2, 0.25]), np.array([3, 1, 4, 0]), np.array([0, 5, 1, 2])
    plain = {e: a[every >= e].sum() / 8 + b[every < e].sum() / 8 for e in (-2, -.375, .375, 1.25, 3)}
    assert url_filter.best_threshold(every, a, b) == max(plain, key=lambda e: (plain[e], -abs(e)))
    assert "limit" not in inspect.signature(url_filter.fit).parameters and "fit_rows" not in inspect.signature(url_filter.fit).parameters


def test_held_out_is_by_id():
    assert zlib.crc32(b"7") % 4 in range(4)
