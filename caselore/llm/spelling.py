"""Spelling variant grouping by a reduced alphabet: words that differ by one edit, and the form that each is a variant of.

Letters are dealt to a few symbols, so that one edit of a word is at most one edit of its reduced word. For every distinct
reduced word its full one-edit neighbourhood is generated (itself, all deletions, replacements and insertions of a
symbol) as 64-bit keys, the keys are joined to the keys of the reduced vocabulary, and the words behind the pairs that
are left are compared in full by their edit distance in code points. A key that two reduced words share by chance makes
one more pair to compare and no wrong one.

Symbols are dealt by how many words a letter is in, the most frequent first to the symbol with the least so far. Their
number is the least at which words that share a reduced word make no more pairs than there are words; at the most every letter is
a symbol of its own and no two words share one. So the pairs grow with the vocabulary, whatever words it has.

A word's form is the near word of largest n (ties: the smallest in code-point order) if it has at least `ratio` times the
word's n; forms are followed to the root by pointer jumping, whose rounds grow with the logarithm of the longest chain.

A null text has no words, a null id is the empty text where deletions are dealt. Rows of one word are added up, null words are
left out, words without a near word have none. Repeated rows of a text count each. Empty tables give no rows. Columns
are found by their exact names, others play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import LOWER, blocks, byte_table, mixed, spans, word_of_text
from caselore.llm.columns import pick
from caselore.session import scratch_path

#: Texts are taken in blocks of about this size when words are counted.
COUNT_BYTES = 1 << 22
#: So many reduced words of one length are in hand at a time.
CHUNK_CELLS = 1 << 18
#: Numbers of symbols that are tried, the least first; beyond them every letter has its own.
SYMBOLS = (4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48)

_LETTER = byte_table({*range(0x41, 0x5B), *range(0x61, 0x7B)})
_LONG = 64
_BASE = 0x9E3779B97F4A7C15


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def runs_of_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of [A-Za-z\\u00C0-\\u00FF]+: letters of one byte, and those of two bytes that start with C3."""
    two = np.zeros(len(data), bool)
    two[:-1] = (data[:-1] == 0xC3) & ((data[1:] & 0xC0) == 0x80)
    borders = offsets[1:-1]
    two[borders[borders > 0] - 1] = False
    is_word = _LETTER[data] | two
    is_word[1:] |= two[:-1]
    return spans(is_word, offsets)


def crc_of_pairs(prefixes: np.ndarray, text: np.ndarray, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of prefix + word from those of both: that of the prefix carried on over as many zero bytes as the word has."""
    out = np.zeros(len(text), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.searchsorted(lengths[order], np.arange(_LONG + 2))
    carried = prefixes.copy()
    for length in range(_LONG + 1):
        at = order[cuts[length]:cuts[length + 1]]
        out[at] = crcs[at] ^ carried[text[at]]
        carried = (carried >> np.uint32(8)) ^ _CRC[carried & np.uint32(0xFF)]
    return out


def word_counts(docs: DataFrame, deleted_in: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lower-cased, and how often they occur in all texts.

    With `deleted_in` a run whose CRC-32 h of "<id>:<run>" is a multiple of it loses its code point h % length first; what is
    left may be empty.
    """
    texts = pick(docs, id=id_col, text=text_col).select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", COUNT_BYTES):
            starts, ends, first = runs_of_letters(block.data, block.offsets)
            if not len(starts):
                continue
            lengths = ends - starts
            cuts = np.concatenate([[0], np.cumsum(lengths)])
            data = LOWER[block.data[np.arange(cuts[-1]) + np.repeat(starts - cuts[:-1], lengths)]]
            found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
            coded = found.dictionary_encode()
            numbers, distinct = coded.indices.to_numpy(), coded.dictionary
            if deleted_in:
                changed, touched = Counter(), _deletions(block.rows.column("id"), word_of_text(first), numbers, lengths, distinct, deleted_in)
                for k, h in touched:
                    word = distinct[int(numbers[k])].as_py()
                    cut = h % len(word)
                    changed[word[:cut] + word[cut + 1:]] += 1
                numbers = np.delete(numbers, [k for k, _ in touched])
                if changed:
                    yield pa.RecordBatch.from_arrays([pa.array(list(changed)), pa.array(list(changed.values()), pa.int64())], ["word", "n"])
            counts = np.bincount(numbers, minlength=len(distinct))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([distinct.take(pa.array(seen)).cast(pa.string()), pa.array(counts[seen])], ["word", "n"])

    return texts.mapInArrow(step, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _deletions(ids: pa.Array, text: np.ndarray, numbers: np.ndarray, lengths: np.ndarray, distinct: pa.Array,
               every: int) -> list[tuple[int, int]]:
    """(place, h) of the runs whose h is a multiple."""
    prefixes = np.array([zlib.crc32(f"{x}:".encode()) for x in ids.to_pylist()], np.uint32)
    crcs = np.array([zlib.crc32(w.encode()) for w in distinct.to_pylist()], np.uint32)
    h = crc_of_pairs(prefixes, text, crcs[numbers], lengths)
    for k in np.flatnonzero(lengths > _LONG).tolist():
        h[k] = zlib.crc32(distinct[int(numbers[k])].as_py().encode(), int(prefixes[text[k]]))
    at = np.flatnonzero(h % np.uint32(every) == 0)
    return list(zip(at.tolist(), h[at].tolist(), strict=True))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(letters: list[tuple[str, int]], symbols: int) -> dict[str, int]:
    """The symbol of every letter: the most frequent first, each to the symbol with the least so far."""
    load, out = [0] * symbols, {}
    for letter, n in sorted(letters, key=lambda x: (-x[1], x[0])):
        least = min(range(symbols), key=lambda s: (load[s], s))
        out[letter] = least
        load[least] += n
    return out


def reduced(word: Column, classes: dict[str, int]) -> Column:
    """The word in symbols, each one code point from U+4E00 on."""
    return F.translate(word, "".join(classes), "".join(chr(0x4E00 + s) for s in classes.values()))


def _alphabet(vocabulary: DataFrame) -> dict[str, int]:
    """The least number of symbols at which words of one reduced word make no more pairs than there are words."""
    # As many rows as there are different letters, however many words.
    letters = [(r["letter"], r["n"]) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
               .filter("letter <> ''").groupBy("letter").agg(F.count("*").alias("n")).collect()]
    for symbols in [s for s in SYMBOLS if s < len(letters)]:
        classes = dealt(letters, symbols)
        sizes = vocabulary.groupBy(reduced(F.col("word"), classes).alias("r")).agg(F.count("*").alias("c"))
        pairs, total = sizes.agg(F.sum(F.expr("cast(c as decimal(38, 0)) * (c - 1) / 2")), F.sum("c")).first()
        if pairs <= total:
            return classes
    return {letter: k for k, (letter, _) in enumerate(sorted(letters))}


def neighbourhood(cells: np.ndarray, symbols: int) -> np.ndarray:
    """Per row of symbols (m x length) the keys of all its variants by one edit; the first column is the key of the row itself."""
    m, length = cells.shape
    powers = np.ones(length + 2, np.uint64)
    powers[1:] = np.multiply.accumulate(np.full(length + 1, _BASE, np.uint64))
    values = mixed(np.arange(1, symbols + 1, dtype=np.uint64))
    terms = values[cells]
    before = np.zeros((m, length + 1), np.uint64)  # the sum of the symbols before a place
    np.cumsum(terms * powers[:length], axis=1, out=before[:, 1:])
    here = np.zeros((m, length + 1), np.uint64)  # that of the symbols from a place on, moved to one place further
    here[:, :length] = (terms * powers[1:length + 1])[:, ::-1].cumsum(axis=1)[:, ::-1]
    less = np.zeros((m, length + 1), np.uint64)  # and moved to one place before
    less[:, 1:length] = (terms[:, 1:] * powers[:length - 1])[:, ::-1].cumsum(axis=1)[:, ::-1]
    whole = before[:, -1:]
    deleted = before[:, :length] + less[:, 1:] if length else np.zeros((m, 0), np.uint64)
    replaced = (whole[:, :, None] + (values - terms[:, :, None]) * powers[:length, None]).reshape(m, -1)
    inserted = (before[:, :, None] + here[:, :, None] + values * powers[:length + 1, None]).reshape(m, -1)
    return np.concatenate([mixed(whole + np.uint64(length)), mixed(deleted + np.uint64(length - 1)) if length else deleted,
                           mixed(replaced + np.uint64(length)), mixed(inserted + np.uint64(length + 1))], axis=1)


def _by_length(column: pa.Array, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of symbols) of the reduced words of each length, a bounded number at a time."""
    texts = column.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    for length in np.unique(lengths).tolist():
        rows = max(1, CHUNK_CELLS // ((length + 1) * (2 * symbols + 1)))
        places = np.flatnonzero(lengths == length)
        for k in range(0, len(places), rows):
            at = places[k:k + rows]
            joined = "".join(texts[i] for i in at).encode("utf-32-le")
            yield at, np.frombuffer(joined, np.uint32).reshape(len(at), length).astype(np.int64) - 0x4E00


def _keys(words: DataFrame, classes: dict[str, int]) -> DataFrame:
    """(word, n, key)"""
    symbols = max(1, len(set(classes.values())))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.uint64)
            for at, cells in _by_length(batch.column("r"), symbols):
                keys[at] = key_of(cells, symbols)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys.view(np.int64))], ["word", "n", "r", "key"])

    return words.select("word", "n", reduced(F.col("word"), classes).alias("r")).mapInArrow(step, "word string, n long, r string, key long")


def key_of(cells: np.ndarray, symbols: int) -> np.ndarray:
    """The key of every row of symbols, as neighbourhood() has it in its first column."""
    powers = np.ones(cells.shape[1] + 1, np.uint64)
    powers[1:] = np.multiply.accumulate(np.full(cells.shape[1], _BASE, np.uint64))
    values = mixed(np.arange(1, symbols + 1, dtype=np.uint64))
    return mixed((values[cells] * powers[:-1]).sum(axis=1, dtype=np.uint64) + np.uint64(cells.shape[1]))


def _variants(keyed: DataFrame, symbols: int) -> DataFrame:
    """(src, dst): the keys of the one-edit neighbourhood of every distinct reduced word that are not less than its own."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, cells in _by_length(batch.column("r"), symbols):
                keys = neighbourhood(cells, symbols).view(np.int64)
                src = keys[:, :1].copy()
                keys.sort(axis=1)
                fresh = keys >= src
                fresh[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(src[:, 0], fresh.sum(axis=1))), pa.array(keys[fresh])], ["src", "dst"])

    return keyed.select("r").distinct().mapInArrow(step, "src long, dst long")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, other, other_n): words that one inserted, deleted or replaced code point tells apart, both ways."""
    classes = _alphabet(vocabulary)
    keyed = _stored(_keys(vocabulary, classes), "keys")
    known = keyed.select(F.col("key").alias("dst")).distinct()
    pairs = _variants(keyed, max(1, len(set(classes.values())))).join(known, "dst", "left_semi").distinct()
    one, other = (keyed.select(F.col("key").alias(k), F.col("word").alias(w), F.col("n").alias(m))
                  for k, w, m in (("src", "word", "n"), ("dst", "other", "other_n")))
    compared = pairs.join(one, "src").join(other, "dst").filter(
        ((F.col("src") < F.col("dst")) | (F.col("word") < F.col("other")))
        & (F.abs(F.char_length("word") - F.char_length("other")) <= 1) & (F.levenshtein("word", "other", 1) == 1))
    both = F.array(F.struct("word", "n", "other", "other_n"),
                   F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return compared.select(F.inline(both))


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    vocabulary = _stored(pick(words, word="word", n="n").filter("word IS NOT NULL").groupBy("word")
                         .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "vocabulary")
    if vocabulary.isEmpty():
        return vocabulary.select("word", F.lit(None).cast("string").alias("form"), "word", "n", "n", "n").toDF(
            "word", "form", "root", "n", "n_near", "form_n")
    near = near_pairs(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("neg"), "other")).alias("best"))
    described = _stored(
        vocabulary.join(near, "word", "left").withColumn("large", -F.col("best.neg") >= ratio * F.col("n"))
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("large"), F.col("best.other")).alias("form"),
                F.when(F.col("large"), -F.col("best.neg")).alias("form_n")), "forms")
    roots = _roots(described.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return (described.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _roots(pointers: DataFrame) -> DataFrame:
    """(word, root): pointers followed to their ends; n grows along them, so they have ends."""
    while True:
        ahead = pointers.select(F.col("word").alias("at"), F.col("root").alias("next"))
        pointers = pointers.join(ahead, pointers["root"] == ahead["at"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        pointers = _stored(pointers, "roots")
        if pointers.filter("moved").isEmpty():
            return pointers.drop("moved")
