"""Language identification by interpolated Kneser-Ney character models.

Every language has a model of order 4 over letters: text is lower-cased, runs of anything else are one space, and every
letter of the learned texts has a code of its own (of more than 32766 letters the most frequent ones; letters never
learned share one). A code has as many bits as these letters need, at least 6 and at most 15, so an n-gram is packed into 60
bits or fewer; the packed code is its own hash, and a model keeps sorted arrays of codes with their discounted shares
and back-off weights. A text gets the
language of the lowest cross-entropy per character; a text whose best cross-entropy lies above the 99.5th percentile
of that language's held-back documents is marked as rejected (it is in none of the languages), but still gets its best.

Models are fitted on a bounded sample of labelled documents: about fit_docs per language, chosen by a hash of the id,
whole texts; every fifth of them is held back for the calibration. All documents are scored, whole.

Null texts and texts without a letter are `und` with score 0, and so is everything if no language could be learned.
Ties go to the first language by name. Repeated rows get equal results. An empty table gives no rows. Only the id, the
text and, for learning, the language are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.llm.char_models import gathered, looked_up

ORDER, LEAST_BITS, MOST_BITS = 4, 6, 15
FIT_DOCS = 1500
BLOCK_CHARS = 1 << 20
REJECT_ABOVE = 0.995
#: Sharpness of the score: the softmax of the cross-entropies times this.
SHARPNESS = 12.0
#: Different n-grams whose probabilities a task remembers; beyond that it starts anew.
REMEMBERED = 1 << 22
UNKNOWN = "und"


@functools.cache
def _alphabetic() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _char_blocks(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, code points of the lower-cased texts, offsets) with about BLOCK_CHARS characters at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(lengths // BLOCK_CHARS)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            rows = batch.slice(start, end - start)
            texts = [(t or "").lower() for t in rows.column(text_col).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            yield rows, np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32), offsets


class Alphabet:
    """Codes of the letters: 0 for anything else, numbers from 1 for the known, the last code for the rest."""

    def __init__(self, letters: np.ndarray):
        self.bits = min(max((len(letters) + 1).bit_length(), LEAST_BITS), MOST_BITS)
        rest = (1 << self.bits) - 1
        known = letters[:rest - 1]
        self.table = np.where(_alphabetic(), rest, 0).astype(np.uint16)
        self.table[known] = np.arange(1, len(known) + 1)

    def ngrams(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n-gram code ending at each character, offsets, letters of each text); runs of non-letters count once."""
        codes = self.table[points]
        inner = offsets[1:-1][offsets[1:-1] < len(codes)]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
        keep[inner] = True
        total = np.concatenate([[0], np.cumsum(keep)])
        offsets, codes = total[offsets], codes[keep].astype(np.int64)
        packed = codes.copy()
        age = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
        for k in range(1, ORDER):
            before = np.zeros(len(codes), np.int64)
            before[k:] = codes[:-k] if k else codes
            before[age < k] = 0
            packed |= before << (self.bits * k)
        letters = np.diff(np.concatenate([[0], np.cumsum(codes > 0)])[offsets])
        return packed, offsets, letters


def _grouped(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(codes, return_inverse=True)
    return keys, np.bincount(at, values, len(keys))


class KneserNey:
    """Interpolated Kneser-Ney over packed codes, from the counts of full n-grams."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bits: int = LEAST_BITS):
        self.levels, self.bits = [], bits
        for order in range(ORDER, 0, -1):
            context, total = _grouped(codes >> bits, counts)
            _, kinds = _grouped(codes >> bits, np.ones(len(codes)))
            once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
            discount = once / (once + 2 * twice) if once else 0.5
            share = (counts - discount) / total[np.searchsorted(context, codes >> bits)]
            self.levels.append((order, codes, np.maximum(share, 0), context, discount * kinds / total))
            # Below the top, an n-gram counts once for every different character before it.
            codes, counts = _grouped(codes & ((1 << (bits * (order - 1))) - 1), np.ones(len(codes)))

    def log2(self, wanted: np.ndarray) -> np.ndarray:
        p = np.full(len(wanted), 1.0 / (1 << self.bits))
        for order, codes, share, context, backoff in reversed(self.levels):
            now = wanted & ((1 << (self.bits * order)) - 1)
            p = looked_up(codes, share, now) + looked_up(context, backoff, now >> self.bits, 1.0) * p
        return np.log2(p)


class Models:
    def __init__(self, alphabet: Alphabet, by_language: dict[str, KneserNey], limits: dict[str, float] | None = None):
        self.alphabet, self.by_language, self.limits = alphabet, by_language, limits or {}

    def entropies(self, batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """(rows, cross-entropy per text and language, letters per text). A code is looked up once in a task."""
        seen, known = np.zeros(0, np.int64), np.zeros((len(self.by_language), 0), np.float32)
        for rows, points, offsets in _char_blocks(batches, text_col):
            codes, offsets, letters = self.alphabet.ngrams(points, offsets)
            wanted, at = np.unique(codes, return_inverse=True)
            if len(seen) > REMEMBERED:
                seen, known = seen[:0], known[:, :0]
            new = np.setdiff1d(wanted, seen, assume_unique=True)
            fresh = np.array([model.log2(new) for model in self.by_language.values()], np.float32).reshape(len(known), len(new))
            order = np.argsort(np.concatenate([seen, new]), kind="stable")
            seen, known = np.concatenate([seen, new])[order], np.concatenate([known, fresh], axis=1)[:, order]
            bits, full = known[:, np.searchsorted(seen, wanted)], np.flatnonzero(np.diff(offsets))
            out = np.full((len(known), rows.num_rows), np.inf)
            for k in range(len(known)):
                if len(full):
                    out[k, full] = -np.add.reduceat(bits[k][at], offsets[full], dtype=np.float64) / np.diff(offsets)[full]
            yield rows, out, letters


def _sampled(train: DataFrame, lang_col: str, id_col: str, fit_docs: int) -> DataFrame:
    """About fit_docs documents of every language, by a hash of the id."""
    counts = {r[0]: r[1] for r in train.groupBy(lang_col).count().collect()}
    share: Column = F.lit(0.0)
    for name, n in sorted(counts.items()):
        share = F.when(F.col(lang_col) == name, F.lit(min(1.0, fit_docs / n))).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(11), id_col), F.lit(1 << 20)) / float(1 << 20)
    fold = F.pmod(F.xxhash64(F.lit(12), id_col), F.lit(5))
    return train.filter(place < share).withColumn("__held_back", fold == 0)


def fit(train: DataFrame, fit_docs: int = FIT_DOCS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Models | None:
    """Models of the languages of `train` (rows without a language are left out); None if there are none."""
    train = train.select(id_col, text_col, lang_col).filter(F.col(lang_col).isNotNull())
    sample = _sampled(train, lang_col, id_col, fit_docs)
    fitted, held_back = sample.filter(~F.col("__held_back")), sample.filter("__held_back")

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        for _, points, _ in _char_blocks(batches, text_col):
            yield "letters", *np.unique(points[_alphabetic()[points]], return_counts=True)

    found = gathered(fitted.select(text_col), letters)
    if not found:
        return None
    points, counts = found["letters"]
    alphabet = Alphabet(points[np.lexsort((points, -counts))])

    def ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        for rows, points, offsets in _char_blocks(batches, text_col):
            codes, offsets, _ = alphabet.ngrams(points, offsets)
            languages = np.array(rows.column(lang_col).to_pylist(), object)
            of = np.repeat(np.arange(len(languages)), np.diff(offsets))
            for name in set(languages):
                yield name, *np.unique(codes[(languages == name)[of]], return_counts=True)

    counted = gathered(fitted, ngrams)
    models = Models(alphabet, {name: KneserNey(codes.astype(np.int64), n, alphabet.bits) for name, (codes, n) in counted.items()})
    names = list(models.by_language)
    if not names:
        return None

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bits, letters in models.entropies(batches, text_col):
            ok = letters > 0
            yield pa.RecordBatch.from_arrays([pa.array(bits.argmin(axis=0)[ok]), pa.array(bits.min(axis=0)[ok])], ["k", "bits"])

    limits = (held_back.select(text_col).mapInArrow(best, "k long, bits double").groupBy("k")
              .agg(F.percentile_approx("bits", REJECT_ABOVE, 10_000).alias("limit")).collect())
    models.limits = {names[r["k"]]: r["limit"] for r in limits}
    return models


def identify(docs: DataFrame, models: Models | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: lang_pred, score (0 to 1), rejected."""
    kind = docs.schema[id_col].dataType.simpleString()
    if models is None:
        return docs.select(id_col, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    names = np.array(list(models.by_language), object)
    limits = np.array([models.limits.get(n, np.inf) for n in names])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bits, letters in models.entropies(batches, text_col):
            k, least = bits.argmin(axis=0), bits.min(axis=0)
            none = letters == 0
            with np.errstate(invalid="ignore"):
                score = 1.0 / np.exp2(-SHARPNESS * (bits - least)).sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [rows.column(id_col), pa.array(np.where(none, UNKNOWN, names[k]), pa.string()),
                 pa.array(np.where(none, 0.0, score)), pa.array(none | (least > limits[k]))],
                [id_col, "lang_pred", "score", "rejected"])

    return docs.select(id_col, text_col).mapInArrow(predict, f"{id_col} {kind}, lang_pred string, score double, rejected boolean")
