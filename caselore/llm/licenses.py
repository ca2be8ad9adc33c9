"""Licence scan by a positional index of rare tokens.

Each template is a licence text in words with a mandatory key phrase in it. The index is built once per run from the
document frequencies of all licence words over the whole corpus: every key phrase is entered under its word of highest
IDF, with that word's place in the phrase. A file's words are looked up in the index, so a common word like "license"
opens no posting. Every hit gives a relative position at which the template would lie; it stands if all words of the
key phrase are at their places. Around a verified place the rest of the template is compared word by word, and the
share of equal words is the score (the highest over all places).

A null text is empty: no words, no labels (empty strings), score 0. Phrases never cross documents. Repeated rows get
equal results. An empty table gives no rows. Only the id and the text are read, so other columns, whatever their names,
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import ALNUM, LOWER, Block, Hashes, blocks, hash_of, word_of_text, words


@dataclass(frozen=True)
class Template:
    label: str
    text: str  # lower-case words
    key: str  # mandatory phrase, part of the text
    base: bool = False


#: Phrases that public licences and notices are known by.
TEMPLATES = (
    Template("cc-by", "licensed under cc by", "cc by", True),
    Template("gpl", "licensed under the gnu general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("apache", "licensed under the apache license", "apache license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification",
             "redistribution and use in source and binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("proprietary", "proprietary and confidential", "proprietary and confidential"),
)


def _word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, lower-cased, and the number of the first word of each text."""
    lower = Block(None, LOWER[block.data], block.offsets)
    starts, ends, first = words(lower, ALNUM)
    return Hashes(lower.data).of(starts, ends), first


def _vocabulary(templates: tuple[Template, ...]) -> dict[str, int]:
    return {w: hash_of(w) for w in sorted({w for t in templates for w in t.key.split()})}


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text") -> dict[str, int]:
    """In how many documents each word of a key phrase occurs, over all documents."""
    vocabulary = _vocabulary(templates)
    names = list(vocabulary)
    hashed = np.array([vocabulary[w] for w in names], np.uint64)
    order = np.argsort(hashed)
    table = hashed[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), np.int64)
        for block in blocks(batches, text_col):
            found, first = _word_hashes(block)
            at = np.minimum(np.searchsorted(table, found), len(table) - 1)
            hit = np.flatnonzero(table[at] == found)
            pairs = np.unique(word_of_text(first)[hit] * len(names) + at[hit])
            total += np.bincount(pairs % len(names), minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(order), pa.array(total)], ["word", "df"])

    rows = docs.select(text_col).mapInArrow(count, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).collect()
    return dict.fromkeys(names, 0) | {names[r["word"]]: r["df"] for r in rows}


class Index:
    """Postings under the rarest word of each key phrase: (template, place of the word in the key)."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[str, int]):
        self.templates = templates
        self.texts = [np.array([hash_of(w) for w in t.text.split()], np.uint64) for t in templates]
        self.keys = [np.array([hash_of(w) for w in t.key.split()], np.uint64) for t in templates]
        self.key_at = []
        anchors = []
        for t in templates:
            text, key = t.text.split(), t.key.split()
            self.key_at.append(next(i for i in range(len(text)) if text[i:i + len(key)] == key))
            anchors.append(min(range(len(key)), key=lambda i: (frequency[key[i]], i)))
        entries = sorted((int(self.keys[k][a]), k, a) for k, a in enumerate(anchors))
        self.hashes, at = np.unique(np.array([e[0] for e in entries], np.uint64), return_index=True)
        self.postings = [[e[1:] for e in entries[i:j]] for i, j in zip(at, [*at[1:], len(entries)], strict=True)]

    def places(self, found: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(template, word numbers where its key phrase stands, numbers of their texts)."""
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hits = np.flatnonzero(self.hashes[at] == found)
        of_all = np.searchsorted(first, hits, side="right") - 1
        for entry in np.unique(at[hits]):
            mine = at[hits] == entry
            for template, place in self.postings[entry]:
                key = self.keys[template]
                begin, of = hits[mine] - place, of_all[mine]
                fits = (begin >= first[of]) & (begin + len(key) <= first[of + 1])
                begin, of = begin[fits], of[fits]
                for k in range(len(key)):
                    right = found[begin + k] == key[k]
                    begin, of = begin[right], of[right]
                yield template, begin, of

    def shares(self, template: int, begin: np.ndarray, of: np.ndarray, found: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Share of the template's words that are at their places around each key phrase."""
        text = self.texts[template]
        equal = np.zeros(len(begin), np.int64)
        for k in range(len(text)):
            at = begin - self.key_at[template] + k
            inside = (at >= first[of]) & (at < first[of + 1])
            equal[inside] += found[at[inside]] == text[k]
        return equal / len(text)


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per document: n_words, n_base (places of base phrases), first_word, last_word, base_labels, labels, score."""
    index = Index(templates, document_frequencies(docs, templates, text_col))
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            n = len(block)
            found, first = _word_hashes(block)
            n_base, low, high = np.zeros(n, np.int64), np.full(n, 1 << 62), np.full(n, -1)
            base, labels, score = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
            for k, begin, of in index.places(found, first):
                template = templates[k]
                for d in np.unique(of):
                    labels[d].add(template.label)
                    if template.base:
                        base[d].add(template.label)
                np.maximum.at(score, of, index.shares(k, begin, of, found, first))
                if template.base:
                    np.add.at(n_base, of, 1)
                    np.minimum.at(low, of, begin - first[of])
                    np.maximum.at(high, of, begin - first[of])
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(id_col), pa.array(np.diff(first)), pa.array(n_base), pa.array(low, mask=none),
                 pa.array(high, mask=none), pa.array([",".join(sorted(x)) for x in base], pa.string()),
                 pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score)],
                [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    schema = (f"{id_col} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double")
    return docs.select(id_col, text_col).mapInArrow(scan, schema)
