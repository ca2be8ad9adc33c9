"""Benchmark decontamination with one FM-index per shard of the training texts.

Test items are cut into windows of `window` words; an item with fewer words is one window. A shard is a block of
documents inside a task. Its words become symbols (the words of the items; any other word ends a run, since no window
holds it, and runs shorter than the shortest window are left out, since none fits in them). The FM-index of the runs is
searched backwards for all windows at once, the hits are located by sampled suffix positions and merged into spans.
Documents are read once and never shuffled.

The items are a stated query set: they are taken in blocks of up to PHRASE_WORDS words, each block is one step over the
documents in the same pass.

Null and empty texts have no words and no hits; items without words match nothing; items without an id count for hits,
but are not listed. Repeated rows get equal results; equal items are all listed. Empty tables give no rows, or no hits.
Only the text is read; in the result of `scan` input columns named like DECON_COLUMNS, in any case, are replaced,
`cut` keeps all columns. Their names may be any.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caselore.llm.blocks import ALNUM, LOWER, Block, Hashes, blocks, to_block, word_of_text, words
from caselore.llm.columns import numbered, without
from caselore.llm.fm_index import FMIndex

WINDOW = 10
SHARD_BYTES = 1 << 20
PHRASE_WORDS = 1_000_000
DECON_COLUMNS = ("decon_words", "decon_spans", "decon_items")


def _lowered(block: Block) -> Block:
    return Block(block.rows, LOWER[block.data], block.offsets)


class Phrases:
    """The windows of a block of items as symbols, and the items of each window."""

    def __init__(self, item_ids: list[str | None], texts: list[str | None], window: int):
        block = _lowered(to_block(pa.array([t or "" for t in texts], pa.large_string())))
        starts, ends, first = words(block, ALNUM)
        self.vocabulary, places, symbols = np.unique(Hashes(block.data).of(starts, ends), return_index=True, return_inverse=True)
        raw = block.data.tobytes()
        self.words = [raw[i:j] for i, j in zip(starts[places].tolist(), ends[places].tolist(), strict=True)]
        symbols = symbols.astype(np.int64) + 1
        rows, of = [], []
        for item, (i, j) in enumerate(zip(first[:-1], first[1:], strict=True)):
            for k in range(i, max(i + 1, j - window + 1)) if j > i else ():
                part = symbols[k:min(k + window, j)]
                rows.append(np.concatenate([np.zeros(window - len(part), np.int64), part]))
                of.append(item)
        grid = np.array(rows, np.int64).reshape(len(rows), window)
        self.windows, at = np.unique(grid, axis=0, return_inverse=True)
        self.lengths = np.count_nonzero(self.windows, axis=1)
        pairs = np.unique(np.stack([at.ravel(), np.array(of, np.int64)], axis=1), axis=0) if rows else np.zeros((0, 2), np.int64)
        self.item_of, self.item_at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        self.item_ids = item_ids
        # A small table says for most words that they are in no item, before the sorted search.
        self.mask = np.zeros(1 << 20, bool)
        self.mask[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def symbols(self, hashed: np.ndarray) -> np.ndarray:
        """Symbol of every word, 0 for those in no item."""
        out = np.zeros(len(hashed), np.int64)
        maybe = np.flatnonzero(self.mask[(hashed & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, hashed[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[at] == hashed[maybe], at + 1, 0)
        return out

    def hits(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first word of each text and one more, flag per word, and text and item of every item with an occurring window)."""
        starts, ends, first = words(block, ALNUM)
        return first, *self._found(Hashes(block.data).of(starts, ends), first, block.data, starts, ends)

    def _found(self, hashed: np.ndarray, first: np.ndarray, data: np.ndarray, starts: np.ndarray,
               ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of, flags = word_of_text(first), np.zeros(len(hashed), bool)
        none = flags, np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.windows):
            return none
        symbols = self.symbols(hashed)
        known = np.flatnonzero(symbols)
        opens = np.ones(len(known), bool)
        opens[1:] = (np.diff(known) > 1) | (of[known[1:]] != of[known[:-1]])
        run = np.cumsum(opens) - 1
        known = known[(np.bincount(run) >= self.lengths.min())[run]] if len(known) else known
        # What is in a run is compared on its bytes, so that no hash decides.
        raw = data.tobytes()
        known = known[[raw[i:j] == self.words[k - 1] for i, j, k in zip(
            starts[known].tolist(), ends[known].tolist(), symbols[known].tolist(), strict=True)]] if len(known) else known
        if not len(known):
            return none
        opens = np.ones(len(known), bool)
        opens[1:] = (np.diff(known) > 1) | (of[known[1:]] != of[known[:-1]])
        place = np.arange(len(known)) + np.cumsum(opens) - 1
        text = np.zeros(place[-1] + 2, np.int64)
        text[place] = symbols[known]
        word_at = np.zeros(len(text), np.int64)
        word_at[place] = known
        index = FMIndex(text, len(self.vocabulary))
        low, high = index.search(self.windows, self.lengths)
        counts = high - low
        window = np.repeat(np.arange(len(counts)), counts)
        rows = np.repeat(low, counts) + np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
        word = word_at[index.locate(rows)]
        change = np.zeros(len(hashed) + 1, np.int64)
        np.add.at(change, word, 1)
        np.add.at(change, word + self.lengths[window], -1)
        flags = np.cumsum(change[:-1]) > 0
        pairs = np.unique(of[word] * len(self.windows) + window) if len(word) else np.zeros(0, np.int64)
        doc, window = pairs // len(self.windows), pairs % len(self.windows)
        n = self.item_at[window + 1] - self.item_at[window]
        items = np.repeat(self.item_at[window], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return flags, np.repeat(doc, n), self.item_of[items]


def phrase_blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> list[Phrases]:
    """The items in blocks of about PHRASE_WORDS words."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / (6 * PHRASE_WORDS)))
    found = []
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        found.append(Phrases([r["id"] for r in rows], [r["text"] for r in rows], window))
    return found


def _spans(flags: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per text the runs of flagged words: start and end, one after the other, in words of the text."""
    of = word_of_text(first)
    at = np.flatnonzero(flags)
    opens = np.ones(len(at), bool)
    opens[1:] = (np.diff(at) > 1) | (of[at[1:]] != of[at[:-1]])
    closes = np.concatenate([opens[1:], [True]])[:len(at)]
    doc = of[at[opens]]
    flat = np.stack([at[opens] - first[doc], at[closes] + 1 - first[doc]], axis=1).ravel()
    offsets = 2 * np.searchsorted(doc, np.arange(len(first)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int64)))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
         schema: StructType | None = None) -> DataFrame:
    """All columns of docs with decon_words (how many), decon_spans (flat list of start and end of removal spans, in
    words) and decon_items (ids of the items with occurring windows, as strings, sorted). `finish` is applied to these
    rows in the same pass and gives rows of `schema`."""
    plain, place = numbered(docs)
    kept, text = without(docs, *DECON_COLUMNS), place(text_col)
    names = [f"c{i}" for i in kept]
    out = plain.select(*names, F.lit(None).cast("long").alias("decon_words"),
                      F.array().cast("array<bigint>").alias("decon_spans"), F.array().cast("array<string>").alias("decon_items"))
    steps = phrase_blocks(benchmark, window, item_col, item_text)
    for k, phrases in enumerate(steps):
        last = finish if k == len(steps) - 1 else None

        def step(batches: Iterator[pa.RecordBatch], phrases: Phrases = phrases, last=last) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, text, SHARD_BYTES):
                first, flags, doc, item = phrases.hits(_lowered(block))
                earlier = block.rows.column("decon_spans")
                for d in np.flatnonzero(pc.list_value_length(earlier).to_numpy(zero_copy_only=False)):
                    flat = earlier[int(d)].as_py()
                    for i, j in zip(flat[::2], flat[1::2], strict=True):
                        flags[first[d] + i:first[d] + j] = True
                listed = [set(x or ()) for x in block.rows.column("decon_items").to_pylist()]
                for d, i in zip(doc.tolist(), item.tolist(), strict=True):
                    if phrases.item_ids[i] is not None:
                        listed[d].add(phrases.item_ids[i])
                batch = pa.RecordBatch.from_arrays(
                    [*[block.rows.column(c) for c in names], pa.array(np.diff(first)), _spans(flags, first),
                     pa.array([sorted(x) for x in listed], pa.list_(pa.string()))], [*names, *DECON_COLUMNS])
                yield last(batch) if last else batch

        out = out.mapInArrow(step, schema if last else out.schema)
    return out if finish else out.toDF(*[docs.columns[i] for i in kept], *DECON_COLUMNS)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_words, n_hit, n_items, items_sha256, contaminated from the columns of `scan`."""
    spans = F.col("decon_spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: x - total)  # end - (start - total so far)
    ids = F.concat_ws(",", "decon_items")
    return scanned.select(id_col, F.col("decon_words").alias("n_words"), n_hit.alias("n_hit"),
                          F.size("decon_items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
                          (n_hit > 0).alias("contaminated"))


def without_spans(text: str, spans: list[int]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    data = text.encode()
    block = _lowered(to_block(pa.array([text], pa.large_string())))
    starts, ends, _ = words(block, ALNUM)
    parts, at = [], 0
    for i, j in zip(spans[::2], spans[1::2], strict=True):
        parts.append(data[at:starts[i]])
        at = int(ends[j - 1])
    parts.append(data[at:])
    return b"".join(parts).decode()


def cut(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", chars_col: str = "n_chars",
        **columns: str) -> DataFrame:
    """The rows of docs, all columns, with the removal spans cut out of the text; a document of which no word is left
    goes. chars_col, if there is one, is the length of the new text."""
    plain, place = numbered(docs)
    names, text = plain.columns, place(text_col)
    chars = place(chars_col) if chars_col in docs.columns else None

    def rewrite(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column("decon_spans").to_pylist()
        new = {d: without_spans(batch.column(text)[d].as_py(), s) for d, s in enumerate(spans) if s}
        keep = [not s or sum(s[1::2]) - sum(s[::2]) < n for s, n in zip(spans, batch.column("decon_words").to_pylist(), strict=True)]
        out = {c: batch.column(c) for c in names}
        if new:
            out[text] = pa.array([new.get(d, t) for d, t in enumerate(out[text].to_pylist())], out[text].type)
            if chars:
                out[chars] = pa.array([len(new[d]) if d in new else c for d, c in enumerate(out[chars].to_pylist())], out[chars].type)
        return pa.RecordBatch.from_arrays(list(out.values()), list(out)).filter(pa.array(keep, pa.bool_()))

    return scan(plain, benchmark, window, text, finish=rewrite, schema=plain.schema, **columns).toDF(*docs.columns)
