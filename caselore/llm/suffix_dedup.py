"""Suffix-array dedup: byte windows that occur more than once, by depth-limited most-significant-digit passes.

All suffixes are ordered only as far as `window` bytes, and only where they can still be equal: groups that are equal
at that depth are exactly the repeated windows. The digits of a suffix are hashes of growing parts of its window.

Pass 1. Its first digit is the hash of an anchor, the 128 bytes inside the window with the smallest hash. Neighbouring
windows share their anchor, so a run of about 140 suffixes is one row, and so are the runs in the next passes. An anchor that occurs once
settles its whole run: nothing in it is repeated. A run that occurs again with all of its bytes is settled too: all
of it is repeated. Rows are counted by (digit), then by (digit, whole run) where the runs of an anchor differ.
Pass 2. Runs that share only the anchor are cut, at fixed distances from it, into parts of 32 windows. The digit of a part
is the hash of the bytes that its windows have in common; parts are settled like runs.
Pass 3. The windows of parts that still share only their digit are compared by the hash of the whole window.

Digits are 64-bit hashes and always used with the hash of the run, part or window, so equality rests on 128 bits but in
pass 3, which compares few windows. A run of which there are many copies is a count; nothing collects a group. Texts are
read three times; passes 2 and 3 and the removal look only at texts that have open rows or spans.

A null text is empty; texts shorter than a window have no windows and stay whole. Rows are known by their id and a hash of the
text, so nulls and repeated ids are rows like any other; a repeated row is a repeat of its windows. Spans are bytes, so
what is left can end inside a character. Ids may be of any type. An empty table gives no rows. Only the id and the text
are read, each from the first column of exactly that name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from caselore.llm.blocks import Block, Hashes, blocks, mixed
from caselore.llm.columns import pick
from caselore.session import shared_dir

WINDOW, ANCHOR, PART = 400, 128, 32
#: Up to so many texts, and places or spans in them, are sent to all tasks (some 40 MB) instead of shuffling the texts.
BROADCAST_TEXTS, BROADCAST_PLACES = 200_000, 600_000
_RUN = "doc long, mark long, low long, n long, back long, digit long, whole long"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` values in a row, from minima to the left and right of each block border."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    grid = padded.reshape(-1, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def _whole(hashes: Hashes, low: np.ndarray, n: np.ndarray, back: np.ndarray, window: int) -> np.ndarray:
    """Hash of all bytes of n windows from `low` on, with their place against the anchor."""
    return mixed(hashes.of(low, low + n - 1 + window) + (n * (window + 1) + back).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def anchored_runs(data: np.ndarray, offsets: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(text, low, n, back, digit, whole) of every run of windows with one anchor; back is anchor - low."""
    hashes = Hashes(data)
    grams = hashes.rolling(anchor)
    bits = np.uint64(max(24, len(grams).bit_length()))
    keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(keys, window - anchor + 1)
    lengths = np.maximum(np.diff(offsets) - window + 1, 0)
    total = np.cumsum(lengths)
    at = np.arange(total[-1] if len(total) else 0) - np.repeat(total - lengths, lengths) + np.repeat(offsets[:-1], lengths)
    where = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    opens = np.ones(len(at), bool)
    opens[1:] = (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(opens)
    low, n, back = at[first], np.diff(np.append(first, len(at))), where[first] - at[first]
    text = np.searchsorted(offsets, low, side="right") - 1
    return text, low, n, back, grams[where[first]], _whole(hashes, low, n, back, window)


def _known(block: Block, text: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The id and the hash of these texts of a block."""
    at = pa.array(text)
    return block.rows.column("doc").take(at), block.rows.column("mark").take(at)


def _batch(doc: pa.Array, mark: pa.Array, low: np.ndarray, n: np.ndarray, back: np.ndarray, digit: np.ndarray,
           whole: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc, mark, *[pa.array(x.astype(np.int64)) for x in (low, n, back)], pa.array(digit.view(np.int64)),
         pa.array(whole.view(np.int64))], ["doc", "mark", "low", "n", "back", "digit", "whole"])


def _runs(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            text, low, n, back, digit, whole = anchored_runs(block.data, block.offsets, window, anchor)
            yield _batch(*_known(block, text), low - block.offsets[text], n, back, digit, whole)

    return texts.mapInArrow(step, _RUN)


def _settled(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans that are repeated, one row of each class of runs that still shares only its digit with others)."""
    digits = (runs.groupBy("digit").agg(F.count("*").alias("copies"), F.min("whole").alias("lo"), F.max("whole").alias("hi"))
              .filter(F.col("copies") > 1).select("digit", (F.col("lo") != F.col("hi")).alias("open"))).checkpoint()
    shared = runs.join(digits, "digit").checkpoint()
    mixed_ = shared.filter("open")
    place = F.struct("doc", "mark", "low", "n", "back")
    classes = mixed_.groupBy("digit", "whole").agg(F.count("*").alias("copies"), F.min(place).alias("p")).checkpoint()
    several = classes.filter(F.col("copies") > 1).select("digit", "whole")
    spans = (shared.filter(~F.col("open")).select("doc", "mark", "low", "n")
             .unionByName(mixed_.join(several, ["digit", "whole"], "left_semi").select("doc", "mark", "low", "n")))
    return spans, classes.select("p.*", "digit")


def _with_texts(texts: DataFrame, rows: DataFrame, places: str, how: str = "inner") -> DataFrame:
    """Texts joined to rows that have (doc, mark) and a list of places; ids may be null."""
    n, total = rows.agg(F.count("*"), F.sum(F.size(places))).first()
    small = n <= BROADCAST_TEXTS and (total or 0) <= BROADCAST_PLACES
    rows = rows.withColumnsRenamed({"doc": "doc_", "mark": "mark_"})
    on = texts["doc"].eqNullSafe(rows["doc_"]) & (texts["mark"] == rows["mark_"])
    return texts.join(F.broadcast(rows) if small else rows, on, how).drop("doc_", "mark_")


def _places(rows: DataFrame) -> DataFrame:
    """The open rows of each text in one; a text has fewer of them than bytes."""
    return rows.groupBy("doc", "mark").agg(F.collect_list(F.struct("low", "n", "back", "digit")).alias("open")).checkpoint()


def _listed(lists: pa.ListArray) -> tuple[np.ndarray, ...]:
    """The number of its list for every entry, and the fields of the entries."""
    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return of, *(x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())


def _cut_up(texts: DataFrame, rows: DataFrame, window: int, part: int) -> DataFrame:
    """Runs in parts of `part` windows, counted from the anchor; the digit is what the windows of a part share."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            text, low, n, back, digit = _listed(block.rows.column("open"))
            base = block.offsets[text]
            anchor = base + low + back
            # Windows start back, back - 1, ... bytes before the anchor; the part with the number q holds distances
            # q * part to q * part + part - 1.
            near, far = back - n + 1, back
            first, last = near // part, far // part
            count = last - first + 1
            row = np.repeat(np.arange(len(low)), count)
            q = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = np.maximum(anchor[row] - np.minimum(far[row], q * part + part - 1), 0)
            stop = anchor[row] - np.maximum(near[row], q * part)
            number = stop - start + 1
            hashes = Hashes(block.data)
            core = anchor[row] - q * part
            shared = mixed(hashes.of(core, core - part + 1 + window) ^ mixed(digit[row].view(np.uint64) + q.astype(np.uint64)))
            whole = _whole(hashes, start, number, anchor[row] - start, window)
            yield _batch(*_known(block, text[row]), start - base[row], number, anchor[row] - start, shared, whole)

    return _with_texts(texts, _places(rows), "open").select("doc", "mark", "text", "open").mapInArrow(step, _RUN)


def _windows(texts: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """Every window of open parts, with the hash of all of it."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            text, low, n, _, digit = _listed(block.rows.column("open"))
            row = np.repeat(np.arange(len(low)), n)
            start = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = block.offsets[text[row]] + start
            whole = mixed(Hashes(block.data).of(at, at + window) ^ mixed(digit[row].view(np.uint64)))
            yield pa.RecordBatch.from_arrays([*_known(block, text[row]), pa.array(start), pa.array(whole.view(np.int64))],
                                             ["doc", "mark", "low", "whole"])

    return (_with_texts(texts, _places(rows), "open").select("doc", "mark", "text", "open")
            .mapInArrow(step, "doc long, mark long, low long, whole long"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, mark, spans): the maximal byte ranges [low, end) of repeated windows of a text; mark hashes the text."""
    shared_dir(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    anchor, part = min(ANCHOR, -(-window // 3)), min(PART, -(-window // 4))
    spans, open_runs = _settled(_runs(texts, window, anchor).checkpoint())
    more, open_parts = _settled(_cut_up(texts, open_runs, window, part).checkpoint())
    windows = _windows(texts, open_parts, window).checkpoint()
    twice = windows.groupBy("whole").count().filter(F.col("count") > 1).select("whole")
    single = windows.join(twice, "whole", "left_semi").select("doc", "mark", "low", F.lit(1).cast("long").alias("n"))
    every = spans.unionByName(more).unionByName(single)
    lists = every.groupBy("doc", "mark").agg(F.collect_set(F.struct("low", (F.col("low") + F.col("n") - 1 + window).alias("end"))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, low, end = _listed(batch.column("spans"))
            # Texts one after the other on one line, with room between them.
            stride = int(end.max()) + 2 if len(end) else 1
            low, end = merged(low + of * stride, end + of * stride)
            of = low // stride
            values = pa.StructArray.from_arrays([pa.array(low - of * stride), pa.array(end - of * stride)], ["low", "end"])
            offsets = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.ListArray.from_arrays(pa.array(offsets), values)],
                                             ["doc", "mark", "spans"])

    return lists.mapInArrow(merge, "doc long, mark long, spans array<struct<low: long, end: long>>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc is the id, or a hash of it where ids are no whole numbers: two rows that share it and the hash of the text only
    share their spans."""
    texts = pick(docs, id=id_col, text=text_col)
    whole = isinstance(texts.schema["id"].dataType, IntegralType)
    doc = F.col("id").cast("long") if whole else F.when(F.col("id").isNotNull(), F.xxhash64("id"))
    return texts.select(doc.alias("doc"), F.xxhash64("text").alias("mark"), "text", "id")


def merged(low: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ranges that overlap or touch."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(end[order])
    opens = np.ones(len(low), bool)
    opens[1:] = low[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    return low[first], reach[np.append(first[1:], len(low)) - 1]


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   with_kept: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the bytes that are left."""
    texts = _texts(docs, id_col, text_col)
    spans = repeated_spans(docs, window, id_col=id_col, text_col=text_col).checkpoint()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            raw, found = block.data.tobytes(), []
            for k, ranges in enumerate(block.rows.column("spans")):
                start, stop = int(block.offsets[k]), int(block.offsets[k + 1])
                parts, at, n = [], start, 0
                if ranges.is_valid and len(ranges.values):
                    low, end = (x.to_numpy(zero_copy_only=False) for x in ranges.values.flatten())
                    n = len(low)
                    for i, j in zip(low.tolist(), end.tolist(), strict=True):
                        parts.append(raw[at:start + i])
                        at = start + j
                parts.append(raw[at:stop])
                kept = b"".join(parts)
                found.append((stop - start, stop - start - len(kept), n, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            columns = list(zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("id"), *[pa.array(c, t) for c, t in
                                             zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = (_with_texts(texts, spans, "spans", "left").select("id", "text", "spans")
           .mapInArrow(step, f"`{id_col}` {texts.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
    return out if with_kept else out.drop("kept")
