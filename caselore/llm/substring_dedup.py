"""Substring dedup by level-wise doubling: word windows repeated at one length alone are extended to twice that length.

Names. A word has two names of 64 bits: mixes of its bytes, or the halves of its XXH3-128 if it has more than 16; the name of a window is a mix, not linear, of the names of two
shorter windows that cover it, so lengths go 1, 2, 4, 7, 13 and on to 26, 52, ... and every step costs one operation per word.

Level 7 (half the window, rounded up). Of the seeds in a window of 13 words the one with the least name is its anchor;
neighbouring windows share it, so about a quarter of the words start a row. Names of anchors are counted alone, as
(name, least and greatest id); those of a single document are gone. The others make a bit set of bounded size that
the tasks look their anchors up in, so that only runs (windows with one anchor) that may be repeated are shuffled, and an
exact join follows.
Level 13. Where all runs of an anchor are the same, all of their windows are repeated. Else equal runs are
settled together, and what is left is compared window by window. A window is known by the name of its anchor
and its own, from different halves, 128 bits in all.
Levels 26, 52, ... Windows inside the repeated stretches are extended, a level at a time, until none is left that two documents
share. Of the places where a window of L words may begin only the anchors of L / 2 places are taken, so that all
levels together cost less than the first; a stretch of 1.5 L shared words is found at level L at the latest. The result is the
column `longest`: words of the longest doubled window of a document that another document has too.

A window is `repeated` if documents of different ids have it, and `late` if one of a smaller id has it; late words go. Ids may be
of any type that can be ordered. A null id is neither smaller nor larger than others: such rows stay whole and make no
copies. Rows of one id are one document: no copies of each other, but all of them lose what a smaller id has. A null text is
empty; texts shorter than a window have no windows and stay whole. An empty table gives no rows. Only the id and the
text are read, found by their exact names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselore.llm.blocks import SPACED, Block, blocks, mixed, word_of_text, words
from caselore.llm.columns import pick
from caselore.session import freed_shuffles, scratch_path

WINDOW = 13
#: The bit set of repeated anchors has 16 bits for each and never more than this (32 MB).
MAX_BITS = 1 << 28


def _lengths(window: int) -> list[int]:
    """1, 2, ..., window; each at most twice the one before."""
    out = [window]
    while out[0] > 1:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _paired(left: np.ndarray, right: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    return mixed(mixed(left + np.asarray(salt, np.uint64)) + right * np.uint64(0x9E3779B97F4A7C15))


def _leading(eights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first so many of 8 bytes (at most all) as a number, the others as zeros."""
    unused = np.uint64(8) * (8 - np.clip(sizes, 1, 8)).astype(np.uint64)
    return np.where(sizes > 0, eights.view("<u8").ravel() & (np.uint64(0xFFFFFFFFFFFFFFFF) >> unused), np.uint64(0))


def extended(names: np.ndarray, have: int, want: int) -> np.ndarray:
    """Names of the windows of `want` words from those of `have`, have <= want <= 2 * have."""
    if have == want:
        return names
    n = max(0, len(names) + have - want)
    return _paired(names[:n], names[want - have:want - have + n], want)


def word_names(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and one more, two names of every word)."""
    starts, ends, first = words(block, SPACED)
    sizes = ends - starts
    padded = np.concatenate([block.data, np.zeros(16, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded[:-7].view(), (len(padded) - 7, 8), (1, 1))
    low, high = (_leading(eights[starts + 8 * k], sizes - 8 * k) for k in (0, 1))
    salt = sizes.astype(np.uint64)
    a, b = _paired(low, high, salt), _paired(high, low, ~salt)
    for k in np.flatnonzero(sizes > 16).tolist():
        a[k], b[k] = np.frombuffer(xxhash.xxh3_128_digest(block.data[starts[k]:ends[k]].tobytes()), np.uint64)
    return starts, ends, first, a, b


def anchors(names: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of every `width` names in a row (the first of equals)."""
    n = len(names) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(24, len(names).bit_length()))
    keys = (names >> bits << bits) | np.arange(len(names), dtype=np.uint64)
    # Minima to the left and to the right of the borders between stretches of `width`.
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    grid = padded.reshape(-1, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:n], before[width - 1:width - 1 + n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class Runs:
    """The runs of a block: windows in a row, of one text, with one anchor."""

    def __init__(self, block: Block, window: int):
        _, _, self.first, a, b = word_names(block)
        lengths = _lengths(window)
        for have, want in zip(lengths[:-2], lengths[1:-1], strict=True):
            a = extended(a, have, want)
        for have, want in zip(lengths[:-1], lengths[1:], strict=True):
            b = extended(b, have, want)
        seed = lengths[-2]
        place = anchors(a, window - seed + 1)
        per_text = np.maximum(np.diff(self.first) - window + 1, 0)
        at = np.arange(per_text.sum()) + np.repeat(self.first[:-1] - (np.cumsum(per_text) - per_text), per_text)
        text, where = np.repeat(np.arange(len(per_text)), per_text), place[at]
        opens = np.ones(len(at), bool)
        opens[1:] = (where[1:] != where[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(opens)
        self.text, self.low, self.n = text[begin], at[begin], np.diff(np.append(begin, len(at)))
        self.back, self.digit, self.names = where[begin] - self.low, a[where[begin]], b


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, doc=id_col, text=text_col).withColumn("mark", F.xxhash64("text"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, survives lost executors, needs no shuffle files any more."""
    path = scratch_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _anchor_ids(texts: DataFrame, window: int) -> DataFrame:
    """The digits of the anchors that documents of different ids have."""
    kind = texts.schema["doc"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            runs = Runs(block, window)
            yield pa.RecordBatch.from_arrays([block.rows.column("doc").take(pa.array(runs.text)), pa.array(runs.digit.view(np.int64))],
                                             ["doc", "digit"])

    found = texts.filter(F.col("doc").isNotNull()).select("doc", "text").mapInArrow(step, f"doc {kind}, digit long")
    return (found.groupBy("digit").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
            .filter(F.col("lo") < F.col("hi")).select("digit"))


def bit_set(spark: SparkSession, digits: DataFrame, max_bits: int = MAX_BITS) -> Broadcast:
    """The digits modulo a power of two as bits, in 64-bit pieces; at most max_bits whatever the number of digits."""
    total = digits.count()
    size = max(1 << 12, min(max_bits, 1 << (16 * total).bit_length()))
    piece = F.shiftrightunsigned(F.col("digit").bitwiseAND(F.lit(size - 1)), 6).alias("piece")
    rows = digits.groupBy(piece).agg(F.bit_or(F.expr("shiftleft(1L, int(digit & 63))")).alias("bits")).toArrow()
    table = np.zeros(size >> 6, np.uint64)
    table[rows["piece"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(table)


def in_bit_set(table: np.ndarray, digits: np.ndarray) -> np.ndarray:
    low = digits & np.uint64((len(table) << 6) - 1)
    return (table[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _candidate_runs(texts: DataFrame, window: int, table: Broadcast) -> DataFrame:
    """(doc, mark, low, back, digit, names of the windows) of the runs whose anchors may be repeated."""
    kind = texts.schema["doc"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            runs = Runs(block, window)
            keep = np.flatnonzero(in_bit_set(table.value, runs.digit))
            text, low, n = runs.text[keep], runs.low[keep], runs.n[keep]
            cuts = np.concatenate([[0], np.cumsum(n)])
            at = np.arange(cuts[-1]) + np.repeat(low - cuts[:-1], n)
            known = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc").take(known), block.rows.column("mark").take(known),
                 pa.array((low - runs.first[text]).astype(np.int32)), pa.array(runs.back[keep].astype(np.int32)),
                 pa.array(runs.digit[keep].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(runs.names[at].view(np.int64)))],
                ["doc", "mark", "low", "back", "digit", "names"])

    return texts.filter(F.col("doc").isNotNull()).select("doc", "mark", "text").mapInArrow(
        step, f"doc {kind}, mark long, low int, back int, digit long, names array<long>")


def _span(end: Column, late: Column) -> list[Column]:
    return [F.col("doc"), F.col("mark"), F.col("low"), end.cast("int").alias("end"), late.alias("late")]


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """(doc, mark, low, end, late): ranges of words of windows that documents of different ids have; they overlap."""
    spark = texts.sparkSession
    digits = _stored(_anchor_ids(texts, window), "anchors")
    runs = _stored(_candidate_runs(texts, window, bit_set(spark, digits)), "runs").withColumn("whole", F.xxhash64("back", "names"))
    # Stored before the join, so that a hot digit can be split there.
    shared = _stored(runs.groupBy("digit").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("whole").alias("one"),
                                               F.max("whole").alias("other"))
                     .filter(F.col("lo") < F.col("hi")).select("digit", "lo", (F.col("one") == F.col("other")).alias("same")), "shared")
    # Anchor and names of a run are kept only as long as something is compared by them.
    open_ = [F.when(~F.col("same"), F.col(k)).alias(k) for k in ("digit", "whole", "names")]
    known = _stored(runs.join(shared, "digit").select("doc", "mark", "low", F.size("names").alias("n"), "lo", "same", *open_), "known")
    last = F.col("low") + F.col("n") - 1 + window
    settled = known.filter("same").select(*_span(last, F.col("doc") > F.col("lo")))
    # Runs that share their anchor only: equal ones are settled together, by the least id that has them.
    mixed_ = known.filter(~F.col("same")).drop("lo", "same")
    classes = _stored(mixed_.groupBy("digit", "whole").agg(F.min("doc").alias("lo")), "classes")
    first = F.when(F.col("doc") == F.col("lo"), F.col("names")).alias("names")
    mixed_ = _stored(mixed_.join(classes, ["digit", "whole"]).select("doc", "mark", "low", "n", "lo", "digit", "whole", first), "mixed")
    copies = mixed_.filter(F.col("doc") > F.col("lo")).select(*_span(last, F.lit(True)))
    single = (mixed_.filter(F.col("doc") == F.col("lo"))
              .select("doc", "mark", "low", "digit", F.posexplode("names").alias("k", "name"))
              .select("doc", "mark", (F.col("low") + F.col("k")).alias("low"), "digit", "name"))
    # The windows of one run per class and document; those of its copies count as well, as owners of a smaller or larger id.
    several = mixed_.groupBy("digit", "whole").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"),
                                                     F.first("names", ignorenulls=True).alias("names"))
    names = (several.select("digit", "lo", "hi", F.explode("names").alias("name")).groupBy("digit", "name")
             .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter(F.col("lo") < F.col("hi")))
    names = _stored(names, "names")
    found = single.join(names, ["digit", "name"]).select(*_span(F.col("low") + window, F.col("doc") > F.col("lo")))
    return settled.unionByName(copies).unionByName(found)


def _covered(first: np.ndarray, text: np.ndarray, low: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Flags of the words that a range of its text covers."""
    steps = np.zeros(first[-1] + 1, np.int64)
    np.add.at(steps, first[text] + low, 1)
    np.add.at(steps, first[text] + end, -1)
    return np.cumsum(steps[:-1]) > 0


def _kept_texts(block: Block, starts: np.ndarray, ends: np.ndarray, stay: np.ndarray) -> list[bytes]:
    """The words that stay of each text, joined by one space."""
    data = np.where(SPACED[block.data], block.data, np.uint8(0x20))
    # A word goes with the byte after it, a space now, unless its text ends there.
    inside = np.ones(len(data) + 1, np.int8)
    inside[block.offsets] = 0
    ends = ends[stay]
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts[stay]] = 1
    steps[ends + inside[ends]] -= 1
    flags = np.cumsum(steps[:-1], dtype=np.int8) > 0
    kept, cuts = data[flags].tobytes(), np.concatenate([[0], np.cumsum(block.per_text(flags))]).tolist()
    return [kept[i:j].removesuffix(b" ") for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _level_rows(block: Block, shared: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, text, place, name) of the windows of window * 2 ** level words inside repeated stretches."""
    _, _, first, a, b = word_names(block)
    of = word_of_text(first)
    lengths = _lengths(window)
    for have, want in zip(lengths[:-2], lengths[1:-1], strict=True):
        a = extended(a, have, want)
    for have, want in zip(lengths[:-1], lengths[1:], strict=True):
        b = extended(b, have, want)
    stops = np.flatnonzero(~shared | np.append(of[1:] != of[:-1], True))  # the last word of its stretch, or no word of one
    room = stops[np.searchsorted(stops, np.arange(len(of)))] - np.arange(len(of)) + shared
    level, size = 1, 2 * window
    while len(room) and room.max() >= size:
        b = extended(b, size // 2, size)
        at = np.unique(anchors(a, size // 2))
        at = at[at < len(b)]
        at = at[room[at] >= size]
        yield level, of[at], at - first[of[at]], b[at]
        level, size = level + 1, 2 * size


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                     with_kept: bool = False, extend: bool = True) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256, and if wanted `longest` and the words that are left, joined by one space.

    Without `extend` the doubling ends at the window: longer ones remove no further word.
    """
    texts = _texts(docs, id_col, text_col)
    kind = texts.schema["doc"].dataType.simpleString()
    spans = repeated_windows(texts, window)
    # A span is one number: low, end and, in the last bit, late.
    packed = F.expr("shiftleft(bigint(low), 32) + 2L * end + int(late)")
    spans = _stored((spans if extend else spans.filter("late")).select("doc", "mark", packed.alias("span")), "spans")
    lists = (spans.groupBy("doc", "mark").agg(F.collect_set("span").alias("spans"))
             .withColumnsRenamed({"doc": "doc_", "mark": "mark_"}))
    schema = (f"doc {kind}, mark long, level int, at int, name long, n_words long, n_removed long, kept_sha256 string, kept string, "
              "shares boolean")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "mark", "level", "at", "name", "n_words", "n_removed", "kept_sha256", "kept", "shares"]
        for block in blocks(batches, "text"):
            starts, ends, first = words(block, SPACED)
            lists = block.rows.column("spans")
            text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            span = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            low, end, late = span >> 32, (span & 0xFFFFFFFF) >> 1, span & 1 != 0
            gone = _covered(first, text[late], low[late], end[late])
            per_text, before = np.diff(first), np.concatenate([[0], np.cumsum(gone)])
            found = [(n, m, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if with_kept else None, some > 0)
                     for n, m, kept, some in zip(per_text.tolist(), np.diff(before[first]).tolist(), _kept_texts(block, starts, ends, ~gone),
                                                 np.diff(lists.offsets.to_numpy()).tolist(), strict=True)]
            n = len(block)
            rows = [block.rows.column("doc"), block.rows.column("mark"), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows + [pa.array(x, t) for x, t in zip(
                zip(*found, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()), strict=True)], names)
            some = np.unique(text)
            if not extend or not len(some):
                continue
            shared = _covered(first, text, low, end)
            shared = shared[np.isin(word_of_text(first), some)]
            for level, which, at, name in _level_rows(block.take(some), shared, window):
                known, m = pa.array(some[which]), len(at)
                yield pa.RecordBatch.from_arrays(
                    [block.rows.column("doc").take(known), block.rows.column("mark").take(known), pa.array(np.full(m, level, np.int32)),
                     pa.array(at.astype(np.int32)), pa.array(name.view(np.int64)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                     pa.nulls(m, pa.string()), pa.nulls(m, pa.string()), pa.nulls(m, pa.bool_())], names)

    joined = (texts.join(lists, texts["doc"].eqNullSafe(lists["doc_"]) & (texts["mark"] == lists["mark_"]), "left")
              .select("doc", "mark", "text", F.coalesce("spans", F.array().cast(lists.schema["spans"].dataType)).alias("spans")))
    out = joined.mapInArrow(step, schema)
    if not extend:
        return out.select(F.col("doc").alias(id_col), "n_words", "n_removed", "kept_sha256", *["kept"] * with_kept)
    # a folder per level: each level of the doubling reads its own rows only
    path = scratch_path(docs.sparkSession, "levels")
    with freed_shuffles(docs.sparkSession):
        out.write.partitionBy("level").parquet(path)
    out = docs.sparkSession.read.schema(out.schema).parquet(path)
    longest = (_extend(out.filter("level > 0").select("doc", "mark", "level", "at", "name"), window)
               .groupBy("doc", "mark").agg(F.max("longest").alias("longest")).withColumnsRenamed({"doc": "doc_", "mark": "mark_"}))
    rows = out.filter("level = 0")
    return (rows.join(longest, rows["doc"].eqNullSafe(longest["doc_"]) & (rows["mark"] == longest["mark_"]), "left")
            .select(F.col("doc").alias(id_col), "n_words", "n_removed", "kept_sha256",
                    F.coalesce("longest", F.when(F.col("shares"), F.lit(window)).otherwise(0).cast("long")).alias("longest"),
                    *["kept"] * with_kept))


def _extend(rows: DataFrame, window: int) -> DataFrame:
    """(doc, mark, longest) for each level at which windows are left that documents of different ids have."""
    found, alive, level = [], None, 1
    while True:
        now = rows.filter(F.col("level") == level)
        if alive is not None:
            now = _stored(now.join(alive, ["doc", "mark", "at"], "left_semi"), "now")
        # Stored before the join, so that a hot name can be split there.
        several = _stored(now.groupBy("name").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                          .filter(F.col("lo") < F.col("hi")).select("name"), "several")
        alive = _stored(now.join(several, "name", "left_semi").select("doc", "mark", "at"), "alive")
        found.append(alive.select("doc", "mark", F.lit(window << level).cast("long").alias("longest")))
        if alive.isEmpty():
            return reduce(DataFrame.unionByName, found)
        level += 1
