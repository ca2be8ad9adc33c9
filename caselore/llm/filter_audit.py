"""Filter interaction audit: what each of five filters removes in every order, by a table-driven byte transducer.

The transducer. A byte has one of six classes, the transducer is inside or outside a word, and a table says for
(state, class) what the byte emits: a word begins or ends, a code point, a capital, a symbol. The state after a byte
depends on that byte's class alone, so the emissions of a whole block of texts are one lookup in the table and nothing
is walked byte by byte. The spans of the words go into a hash table for each text that compares their bytes when hashes
meet, so the number of distinct words is exact.

The audit. A document is one number of five bits: the filters that it fails. Filter E (a copy of a text with a smaller id)
compares SHA-256 digests of all texts of the table; only digests with several ids are joined back. All else are counts of
documents by part and those 32 numbers: what a filter removes depends on which filters came before it and not on
their order, so 5 x 16 sums per part give the 120 orders and the Shapley sums.

A null text is empty, a null part is the empty string. A null id is neither smaller nor larger than others, so it is no
copy and makes none, and has no label. A repeated row is one more document; several label rows of an id count as
one that has every mark among them. Equal ids are not smaller, so rows of one id and text are not copies of each other.
An empty table has no parts and gives no rows. Columns are found by their exact names, others play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.llm.blocks import Block, blocks
from caselore.llm.columns import pick
from caselore.session import shared_dir

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 2

_SPACE, _PLAIN, _CAPITAL, _SYMBOL, _LEAD, _MORE = range(6)
_OUTSIDE, _INSIDE = 0, 1
BEGIN, END, POINT, UPPER, SIGN = 1, 2, 4, 8, 16
#: So many spans of a text are put into its table at a time.
_SPANS = 1 << 16


def _classes() -> np.ndarray:
    table = np.full(256, _PLAIN, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = _SPACE
    table[0x41:0x5B] = _CAPITAL
    table[list(b"#$%&*|")] = _SYMBOL
    table[0x80:0xC0] = _MORE
    table[0xC0:] = _LEAD
    return table


#: The class of every byte; the state after a class; what (state, class) emits.
CLASS = _classes()
NEXT = np.array([_OUTSIDE, _INSIDE, _INSIDE, _INSIDE, _INSIDE, _INSIDE], np.uint8)
_OF_CLASS = np.array([POINT, POINT, POINT | UPPER, POINT | SIGN, POINT, 0], np.uint8)
EMIT = np.stack([_OF_CLASS | np.where(NEXT == _INSIDE, BEGIN, 0), _OF_CLASS | np.where(NEXT == _OUTSIDE, END, 0)]).astype(np.uint8)


def _distinct(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> int:
    """How many different byte strings the spans are."""
    table: set[bytes] = set()
    for k in range(0, len(starts), _SPANS):
        table.update([raw[i:j] for i, j in zip(starts[k:k + _SPANS].tolist(), ends[k:k + _SPANS].tolist(), strict=True)])
    return len(table)


def text_counts(block: Block) -> dict[str, np.ndarray]:
    """Per text: n_words, n_distinct (words), n_points (code points), n_capitals, n_symbols."""
    data, offsets = block.data, block.offsets
    classes = CLASS[data]
    states = np.empty(len(data) + 1, np.uint8)
    states[0], states[1:] = _OUTSIDE, NEXT[classes]
    last = states[offsets[1:]] == _INSIDE  # texts that end inside a word
    last &= np.diff(offsets) > 0
    states[offsets] = _OUTSIDE
    out = EMIT[states[:-1], classes]

    def per_text(flag: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(out & flag), offsets))

    starts = np.flatnonzero(out & BEGIN)
    ends = np.sort(np.concatenate([np.flatnonzero(out & END), offsets[1:][last]]))
    first, raw = np.searchsorted(starts, offsets), data.tobytes()
    distinct = [_distinct(raw, starts[i:j], ends[i:j]) for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    return {"n_words": np.diff(first), "n_distinct": np.array(distinct, np.int64), "n_points": per_text(POINT),
            "n_capitals": per_text(UPPER), "n_symbols": per_text(SIGN)}


def failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Bits 0 to 3 for the filters A to D that a text fails."""
    return ((counts["n_words"] < MIN_WORDS).astype(np.int32)
            | (100 * counts["n_distinct"] < MIN_DISTINCT_PERCENT * counts["n_words"]).astype(np.int32) << 1
            | (100 * counts["n_capitals"] > MAX_CAPITAL_PERCENT * counts["n_points"]).astype(np.int32) << 2
            | (counts["n_symbols"] > 0).astype(np.int32) << 3)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per document: id, part, mask (bits 0 to 4 for the filters A to E that it fails)."""
    shared_dir(docs.sparkSession)
    texts = pick(docs, id=id_col, part=part_col, text=text_col).withColumn("part", F.coalesce("part", F.lit("")))
    kind = texts.schema["id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            raw, cuts = memoryview(block.data), block.offsets.tolist()
            digests = [hashlib.sha256(raw[i:j]).digest() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("id"), block.rows.column("part"), pa.array(digests, pa.binary()), pa.array(failed(text_counts(block)))],
                ["id", "part", "digest", "mask"])

    rows = texts.mapInArrow(step, f"id {kind}, part string, digest binary, mask int").checkpoint()
    copied = (rows.groupBy("digest").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
              .filter(F.col("lo") < F.col("hi")).select("digest", "lo"))
    copy = F.when(F.col("id") > F.col("lo"), 1 << 4).otherwise(0)
    return rows.join(copied, "digest", "left").select("id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def _orders() -> list[tuple[str, int, int, int]]:
    """(order, step, number of the step's filter, bits of the filters before it) for all orders."""
    return [("".join(FILTERS[f] for f in order), k + 1, f, sum(1 << g for g in order[:k]))
            for order in permutations(range(len(FILTERS))) for k, f in enumerate(order)]


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    marks = (pick(labels, id=id_col, quality="quality", toxic="toxic").groupBy("id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")))
    tally = (failures(docs, id_col, text_col, part_col).join(marks, "id", "left").groupBy("part", "mask")
             .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    # Every filter against every set of the four others: the 16 sets are numbers with the filter's bit left out.
    cell = tally.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(16 * len(FILTERS) - 1)))).selectExpr(
        "*", "cell div 16 AS filter", "shiftleft(1, int(cell div 16)) AS bit",
        "cell % 16 % shiftleft(1, int(cell div 16)) + shiftleft(shiftright(cell % 16, int(cell div 16)), int(cell div 16) + 1) AS before")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    seen = F.col("mask").bitwiseAND(F.col("before")) != 0
    here = fails & ~seen

    def total(value: str, when) -> F.Column:
        return F.sum(F.when(when, F.col(value)).otherwise(0))

    sums = cell.groupBy("part", F.col("filter").cast("int").alias("filter"), F.col("before").cast("int").alias("before")).agg(
        total("n", ~fails & ~seen).alias("kept"), total("n", here).alias("removed"), total("n", fails & seen).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"), total("good", here).alias("good_lost"),
        total("bad", here).alias("toxic_lost"))
    # In 24, 6, 4, 6 or 24 of the 120 orders exactly these filters, 0 to 4 of them, stand before the filter.
    orders_so = F.element_at(F.array(*[F.lit(x) for x in (24, 6, 4, 6, 24)]), F.bit_count("before") + 1)
    shapley = F.sum(F.col("removed") * orders_so).over(Window.partitionBy("part", "filter"))
    places = spark.createDataFrame(_orders(), "filter_order string, step int, filter int, before int")  # 600 rows
    return (sums.withColumn("shapley", shapley).join(F.broadcast(places), ["filter", "before"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
