"""Quality rules as a short-circuit cascade.

The counts that every rule may use (words, symbols, repeated lines and word windows) are taken once per block of
texts. A text that fails the base rules is out. The others pass through the rules one after the other; a rule looks only at the texts
that are still in. The order is set before the run: on a sample every rule is timed and its rejections are counted,
and the rules are sorted by rejections per second. The order changes the cost, never the verdict.

Nulls count as empty texts, which fail the base rules by having no words. Repeated rows get equal results. An empty
table gives no rows. Only the id and the text are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import SPACED, Block, Hashes, blocks, byte_table, mixed, word_of_text, words

SYMBOLS = byte_table(b"#*$%&|<>")
UPPER = byte_table(set(range(0x41, 0x5B)))
LETTER = byte_table({*range(0x41, 0x5B), *range(0x61, 0x7B)})
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: About so many documents are timed to order the rules.
SAMPLE_ROWS = 2000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] = same
    flags[order[:-1]] |= same
    return flags


def base_counts(block: Block) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    data, offsets = block.data, block.offsets
    starts, ends, first = words(block, SPACED)
    of = word_of_text(first)
    n, hashes = len(block), Hashes(data)
    text_key = of.astype(np.uint64) * _C
    hashed = hashes.of(starts, ends)
    # Lines with a word are those that a word is the first of.
    breaks = np.flatnonzero(data == 0x0A)
    line = np.searchsorted(breaks, starts)
    opens = np.ones(len(starts), bool)
    opens[1:] = (line[1:] != line[:-1]) | (of[1:] != of[:-1])
    at, line = of[opens], line[opens]
    begin = np.maximum(offsets[at], np.concatenate([[-1], breaks])[line] + 1)
    end = np.minimum(offsets[at + 1], np.concatenate([breaks, [len(data)]])[line])
    keys = mixed(hashes.of(begin, end) + at.astype(np.uint64) * _C)
    n_lines = np.bincount(at, minlength=n)
    distinct = np.bincount(at[np.unique(keys, return_index=True)[1]], minlength=n)
    # Where keys are equal the bytes decide.
    raw, lines = data.tobytes(), np.searchsorted(at, np.arange(n + 1))
    for k in np.flatnonzero(distinct < n_lines):
        mine = slice(lines[k], lines[k + 1])
        distinct[k] = len({raw[i:j] for i, j in zip(begin[mine].tolist(), end[mine].tolist(), strict=True)})
    # Windows of three words, all of one text.
    window = np.flatnonzero(of[2:] == of[:-2]) if len(of) > 2 else np.zeros(0, np.int64)
    keys = mixed(hashed[window] * _A + hashed[window + 1] * _B + hashed[window + 2] + text_key[window])
    again = window[_repeated(keys)]
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[again + k] = True
    return {
        "n_words": np.diff(first), "word_chars": block.per_text(SPACED[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": block.per_text(SYMBOLS[data]), "n_lines": n_lines, "n_dup_lines": n_lines - distinct,
        "n_repeat_words": np.bincount(of[covered], minlength=n)}


@dataclass(frozen=True)
class Rule:
    """Rejects texts: `reject` gets a block of the texts still in and their counts, and gives a flag for each."""

    name: str
    reject: Callable[[Block, dict[str, np.ndarray]], np.ndarray]


def _shouting(block: Block, counts: dict[str, np.ndarray]) -> np.ndarray:
    return 5 * block.per_text(block.data == 0x21) > counts["n_words"]


def _capitals(block: Block, counts: dict[str, np.ndarray]) -> np.ndarray:
    return 2 * block.per_text(UPPER[block.data]) > block.per_text(LETTER[block.data])


def _stutter(block: Block, counts: dict[str, np.ndarray]) -> np.ndarray:
    starts, ends, first = words(block, SPACED)
    of, hashed = word_of_text(first), Hashes(block.data).of(starts, ends)
    same = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    return 5 * np.bincount(of[1:][same], minlength=len(block)) > counts["n_words"]


RULES = (
    Rule("symbols", lambda block, c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("word_length", lambda block, c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 12 * c["n_words"])),
    Rule("repeated_lines", lambda block, c: 2 * c["n_dup_lines"] > c["n_lines"]),
    Rule("shouting", _shouting),
    Rule("capitals", _capitals),
    Rule("stutter", _stutter),
)


def _base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def cascade(block: Block, counts: dict[str, np.ndarray], alive: np.ndarray, rules: tuple[Rule, ...]) -> np.ndarray:
    """The flags of `alive` without the texts that a rule rejects; each rule sees only what is left."""
    alive = alive.copy()
    for rule in rules:
        at = np.flatnonzero(alive)
        if not len(at):
            break
        alive[at[rule.reject(block.take(at), {k: v[at] for k, v in counts.items()})]] = False
    return alive


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
               id_col: str = "doc_id", text_col: str = "text") -> tuple[Rule, ...]:
    """The rules by rejections per second on about sample_rows documents, chosen by a hash of the id."""
    total = docs.count()
    share = min(1.0, sample_rows / max(1, total))
    sample = docs.select(id_col, text_col).filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            counts = base_counts(block)
            at = np.flatnonzero(~_base_failed(counts))
            block, counts = block.take(at), {k: v[at] for k, v in counts.items()}
            seen = []
            for k, rule in enumerate(rules):
                start = time.perf_counter()
                rejected = int(np.count_nonzero(rule.reject(block, counts)))
                seen.append((k, time.perf_counter() - start, rejected))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*seen, strict=True)], ["rule", "seconds", "rejected"])

    sums = (sample.mapInArrow(measure, "rule long, seconds double, rejected long")
            .groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("n")).collect())
    gain = {r["rule"]: r["n"] / max(r["s"], 1e-9) for r in sums}
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: (-gain.get(k, 0.0), k)))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts, base_failed and kept (passed the base and every rule)."""
    ordered = rule_order(docs, rules, sample_rows, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            counts = base_counts(block)
            failed = _base_failed(counts)
            kept = cascade(block, counts, ~failed, ordered)
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(id_col), *[pa.array(counts[c]) for c in names], pa.array(failed), pa.array(kept)],
                [id_col, *names, "base_failed", "kept"])

    schema = f"{id_col} {kind}, {', '.join(f'{c} long' for c in names)}, base_failed boolean, kept boolean"
    return docs.select(id_col, text_col).mapInArrow(judge, schema)
