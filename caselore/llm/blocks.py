"""Blocks of texts as one byte buffer, with words and substring hashes found by whole-array steps.

Inside a task the texts of an Arrow batch are cut into blocks of about BLOCK_BYTES, so a task holds a few arrays of
that size however many rows a batch has; a longer text is a block of its own. A null text is an empty one.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19


def byte_table(inside: bytes | set[int], invert: bool = False) -> np.ndarray:
    """256 flags: which bytes belong to a class."""
    table = np.zeros(256, bool)
    table[list(inside)] = True
    return ~table if invert else table


#: Words between ASCII white space: [^\x20\x09-\x0D]+
SPACED = byte_table({0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D}, invert=True)
#: Runs of ASCII letters, digits and anything beyond ASCII, after lower-casing A-Z: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = byte_table({*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)})
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def release_memory() -> None:
    """Give freed memory back at the end of a task; idle workers live on, several to an executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


class Block:
    """Consecutive rows of a batch: `data` (uint8), `offsets` (one more than rows) and the rows themselves."""

    def __init__(self, rows: pa.RecordBatch | None, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, keep: np.ndarray) -> Block:
        """The texts at these positions, without the rows."""
        lengths = np.diff(self.offsets)[keep]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        index = np.arange(offsets[-1]) + np.repeat(self.offsets[:-1][keep] - offsets[:-1], lengths)
        return Block(None, self.data[index], offsets)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(total[self.offsets])


def to_block(texts: pa.Array, rows: pa.RecordBatch | None = None) -> Block:
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return Block(rows, data, offsets - offsets[0])


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of the batches in order, cut into blocks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(ends // limit)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield to_block(texts.slice(start, end - start), batch.slice(start, end - start))
        del texts
    release_memory()


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of flagged bytes within a text, and per text the number of the first run (one more at the end)."""
    if not len(is_word):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    before = np.concatenate([[False], is_word[:-1]])
    after = np.concatenate([is_word[1:], [False]])
    borders = offsets[1:-1]
    before[borders[borders < len(is_word)]] = False
    after[borders[borders > 0] - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the data, and per text the number of the first word (one more at the end)."""
    return spans(inside[block.data], block.offsets)


#: The modulus, a Mersenne prime, and two bases without a pattern; with a power of two as modulus ordinary texts collide.
_PRIME = (1 << 31) - 1
_BASES = (0x3C6EF372, 0x5BE0CD19)
_powers: dict[int, np.ndarray] = {}


def _modulo(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    for _ in range(2):
        x = (x & np.uint64(_PRIME)) + (x >> np.uint64(31))
    return np.where(x >= _PRIME, x - np.uint64(_PRIME), x)


def _grown(base: int, n: int) -> np.ndarray:
    """At least n powers of the base modulo the prime."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) < max(n, BLOCK_BYTES + 1):
        known = np.concatenate([known, _modulo(known * np.uint64(pow(base, len(known), _PRIME)))])
    _powers[base] = known
    return known


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that any bits of the result can be used."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """64-bit hashes of substrings of a buffer, from two running sums modulo a prime; equal bytes have equal hashes in any buffer."""

    def __init__(self, data: np.ndarray):
        values = data.astype(np.uint64) + np.uint64(1)
        zero = np.zeros(1, np.uint64)
        self.sums = [np.concatenate([zero, np.cumsum(_modulo(values * _grown(base, len(data))[:len(data)]))]) for base in _BASES]

    def _of(self, totals: list[np.ndarray], starts: np.ndarray | slice, lengths: np.ndarray) -> np.ndarray:
        inverses = [_grown(pow(base, -1, _PRIME), len(self.sums[0]))[starts] for base in _BASES]
        one, other = (_modulo(_modulo(x) * inverse) for x, inverse in zip(totals, inverses, strict=True))
        return mixed(mixed((one << np.uint64(31)) | other) + lengths)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._of([x[ends] - x[starts] for x in self.sums], starts, (ends - starts).astype(np.uint64))

    def rolling(self, k: int) -> np.ndarray:
        """The hash of the k bytes from every position on."""
        n = max(0, len(self.sums[0]) - k)
        return self._of([x[k:] - x[:n] for x in self.sums], slice(n), np.uint64(k))


def word_of_text(first: np.ndarray) -> np.ndarray:
    """The number of its text for every word, from `first` of words()."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def hash_of(word: str) -> int:
    """The hash of one word, as Hashes gives it."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Hashes(data).of(np.array([0]), np.array([len(data)]))[0])
