"""Hashes of word shingles, and SimHash fingerprints from them."""

from __future__ import annotations

import numpy as np
import xxhash

from caselore.llm.blocks import LOWER, SPACED, Block, words

SEED = 42


def shingle_hashes(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle in order, offsets per text).

    A shingle is k words of the text, A-Z lower-cased, joined by one space; a text with fewer words is one shingle, one
    without words has none.
    """
    starts, ends, first = words(block, SPACED)
    n_words = np.diff(first)
    # One space after every word: keep word bytes and the first byte after each word.
    keep = SPACED[block.data]
    after = ends[ends < len(block.data)]
    data = np.where(keep, LOWER[block.data], np.uint8(0x20))
    keep[after] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    buffer = data[keep].tobytes()
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts) + np.repeat(first[:-1], counts)
    last = np.minimum(at + k, np.repeat(first[1:], counts)) - 1
    # The byte after a text's last word may be the next text's; ends are those of the words, so it is never hashed.
    begin, end = total[starts[at]], total[starts[last]] + (ends - starts)[last]
    digest = xxhash.xxh64_digest
    joined = b"".join([digest(buffer[i:j], SEED) for i, j in zip(begin.tolist(), end.tolist(), strict=True)])
    return np.frombuffer(joined, ">u8").astype(np.uint64), offsets


def fingerprints(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A bit is 1 if it is set in over half of a text's hashes; 0 for a text without any."""
    n, full = np.diff(offsets), np.flatnonzero(np.diff(offsets))
    out = np.zeros(len(n), np.uint64)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
        ones = np.add.reduceat(bits, offsets[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > n[full, None], axis=1).view(">u8").ravel()
    return out
