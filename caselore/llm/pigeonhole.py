"""Links between fingerprints within a Hamming distance, by the generalised pigeonhole principle.

The bits are split into partitions with thresholds t that add up to (distance - partitions + 1): two fingerprints
within the distance differ by no more than t bits in at least one of them. Bits that go together in a sample of the data are put
into one partition, so that partitions differ in how selective they are. For each number of partitions, dynamic
programming over the partitions finds the thresholds of the lowest cost: rows probed plus candidate pairs, both
estimated from the sample; a threshold of -1 leaves a partition out.

Every fingerprint is entered under its bits in each partition and probes all values within the threshold. Rows meet by
a shuffle on (partition, value), are compared inside the task as whole arrays, and only a spanning forest of the links
found leaves it, so a dense group costs no more rows than its members. A bucket with many members is not
compared but dealt again: the bits outside its key are split into distance + 1 parts, of which a linked pair agrees in
one, until every bucket is small. That is exact, and no bucket is too large for a task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import release_memory

BITS = 64
#: Members (different fingerprints) of a bucket up to which it is compared in one task.
BUCKET_MEMBERS = 2000
SAMPLE_ROWS = 4000
#: Cost of a probe row (made, shuffled, sorted) against that of comparing one candidate pair.
PROBE_COST = 40.0
PAIR_BLOCK = 1 << 21


def _columns(sample: np.ndarray) -> np.ndarray:
    return ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


def grouped_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in `parts` groups of about equal size; each group gathers the bits most correlated with it."""
    bits = _columns(sample)
    bits = bits - bits.mean(axis=0) if len(bits) else np.zeros((1, BITS))
    scale = np.sqrt(np.square(bits).sum(axis=0))
    strength = np.abs(bits.T @ bits) / np.maximum(np.outer(scale, scale), 1e-12)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        first = max(left, key=lambda b: (strength[b, list(left)].sum(), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            nearest = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allocate(groups: list[list[int]], sample: np.ndarray, rows: int, distance: int) -> tuple[float, list[int]]:
    """(cost, threshold of each group) by dynamic programming over the groups and the sum of thresholds + 1."""
    some = sample[:1500]
    left, right = np.triu_indices(len(some), 1)
    costs = []
    for group in groups:
        apart = np.bitwise_count((some[left] ^ some[right]) & np.uint64(mask_of(group))) if len(left) else np.zeros(0)
        line = [0.0]
        for t in range(distance + 1):
            ball = sum(math.comb(len(group), d) for d in range(t + 1))
            seen = np.count_nonzero(apart <= t) / len(apart) if len(apart) else 0.0
            line.append(PROBE_COST * rows * ball + max(seen, ball / 2 ** len(group)) * rows * rows / 2)
        costs.append(line)
    best = {0: (0.0, [])}
    for line in costs:  # index 0 is a threshold of -1
        best = {total: min((cost + line[x], [*chosen, x - 1]) for x in range(len(line)) if (total - x) in best
                           for cost, chosen in [best[total - x]])
                for total in range(distance + 2) if any(total - x in best for x in range(len(line)))}
    return best[distance + 1]


def plan(sample: np.ndarray, rows: int, distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of every partition in use."""
    found = []
    for parts in range(1, distance + 2):
        groups = grouped_bits(sample, parts)
        cost, thresholds = allocate(groups, sample, rows, distance)
        found.append((cost, [(mask_of(g), t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def flips(mask: int, threshold: int) -> list[int]:
    """All ways to flip up to `threshold` bits of a mask, none first."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    return [sum(1 << b for b in chosen) for d in range(threshold + 1) for chosen in itertools.combinations(bits, d)]


def split(mask: int, parts: int) -> list[int]:
    """The bits outside of a mask in so many parts."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask_of(free[k::parts]) for k in range(parts)]


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest number reachable from each of 0..n-1 over the edges (u, v)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same nodes as (a, b), one per node and no more."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = local_roots(at[:len(a)], at[len(a):], len(nodes))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that the rows of a key are never parted."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        if not len(columns[0]):
            continue
        at = [batch.schema.names.index(k) for k in keys]
        same = np.ones(len(columns[0]), bool)
        for k in at:
            same &= columns[k] == columns[k][-1]
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield [c[:cut] for c in columns]
        rest = [c[cut:] for c in columns]
    if rest is not None and len(rest[0]):
        yield rest


def _compared(distance: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, key, member, fp in whole_groups(batches, ["path", "key"]):
            fp = fp.view(np.uint64)
            opens = np.ones(len(key), bool)
            opens[1:] = (key[1:] != key[:-1]) | (path[1:] != path[:-1])
            at = np.flatnonzero(opens)
            group = np.cumsum(opens) - 1
            members = np.add.reduceat(member.astype(np.int64), at)  # they come first in their bucket
            partners = members[group]
            found_a, found_b = [], []
            ends = np.cumsum(partners)
            start = 0
            while start < len(ends):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIR_BLOCK, "right")))
                n = partners[start:stop]
                left = np.repeat(np.arange(start, stop), n)
                right = np.repeat(at[group[start:stop]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
                near = (np.bitwise_count(fp[left] ^ fp[right]) <= distance) & (fp[left] != fp[right])
                found = _forest(fp[left[near]], fp[right[near]])
                found_a.append(found[0])
                found_b.append(found[1])
                start = stop
            a, b = _forest(np.concatenate(found_a), np.concatenate(found_b))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
        release_memory()

    return step


def _dealt_again(distance: int):
    """Rows of large buckets, each under its key and one of the parts of the bits outside of it."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, key, member, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for mask in np.unique(path):
                mine = path == mask
                for part in split(int(mask) % (1 << BITS), distance + 1) if mask != -1 else ():
                    part = np.int64(signed(part))
                    columns = (np.full(mine.sum(), mask | part), key[mine] | (fp[mine] & part), member[mine], fp[mine])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["path", "key", "member", "fp"])

    return step


def links(fps: DataFrame, distance: int = 3, bucket_members: int = BUCKET_MEMBERS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(a, b): pairs of linked fingerprints that connect all that links connect; fps has a column fp (long), distinct."""
    rows = fps.count()
    if rows < 2:
        return fps.sparkSession.createDataFrame([], "a long, b long")
    share = min(1.0, sample_rows / max(1, rows))
    sample = fps.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).select("fp").toArrow()
    sampled = np.sort(sample["fp"].to_numpy().astype(np.int64)).view(np.uint64)
    sampled = sampled[np.random.default_rng(1).permutation(len(sampled))]
    chosen = plan(sampled, rows, distance)
    probes = F.array(*[F.struct(F.lit(signed(mask)).alias("path"), F.lit(signed(flip)).alias("flip"))
                       for mask, t in chosen for flip in flips(mask, t)])
    dealt = (fps.select("fp", F.explode(probes).alias("p"))
             .select(F.col("p.path").alias("path"), F.col("fp").bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.path")).alias("key"),
                     (F.col("p.flip") == 0).alias("member"), "fp"))
    found, schema = [], "a long, b long"
    while True:
        large = (dealt.filter("member").groupBy("path", "key").count().filter(F.col("count") > bucket_members)
                 .select("path", "key")).checkpoint()
        some = not large.isEmpty()
        here = dealt.join(large, ["path", "key"], "left_anti") if some else dealt
        found.append(here.repartition("path", "key").sortWithinPartitions("path", "key", F.col("member").desc())
                     .mapInArrow(_compared(distance), schema))
        if not some:
            break
        dealt = (dealt.join(large, ["path", "key"], "left_semi").select("path", "key", "member", "fp").mapInArrow(_dealt_again(distance), "path long, key long, member boolean, fp long")
                 .distinct().checkpoint())
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()
