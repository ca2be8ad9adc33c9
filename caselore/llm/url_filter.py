"""URL filter by a ratio of character language models.

Rules of hosts and paths judge the URLs they fit. The others are judged by two smoothed variable-order Markov models,
one of URLs that rules accept and one of those they reject: a character is predicted from up to four before it, and
each order is interpolated with the next shorter one by Witten-Bell weights. The score is the difference of the two
log-likelihoods per character; its threshold is the one that separates accepted and rejected URLs best.

The models count all URLs that rules judge. For the threshold each of them is scored by models of the other folds, of FOLDS by a
hash of id and URL, so all of them decide and none by models that saw it. Scores are compared at four digits, and Spark counts them
per value, so what reaches the driver is bounded by the alphabet (characters, contexts and score values), not by the rows. A-Z count
as a-z and every digit as 0, so running numbers do not fill the models.

A null or empty URL, or one without ://, has an empty host and path and fits no rule; without a character its score is
0. If one side has no URLs to learn from, URLs without a rule are allowed. Repeated rows get equal verdicts. An empty
table gives no rows. Only the id and the URL are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import LOWER, Block, blocks
from caselore.llm.char_models import gathered, looked_up

ORDER = 5
FOLDS = 5
DIGITS = 4
_CLASSES = LOWER.copy()
_CLASSES[0x30:0x3A] = 0x30


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.coalesce(F.locate("://", url), F.lit(0)) > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(F.locate("://", url), F.lit(0)) > 0, path).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The text of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def _grams(block: Block) -> np.ndarray:
    """Packed bytes of the ORDER characters that end at each one; places before a text are 0."""
    data = _CLASSES[block.data].astype(np.int64)
    age = np.arange(len(data)) - np.repeat(block.offsets[:-1], np.diff(block.offsets))
    packed = data.copy()
    for k in range(1, ORDER):
        before = np.zeros(len(data), np.int64)
        before[k:] = data[:-k]
        before[age < k] = 0
        packed |= before << (8 * k)
    return packed


class Markov:
    """Counts of all orders, with Witten-Bell interpolation."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.levels = []
        for order in range(1, ORDER + 1):
            grams, at = np.unique(codes & ((1 << (8 * order)) - 1), return_inverse=True)
            n = np.bincount(at, counts, len(grams))
            context, at = np.unique(grams >> 8, return_inverse=True)
            total, kinds = np.bincount(at, n, len(context)), np.bincount(at, minlength=len(context))
            self.levels.append((order, grams, n / (total + kinds)[at], context, kinds / (total + kinds)))

    def log(self, wanted: np.ndarray) -> np.ndarray:
        p = np.full(len(wanted), 1.0 / 256)
        for order, grams, share, context, backoff in self.levels:
            now = wanted & ((1 << (8 * order)) - 1)
            p = looked_up(grams, share, now) + looked_up(context, backoff, now >> 8, 1.0) * p
        return np.log(p)


def _ratios(models: dict[str, Markov], block: Block) -> np.ndarray:
    """Log-likelihood difference per character, accepted minus rejected; 0 for an empty URL."""
    codes, at = np.unique(_grams(block), return_inverse=True)
    each = (models["allow"].log(codes) - models["block"].log(codes))[at]
    lengths = np.diff(block.offsets)
    total = np.concatenate([[0.0], np.cumsum(each)])
    return np.diff(total[block.offsets]) / np.maximum(lengths, 1)


def best_threshold(scores: np.ndarray, accepted: np.ndarray, rejected: np.ndarray) -> float:
    """The middle of the gap with the highest mean share of right verdicts on the two sides (>= is accepted).

    scores are distinct, accepted and rejected say how often each occurs.
    """
    order = np.argsort(scores)
    s, a, b = scores[order], accepted[order], rejected[order]
    right = ((a.sum() - np.concatenate([[0], np.cumsum(a)])) / max(1, a.sum())
             + np.concatenate([[0], np.cumsum(b)]) / max(1, b.sum()))
    edges = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    best = np.flatnonzero(right == right.max())
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def _model(tables: list[tuple[np.ndarray, np.ndarray]]) -> Markov:
    codes, at = np.unique(np.concatenate([np.zeros(0, np.int64), *[c for c, _ in tables]]), return_inverse=True)
    return Markov(codes, np.bincount(at, np.concatenate([np.zeros(0, np.int64), *[n for _, n in tables]]), len(codes)))


def fit(judged: DataFrame, id_col: str = "page_id", url_col: str = "url") -> tuple[dict[str, Markov], float] | None:
    """(models, threshold) from all rows with a verdict; None if one side has none."""
    fold = F.pmod(F.xxhash64(F.lit(22), id_col, url_col), F.lit(FOLDS)).cast("string")
    rows = judged.select(url_col, "verdict", F.concat_ws(":", "verdict", fold).alias("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        for block in blocks(batches, url_col):
            parts = np.array(block.rows.column("part").to_pylist(), object)
            grams = _grams(block)
            of = np.repeat(np.arange(len(parts)), np.diff(block.offsets))
            for name in set(parts):
                yield name, *np.unique(grams[(parts == name)[of]], return_counts=True)

    counted = gathered(rows, count)
    sides = {side: {name[-1]: table for name, table in counted.items() if name.startswith(side)} for side in ("allow", "block")}
    if not all(sides.values()):
        return None
    models = {side: _model(list(tables.values())) for side, tables in sides.items()}
    others = {str(k): {side: _model([t for name, t in tables.items() if name != str(k)]) for side, tables in sides.items()}
              for k in range(FOLDS)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, url_col):
            parts = np.array(block.rows.column("part").to_pylist(), object)
            scores = np.zeros(len(block))
            for name in set(parts):
                at = np.flatnonzero(parts == name)
                scores[at] = _ratios(others[name[-1]], block.take(at))
            yield pa.RecordBatch.from_arrays([block.rows.column("verdict"), pa.array(np.round(scores, DIGITS))], ["verdict", "s"])

    found = (rows.mapInArrow(score, "verdict string, s double").groupBy("s")
             .agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")).toArrow())
    return models, best_threshold(*(found[c].to_numpy() for c in ("s", "a", "b")))


def judge(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: host, path, rule (else null), verdict, score (null where a rule decided)."""
    kind = pages.schema[id_col].dataType.simpleString()
    parts = pages.select(id_col, url_col, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    decided = F.lit(None).cast("string")
    for rule in rules:
        decided = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(decided)
    ruled = ruled.withColumn("verdict", decided)
    fitted = fit(ruled.filter(F.col("verdict").isNotNull()).select(id_col, url_col, "verdict"), id_col, url_col)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, url_col):
            rows = block.rows
            verdicts = np.array(rows.column("verdict").to_pylist(), object)
            open_ = np.array([v is None for v in verdicts], bool)
            scores = np.zeros(len(block))
            if fitted is None:
                verdicts[open_] = "allow"
            else:
                scores = _ratios(fitted[0], block)
                verdicts[open_] = np.where(np.round(scores[open_], DIGITS) >= fitted[1], "allow", "block")
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in (id_col, "host", "path", "rule")], pa.array(list(verdicts), pa.string()),
                 pa.array(scores, mask=~open_)], [id_col, "host", "path", "rule", "verdict", "score"])

    return ruled.mapInArrow(decide, f"{id_col} {kind}, host string, path string, rule string, verdict string, score double")
