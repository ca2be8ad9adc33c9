"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by naive Bayes log-count ratios.

The indicators of a text are its words and word pairs, and the n-grams (1 to 3) of word shapes: a word's letters are
collapsed to runs of lower case, capitals and digits, other characters stay, and a word equal to the one before it is
a shape of its own. They are hashed to 2^18 places. The log-count ratio of a place compares in how many good and bad
texts it occurs (smoothed by one). Texts are indicator vectors times these ratios, scaled to length 1; the weights are
fitted by dual coordinate descent with both classes weighing the same. A logistic curve fitted to decisions of models
that did not see the text turns a decision into a score from 0 to 1.

Everything is fitted on a bounded sample of labelled rows: about fit_rows / 2 of each class, by a hash of the id. Only
id and label of the sample are sent to the tasks, and only its indicators to the driver. All texts are scored, whole.

A null label counts as none. A null text is an empty one; empty texts have no indicators and get the score of the
intercept alone. Rows of an id with several labels count once each. Repeated rows get equal scores. With no labels, or
labels of one class only, every score is the share of good labels (1 if there are none). An empty table gives no rows.
Only the id and the text are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import SPACED, Block, Hashes, blocks, mixed, word_of_text, words

PLACES = 1 << 18
FIT_ROWS = 8000
EPOCHS = 12
COST = 1.0
THRESHOLD = 0.7

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def indicators(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(places, offsets): the distinct places of each text in order."""
    starts, ends, first = words(block, SPACED)
    of, n = word_of_text(first), len(block)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    word = Hashes(block.data).of(starts, ends)
    shapes = _SHAPE[block.data]
    keep = np.ones(len(shapes), bool)
    keep[1:] = shapes[1:] != shapes[:-1]
    keep[starts] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    shape = Hashes(shapes[keep]).of(total[starts], total[ends])
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (of[1:] == of[:-1])
    shape[again] = 1
    keys = [(of, mixed(word)), (of, mixed(shape + _ODD[0]))]
    for series, k in ((word, 2), (shape, 2), (shape, 3)):
        at = np.flatnonzero(of[k - 1:] == of[:len(of) - k + 1]) if len(of) >= k else np.zeros(0, np.int64)
        joined = np.full(len(at), k, np.uint64)
        for j in range(k):
            joined = mixed(joined + series[at + j] * _ODD[j])
        keys.append((of[at], joined))
    merged = np.unique(np.concatenate([o * PLACES + (h % np.uint64(PLACES)).astype(np.int64) for o, h in keys]))
    return merged % PLACES, np.searchsorted(merged, np.arange(n + 1) * PLACES)


class Classifier:
    """weights: of a place, ratio times weight; squares: of the ratios, for the length of a text."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, intercept: float, slope: float, shift: float):
        self.products, self.squares = (ratios * weights).astype(np.float32), np.square(ratios).astype(np.float32)
        self.intercept, self.slope, self.shift = intercept, slope, shift

    def scores(self, places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        def sums(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0.0], np.cumsum(values[places], dtype=np.float64)])[offsets])

        decision = sums(self.products) / np.sqrt(np.maximum(sums(self.squares), 1e-12)) + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * decision + self.shift, -50, 50)))


class Constant:
    """Stands in where there is nothing to learn."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.full(len(offsets) - 1, self.score)


def log_count_ratios(texts: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    def shares(chosen: np.ndarray) -> np.ndarray:
        seen = np.bincount(np.concatenate([texts[i] for i in np.flatnonzero(chosen)]), minlength=PLACES) + 1.0
        return seen / seen.sum()

    return np.log(shares(good) / shares(~good))


def dual_coordinate_descent(vectors: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray,
                            epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-loss linear SVM; vectors are (places, values) of length 1."""
    weights, intercept, alpha = np.zeros(PLACES), 0.0, np.zeros(len(vectors))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(vectors)):
            places, values = vectors[i]
            gradient = signs[i] * (weights[places] @ values + intercept) - 1
            was, alpha[i] = alpha[i], min(max(alpha[i] - gradient / (1.0 + (len(places) > 0)), 0.0), costs[i])
            if alpha[i] != was:
                step = (alpha[i] - was) * signs[i]
                weights[places] += step * values
                intercept += step
    return weights, intercept


def _curve(decisions: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of highest likelihood, with smoothed targets, by Newton steps."""
    n1, n0 = good.sum(), (~good).sum()
    targets = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design, theta = np.stack([decisions, np.ones(len(decisions))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -50, 50)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (targets - p) - 1e-3 * theta)
        theta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(texts: list[np.ndarray], good: np.ndarray, cost: float = COST) -> Classifier | Constant:
    """From the places of each text and its label."""
    if not len(good) or good.all() or not good.any() or min(good.sum(), (~good).sum()) < 2:
        return Constant(float(good.mean()) if len(good) else 1.0)

    def model(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        at = np.flatnonzero(chosen)
        ratios = log_count_ratios([texts[i] for i in at], good[at])
        vectors = []
        for i in at:
            values = ratios[texts[i]]
            vectors.append((texts[i], values / max(np.sqrt(values @ values), 1e-6)))
        share = good[at].mean()
        costs = cost * np.where(good[at], 0.5 / share, 0.5 / (1 - share))
        return ratios, *dual_coordinate_descent(vectors, np.where(good[at], 1.0, -1.0), costs)

    # Decisions for the curve come from two models, each on texts it has not seen; both halves hold both classes.
    half = np.zeros(len(good), bool)
    for side in (good, ~good):
        half[np.flatnonzero(side)[::2]] = True
    decisions = np.zeros(len(good))
    for chosen in (half, ~half):
        ratios, weights, intercept = model(chosen)
        for i in np.flatnonzero(~chosen):
            values = ratios[texts[i]]
            decisions[i] = (weights[texts[i]] @ values) / max(np.sqrt(values @ values), 1e-6) + intercept
    slope, shift = _curve(decisions, good)
    return Classifier(*model(np.ones(len(good), bool)), slope, shift)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Classifier | Constant:
    """A classifier from labelled documents; `labels` has id_col and label_col (1 is good)."""
    rows = labels.select(id_col, (F.col(label_col) == 1).alias("good")).filter(F.col("good").isNotNull() & F.col(id_col).isNotNull())
    counts = {r["good"]: r["count"] for r in rows.groupBy("good").count().collect()}
    share = F.when(F.col("good"), min(1.0, fit_rows / 2 / max(1, counts.get(True, 0)))).otherwise(min(1.0, fit_rows / 2 / max(1, counts.get(False, 0))))
    place = F.pmod(F.xxhash64(F.lit(31), id_col), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(place < share)  # about fit_rows rows, whatever the size of the tables

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            places, offsets = indicators(block)
            each = [places[i:j].astype(np.int32).tobytes() for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(id_col), block.rows.column("good"), pa.array(each, pa.binary())], [id_col, "good", "places"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = (docs.select(id_col, text_col).join(F.broadcast(sample), id_col)
             .mapInArrow(gather, f"{id_col} {kind}, good boolean, places binary").toArrow()
             .sort_by([(id_col, "ascending"), ("good", "ascending"), ("places", "ascending")]))
    texts = [np.frombuffer(b, np.int32) for b in found["places"].to_pylist()]
    good = np.array(found["good"].to_pylist(), bool)
    # The sample has the classes in other shares than the labels; the curve is moved back to the labels' shares.
    classifier = train(texts, good)
    if isinstance(classifier, Classifier):
        odds = np.log(counts[True] / counts[False]) - np.log(good.sum() / (~good).sum())
        classifier.shift += float(odds)
    return classifier


def score(docs: DataFrame, classifier: Classifier | Constant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its score."""
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            yield pa.RecordBatch.from_arrays(
                [block.rows.column(id_col), pa.array(classifier.scores(*indicators(block)))], [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(judge, f"{id_col} {kind}, score double")


def keep_good(docs: DataFrame, classifier: Classifier | Constant, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, with a score of at least the threshold."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            yield block.rows.filter(pa.array(classifier.scores(*indicators(block)) >= threshold))

    return docs.mapInArrow(judge, docs.schema)
