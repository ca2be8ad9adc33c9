"""Character n-gram counts gathered by Spark, and the language models made from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gathered(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, np.ndarray, np.ndarray]]],
             ) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """{class: (sorted n-gram codes, counts)} from a function that yields (class, codes, counts) per block."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, codes, counts in count(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                ["class", "code", "n"])

    summed = rows.mapInArrow(partial, "class string, code long, n long").groupBy("class", "code").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    names = np.array(found["class"].to_pylist(), object)
    codes, counts = found["code"].to_numpy(), found["n"].to_numpy()
    model = {}
    for name in sorted(set(names)):
        mine = names == name
        order = np.argsort(codes[mine])
        model[name] = (codes[mine][order], counts[mine][order])
    return model


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float = 0.0) -> np.ndarray:
    """values of the wanted keys in a sorted array; `default` for those that are not in it."""
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)
