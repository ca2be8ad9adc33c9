"""SimHash near-duplicates: groups of linked fingerprints, and documents of which one per group stays.

`simhash_components` takes one 64-bit fingerprint per text (the majority of each bit over the hashes of its shingles)
and finds all links within a Hamming distance by the generalised pigeonhole of llm.pigeonhole. Equal fingerprints are
one node, so copies cost a row each and nothing more. `one_per_group` keeps the document of the smallest id of each group.

Null texts are empty ones. Empty texts have fingerprint zero and are linked like any other, so one of them stays. Ids may
be of any type with an order. Rows without an id get the component of their fingerprint, and one_per_group keeps them.
Rows of one id are one document to one_per_group: they go if any of their texts is linked to a smaller id. Empty tables
give no rows. Only the id and the text are read, each from the first column of exactly that name; one_per_group returns
all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselore.llm.blocks import blocks
from caselore.llm.columns import numbered, pick
from caselore.llm.pigeonhole import links
from caselore.llm.shingles import fingerprints, shingle_hashes
from caselore.operators.components import connected_components
from caselore.session import shared_dir

#: Up to so many ids a join sends them to all tasks (16 bytes each) instead of shuffling the texts.
BROADCAST_IDS = 500_000


def simhash(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every document as a long."""
    texts = pick(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            fp = fingerprints(*shingle_hashes(block, shingle))
            yield pa.RecordBatch.from_arrays([block.rows.column("id"), pa.array(fp.view(np.int64))], [id_col, "fp"])

    return texts.mapInArrow(step, f"`{id_col}` {kind}, fp long")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id",
                       text_col: str = "text", **options: int) -> DataFrame:
    """Per document: fp (long) and component_id, the smallest id reachable over links, its own included."""
    shared_dir(docs.sparkSession)
    prints = simhash(docs, shingle, id_col, text_col).checkpoint()
    nodes = prints.groupBy("fp").agg(F.min(id_col).alias("least")).checkpoint()
    edges = links(nodes.select("fp"), distance, **options).checkpoint()
    joined = connected_components(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    group = joined.select(F.col("node").alias("fp"), F.col("component"))
    least = (nodes.join(group, "fp").groupBy("component").agg(F.min("least").alias("component_id")))
    moved = group.join(least, "component").select("fp", "component_id")
    where = nodes.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")).checkpoint()
    return prints.join(where, "fp").select(id_col, "fp", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  **options: int) -> DataFrame:
    """The rows of docs, all columns, without those linked to a document of a smaller id."""
    found = simhash_components(docs, shingle, distance, id_col, text_col, **options)
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone")).distinct().checkpoint()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    rows, place = numbered(docs)
    return rows.join(gone, rows[place(id_col)] == gone["gone"], "left_anti").toDF(*docs.columns)
