"""The vector index against brute force."""

import numpy as np
import pytest

from caselore.operators import vector_index as vi
from tests.conftest import SMALL


def plain(vectors, queries, k, skip_self=False):
    out = {}
    for q, a in queries.items():
        scored = []
        for v, b in vectors.items():
            if not (skip_self and v == q):
                length = np.linalg.norm(a) * np.linalg.norm(b)
                scored.append((-round(float(np.dot(a, b) / length), 6) if length else 0.0, v))
        out[q] = [(v, -s) for s, v in sorted(scored)[:k]]
    return out


def rows_of(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def frames(spark, vectors, queries):
    return (spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vectors.items()], "vec_id long, vector array<float>").repartition(3),
            spark.createDataFrame([(k, [float(x) for x in v]) for k, v in queries.items()], "query_id long, vector array<float>"))


def close(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=2e-6)
        clear = {v for v, s in want[q] if s > want[q][-1][1] + 3e-6}
        assert clear <= {v for v, _ in got[q]}


@pytest.mark.parametrize("skip_self", [False, True])
def test_exact_on_clusters(spark, skip_self):
    """Clusters, a cell with a third of all rows, equal vectors, a zero vector and queries that are not in the table."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    vectors = {k: np.float32(centres[k % 12] + 0.2 * rng.normal(size=8)) for k in range(400)}
    vectors |= {k: np.float32(centres[0]) for k in range(400, 600)} | {700: np.zeros(8, np.float32)}
    queries = {k: v for k, v in vectors.items() if k % 50 == 0} | {1000 + k: np.float32(rng.normal(size=8)) for k in range(5)}
    table, asked = frames(spark, vectors, queries)
    index = vi.build_index(table, block_rows=32)
    assert index.blocks.selectExpr("sum(size(ids))").first()[0] == len(vectors)
    assert index.blocks.selectExpr("max(size(ids))").first()[0] <= 200  # equal ids do not occur, so blocks stay near 32
    close(rows_of(vi.nearest(index, asked, 7, probes=2, skip_self=skip_self)), plain(vectors, queries, 7, skip_self))


def test_bound_holds(spark):
    """Blocks that are left out hold nothing better: few probes and one cell each give the same rows as all cells."""
    rng = np.random.default_rng(4)
    vectors = {k: np.float32(rng.normal(size=3)) for k in range(500)}
    table, asked = frames(spark, vectors, {k: vectors[k] for k in range(0, 500, 60)})
    index = vi.build_index(table, cells=40, block_rows=16)
    few, every = (rows_of(vi.nearest(index, asked, 5, probes=p)) for p in (1, 40))
    assert few == every


def test_recall_on_the_tables(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").selectExpr("vec_id", "embedding AS vector")
    index = vi.build_index(table)
    told = vi.recall(index, table.filter("vec_id % 100 = 0").selectExpr("vec_id AS query_id", "vector"), 5, [1, len(index.centres)]).collect()
    assert {r["probes"]: r["recall"] for r in told}[len(index.centres)] == 1.0 and all(r["wanted"] == 5 * r["queries"] for r in told)


def test_few_rows_and_none(spark):
    table, asked = frames(spark, {1: np.ones(2), 2: -np.ones(2)}, {5: np.ones(2)})
    index = vi.build_index(table)
    assert rows_of(vi.nearest(index, asked, 5)) == {5: [(1, 1.0), (2, -1.0)]}
    assert vi.nearest(index, asked.limit(0), 5).count() == 0
    with_nulls = table.unionByName(spark.createDataFrame([(9, None)], "vec_id long, vector array<float>"))
    assert vi.build_index(with_nulls).blocks.selectExpr("sum(size(ids))").first()[0] == 2
    assert vi.nearest(vi.build_index(table.limit(0)), asked, 5).count() == 0
