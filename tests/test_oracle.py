"""Every named query against its SQL oracle in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from caselore.plans.oracle import oracles
from caselore.plans.queries import QUERIES
from tests.conftest import SMALL

ORACLES = oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


#: Iterative ones and measurements; test_communities and test_vector_index hold them against plain implementations.
WITHOUT_SQL = {"communities", "knn_index_recall", "problem_frequency_sketch"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLES)


def sort_key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=sort_key)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=sort_key) == expected
