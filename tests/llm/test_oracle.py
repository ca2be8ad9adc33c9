"""Every query that SQL can express, against its SQL."""

import duckdb
import pytest

from caselore.llm.oracle import ORACLES
from caselore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = connection.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) == len(want)
    key = [c for c in ("doc_id", "epoch", "part", "filter_order", "step") if c in columns]
    got, want = (x[columns].sort_values(key).reset_index(drop=True).astype(object) for x in (got, want))
    assert got.where(got.notna(), None).equals(want.where(want.notna(), None))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
