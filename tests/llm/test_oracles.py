"""The queries of this subpackage that SQL can express, against that SQL."""

from __future__ import annotations

import duckdb
import pytest

from sheaf.llm import queries
from tests.conftest import SF001, needs


@needs(SF001)
@pytest.mark.parametrize("name,column,least", [("op9_odd_sketch", "kept", False), ("op12_induced_dedup", "n_removed", 1)])
def test_query_equals_its_sql(spark, name, column, least):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF001)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(want.fetchall())
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == rows
    found = [r[columns.index(column)] for r in rows]
    assert sum(x is False if least is False else x >= least for x in found) > 10
