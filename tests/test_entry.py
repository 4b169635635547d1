"""The driver contract, and every registered query against its DuckDB oracle."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from sheaf.sources.tables import TABLES

from .conftest import SF0001, needs


def _own(names):
    """The keys of the optional subpackage have tests of their own."""
    return {n for n in names if n not in E.EXTRA}


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert _own(q) == _own(o)


@needs(SF0001)
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "product_id", "max_norm_rating"]
    assert len(rows) == 20


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@needs(SF0001)
@pytest.mark.parametrize("key", sorted(_own(E.oracle_sql())))
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF0001).toPandas()
    want = duck.execute(E.oracle_sql()[key]).df()
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
