"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver does the same at sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from refinery.oracle import ORACLE
from refinery.registry import QUERIES
from tests.conftest import SMALL_SF

TABLES = ["lineitem", "orders"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


# Spark type -> DuckDB type of the same values.
TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL_SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, srows) == _canon(ocols, res.fetchall())
    rel = con.sql(ORACLE[name])
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == otypes


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "parent_asin"
