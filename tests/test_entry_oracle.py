"""The driver contract and every SQL-checked key against DuckDB on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from quarry.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"
ORACLE = entry_mod.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        r = round(v, 6)
        return "nan" if math.isnan(v) else (0.0 if r == 0 else r)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["hired", "service_branch"]
    assert df.count() > 0


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(entry_mod.queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_key_matches_duckdb(spark, con, key):
    sdf = entry_mod.queries()[key](spark, SF)
    rel = con.sql(ORACLE[key])
    assert {n: SPARK_TO_DUCK.get(t, t) for n, t in sdf.dtypes} == {n: str(t) for n, t in zip(rel.columns, rel.types)}
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in sdf.collect()], sdf.columns) == _canon(res.fetchall(), dcols)
