"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import duckdb
import pytest

from textloom.plans import control_queries, fixture_queries, text_queries  # noqa: F401
from textloom.registry import ALL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if q.sql])
def test_query_equals_its_sql(spark, duck, name):
    got = ALL[name].run(spark, SF)
    expected = duck.sql(ALL[name].sql).to_arrow_table()
    assert sorted(got.columns) == sorted(expected.column_names)
    order = sorted(got.columns)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=repr)
    theirs = sorted((tuple(plain(r[c]) for c in order) for r in expected.to_pylist()), key=repr)
    assert mine == theirs


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if not q.sql])
def test_query_without_sql_runs(spark, name):
    got = ALL[name].run(spark, SF)
    assert got.columns and got.collect() is not None
