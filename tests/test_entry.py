from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_names_and_shapes(spark):
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert entry.entry(spark).columns == ["news_id", "attribute_name", "subject_id", "value_id"]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_queries_against_sql(spark, tables, name):
    want = tables.sql(entry.oracle_sql()[name])
    columns = sorted(want.columns)
    rows = lambda data, names: sorted((tuple(r[names.index(c)] for c in columns) for r in data), key=str)
    got = entry.queries()[name](spark, SMALL)
    assert sorted(got.columns) == columns
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)
