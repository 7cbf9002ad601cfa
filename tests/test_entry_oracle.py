"""Every registered query runs and equals its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert "hr_per_pa_7" in df.columns and df.count() > 0


def test_every_query_has_unique_name_and_oracle_keys_subset():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, srows) == _canon(dcols, drows)
