"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from ortholake.registry import ORACLE as REGISTERED_SQL
from ortholake.registry import QUERIES as REGISTERED
from tools.oracle_check import TABLES, rows_key

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = dict(REGISTERED), dict(REGISTERED_SQL)      # the training-data queries have their own tests


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_sequences"] > 0


def test_every_query_has_oracle_or_is_iterative():
    assert set(QUERIES) - set(ORACLE) == {"table_preview"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_key(cols, srows) == rows_key(ocols, orows)
