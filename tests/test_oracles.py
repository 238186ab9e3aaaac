"""Every query with oracle SQL matches DuckDB on the smallest scale factor
(the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracles import TABLES, digest

ORACLES = E.oracle_sql()


# a depth-5 tree of recipe 5 learns nothing that lasts from the 750 training rows of the smallest table
LARGER = {"model_check_5": "/root/testdata/sf0.01"}


def connection(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    if name in LARGER:
        sf_dir, con = LARGER[name], connection(LARGER[name])
    df = E.queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns and df.count() > 0
