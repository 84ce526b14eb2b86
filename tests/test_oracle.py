"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, digest

SF_DIR = os.environ.get("SHELFWISE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_DIR}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    """Only the training-data operators may lack SQL; their own tests hold
    them against brute force."""
    assert set(SQL) <= set(QUERIES)
    assert all(name == "pipeline" or name.startswith("op") for name in set(QUERIES) - set(SQL))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "size", "ROAS", "salesVolume"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    exp_cols, exp = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert digest(got_cols, got) == digest(exp_cols, exp)
