"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


#: The queries of the optional pipeline operators are tested beside those operators.
OWN = {q for q in entry.queries() if not re.fullmatch(r"op\d+_.*|pipeline", q)}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_name", "disclaimer", "amt_spent", "num_of_ads", "page_id", "date"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert entry.oracle_sql().keys() >= OWN
    assert entry.queries().keys() >= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got, want = df.collect(), res.fetchall()
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    g = sorted((tuple(r[i] for i in order) for r in rows_of(got)), key=repr)
    w = sorted((tuple(r[i] for i in oorder) for r in rows_of(want)), key=repr)
    assert g == w


def test_every_query_names_its_operators():
    assert set(entry.QUERY_OPERATORS) == OWN


def test_first_member_is_exercised_by_a_load():
    assert [q for q, ids in entry.QUERY_OPERATORS.items() if "O1" in ids] == ["archive_lifelong"]
