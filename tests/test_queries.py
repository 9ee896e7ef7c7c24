"""Every registered query next to its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for file in os.listdir(ROOT):
        name = file.split(".")[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return int(value) if value == int(value) else round(value, 6)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_against_sql(spark, con, name):
    df = contract.queries()[name](spark, ROOT)
    rel = con.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "ndcg"] and df.count() > 0


def test_nunique_by_joins_once(spark):
    made = contract.queries()["nunique_by"](spark, ROOT)
    # All counts read the stored join; none joins the lines with their orders again.
    assert "l_orderkey" not in made._jdf.queryExecution().toString()
    assert {r["dim"] for r in made.collect()} == {"os", "subdomain", "action_type", "category"}
