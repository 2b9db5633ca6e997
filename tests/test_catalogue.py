"""Every catalogue query against its SQL, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([round(float(r[i]), 6) if isinstance(r[i], (int, float)) and not isinstance(r[i], bool) and not (isinstance(r[i], float) and math.isnan(r[i])) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline"])
def test_query(spark, tables, name):
    got = entry.queries()[name](spark, SF)
    want = tables.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical([tuple(r) for r in got.collect()], got.columns) == canonical(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry.entry(spark).columns == ["_id"]


def test_scans_prune_and_push(spark):
    plan = entry.queries()["filter_eq"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_size,25)" in plan and "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
