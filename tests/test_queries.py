"""Every registered query that has SQL, against DuckDB on the same files."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    shown = lambda v: None if pd.isna(v) else str(v) if isinstance(v, (str, bool, pd.Timestamp)) else f"{float(v):.9g}"
    plain = [[shown(v) for v in r] for r in frame.astype(object).to_numpy().tolist()]
    return sorted(plain, key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, data, db, name):
    got, want = entry.queries()[name](spark, data).toPandas(), db.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    kinds = lambda f: {c: f[c].dtype.kind + str(f[c].dtype.itemsize) for c in f.columns if f[c].dtype.kind in "if" and not f[c].isna().any()}
    both = kinds(got).keys() & kinds(want).keys()
    assert {c: kinds(got)[c] for c in both} == {c: kinds(want)[c] for c in both}
    assert rows(got) == rows(want)


def test_every_query_is_known():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry


def test_order_dates_reach_every_order_and_year(spark, data, db):
    got = entry.queries()["order_dates_of_all_years"](spark, data).toPandas()
    n, years = db.sql("SELECT count(*), list_sort(list_distinct(list(year(o_orderdate)))) FROM orders").fetchall()[0]
    assert len(got) == n and sorted(got["y"].unique()) == years and len(years) > 1


def test_parts_of_similar_price_are_all_pairs(spark, tmp_path):
    prices = [100.0, 100.5, 100.50001, 99.75, 100.25, 100.25, 101.0, -0.25, 0.25, -0.0, None, float("nan"), float("nan"), float("inf"), float("-inf"), 1e300, 1e300]
    rows = [(k, size, v) for k, (size, v) in enumerate((size, v) for size in (1, 2, None) for v in prices)]
    spark.createDataFrame(rows, "p_partkey bigint, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    made = entry.queries()["parts_of_similar_price"](spark, str(tmp_path))
    got = sorted(map(tuple, made.select("p_partkey", "near_key").collect()))
    near = lambda v, w: w - 0.5 <= v <= w + 0.5 or (v != v and w != w)
    want = sorted((j, k) for j, s, v in rows for k, t, w in rows if None not in (s, v, w) and s == t and near(v, w))
    assert got == want == sorted(con.sql(entry.oracle_sql()["parts_of_similar_price"]).fetchall())
    assert (0, 1) in got and (0, 2) not in got and (3, 4) in got and (4, 5) in got and (0, 0) in got
    assert "SortMergeJoin" in made._jdf.queryExecution().executedPlan().toString()  # pairs spread by key, however small the table


def test_entry(spark):
    assert entry.entry(spark).count() > 0
