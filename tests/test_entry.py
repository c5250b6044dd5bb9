"""The driver's entry points, and every query against its SQL on a small scale."""

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.all_oracles()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    cols = sorted(want.columns)
    df = entry.queries()[name](spark, DATA)
    assert sorted(df.columns) == cols
    rows = sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    at = [want.columns.index(c) for c in cols]
    assert rows == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


# Equal spans of a customer, which the SQL leaves in any order, and spans without an end, which it puts last.
EQUAL = [(k, 1, 1000.0) for k in (3, 5003, 10003)] + [(k, 2, 1000.0) for k in (1, 4, 5004)]
NO_END = [(3, 1, 1000.0), (5003, 1, None), (2, 2, None), (5002, 2, 1000.0), (4, 2, 1000.0)]


@pytest.mark.parametrize("orders, total", [(EQUAL, "o_orderkey"), (EQUAL[::-1], "o_orderkey"), (NO_END, None), (NO_END[::-1], None)])
def test_overlap_of_equal_starts(spark, tmp_path, orders, total):
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    con.sql(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    sql = entry.oracle_sql()["overlap_violations"]
    if total:
        assert sql.count("order by a, b ") == 1
        sql = sql.replace("order by a, b ", f"order by a, b, {total} ")
    cols = ["o_custkey", "o_orderkey", "a", "b", "reach"]
    got = entry.queries()["overlap_violations"](spark, str(tmp_path)).select(*cols).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, con.sql(f"select {', '.join(cols)} from ({sql})").fetchall())) != []
