"""Every registered query against its DuckDB SQL."""

import pytest

from tilewright.queries import ORACLE_SQL, QUERIES


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(tuple(repr(plain(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(found.fetchall(), found.columns)


#: Queries whose result is empty where all is well.
CHECKS = {"duplicate_keys", "group_conflict", "readback_equal"}


def test_query_results_have_rows(duck):
    import os

    import duckdb

    folder, c = os.environ.get("TEST_SQL_DIR", "/root/testdata/sf0.01"), duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    empty = {n for n, sql in ORACLE_SQL.items() if n not in CHECKS and not c.sql(f"select 1 from ({sql}) limit 1").fetchall()}
    assert not empty


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_spatial_join_is_an_equi_join(spark, sf):
    plan = QUERIES["spatial_join_box"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_pushes_filters_and_prunes(spark, sf):
    plan = QUERIES["scan_parquet"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,30.0)" in plan and "l_extendedprice" not in plan


def _with_orders(spark, folder):
    """Customers 1 to 3 and orders of 1 and 2, none of which is urgent, final or of high priority."""
    spark.range(1, 4).withColumnRenamed("id", "c_custkey").write.parquet(f"{folder}/customer.parquet")
    spark.sql("select id as o_custkey, 'O' as o_orderstatus, '5-LOW' as o_orderpriority from range(1, 3)").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_anti_join_takes_every_order(spark, tmp_path):
    assert [r[0] for r in QUERIES["anti_join"](spark, _with_orders(spark, tmp_path)).collect()] == [3]


def test_set_intersect_takes_every_order(spark, tmp_path):
    assert sorted(r[0] for r in QUERIES["set_intersect"](spark, _with_orders(spark, tmp_path)).collect()) == [1, 2]
