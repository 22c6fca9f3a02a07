"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_counterpart_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert compare(got, con.execute(sql).df()) == "ok"


def test_signature_ignores_order_and_sees_change(spark):
    from terraloom.plans import reports

    df = spark.read.parquet(f"{SF}/nation.parquet")
    same = reports.signature(df.orderBy("n_name")).first()
    assert reports.signature(df).first() == same
    assert reports.signature(df.withColumn("n_name", df.n_nationkey.cast("string"))).first() != same


def test_run_index_is_append_only(spark, tmp_path):
    from terraloom.plans import reports

    spark.read.parquet(f"{SF}/nation.parquet").createOrReplaceTempView("nation_view")
    for run in ("one", "two"):
        index = reports.run_queries(
            spark,
            {"all": "SELECT * FROM nation_view;", "top": "WITH t AS (SELECT 1 AS a) SELECT * FROM t -- LIMIT", "two": "SELECT 1; SELECT 2",
             "write": "INSERT INTO nation_view VALUES (1)", "escape": "SELECT 1) UNION (SELECT 2"},
            str(tmp_path / "out"), run_id=run,
        )
        table = reports.append_run(index, str(tmp_path / "index"))
    got = {(r.run_id, r.name): (r.status, r.row_count) for r in table.collect()}
    assert got[("one", "all")] == ("ok", 25) and got[("two", "top")] == ("ok", 1)
    assert got[("one", "two")][0] == got[("one", "write")][0] == "failed" and len(got) == 10


def test_profile_of_every_kind_of_column(spark):
    from terraloom.plans import reports

    df = spark.createDataFrame(
        [(1, 2.5, "b", True, [1]), (3, None, "a", False, None), (2, 7.5, None, True, None)],
        "i int, `odd name` double, s string, f boolean, a array<int>",
    )
    rows = {r.column_name: r for r in reports.profile(df).collect()}
    assert set(rows) == {"i", "odd name", "s", "f"}
    assert (rows["i"].rows, rows["i"].nulls, rows["i"].distinct_values, rows["i"].mean, rows["i"].q50) == (3, 0, 3, 2.0, 2.0)
    assert (rows["odd name"].nulls, rows["odd name"].min_value, rows["odd name"].q75) == (1, "2.5", 7.5)
    assert (rows["s"].nulls, rows["s"].max_value, rows["s"].mean, rows["s"].q25) == (1, "b", None, None)
    exact = {r.column_name: r.distinct_values for r in reports.profile(df, exact=True).collect()}
    assert exact == {"i": 3, "odd name": 2, "s": 2, "f": 2}
