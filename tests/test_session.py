import os

import pytest
from pyspark.sql import functions as F

from terraloom import session


def test_sweep_removes_only_what_was_handed_out(spark, monkeypatch):
    monkeypatch.setattr(session, "_handed_out", {})
    path = session.new_dir(spark, "swept")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    session.sweep(spark)
    assert not os.path.isdir(local) and os.path.isdir(os.path.dirname(local))


def test_discard_takes_only_named_tables_of_this_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_handed_out", {})
    one, two = (session.new_dir(spark, n) for n in ("one", "two"))
    other = str(tmp_path / "other")
    for path in (one, two, other):
        spark.range(3).write.parquet(path)
    session.discard(spark, [one, other])
    assert session.handed_out(spark) == [two]
    assert [os.path.isdir(p.removeprefix("file:")) for p in (one, two, other)] == [False, True, True]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_heavy_keys_is_the_plain_join(spark, how):
    facts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"), "id")
    dim = facts.where("k <> 3").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = session.lookup(facts, dim, ["k"], "n", how)
    want = facts.join(dim, ["k"], how)
    assert "Union" in got._jdf.queryExecution().analyzed().toString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_lookup_shuffles_tables_of_many_rows(spark, monkeypatch):
    facts = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    dim = spark.range(50).selectExpr("id AS k", "CAST(20 AS BIGINT) AS n")
    assert "BroadcastHashJoin" in session.lookup(facts, dim, ["k"], "n")._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "BROADCAST_ROWS", 49)
    out = session.lookup(facts, dim, ["k"], "n")
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 1000
