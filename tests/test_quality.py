import pytest
from pyspark.sql import functions as F

from martloom.operators import quality


def failures(df):
    return {(r.check_name, r.column_name): r.failures for r in df.collect()}


def test_each_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, s string")
    parent = spark.createDataFrame([(2,)], "k int")
    assert failures(quality.not_null(df, "t", ["k", "s"])) == {("not_null", "k"): 2, ("not_null", "s"): 0}
    assert failures(quality.unique(df, "t", "k")) == {("unique", "k"): 1}
    assert failures(quality.accepted_values(df, "t", "s", ["a", "b"])) == {("accepted_values", "s"): 1}
    assert failures(quality.relationships(df, "t", "k", parent, "k")) == {("relationships", "k"): 2}


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k int, s string")
    checks = [
        quality.not_null(df, "t", ["k"]), quality.unique(df, "t", "k"),
        quality.accepted_values(df, "t", "s", ["a"]), quality.relationships(df, "t", "k", df, "k"),
    ]
    assert all(r.passed for r in quality.run_suite(checks).collect())


def test_a_failure_stops_the_run(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(quality.DataTestFailed, match=r"t\.k unique: 1"):
        quality.run_suite([quality.unique(df, "t", "k"), quality.not_null(df, "t", ["k"])])


def test_hot_foreign_key_is_counted_before_the_join(spark, plan_of):
    child = spark.range(0, 90_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    parent = spark.range(0, 90_000, 1, 8)
    # A parent that fits a broadcast is joined map-side and nothing is shuffled by key.
    assert "BroadcastHashJoin" in plan_of(quality.relationships(child, "t", "k", parent, "id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check = quality.relationships(child, "t", "k", parent, "id")
        plan = plan_of(check)
        assert "partial_count" in plan[plan.index("LeftAnti"):]
        assert failures(check) == {("relationships", "k"): 30_000}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_not_null_is_one_scan_per_table(spark, folder, plan_of):
    df = spark.read.parquet(f"{folder}/orders.parquet")
    plan = plan_of(quality.not_null(df, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]))
    assert plan.count("FileScan") == 1


def test_constraints_after_an_increment(spark):
    fact = "id int, fk int"
    stored = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (None, None)], fact)
    added = spark.createDataFrame([(3, 10), (4, 30), (5, 40), (5, 10), (None, None), (None, 10)], fact)
    parents = spark.createDataFrame([(10,), (30,)], "pk int")
    gone = spark.createDataFrame([(20,)], "pk int")
    checks = [
        quality.still_unique(stored, added, "fact", "id"),
        quality.still_related(stored, added, "fact", "fk", parents, "pk"),
        quality.still_related(stored, added, "fact", "fk", parents, "pk", gone),
    ]
    assert [c.first().failures for c in checks] == [2, 1, 3]
    clean = spark.createDataFrame([(7, 30)], fact)
    assert all(r.passed for r in quality.suite([quality.still_unique(stored, clean, "f", "id"), quality.still_related(stored, clean, "f", "fk", parents, "pk")]).collect())
