import pytest
from pyspark.sql import functions as F

from martloom.operators import upsert

SCHEMA = "k int, a string, b string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_matched_rows_change_and_new_rows_come_in(spark):
    t = table(spark, (1, "x", "x"), (2, "x", "x"))
    s = table(spark, (2, "y", None), (3, "y", "y"))
    assert rows(upsert.merge_upsert(t, s, ["k"])) == [(1, "x", "x"), (2, "y", None), (3, "y", "y")]
    assert upsert.merge_counts(t, s, ["k"]).first().asDict() == {"inserted": 1, "updated": 1}


def test_null_keys_never_match(spark):
    t, s = table(spark, (None, "t", "t")), table(spark, (None, "s", "s"))
    for merged in (upsert.merge_upsert(t, s, ["k"]), upsert.merge_partial(t, s, ["k"], ["a"])):
        assert rows(merged) == [(None, "s", "s"), (None, "t", "t")]


def test_partial_update_takes_nulls_and_leaves_other_columns(spark):
    t = table(spark, (1, "x", "x"), (2, "x", "x"))
    s = table(spark, (2, None, "new"), (3, "y", "y"))
    assert rows(upsert.merge_partial(t, s, ["k"], ["a"])) == [(1, "x", "x"), (2, None, "x"), (3, "y", "y")]


def test_newest_version_wins_whatever_its_side(spark):
    t = table(spark, (1, "9", "stored"), (2, "1", "stored"), (4, "1", "stored"))
    s = table(spark, (1, "5", "late"), (2, "5", "new"), (3, "5", "new"))
    assert rows(upsert.merge_latest(t, s, ["k"], [F.desc("a")])) == [
        (1, "9", "stored"), (2, "5", "new"), (3, "5", "new"), (4, "1", "stored"),
    ]


def test_insert_missing_leaves_stored_rows(spark):
    t, s = table(spark, (1, "x", "x")), table(spark, (1, "y", "y"), (2, "y", "y"))
    assert rows(upsert.insert_missing(t, s, ["k"])) == [(1, "x", "x"), (2, "y", "y")]


def test_repeated_source_keys_are_refused(spark):
    with pytest.raises(upsert.DuplicateKeys):
        upsert.require_unique(table(spark, (1, "x", "x"), (1, "y", "y")), ["k"])
    upsert.require_unique(table(spark, (None, "x", "x"), (None, "y", "y"), (1, "z", "z")), ["k"])


def test_merging_twice_changes_nothing(spark):
    t, s = table(spark, (1, "x", "x")), table(spark, (1, "y", "y"), (2, "y", "y"))
    once = upsert.merge_upsert(t, s, ["k"])
    assert rows(upsert.merge_upsert(once, s, ["k"])) == rows(once)


def test_small_increment_does_not_shuffle_the_target(spark, plan_of):
    t = spark.range(0, 5_000_000, 1, 8).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("a"), F.lit("x").alias("b"))
    source = table(spark, (1, "y", "y"))
    plan = plan_of(upsert.merge_upsert(t, upsert.small_side(source), ["k"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    # Beyond the bound the join has to work without a broadcast.
    big = upsert.merge_upsert(t, upsert.small_side(source, limit=1), ["k"])
    assert "SortMergeJoin" in plan_of(big) and big.count() == 5_000_000


def test_shared_keys(spark):
    a, b = table(spark, (1, "", ""), (2, "", "")), table(spark, (2, "", ""), (2, "", ""), (3, "", ""))
    assert rows(upsert.shared_keys(a, b, ["k"])) == [(2,)]


def _target(spark, n=200_000):
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 1000 != 7, F.col("id").cast("int")).alias("k"), F.lit("x").alias("a"), F.lit("x").alias("b")
    )


def test_a_filter_of_keys_loses_none_and_lets_few_others_through(spark):
    target = _target(spark)
    source = spark.range(0, 2_000, 1, 2).select((F.col("id") * 131).cast("int").alias("k"), F.lit("y").alias("a"), F.lit("y").alias("b"))
    near = upsert.may_match(target, upsert.key_filter(source, ["k"]), ["k"])
    hits = target.join(source.select("k"), "k", "left_semi")
    assert near.columns == target.columns
    assert hits.exceptAll(near).isEmpty()
    assert near.count() - hits.count() < 0.02 * target.count()
    two = ["k", "a"]
    assert upsert.may_match(target, upsert.key_filter(source, two), two).count() < 0.02 * target.count()


def test_filters_of_parts_merge_into_that_of_the_whole(spark):
    source = table(spark, *[(i, "", "") for i in range(500)], (None, "", ""))
    whole = upsert.key_filter(source, ["k"])
    parts = upsert.key_filter(source.filter("k < 200"), ["k"]).unionByName(upsert.key_filter(source.filter("k >= 200"), ["k"]))
    merged = parts.groupBy("block", "blocks").agg(F.bitmap_or_agg("bits").alias("bits")).select(whole.columns)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    assert upsert.may_match(source, upsert.key_filter(source.limit(0), ["k"]), ["k"]).isEmpty()


def test_a_large_increment_shuffles_few_stored_rows(spark, monkeypatch):
    """Beyond the broadcast, what a join shuffles of the target is near its matches."""
    monkeypatch.setattr(upsert, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = table(spark, *[(i * 400, "y", "y") for i in range(500)])
        found = upsert.matching(_target(spark), source, ["k"])
        assert sorted(r.k for r in found.collect()) == [i * 400 for i in range(500)]
        plan, most = [found._jdf.queryExecution().executedPlan().executedPlan()], 0
        while plan:
            node = plan.pop()
            if node.nodeName() == "Exchange":
                most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
            plan += [node.plan()] if node.getClass().getSimpleName().endswith("QueryStageExec") else []
            plan += [node.children().apply(i) for i in range(node.children().length())]
        assert 500 <= most < 5_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_versioned_upsert_without_broadcast(spark, fresh, monkeypatch):
    """Rows that move to another partition are found by the filter too."""
    from martloom.operators import versions

    monkeypatch.setattr(upsert, "BROADCAST_BYTES", -1)
    layout = versions.Layout(["a"], ["k"], ["k"])
    versions.publish(table(spark, *[(i, f"p{i % 4}", "old") for i in range(400)]), fresh, "load", layout)
    versions.upsert(table(spark, (3, "p3", "new"), (8, "p1", "moved"), (9_000, "p9", "added")), fresh, ["k"], layout)
    found = {r.k: (r.a, r.b) for r in versions.read(spark, fresh).collect()}
    assert len(found) == 401 and found[3] == ("p3", "new") and found[8] == ("p1", "moved") and found[9_000] == ("p9", "added")
    assert versions.read(spark, fresh).count() == 401


def test_only_new_and_changed_rows_are_stamped(spark):
    old, new = F.lit("2026-01-01"), F.lit("2026-02-01")
    target = table(spark, (1, "x", None), (2, "x", "x"), (3, "x", "x")).withColumn("loaded_at", old.cast("timestamp"))
    source = table(spark, (1, "x", None), (2, "x", "y"), (4, "z", "z"))
    merged = upsert.merge_stamped(target, source, ["k"], new)
    assert {r.k: (r.b, str(r.loaded_at)[:10]) for r in merged.collect()} == {
        1: (None, "2026-01-01"), 2: ("y", "2026-02-01"), 3: ("x", "2026-01-01"), 4: ("z", "2026-02-01"),
    }
