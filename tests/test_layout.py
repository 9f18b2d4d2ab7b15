"""Layouts: what a filter reads of a table, and that rewriting keeps every row."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martloom.operators import layout
from martloom.plans import bi


def _fact(spark, rows=20_000):
    """Customers and days that do not go together; amounts and regions by rule."""
    n = F.col("id")
    return spark.range(0, rows, 1, 4).select(
        n.alias("transaction_id"), F.pmod(F.xxhash64(n), F.lit(1000)).cast("int").alias("customer_id"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.pmod(F.xxhash64(n, F.lit(1)), F.lit(200)).cast("int")).alias("order_date"),
        F.concat(F.lit("R"), (n % 5).cast("string")).alias("region"), (n % 97).cast("decimal(12,2)").alias("total_amount"),
    )


def _scanned(df) -> int:
    """Rows that the table scans of a query gave to it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    rows, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName() and node.metrics().contains("numOutputRows"):
            rows += node.metrics().apply("numOutputRows").value()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return rows


def _by_day(spark, folder):
    layout.write_clustered(_fact(spark), folder, ["order_date"], ["customer_id"], ["transaction_id"], tasks=2)
    return spark.read.parquet(folder)


def test_the_newest_day_is_known_without_opening_others(spark, fresh):
    from pathlib import Path

    table = _by_day(spark, fresh)
    expected = bi.latest_day_by_region(table).orderBy("region").collect()
    for file in Path(fresh.removeprefix("file:")).glob("order_date=*/*.parquet"):
        if "order_date=2026-07-19" not in str(file):
            file.write_bytes(b"no parquet")  # opening it would fail
    newest = layout.newest(table, "order_date")
    found = bi.latest_day_by_region(table, newest).orderBy("region")
    assert found.collect() == expected and found.first().order_date == dt.date(2026, 7, 19)


def test_a_newest_folder_without_rows_does_not_count(spark, fresh):
    _fact(spark).write.partitionBy("order_date").parquet(fresh)
    _fact(spark).limit(0).drop("order_date").coalesce(1).write.parquet(f"{fresh}/order_date=2027-01-01")
    table = spark.read.parquet(fresh)
    assert table.select(layout.newest(table, "order_date").alias("d")).first().d == dt.date(2026, 7, 19)
    assert spark.conf.get("spark.sql.optimizer.metadataOnly") == "false"
    none = spark.createDataFrame([], table.schema)
    assert spark.range(1).select(layout.newest(none, "order_date").alias("d")).first().d is None


def _groups_read(folder, column, low, high) -> float:
    """Share of the row groups whose least and greatest value allow the filter."""
    from pathlib import Path

    hit = total = 0
    for file in Path(folder.removeprefix("file:")).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit / total


def test_reclustering_helps_filters_on_either_column(spark, fresh):
    fact = _fact(spark, 100_000)
    fact.write.parquet(f"{fresh}/before")
    before = spark.read.parquet(f"{fresh}/before")
    layout.recluster(before, f"{fresh}/after", ["customer_id", "order_date"], ["transaction_id"], tasks=64)
    after = spark.read.parquet(f"{fresh}/after")
    assert after.columns == before.columns
    assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()
    days = (dt.date(2026, 3, 1), dt.date(2026, 3, 7))
    assert _groups_read(f"{fresh}/before", "customer_id", 100, 110) == 1.0
    assert _groups_read(f"{fresh}/after", "customer_id", 100, 110) <= 0.25
    assert _groups_read(f"{fresh}/after", "order_date", *days) <= 0.25
    one = F.col("customer_id").between(100, 110)
    assert _scanned(after.filter(one)) < 0.3 * _scanned(before.filter(one))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a"), (None, "b"), (3, None), (1, "a")], [(7, "same")] * 50])
def test_curve_of_odd_rows(spark, fresh, rows):
    df = spark.createDataFrame(rows, "n int, s string")
    layout.recluster(df, fresh, ["n", "s"])
    back = spark.read.schema(df.schema).parquet(fresh)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_ranks_follow_the_order_and_fill_ranges_alike(spark):
    df = spark.range(0, 8_000).select((F.col("id") * 7 % 8_000).alias("n"), F.concat(F.lit("k"), F.lpad((F.col("id") % 900).cast("string"), 4, "0")).alias("s"))
    for column in ("n", "s"):
        ranked = df.select(column, layout.range_rank(df, column, 4).alias("r"))
        rows = ranked.groupBy("r").agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("r").collect()
        assert [r.r for r in rows] == list(range(16))
        assert all(a.high < b.low for a, b in zip(rows, rows[1:], strict=False))
        assert max(r.n for r in rows) < 2 * min(r.n for r in rows)
    with pytest.raises(ValueError, match="do not fit"):
        layout.with_place(df, ["n", "s", "n"], "p", 30)


def test_point_look_ups_read_few_rows(spark, fresh):
    fact = _fact(spark, 60_000).withColumn("customer_id", F.col("customer_id") * 2)  # odd ids are absent
    fact.repartition(2).write.parquet(f"{fresh}/plain")
    layout.write_indexed(fact, f"{fresh}/indexed", "customer_id", 1000, tasks=2)
    plain, indexed = spark.read.parquet(f"{fresh}/plain"), spark.read.parquet(f"{fresh}/indexed")
    for key in (274, 275, 1_000_000):
        rows = F.col("customer_id") == key
        assert indexed.filter(rows).count() == plain.filter(rows).count()
    assert _scanned(indexed.filter("customer_id = 274")) <= 4_000 < 60_000 == _scanned(plain.filter("customer_id = 274"))
    assert _scanned(indexed.filter("customer_id = 275")) == 0  # within the range of a file: the Bloom filter tells


def test_width_of_a_write(spark, fresh):
    spark.range(10).write.parquet(fresh)
    table = spark.read.parquet(fresh)
    assert layout.write_width(table) == 1
    assert layout.write_width(table, 3_000) == 10


def test_a_writing_task_takes_a_bounded_share(spark):
    """80 MB of input are more than one task sorts in memory at a time."""
    assert layout.write_width(spark.range(10_000_000)) == 3
    assert layout.write_width(spark.range(10), 3_000) == 10
