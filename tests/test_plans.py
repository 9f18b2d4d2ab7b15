"""The physical plans are what a large run needs."""

import re

import pytest

from martloom.operators import layout
from martloom.plans import bi, catalog, inputs
from martloom.session import scratch_dir

LAZY = [
    "star_month_category", "flat_sales", "metric_yoy", "yoy_same_period", "category_contribution", "clean_sales",
    "silver_sales", "reject_log", "audit_counts", "dedup_audit", "stg_orders", "dim_product_current",
    "customer_drilldown", "last7_region_daily", "feed_increment", "dq_relationships", "dq_unique", "merge_counts",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, folder, plan_of, name):
    plan = plan_of(catalog.QUERIES[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_scan_reads_only_what_the_query_needs(spark, folder, plan_of):
    plan = plan_of(catalog.star_month_category(spark, folder))
    read = re.findall(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert read and "l_tax" not in read[0] and "l_comment" not in read[0] and "l_extendedprice" not in read[0]


def test_customer_range_reaches_the_scan(spark, folder, plan_of):
    plan = plan_of(catalog.customer_drilldown(spark, folder))
    assert "GreaterThanOrEqual(o_custkey,100)" in plan and "LessThanOrEqual(c_custkey,200)" in plan


def test_dimensions_are_broadcast_by_size(spark, folder, plan_of):
    assert plan_of(catalog.star_month_category(spark, folder)).count("BroadcastHashJoin") >= 3
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(catalog.star_month_category(spark, folder))
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clustered_table_prunes_days_and_row_groups(spark, folder, plan_of):
    path = scratch_dir(spark, "layout")
    fact = inputs.regional_lines(inputs.tables(spark, folder))
    layout.write_clustered(fact, path, ["order_date"], ["customer_id"], ["transaction_id"])
    day = fact.select("order_date").orderBy("order_date").first().order_date
    stored = spark.read.parquet(path).filter(f"order_date = date '{day}' and customer_id between 100 and 200")
    plan = plan_of(stored)
    assert re.search(r"PartitionFilters: \[[^\]]*order_date", plan)
    assert "GreaterThanOrEqual(customer_id,100)" in plan
    same = fact.filter(f"order_date = date '{day}' and customer_id between 100 and 200")
    assert stored.count() == same.count()


def test_hot_partition_is_spread_over_tasks(spark):
    """Two thirds of the rows on one day: the range goes on into the customer and the id."""
    rows = spark.range(0, 120_000, 1, 8).selectExpr(
        "if(id % 3 > 0, 1, id) as day", "if(id % 2 = 0, 7, id) as customer", "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = layout.clustered(rows, ["day"], ["customer"], ["id"]).selectExpr("day", "spark_partition_id() as p")
        tasks = placed.filter("day = 1").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) >= 5 and max(t["count"] for t in tasks) < 30_000


def test_same_days_last_year_works_on_days_not_rows(spark, folder, plan_of):
    t = inputs.tables(spark, folder)
    dated = catalog._dated(t)
    plan = plan_of(bi.same_period_last_year(dated, bi.dim_date(inputs.bi_bounds(t)), ["year"]))
    assert "partial_sum(revenue" in plan
