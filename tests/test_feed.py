import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.sources import feed


def changes(spark, n, hot=False):
    """n changes; with ``hot`` a third of them bear the same time."""
    minute = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")) if hot else F.col("id")
    at = F.expr("timestamp_ntz '2026-07-01 00:00:00'") + F.make_dt_interval(mins=minute)
    return spark.range(0, n, 1, 8).select(F.format_string("o%08d", "id").alias("order_id"), at.alias("modified_at"))


def test_pages_are_complete_and_in_order(spark):
    rows = changes(spark, 1_050)
    pages = {r.page: r for r in feed.page_summary(rows, ["modified_at", "order_id"], 200).collect()}
    assert [pages[i].page_rows for i in range(6)] == [200] * 5 + [50]
    assert [pages[i].next_cursor for i in range(6)] == [200, 400, 600, 800, 1000, None]
    assert {p.total_rows for p in pages.values()} == {1_050}


def test_places_match_a_single_sort_with_a_hot_time(spark):
    rows = changes(spark, 9_000, hot=True)
    placed = feed.numbered(rows, ["modified_at", "order_id"]).orderBy("_row").collect()
    assert [r._row for r in placed] == list(range(9_000))
    expected = sorted((r.modified_at, r.order_id) for r in rows.collect())
    assert [(r.modified_at, r.order_id) for r in placed] == expected


def test_one_page(spark):
    rows = feed.page_slice(changes(spark, 1_000), ["modified_at", "order_id"], 400, 200).collect()
    assert [r.order_id for r in rows] == [f"o{i:08d}" for i in range(400, 600)]


def test_pages_tile_the_feed_under_tied_times(spark, plan_of):
    rows = changes(spark, 1_000, hot=True)
    pages = [feed.page_slice(rows, ["modified_at"], at, 300) for at in range(0, 1_000, 300)]
    assert "TakeOrderedAndProject" not in plan_of(pages[0])
    assert sorted(r for p in pages for r in p.collect()) == sorted(rows.collect())


def test_page_arrays_keep_the_order(spark):
    pages = feed.page_arrays(changes(spark, 450), ["modified_at", "order_id"], 200).orderBy("page").collect()
    assert [len(p.rows) for p in pages] == [200, 200, 50]
    assert [r.order_id for p in pages for r in p.rows] == [f"o{i:08d}" for i in range(450)]


def test_mark_is_strict_and_an_overlap_reaches_back(spark):
    rows = changes(spark, 10)
    hwm = dt.datetime(2026, 7, 1, 0, 5)
    assert feed.extract_since(rows, hwm).count() == 4
    assert feed.extract_since(rows, hwm, overlap="2 minutes").count() == 6
    assert feed.extract_since(rows).count() == 10


def test_mark_filter_reaches_the_scan(spark, folder, plan_of):
    scan = spark.read.parquet(f"{folder}/orders.parquet")
    plan = plan_of(feed.extract_since(scan, dt.datetime(2001, 1, 1), "o_orderdate"))
    assert "GreaterThan(o_orderdate" in plan


def test_control_table(spark, fresh):
    path = f"{fresh}/hwm"
    assert feed.hwm_value(feed.read_control(spark, path), "orders") is None
    first, second = dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 2)
    feed.hwm_advance(spark, path, "orders", second)
    feed.hwm_advance(spark, path, "orders", first)
    control = feed.read_control(spark, path)
    assert feed.hwm_value(control, "orders") == first  # newest row, not greatest value
    names = spark.createDataFrame([("orders",), ("other",)], "table_name string")
    found = {r.table_name: r.value for r in feed.hwm_lookup(control, names).collect()}
    assert found == {"orders": first, "other": dt.datetime(1900, 1, 1)}


def test_mark_never_goes_back(spark):
    old = spark.createDataFrame([("a", dt.datetime(2026, 7, 5)), ("b", dt.datetime(2026, 7, 5))], "table_name string, value timestamp_ntz")
    seen = spark.createDataFrame([("a", dt.datetime(2026, 7, 1))], "table_name string, modified_at timestamp_ntz")
    assert {r.new_value for r in feed.next_hwm(seen, old).collect()} == {dt.datetime(2026, 7, 5)}


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_pages_behind_cursors_tile_the_feed(spark, size):
    """Tied and missing times: every row is on one page, in order."""
    times = [None, "2026-07-01 00:00:00", "2026-07-01 00:00:00", "2026-07-02 00:00:00"]
    rows = [(f"O{i:03d}", times[i % 4]) for i in range(22)]
    feed_rows = spark.createDataFrame(rows, "order_id string, t string").select("order_id", F.col("t").cast("timestamp_ntz").alias("modified_at"))
    order, cursor, seen = ["modified_at", "order_id"], None, []
    while (found := feed.page_after(feed_rows.repartition(4), order, cursor, size).collect()):
        assert len(found) <= size
        seen += [r.order_id for r in found]
        cursor = [found[-1].modified_at, found[-1].order_id]
    assert seen == [i for i, _ in sorted(rows, key=lambda r: (r[1] or "", r[0]))]
    page = feed.page_after(feed_rows, order, None, 4)
    assert feed.cursor_of(page, order) == [None, "O012"]
    assert feed.cursor_of(feed_rows.limit(0), order) is None


def test_one_page_does_not_sort_the_feed(spark, folder, plan_of):
    rows = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("modified_at"))
    plan = plan_of(feed.page_after(rows, ["modified_at", "order_id"], ["1998-01-01 00:00:00", 5], 100))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "GreaterThanOrEqual(o_orderdate" in plan
