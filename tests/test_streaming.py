import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators import versions
from martloom.plans import orders
from martloom.streaming import jobs

EVENTS = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())])


def land(folder, name, *rows):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows))


def hours(spark, base):
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(f"{base}/in")
    jobs.write_hourly(events, f"{base}/out", f"{base}/checkpoint")
    return sorted((r.hour_start.hour, r.n_events) for r in spark.read.parquet(f"{base}/out").collect())


def test_hour_waits_five_minutes_for_late_rows(spark, fresh):
    at = lambda t: {"ts": f"2026-07-01T{t}", "value": 1.0}
    land(fresh, "in/1.json", at("00:10:00"), at("01:04:00"))  # 4 minutes past the end: still open
    assert hours(spark, fresh) == []
    land(fresh, "in/2.json", at("00:59:59"), at("01:05:00"))  # late row counts; now 5 minutes past
    assert hours(spark, fresh) == [(0, 2)]
    land(fresh, "in/3.json", at("00:30:00"), at("02:30:00"))  # too late for its closed hour
    assert hours(spark, fresh) == [(0, 2), (1, 2)]


def order(order_id, changed, status, customer="C1"):
    return {
        "order_id": order_id, "customer_id": customer, "product_id": "P", "category": "A", "quantity": "1.0",
        "unit_price": 2, "order_status": status, "created_at": "2026-07-01T00:00:00+00:00",
        "modified_at": f"2026-07-{changed:02d}T00:00:00+00:00",
    }


def merge(spark, base):
    schema = T.StructType.fromDDL(orders.FEED)
    jobs.upsert_stream(
        jobs.stream_files(spark, f"{base}/in", schema, "json", max_files=1), f"{base}/latest", f"{base}/checkpoint",
        ["order_id"], orders.newest_first(), lambda b: orders.typed_feed(b.select(*orders.FEED_COLUMNS)),
    )
    return sorted((r.order_id, r.order_status) for r in versions.read(spark, f"{base}/latest").collect())


def test_changes_replace_older_versions_in_any_order_of_arrival(spark, fresh):
    land(fresh, "in/1.json", order("a", 1, "completed"), order("a", 2, "returned"), order("b", 1, "completed"))
    assert merge(spark, fresh) == [("a", "returned"), ("b", "completed")]
    version = versions.latest_version(spark, f"{fresh}/latest")
    assert merge(spark, fresh) == [("a", "returned"), ("b", "completed")]
    assert versions.latest_version(spark, f"{fresh}/latest") == version
    land(fresh, "in/2.json", order("a", 1, "completed"), order("b", 5, "cancelled"))
    assert merge(spark, fresh) == [("a", "returned"), ("b", "cancelled")]


def test_second_ingest_adds_nothing(spark, fresh):
    land(fresh, "in/1.json", order("a", 1, "completed"))
    Path(fresh, "in/empty.json").write_text("")
    schema = T.StructType.fromDDL(orders.FEED)
    for expected in (1, 1):
        jobs.ingest(jobs.stream_files(spark, f"{fresh}/in", schema, "json"), f"{fresh}/bronze", f"{fresh}/cp")
        assert spark.read.parquet(f"{fresh}/bronze").count() == expected
    land(fresh, "in/2.json", order("b", 1, "completed"))
    jobs.ingest(jobs.stream_files(spark, f"{fresh}/in", schema, "json"), f"{fresh}/bronze", f"{fresh}/cp")
    rows = spark.read.parquet(f"{fresh}/bronze")
    assert rows.select(F.count_distinct("_source_file")).first()[0] == 2


def test_pages_are_streamed_once_and_empty_ones_are_remembered(spark, fresh):
    from pathlib import Path

    from martloom.streaming import jobs

    landing = Path(fresh.removeprefix("file:"), "landing", "run_date=2026-07-01")
    landing.mkdir(parents=True)
    (landing / "page_0.json").write_text('[{"a": "1", "b": null},\n {"a": "2"}]')
    (landing / "page_1.json").write_text("[]")
    run = lambda: jobs.ingest(jobs.json_pages(spark, f"{fresh}/landing/run_date=*", "a string, b string"), f"{fresh}/bronze", f"{fresh}/check")
    rows = lambda: sorted((r.a, r._position) for r in spark.read.parquet(f"{fresh}/bronze").collect())
    run()
    assert rows() == [("1", 0), ("2", 1)]
    (landing / "page_2.json").write_text('[{"a": "3"}]')
    for _ in range(2):
        run()
        assert rows() == [("1", 0), ("2", 1), ("3", 0)]
    seen = "".join(f.read_text() for f in Path(fresh.removeprefix("file:"), "check", "sources", "0").iterdir() if not f.name.startswith("."))
    assert "page_1.json" in seen
    (landing / "page_3.json").write_text('[{"a": ')
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        run()
