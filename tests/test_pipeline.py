import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators import quality, versions
from martloom.plans import orders, pipeline
from martloom.sources import files

HEADER = "transaction_id,customer_id,product_id,order_date,quantity,unit_price,region"


def drop(folder, name, *lines):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")


def dims(spark):
    customers = spark.createDataFrame([(10, " Ann "), (11, "Bo"), (11, "Bo ")], "customer_id int, customer_name string")
    products = spark.createDataFrame([(5, "Pen"), (6, "Cup")], "product_id int, product_name string")
    return customers, products


def fact_rows(spark, lake):
    fact = versions.read(spark, f"{lake}/fact_sales")
    return sorted((r.transaction_id, r.quantity, str(r.total_amount)) for r in fact.collect())


def test_retail_run_is_incremental_and_repeatable(spark, fresh):
    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    drop(landing, "sales_1.csv", "1,10,5,2026-07-01,2,9.50, N ", "2,,5,2026-07-01,1,1,N", "3,11,6,2026-07-03,3.0,1,S")
    run = lambda: pipeline.run_retail(spark, landing, *dims(spark), lake)
    assert all(r.passed for r in run().collect())
    assert fact_rows(spark, lake) == [(1, 2, "19.00"), (3, 3, "3.00")]
    assert versions.read(spark, f"{lake}/dim_date").count() == 3
    assert versions.read(spark, f"{lake}/dim_customer").count() == 2
    assert [r.reason for r in versions.read(spark, f"{lake}/rejects").collect()] == ["null/unparseable CustomerID"]

    run()
    assert versions.latest_version(spark, f"{lake}/fact_sales") == 1
    assert versions.read(spark, f"{lake}/rejects").count() == 1

    drop(landing, "sales_2.csv", "1,10,5,2026-07-01,4,9.50,N", "4,10,5,2026-08-05,1,1,N")
    run()
    assert fact_rows(spark, lake) == [(1, 4, "38.00"), (3, 3, "3.00"), (4, 1, "1.00")]
    assert {r.version for r in versions.history(spark, f"{lake}/fact_sales").collect()} == {1, 2}


def test_retail_run_makes_up_for_one_that_died_after_bronze(spark, fresh):
    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    drop(landing, "sales_1.csv", "1,10,5,2026-07-01,2,9.50,N", "2,,5,2026-07-01,1,1,N")
    from martloom.plans import retail

    pipeline.ingest_csv(spark, landing, lake, "bronze_sales", retail.RAW_COLUMNS)
    pipeline.run_retail(spark, landing, *dims(spark), lake)
    assert fact_rows(spark, lake) == [(1, 2, "19.00")]
    assert versions.read(spark, f"{lake}/rejects").count() == 1


def test_retail_run_stops_at_a_failing_test(spark, fresh):
    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    drop(landing, "sales_1.csv", "1,99,5,2026-07-01,2,9.50,N")
    with pytest.raises(quality.DataTestFailed, match="customer_id relationships: 1"):
        pipeline.run_retail(spark, landing, *dims(spark), lake)


def feed(spark, *rows):
    at = lambda d: dt.datetime(2026, 7, d)
    data = [(o, c, "P1", "CAT", q, Decimal("2.50"), s, at(made), at(changed)) for o, c, q, s, made, changed in rows]
    schema = orders.FEED.replace("created_at string, modified_at string", "created_at timestamp_ntz, modified_at timestamp_ntz")
    return spark.createDataFrame(data, schema)


def staged(spark, lake):
    return sorted((r.order_id, r.quantity, r.order_status) for r in versions.read(spark, f"{lake}/stg_orders").collect())


def test_orders_run_catches_changes_and_lost_customers(spark, fresh):
    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    first = [("a", "C1", "2.0", "completed", 1, 1), ("b", None, "1", "completed", 1, 1), ("c", "C2", "3", "completed", 2, 2)]
    results = pipeline.run_orders(spark, feed(spark, *first), landing, lake)
    assert results.count() == 19 and all(r.passed for r in results.collect())
    assert staged(spark, lake) == [("a", 2, "completed"), ("c", 3, "completed")]

    pipeline.run_orders(spark, feed(spark, *first), landing, lake)
    assert versions.latest_version(spark, f"{lake}/bronze_orders") == 1  # nothing new was pulled

    later = [*first, ("a", "C1", "2", "returned", 1, 5), ("c", None, "3", "completed", 2, 6), ("d", "C3", "1", "cancelled", 4, 4)]
    pipeline.run_orders(spark, feed(spark, *later), landing, lake)
    assert staged(spark, lake) == [("a", 2, "returned"), ("d", 1, "cancelled")]
    assert versions.read(spark, f"{lake}/dim_date").count() == 4


def test_orders_mark_stays_when_landing_fails(spark, fresh, monkeypatch):
    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    source = feed(spark, ("a", "C1", "1", "completed", 1, 1))

    def broken(*_, **__):
        raise OSError("landing zone unreachable")

    monkeypatch.setattr(pipeline, "land_json", broken)
    with pytest.raises(OSError):
        pipeline.land_increment(source, landing, f"{lake}/hwm")
    monkeypatch.undo()
    assert pipeline.land_increment(source, landing, f"{lake}/hwm") == 1
    assert pipeline.land_increment(source, landing, f"{lake}/hwm") == 0


def test_orders_run_stops_at_an_unknown_status(spark, fresh):
    with pytest.raises(quality.DataTestFailed, match="order_status accepted_values: 1"):
        pipeline.run_orders(spark, feed(spark, ("a", "C1", "1", "lost", 1, 1)), f"{fresh}/landing", f"{fresh}/lake")


def test_dedupe_before_filter_differs_from_filter_before_dedupe(spark):
    rows = feed(spark, ("a", "C1", "1", "completed", 1, 1), ("a", None, "1", "returned", 1, 2))
    assert orders.stg_orders(orders.latest_orders(rows)).isEmpty()
    assert orders.latest_orders(rows.filter("customer_id is not null")).count() == 1


def test_lineage_does_not_reach_the_marts(spark, fresh):
    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    pipeline.run_orders(spark, feed(spark, ("a", "C1", "1", "completed", 1, 1)), landing, lake)
    for name in ("stg_orders", "fct_orders", "dim_customer", "dim_product"):
        assert files.INGESTED_AT not in versions.read(spark, f"{lake}/{name}").columns
    assert versions.read(spark, f"{lake}/fct_orders").select(F.col("gross_amount").cast("string")).first()[0] == "2.50"


@pytest.mark.parametrize("dies", ["after the note", "after the data"])
def test_no_file_is_lost_by_a_crash_and_a_restore(spark, fresh, monkeypatch, dies):
    """A run dies at some step, a restore takes the number of its version, later runs load every file once."""
    from martloom.plans import retail

    landing, lake = f"{fresh}/landing", f"{fresh}/lake"
    ingest = lambda: pipeline.ingest_csv(spark, landing, lake, "bronze", retail.RAW_COLUMNS)
    drop(landing, "sales_1.csv", "1,10,5,2026-07-01,2,9.50,N")
    ingest()
    drop(landing, "sales_2.csv", "2,10,5,2026-07-02,2,9.50,N")
    step = (versions, "append") if dies == "after the note" else (versions, "_commit")
    with monkeypatch.context() as patch:
        patch.setattr(*step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            ingest()
    versions.restore(spark, f"{lake}/bronze", 1)
    drop(landing, "sales_3.csv", "3,10,5,2026-07-03,2,9.50,N")
    assert (ingest(), ingest()) == (2, 0)
    assert sorted(r.transaction_id for r in versions.read(spark, f"{lake}/bronze").collect()) == ["1", "2", "3"]
    versions.restore(spark, f"{lake}/bronze", 1)
    assert (ingest(), ingest()) == (2, 0)
