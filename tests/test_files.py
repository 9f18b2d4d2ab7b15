import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators import clean, layout
from martloom.plans import orders, pipeline, retail
from martloom.sources import files, jdbc

HEADER = "transaction_id,customer_id,product_id,order_date,quantity,unit_price,region"


def drop(folder, name, *lines):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


@pytest.fixture
def landing(fresh):
    return f"{fresh}/landing"


def scan(spark, path):
    return files.with_lineage(files.read_csv_raw(spark, path, retail.RAW_COLUMNS))


def test_everything_lands_as_text_with_lineage(spark, landing):
    path = drop(landing, "a.csv", '1,,5,2026-07-01,3.0,1.5," N, ""x"" "', "2,  ,5,2026-07-01,2,1.5,S")
    rows = scan(spark, path).orderBy("transaction_id").collect()
    assert rows[0].customer_id is None and rows[1].customer_id == "  "
    assert rows[0].quantity == "3.0" and rows[0]._source_file == path
    assert rows[0]._ingested_at is not None


def test_last_row_of_a_file_wins(spark, landing):
    drop(landing, "a.csv", "1,10,5,2026-07-01,2,9,N", "1,10,5,2026-07-01,5,9,N")
    out = retail.clean_sales(scan(spark, landing), files.newest_landed_first()).collect()
    assert [r.quantity for r in out] == [5]


def test_last_row_wins_across_files_and_splits(spark, landing):
    """Three files cut into many splits; every id occurs in every file and twice per file."""
    for f in range(3):
        lines = [f"{i},1,1,2026-07-01,{f * 2 + 1 + half},1,N" for half in (0, 1) for i in range(20_000)]
        drop(landing, f"sales_{f}.csv", *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = scan(spark, landing)
        assert rows.rdd.getNumPartitions() > 6
        latest = clean.dedup_latest(rows, ["transaction_id"], files.newest_landed_first())
        assert latest.groupBy("quantity").count().collect() == [("6", 20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_wrong_header_is_an_error(spark, landing):
    Path(landing).mkdir(parents=True)
    Path(landing, "a.csv").write_text("customer_id,transaction_id,product_id,order_date,quantity,unit_price,region\n1,2,3,4,5,6,7\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan(spark, landing).collect()


def test_reference_csv_is_typed_by_header_name(spark, landing):
    Path(landing).mkdir(parents=True)
    Path(landing, "products.csv").write_text("Category,ProductID,UnitCost\nToys,7,1.50\nToys,x,2\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("ProductID", T.IntegerType()), T.StructField("UnitCost", T.DecimalType(10, 2))])
    rows = files.read_reference_csv(spark, f"{landing}/products.csv", schema).collect()
    assert sorted(map(str, rows)) == ["Row(ProductID=7, UnitCost=Decimal('1.50'))", "Row(ProductID=None, UnitCost=Decimal('2.00'))"]


def test_json_pages_with_an_empty_one(spark, landing):
    day = Path(landing, "run_date=2026-07-01")
    day.mkdir(parents=True)
    (day / "p0.json").write_text('[{"order_id":"a","quantity":"2","unit_price":3},{"order_id":"b","customer_id":null}]')
    (day / "p1.json").write_text("[]")
    rows = files.read_json_pages(spark, landing, orders.FEED).orderBy("order_id").collect()
    assert [(r.order_id, r.quantity, str(r.run_date)) for r in rows] == [("a", "2", "2026-07-01"), ("b", None, "2026-07-01")]
    only_empty = files.read_json_pages(spark, landing, orders.FEED, [str(day / "p1.json")])
    assert only_empty.isEmpty() and "order_id" in only_empty.columns


def test_landed_pages_keep_to_their_size(spark, landing):
    df = spark.range(0, 1000, 1, 3).select(F.col("id").cast("string").alias("order_id"), F.lit(None).cast("string").alias("customer_id"))
    layout.land_json(df, landing, F.lit("2026-07-01").cast("date"), 200)
    sizes = [len(p.read_text().splitlines()) for p in Path(landing, "run_date=2026-07-01").glob("*.json")]
    assert sum(sizes) == 1000 and max(sizes) <= 200
    assert '"customer_id":null' in next(Path(landing, "run_date=2026-07-01").glob("*.json")).read_text()


def test_ingest_is_incremental_and_idempotent(spark, fresh, landing):
    drop(landing, "d1/sales.csv", "1,10,5,2026-07-01,2,9,N")
    lake = f"{fresh}/lake"
    run = lambda: pipeline.ingest_csv(spark, f"{landing}/*", lake, "bronze", retail.RAW_COLUMNS)
    assert run() == 1
    assert run() == 0
    drop(landing, "d2/sales.csv", "2,10,5,2026-07-01,2,9,N", "3,10,5,2026-07-01,2,9,N")
    drop(landing, "d2/empty.csv")
    assert run() == 2
    assert run() == 0
    assert files.ledger(spark, f"{lake}/bronze_files").count() == 3


def test_a_crash_loads_nothing_twice(spark, fresh, landing, monkeypatch):
    """Whatever step a run dies at, later runs load every file once, whatever its name."""
    from martloom.operators import versions

    lake = f"{fresh}/lake"
    run = lambda: pipeline.ingest_csv(spark, landing, lake, "bronze", retail.RAW_COLUMNS)
    drop(landing, "a 1.csv", "1,10,5,2026-07-01,2,9,N")
    assert run() == 1
    names = ["b+2.csv", "c%3.csv", "d[4].csv", "e{5}.csv", "ü 6.csv"]
    for step, name in zip((versions._write_data, versions._commit, files.record, versions._commit, versions._write_data), names, strict=True):
        drop(landing, name, f"{names.index(name) + 2},10,5,2026-07-01,2,9,N")
        with monkeypatch.context() as broken:
            def die(*_, **__):
                raise RuntimeError("lost")

            broken.setattr(files if step is files.record else versions, step.__name__, die)
            with pytest.raises(RuntimeError):
                run()
        if name != "c%3.csv":
            run()
    assert run() == 0 and run() == 0
    rows = versions.read(spark, f"{lake}/bronze").select("transaction_id", files.SOURCE_FILE).collect()
    assert sorted(r[0] for r in rows) == ["1", "2", "3", "4", "5", "6"]
    assert sorted(r[1].rsplit("/", 1)[1] for r in rows) == sorted(["a 1.csv", *names])


def test_files_taken_back_are_loaded_again(spark, fresh, landing):
    from martloom.operators import versions

    lake = f"{fresh}/lake"
    run = lambda: pipeline.ingest_csv(spark, landing, lake, "bronze", retail.RAW_COLUMNS)
    for n in (1, 2):
        drop(landing, f"{n}.csv", f"{n},10,5,2026-07-01,2,9,N")
        assert run() == 1
    versions.restore(spark, f"{lake}/bronze", 1)
    assert run() == 1 and run() == 0
    assert versions.read(spark, f"{lake}/bronze").count() == 2


def test_unseen_by_path_and_by_name(spark):
    a = spark.createDataFrame([("/x/1.csv",), ("/y/1.csv",), ("/y/2.csv",)], "path string")
    seen = spark.createDataFrame([("/x/1.csv",)], "path string")
    paths = lambda df: sorted(r.path for r in df.collect())
    assert paths(files.unseen(a, seen)) == ["/y/1.csv", "/y/2.csv"]
    assert paths(files.unseen(a, seen, by_name=True)) == ["/y/2.csv"]


def test_files_newer_than_a_time(spark, landing):
    old, new = drop(landing, "old.csv", "1,,,,,,"), drop(landing, "new.csv", "2,,,,,,")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    found = files.list_files(spark, landing, "2010-01-01T00:00:00").collect()
    assert [r.path for r in found] == [new] and found[0].size > 0
    assert files.list_files(spark, landing).count() == 2
    assert files.list_files(spark, f"{landing}/nothing").isEmpty()


def test_listing_does_not_read_contents(spark, landing, plan_of):
    drop(landing, "a.csv", "1,,,,,,")
    assert "content" not in plan_of(files.list_files(spark, landing)).split("ReadSchema")[1]


def test_jdbc_ranges():
    assert jdbc.partition_options("id", 1, 100, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc.partition_options("id", 5, 1, 4)
