"""Headline timings as one JSON line.

The star and flat queries run like the published baseline: on stored tables,
warm, median of 7. The layout pairs compare a plain copy of the fact with one
kept by day and sorted by customer. The rest is timed from the raw parquet
files (median of 3), the result thrown away row by row; the retail run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from martloom.operators import layout  # noqa: E402
from martloom.plans import bi, catalog, inputs, pipeline  # noqa: E402
from martloom.session import get_spark, scratch_dir  # noqa: E402

FROM_RAW = [
    "star_month_category", "metric_yoy", "yoy_same_period", "category_contribution", "clean_sales", "silver_sales",
    "reject_summary", "stg_orders", "dim_product_current", "feed_pages", "merge_upsert", "dq_relationships",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def stored(df: DataFrame, path: str, files: int = 0) -> DataFrame:
    (df.repartition(files) if files else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def warm(df: DataFrame) -> DataFrame:
    df = df.cache()
    df.count()
    return df


def star_and_flat(spark: SparkSession, folder: str, cores: int, times: dict[str, float]) -> None:
    t = inputs.tables(spark, folder)
    base = scratch_dir(spark, "bench-star")
    fact = warm(stored(catalog._bi_fact(t), f"{base}/fact", cores))
    dates = warm(stored(bi.dim_date(inputs.bi_bounds(t)), f"{base}/dates", 1))
    products = warm(stored(inputs.bi_products(t), f"{base}/products", 1))
    customers = stored(inputs.bi_customers(t), f"{base}/customers", 1)
    flat = bi.flat_sales(fact, dates, products, inputs.bi_regions(t), customers)
    flat = warm(stored(flat, f"{base}/flat", cores))
    star = bi.star_month_category(fact, dates, products)
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # a few hundred groups are left
    for _ in range(5):  # compile
        star.collect(), bi.month_category(flat).collect()
    times["star_query_warm"] = timed(lambda: bi.star_month_category(fact, dates, products).collect(), 7)
    times["flat_query_warm"] = timed(lambda: bi.month_category(flat).collect(), 7)
    for df in (fact, dates, products, flat):
        df.unpersist()
    spark.conf.set("spark.sql.shuffle.partitions", str(cores))


def layouts(spark: SparkSession, folder: str, cores: int, times: dict[str, float]) -> None:
    t = inputs.tables(spark, folder)
    base = scratch_dir(spark, "bench-layout")
    fact = stored(catalog._report_fact(t), f"{base}/plain", cores)
    days = fact.select("order_date").distinct().count()
    layout.write_clustered(
        fact, f"{base}/by_day", ["order_date"], ["customer_id"], ["transaction_id"], tasks=layout.write_width(fact, days)
    )
    by_day = spark.read.parquet(f"{base}/by_day")
    one_day = (F.col("order_date") == F.lit("1998-03-02").cast("date")) & F.col("customer_id").between(100, 900)

    def slice_of(table: DataFrame) -> DataFrame:
        return table.filter(one_day).groupBy("region").agg(F.sum("total_amount").alias("total"), F.count("*").alias("n"))

    for name, table in (("plain", fact), ("by_day", by_day)):
        slice_of(table).collect()
        times[f"day_customer_slice_{name}"] = timed(lambda table=table: slice_of(table).collect(), 5)

    def latest(table: DataFrame, known: bool):
        day = layout.newest(table, "order_date") if known else None
        return bi.latest_day_by_region(table, day).collect()

    for name, table in (("plain", fact), ("by_day", by_day)):
        times[f"latest_day_{name}"] = timed(lambda t=table, k=name == "by_day": latest(t, k), 5)

    # one customer looked up: plain copy against one with page index and Bloom filters, and along a curve
    layout.write_indexed(fact, f"{base}/indexed", "customer_id", fact.select("customer_id").distinct().count())
    layout.recluster(fact, f"{base}/curve", ["customer_id", "order_date"], ["transaction_id"], tasks=cores)
    for name in ("indexed", "curve"):
        table = spark.read.parquet(f"{base}/{name}")
        times[f"customer_point_{name}"] = timed(lambda t=table: spend(t), 5)
    times["customer_point_plain"] = timed(lambda: spend(fact), 5)


def spend(table: DataFrame):
    one = table.filter(F.col("customer_id") == 137)
    return one.agg(F.count("*"), F.sum("total_amount")).collect()


def retail_run(spark: SparkSession, folder: str) -> float:
    """Five CSV drops through bronze, cleaning, upsert, dimensions and data tests."""
    t = inputs.tables(spark, folder)
    base = scratch_dir(spark, "bench-retail")
    drop = (F.year("staged_on") % 5).alias("drop_no")
    layout.land_csv(inputs.bronze(t).select(*pipeline.retail.RAW_COLUMNS, drop), f"{base}/landing", ["drop_no"])
    customers = inputs.customers(t).select("customer_id", "customer_name", "segment")
    products = inputs.bi_products(t).withColumnRenamed("product_key", "product_id")
    start = time.perf_counter()
    pipeline.run_retail(spark, f"{base}/landing/drop_no=*", customers, products, f"{base}/lake", pipeline.MONTHLY_FACT)
    return round(time.perf_counter() - start, 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(
        "bench", f"local[{cores}]", spark_ui_enabled="false", spark_sql_shuffle_partitions=str(cores),
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    star_and_flat(spark, folder, cores, times)
    layouts(spark, folder, cores, times)
    for name in FROM_RAW:
        times[name] = timed(lambda name=name: run(catalog.QUERIES[name](spark, folder)), 3)
    times["retail_run"] = retail_run(spark, folder)
    print(json.dumps({
        "metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
