"""The two end-to-end runs. Each step is a Spark job; a failed data test stops the run."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import quality, versions
from martloom.operators.layout import land_json
from martloom.operators.versions import Layout
from martloom.plans import marts, orders, retail
from martloom.session import pinned
from martloom.sources import feed, files

# Facts are kept per day and sorted by customer inside: reports cut by date first
# and by customer second, and an increment rewrites the days it brings. Tables
# with little per day are better kept per month.
DAILY_FACT = Layout(["order_date"], ["customer_id"], ["transaction_id"])
MONTHLY_FACT = Layout(["order_month"], ["customer_id"], ["transaction_id"])
DAILY_ORDERS = Layout(["created_day"], ["customer_id"], ["order_id"])


def month_of(day: str):
    return (F.year(day) * 100 + F.month(day)).cast("int")


# ---- bronze ----------------------------------------------------------------


def new_files(spark: SparkSession, glob: str, lake: str, table: str) -> DataFrame:
    """Landed files that no version of the bronze table holds yet."""
    seen = files.ledger(spark, f"{lake}/{table}_files", versions.held(spark, f"{lake}/{table}"))
    return files.unseen(files.list_files(spark, glob), seen)


def literal_path(path: str) -> str:
    """A path that a reader does not take for a pattern."""
    return "".join("\\" + c if c in "\\[]{}*?" else c for c in path)


def _store(rows: DataFrame, fresh: DataFrame, lake: str, table: str) -> int:
    """Append rows under the next version number, which their files are noted under before it becomes visible."""
    spark = rows.sparkSession
    version = (versions.latest_version(spark, f"{lake}/{table}") or 0) + 1
    run = uuid.uuid4().hex
    files.record(fresh, f"{lake}/{table}_files", version, run)
    return versions.append(rows, f"{lake}/{table}", writer="files", batch_id=version, run=run).inserted


def ingest_csv(
    spark: SparkSession, glob: str, lake: str, table: str, columns: Sequence[str]
) -> int:
    """Append the rows of unseen CSV files as text with lineage. Returns the number of rows.

    The driver holds the paths of the new files only.
    """
    fresh = pinned(new_files(spark, glob, lake, table))
    paths = [literal_path(r.path) for r in fresh.select("path").collect()]
    if not paths:
        return 0
    return _store(files.with_lineage(files.read_csv_raw(spark, paths, columns)), fresh, lake, table)


def ingest_json(
    spark: SparkSession, landing: str, lake: str, table: str, schema: str, arrays: bool = False
) -> int:
    """The same for JSON pages below ``run_date=*/``; empty pages count as loaded."""
    fresh = pinned(new_files(spark, landing, lake, table))
    paths = [literal_path(r.path) for r in fresh.select("path").collect()]
    if not paths:
        return 0
    rows = files.with_lineage(files.read_json_pages(spark, landing, schema, paths, arrays))
    return _store(rows, fresh, lake, table)


def refresh_snapshot(snapshot: DataFrame, lake: str, table: str) -> int:
    """Replace the bronze copy of a relational table."""
    stamped = snapshot.withColumn(files.INGESTED_AT, F.current_timestamp())
    return versions.publish(stamped, f"{lake}/{table}", "snapshot").inserted


def unprocessed(spark: SparkSession, bronze: str, table: str) -> tuple[DataFrame | None, int]:
    """Bronze rows that ``table`` has not merged yet, and the bronze version they reach up to.

    The table notes with each version how far it got, so a run that died after
    bronze is made up for by the next one.
    """
    newest = versions.latest_version(spark, bronze) or 0
    done = versions.last_batch(spark, table, "bronze")
    if newest <= done:
        return None, done
    return versions.added_since(spark, bronze, done), newest


def merge_fact(spark: SparkSession, lake: str, layout: Layout) -> None:
    """Clean what bronze holds beyond the fact's mark, and upsert it."""
    fresh, batch = unprocessed(spark, f"{lake}/bronze_sales", f"{lake}/fact_sales")
    if fresh is None:
        return
    fact = retail.clean_sales(fresh, files.newest_landed_first())
    if "order_month" in layout.partition_by:
        fact = fact.withColumn("order_month", month_of("order_date"))
    versions.upsert(fact, f"{lake}/fact_sales", ["transaction_id"], layout, writer="bronze", batch_id=batch)


# ---- retail run --------------------------------------------------------------


def retail_tests(fact: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame) -> list[DataFrame]:
    """Primary and foreign keys of the star schema, and the columns that must have a value."""
    return [
        quality.unique(fact, "fact_sales", "transaction_id"),
        quality.unique(customers, "dim_customer", "customer_id"),
        quality.unique(products, "dim_product", "product_id"),
        quality.unique(dates, "dim_date", "date_key"),
        quality.not_null(fact, "fact_sales", retail.FACT_COLUMNS[:-1]),
        quality.relationships(fact, "fact_sales", "customer_id", customers, "customer_id"),
        quality.relationships(fact, "fact_sales", "product_id", products, "product_id"),
        quality.relationships(fact, "fact_sales", "date_key", dates, "date_key"),
    ]


def run_retail(
    spark: SparkSession,
    landing_glob: str,
    customers: DataFrame,
    products: DataFrame,
    lake: str,
    fact_layout: Layout = DAILY_FACT,
) -> DataFrame:
    """CSV drops and two relational snapshots to a tested star schema.

    Only rows of new files are cleaned and merged: a later file wins over an
    earlier one for the same transaction, so merging increments gives what
    cleaning everything again would. Returns the data test results.
    """
    ingest_csv(spark, landing_glob, lake, "bronze_sales", retail.RAW_COLUMNS)
    refresh_snapshot(customers, lake, "bronze_customers")
    refresh_snapshot(products, lake, "bronze_products")

    fresh, batch = unprocessed(spark, f"{lake}/bronze_sales", f"{lake}/rejects")
    if fresh is not None:
        rejected = retail.stamped_rejects(retail.reject_log(fresh))
        versions.append(rejected, f"{lake}/rejects", writer="bronze", batch_id=batch)
    merge_fact(spark, lake, fact_layout)

    for name in ("customers", "products"):
        silver = retail.silver_dimension(versions.read(spark, f"{lake}/bronze_{name}"))
        versions.publish(silver, f"{lake}/dim_{name[:-1]}", "snapshot")
    fact = versions.read(spark, f"{lake}/fact_sales")
    if fact is None:
        raise ValueError("nothing has landed yet")
    versions.publish(retail.dim_date(fact), f"{lake}/dim_date", "snapshot")
    return quality.run_suite(
        retail_tests(fact, *[versions.read(spark, f"{lake}/dim_{n}") for n in ("customer", "product", "date")])
    )


# ---- orders run --------------------------------------------------------------


def land_increment(
    source: DataFrame, landing: str, control: str, name: str = "orders", page_size: int = 100_000
) -> int:
    """Land what changed since the stored mark as JSON pages; advance the mark last."""
    spark = source.sparkSession
    old = feed.hwm_value(feed.read_control(spark, control), name)
    increment = pinned(feed.extract_since(source, old))
    seen = increment.agg(F.max("modified_at").alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not seen.n:
        return 0
    ordered = increment.repartitionByRange("modified_at", "order_id").sortWithinPartitions("modified_at", "order_id")
    land_json(ordered, landing, F.current_date(), page_size)
    feed.hwm_advance(spark, control, name, seen.m)
    return seen.n


def run_orders(spark: SparkSession, source: DataFrame, landing: str, lake: str) -> DataFrame:
    """Change feed to four tested marts, which take over the changed days only. Returns the data test results.

    The table of newest versions keeps orders whose newest version lacks a
    customer; staging filters them afterwards, as its rule demands.
    """
    land_increment(source, landing, f"{lake}/hwm")
    ingest_json(spark, landing, lake, "bronze_orders", orders.FEED)
    fresh, batch = unprocessed(spark, f"{lake}/bronze_orders", f"{lake}/orders_latest")
    if fresh is not None:
        tiebreak = files.newest_landed_first()
        newest = orders.latest_orders(fresh, *tiebreak).withColumn("created_day", F.to_date("created_at"))
        columns = [*orders.FEED_COLUMNS, "created_day", files.INGESTED_AT]
        versions.upsert(
            newest.select(columns), f"{lake}/orders_latest", ["order_id"], DAILY_ORDERS,
            newest_first=orders.newest_first(F.desc(files.INGESTED_AT)), rows_may_move=False,
            writer="bronze", batch_id=batch,
        )
    if not versions.exists(spark, f"{lake}/orders_latest"):
        raise ValueError("nothing has landed yet")
    marts.follow(spark, lake, f"{lake}/orders_latest")
    versions.publish(marts.dim_date(spark, lake), f"{lake}/dim_date", "model")
    names = ("stg_orders", "fct_orders", "dim_customer", "dim_product", "dim_date")
    return quality.run_suite(orders.data_tests({n: marts.table(spark, lake, n) for n in names}))


def publish_marts(stg: DataFrame, lake: str) -> DataFrame:
    """Write staging, then the marts from the stored staging rows, then test them."""
    spark = stg.sparkSession
    versions.publish(stg, f"{lake}/stg_orders", "model")
    stored = {"stg_orders": versions.read(spark, f"{lake}/stg_orders")}
    for name, mart in orders.marts(stored["stg_orders"]).items():
        if name != "stg_orders":
            versions.publish(mart, f"{lake}/{name}", "model")
            stored[name] = versions.read(spark, f"{lake}/{name}")
    return quality.run_suite(orders.data_tests(stored))
