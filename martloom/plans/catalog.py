"""Registered queries: every operator over the given tables.

Each query takes (spark, folder of parquet tables) and returns a DataFrame.
Decimals leave as double here, so that every client shows the same numbers; the
library itself keeps them decimal. Queries about files, versions and streams
write to a fresh folder under ``spark.checkpoint.dir`` and read back from it.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import calendar, money, text
from martloom.operators import clean, layout, quality, upsert, versions
from martloom.plans import bi, inputs, marts, orders, pipeline, retail
from martloom.session import pinned, scratch_dir, stored
from martloom.sources import feed, files
from martloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Weights per product category, chosen for this catalog.
CATEGORY_WEIGHTS = {
    "ECONOMY": 0.25, "LARGE": 0.15, "MEDIUM": 0.20, "PROMO": 0.10, "SMALL": 0.05, "STANDARD": 0.25,
}


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as double."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def day(text_value: str) -> Column:
    return F.lit(text_value).cast("date")


# ---- BI star -----------------------------------------------------------------


def _first_day(t: inputs.Tables) -> Column:
    return inputs.bi_bounds(t).select("first_day").scalar()


def _bi_fact(t: inputs.Tables, regional: bool = True) -> DataFrame:
    return bi.fact_sales(inputs.bi_lines(t, regional), inputs.bi_products(t), _first_day(t))


def _dated(t: inputs.Tables, regional: bool = False) -> DataFrame:
    """BI fact joined to its date dimension."""
    return _bi_fact(t, regional).join(bi.dim_date(inputs.bi_bounds(t)), "date_key")


def _with_category(sales: DataFrame, t: inputs.Tables) -> DataFrame:
    return sales.join(inputs.bi_products(t).select("product_key", "category"), "product_key")


def _with_region(sales: DataFrame, t: inputs.Tables) -> DataFrame:
    return sales.join(inputs.bi_regions(t), "region_key")


def star_month_category(spark: SparkSession, folder: str) -> DataFrame:
    t = inputs.tables(spark, folder)
    fact = _bi_fact(t, regional=False)
    return plain(bi.star_month_category(fact, bi.dim_date(inputs.bi_bounds(t)), inputs.bi_products(t)))


def _flat(t: inputs.Tables) -> DataFrame:
    return bi.flat_sales(
        _bi_fact(t), bi.dim_date(inputs.bi_bounds(t)), inputs.bi_products(t),
        inputs.bi_regions(t), inputs.bi_customers(t),
    )


def flat_sales(spark, folder):
    return plain(_flat(inputs.tables(spark, folder)))


def flat_month_category(spark, folder):
    return plain(bi.month_category(_flat(inputs.tables(spark, folder))))


def bi_fact_measures(spark, folder):
    return plain(_bi_fact(inputs.tables(spark, folder)))


def category_weight_map(spark, folder):
    t = inputs.tables(spark, folder)
    weight = bi.map_values(CATEGORY_WEIGHTS, F.col("category")).alias("weight")
    return inputs.bi_products(t).select("product_key", "category", weight)


def dim_date_bi(spark, folder):
    return bi.dim_date(inputs.bi_bounds(inputs.tables(spark, folder)))


# ---- BI measures -------------------------------------------------------------


def metric_totals(spark, folder):
    totals = bi.measures(_bi_fact(inputs.tables(spark, folder), regional=False))
    return plain(totals.select("transactions", "total_revenue", "total_profit"))


def metric_aov_margin(spark, folder):
    t = inputs.tables(spark, folder)
    return plain(bi.measures(_with_region(_bi_fact(t), t), ["region_name"]))


def metric_yoy(spark, folder):
    return plain(bi.yearly_growth(_dated(inputs.tables(spark, folder))))


def yoy_same_period(spark, folder):
    t = inputs.tables(spark, folder)
    dates = bi.dim_date(inputs.bi_bounds(t))
    return plain(bi.same_period_last_year(_dated(t), dates, ["year", "month"]))


def metric_category_share(spark, folder):
    t = inputs.tables(spark, folder)
    return plain(bi.category_share(_with_category(_bi_fact(t, regional=False), t)))


def category_contribution(spark, folder):
    t = inputs.tables(spark, folder)
    sales = _with_region(_with_category(_dated(t, regional=True), t), t)
    view = F.col("full_date") >= day("1998-01-01")
    return plain(bi.contribution(sales, "category", ["region_name"], view))


def metric_weekend(spark, folder):
    return bi.weekend_split(_dated(inputs.tables(spark, folder)))


def metric_top_months(spark, folder):
    return bi.top_months(_dated(inputs.tables(spark, folder)))


def trend_month(spark, folder):
    return plain(bi.measures(_dated(inputs.tables(spark, folder)), ["year", "month"]))


def region_segment(spark, folder):
    t = inputs.tables(spark, folder)
    sales = _with_region(_bi_fact(t), t).join(inputs.bi_customers(t), "customer_key")
    return plain(bi.measures(sales, ["region_name", "segment"]))


# ---- operational reports -----------------------------------------------------


def _report_fact(t: inputs.Tables, regional: bool = True) -> DataFrame:
    lines = inputs.regional_lines(t) if regional else inputs.lines(t)
    return lines.withColumn("total_amount", money.line_total("quantity", "unit_price"))


def customer_drilldown(spark, folder):
    t = inputs.tables(spark, folder)
    return plain(bi.customer_spend(_report_fact(t, False), inputs.customers(t), 100, 200))


def customer_point(spark, folder):
    t = inputs.tables(spark, folder)
    return plain(bi.customer_spend(_report_fact(t, False), inputs.customers(t), 137, 137))


def last7_region_daily(spark, folder):
    t = inputs.tables(spark, folder)
    as_of = calendar.day_bounds(t("orders"), "o_orderdate").select("last_day").scalar()
    return plain(bi.last_days_by_region(_report_fact(t), as_of))


def latest_day_region(spark, folder):
    return plain(bi.latest_day_by_region(_report_fact(inputs.tables(spark, folder))))


# ---- cleaning ----------------------------------------------------------------


def _bronze(spark, folder) -> DataFrame:
    return inputs.bronze(inputs.tables(spark, folder))


def _clean(spark, folder) -> DataFrame:
    return retail.clean_sales(_bronze(spark, folder), inputs.last_staged_first())


def clean_sales(spark, folder):
    return plain(_clean(spark, folder).select(*retail.RAW_COLUMNS))


def fact_sales(spark, folder):
    fact = _clean(spark, folder)
    by_text = calendar.date_key_of_text(F.col("order_date").cast("string"))
    return plain(fact.withColumn("date_key_from_text", by_text))


def reject_log(spark, folder):
    return retail.reject_log(_bronze(spark, folder))


def reject_summary(spark, folder):
    rejected = retail.reject_log(_bronze(spark, folder))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


def silver_sales(spark, folder):
    return plain(retail.silver_sales(_bronze(spark, folder), inputs.last_staged_first()))


def dedup_audit(spark, folder):
    return retail.duplicates_by_region(_bronze(spark, folder), F.struct("staged_on", "_p", "_s"))


def audit_counts(spark, folder):
    return retail.audit_counts(_bronze(spark, folder))


def seeded_day(spark, folder):
    """Sales by region of one day that a seed picks."""
    fact = _report_fact(inputs.tables(spark, folder))
    picked = clean.seeded_pick(inputs.tables(spark, folder)("orders").select(F.col("o_orderdate").cast("date").alias("order_date")), "order_date", 42)
    return plain(bi.daily_region(fact.join(picked, "order_date", "left_semi")))


def silver_dims(spark, folder):
    """Customers landed with padded text and, for every tenth, an exact copy without the padding."""
    t = inputs.tables(spark, folder)
    data = inputs.customers(t).select("customer_id", "customer_name", "segment")
    padded = data.select(
        "customer_id",
        F.concat(F.lit("  "), "customer_name").alias("customer_name"),
        F.concat("segment", F.lit(" ")).alias("segment"),
    )
    landed = padded.unionByName(data.filter(F.col("customer_id") % 10 == 0))
    return retail.silver_dimension(landed.withColumn("_ingested_at", F.current_timestamp()))


def dim_date(spark, folder):
    silver = retail.silver_sales(_bronze(spark, folder), inputs.last_staged_first())
    return retail.dim_date(silver)


def dim_date_observed(spark, folder):
    return retail.dim_date_observed(_clean(spark, folder))


# ---- orders marts ------------------------------------------------------------


def _stg(spark, folder) -> DataFrame:
    rows = inputs.feed(inputs.tables(spark, folder))
    return orders.stg_orders(orders.latest_orders(rows, F.desc("order_status")))


def stg_orders(spark, folder):
    """Staging as a view: nothing is written, each reader plans through it."""
    _stg(spark, folder).createOrReplaceTempView("martloom_stg_orders")
    return plain(spark.table("martloom_stg_orders"))


def fct_orders(spark, folder):
    return plain(orders.fct_orders(_stg(spark, folder)))


def dim_customer_activity(spark, folder):
    return orders.dim_customer(_stg(spark, folder))


def marts_incremental(spark, folder):
    """Marts of the orders so far, then two increments: new orders, changed ones, and customers without any left.

    Returned per mart and key: a count, an amount, the first and the last time.
    """
    lake, rows = scratch_dir(spark, "marts"), inputs.feed(inputs.tables(spark, folder))
    late = F.col("modified_at") >= F.lit("1998-01-01").cast("timestamp_ntz")
    change = F.col("order_status") == "returned"
    for part in (rows.filter(~late & ~change), rows.filter(~late & change), rows.filter(late)):
        newest = orders.latest_orders(part, F.desc("order_status")).withColumn("created_month", pipeline.month_of("created_at"))
        by_month = versions.Layout(["created_month"], ["customer_id"], ["order_id"])
        versions.upsert(
            newest, f"{lake}/latest", ["order_id"], by_month, rows_may_move=False,
            newest_first=orders.newest_first(F.desc("order_status")),
        )
        marts.follow(spark, lake, f"{lake}/latest", "month")
    return plain(_marts_digest(*[marts.table(spark, lake, n) for n in ("fct_orders", "dim_customer", "dim_product")]))


def _marts_digest(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    none = F.lit(None).cast("timestamp_ntz")
    days = fact.groupBy(F.col("order_date").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("gross_amount").cast("decimal(28,2)").alias("amount"), F.min("created_at").alias("first_at"), F.max("modified_at").alias("last_at")
    )
    return (
        days.select(F.lit("fct_orders").alias("mart"), "*")
        .unionByName(customers.select(F.lit("dim_customer").alias("mart"), F.col("customer_id").alias("key"), F.col("lifetime_order_count").alias("n"), F.lit(None).cast("decimal(28,2)").alias("amount"), F.col("first_order_at").alias("first_at"), F.col("last_order_at").alias("last_at")))
        .unionByName(products.select(F.lit("dim_product").alias("mart"), F.concat_ws("/", "product_id", "category").alias("key"), F.col("times_ordered").alias("n"), F.col("current_unit_price").cast("decimal(28,2)").alias("amount"), none.alias("first_at"), none.alias("last_at")))
    )


def dim_product_current(spark, folder):
    return plain(orders.dim_product(_stg(spark, folder)))


def dim_date_orders(spark, folder):
    return orders.dim_date(_stg(spark, folder))


# ---- feed and marks ----------------------------------------------------------


def feed_increment(spark, folder):
    rows = inputs.feed(inputs.tables(spark, folder))
    return plain(feed.extract_since(rows, "2001-01-01 00:00:00"))


def feed_pages(spark, folder):
    rows = inputs.feed(inputs.tables(spark, folder))
    return feed.page_summary(rows, ["modified_at", "order_id"], 200)


def feed_page_slice(spark, folder):
    rows = inputs.feed(inputs.tables(spark, folder))
    return plain(feed.page_slice(rows, ["modified_at", "order_id"], 400, 200))


def feed_page_seek(spark, folder):
    """The third page of the feed, reached by the cursors of the pages before it."""
    rows, order = inputs.feed(inputs.tables(spark, folder)), ["modified_at", "order_id"]
    cursor = None
    for _ in range(2):
        cursor = feed.cursor_of(feed.page_after(rows, order, cursor, 200), order)
    return plain(feed.page_after(rows, order, cursor, 200))


def hwm_lookup(spark, folder):
    """Marks of two loaded tables, and of one that was never loaded."""
    names = spark.createDataFrame([("orders",), ("lines",), ("returns",)], "table_name string")
    return feed.hwm_lookup(inputs.control(inputs.tables(spark, folder)), names)


def hwm_advance(spark, folder):
    t = inputs.tables(spark, folder)
    names = spark.createDataFrame([("orders",), ("lines",), ("returns",)], "table_name string")
    old = feed.hwm_lookup(inputs.control(t), names)
    seen = t("orders").select(F.lit("orders").alias("table_name"), F.col("o_orderdate").alias("modified_at"))
    seen = seen.unionByName(
        t("lineitem").select(F.lit("lines").alias("table_name"), F.col("l_shipdate").alias("modified_at"))
    )
    return feed.next_hwm(seen, old)


def id_overlap(spark, folder):
    """Ids of lines shipped before 1998 and from 1998 on, and how many occur in both."""
    t = inputs.tables(spark, folder)
    ids = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id")
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    per_id = t("lineitem").select(ids, early.alias("early")).groupBy("transaction_id")
    per_id = per_id.agg(F.bool_or("early").alias("b"), F.bool_or(~F.col("early")).alias("a"))
    counts = per_id.agg(F.count_if("b").alias("before"), F.count_if("a").alias("after"), F.count_if(F.col("a") & F.col("b")).alias("both"))
    return counts.select(F.stack(F.lit(3), *[x for n in counts.columns for x in (F.lit(n), F.col(n))]).alias("part", "ids"))


# ---- files -------------------------------------------------------------------


def _land_sales(spark, folder, label: str) -> str:
    """Bronze rows as CSV drops, one folder per year of staging."""
    path = scratch_dir(spark, label)
    rows = _bronze(spark, folder).withColumn("drop_year", F.year("staged_on"))
    layout.land_csv(rows.select(*retail.RAW_COLUMNS, "drop_year"), path, ["drop_year"])
    return path


def scan_csv_raw(spark, folder):
    landed = _land_sales(spark, folder, "csv")
    rows = files.with_lineage(files.read_csv_raw(spark, landed, retail.RAW_COLUMNS))
    drop = F.regexp_extract(files.SOURCE_FILE, r"drop_year=(\d+)/[^/]+\.csv$", 1)
    absolute = F.col(files.SOURCE_FILE).startswith("/").alias("plain_path")
    return rows.select(*retail.RAW_COLUMNS, drop.cast("int").alias("drop_year"), absolute)


def scan_json_pages(spark, folder):
    """The feed landed as JSON arrays of up to 1000 rows, one file per page, and read back."""
    path = scratch_dir(spark, "pages")
    rows = inputs.feed(inputs.tables(spark, folder))
    pages = feed.page_arrays(rows, ["modified_at", "order_id"], 1000)
    layout.land_json_pages(pages, path, day("2026-07-01"))
    back = files.read_json_pages(spark, path, orders.FEED, arrays=True)
    return plain(orders.typed_feed(back))


def land_json_roundtrip(spark, folder):
    """Rows and files per run date after landing JSON lines, 200 rows per file at most."""
    path = scratch_dir(spark, "jsonl")
    rows = inputs.feed(inputs.tables(spark, folder))
    layout.land_json(rows, path, F.trunc("modified_at", "year"))
    back = files.read_json_pages(spark, path, orders.FEED, arrays=False)
    per_file = back.groupBy("run_date", F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("unit_price").alias("amount")
    )
    result = per_file.groupBy("run_date").agg(
        F.sum("n").alias("landed_rows"), F.sum("amount").alias("amount"), (F.max("n") <= 200).alias("within_page_size")
    )
    return plain(result.withColumn("run_date", F.col("run_date").cast("date")))


STAGING = {
    "transaction_id": "TransactionID", "customer_id": "CustomerID", "product_id": "ProductID",
    "order_date": "OrderDate", "quantity": "Quantity", "unit_price": "UnitPrice", "region": "Region",
}


def staging_mapped(spark, folder):
    """Truncate-and-insert staging: explicit column mapping, whole replacement."""
    path = scratch_dir(spark, "staging")
    rows = _bronze(spark, folder)
    versions.publish(layout.mapped(rows.limit(0), STAGING), path, "truncate")
    versions.publish(layout.mapped(rows, STAGING), path, "insert")
    return versions.read(spark, path)


def _drops_of(found: DataFrame) -> DataFrame:
    return found.select(F.regexp_extract("path", r"drop_year=(\d+)", 1).cast("int").alias("drop_year")).distinct()


def files_modified_after(spark, folder):
    """Drops that landed after the last change of an earlier batch, found by their time of change."""
    rows = _bronze(spark, folder).withColumn("drop_year", F.year("staged_on")).select(*retail.RAW_COLUMNS, "drop_year")
    path = scratch_dir(spark, "modified")
    layout.land_csv(rows.filter("drop_year < 1999"), f"{path}/early", ["drop_year"])
    last = files.list_files(spark, path).agg(F.max("modified_at").alias("m")).first().m
    # the reader's cut-off has whole seconds and the session's zone
    cut = last.replace(microsecond=0) + dt.timedelta(seconds=1)
    time.sleep(max(0.0, cut.timestamp() + 0.1 - time.time()))
    layout.land_csv(rows.filter("drop_year >= 1999"), f"{path}/late", ["drop_year"])
    return _drops_of(files.list_files(spark, path, cut.astimezone(dt.UTC).strftime("%Y-%m-%dT%H:%M:%S")))


def new_files_anti(spark, folder):
    """Landed drops that are not among the files known so far."""
    landed = _land_sales(spark, folder, "unseen")
    known = files.list_files(spark, f"{landed}/drop_year=199[0-8]")
    return _drops_of(files.unseen(files.list_files(spark, landed), known))


def _rows_per_drop(landed: DataFrame) -> DataFrame:
    drop = F.regexp_extract(files.SOURCE_FILE, r"drop_year=(\d+)", 1).cast("int").alias("drop_year")
    return landed.groupBy(drop).agg(F.count(F.lit(1)).alias("landed_rows"))


def incremental_append(spark, folder):
    """CSV drops loaded in two runs and a third that finds nothing; rows per drop."""
    landed, lake = _land_sales(spark, folder, "drops"), scratch_dir(spark, "lake")
    pipeline.ingest_csv(spark, f"{landed}/drop_year=199[0-8]", lake, "bronze", retail.RAW_COLUMNS)
    for _ in range(2):
        pipeline.ingest_csv(spark, f"{landed}/drop_year=*", lake, "bronze", retail.RAW_COLUMNS)
    drop = F.regexp_extract(files.SOURCE_FILE, r"drop_year=(\d+)", 1).cast("int").alias("drop_year")
    return versions.read(spark, f"{lake}/bronze").groupBy(drop).agg(F.count(F.lit(1)).alias("landed_rows"))


def ingest_after_crash(spark, folder):
    """Rows per drop after three runs, the second of which died before its version became visible."""
    landed, lake = _land_sales(spark, folder, "drops"), scratch_dir(spark, "lake")
    pipeline.ingest_csv(spark, f"{landed}/drop_year=199[0-6]", lake, "bronze", retail.RAW_COLUMNS)
    lost = pipeline.new_files(spark, f"{landed}/drop_year=199[7-8]", lake, "bronze")
    files.record(lost, f"{lake}/bronze_files", 2, "lost")
    for years in ("1999", "*", "*"):
        pipeline.ingest_csv(spark, f"{landed}/drop_year={years}", lake, "bronze", retail.RAW_COLUMNS)
    return _rows_per_drop(versions.read(spark, f"{lake}/bronze"))


def crash_then_restore(spark, folder):
    """Rows per drop where a run died after it noted its files, and a restore took the number of its version."""
    landed, lake = _land_sales(spark, folder, "drops"), scratch_dir(spark, "lake")
    pipeline.ingest_csv(spark, f"{landed}/drop_year=199[0-6]", lake, "bronze", retail.RAW_COLUMNS)
    lost = pipeline.new_files(spark, f"{landed}/drop_year=199[7-8]", lake, "bronze")
    files.record(lost, f"{lake}/bronze_files", 2, "lost")
    versions.restore(spark, f"{lake}/bronze", 1)
    for _ in range(2):
        pipeline.ingest_csv(spark, f"{landed}/drop_year=*", lake, "bronze", retail.RAW_COLUMNS)
    return _rows_per_drop(versions.read(spark, f"{lake}/bronze"))


def restore_then_run(spark, folder):
    """Transactions of the fact after a drop, another drop, a restore of the first version, and one more run."""
    landed, lake = _land_sales(spark, folder, "drops"), scratch_dir(spark, "lake")
    for years in ("199[0-7]", "*"):
        pipeline.ingest_csv(spark, f"{landed}/drop_year={years}", lake, "bronze_sales", retail.RAW_COLUMNS)
        pipeline.merge_fact(spark, lake, pipeline.MONTHLY_FACT)
    versions.restore(spark, f"{lake}/fact_sales", 1)
    pipeline.merge_fact(spark, lake, pipeline.MONTHLY_FACT)
    return versions.read(spark, f"{lake}/fact_sales").select("transaction_id")


def snapshot_refresh(spark, folder):
    """Bronze snapshot of a relational table, replaced as a whole by a second load."""
    lake = scratch_dir(spark, "refresh")
    t = inputs.tables(spark, folder)
    pipeline.refresh_snapshot(t("customer").filter("c_custkey % 2 = 0"), lake, "bronze_customers")
    pipeline.refresh_snapshot(t("customer"), lake, "bronze_customers")
    return versions.read(spark, f"{lake}/bronze_customers").drop(files.INGESTED_AT)


def layout_pruned_scan(spark, folder):
    """One day and a customer range out of a table kept by day and sorted by customer."""
    t = inputs.tables(spark, folder)
    stored = _fact_by_day(spark, t)
    one_day = stored.filter((F.col("order_date") == day("1998-03-02")) & F.col("customer_id").between(100, 900))
    return plain(one_day.groupBy("region").agg(F.sum("total_amount").alias("total"), F.count(F.lit(1)).alias("n")))


def _fact_by_day(spark, t: inputs.Tables) -> DataFrame:
    path = scratch_dir(spark, "layout")
    days = inputs.bi_bounds(t).select(F.date_diff("last_day", "first_day").alias("n")).first().n or 0
    width = layout.write_width(t("lineitem"), days + 1)
    layout.write_clustered(_report_fact(t), path, ["order_date"], ["customer_id"], ["transaction_id"], tasks=width)
    return spark.read.parquet(path)


def latest_day_stored(spark, folder):
    """The last day of a fact kept by day, found in the names of its folders; no other day is opened."""
    stored = _fact_by_day(spark, inputs.tables(spark, folder))
    return plain(bi.latest_day_by_region(stored, layout.newest(stored, "order_date")))


def layout_optimized(spark, folder):
    """A stored fact written anew along a curve through customer and day; slices by either column."""
    t = inputs.tables(spark, folder)
    before, after = scratch_dir(spark, "stored"), scratch_dir(spark, "curve")
    _report_fact(t).write.parquet(before)
    layout.recluster(spark.read.parquet(before), after, ["customer_id", "order_date"], ["transaction_id"])
    stored = spark.read.parquet(after)
    slices = {
        "customers": F.col("customer_id").between(100, 200),
        "days": F.col("order_date").between(day("1998-03-01"), day("1998-03-31")),
        "all": F.lit(True),
    }
    parts = [
        stored.filter(rows).agg(F.lit(name).alias("slice"), F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total"))
        for name, rows in slices.items()
    ]
    return plain(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def customer_indexed(spark, folder):
    """Spend of one customer with sales and of one without, looked up in a fact with page index and Bloom filters."""
    t = inputs.tables(spark, folder)
    path = scratch_dir(spark, "indexed")
    customers = inputs.customers(t)
    layout.write_indexed(_report_fact(t, False), path, "customer_id", customers.count())
    stored = spark.read.parquet(path)
    found = [bi.customer_spend(stored, customers, key, key) for key in (137, 138)]
    return plain(found[0].unionByName(found[1]))


# ---- upserts and versions ----------------------------------------------------


def _merge_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Fact before 2000, and corrected rows from 1999 on.

    The cleaned fact is stored once: both sides, and the merge itself, read it.
    """
    fact = stored(_clean(spark, folder), "cleaned")
    more = fact.filter(F.col("order_date") >= day("1999-01-01")).withColumn("quantity", F.col("quantity") + 1)
    source = more.withColumn("total_amount", money.line_total("quantity", "unit_price"))
    return fact.filter(F.col("order_date") < day("2000-01-01")), source


def merge_upsert(spark, folder):
    return plain(upsert.merge_upsert(*_merge_sides(spark, folder), ["transaction_id"]))


def merge_partial_update(spark, folder):
    """The source also brings other regions; only quantity and total are taken over."""
    target, source = _merge_sides(spark, folder)
    source = source.withColumn("region", F.lit("ELSEWHERE"))
    return plain(upsert.merge_partial(target, source, ["transaction_id"], ["quantity", "total_amount"]))


def merge_matches(spark, folder):
    """Stored rows that an increment touches, found through a Bloom filter of its keys, per region."""
    target, source = _merge_sides(spark, folder)
    keys = ["transaction_id"]
    near = upsert.may_match(target, upsert.key_filter(source, keys), keys)
    hits = near.join(source.select(*keys), keys, "left_semi")
    return plain(hits.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total")))


def merge_counts(spark, folder):
    return upsert.merge_counts(*_merge_sides(spark, folder), ["transaction_id"])


def merge_stamped(spark, folder):
    """Rows per day of loading after a merge that repeats some rows, changes some and adds some."""
    target, source = _merge_sides(spark, folder)
    again = target.filter("transaction_id % 7 = 0 and order_date < date'1999-01-01'")
    stored = target.withColumn("loaded_at", F.lit("2026-01-01").cast("timestamp_ntz"))
    stamp = F.lit("2026-02-01").cast("timestamp_ntz")
    merged = upsert.merge_stamped(stored, source.unionByName(again), ["transaction_id"], stamp)
    counts = merged.groupBy(F.to_date("loaded_at").alias("loaded_on"), "region")
    return plain(counts.agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("total_quantity")))


def dim_csv_upsert(spark, folder):
    """A customer dimension from a CSV file whose columns stand in another order, then changed by a second file."""
    out = scratch_dir(spark, "reference")
    stored = inputs.customers(inputs.tables(spark, folder)).select("customer_id", "customer_name", "segment")
    changed = stored.filter("customer_id % 10 = 0").withColumn("segment", F.lit("CHANGED"))
    layout.land_csv(stored.select("segment", "customer_id", "customer_name"), f"{out}/one")
    layout.land_csv(changed.select("customer_name", "segment", "customer_id"), f"{out}/two")
    one, two = (files.read_reference_csv(spark, f"{out}/{n}", stored.schema) for n in ("one", "two"))
    return upsert.merge_upsert(one, upsert.small_side(pinned(two)), ["customer_id"])


def dim_type1_upsert(spark, folder):
    t = inputs.tables(spark, folder)
    target = inputs.customers(t).select("customer_id", "customer_name", "segment")
    changed = target.filter("customer_id % 10 = 0").withColumn("segment", F.lit("CHANGED"))
    added = target.filter("customer_id % 30 = 7").withColumn("customer_id", F.col("customer_id") + 1_000_000_000)
    return upsert.merge_upsert(target, changed.unionByName(added), ["customer_id"])


def insert_missing(spark, folder):
    fact = pinned(_clean(spark, folder).select("order_date").distinct())  # one row per day
    stored = retail.dim_date(fact).filter(F.col("full_date") < day("1999-01-01"))
    marked = stored.withColumn("origin", F.lit("stored"))
    observed = retail.dim_date_observed(fact).withColumn("origin", F.lit("added"))
    return upsert.insert_missing(marked, observed, ["date_key"])


def _versioned(spark, folder) -> str:
    """Version 1 loads the target, 2 merges the source, 3 restores 1."""
    path = scratch_dir(spark, "versions")
    target, source = _merge_sides(spark, folder)
    month, monthly = pipeline.month_of("order_date"), pipeline.MONTHLY_FACT
    versions.publish(target.withColumn("order_month", month), path, "load", monthly)
    versions.upsert(source.withColumn("order_month", month), path, ["transaction_id"], monthly)
    versions.restore(spark, path, 1)
    return path


def snapshot_current(spark, folder):
    return plain(versions.read(spark, _versioned(spark, folder)))


def snapshot_as_of(spark, folder):
    return plain(versions.read(spark, _versioned(spark, folder), version=2))


def snapshot_history(spark, folder):
    """Versions with operation and row count, and the quantities they hold."""
    path = _versioned(spark, folder)
    sums = [
        versions.read(spark, path, v).agg(F.sum("quantity").alias("total_quantity")).withColumn("version", F.lit(v))
        for v in (1, 2, 3)
    ]
    together = sums[0].unionByName(sums[1]).unionByName(sums[2])
    return versions.history(spark, path).select("version", "operation", "row_count").join(together, "version")


def snapshot_restore(spark, folder):
    """What a restore of version 2 on top of the restore of version 1 brings back."""
    path = _versioned(spark, folder)
    versions.restore(spark, path, 2)
    back = versions.read(spark, path)
    return back.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("total_quantity"))


# ---- data tests --------------------------------------------------------------


def _feed(spark, folder) -> DataFrame:
    return inputs.feed(inputs.tables(spark, folder))


def dq_not_null(spark, folder):
    return quality.not_null(_feed(spark, folder), "feed", ["order_id", "customer_id", "quantity"])


def dq_unique(spark, folder):
    return quality.unique(_feed(spark, folder), "feed", "order_id").unionByName(
        quality.unique(_stg(spark, folder), "stg_orders", "order_id")
    )


def dq_accepted_values(spark, folder):
    rows = _feed(spark, folder)
    return quality.accepted_values(rows, "feed", "order_status", ["completed", "returned"]).unionByName(
        quality.accepted_values(_stg(spark, folder), "stg_orders", "order_status", orders.STATUSES)
    )


def dq_relationships(spark, folder):
    t = inputs.tables(spark, folder)
    large = t("part").filter("p_size > 10")
    return quality.relationships(t("lineitem"), "lineitem", "l_partkey", large, "p_partkey").unionByName(
        quality.relationships(t("lineitem"), "lineitem", "l_orderkey", t("orders"), "o_orderkey")
    )


def retail_suite(spark, folder):
    """Keys of the star schema after an increment that repeats keys of 1999 and has customers nobody knows."""
    t = inputs.tables(spark, folder)
    stored, added = _merge_sides(spark, folder)
    unknown = F.when(F.col("transaction_id") % 100 == 3, F.col("customer_id") + 1_000_000_000).otherwise(F.col("customer_id"))
    added = pinned(added.withColumn("customer_id", unknown.cast("int")))
    customers, products = inputs.customers(t), inputs.bi_products(t).withColumnRenamed("product_key", "product_id")
    return quality.suite([
        quality.still_unique(stored, added, "fact_sales", "transaction_id"),
        quality.not_null(added, "fact_sales", retail.FACT_COLUMNS[:-1]),
        quality.still_related(stored, added, "fact_sales", "customer_id", customers, "customer_id"),
        quality.still_related(stored, added, "fact_sales", "product_id", products, "product_id", gone=products.filter("product_id < 0")),
    ])


def dq_suite(spark, folder):
    """Staging and marts written, then the 19 tests on the stored tables."""
    return pipeline.publish_marts(_stg(spark, folder), scratch_dir(spark, "marts"))


# ---- streams -----------------------------------------------------------------


def stream_file_ingest(spark, folder):
    """CSV drops streamed into bronze; a second run over the same checkpoint adds nothing."""
    landed, out = _land_sales(spark, folder, "stream"), scratch_dir(spark, "stream-out")
    for _ in range(2):
        stream = jobs.stream_files(
            spark, f"{landed}/drop_year=*", files.text_schema(retail.RAW_COLUMNS), "csv",
            header="true", escape="\\",
        )
        jobs.ingest(stream, f"{out}/bronze", f"{out}/checkpoint")
    drop = F.regexp_extract(files.SOURCE_FILE, r"drop_year=(\d+)", 1).cast("int").alias("drop_year")
    return spark.read.parquet(f"{out}/bronze").groupBy(drop).agg(F.count(F.lit(1)).alias("landed_rows"))


def stream_json_pages(spark, folder):
    """Pages of the feed landed in two turns, an empty one among them, and streamed into bronze; a third run adds nothing."""
    out = scratch_dir(spark, "stream-pages")
    rows = inputs.feed(inputs.tables(spark, folder))
    pages = pinned(feed.page_arrays(rows, ["modified_at", "order_id"], 1000))
    empty = pages.limit(1).select("page", F.filter("rows", lambda _: F.lit(False)).alias("rows"))
    turns = [pages.filter("page % 2 = 0").unionByName(empty), pages.filter("page % 2 = 1"), pages.limit(0)]
    for i, turn in enumerate(turns):
        layout.land_json_pages(turn, f"{out}/landing", day(f"2026-07-0{i + 1}"))
        jobs.ingest(jobs.json_pages(spark, f"{out}/landing/run_date=*", orders.FEED), f"{out}/bronze", f"{out}/checkpoint")
    return plain(orders.typed_feed(spark.read.parquet(f"{out}/bronze").select(*orders.FEED_COLUMNS)))


def stream_hourly_counts(spark, folder):
    out = scratch_dir(spark, "hourly")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # As a glob the path may be one file or a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    jobs.write_hourly(events, f"{out}/hours", f"{out}/checkpoint")
    hours = spark.read.parquet(f"{out}/hours")
    return plain(
        hours.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz")).drop("hour_end")
    )


def stream_upsert(spark, folder):
    """The feed landed in two drops; each drop is merged as a micro-batch, newest version wins."""
    base = scratch_dir(spark, "stream-upsert")
    rows = inputs.feed(inputs.tables(spark, folder))
    first = F.col("modified_at") < F.lit("1998-01-01").cast("timestamp_ntz")
    for drop, run_date in ((rows.filter(first), "2026-07-01"), (rows.filter(~first), "2026-07-02")):
        layout.land_json(drop, f"{base}/landing", day(run_date), page_size=1_000_000)
        stream = jobs.stream_files(spark, f"{base}/landing/run_date=*", _feed_schema(), "json")
        jobs.upsert_stream(
            stream, f"{base}/latest", f"{base}/checkpoint", ["order_id"],
            orders.newest_first(F.desc("order_status")),
            prepare=lambda b: orders.typed_feed(b.select(*orders.FEED_COLUMNS)).withColumn(
                "created_year", F.year("created_at")
            ),
            layout=versions.Layout(["created_year"], ["customer_id"], ["order_id"]),
            rows_may_move=False,
        )
    return plain(orders.stg_orders(versions.read(spark, f"{base}/latest")))


def _feed_schema() -> T.StructType:
    return T.StructType.fromDDL(orders.FEED)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        star_month_category, flat_sales, flat_month_category, bi_fact_measures, category_weight_map, dim_date_bi,
        metric_totals, metric_aov_margin, metric_yoy, yoy_same_period, metric_category_share,
        category_contribution, metric_weekend, metric_top_months, trend_month, region_segment,
        customer_drilldown, customer_point, last7_region_daily, latest_day_region,
        clean_sales, fact_sales, reject_log, reject_summary, silver_sales, dedup_audit, audit_counts, silver_dims,
        dim_date, dim_date_observed, seeded_day,
        stg_orders, fct_orders, dim_customer_activity, dim_product_current, dim_date_orders,
        marts_incremental,
        feed_increment, feed_pages, feed_page_slice, feed_page_seek, hwm_lookup, hwm_advance, id_overlap,
        scan_csv_raw, scan_json_pages, land_json_roundtrip, staging_mapped, files_modified_after, new_files_anti,
        incremental_append, ingest_after_crash, crash_then_restore, restore_then_run, snapshot_refresh, layout_pruned_scan,
        latest_day_stored, layout_optimized, customer_indexed,
        merge_upsert, merge_partial_update, merge_counts, merge_matches, merge_stamped, dim_type1_upsert, dim_csv_upsert, insert_missing,
        snapshot_current, snapshot_as_of, snapshot_history, snapshot_restore,
        dq_not_null, dq_unique, dq_accepted_values, dq_relationships, dq_suite, retail_suite,
        stream_file_ingest, stream_json_pages, stream_hourly_counts, stream_upsert,
    )
}
