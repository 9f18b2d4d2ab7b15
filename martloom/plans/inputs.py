"""Retail inputs derived from the given parquet tables.

The given tables are clean; the dirt of real landings (blank customers, ids and
dates that do not parse, float-like quantities, padded regions) is put in by
rule, so that any engine derives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import calendar

Tables = Callable[[str], DataFrame]


def tables(spark: SparkSession, folder: str) -> Tables:
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


# ---- retail ----------------------------------------------------------------


def lines(t: Tables) -> DataFrame:
    """Sales lines: line item with its order and the list price of its part."""
    order_days = t("orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    prices = t("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
    )
    return (
        order_lines(t)
        .join(order_days, "l_orderkey")
        .join(prices, "product_id")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            "customer_id", "product_id", "l_suppkey", "order_date", "quantity", "unit_price",
            "discount_pct", "staged_on",
        )
    )


def order_lines(t: Tables) -> DataFrame:
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("product_id"),
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
        F.col("l_shipdate").cast("date").alias("staged_on"),
    )


def customers(t: Tables) -> DataFrame:
    """Customers with their region, through nation."""
    regions = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t("customer")
        .join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            (F.col("r_regionkey") + 1).alias("region_key"),
        )
    )


def regional_lines(t: Tables) -> DataFrame:
    """Lines with the region of their customer.

    The dimensions are joined one after the other and not among themselves
    first: each join then sees the true size of a stored table.
    """
    return (
        lines(t)
        .join(t("customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey"), "customer_id")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .drop("c_nationkey", "n_nationkey", "n_name", "n_regionkey", "r_regionkey")
        .withColumnRenamed("r_name", "region")
    )


def bronze(t: Tables) -> DataFrame:
    """Landed sales, all text, with dirt; staged_on, _p and _s order the versions of an id."""
    base = regional_lines(t)
    dirt = (F.col("transaction_id") + F.col("product_id")) % 33
    text = {c: F.col(c).cast("string") for c in base.columns}
    return base.select(
        F.when(F.col("product_id") % 89 == 3, F.concat(F.lit("x"), text["transaction_id"]))
        .otherwise(text["transaction_id"]).alias("transaction_id"),
        F.when(dirt == 0, "").when(dirt == 1, "  ").when(dirt == 2, F.lit(None))
        .otherwise(text["customer_id"]).alias("customer_id"),
        F.when(F.col("product_id") % 101 == 7, "abc").otherwise(text["product_id"]).alias("product_id"),
        F.when(F.col("transaction_id") % 97 == 5, "bad-date").otherwise(text["order_date"]).alias("order_date"),
        F.when(F.col("product_id") % 50 == 0, F.concat(text["quantity"], F.lit(".0")))
        .otherwise(text["quantity"]).alias("quantity"),
        text["unit_price"].alias("unit_price"),
        F.concat(F.lit("  "), F.col("region"), F.lit(" ")).alias("region"),
        "staged_on",
        F.col("product_id").alias("_p"),
        F.col("l_suppkey").alias("_s"),
    )


def last_staged_first() -> list[Column]:
    return [F.desc("staged_on"), F.desc("_p"), F.desc("_s")]


# ---- orders feed -----------------------------------------------------------


def feed(t: Tables) -> DataFrame:
    """Change feed: every order, and for every 20th a later change to ``returned``."""
    orders = t("orders")
    key = F.col("o_orderkey")
    whole = (key % 5 + 1).cast("string")

    def version(customer_gap: Column, quantity: Column, status: Column, changed: Column) -> list[Column]:
        return [
            F.concat(F.lit("ORD"), F.lpad(key.cast("string"), 8, "0")).alias("order_id"),
            F.when(~customer_gap, F.concat(F.lit("CUST"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")))
            .alias("customer_id"),
            F.concat(F.lit("PROD"), F.lpad((key % 600).cast("string"), 4, "0")).alias("product_id"),
            F.concat(F.lit("CAT"), ((key % 600) % 6).cast("string")).alias("category"),
            quantity.alias("quantity"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("unit_price"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("created_at"),
            changed.alias("modified_at"),
        ]

    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "returned")
        .otherwise("cancelled")
    )
    quirk = F.when(key % 20 == 3, F.concat(whole, F.lit(".0"))).otherwise(whole)
    first = orders.select(version(key % 50 == 7, quirk, status, F.col("o_orderdate")))
    changed = F.col("o_orderdate") + F.expr("interval 30 day")
    later = orders.filter(key % 20 == 0).select(version(key % 200 == 0, whole, F.lit("returned"), changed))
    return first.unionByName(later)


def control(t: Tables) -> DataFrame:
    """HWM control rows as yearly loads before 2001 would have left them."""

    def loads(name: str, table: str, ts: str) -> DataFrame:
        return (
            t(table)
            .filter(F.col(ts) < F.lit("2001-01-01").cast("timestamp_ntz"))
            .groupBy(F.year(ts).cast("bigint").alias("id"))
            .agg(F.max(ts).alias("value"))
            .select(F.lit(name).alias("table_name"), "id", "value")
        )

    return loads("orders", "orders", "o_orderdate").unionByName(loads("lines", "lineitem", "l_shipdate"))


# ---- BI --------------------------------------------------------------------


def bi_bounds(t: Tables) -> DataFrame:
    return calendar.day_bounds(t("orders"), "o_orderdate")


def bi_products(t: Tables) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return t("part").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (price * F.lit("0.7").cast("decimal(2,1)")).cast("decimal(12,3)").alias("unit_cost"),
        price.alias("unit_price"),
    )


def bi_regions(t: Tables) -> DataFrame:
    return t("region").select((F.col("r_regionkey") + 1).alias("region_key"), F.col("r_name").alias("region_name"))


def bi_customers(t: Tables) -> DataFrame:
    return t("customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_mktsegment").alias("segment"),
        (F.lit(2019) + F.col("c_custkey") % 7).cast("int").alias("signup_year"),
    )


def bi_lines(t: Tables, regional: bool = True) -> DataFrame:
    """Lines with the keys of the BI fact; the region costs one more join."""
    order_keys = t("orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    keyed = (
        order_lines(t)
        .withColumn("transaction_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .withColumnRenamed("product_id", "product_key")
        .join(order_keys, "l_orderkey")
    )
    if regional:
        nations = t("nation").select("n_nationkey", (F.col("n_regionkey") + 1).alias("region_key"))
        keyed = (
            keyed.join(t("customer").select(F.col("c_custkey").alias("customer_key"), "c_nationkey"), "customer_key")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .drop("c_nationkey", "n_nationkey")
        )
    return keyed
