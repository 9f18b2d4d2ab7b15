"""Orders feed: staging (latest version per order) and four marts with their data tests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import calendar, text
from martloom.operators import clean, quality

FEED = (
    "order_id string, customer_id string, product_id string, category string, quantity string,"
    " unit_price decimal(12,2), order_status string, created_at string, modified_at string"
)

FEED_COLUMNS = [
    "order_id", "customer_id", "product_id", "category", "quantity", "unit_price",
    "order_status", "created_at", "modified_at",
]

# Accepted values of the order status (fixed values).
STATUSES = ["completed", "returned", "cancelled"]


def newest_first(*more: Column) -> list[Column]:
    return [F.desc("modified_at"), *more]


def typed_feed(bronze: DataFrame) -> DataFrame:
    """Landed feed rows, typed. Only the empty text counts as a missing customer."""
    return clean.coerce(
        bronze,
        {
            "customer_id": text.empty_to_null,
            "quantity": text.to_whole,
            "unit_price": lambda c: text.to_money(c, 12),
            "created_at": text.to_instant,
            "modified_at": text.to_instant,
        },
    )


def latest_orders(bronze: DataFrame, *tiebreak: Column) -> DataFrame:
    """Newest version per order; versions without a customer take part."""
    return clean.dedup_latest(typed_feed(bronze), ["order_id"], newest_first(*tiebreak))


def stg_orders(latest: DataFrame) -> DataFrame:
    """Dedupe comes before the customer filter: an order whose newest version has
    no customer is gone, whatever older versions say."""
    gross = F.round(F.col("quantity") * F.col("unit_price"), 2).cast("decimal(18,2)")
    return latest.filter(F.col("customer_id").isNotNull()).select(
        "order_id", "customer_id", "product_id", "category", "quantity", "unit_price",
        gross.alias("gross_amount"), "order_status", "created_at", "modified_at",
    )


def fct_orders(stg: DataFrame) -> DataFrame:
    """One row per order, all statuses."""
    return stg.select(
        "order_id", "customer_id", "product_id", F.to_date("created_at").alias("order_date"),
        "quantity", "unit_price", "gross_amount", "order_status", "created_at", "modified_at",
    )


def dim_customer(stg: DataFrame) -> DataFrame:
    return stg.groupBy("customer_id").agg(
        F.min("created_at").alias("first_order_at"),
        F.max("created_at").alias("last_order_at"),
        F.count(F.lit(1)).alias("lifetime_order_count"),
    )


def dim_product(stg: DataFrame) -> DataFrame:
    """Price of the latest change (order id breaks ties), and number of orders."""
    return stg.groupBy("product_id", "category").agg(
        F.max_by("unit_price", F.struct("modified_at", "order_id")).alias("current_unit_price"),
        F.count_distinct("order_id").alias("times_ordered"),
    )


def dim_date(stg: DataFrame) -> DataFrame:
    spine = calendar.day_spine(calendar.day_bounds(stg, "created_at"), "order_date")
    day_of_week = calendar.weekday_sunday0("order_date")
    return spine.select(
        "order_date",
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
        day_of_week.alias("day_of_week"),
        F.when(day_of_week.isin(0, 6), True).otherwise(False).alias("is_weekend"),
    )


def marts(stg: DataFrame) -> dict[str, DataFrame]:
    return {
        "stg_orders": stg,
        "fct_orders": fct_orders(stg),
        "dim_customer": dim_customer(stg),
        "dim_product": dim_product(stg),
        "dim_date": dim_date(stg),
    }


def data_tests(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The 19 tests: 5 unique, 10 not_null, 1 accepted_values, 3 relationships."""
    fact = t["fct_orders"]
    return [
        quality.unique(t["stg_orders"], "stg_orders", "order_id"),
        quality.not_null(t["stg_orders"], "stg_orders", ["order_id", "customer_id", "quantity"]),
        quality.accepted_values(t["stg_orders"], "stg_orders", "order_status", STATUSES),
        quality.unique(t["dim_customer"], "dim_customer", "customer_id"),
        quality.not_null(t["dim_customer"], "dim_customer", ["customer_id"]),
        quality.unique(t["dim_product"], "dim_product", "product_id"),
        quality.not_null(t["dim_product"], "dim_product", ["product_id"]),
        quality.unique(t["dim_date"], "dim_date", "order_date"),
        quality.not_null(t["dim_date"], "dim_date", ["order_date"]),
        quality.unique(fact, "fct_orders", "order_id"),
        quality.not_null(fact, "fct_orders", ["order_id", "customer_id", "product_id", "order_date"]),
        quality.relationships(fact, "fct_orders", "customer_id", t["dim_customer"], "customer_id"),
        quality.relationships(fact, "fct_orders", "product_id", t["dim_product"], "product_id"),
        quality.relationships(fact, "fct_orders", "order_date", t["dim_date"], "order_date"),
    ]
