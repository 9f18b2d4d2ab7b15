"""Retail sales: landed text to a clean, deduplicated, keyed fact and its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import calendar, money, text
from martloom.operators import clean

RAW_COLUMNS = [
    "transaction_id", "customer_id", "product_id", "order_date", "quantity", "unit_price", "region",
]

TYPES = {
    "transaction_id": text.to_long,
    "customer_id": text.to_int,
    "product_id": text.to_int,
    "order_date": text.to_day,
    "quantity": text.to_whole,
    "unit_price": text.to_money,
    "region": text.blank_to_null,
}
# Silver keeps ids such as "3.0" as 3; the batch load rejects them.
SILVER_TYPES = {**TYPES, "customer_id": text.to_whole, "product_id": text.to_whole, "region": text.trimmed}

# Reject rules in the order they are tried. The reason texts are fixed values.
REJECT_RULES = [
    ("transaction_id", "unparseable TransactionID"),
    ("customer_id", "null/unparseable CustomerID"),
    ("product_id", "null/unparseable ProductID"),
    ("order_date", "unparseable OrderDate"),
    ("quantity", "null/unparseable Quantity"),
    ("unit_price", "null/unparseable UnitPrice"),
    ("total_amount", "line total out of range"),
]

FACT_COLUMNS = [
    "transaction_id", "customer_id", "product_id", "date_key", "order_date",
    "quantity", "unit_price", "total_amount", "region",
]


def typed_batch(bronze: DataFrame) -> DataFrame:
    """Typed columns next to the raw row text."""
    typed = clean.coerce(bronze.withColumn(clean.RAW, text.raw_row(RAW_COLUMNS)), TYPES)
    return typed.withColumn("total_amount", money.line_total("quantity", "unit_price"))


def accepted_and_rejected(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean.split_rejects(typed_batch(bronze), REJECT_RULES)


def clean_sales(bronze: DataFrame, newest_first: Sequence[Column]) -> DataFrame:
    """Cast, set rejects aside, keep the last row per transaction, derive key and total."""
    accepted, _ = accepted_and_rejected(bronze)
    latest = clean.dedup_latest(accepted, ["transaction_id"], newest_first)
    return fact_sales(latest)


def fact_sales(sales: DataFrame) -> DataFrame:
    """Line total and date key; column list and order of the fact."""
    return (
        sales.withColumn("date_key", calendar.date_key("order_date"))
        .withColumn("total_amount", money.line_total("quantity", "unit_price"))
        .select(*FACT_COLUMNS)
    )


def reject_log(bronze: DataFrame) -> DataFrame:
    """Every bad row once, with its first failing rule and the row as landed."""
    return accepted_and_rejected(bronze)[1]


def stamped_rejects(rejected: DataFrame) -> DataFrame:
    return rejected.select(F.current_timestamp().alias("rejected_at"), "reason", "raw_row")


def audit_counts(bronze: DataFrame) -> DataFrame:
    return clean.audit(clean.with_reason(typed_batch(bronze), REJECT_RULES), "transaction_id")


def silver_sales(bronze: DataFrame, newest_first: Sequence[Column]) -> DataFrame:
    """Drop blank customers, keep the newest row per landed id, then type.

    Bad values other than the customer stay in as NULL, and the newest row is
    chosen on the id as text: both are rules of this layer.
    """
    latest = silver_latest(bronze, newest_first)
    return clean.coerce(latest, SILVER_TYPES).select(*RAW_COLUMNS)


def silver_latest(bronze: DataFrame, newest_first: Sequence[Column]) -> DataFrame:
    known = clean.drop_blank_keys(bronze, "customer_id")
    return clean.dedup_latest(known, ["transaction_id"], newest_first)


def duplicates_by_region(bronze: DataFrame, version: Column) -> DataFrame:
    known = clean.drop_blank_keys(bronze, "customer_id").withColumn("region", text.blank_to_null("region"))
    return clean.superseded_counts(known, ["transaction_id"], version, ["region"])


def silver_dimension(snapshot: DataFrame, lineage: Sequence[str] = ("_ingested_at",)) -> DataFrame:
    """Trim first, then drop exact copies on the data columns; no lineage goes on."""
    data = snapshot.drop(*lineage)
    return clean.distinct_rows(clean.trim_strings(data))


def dim_date(fact: DataFrame, day: str = "order_date") -> DataFrame:
    """Every day between the first and the last sale; no rows for an empty fact."""
    return date_attributes(calendar.day_spine(calendar.day_bounds(fact, day)))


def dim_date_observed(fact: DataFrame, day: str = "order_date") -> DataFrame:
    """Only days that occur; gaps stay."""
    days = fact.select(F.col(day).alias("full_date")).filter("full_date IS NOT NULL").distinct()
    return date_attributes(days)


def date_attributes(days: DataFrame) -> DataFrame:
    return days.select(
        calendar.date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        calendar.weekday_name("full_date").alias("day_of_week"),
        calendar.is_weekend("full_date").alias("is_weekend"),
    )
