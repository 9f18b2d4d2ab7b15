"""BI star schema with surrogate keys, the flat table, measures and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import calendar, money


# ---- star schema -----------------------------------------------------------


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds, numbered from 1."""
    days = bounds.select(
        "first_day",
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"),
    )
    return days.select(
        calendar.day_number("full_date", F.col("first_day")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        calendar.weekday_monday0("full_date").alias("day_of_week"),
        calendar.is_weekend("full_date").alias("is_weekend"),
        calendar.month_short_name("full_date").alias("month_name"),
    )


def fact_sales(lines: DataFrame, products: DataFrame, first_day: Column) -> DataFrame:
    """Surrogate date key and the three measures, each rounded on its own.

    ``lines`` has transaction_id, order_date, product_key, customer_key,
    region_key, quantity and discount_pct (any of the keys may be left out).
    """
    prices = products.select("product_key", "unit_price", "unit_cost")
    keys = [c for c in ("product_key", "customer_key", "region_key") if c in lines.columns]
    revenue = money.net_revenue("unit_price", "quantity", "discount_pct")
    cost = money.line_cost("unit_cost", "quantity")
    return (
        lines.join(prices, "product_key")
        .withColumn("date_key", calendar.day_number("order_date", first_day))
        .withColumn("revenue", revenue)
        .withColumn("cost", cost)
        .withColumn("profit", F.col("revenue") - F.col("cost"))
        .select("transaction_id", "date_key", *keys, "quantity", "discount_pct", "revenue", "cost", "profit")
    )


def flat_sales(
    fact: DataFrame, dates: DataFrame, products: DataFrame, regions: DataFrame, customers: DataFrame
) -> DataFrame:
    """The fact with all attributes of its four dimensions: 20 columns."""
    return (
        fact.join(dates, "date_key")
        .join(products, "product_key")
        .join(regions, "region_key")
        .join(customers, "customer_key")
        .select(
            "transaction_id", "quantity", "discount_pct", "revenue", "cost", "profit",
            "full_date", "year", "month", "quarter", "day_of_week", "is_weekend", "month_name",
            "product_name", "category", "unit_cost", "unit_price", "region_name", "segment", "signup_year",
        )
    )


def map_values(values: Mapping[str, float], key: Column) -> Column:
    """Value of a small fixed map, NULL for unknown keys."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.try_element_at(table, key)


# ---- measures --------------------------------------------------------------


def measures(sales: DataFrame, axes: Sequence[str] = (), filters: Column | None = None) -> DataFrame:
    """Revenue, profit, rows, margin and average order value per axis values.

    Filters come first, then one aggregation; margin and average are ratios of
    the sums, blank where the denominator is zero or missing.
    """
    if filters is not None:
        sales = sales.filter(filters)
    revenue, profit, rows = F.sum("revenue"), F.sum("profit"), F.count(F.lit(1))
    return sales.groupBy(*axes).agg(
        rows.alias("transactions"),
        revenue.alias("total_revenue"),
        profit.alias("total_profit"),
        money.ratio(profit, revenue).alias("profit_margin"),
        money.ratio(revenue, rows, 2).alias("average_order_value"),
    )


def star_month_category(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and profit by year, month and category from the star schema.

    Facts are summed per day and category first, so only those few sums meet the calendar.
    """
    daily = fact.join(products.select("product_key", "category"), "product_key").groupBy("date_key", "category")
    daily = daily.agg(F.sum(money.cents("revenue")).alias("_revenue"), F.sum(money.cents("profit")).alias("_profit"))
    return _month_category(daily.join(dates.select("date_key", "year", "month_name"), "date_key"))


def month_category(sales: DataFrame) -> DataFrame:
    return _month_category(sales.withColumns({"_revenue": money.cents("revenue"), "_profit": money.cents("profit")}))


def _month_category(sales: DataFrame) -> DataFrame:
    axes = ["year", "month_name", "category"]
    sums = [money.from_cents(F.sum(f"_{c}")).alias(c) for c in ("revenue", "profit")]
    return sales.groupBy(*axes).agg(*sums).orderBy(*axes)


def yearly_growth(sales: DataFrame) -> DataFrame:
    """Revenue per year and growth against the previous row, in percent."""
    years = sales.groupBy("year").agg(F.sum("revenue").alias("revenue"))
    # One row per year is left for the single ordered window.
    before = F.lag("revenue").over(Window.orderBy("year"))
    return years.select("year", "revenue", money.growth_percent(F.col("revenue"), before).alias("growth_pct"))


def category_share(sales: DataFrame) -> DataFrame:
    """Rows, revenue, profit per category and their share of the whole, in percent."""
    by_category = sales.groupBy("category").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
    )
    whole = Window.partitionBy()  # over one row per category
    return by_category.select(
        "*",
        money.percent(F.col("transactions"), F.sum("transactions").over(whole)).alias("txn_share_pct"),
        money.percent(F.col("profit"), F.sum("profit").over(whole)).alias("profit_share_pct"),
    ).orderBy(F.desc("profit"), "category")


def contribution(
    sales: DataFrame, of: str, axes: Sequence[str] = (), filters: Column | None = None
) -> DataFrame:
    """Share of each ``of`` value in the profit of what is in view.

    Outer filters apply before the aggregation and the other axes split the
    whole, so the share answers to every slicer but the category itself.
    """
    if filters is not None:
        sales = sales.filter(filters)
    profit = sales.groupBy(*axes, of).agg(F.sum("profit").alias("profit"))
    in_view = F.sum("profit").over(Window.partitionBy(*axes))
    return profit.select("*", money.ratio(F.col("profit"), in_view).alias("contribution"))


def same_period_last_year(
    sales: DataFrame, days: DataFrame, axes: Sequence[str], day: str = "full_date"
) -> DataFrame:
    """Revenue of a period against the same days one year earlier.

    The fact is summed per day first, so everything after works on one row per
    calendar day. Prior days are shifted forward by a year and then met with the
    days in context: a period the calendar covers only in part is compared with
    the same part of last year. 29 February moves to the 28th.
    """
    daily = sales.groupBy(day).agg(F.sum("revenue").alias("revenue"))
    earlier = (
        daily.groupBy(F.add_months(day, 12).alias(day)).agg(F.sum("revenue").alias("prior_revenue"))
    )
    periods = (
        days.select(day, *axes)
        .join(daily, day, "left")
        .join(earlier, day, "left")
        .groupBy(*axes)
        .agg(F.sum("revenue").alias("revenue"), F.sum("prior_revenue").alias("prior_revenue"))
    )
    now = F.coalesce("revenue", F.lit(0))
    return periods.select("*", money.growth(now, F.col("prior_revenue")).alias("growth"))


def weekend_split(sales: DataFrame) -> DataFrame:
    average = F.round(F.sum("revenue") / F.count(F.lit(1)), 2).cast("double")
    return sales.groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("transactions"), average.alias("avg_revenue")
    )


def top_months(sales: DataFrame, k: int = 3) -> DataFrame:
    """Busiest month names across years; the name breaks ties."""
    counted = sales.groupBy("month_name").agg(F.count(F.lit(1)).alias("transactions"))
    return counted.orderBy(F.desc("transactions"), "month_name").limit(k)


# ---- operational reports ---------------------------------------------------


def customer_spend(fact: DataFrame, customers: DataFrame, low: int, high: int) -> DataFrame:
    """Count and spend per customer name for a closed range of ids.

    The fact is summed per customer before the join.
    """
    per_customer = (
        fact.filter(F.col("customer_id").between(low, high))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_spend"))
    )
    return (
        per_customer.join(customers.filter(F.col("customer_id").between(low, high)), "customer_id")
        .groupBy("customer_name")
        .agg(F.sum("_n").alias("transaction_count"), F.sum("_spend").alias("total_spend"))
    )


def daily_region(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_date", "region").agg(
        F.sum("total_amount").alias("daily_revenue"), F.count(F.lit(1)).alias("transaction_count")
    )


def last_days_by_region(fact: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Daily revenue per region from ``days`` days before ``as_of`` up to it."""
    recent = fact.filter(F.col("order_date").between(F.date_sub(as_of, days), as_of))
    return daily_region(recent).orderBy("order_date", "region")


def latest_day_by_region(fact: DataFrame, latest: Column | None = None) -> DataFrame:
    """Revenue per region of the last day; a fact kept by day knows which that is (``layout.newest``)."""
    latest = fact.agg(F.max("order_date")).scalar() if latest is None else latest
    return daily_region(fact.filter(F.col("order_date") == latest))
